"""Line dedup, Jaccard join, decontamination, secrets, licenses, tokens: brute force, edges, hot groups."""

import collections
import hashlib
import random

import numpy as np
import pytest

from tallyriver.llm import bpe, credentials, decontamination, jaccard, licenses, lines, phash
from tallyriver.llm.components import components


# --- components ---------------------------------------------------------------


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)]
    edges = spark.createDataFrame([*path, *star, (7, 7), (None, 3), (500, 501)], "a bigint, b bigint")
    found = {r["node"]: r["root"] for r in components(edges).collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, **{i: 500 for i in range(500, 560)}}
    assert components(edges.limit(0)).count() == 0


# --- line dedup ---------------------------------------------------------------


def test_perfect_hash_is_minimal_and_fingerprints_refuse_others():
    random_ = np.random.default_rng(2)
    keys = random_.integers(0, 2**63, (2, 20_000)).astype(np.uint64)
    keys[0, :5000] = keys[0, 0]  # equal halves are no equal keys
    find = phash.Lookup(phash.build(*keys))
    assert sorted(find(*keys)) == list(range(20_000))
    assert phash.Lookup(phash.build(keys[0][:0], keys[1][:0]))(*keys[:, :3]).tolist() == [-1, -1, -1]
    with pytest.raises(ValueError):
        phash.build(np.zeros(2, np.uint64), np.zeros(2, np.uint64))


def _lines_by_hand(rows, shared=3):
    def key(line):
        return line.strip(" \t\n\v\f\r").translate({c: c + 32 for c in range(65, 91)})

    holders = collections.defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and text is not None and len(key(line)) >= 20:
                holders[key(line)].add(i)
    hot = {k: max(v) for k, v in holders.items() if len(v) >= shared}
    out = []
    for i, text in rows:
        all_ = (text or "").split("\n")
        kept = [x for x in all_ if i is None or key(x) not in hot or hot[key(x)] == i]
        out.append((i, len(all_), len(all_) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


LINE = "A line that many documents share"
LINE_ROWS = [
    (1, f"{LINE}\nown"),
    (2, f"  {LINE.upper()}\t\r\n{LINE}\n"),
    (3, LINE),
    (3, f"{LINE}\nthe same id again, with another line"),
    (4, "ééééééééééééééééééé"),
    (5, "ééééééééééééééééééé"),
    (6, "ééééééééééééééééééé"),
    (7, "éééééééééééééééééééé"),
    (8, "éééééééééééééééééééé"),
    (9, "éééééééééééééééééééé"),
    (10, "a line in one document, but twice\na line in one document, but twice\na line in one document, but twice"),
    (11, "a line of the same id in three rows"),
    (11, "a line of the same id in three rows"),
    (11, "a line of the same id in three rows"),
    (None, LINE),
    (None, None),
    (12, None),
    (13, ""),
]


@pytest.mark.parametrize("options", [{}, {"shard_keys": 1, "salts": 3}])
def test_line_dedup_by_hand(spark, frame, edges, options):
    rows = [*LINE_ROWS, *edges]
    docs = frame(rows)
    out = lines.dedup_lines(docs, **options)
    assert set(out.columns) == {*docs.columns, "n_dropped"}
    mine = sorted([(r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in out.collect()], key=str)
    assert mine == _lines_by_hand(rows)
    assert lines.dedup_lines(frame([])).count() == 0


# --- Jaccard join -------------------------------------------------------------


def _components_by_hand(rows, percent=80):
    def shingles(text):
        words = (text or "").encode().lower().split()
        if len(words) < 5:
            return {tuple(words)} if words else set()
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), min(ids) if ids and sets[i] else doc))
    return sorted(out, key=str)


def _near_copies(n, words, seed, changed):
    random_ = random.Random(seed)
    base = [f"w{random_.randrange(10_000)}" for _ in range(words)]
    texts = []
    for _ in range(n):
        copy = list(base)
        for _ in range(random_.randrange(changed + 1)):
            copy[random_.randrange(words)] = f"x{random_.randrange(10_000)}"
        texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize("options", [{}, {"group_tokens": 300, "buckets": 64}])
def test_jaccard_by_hand(spark, frame, edges, options):
    passage = " ".join(f"p{i}" for i in range(30))
    texts = _near_copies(25, 80, 1, 4) + _near_copies(25, 40, 2, 1) + ["a b c d", "a b c d e", "A B\tC d", "a b c d e f"]
    texts += [f"{passage} {t}" for t in _near_copies(6, 30, 3, 30)] + texts[:5] * 4
    rows = [*((100 + i, t) for i, t in enumerate(texts)), *edges]
    found = jaccard.jaccard_components(frame(rows), **options)
    mine = sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect()], key=str)
    assert mine == _components_by_hand(rows)
    assert jaccard.jaccard_components(frame([])).count() == 0


@pytest.mark.parametrize("percent", [1, 55, 80, 99, 100])
def test_linked_sizes_lie_in_neighbouring_bands(percent):
    edges = np.array(jaccard.band_edges(percent))
    assert (np.diff(edges) > 0).all() and len(edges) < 200
    sizes = np.arange(1, 5000)
    largest = np.minimum(sizes * 100 // percent, jaccard.LARGEST_SET - 1)
    own, far = (np.searchsorted(edges, x, side="right") for x in (sizes, largest))
    assert (far - own <= 1).all()


@pytest.mark.parametrize("percent", [50, 80, 100])
def test_jaccard_links_sets_of_neighbouring_bands(spark, frame, percent):
    """Sequences of growing length over three vocabularies: a link where one is just long enough for the next."""
    sizes = [4, 5, 6, 8, 10, 13, 16, 20, 25, 31, 32, 40, 50, 62, 63, 64, 80, 100, 101, 126, 157, 200, 251]
    texts = [" ".join(f"{name}{i}" for i in range(n + 4)) for name in "abc" for n in sizes[ord(name) % 3 :: 2]]
    rows = list(enumerate(texts))
    found = jaccard.jaccard_components(frame(rows), percent=percent)
    mine = sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect()], key=str)
    assert mine == _components_by_hand(rows, percent)


def test_guests_meet_home_sets_alone():
    sets = [np.arange(start, start + 20, dtype=np.uint64) for start in (0, 1, 2, 100, 101)]
    assert sorted(jaccard.linked([5, 6, 7, 8, 9], sets, 80, [False, True, False, False, False])) == [(6, 5), (7, 5)]
    assert sorted(jaccard.linked([5, 6, 7, 8, 9], sets, 80)) == [(6, 5), (7, 5), (9, 8)]


def test_trie_finds_every_link_at_the_border():
    random_ = random.Random(4)
    sets = []
    for _ in range(12):
        base = random_.sample(range(1000), 40)
        for _ in range(6):
            sets.append(np.array(sorted({*base[random_.randrange(9) :], *random_.sample(range(1000, 1100), 2)}), np.uint64))
    found = dict(jaccard.linked(list(range(len(sets))), sets, 80))
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(set(sets[i].tolist()) & set(sets[j].tolist()))
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    assert {i: found.get(i, i) for i in range(len(sets))} == {i: find(i) for i in range(len(sets))}


# --- decontamination ----------------------------------------------------------


def test_leaks_by_hand(spark, frame, edges):
    random_ = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(random_.choices(words, k=random_.choice([3, 5, 6, 9, 20, 60])))) for i in range(40)]
    rows = list(edges)
    for i, (_, text) in enumerate(items):
        held = text.split()
        if i % 3 == 0 and len(held) > 10:
            held[len(held) // 2] = "other"
        filler = [random_.choice(words) for _ in range(random_.choice([0, 10, 2000]))]
        rows.append((200 + i, " ".join([*filler, *held, *filler[:7]]).title()))
    items += [(50, None), (51, ""), (None, "w1 w2 w3 w4 w5"), (1, "w1 w2 w3 w4 w5 w6")]

    def shingles(text):
        norm = "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()
        if len(norm) < 5:
            return {tuple(norm)} if norm else set()
        return {tuple(norm[i : i + 5]) for i in range(len(norm) - 4)}

    tests, held = collections.defaultdict(set), collections.defaultdict(set)
    for i, t in items:
        if i is not None:
            tests[i] |= shingles(t)
    for i, t in rows:
        if i is not None:
            held[i] |= shingles(t)
    wanted = sorted(
        (d, i, len(s), len(s & h)) for d, h in held.items() for i, s in tests.items() if s and 100 * len(s & h) >= 80 * len(s)
    )
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, hashes string")
    docs = frame(rows)
    found = decontamination.find_leaks(docs, bench).collect()
    assert sorted((r["doc_id"], r["item_id"], r["n_shingles"], r["n_shared"]) for r in found) == wanted and len(wanted) > 20
    assert all(r["containment"] == r["n_shared"] / r["n_shingles"] for r in found)
    clean = decontamination.without_leaks(docs, bench)
    leaked = {w[0] for w in wanted}
    assert sorted(map(str, (r["doc_id"] for r in clean.collect()))) == sorted(str(i) for i, _ in rows if i not in leaked)
    assert decontamination.find_leaks(frame([]), bench).count() == 0
    assert decontamination.find_leaks(docs, bench.limit(0)).count() == 0


def test_decontamination_plan_is_native(spark, frame):
    bench = spark.createDataFrame([(1, "a b c d e f g")], "item_id bigint, text string")
    plan = decontamination.find_leaks(frame([(1, "a b c d e f g")]), bench)._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapIn" not in plan and "CartesianProduct" not in plan


# --- credentials --------------------------------------------------------------


def _spans(spark, frame, text):
    found = credentials.find_credentials(frame([(1, text)])).collect()
    return [(s["kind"], text[s["start"] : s["end"]]) for s in found[0]["spans"]]


def test_strong_secrets_are_reported_alone(spark, frame):
    key = "AKIA" + "Z9" * 8
    text = f"😀é PassWord : 'abcd1234' x {key} {'0f' * 20} secret=short"
    assert _spans(spark, frame, text) == [("assign", "PassWord : 'abcd1234"), ("access", key), ("hex", "0f" * 20), ("credential", "secret=short")]
    # a failing match still takes its characters
    assert _spans(spark, frame, "secret=token:abcdefgh1") == []


def test_weak_parts_need_their_complement_in_scope(spark, frame):
    user, site, secret = "username=alice", "https://db.example.com/x", "pwd=abc12"
    far = " .." * 200
    assert _spans(spark, frame, user) == _spans(spark, frame, site) == _spans(spark, frame, secret) == []
    assert _spans(spark, frame, f"{user} {site}") == []
    assert [k for k, _ in _spans(spark, frame, f"{user} {secret}")] == ["identifier", "credential"]
    assert [k for k, _ in _spans(spark, frame, f"{site} {secret} {user}")] == ["endpoint", "credential", "identifier"]
    assert _spans(spark, frame, f"{user}{far}{secret}") == []
    assert [k for k, _ in _spans(spark, frame, f"{user}{far}{secret} {site}")] == ["credential", "endpoint"]


def test_credentials_edges(spark, frame, edges):
    rows = [*edges, (8, "token=abcdefgh1 " * 500), (9, "token=abcdefgh1"), (9, "token=abcdefgh1"), (9, "token=abcdefgh2 x")]
    found = credentials.credential_digest(credentials.find_credentials(frame(rows))).collect()
    assert collections.Counter(r["doc_id"] for r in found) == collections.Counter(i for i, _ in rows)
    assert [r["n_assign"] for r in found if r["doc_id"] == 8] == [500]
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r["base_sha256"] == empty and r["spans"] == "" for r in found if r["doc_id"] not in (8, 9))
    assert {r["spans"] for r in found if r["doc_id"] == 9} == {"assign:0:15"}
    assert credentials.find_credentials(frame([])).count() == 0


# --- licenses -----------------------------------------------------------------


def _phrases_by_hand(text):
    import re

    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    places = []
    for phrase, label in licenses.BASE_PHRASES.items():
        wanted = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(wanted)] == wanted]
    return len(words), sorted(places)


def test_licenses_by_hand(spark, frame, documents, edges):
    odd = "GNU General\nPublic-License; cc by CC-BY-SA 4.0, mitt license the MIT License ßapache license"
    rows = [*documents, *edges, (900_001, odd), (900_002, "Licensed under the Apache License, Version 2.0. " * 3)]
    labelled = licenses.license_labels(licenses.scan_licenses(frame(rows))).collect()
    assert len(labelled) == len(rows)
    wanted = collections.Counter()
    for i, text in rows:
        n, places = _phrases_by_hand(text)
        starts = [p for p, _ in places]
        wanted[(i, n, len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))] += 1
    names = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert collections.Counter(tuple(r[c] for c in names) for r in labelled) == wanted
    for r in labelled:
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    by_id = {r["doc_id"]: r for r in labelled}
    assert by_id[900_001]["labels"] == "cc-by,cc-by-sa-4.0,gpl,mit"
    assert by_id[900_002]["labels"] == "apache,apache-2.0"
    assert licenses.scan_licenses(frame([])).count() == 0


def test_contained_detections_are_suppressed():
    n, base, found = licenses.Scanner().scan(b"the GNU General Public License, version 3.0 or any later version. SPDX-License-Identifier: MIT")
    assert [(s, e, label) for s, e, label, _ in found] == [(1, 12, "gpl-3.0-or-later"), (12, 16, "mit")]
    assert base == [(1, 5, "gpl")]
    assert len(licenses.build_rules()) >= 200


def test_every_rule_names_its_keyword():
    assert all(rule.keyword in rule.pattern for rule in licenses.build_rules())


# --- tokens -------------------------------------------------------------------


@pytest.fixture(scope="module")
def codec():
    import public_tokenizers
    import tiktoken

    tokens = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    pattern = public_tokenizers.PATTERN
    theirs = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    return bpe.Codec(bpe.model_bytes(tokens), tokens, pattern), theirs


def _same(codec, text):
    mine, theirs = codec
    ids = mine.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == theirs.encode_ordinary(text)
    assert mine.decode(ids) == text.encode()


def test_tokens_equal_the_other_library(codec, documents):
    for _, text in documents:
        _same(codec, text)
    random_ = random.Random(6)
    for _ in range(300):
        spans = [(32, 127), (0, 0xD800), (0xE000, 0x110000), (9, 14)]
        _same(codec, "".join(chr(random_.randrange(*random_.choice(spans))) for _ in range(random_.randrange(80))))
    for text in ("", " ▁ a▁b", "<unknown>", "<|endoftext|>", "a" * 5000, "\x00\x1c\x85\u2028  \n\n x"):
        _same(codec, text)


def test_tokens_with_a_small_cache(codec, documents, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 10)
    for _, text in documents[:20]:
        _same(codec, text)


def test_tokens_edges(spark, frame, edges):
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    rows = bpe.decode(bpe.encode(frame(edges), path, pattern), path).collect()
    assert collections.Counter((r["doc_id"], bytes(r["decoded"])) for r in rows) == collections.Counter(
        (i, (t or "").encode()) for i, t in edges
    )
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in rows)
    at_once = bpe.encode(frame(edges), path, pattern, decoded=True)
    assert sorted(map(str, at_once.collect())) == sorted(map(str, rows))
    assert bpe.encode(frame([]), path, pattern).count() == 0
    nulls = spark.createDataFrame([(1, None, None)], "doc_id bigint, n_tokens bigint, ids binary")
    assert bytes(bpe.decode(nulls, path).first()["decoded"]) == b""


def test_short_items_are_found_inside_longer_documents(spark):
    docs = [(1, "one two three four five six seven"), (2, "three four"), (3, "four three two one zero minus one"), (4, "Three, four!"), (5, "five")]
    items = [(10, "three four"), (11, "five"), (12, "six seven eight"), (13, "two three four five six"), (14, "minus"), (14, "four three two one zero minus")]
    held, bench = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    found = decontamination.find_leaks(held, bench, short_items=True).collect()
    assert sorted((r["doc_id"], r["item_id"], r["n_shingles"], r["n_shared"]) for r in found) == [
        (1, 10, 1, 1), (1, 11, 1, 1), (1, 13, 1, 1), (2, 10, 1, 1), (3, 14, 3, 3), (4, 10, 1, 1), (5, 11, 1, 1),
    ]


def test_a_line_that_shares_half_a_fingerprint_is_not_found():
    import pyarrow as pa

    top = np.uint64(7 << 32)
    key = {"shard": pa.array([0], pa.int32()), "high": pa.array([1]), "low": pa.array([7 << 32]), "documents": pa.array([3]), "last": pa.array([9])}
    (built,) = lines._build_pass(iter([pa.RecordBatch.from_pydict(key)]))
    arrays = lines._Arrays(built.to_pylist()[0])
    others = np.arange(1, 20_001, dtype=np.uint64)
    assert (arrays.find(others, top + others) >= 0).any()
    assert not arrays.dropped(np.zeros(20_000, np.int64), others, top + others, 3).any()
    assert arrays.dropped(np.array([4]), np.array([1], np.uint64), np.array([top]), 3).all()


@pytest.mark.parametrize(
    "text, label",
    [
        ("https://creativecommons.org/licenses/by-nc-sa/4.0/", "cc-by-nc-sa-4.0"),
        ("https://creativecommons.org/licenses/by-nc-nd/4.0/", "cc-by-nc-nd-4.0"),
        ("see creativecommons.org/licenses/by/ for terms", "cc-by"),
        ("see creativecommons.org/licenses/by-nc-sa/ for terms", "cc-by-nc-sa"),
        ("Boost Software License - Version 1.0", "bsl-1.0"),
        ("Business Source License 1.1", "busl-1.1"),
        ("SPDX-License-Identifier: BUSL-1.1", "busl-1.1"),
        ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause"),
        ("SPDX-License-Identifier: Zlib", "zlib"),
        ("SPDX-License-Identifier: Unlicense", "unlicense"),
        ("SPDX-License-Identifier: PostgreSQL", "postgresql"),
        ("SPDX-License-Identifier: 0BSD", "0bsd"),
        ("the Server Side Public License, version 1", "sspl-1.0"),
    ],
)
def test_named_licenses(text, label):
    _, _, found = licenses.Scanner().scan(text.encode())
    assert [f[2] for f in found] == [label]


def test_many_matches_take_linear_time():
    import time

    scanner, times = licenses.Scanner(), []
    for copies in (10_000, 80_000):
        started = time.process_time()
        n, base, found = scanner.scan(b"mit license " * copies)
        times.append(time.process_time() - started)
        assert n == 2 * copies and len(base) == copies and [f[0] for f in found] == list(range(0, 2 * copies, 2))
    # about 1 MB; eight times the matches
    assert times[1] <= 30 * times[0] + 0.5


def test_enough_rules_are_written_by_hand():
    written = sum(map(len, licenses.VERSIONED.values())) + len(licenses.PLAIN)
    assert written >= 200 and len(licenses.build_rules()) > 300
    for rule in licenses.build_rules():
        # the keyword gates the rule, so a match must hold it
        assert rule.keyword in rule.pattern, rule
