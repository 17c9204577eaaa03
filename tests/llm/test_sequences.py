"""Runs of words, language-model scores and conversation repair against brute force."""

import collections
import hashlib
import heapq
import itertools
import math
import os
import random
import re
import time
import zlib

import numpy as np
import pytest

from tallyriver.llm import language_model as lm
from tallyriver.llm.conversations import FINAL, backward, kinds_of, repair, repair_conversations, walk, with_inserts
from tallyriver.llm.queries import QUERIES, planted_run
from tallyriver.llm.runs import SquareCatchers, find_runs
from tallyriver.llm.text import word_hashes
from tallyriver.storage import SHUFFLE_CLEANUP

BLANK = r"[^\x20\x09-\x0D]+"


# --- runs ---


def brute_runs(words, least=12):
    """Maximal stretches of every period; of one stretch, the smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((a, b - a, q) for (a, b), q in found.items())


def caught(words, sizes, **options):
    catchers = SquareCatchers(**options)
    hashes, at = word_hashes([w.encode() for w in words]), 0
    for size in itertools.cycle(sizes):
        if at >= len(hashes):
            break
        catchers.append(hashes[at : at + size])
        at += size
    return list(zip(*(a.tolist() for a in catchers.runs())))


def substituted(rule, start, rounds):
    for _ in range(rounds):
        start = "".join(rule[c] for c in start)
    return start


def run_cases():
    rng = random.Random(1)
    yield from ("", "a", "a" * 11, "a" * 12, "a" * 50, "ab" * 30, "abcabcabcab", "abcabcabcabc")
    yield substituted({"0": "01", "1": "10"}, "0", 9)
    yield substituted({"a": "ab", "b": "a"}, "a", 11)
    for _ in range(150):
        letters = rng.choice(["ab", "abc", "aab"])
        yield "".join(rng.choice(letters) for _ in range(rng.randrange(1, 90)))
    for _ in range(60):
        root = [str(rng.randrange(6)) for _ in range(rng.randrange(1, 40))]
        yield [str(rng.randrange(6)) for _ in range(rng.randrange(30))] + root * rng.randrange(2, 5) + root[:3] + list("xyz")


def test_runs_equal_brute_force():
    for words in run_cases():
        assert caught(words, [1 << 20]) == brute_runs(words), words


def test_runs_do_not_depend_on_how_words_are_appended():
    for words in itertools.islice(run_cases(), 60):
        assert caught(words, [1]) == caught(words, [7, 2, 31]) == brute_runs(words), words


def test_runs_of_other_lengths():
    for least, words in itertools.product((1, 2, 5, 30), itertools.islice(run_cases(), 40)):
        assert caught(words, [1 << 20], min_length=least) == brute_runs(words, least)


def test_sums_that_collide_do_not_change_runs(monkeypatch):
    """With sums of a few values only, all that is found wrong is searched again."""
    whole = SquareCatchers.window
    monkeypatch.setattr(SquareCatchers, "window", lambda self, start, size: whole(self, start, size) % np.uint64(3))
    # pieces may still be found too large, never too small: every reported run is checked word by word
    for words in itertools.islice(run_cases(), 40):
        for start, length, period in caught(words, [1 << 20]):
            part = list(words[start : start + length])
            assert part[period:] == part[:-period]


def test_a_long_text_of_one_word():
    assert caught(["la"] * 200_000, [1 << 20]) == [(0, 200_000, 1)]


def brute_digest(doc_id, text):
    words = re.findall(BLANK, text or "")
    places = planted_run(doc_id, len(words))
    words = words if places is None else [words[k] for k in places]
    runs = brute_runs(words)
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    longest = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return (len(runs), *longest, *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)))


def test_planted_run_follows_its_rule():
    chosen = [i for i in range(100) if planted_run(i, 50) is not None]
    assert chosen == [i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0] != []
    g = zlib.crc32(str(chosen[0]).encode()) // 10
    a, p = g % 50, 1 + (50 - g % 50) // (3 + g % 8)
    assert planted_run(chosen[0], 50).tolist() == [i if i < a else a + (i - a) % p for i in range(50)]
    assert planted_run(chosen[0], 0) is None and planted_run(None, 50) is None


def test_run_query_equals_brute_force(spark, sf_dir, documents):
    short = {i: t for i, t in documents if len(t or "") < 3000}
    rows = QUERIES["op11_periodic_runs"](spark, sf_dir).collect()
    assert len(rows) == len(documents) and {r["doc_id"] for r in rows} == {i for i, _ in documents}
    for r in rows:
        if r["doc_id"] in short:
            assert tuple(r)[1:] == brute_digest(r["doc_id"], short[r["doc_id"]])
    assert any(r["n_runs"] for r in rows)


def test_run_edges(frame, edges, spark):
    found = find_runs(frame(edges))
    rows = sorted(found.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["collapsed"]))
    assert len(rows) == len(edges)
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert [by[i]["n_words"] for i in (1, 2, 3, 4, 5)] == [0, 0, 0, 1, 10]
    assert by[1]["runs"] == [] and by[1]["collapsed"] == "" and by[6]["collapsed"] == "ÀÉ 漢字 😀 \x00 word next"
    assert [tuple(r) for r in by[7]["runs"]] == [(0, 60_000, 1)] and by[7]["collapsed"] == "long"
    empty = find_runs(frame(edges).limit(0))
    assert empty.count() == 0 and empty.schema == found.schema


def test_texts_in_one_group_do_not_touch(frame):
    text = "a b c a b c a b"
    rows = find_runs(frame([(i, text) for i in range(50)])).collect()
    assert all(r["runs"] == [] for r in rows)


# --- language model ---


def tokens_of(text):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(BLANK, text or "")]


def brute_scores(train, texts, pseudo):
    """(tokens, known, base, score) of each text by dictionaries, counts rounded as the filter does."""
    single, pairs = collections.Counter(), collections.Counter()
    for text in train:
        words = [("begin",), *tokens_of(text), ("end",)]
        single.update(words)
        pairs.update(zip(words, words[1:]))
    n = sum(c for w, c in single.items() if w != ("begin",))
    v = len([w for w in single if w != ("begin",)])

    def near(c):
        return (3 * 2 ** (c.bit_length() - 1) - 1) / 2 if c else 0

    rows = []
    for text in texts:
        words = [("begin",), *tokens_of(text), ("end",)]
        base = score = known = 0
        for a, b in zip(words, words[1:]):
            below = n + 0.1 * (v + 1)
            base += math.log10((single[b] + 0.1) / below)
            known += single[b] > 0
            p = (min(near(single[b]), n) + 0.1) / below
            context = near(single[a])
            score += math.log10((min(near(pairs[a, b]), context) + pseudo * p) / (context + pseudo))
        rows.append((len(words) - 1, known, base, score))
    return n, rows


def close(got, wanted):
    return got[:2] == wanted[:2] and all(math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9) for a, b in zip(got[2:], wanted[2:]))


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}])
@pytest.mark.parametrize("shard_chars", [lm.SHARD_CHARS, 20_000])
def test_scores_equal_dictionaries(spark, frame, documents, options, shard_chars):
    rows = documents[:60]
    train, texts = [t for i, t in rows if i % 3], [t for _, t in rows]
    # so many bits that no probe hits by chance
    model = lm.fit_language_model(frame([(i, t) for i, t in rows if i % 3]), shard_chars=shard_chars, bits=200)
    total, wanted = brute_scores(train, texts, 7.0)
    assert model.totals.tokens == total and (model.shards > 1) == (shard_chars == 20_000)
    got = lm.score_texts(frame(rows), model, pseudo_count=7.0, **options).orderBy("doc_id").collect()
    assert all(close(tuple(g)[1:], w) for g, w in zip(got, wanted)) and len(got) == len(wanted)


def test_lm_query(spark, sf_dir, documents):
    out = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in documents}
    total, wanted = brute_scores([t for i, t in documents if not out[i]], [t for _, t in documents], lm.PSEUDO_COUNT)
    rows = {r["doc_id"]: r for r in QUERIES["op12_lm_scoring"](spark, sf_dir).collect()}
    assert len(rows) == len(documents)
    for (i, _), w in zip(documents, wanted):
        r = rows[i]
        assert (r["held_out"], r["train_tokens"]) == (out[i], total)
        assert (r["n_tokens"], r["n_known"]) == w[:2] and math.isclose(r["base_score"], w[2], rel_tol=1e-9)
        # a few probes may hit by chance
        assert abs(r["score"] - w[3]) <= 0.01 * abs(w[3]) + 0.01
    held = [r for r in rows.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_filter_holds_every_level():
    rng = np.random.default_rng(2)
    hashes = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    counts = np.minimum(rng.zipf(1.6, 20_000), 1 << 40)
    bits = lm.filter_bits(hashes, counts)
    filters = lm.Filters([len(bits)], bits.tobytes())
    found = filters.levels(hashes, np.zeros(len(hashes), np.int64))
    assert (found >= lm.levels_of(counts)).all() and (found > lm.levels_of(counts)).mean() < 0.006
    unseen = rng.integers(0, 1 << 63, 200_000, dtype=np.uint64)
    assert (filters.levels(unseen, np.zeros(len(unseen), np.int64)) > 0).mean() < 0.005


@pytest.mark.parametrize("limit", [lm.BROADCAST_BYTES, 0])
def test_lm_edges(frame, edges, limit):
    model = lm.fit_language_model(frame(edges))
    found = lm.score_texts(frame(edges), model, broadcast_bytes=limit)
    rows = found.collect()
    assert len(rows) == len(edges) and all(r["score"] <= 0 and r["n_known"] == r["n_tokens"] for r in rows)
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert [by[i]["n_tokens"] for i in (1, 2, 3, 4, 5, 7)] == [1, 1, 1, 2, 11, 60_001]
    assert sum(r["doc_id"] is None for r in rows) == 2
    empty = lm.score_texts(frame(edges).limit(0), model, broadcast_bytes=limit)
    assert empty.count() == 0 and empty.schema == found.schema
    nothing = lm.fit_language_model(frame(edges).limit(0))
    assert nothing.totals == (0, 0)
    assert {r["n_known"] for r in lm.score_texts(frame(edges), nothing, broadcast_bytes=limit).collect()} == {0}


# --- conversations ---


def faults_of(rows):
    seen, found = set(), []
    for role, text in rows:
        end = text.rstrip(" \t\n\v\f\r")[-1:]
        found.append("blank" if not end else "duplicate" if (role, text) in seen else "" if end in ".!?" else "truncated")
        seen.add((role, text))
    return found


def cheapest(rows):
    """Cost, letters and resulting rows of the cheapest repair, by a search over all edits in the order of cost and letters."""
    faults, done = faults_of(rows), set()
    heap = [(0, "", 0, ())]
    while True:
        cost, letters, i, out = heapq.heappop(heap)
        initials = "".join(r[:1] for r, _ in out)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            return cost, letters, out
        if (i, initials[-1:]) in done or not re.fullmatch("s?(ua)*u?", initials):
            continue
        done.add((i, initials[-1:]))
        for role in ("user", "assistant"):
            heapq.heappush(heap, (cost + 5, letters + "I", i, (*out, (role, ""))))
        if i < len(rows):
            role, text = rows[i]
            heapq.heappush(heap, (cost + 2, letters + "D", i + 1, out))
            if faults[i] in ("", "truncated"):
                more = 5 * (faults[i] == "truncated")
                if role[:1]:
                    heapq.heappush(heap, (cost + more, letters + "K", i + 1, (*out, (role, text))))
                for other in ("user", "assistant"):
                    heapq.heappush(heap, (cost + more + 1, letters + "R", i + 1, (*out, (other, text))))


def brute_repair(rows):
    """The contract's numbers of (turn, role, text) rows in order."""
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [(r, x) for _, r, x in rows]
    faults = faults_of(pairs)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, letters, out = cheapest(pairs)
    text = "\n".join(f"{r}:{x}" for r, x in out)
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, letters, hashlib.sha256(text.encode()).hexdigest())


def damaged(rows):
    """(conv, turn, role, text) rows after the damage of the query, in order, by conversation."""
    convs = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv]
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(key.encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fate, text)
        role = "user" if fate == 4 else role
        convs[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0)) for c, r in convs.items()}


def random_rows(rng, n):
    roles, texts = ("user", "assistant", "system", "tool", " ", "u"), ("Hi.", "Yo!", "cut", "a?", " \t", "b.", "c.", "d. ", "e\n")
    return [(rng.choice(roles), rng.choice(texts)) for _ in range(n)]


def test_repair_equals_search_over_edits():
    rng = random.Random(5)
    for _ in range(1500):
        rows = random_rows(rng, rng.randrange(0, 10))
        roles, texts = [r for r, _ in rows], [t for _, t in rows]
        assert repair(kinds_of(roles, texts)) == cheapest(rows)[:2], rows


def test_checkpoints_do_not_change_the_walk():
    """A walk in two parts, the second from the first one's state, gives the letters of the whole."""
    rng = random.Random(6)
    for _ in range(100):
        rows = random_rows(rng, rng.randrange(2, 60))
        kinds, cut = kinds_of(*zip(*rows)), rng.randrange(1, len(rows))
        end = with_inserts(FINAL)
        first, state = walk(kinds[:cut], backward(kinds[cut:], end), last=False)
        assert first + walk(kinds[cut:], end, state)[0] == walk(kinds, end)[0] == repair(kinds)[1]


def test_conversation_query_equals_brute_force(spark, sf_dir):
    table = spark.read.parquet(os.path.join(sf_dir, "conversations.parquet"))
    wanted = {c: brute_repair(r) for c, r in damaged([tuple(r) for r in table.collect()]).items()}
    rows = QUERIES["op13_conversation_repair"](spark, sf_dir).collect()
    assert len(rows) == len(wanted) and {r["conv_id"]: tuple(r)[1:] for r in rows} == wanted


CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string, conv string, place string, copies string, kinds string"


def made(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], CONVERSATIONS).repartition(3)


@pytest.mark.parametrize("block_rows", [1, 3, 1000])
@pytest.mark.parametrize("damage", [True, False])
def test_blocks_do_not_change_conversations(spark, block_rows, damage):
    rng = random.Random(block_rows)
    rows = [(c, t, *random_rows(rng, 1)[0]) for c in range(12) for t in range(rng.randrange(1, 25))]
    rows += [(99, t, *random_rows(rng, 1)[0]) for t in range(0, 120, 2)] + [(None, t, "user", "Hi.") for t in range(4)]
    if damage:
        wanted = damaged(rows)
    else:
        wanted = collections.defaultdict(list)
        for c, t, r, x in rows:
            wanted[c].append((t, r, x))
    found = repair_conversations(made(spark, rows), damage=damage, block_rows=block_rows).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in found} == {c: brute_repair(r) for c, r in wanted.items()}


def test_conversation_edges(spark):
    rows = [
        (1, 0, None, "Hello."), (1, 1, "assistant", None), (2, None, "user", "Hi."), (2, None, "user", "Hi."), (2, 5, "assistant", "Yes."),
        (3, 0, "user", "long. " * 20_000 + "!"), (3, 3, "assistant", "ok"), (4, 7, "system", "Be kind."), (None, None, None, None),
    ]
    found = {r["conv_id"]: r for r in repair_conversations(made(spark, rows)).collect()}
    assert set(found) == {1, 2, 3, 4, None}
    by = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, role or " ", text or " "))
    assert {c: tuple(r)[1:] for c, r in found.items()} == {c: brute_repair(r) for c, r in by.items()}
    assert (found[2]["gaps"], found[2]["duplicate"], found[3]["gaps"], found[4]["audit"]) == (0, 1, 2, "D")
    empty = repair_conversations(made(spark, rows).limit(0))
    assert empty.count() == 0 and empty.columns == list(found[1].asDict())


def test_a_conversation_that_loses_all_rows(spark):
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    row = repair_conversations(made(spark, [(lost, 0, "user", "Hi.")]), damage=True).collect()
    assert [tuple(r) for r in row] == [(lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_many_equal_rows_of_one_turn(spark):
    rows = spark.range(3000).selectExpr("1L as conv_id", "7L as turn", "'user' as role", "'Hi.' as text")
    (row,) = repair_conversations(rows, block_rows=100).collect()
    assert (row["duplicate"], row["illegal"], row["audit"]) == (2999, 2999, "D" * 3000)


def test_a_group_of_texts_takes_little_memory():
    """A group's arrays are small beside a worker's share of an executor, however many texts a batch holds."""
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(1)
    texts = [" ".join(f"w{n}" for n in rng.zipf(1.3, 30_000) % 1_000_000) for _ in range(130)]
    batch = pa.record_batch([pa.array(texts)], names=["text"])
    assert batch.nbytes > 9 << 20
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in lm._count_pass(3)(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows >= 3 and peak < 96 << 20


def test_look_ups_do_not_depend_on_their_parts(monkeypatch):
    hashes = np.arange(1, 5001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    counts = np.arange(5000) % 9 + 1
    bits = lm.filter_bits(hashes, counts)
    filters = lm.Filters([len(bits)], bits.tobytes())
    shard = np.zeros(len(hashes), np.int64)
    whole = filters.levels(hashes, shard)
    monkeypatch.setattr(lm, "LOOKUP", 7)
    assert (filters.levels(hashes, shard) == whole).all() and (whole >= lm.levels_of(counts)).all()
    assert len(filters.levels(hashes[:0], shard[:0])) == 0


def calls_in(fn):
    """How many functions are called, those in C included."""
    import sys

    n = 0

    def seen(frame, event, arg):
        nonlocal n
        n += event in ("call", "c_call")

    sys.setprofile(seen)
    try:
        fn()
    finally:
        sys.setprofile(None)
    return n


def test_a_group_is_dealt_without_a_step_for_each_shard():
    """Groups and shards both grow with the input, so steps for each of both would grow with its square."""
    import pyarrow as pa

    batch = pa.record_batch([pa.array([" ".join(f"w{n}" for n in range(5000))])], names=["text"])
    few, many = (calls_in(lambda: list(lm._count_pass(shards)(iter([batch])))) for shards in (10, 3000))
    assert many < few + 100


def counted_and_built(texts, shards):
    import pyarrow as pa

    batches = [pa.record_batch([pa.array(t)], names=["text"]) for t in texts]
    rows = pa.Table.from_batches(list(lm._count_pass(shards)(iter(batches)))).sort_by("shard")
    parts = rows.to_batches(max_chunksize=3)
    return pa.Table.from_batches(list(lm._build_pass(200)(iter(parts)))).to_pylist()


def test_counts_beyond_a_byte_are_whole():
    texts = [["a " * 254 + "b", "a " * 256], ["a " * 70_000 + "c " * 255, "c b c"]]
    single = collections.Counter(w for t in sum(texts, []) for w in t.split())
    rows = counted_and_built(texts, 7)
    held = {h: n for r in rows for h, n in zip(np.frombuffer(r["hashes"], np.uint64).tolist(), np.frombuffer(r["counts"], np.int64).tolist())}
    hashes = dict(zip(single, word_hashes([w.encode() for w in single]).tolist()))
    assert held == {**{hashes[w]: n for w, n in single.items()}, int(lm.END): 4}
    assert sum(r["tokens"] for r in rows) == sum(single.values()) + 4


@pytest.mark.parametrize("asked", [1, 40, lm.ASKED])
def test_answers_look_up_what_several_groups_ask_once(monkeypatch, asked):
    import pyarrow as pa

    texts = [[f"a b c d{k}"] for k in range(30)]
    (row,) = counted_and_built([*texts, texts[0]], 1)
    own = {n: row[n] for n in ("shard", "hashes", "counts", "bits")}
    groups = [lm._grouped(iter([t[0].encode()])) for t in texts] + [lm._grouped(iter([b"never met"]))]
    questions = [{"shard": s, "key": k, "words": g.words.tobytes(), "pairs": lm._narrow(g.pairs, 5).tobytes()} for s in (0, 4) for k, g in enumerate(groups)]
    schema = pa.schema([("shard", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary()), ("bits", pa.binary()), ("key", pa.int64()), ("words", pa.binary()), ("pairs", pa.binary())])
    batches = pa.Table.from_pylist([own, *questions], schema=schema).to_batches(max_chunksize=20)
    probed, plain = [], lm.Filters._levels
    monkeypatch.setattr(lm, "ASKED", asked)
    monkeypatch.setattr(lm.Filters, "_levels", lambda self, hashes, shard: probed.append(len(hashes)) or plain(self, hashes, shard))
    rows = [r for b in lm._answer_pass(2)(iter(batches)) for r in b.to_pylist()]
    assert [(r["shard"], r["key"]) for r in rows] == [(q["shard"], q["key"]) for q in questions]
    for r, group in zip(rows, groups * 2):
        known = r["shard"] == 0 and r["key"] < 30
        # begin and end, a, b and c come in all 31 texts, the first text twice
        once = 2 if r["key"] == 0 else 1
        exact = np.frombuffer(r["exact"], np.uint16)
        unknown = [0] * (len(group.words) - 1) + [31 * (r["shard"] == 0)]
        assert sorted(exact) == ([0, once, *[31] * 4] if known else unknown)
        assert sorted(r["pair_near"]) == ([once] * 2 + [5] * 3 if known else [0] * len(group.pairs))
    if asked > 10_000:
        assert sum(probed) < 0.5 * sum(len(g.words) + len(g.pairs) for g in groups * 2)


def test_scores_of_many_groups_by_both_ways(frame, documents):
    """Groups of few texts, ids and texts that are null or come twice."""
    rows = [*documents[:200], (None, None), (None, "a b"), documents[0]]
    model = lm.fit_language_model(frame(documents[:150]), shard_chars=9_000)
    docs = frame(rows).repartition(9)
    one, other = (sorted(map(tuple, lm.score_texts(docs, model, broadcast_bytes=n).collect()), key=str) for n in (1 << 40, 0))
    assert model.shards > 5 and len(one) == len(other) == len(rows)
    assert all(a[0] == b[0] and close(a[1:], b[1:]) for a, b in zip(one, other))


def shuffled_bytes(spark):
    """Bytes of each shuffle's files that the session has."""
    files, found = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles(), collections.Counter()
    for i in range(files.size()):
        if files.apply(i).getName().startswith("shuffle_"):
            found[files.apply(i).getName().split("_")[1]] += files.apply(i).length()
    return found


@pytest.mark.parametrize("scored", [False, True])
def test_counts_and_questions_leave_no_shuffle_files(spark, sf_dir, scored):
    """Else the disk holds what was counted until all texts are scored."""
    docs, before = spark.read.parquet(os.path.join(sf_dir, "documents.parquet")), shuffled_bytes(spark)
    model = lm.fit_language_model(docs, shard_chars=100_000)
    if scored:
        lm.score_texts(docs, model, broadcast_bytes=0)
    for _ in range(50):
        left = max([n for k, n in shuffled_bytes(spark).items() if k not in before], default=0)
        if left < 10_000:
            break
        time.sleep(0.2)
    assert left < 10_000 and model.size > 100_000
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
