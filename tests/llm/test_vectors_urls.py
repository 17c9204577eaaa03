"""Nearest neighbours: exactness of what is found, recall, hot leaves. URLs: rules by hand, models, edges."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyriver.llm import neighbours, urls
from tallyriver.llm.queries import QUERIES, URL_RULES


def _exact(ids, rows, query, own, k=5):
    keep = ids != own
    scores = neighbours.cosines(rows[keep], query)
    order = np.lexsort((ids[keep], -scores))[:k]
    return [(int(i), float(s)) for i, s in zip(ids[keep][order], scores[order])]


def _found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def test_recall_and_scores_on_the_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    ids, data = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64)
    found = _found(QUERIES["op9_nearest_neighbours"](spark, sf_dir))
    assert set(found) == {int(i) for i in ids if i % 50 == 0}
    hits = 0
    for q, near in found.items():
        wanted = _exact(ids, data, data[ids == q][0], q)
        hits += len({i for i, _ in near} & {i for i, _ in wanted})
        for i, score in near:
            assert score == neighbours.cosines(data[ids == i], data[ids == q][0])[0]
    assert hits >= 0.9 * 5 * len(found)


def test_recall_of_a_deeper_forest(spark):
    random = np.random.default_rng(8)
    data = random.standard_normal((3000, 24))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id bigint, embedding array<double>")
    index = neighbours.build_index(frame.repartition(4))
    found = _found(neighbours.search(index, frame.filter("vec_id % 50 = 0")))
    ids = np.arange(3000)
    hits = sum(len({i for i, _ in near} & {i for i, _ in _exact(ids, data, data[q], q)}) for q, near in found.items())
    assert len(found) == 60 and hits >= 0.9 * 300


def test_a_third_of_equal_vectors_is_cut_into_blocks(spark):
    random = np.random.default_rng(9)
    data = random.standard_normal((300, 8))
    data[::3] = data[0]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id bigint, embedding array<double>")
    index = neighbours.build_index(frame.repartition(3), block_rows=10)
    assert index.blocks.max() >= 10
    near = _found(neighbours.search(index, frame.filter("vec_id = 150"), probed=1.0))[150]
    assert near == _exact(np.arange(300), data, data[150], 150) and [i for i, _ in near] == [0, 3, 6, 9, 12]


def test_vector_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], "x"), (1, [0.0, 0.0], "x"), (2, None, "x"), (3, [1.0, None], "x"), (4, [nan, 1.0], "x"),
        (5, [inf, 1.0], "x"), (6, [1.0, 1.0, 1.0], "x"), (None, [1.0, 0.5], "x"), (7, [2.0, 0.0], "x"), (8, [-1.0, 0.0], "x"),
        (8, [0.0, 1.0], "x"), (9, [], "x"),
    ]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, id string")
    index = neighbours.build_index(frame)
    found = _found(neighbours.search(index, frame))
    assert set(found) == {0, 7, 8}
    assert found[0] == [(7, 1.0), (8, 0.0)] and found[8] == [(0, 0.0), (7, 0.0)]
    empty = frame.limit(0)
    assert neighbours.search(neighbours.build_index(empty), empty).count() == 0
    assert neighbours.search(index, empty).count() == 0


def _by_hand(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = rest[:end].translate({c: c + 32 for c in range(65, 91)})
        path = rest[end:]
        path = path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    rule = max(fits, key=lambda r: len(r.host + r.path), default=None)
    return host, path, rule and rule.host + rule.path, rule and rule.verdict


EDGES = [
    None, "", "no scheme", "http://", "http://ORG/", "https://a.B.org", "https://a.org/x", "http://xorg/x", "ftp://com/de/?q#f",
    "http://example.org/en/1", "http://www.example.org/en/2", "http://x.example.org/es/#a", "http://u?x://org/", "a://b\nc.org/\nd",
    "http://com/fr/" + "x" * 30_000, "http://é.com/de/ß",
]


def test_rules_by_hand(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = [(r["page_id"], r["url"], "x") for r in pages.collect()]
    rows += [(10_000_000 + i // 2, u, "x") for i, u in enumerate([*EDGES, *EDGES])] + [(None, EDGES[6], "x")]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, host string").repartition(3)
    out = urls.filter_urls(frame, URL_RULES).collect()
    mine = sorted(((r["page_id"], r["host"], r["path"], r["rule"]) for r in out), key=str)
    assert mine == sorted(((i, *_by_hand(u)[:3]) for i, u, _ in rows), key=str)
    verdicts = {(r.host + r.path): r.verdict for r in URL_RULES}
    assert all(r["verdict"] == verdicts[r["rule"]] if r["rule"] else r["verdict"] in ("allow", "block") for r in out)
    assert all(math.isfinite(r["score"]) for r in out)


def test_models_tell_kinds_apart(spark):
    rules = [urls.Rule("allow", "good.test", "/"), urls.Rule("block", "bad.test", "/")]
    rows = [(i, f"http://{'good' if i % 2 else 'bad'}.test/{'garden' if i % 2 else 'casino'}/{i}") for i in range(200)]
    rows += [(1000, "http://other.net/casino/7"), (1001, "http://other.net/garden/7")]
    frame = spark.createDataFrame(rows, "page_id bigint, url string")
    out = {r["page_id"]: r for r in urls.filter_urls(frame, rules).collect()}
    assert out[1000]["verdict"] == "block" and out[1001]["verdict"] == "allow" and out[1000]["rule"] is None


def test_ratios_of_scaled_counts_are_probabilities(spark):
    rows = [("^^^a", 3, 1), ("^^ab", 2, 0), ("^^ac", 1, 1), ("^abc", 0, 0), ("abc$", 0, 2)]
    counted = spark.createDataFrame(rows, "gram string, good bigint, bad bigint")
    ratios = {r["gram"]: r["ratio"] for r in urls.ratio_table(counted).collect()}
    assert set(ratios) == {r[0] for r in rows}
    assert ratios["^^ab"] < 0 < ratios["abc$"]
    none = spark.createDataFrame([("^^^a", 3, 0)], "gram string, good bigint, bad bigint")
    assert [r["ratio"] for r in urls.ratio_table(none).collect()] == [0.0]


def test_without_labels_all_is_allowed(spark):
    frame = spark.createDataFrame([(1, "http://x.test/a"), (2, None)], "page_id bigint, url string")
    assert {(r["score"], r["verdict"]) for r in urls.filter_urls(frame, []).collect()} == {(0.0, "allow")}
    assert urls.filter_urls(frame.limit(0), URL_RULES).count() == 0


@pytest.mark.parametrize("name", ["op1_secret_scan", "op3_url_filter", "op7_benchmark_decontamination"])
def test_native_operators_run_no_python(name, spark, sf_dir):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapIn" not in plan


def test_models_read_digits_scripts_and_queries(spark):
    rules = [
        urls.Rule("allow", "a.test", "/"), urls.Rule("block", "a.test", "/en/1"),
        urls.Rule("allow", "b.test", "/"), urls.Rule("block", "b.test", "/ж"),
        urls.Rule("allow", "good.test", "/"), urls.Rule("block", "bad.test", "/"),
    ]
    rows = [f"http://a.test/en/{1 + i % 2}{i:03}" for i in range(100)]
    rows += [f"http://b.test/{'жω'[i % 2] * 3}/{i:03}" for i in range(100)]
    rows += [f"http://{('good', 'bad')[i % 2]}.test/x?{('from=mail', 'ref=spam')[i % 2]}&n={i:03}" for i in range(100)]
    pairs = [
        ("http://o.net/en/1777", "http://o.net/en/2777"), ("http://o.net/жжж/7", "http://o.net/ωωω/7"),
        ("http://o.net/x?ref=spam", "http://o.net/x?from=mail"),
    ]
    rows += [u for pair in pairs for u in pair]
    frame = spark.createDataFrame(list(enumerate(rows)), "page_id bigint, url string")
    out = [r["score"] for r in sorted(urls.filter_urls(frame, rules).collect(), key=lambda r: r["page_id"])]
    for bad, good in pairs:
        assert out[rows.index(bad)] > out[rows.index(good)]


def test_grams_are_whole_code_points_and_marks_are_escaped(spark):
    frame = spark.createDataFrame([("😀\x02é",), (None,)], "url string")
    found = {r["gram"] for r in urls._grams(frame).collect()}
    d, s = urls.DEPTH, urls.START
    spelled = s * d + "😀" + urls.ESCAPE + "b" + "é" + urls.END
    assert found == {spelled[i : i + d + 1] for i in range(len(spelled) - d)} | {s * d + urls.END}


def test_an_id_repeated_over_k_times_takes_one_place(spark):
    random = np.random.default_rng(10)
    data = random.standard_normal((40, 6))
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    # the nearest id many times: the same row again, and rows that differ a little
    rows += [(100, (data[3] * 1.5).tolist())] * 12 + [(101, (data[3] + 1e-3 * random.standard_normal(6)).tolist()) for _ in range(30)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    scores = {}
    for i, s in zip(ids, neighbours.cosines(vectors, data[3])):
        scores[int(i)] = max(float(s), scores.get(int(i), -2.0))
    del scores[3]
    wanted = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:5]
    for block_rows in (10, 20_000):
        index = neighbours.build_index(frame, block_rows=block_rows)
        assert _found(neighbours.search(index, frame.filter("vec_id = 3"), probed=1.0))[3] == wanted


def test_vectors_of_one_id_are_dealt_to_many_blocks(spark):
    random = np.random.default_rng(11)
    rows = [(7, v.tolist()) for v in random.standard_normal((300, 6))] + [(8, [1.0] * 6)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    index = neighbours.build_index(frame, block_rows=20)
    near = _found(neighbours.search(index, frame.filter("vec_id = 8"), probed=1.0))[8]
    assert [i for i, _ in near] == [7]
    sizes = [r["count"] for r in neighbours.dealt_rows(spark, index).groupBy("leaf", "block").count().collect()]
    assert index.blocks.max() > 1 and max(sizes) < 3 * 20


def test_huge_and_tiny_vectors(spark):
    """Components whose squares would not be finite, or vanish."""
    rows = [(0, [1e200, 0.0]), (1, [3.0, 0.0]), (2, [1e-200, 1e-200]), (3, [0.0, 5e-324]), (4, [-1e308, 1e308])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = neighbours.search(neighbours.build_index(table), table.filter("vec_id in (0, 2)")).collect()
    got = {(r["query_id"], r["rank"]): (r["vec_id"], round(r["score"], 12)) for r in found}
    half = round(0.5**0.5, 12)
    assert got == {
        (0, 1): (1, 1.0), (0, 2): (2, half), (0, 3): (3, 0.0), (0, 4): (4, -half),
        (2, 1): (0, half), (2, 2): (1, half), (2, 3): (3, half), (2, 4): (4, 0.0),
    }


def test_scaling_by_powers_of_two_changes_no_score():
    rng = np.random.default_rng(8)
    rows, query = rng.standard_normal((500, 24)), rng.standard_normal(24)
    plain = (rows * query).sum(axis=1) / (np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((query * query).sum()))
    assert np.array_equal(neighbours.cosines(rows, query), plain)


def _plain_scores(rows, verdict_of):
    """Scores and verdicts of (id, url) rows by the model's definition, in dictionaries: one n-gram after the other."""
    depth = urls.DEPTH
    spelled = [urls.START * depth + (u or "") + urls.END for _, u in rows]
    places = [_by_hand(u)[:2] for _, u in rows]
    known = [verdict_of(*place) for place in places]
    held = [zlib.crc32("".join(place).encode()) % urls.HELD_OUT_FOLDS == 0 for place in places]

    def grams(text):
        return [text[i : i + depth + 1] for i in range(len(text) - depth)]

    seen = {"allow": Counter(), "block": Counter()}
    letters = set()
    for text, verdict, out in zip(spelled, known, held):
        for gram in grams(text):
            letters.add(gram[-1])
            if verdict and not out:
                for n in range(depth + 1):
                    seen[verdict][gram[depth - n :]] += 1
    totals = {v: sum(c for g, c in seen[v].items() if len(g) == 1) for v in seen}
    weight = {v: sum(totals.values()) / (2 * totals[v]) for v in seen}
    after = defaultdict(set)
    for counts in seen.values():
        for gram in counts:
            after[gram[:-1]].add(gram)

    def probability(verdict, gram):
        shorter = probability(verdict, gram[1:]) if len(gram) > 1 else 1 / len(letters)
        kinds = after.get(gram[:-1], ())
        if not kinds:
            return shorter
        all_ = sum(seen[verdict][g] for g in kinds) * weight[verdict]
        return (seen[verdict][gram] * weight[verdict] + len(kinds) * shorter) / (all_ + len(kinds))

    ratio = {g: math.log(probability("block", g) / probability("allow", g)) for t in spelled for g in grams(t)}
    scores = [sum(ratio[g] for g in grams(t)) / len(grams(t)) for t in spelled]
    judged = [(s, k) for s, k, out in zip(scores, known, held) if k and out]

    def loss(border):
        def share(verdict, wrong):
            cells = [max(-urls.BINS, min(urls.BINS, math.floor(s / urls.BIN))) for s, k in judged if k == verdict]
            return sum(wrong(c) for c in cells) / len(cells)

        return share("allow", lambda c: c >= border) + share("block", lambda c: c < border)

    threshold = 0.0
    # without unseen urls of both kinds there is nothing to calibrate on
    if {k for _, k in judged} == {"allow", "block"}:
        threshold = min(range(-urls.BINS, urls.BINS + 1), key=lambda b: (loss(b), abs(b), b)) * urls.BIN
    return [(s, k or ("block" if s > threshold else "allow")) for s, k in zip(scores, known)]


def _against_plain(spark, rows, rules):
    def verdict_of(host, path):
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return max(fits, key=lambda r: len(r.host + r.path)).verdict if fits else None

    wanted = sorted(((n, v, s) for (n, _), (s, v) in zip(rows, _plain_scores(rows, verdict_of))))
    frame = spark.createDataFrame(rows, "page_id bigint, url string").repartition(3)
    got = sorted((r["page_id"], r["verdict"], r["score"]) for r in urls.filter_urls(frame, rules).collect())
    assert [g[:2] for g in got] == [w[:2] for w in wanted]
    assert all(abs(g[2] - w[2]) < 1e-9 for g, w in zip(got, wanted))


def test_scores_and_verdicts_of_all_pages_against_a_plain_scorer(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").collect()
    _against_plain(spark, [tuple(r) for r in pages], URL_RULES)


def test_scores_of_repeated_null_and_foreign_urls_against_a_plain_scorer(spark):
    rules = [urls.Rule("allow", "good.test", "/"), urls.Rule("block", "bad.test", "/")]
    texts = [f"http://good.test/news/{n}" for n in range(25)] + [f"http://bad.test/win/{n}?cash" for n in range(15)]
    texts += [None, "", "no scheme", "ftp://other.test/news", "http://other.test/win/é😀"] + texts[:3] * 4
    _against_plain(spark, list(enumerate(texts)), rules)
