"""Registered queries of the text operators against their SQL, and the pipeline against its stages' rules."""

import hashlib

import compare
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from tallyriver.llm.queries import ORACLES, QUERIES


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())
    assert set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(name, spark, sf_dir, duck):
    mine = compare.spark_rows(QUERIES[name](spark, sf_dir))
    assert compare.difference(mine, compare.duck_rows(duck, ORACLES[name])) is None


def test_short_items_in_query_and_sql(spark, tmp_path):
    docs = [(1, "one two three four five six seven"), (2, "three four"), (3, "four three two one zero minus one"), (4, "Three, four!"), (5, "five"), (6, None)]
    items = [(10, "three four"), (11, "five"), (12, "six seven eight"), (13, "two three four five six"), (14, "minus"), (15, "")]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    name = "op7_benchmark_decontamination"
    mine = sorted(tuple(r) for r in QUERIES[name](spark, str(tmp_path)).collect())
    assert mine == sorted(con.sql(ORACLES[name]).fetchall())
    assert [(r[0], r[1]) for r in mine] == [(1, 10), (1, 11), (1, 13), (2, 10), (3, 14), (4, 10), (5, 11)]


def _brute_lines(docs):
    """Line dedup of {id: text} by plain dictionaries."""
    holders = {}
    for i, text in docs.items():
        for line in text.split("\n"):
            key = line.strip(" \t\n\v\f\r").translate({c: c + 32 for c in range(65, 91)})
            if len(key) >= 20:
                holders.setdefault(key, set()).add(i)
    hot = {k: max(v) for k, v in holders.items() if len(v) >= 3}

    def kept(i, line):
        key = line.strip(" \t\n\v\f\r").translate({c: c + 32 for c in range(65, 91)})
        return key not in hot or hot[key] == i

    return {i: "\n".join(x for x in t.split("\n") if kept(i, x)) for i, t in docs.items()}


def _shingles(words):
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def _brute_copies(docs):
    """Ids that are not the smallest of their component."""
    import collections

    sets = {i: _shingles(t.encode().lower().split()) for i, t in docs.items()}
    parent = {i: i for i in docs}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = collections.defaultdict(list)
    for i, s in sorted(sets.items()):
        shared = collections.Counter(j for g in s for j in holders[g])
        for j, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
        for g in s:
            holders[g].append(i)
    return {i for i in docs if find(i) != i}


def _normal(text):
    return ["".join(w) for w in "".join(c if c.isalnum() else " " for c in text.lower()).split()]


def test_pipeline_against_brute_force(spark, sf_dir):
    import public_tokenizers
    import tiktoken

    from tallyriver.llm.bpe import read_ranks

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    first = corpus_pipeline.quality_stage(spark, docs, sf_dir)
    assert first.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in first.collect()}
    bad = {r["doc_id"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 0").collect()}
    good = {r["doc_id"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1").collect()}
    gone = {r["doc_id"] for r in docs.select("doc_id").collect()} - set(texts)
    assert len(gone & bad) >= 0.7 * len(bad) and len(gone & good) <= 0.05 * len(good)

    texts = _brute_lines(texts)
    texts = {i: t for i, t in texts.items() if i not in _brute_copies(texts)}
    items = [_shingles(_normal(r["text"])) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaked = {i for i, t in texts.items() if any(100 * len(s & _shingles(_normal(t))) >= 80 * len(s) for s in items)}
    texts = {i: t for i, t in texts.items() if i not in leaked}
    ranks = {t: i for i, t in enumerate(read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))}
    codec = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    wanted = {}
    for i, t in texts.items():
        ids = codec.encode_ordinary(t)
        packed = b"".join(x.to_bytes(4, "little") for x in ids)
        wanted[i] = (len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(t.encode()).hexdigest())

    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows} == wanted
    assert len(rows) == len(wanted) < docs.count()


def test_stages_return_the_columns_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == 0


def test_rows_without_or_with_the_same_id(spark, tmp_path):
    """Copies, leaks and clean rows are told apart by row: null and repeated ids are treated like any other."""
    item = " ".join(f"q{i}" for i in range(20))
    text = [" ".join(f"w{k}x{i}" for i in range(30)) for k in range(4)]
    # so long that it is no near copy of the item
    leak = " ".join(f"b{i}" for i in range(30)) + f" {item} after"
    rows = [(1, text[0]), (None, text[0]), (2, text[1]), (2, leak), (None, item), (3, text[2]), (3, text[2]), (None, text[3])]
    docs = spark.createDataFrame([(i, t, "en", "web", len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    spark.createDataFrame([(7, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = corpus_pipeline.near_copy_stage(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in kept.collect()))) == sorted(
        map(str, [(1, text[0]), (2, text[1]), (2, leak), (None, item), (3, text[2]), (None, text[3])])
    )
    clean = corpus_pipeline.benchmark_stage(spark, kept, str(tmp_path))
    assert clean.columns == docs.columns
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in clean.collect()))) == sorted(
        map(str, [(1, text[0]), (2, text[1]), (3, text[2]), (None, text[3])])
    )
