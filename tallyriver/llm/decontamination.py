"""Search for test items inside documents: size-partitioned MinHash sketches, verified by exact containment.

Items are partitioned by the number of their shingles. The sketch of an item is its smallest shingle hashes, just more
of them than a document may miss, so a document that contains the item shares at least one: the search loses nothing.
Every partition keeps the largest hash of its sketches; a document's sketch is all its hashes up to the largest bound
of the partitions that it is long enough for, so long documents do not hide short items, and short ones skip the
partitions of long items. Documents that share a hash with an item are candidates; exact containment decides. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyriver.llm.text import SHINGLE_WORDS, renamed
from tallyriver.storage import broadcast_if_small, shared_folder


def normal_words(text: Column) -> Column:
    """Runs of letters and digits of any script, in lower case."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingle_hashes(words: Column, size: int = SHINGLE_WORDS) -> Column:
    """Distinct 64-bit hashes of all runs of ``size`` words; of the whole sequence if it is shorter."""
    width = F.least(F.size(words), F.lit(size))
    starts = F.when(width > 0, F.sequence(F.lit(1), F.size(words) - width + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, width))))


def run_hashes(words: Column, widths: list[int]) -> Column:
    """Distinct 64-bit hashes of all runs of each of ``widths`` words."""

    def runs(width: int) -> Column:
        last = F.size(words) - width + 1
        starts = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, width)))

    return F.array_distinct(F.concat(*[runs(w) for w in widths]))


def _words(rows: DataFrame) -> DataFrame:
    """``id`` and its words, made once for all that is hashed from them."""
    return rows.select("id", normal_words(F.col("text")).alias("words"))


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    percent: int = 80,
    size: int = SHINGLE_WORDS,
    short_items: bool = False,
) -> DataFrame:
    """Pairs of a document and an item of which it holds at least ``percent`` of the distinct shingles.

    Columns ``doc_id``, ``item_id``, ``n_shingles`` (of the item), ``n_shared`` and ``containment``. Shingles are runs
    of ``size`` words; words are runs of letters and digits, in lower case.

    Defined cases: texts and items that are null or without words are in no pair. An item with fewer words is one
    shingle, its whole sequence, which only a document of the same words has; with ``short_items`` every document has it
    that holds these words in a row. Rows that repeat an id are one document (or item) of all their shingles. Rows
    without an id are left out. An empty table gives an empty result; further columns are ignored.
    """
    spark = docs.sparkSession
    sources = renamed(docs, id=id_col, text=text_col).filter("id is not null and text is not null")
    sources = sources.withColumn("id", F.col("id").cast("bigint"))
    wanted = renamed(items, id=item_col, text=item_text_col).filter("id is not null and text is not null")
    worded = _words(wanted.withColumn("id", F.col("id").cast("bigint")))
    widths = []
    if short_items:
        # the widths below ``size`` that are an item's whole: documents are hashed in runs of these too
        short = worded.select(F.size("words").alias("width")).filter(F.col("width").between(1, size - 1)).distinct().collect()
        widths = [size, *sorted(r["width"] for r in short)]
    hashes = (run_hashes(F.col("words"), widths) if short_items else shingle_hashes(F.col("words"), size)).alias("hashes")
    tests = worded.select("id", shingle_hashes(F.col("words"), size).alias("hashes")).groupBy("id")
    tests = tests.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("hashes")))).alias("hashes"))
    tests = tests.withColumn("n", F.size("hashes")).filter("n > 0")
    path = shared_folder(spark, "items")
    # partitions by powers of two of the number of shingles
    tests.withColumn("part", F.floor(F.log2("n")).cast("int")).write.parquet(path)
    tests = spark.read.schema("id bigint, hashes array<bigint>, n int, part int").parquet(path)

    missed = F.floor(F.col("n") * (100 - percent) / 100).cast("int")
    sketches = tests.select("part", F.col("id").alias("item"), F.explode(F.slice("hashes", 1, missed + 1)).alias("hash"))
    # at most one row for each power of two
    bounds = sketches.groupBy("part").agg(F.max("hash").alias("bound")).collect()
    held = F.size("hashes") * 100
    none = F.lit(None).cast("bigint")
    limit = F.greatest(none, none, *[F.when(held >= 2 ** r["part"] * percent, F.lit(r["bound"])) for r in bounds])
    # explode() would have Spark repeat the hashing in a filter below it; explode_outer() does not
    hashed = _words(sources).select("id", hashes)
    low = hashed.select("id", limit.alias("limit"), F.explode_outer("hashes").alias("hash"))
    low = low.filter("hash <= limit").select("id", "hash")
    candidates = low.join(broadcast_if_small(sketches), "hash").select("id", "item").distinct()
    found = shared_folder(spark, "leak-candidates")
    candidates.write.parquet(found)
    candidates = spark.read.schema("id bigint, item bigint").parquet(found)

    suspects = candidates.select("id").distinct()
    suspected = sources.join(suspects, "id", "left_semi")
    hashed = _words(suspected).select("id", hashes)
    shingles = hashed.select("id", F.explode_outer("hashes").alias("hash")).distinct()
    parts = tests.select(F.col("id").alias("item"), "n", F.explode("hashes").alias("hash"))
    shared = shingles.join(broadcast_if_small(parts), "hash").groupBy("id", "item", "n").agg(F.count(F.lit(1)).alias("shared"))
    kept = shared.filter(F.col("shared") * 100 >= F.col("n") * percent)
    return kept.select(
        F.col("id").alias("doc_id"),
        F.col("item").alias("item_id"),
        F.col("n").cast("bigint").alias("n_shingles"),
        F.col("shared").alias("n_shared"),
        (F.col("shared") / F.col("n")).alias("containment"),
    )


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without those that hold an item; documents without an id stay."""
    leaked = find_leaks(docs, items, id_col=id_col, **options).select(F.col("doc_id").alias("leaked__")).distinct()
    return docs.join(leaked, docs[f"`{id_col}`"].cast("bigint") == F.col("leaked__"), "left_anti")
