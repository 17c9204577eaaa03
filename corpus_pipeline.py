"""From raw documents to training tokens: each stage works on all that the one before has kept.

All stages but the last return the columns of ``documents``. Near copies and leaks are told apart by row, so rows
without an id, or that repeat one, are treated like any other. In the line stage a row without an id is not counted and
keeps its lines, and rows that repeat an id are one document.
"""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyriver.llm import bpe
from tallyriver.llm.decontamination import without_leaks
from tallyriver.llm.jaccard import jaccard_components
from tallyriver.llm.lines import dedup_lines
from tallyriver.llm.quality import fit_quality, with_quality
from tallyriver.storage import shared_folder

QUALITY_THRESHOLD = 0.3
KEY = "row_key__"

#: SQL cannot express the classifier; the tests hold the stages against brute force.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = fit_quality(docs, _table(spark, sf_dir, "labels"))
    scored = with_quality(docs, model, score_col="quality__")
    return scored.filter(F.col("quality__") >= QUALITY_THRESHOLD).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that others share; ``n_chars`` follows the text."""
    kept = dedup_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def _keyed(spark: SparkSession, docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a key for every row, written so that a row keeps it."""
    path = shared_folder(spark, name)
    keyed = docs.withColumn(KEY, F.monotonically_increasing_id())
    keyed.write.parquet(path)
    return spark.read.schema(keyed.schema).parquet(path)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of every group of near copies; one without an id only if none has one."""
    keyed = _keyed(spark, docs, "keyed-copies")
    ids = keyed.select(F.col(KEY).alias("key__"), F.col("doc_id").alias("id__"))
    members = jaccard_components(keyed, id_col=KEY).select(F.col("doc_id").alias("key__"), "component_id").join(ids, "key__")
    order = F.struct(F.col("id__").isNull(), "id__", "key__")
    first = members.groupBy("component_id").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
    others = members.join(first.filter("n > 1"), "component_id").filter("key__ <> first.key__").select(F.col("key__").alias(KEY))
    return keyed.join(others, KEY, "left_anti").select(*docs.columns)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, however short it is."""
    keyed = _keyed(spark, docs, "keyed-leaks")
    return without_leaks(keyed, _table(spark, sf_dir, "benchmark"), id_col=KEY, short_items=True).select(*docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's tokens, encoded and decoded again, as digests."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.digests(bpe.encode(docs, path, pattern, decoded=True))


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_copy_stage),
    ("benchmark decontamination", benchmark_stage),
    ("byte-level BPE", token_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, name.replace(" ", "-"))
        kept = stage(spark, docs, sf_dir)
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
