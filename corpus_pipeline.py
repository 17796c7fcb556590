"""Corpus pipeline: quality selection, line dedup, near-dedup, decontamination, mixing.

``STAGES`` lists the stages in order. Each takes (spark, docs, sf_dir), works on all rows
that its predecessor kept, and returns a frame that is written as Parquet and read again
as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.llm import decontam, linededup, mixing, quality, simhash
from pitpanel.llm.common import fresh, row_key, stored, table

#: Words of a test item that documents are removed for, at least: a word or two that occur
#: in any text are no leak. ``decontam.short_items`` lists the items below it.
SHORTEST = 5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality sample holds, as they are."""
    return quality.select(docs, table(spark, sf_dir, "labels")).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without boilerplate lines. Only a document of nothing else
    stays whole, as a copy that near-dedup judges."""
    return linededup.without_boilerplate(docs, keep_whole=True).select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row: the one with the smallest id, rows without
    an id last, then the one with the smallest content key. Groups are those of the texts,
    so a repeated or null id neither joins two groups nor keeps a second row of one."""
    key, name, n = fresh(docs, "row_key", "kept_key", "rows")
    kept = stored(simhash.survivors(docs).select(F.col("row_key").alias(name), F.col("n").alias(n)), "kept-keys")
    keyed = docs.withColumn(key, row_key())
    same = F.col(key) == F.col(name)
    # the kept keys grow with the corpus, so they are never broadcast, however small they are
    out = keyed.join(kept.where(F.col(n) == 1).hint("merge"), same, "left_semi")
    several = kept.where(F.col(n) > 1)
    if not several.isEmpty():
        # only repeated rows come here; each task leaves the least of them before they are
        # shuffled, so that it doesn't depend on their order which one stays
        least = keyed.join(several.hint("merge"), same, "left_semi").groupBy(key).agg(F.min(F.struct(*docs.columns)).alias(n))
        out = out.unionByName(least.select(key, f"{n}.*"))
    return out.drop(key)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no test item of SHORTEST words or more."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"), least=SHORTEST)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with how many of their words it takes."""
    return mixing.take(docs)


STAGES = [
    ("quality", quality_stage),
    ("line dedup", line_stage),
    ("near-dedup", near_stage),
    ("decontamination", benchmark_stage),
    ("mixing", mixing_stage),
]

#: The quality and near-dedup stages use hashes and models that SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the stages, in order, make of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, "stage-" + name.replace(" ", "-"))
    return docs
