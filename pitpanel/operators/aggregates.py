"""Counts, summaries and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import interval_join, match_by_key
from .normalize import bag_diff, conditional_counts


def status_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))


def universe_summary(universe: DataFrame) -> DataFrame:
    investable = F.when(F.col("is_investable"), F.col("permno"))
    return universe.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("permno").alias("entities"), F.count_distinct(investable).alias("investable_entities"))


def investable_by_date(universe: DataFrame) -> DataFrame:
    return universe.groupBy("date").agg(F.count_if("is_investable").alias("investable"), F.count(F.lit(1)).alias("rows")).orderBy("date")


CLASSES = ("share_type", "security_type", "security_subtype", "us_incorporated_flag", "issuer_type")


def classification_counts(history: DataFrame, columns: Sequence[str] = CLASSES) -> DataFrame:
    return history.groupBy(*columns).agg(F.count(F.lit(1)).alias("intervals"), F.count_distinct("permno").alias("entities"))


def classification_top(history: DataFrame, columns: Sequence[str] = CLASSES, n: int = 40) -> DataFrame:
    """The ``n`` combinations with most entities; ties by name, so the result is fixed."""
    return top_k(classification_counts(history, columns), [F.desc("entities"), F.desc("intervals"), *columns], n)


def exchange_status(history: DataFrame) -> DataFrame:
    return classification_counts(history, ("primary_exchange", "conditional_type", "trading_status_flag"))


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct tuples, those with nulls included."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(F.struct(*keys)).alias("distinct_keys"))


def terminal_totals(daily: DataFrame, events: DataFrame) -> DataFrame:
    """Terminal rows against the events of their entities over the whole period."""
    found = match_by_key(daily.where("delist_flag = 'Y'"), events)
    r = F.col("ret_total")
    return conditional_counts(
        found,
        {
            "no_event": ~F.col("has_event"), "date_mismatches": F.col("date_mismatch"), "value_mismatches": F.col("value_mismatch"), "missing_returns": r.isNull(),
            "numeric_with_warning": r.isNotNull() & ~F.col("ret_missing_flag").eqNullSafe(F.lit("NA")),
        },
    )


def terminal_entry_check(daily: DataFrame, history: DataFrame) -> DataFrame:
    """How many terminal rows an entry filter on attributes would let pass."""
    joined = interval_join(daily.where("delist_flag = 'Y'"), history)
    passes = F.col("primary_exchange").isin("N", "A", "Q") & (F.col("trading_status_flag") == "A")
    return conditional_counts(joined, {"with_metadata": F.col("_key").isNotNull(), "pass_entry_filter": passes})


def sorted_output(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows in the order of ``keys``, by ranges: no task sorts more than its range."""
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def top_k(df: DataFrame, order: Sequence[str | Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def union_aligned(a: DataFrame, b: DataFrame) -> DataFrame:
    """All rows of both; columns by name, absent ones null."""
    return a.unionByName(b, allowMissingColumns=True)


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)


def bag_equal(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: surplus rows of each side, and whether the bags are equal."""
    extra = bag_diff(a, b).agg(
        F.coalesce(F.sum(F.when(F.col("side") == "left", F.col("surplus"))), F.lit(0)).cast("bigint").alias("only_left"),
        F.coalesce(F.sum(F.when(F.col("side") == "right", -F.col("surplus"))), F.lit(0)).cast("bigint").alias("only_right"),
    )
    return extra.withColumn("equal", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def distinct_dates(df: DataFrame, column: str = "date") -> DataFrame:
    return df.select(column).distinct()


def named_counts(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """``label, value`` rows, from one pass."""
    counts = df.agg(*(F.count_if(p).alias(n) for n, p in predicates.items()))
    pairs = F.array(*(F.struct(F.lit(n).alias("label"), F.col(n).alias("value")) for n in predicates))
    return counts.select(F.explode(pairs).alias("p")).select("p.label", "p.value")


def predicate_flags(df: DataFrame) -> DataFrame:
    """Range, membership and null-safe predicates, their nulls kept."""
    flag, dist = F.col("delist_flag"), F.col("distribution_return_flag")
    return df.select(
        "permno", "date", F.col("ret_total").between(-0.01, 0.01).alias("small_move"), dist.isin("C1", "S1").alias("is_distribution"),
        (~dist.isin("NO", "NA")).alias("not_plain"), (~flag.eqNullSafe(F.lit("N"))).alias("differs_from_n"),
        ((flag == "Y") | ~dist.isin("NO", "NA") | dist.isNull()).alias("terms_incomplete"),
    )
