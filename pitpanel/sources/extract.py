"""Bounded extracts of a source and their gate. A source is any DataFrame: Parquet, JDBC or
other; the ranges are plain comparisons that Spark pushes into the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ContractError


def day(value: str):
    return F.lit(value).cast("date")


def source_coverage(df: DataFrame, date: str = "date") -> DataFrame:
    return df.agg(F.min(date).alias("min_date"), F.max(date).alias("max_date"), F.count(F.lit(1)).alias("rows"))


def clip(df: DataFrame, start: str, end: str, date: str = "date") -> tuple[str, str]:
    """The part of a requested range that the source covers; none raises."""
    found = source_coverage(df, date).first()
    lo, hi = max(start, str(found["min_date"])), min(end, str(found["max_date"]))
    if found["rows"] == 0 or lo > hi:
        raise ContractError(f"the source has nothing between {start} and {end}")
    return lo, hi


def extract_months(df: DataFrame, start: str, end: str, columns: Sequence[str] | None = None, date: str = "date") -> DataFrame:
    """Rows from ``start`` to ``end``, as half-open bounds, with their year and month."""
    out = df.where((F.col(date) >= day(start)) & (F.col(date) < F.date_add(day(end), 1)))
    out = out if columns is None else out.select(*columns)
    return out.withColumns({"year": F.year(date).cast("bigint"), "month": F.month(date).cast("bigint")})


def extract_overlapping(df: DataFrame, start: str, end: str, frm: str = "valid_from", to: str = "valid_to") -> DataFrame:
    """Intervals that touch a range; a null end is open."""
    return df.where((F.col(frm) <= day(end)) & (F.coalesce(F.col(to), F.expr("date '9999-12-31'")) >= day(start)))


def extract_between(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    return df.where(F.col(column).between(day(start), day(end)))


def gate_extract(df: DataFrame, keys: Sequence[str], date: str, start: str, end: str) -> DataFrame:
    """One row of defects: null keys, rows with a key that occurs before, unreadable dates and
    dates out of range; ``accepted`` if there are rows and no defects."""
    read = F.col(date).cast("string").try_cast("date")
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    out = df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(null_key).alias("null_keys"), (F.count(F.lit(1)) - F.count_distinct(F.struct(*keys))).alias("surplus_keys"),
        F.count_if(F.col(date).isNotNull() & read.isNull()).alias("invalid_dates"), F.count_if((read < day(start)) | (read > day(end))).alias("out_of_range"),
    )
    clean = (F.col("null_keys") == 0) & (F.col("surplus_keys") == 0) & (F.col("invalid_dates") == 0) & (F.col("out_of_range") == 0)
    return out.withColumn("accepted", (F.col("rows") > 0) & clean)
