"""Where two tables differ: fingerprints from the top down, rows only where these disagree.

Both tables are summed once by group and bucket of keys. Groups whose sums agree are done;
rows are compared in the buckets that don't. For tables that lie in parts with a ledger the
sums are in the ledgers, and no file of an equal part is opened.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.store import Store
from ..sources.tables import fingerprint
from .normalize import bag_diff

#: Buckets of keys in each group.
BUCKETS = 64


def bucketed(df: DataFrame, group: Sequence[str], keys: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")) if keys else df.withColumn("_bucket", F.lit(0))


def levels(df: DataFrame, group: Sequence[str], keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Fingerprints by group and bucket (``n, xor, sum``)."""
    columns = sorted(df.columns)
    return fingerprint(bucketed(df, group, keys, buckets), [*group, "_bucket"], F.xxhash64(*columns))


def differing(a: DataFrame, b: DataFrame, group: Sequence[str], keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``group, _bucket, n_left, n_right`` of the buckets whose contents differ."""
    left, right = levels(a, group, keys, buckets), levels(b, group, keys, buckets)
    at = [*group, "_bucket"]
    marked = left.withColumn("side", F.lit(1)).unionByName(right.withColumn("side", F.lit(2)))
    one = lambda c, side: F.max(F.when(F.col("side") == side, F.col(c)))
    both = marked.groupBy(*at).agg(*(one(c, side).alias(f"{c}_{side}") for c in ("n", "xor", "sum") for side in (1, 2)))
    same = F.col("n_1").eqNullSafe(F.col("n_2")) & F.col("xor_1").eqNullSafe(F.col("xor_2")) & F.col("sum_1").eqNullSafe(F.col("sum_2"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    return both.where(~same).select(*at, zero("n_1").alias("n_left"), zero("n_2").alias("n_right"))


def table_diff(a: DataFrame, b: DataFrame, group: Sequence[str], keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """As ``bag_diff``: rows that one side has more often, how much more, and which side.

    The differing buckets are looked up first, groups x buckets rows at most on the driver;
    if there are none, no row is read a second time. A null group or key is one of its own.
    """
    at = [*group, "_bucket"]
    found = differing(a, b, group, keys, buckets).select(*at).collect()
    same = a.select(*a.columns).limit(0)
    if not found:
        return bag_diff(same, same)
    spark = a.sparkSession
    few = spark.createDataFrame(found, bucketed(same, group, keys, buckets).select(*at).schema).toDF(*(f"_at_{i}" for i in range(len(at))))
    own = lambda df: bucketed(df, group, keys, buckets)
    part = lambda df: own(df).join(F.broadcast(few), [F.col(c).eqNullSafe(F.col(f"_at_{i}")) for i, c in enumerate(at)], "left_semi").drop("_bucket")
    return bag_diff(part(a), part(b).select(*a.columns))


def store_diff(a: Store, b: Store, schema: str) -> DataFrame:
    """``bag_diff`` of two stores that are cut into the same parts, by their ledgers: only
    files of parts whose contents differ are read."""
    left, right = a.ledger()[1], b.ledger()[1]
    none = (0, 0, "0")
    content = lambda parts, k: parts[k].content if k in parts else none
    keys = [k for k in {*left, *right} if content(left, k) != content(right, k)]
    return bag_diff(a.read(schema, keys), b.read(schema, keys))
