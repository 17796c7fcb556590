"""Differences by fingerprints against exceptAll, and what they read."""

import datetime
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pitpanel.operators import differences as di
from pitpanel.sources.shared import scratch
from pitpanel.sources.store import Store

D0 = datetime.date(2020, 1, 1)
ROW = "permno long, date date, v double, s string"


def rows_of(seed, n=600):
    rng = random.Random(seed)
    pick = lambda x, p: None if rng.random() < p else x
    return [(pick(rng.randrange(30), 0.05), pick(D0 + datetime.timedelta(days=rng.randrange(200)), 0.05), rng.choice([None, 0.0, 1.5, float("nan")]), rng.choice(["x", "y", None])) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("buckets", [1, 7, 64])
def test_equals_except_all(spark, seed, buckets):
    rng = random.Random(seed)
    a = rows_of(seed)
    b = list(a)
    for _ in range(seed * 4):
        b[rng.randrange(len(b))] = rows_of(rng.randrange(1 << 30), 1)[0]
    b += [a[0]] * seed
    month = lambda df: df.withColumn("month", F.trunc("date", "MM"))
    left, right = (month(spark.createDataFrame(x, ROW)) for x in (a, b))
    got = di.table_diff(left, right.select("s", "v", "date", "permno", "month"), ["month"], ["permno"], buckets)
    key = lambda r: str((r["permno"], r["date"], r["v"], r["s"]))
    want = [Counter(map(key, x.exceptAll(y).collect())) for x, y in ((left, right), (right, left))]
    found = [Counter(), Counter()]
    for r in got.collect():
        found[r["side"] == "right"][key(r)] += abs(r["surplus"])
    assert found == want


def test_equal_tables_are_read_once_and_changed_ones_by_bucket(spark):
    df = spark.range(20_000).select((F.col("id") % 100).alias("permno"), F.expr("date_add(date'2020-01-01', cast(id % 300 as int))").alias("date"), F.col("id").cast("double").alias("v"))
    df = df.withColumn("month", F.month("date"))
    assert di.differing(df, df.repartition(3), ["month"], ["permno"]).collect() == []
    assert di.table_diff(df, df, ["month"], ["permno"]).collect() == []
    other = df.withColumn("v", F.when(F.col("v").isin(5.0, 77.0, 12345.0), -1.0).otherwise(F.col("v")))
    found = di.differing(df, other, ["month"], ["permno"]).collect()
    assert len(found) == 3 and all(r.n_left == r.n_right for r in found)
    assert sorted((r.v, r.surplus) for r in di.table_diff(df, other, ["month"], ["permno"]).collect()) == [(-1.0, -1)] * 3 + [(5.0, 1), (77.0, 1), (12345.0, 1)]
    lost = di.differing(df, df.where("month > 1 or permno > 0"), ["month"], ["permno"]).collect()
    assert {r.month for r in lost} == {1} and all(r.n_left > r.n_right for r in lost)


def test_stores_are_compared_by_their_ledgers(spark):
    df = spark.createDataFrame([(k, D0 + datetime.timedelta(days=d), 1.0, "x") for k in range(10) for d in range(0, 120, 10)], ROW)
    a, b = (Store(spark, scratch(spark, n), buckets=4) for n in "ab")
    a.write(df), b.write(df)
    assert di.store_diff(a, b, ROW).collect() == []
    b.write(df.withColumn("v", F.when((F.col("permno") == 3) & (F.col("date") == D0), 2.0).otherwise(F.col("v"))))
    out = di.store_diff(a, b, ROW)
    assert sorted((r.permno, r.v, r.side) for r in out.collect()) == [(3, 1.0, "left"), (3, 2.0, "right")]
    assert len(out.inputFiles()) == 2  # one part of each
