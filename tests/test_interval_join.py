"""The interval join by time buckets against brute force and SQL, and its behaviour on a hot key."""

import datetime
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pitpanel.operators import joins as jo

D0 = datetime.date(2000, 1, 1)


def day(n):
    return None if n is None else D0 + datetime.timedelta(days=n)


def plain(rows, hist, open_end, how):
    out = Counter()
    for k, d, i in rows:
        held = [h for h in hist if k is not None and d is not None and h[0] == k and h[1] is not None and h[1] <= d and ((h[2] is None and open_end) or (h[2] is not None and d <= h[2]))]
        for h in held:
            out[k, d, i, h[1], h[2], h[3]] += 1
        if not held and how == "left":
            out[k, d, i, None, None, None] += 1
    return out


@pytest.mark.parametrize("many", [1, 8, 10_000])
@pytest.mark.parametrize("open_end, how", [(True, "left"), (False, "left"), (True, "inner")])
def test_equals_brute_force(spark, many, open_end, how):
    rng = random.Random(many)
    hist = []
    for i in range(400):
        a = rng.randrange(900) if rng.random() < 0.97 else None
        length = rng.choice([0, 1, 3, 30, 400, -2, None])
        far = datetime.date(9999, 12, 31) if rng.random() < 0.03 else None
        hist.append((rng.choice([None, 1, 1, 1, 2, 3, 4]), day(a), far or (None if length is None or a is None else day(a + length)), f"h{i}"))
    rows = [(rng.choice([None, 1, 1, 2, 3, 5]), day(rng.randrange(-100, 1200)) if rng.random() < 0.97 else None, i) for i in range(900)]
    df = spark.createDataFrame(rows, "permno int, date date, i int")
    h = spark.createDataFrame(hist, "permno int, valid_from date, valid_to date, name string")
    got = jo.interval_join(df, h, open_end=open_end, how=how, many=many)
    assert Counter(tuple(r) for r in got.select("permno", "date", "i", "valid_from", "valid_to", "name").collect()) == plain(rows, hist, open_end, how)


def test_no_intervals_and_no_rows(spark):
    df = spark.createDataFrame([(1, D0)], "permno int, date date")
    h = spark.createDataFrame([], "permno int, valid_from date, valid_to date, name string")
    assert [tuple(r) for r in jo.interval_join(df, h).select("permno", "name", "_key").collect()] == [(1, None, None)]
    assert jo.interval_join(df.limit(0), h).collect() == []


def test_timestamps_within_a_day(spark):
    df = spark.sql("select 1 as permno, timestamp'2000-01-03 12:00:00' as date union all select 1, timestamp'2000-01-02 00:00:00'")
    h = spark.createDataFrame([(1, day(0), day(2), f"a{i}") for i in range(3)], "permno int, valid_from date, valid_to date, name string")
    counts = {str(r.date): r.n for r in jo.interval_join(df, h, how="inner", many=1).groupBy("date").agg(F.count("name").alias("n")).collect()}
    assert counts == {"2000-01-02 00:00:00": 3}


def test_hot_key(spark):
    """100,000 intervals and a million rows of one key: by the key alone 10^11 comparisons."""
    hist = spark.range(100_000).select(
        F.lit(1).alias("permno"), F.expr("date_add(date'1900-01-01', cast(id * 7919 % 40000 as int))").alias("valid_from"), F.col("id").alias("name")
    ).withColumn("valid_to", F.expr("date_add(valid_from, cast(name % 3 as int))"))
    hist = hist.unionByName(spark.sql("select 1 as permno, date'1950-01-01' as valid_from, cast(-1 as bigint) as name, cast(null as date) as valid_to"))
    rows = spark.range(0, 1_000_000, 1, 16).select(F.lit(1).alias("permno"), F.expr("date_add(date'1890-01-01', cast(id % 50000 as int))").alias("date"), "id")
    began = time.time()
    got = jo.interval_join(rows, hist).agg(F.count(F.lit(1)), F.count("name"), F.sum("name")).first()
    assert time.time() - began < 60
    # each date is expanded on its own for the expected numbers
    held = hist.where("name >= 0").select(F.explode(F.sequence("valid_from", "valid_to")).alias("date"), "name").groupBy("date").agg(F.count("name").alias("n"), F.sum("name").alias("s"))
    want = rows.join(held, "date", "left").selectExpr("coalesce(n, 0) + int(date >= date'1950-01-01') as n", "coalesce(s, 0) - int(date >= date'1950-01-01') as s")
    assert tuple(got) == tuple(want.agg(F.sum(F.greatest("n", F.lit(1))), F.sum("n"), F.sum("s")).first())


def test_plan_has_no_nested_loop_and_bounds_what_it_broadcasts(spark):
    df = spark.range(200_000).select((F.col("id") % 1000).alias("permno"), F.expr("date_add(date'2000-01-01', cast(id as int))").alias("date"))
    h = df.select("permno", F.col("date").alias("valid_from"), F.date_add("date", F.col("permno").cast("int")).alias("valid_to"))
    plan = jo.interval_join(df, h)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and f"TakeOrderedAndProject(limit={jo.KEYS}" in plan
