"""Totals of an interval join without its pairs, against the join itself and on a hot key."""

import datetime
import random
import time

import pytest
from pyspark.sql import functions as F

from pitpanel.operators import joins as jo
from pitpanel.queries import QUERIES

D0 = datetime.date(2000, 1, 1)


def day(n):
    return None if n is None else D0 + datetime.timedelta(days=n)


@pytest.mark.parametrize("open_end", [True, False])
def test_equals_the_join(spark, open_end):
    rng = random.Random(open_end)
    hist = []
    for _ in range(400):
        a = rng.randrange(300) if rng.random() < 0.97 else None
        length = rng.choice([0, 1, 3, 30, -2, None])
        till = datetime.date(9999, 12, 31) if rng.random() < 0.03 else None if length is None or a is None else day(a + length)
        hist.append((rng.choice([None, 1, 1, 2, 3, 4]), day(a), till, rng.choice([None, -5, 0, 7, 2**62])))
    rows = [(rng.choice([None, 1, 1, 2, 3, 5]), day(rng.randrange(-50, 400)) if rng.random() < 0.97 else None) for _ in range(900)]
    df = spark.createDataFrame(rows, "permno int, date date")
    h = spark.createDataFrame(hist, "permno int, valid_from date, valid_to date, v long")
    got = jo.interval_totals(df, h, "v", open_end=open_end)
    pairs = jo.interval_join(df, h, open_end=open_end).groupBy("permno", "date").agg(
        F.count(F.lit(1)).alias("pairs"), F.count("_key").alias("held"), F.count("v").alias("valued"), F.sum(F.col("v").cast("decimal(20,0)")).alias("total")
    )
    of_all = got.select("permno", "date", F.expr("rows * greatest(intervals, 1)"), F.expr("rows * intervals"), F.expr("rows * valued"), F.expr("rows * total"))
    plain = lambda d: sorted((tuple(str(v) for v in r) for r in d.collect()))
    assert plain(of_all) == plain(pairs)


def test_many_hold_each_row(spark):
    """200,000 intervals of one key that hold each of 200,000 rows: 4 x 10^10 pairs."""
    hist = spark.range(0, 200_000, 1, 8).select(F.lit(1).alias("permno"), F.expr("date_add(date'2000-01-01', cast(id % 100 as int))").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), F.col("id").alias("v"))
    rows = spark.range(0, 200_000, 1, 8).select(F.lit(1).alias("permno"), F.expr("date_add(date'2001-01-01', cast(id % 100 as int))").alias("date"))
    began = time.time()
    got = jo.interval_totals(rows, hist, "v").agg(F.sum("rows"), F.min("intervals"), F.max("valued"), F.max("total")).first()
    assert tuple(map(int, got)) == (200_000, 200_000, 200_000, 199_999 * 100_000) and time.time() - began < 60


def test_busy_keys_makes_no_pairs(spark):
    """The query's plan orders days of a key; it joins rows to no interval."""
    sf = "/root/testdata/sf0.001"
    plan = QUERIES["j1_busy_keys"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 3 and "_width" not in plan  # one makes the visits, two the starts and ends of spells
