"""Series in segments against the windows over whole entities."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from pitpanel.operators import factors, index, segments

D0 = datetime.date(2020, 1, 1)
SCHEMA = "permno int, date date, session_index long, price_raw double, ret_total double, ret_total_backtest double, ret_total_for_signal double, delist_flag string"


def panel_rows(seed, entities=12, sessions=60):
    rng = random.Random(seed)
    rows = []
    for k in range(entities):
        skip = rng.random() * 0.2
        for s in range(rng.randrange(20), sessions):
            if rng.random() < skip * (k % 3):
                continue
            r = rng.choice([None, -1.0, -0.5] + [0.01, 0.02, -0.03] * 15) if k % 2 else rng.uniform(-0.1, 0.1)
            flag = rng.choice(["N"] * 60 + ["Y", None])
            price = rng.choice([None, 0.0, float("nan"), 5.0, 5.0, 5.0]) if s < 30 else 5.0
            rows.append((k, D0 + datetime.timedelta(days=s), s, price, r, r, None if flag == "Y" else r, flag))
    return rows


def rounded(df, *columns):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else str(v) for v in r) for r in df.select("permno", "session_index", *columns).collect()), key=str)


@pytest.fixture(scope="module")
def panel(spark):
    return spark.createDataFrame(panel_rows(1) + [(99, D0, 5, 1.0, 0.1, 0.1, 0.1, "N")], SCHEMA).repartition(5).cache()


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_equal_to_windows(panel, size):
    pairs = [
        (factors.series_ended(panel), segments.series_ended(panel, size), ["economic_series_ended"]),
        (index.wealth_path(panel), segments.wealth_path(panel, size), ["date", "index_anchor_date", "index_status", "wealth_index"]),
        (index.compound_returns(panel), segments.compound_returns(panel, size=size), ["wealth"]),
        (factors.momentum(panel, 4), segments.momentum(panel, 4, size), ["economic_series_ended", "has_required_history", "momentum"]),
    ]
    for whole, parts, columns in pairs:
        assert rounded(parts, *columns) == rounded(whole, *columns)
        assert set(parts.columns) <= set(whole.columns)


def test_no_rows(panel):
    for f in (segments.series_ended, segments.wealth_path, segments.compound_returns):
        assert f(panel.limit(0)).collect() == []
    assert segments.momentum(panel.limit(0), 3).collect() == []


def test_one_long_entity_spreads(spark):
    n = 400_000
    df = spark.range(n).select(
        F.lit(1).alias("permno"), F.expr("date_add(date'1000-01-01', cast(id as int))").alias("date"), F.col("id").alias("session_index"), F.lit(2.0).alias("price_raw"),
        (F.sin("id") / 1000).alias("ret_total"), (F.sin("id") / 1000).alias("ret_total_backtest"), (F.sin("id") / 1000).alias("ret_total_for_signal"), F.lit("N").alias("delist_flag"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = segments.wealth_path(df, 1024).withColumn("task", F.spark_partition_id())
        per_task = [r["count"] for r in path.groupBy("task").count().collect()]
        last = path.where(F.col("session_index") == n - 1).first()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(per_task) == n and len(per_task) > 1 and max(per_task) < 0.6 * n
    import math

    assert last.index_status == "VALID" and abs(last.wealth_index - math.exp(math.fsum(math.log1p(math.sin(i) / 1000) for i in range(1, n)))) < 1e-6
