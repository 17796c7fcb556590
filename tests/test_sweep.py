"""150 configurations in one pass against a run of each alone."""

import datetime

import pytest
from pyspark.sql import functions as F

from pitpanel.operators import factors, features, labels, sweep
from pitpanel.plans.windows import plan_windows

from test_segments import D0, SCHEMA, panel_rows

SESSIONS = 70
CONFIG = "config_id long, eval_start date, eval_end date, lookback long, training long, horizon long, lag long, preopen boolean"


def day(i):
    return D0 + datetime.timedelta(days=i)


@pytest.fixture(scope="module")
def cal(spark):
    at = lambda h: F.expr(f"cast(date as timestamp) + interval {h} hour")
    dates = spark.range(SESSIONS).select(F.expr(f"date_add(date'{D0}', cast(id as int))").alias("date"), F.col("id").alias("session_index"))
    return dates.withColumns({"close_at": at(21), "decision_time": at(22), "available_at": at(46)}).cache()


@pytest.fixture(scope="module")
def panel(spark, cal):
    rows = spark.createDataFrame(panel_rows(3, 15, 60) + [(77, day(5), 5, 1.0, 0.1, 0.1, 0.1, "N")], SCHEMA)
    have = rows.join(cal.select("date", "available_at"), "date").withColumns(
        {
            "return_available_at": F.when(F.col("delist_flag") == "Y", None).otherwise(F.col("available_at")),
            "baseline_eligible_observed": F.col("permno") % 3 != 0,
            "metadata_quality": F.lit("M"),
            "availability_basis": F.lit("B"),
        }
    )
    return have.withColumns({c: F.lit(c) for c in features.OBSERVED if c not in have.columns}).repartition(6).cache()


@pytest.fixture(scope="module")
def plans(spark, cal):
    rows = [
        (i, day(20 + i % 25), day(50 + i % 14), 1 + i % 13, i % 6, 1 + i % 7, i % 3, i % 2 == 0)
        for i in range(148)
    ] + [(148, day(5), day(40), 30, 0, 2, 1, False), (149, day(69), day(69), 1, 0, 60, 0, False)]
    configs = spark.createDataFrame(rows, CONFIG).cache()
    return configs, plan_windows(cal, configs, str(D0), str(day(SESSIONS - 1))).cache()


def shown(df):
    return sorted(tuple(str(round(v, 9) + 0.0 if isinstance(v, float) else v) for v in r) for r in df.collect())


def alone(panel, cal, config, plan):
    """Features and labels of one configuration by its own run."""
    own = panel.where(F.col("date").between(F.lit(plan.process_start), F.lit(plan.eval_end)))
    offset = config.lag + int(config.preopen)
    seen = features.build_features(factors.momentum(own, config.lookback), cal, offset, str(plan.eval_end))
    return seen, labels.build_labels(own, cal, config.horizon, str(plan.eval_end))


@pytest.mark.parametrize("size", [3, 4096])
def test_equal_to_own_runs(panel, cal, plans, size):
    configs, plan = plans
    totals = sweep.running(panel, size).cache()
    wanted = sweep.configured(plan, configs, cal).cache()
    found, ahead = sweep.sweep_features(totals, wanted, cal).cache(), sweep.sweep_labels(totals, wanted, cal).cache()
    due = {r.config_id: r for r in plan.collect()}
    asked = {r.config_id: r for r in configs.collect()}
    met = lambda df: {r.config_id for r in df.select("config_id").distinct().collect()}
    planned = {k for k, p in due.items() if p.problem is None}
    # without an offset nothing is available at its own decision
    assert met(ahead) == planned - {149} and met(found) == {k for k in planned if asked[k].lag + asked[k].preopen}
    assert due[148].problem == "NOT_ENOUGH_HISTORY" and found.where("config_id = 148").isEmpty() and ahead.where("config_id = 148").isEmpty()
    for k in (0, 1, 12, 47, 90, 147) if size == 3 else (25, 77, 149):
        seen, future = alone(panel, cal, asked[k], due[k])
        assert shown(found.where(F.col("config_id") == k).drop("config_id")) == shown(seen)
        assert shown(ahead.where(F.col("config_id") == k).drop("config_id")) == shown(future)
    states = {r.label_status for r in ahead.select("label_status").distinct().collect()}
    assert {"TERMINAL_OUTCOME", "PERIOD_END_TRUNCATED", "SESSION_GAP", "MISSING_RETURN", "OBSERVED_APPROXIMATE_AVAILABILITY"} <= states
    assert not ahead.where("forward_vendor_return = -1").isEmpty()


def test_none(panel, cal, plans):
    configs, plan = plans
    totals, wanted = sweep.running(panel), sweep.configured(plan, configs, cal)
    for t, w in ((totals.limit(0), wanted), (totals, wanted.limit(0))):
        assert sweep.sweep_features(t, w, cal).isEmpty() and sweep.sweep_labels(t, w, cal).isEmpty()


def test_rows_without_entity_and_other_columns(spark, panel, cal, plans):
    configs, plan = plans
    wanted = sweep.configured(plan.where("config_id = 3"), configs, cal)
    lost = panel.where("permno = 4").withColumn("permno", F.lit(None).cast("int"))
    more = panel.unionByName(lost).withColumn("note", F.lit("x"))
    for f in (sweep.sweep_features, sweep.sweep_labels):
        assert shown(f(sweep.running(more), wanted, cal)) == shown(f(sweep.running(panel), wanted, cal))
