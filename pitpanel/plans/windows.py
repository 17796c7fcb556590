"""Research windows planned by sessions, for a table of configurations at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ContractError

CONFIG = ("config_id", "eval_start", "eval_end", "lookback", "training", "horizon", "lag", "preopen")


def plan_windows(cal: DataFrame, configs: DataFrame, source_start: str, source_end: str, strict: bool = False) -> DataFrame:
    """One row per configuration (``CONFIG``, with optional ``train_start``, ``train_end`` and
    ``base_date``), all bounds being sessions of ``cal``.

    Training ends a horizon and an observation offset before the first evaluation; the
    lookback lies before the first observation. ``problem`` names the first thing that
    can't be met, null if all can; ``strict`` raises on any.
    """
    for name in ("train_start", "train_end", "base_date"):
        if name not in configs.columns:
            configs = configs.withColumn(name, F.lit(None).cast("date"))
    at = cal.select("date", F.col("session_index").alias("i"), "decision_time")
    out = configs.withColumn("base_date", F.coalesce("base_date", "eval_start"))
    for name in ("eval_start", "eval_end", "train_start", "train_end", "base_date"):
        out = out.join(at.select(F.col("date").alias(name), F.col("i").alias(f"i_{name}")), name, "left")
    offset = F.col("lag") + F.when(F.col("preopen"), 1).otherwise(0)
    last = F.col("i_eval_start") - F.col("horizon") - F.col("offset")
    chosen = F.col("train_start").isNotNull()
    out = out.withColumn("offset", offset)
    out = out.withColumn("i_last", F.when(chosen, F.col("i_train_end")).when(F.col("training") > 0, last))
    out = out.withColumn("i_first", F.when(chosen, F.col("i_train_start")).when(F.col("training") > 0, F.col("i_last") - F.col("training") + 1))
    out = out.withColumn("i_observed", F.coalesce("i_first", "i_eval_start") - F.col("offset"))
    out = out.withColumn("i_process", F.col("i_observed") - F.col("lookback") + 1)
    for name, index in (("process_start", "i_process"), ("first_observation", "i_observed"), ("training_start", "i_first"), ("training_end", "i_last")):
        out = out.join(at.select(F.col("date").alias(name), F.col("i").alias(index)), index, "left")
    out = out.withColumn("_latest", F.col("i_eval_end") - F.col("offset")).join(at.select(F.col("date").alias("last_observation"), F.col("i").alias("_latest")), "_latest", "left")
    out = out.join(at.select(F.col("date").alias("eval_start"), F.col("decision_time").alias("cutoff")), "eval_start", "left")
    lo, hi = F.lit(source_start).cast("date"), F.lit(source_end).cast("date")
    rules = [
        (F.col("i_eval_start").isNull() | F.col("i_eval_end").isNull(), "EVALUATION_BOUND_IS_NO_SESSION"),
        (chosen & (F.col("i_train_start").isNull() | F.col("i_train_end").isNull()), "TRAINING_BOUND_IS_NO_SESSION"),
        (F.col("i_base_date").isNull(), "BASE_DATE_IS_NO_SESSION"),
        (chosen & (F.col("i_train_end") > last), "TRAINING_NOT_MATURE_AT_CUTOFF"),
        (F.col("process_start").isNull() | (F.col("process_start") < lo), "NOT_ENOUGH_HISTORY"),
        (F.col("eval_end") > hi, "NOT_ENOUGH_COVERAGE"),
        ((F.col("base_date") < F.col("process_start")) | (F.col("base_date") > F.col("eval_end")), "BASE_DATE_OUT_OF_RANGE"),
    ]
    out = out.withColumn("problem", F.coalesce(*(F.when(p, F.lit(n)) for p, n in rules)))
    if strict and not out.where("problem is not null").isEmpty():
        raise ContractError("a research window can't be planned")
    kept = ["config_id", "process_start", "first_observation", "last_observation", "training_start", "training_end", "eval_start", "eval_end", "base_date", "cutoff", "problem"]
    return out.select(*kept, (F.col("i_eval_end") - F.col("i_process") + 1).alias("loaded_sessions"))


def planned_sessions(plan: DataFrame, cal: DataFrame) -> DataFrame:
    """``config_id, date, role``: each session that a plan loads, once for each role it has."""
    on = cal.select("date")
    spans = F.array(
        *(
            F.struct(F.lit(role).alias("role"), F.col(a).alias("lo"), F.col(b).alias("hi"))
            for role, a, b in (("LOADED", "process_start", "eval_end"), ("TRAINING", "training_start", "training_end"), ("EVALUATION", "eval_start", "eval_end"))
        )
    )
    days = plan.where("problem is null").select("config_id", F.explode(spans).alias("s")).where("s.lo is not null")
    each = days.select("config_id", "s.role", F.explode(F.sequence("s.lo", "s.hi")).alias("date"))
    return each.join(on, "date", "left_semi").select("config_id", "date", "role")


def missing_sessions(plan: DataFrame, cal: DataFrame, observed: DataFrame) -> DataFrame:
    """Loaded sessions of each plan that the source has no row on."""
    due = planned_sessions(plan, cal).where("role = 'LOADED'").select("config_id", "date")
    return due.join(observed.select("date").distinct(), "date", "left_anti")
