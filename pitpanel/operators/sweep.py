"""Factors, features and labels of many planned configurations in one pass over the panel.

``running`` adds to each row the totals of its entity up to there. Every lookback or horizon
is then a difference of two rows that meet by session, so its cost doesn't grow with its
length, a configuration costs nothing where others ask for the same length, and the table can
be stored and used again. What a run on its own sessions alone would see follows from the
totals too: an ending before its first session is older than that, and a horizon that
passes its last session stops there.

Each entity has one row a session at most. Returns for signals are null or finite, and what
is available of a later session is so no earlier, as ``build_panel`` and the calendar give
them. Rows without an entity have no factors or labels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .factors import log_growth
from .features import observed_at_decision
from .labels import labelled
from .segments import KEY, SIZE, cut, ending, inside, scanned, totals


def _steps() -> dict[str, Column]:
    r, signal = F.col("ret_total"), F.col("ret_total_for_signal")
    one = lambda p: F.when(p, 1).otherwise(0).cast("long")
    return {
        "_rows": F.lit(1).cast("long"), "_valid": one(signal.isNotNull()), "_losses": one(signal == -1), "_terminal": one(F.col("delist_flag") == "Y"),
        "_missing": one(r.isNull()), "_incomplete": one(r.isNotNull() & signal.isNull()), "_log": F.coalesce(log_growth(signal), F.lit(0.0)),
    }


def running(panel: DataFrame, size: int = SIZE) -> DataFrame:
    """``panel`` with running totals, the session of the last ending so far (``_ended_at``) and
    the session of the entity's next row (``_next``). Long entities are cut into segments."""
    steps = _steps()
    ended = F.when(ending(), F.col("session_index"))
    states = {f"{name}_before": (F.sum(step), "sum") for name, step in steps.items()} | {"_ended_before": (F.max(ended), "max")}
    own = totals(scanned(cut(panel, size), states), steps)
    first = own.groupBy(KEY, "_segment").agg(F.min("session_index").alias("_first"))
    following = first.select(KEY, "_segment", F.lead("_first").over(Window.partitionBy(KEY).orderBy("_segment")).alias("_following"))
    upto = inside(Window.unboundedPreceding, 0)
    out = own.join(following.hint("merge"), [KEY, "_segment"], "left").withColumns(
        {
            "_ended_at": F.coalesce(F.max(ended).over(upto), F.col("_ended_before")),
            "_next": F.coalesce(F.lead("session_index").over(inside()), F.col("_following")),
        }
    )
    return out.select(*panel.columns, *steps, "_ended_at", "_next")


def configured(plan: DataFrame, configs: DataFrame, cal: DataFrame) -> DataFrame:
    """A row for each session that a plan without a problem loads: ``config_id, lookback,
    horizon, offset, eval_end, first, last, session_index``."""
    number = lambda date, name: cal.select(F.col("date").alias(date), F.col("session_index").alias(name))
    lengths = configs.select("config_id", "lookback", "horizon", (F.col("lag") + F.when(F.col("preopen"), 1).otherwise(0)).alias("offset"))
    own = plan.where("problem is null").select("config_id", "process_start", "eval_end").join(lengths, "config_id")
    bounds = own.join(number("process_start", "first"), "process_start").join(number("eval_end", "last"), "eval_end")
    return bounds.drop("process_start").withColumn("session_index", F.explode(F.sequence("first", "last")))


def sweep_factors(totals: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows that each configuration loads, with ``has_required_history`` and ``momentum`` as
    its own run has them. ``totals`` is from ``running``, ``wanted`` from ``configured``."""
    needed = ("_rows", "_valid", "_losses", "_log")
    steps = _steps()
    before = totals.select(F.col(KEY).alias("_key"), F.col("session_index").alias("_start"), *((F.col(n) - steps[n]).alias(f"{n}_start") for n in needed))
    pairs = wanted.select("lookback", "session_index").distinct()
    begins = F.col("session_index") - F.col("lookback") + 1
    met = totals.join(pairs, "session_index").join(before, (F.col(KEY) == F.col("_key")) & (begins == F.col("_start")), "left")
    inner = {n: F.col(n) - F.col(f"{n}_start") for n in needed}
    whole = F.coalesce((inner["_rows"] == F.col("lookback")) & (inner["_valid"] == F.col("lookback")), F.lit(False))
    value = F.when(inner["_losses"] > 0, -1.0).otherwise(F.exp(inner["_log"]) - 1)
    kept = [c for c in totals.columns if c not in (*steps, "_next")]
    found = met.select(*kept, "lookback", whole.alias("_whole"), value.alias("_value"))
    out = found.join(wanted, ["lookback", "session_index"])
    running_yet = F.coalesce(F.col("_ended_at") < F.col("first"), F.lit(True))
    out = out.withColumn("has_required_history", F.col("_whole") & running_yet & (begins >= F.col("first")))
    return out.withColumn("momentum", F.when(F.col("has_required_history"), F.col("_value"))).drop("_whole", "_value", "_ended_at")


def sweep_features(totals: DataFrame, wanted: DataFrame, cal: DataFrame) -> DataFrame:
    """``config_id`` and the columns of ``build_features`` for each configuration."""
    later = cal.select(F.col("session_index").alias("_decided"), F.col("date").alias("decision_date"), "decision_time")
    rows = sweep_factors(totals.where(F.col(KEY).isNotNull()), wanted).where("delist_flag = 'N'")
    seen = rows.withColumn("_decided", F.col("session_index") + F.col("offset")).join(later, "_decided")
    return observed_at_decision(seen.where((F.col("decision_time") >= F.col("available_at")) & (F.col("decision_date") <= F.col("eval_end"))), "config_id")


def sweep_labels(totals: DataFrame, wanted: DataFrame, cal: DataFrame) -> DataFrame:
    """``config_id`` and the columns of ``build_labels`` for each configuration. Looks up the
    longest horizon first: a row stands in for the sessions without one that follow it, as
    many as that at most."""
    longest = wanted.agg(F.max("horizon")).first()[0] or 0
    counts = [n for n in _steps() if n != "_log"]
    upto = F.least(F.coalesce(F.col("_next") - 1, F.col("session_index") + longest), F.col("session_index") + longest)
    ends = totals.select(
        F.col(KEY).alias("_key"), *(F.col(n).alias(f"{n}_end") for n in (*counts, "_log")), F.col("return_available_at").alias("_end_available_at"),
        F.explode(F.sequence("session_index", upto)).alias("_at"),
    )
    wanted = wanted.withColumn("_until", F.least(F.col("session_index") + F.col("horizon"), F.col("last")))
    pairs = wanted.select("horizon", "session_index", "_until").distinct()
    met = totals.join(pairs, "session_index").join(ends, (F.col(KEY) == F.col("_key")) & (F.col("_until") == F.col("_at")))
    names = dict(zip(counts, ("observed_sessions", "valid_sessions", "loss_sessions", "terminal_sessions", "missing_return_sessions", "incomplete_return_sessions"), strict=True))
    ahead = met.select(
        KEY, "date", "session_index", "horizon", "_until", *((F.col(f"{n}_end") - F.col(n)).alias(name) for n, name in names.items()),
        (F.col("_log_end") - F.col("_log")).alias("forward_log"), F.col("_end_available_at").alias("observed_available_at"),
    )
    later = cal.select(
        F.col("session_index").alias("_ends"), F.col("date").alias("label_end_date"), F.col("close_at").alias("label_end_time"), F.col("available_at").alias("expected_available_at")
    )
    windows = ahead.withColumn("_ends", F.col("session_index") + F.col("horizon")).join(later, "_ends")
    asked = wanted.select("config_id", "eval_end", "horizon", "session_index", "_until")
    return labelled(windows.join(asked, ["horizon", "session_index", "_until"]), F.col("horizon"), F.col("eval_end"), "config_id")
