"""Data-quality checks of a run: each gives rows ``check, violations``; ``run_checks`` unites
them and says which passed. Conditions on one table are counted in one pass over it.

``t`` maps names to tables: ``daily, history, events`` (with storage dates), ``calendar,
panel, reconciliation, evidence, features, evaluation, labels, training, audit, summary,
display``. ``plan`` has ``process_start, train_start, train_end, eval_start, eval_end,
base_date, cutoff``; ``config`` has ``offset, horizon``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import quality as q
from ..schemas import DAILY
from ..sources.tables import verify_run
from .aggregates import named_counts
from .calendar import calendar_gaps
from .joins import match_by_key
from .normalize import bag_diff, duplicate_keys, open_end

Tables = Mapping[str, DataFrame]
KEYS = {
    "panel": ("permno", "date"), "features": ("permno", "decision_date"), "evaluation": ("permno", "decision_date"), "labels": ("permno", "decision_date"),
    "training": ("permno", "decision_date"), "audit": ("permno", "decision_date"), "display": ("permno", "date"), "calendar": ("date",),
    "evidence": ("permno", "observed_date"),
}
OUTCOMES = ("forward_vendor_return", "label_status", "delisting_return", "terminal_event_date", "successor_permno", "wealth_index", "index_base100", "valid_to")
OBSERVED = "OBSERVED_APPROXIMATE_AVAILABILITY"


def counted(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    return named_counts(df, predicates).select(F.col("label").alias("check"), F.col("value").alias("violations"))


def rows_of(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check"), "violations")


def all_of(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def constant(spark: SparkSession, name: str, violations: int) -> DataFrame:
    return spark.range(1).select(F.lit(name).alias("check"), F.lit(violations).cast("bigint").alias("violations"))


def day(plan: Mapping, name: str) -> Column:
    return F.lit(plan[name]).cast("date")


def check_artifacts(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Content and row count of each published table against the manifest."""
    seen = verify_run(spark, root, name)
    own = lambda kind, flag: seen.select(F.concat(F.lit(f"{kind}:"), "table").alias("check"), (~F.col(flag)).cast("bigint").alias("violations"))
    return own("artifact", "agrees").unionByName(own("rows", "rows_agree"))


def check_schema(t: Tables, required: Mapping[str, Sequence[str]]) -> DataFrame:
    return all_of([constant(t[n].sparkSession, f"schema:{n}", len(set(cols) - set(t[n].columns))) for n, cols in required.items()])


def check_keys(t: Tables, keys: Mapping[str, Sequence[str]] = KEYS) -> DataFrame:
    parts = []
    for n, key in keys.items():
        null = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in key))
        parts += [rows_of(duplicate_keys(t[n], key), f"key_unique:{n}"), counted(t[n], {f"key_not_null:{n}": null})]
    return all_of(parts)


def check_leakage_columns(t: Tables, outcomes: Sequence[str] = OUTCOMES) -> DataFrame:
    return all_of([constant(t[n].sparkSession, f"no_outcome_columns:{n}", len(set(outcomes) & set(t[n].columns))) for n in ("features", "evaluation")])


def check_availability(t: Tables, offset: int) -> DataFrame:
    c = t["calendar"]
    seen = c.select(F.col("date").alias("observation_date"), F.col("session_index").alias("observed"))
    made = c.select(F.col("date").alias("decision_date"), F.col("session_index").alias("decided"), F.col("decision_time").alias("due"))
    f = t["features"].join(seen, "observation_date", "left").join(made, "decision_date", "left")
    return counted(
        f,
        {
            "feature_available": F.coalesce(F.col("available_at") > F.col("decision_time"), F.lit(True)),
            "feature_offset": ~(F.col("decided") - F.col("observed")).eqNullSafe(F.lit(offset).cast("bigint")),
            "feature_decision_time": ~F.col("decision_time").eqNullSafe(F.col("due")),
        },
    )


def check_feature_sources(t: Tables) -> DataFrame:
    p = t["panel"].select("permno", F.col("date").alias("observation_date"), F.col("price_raw").alias("source_price"), F.col("ret_total_for_signal").alias("source_return"), F.col("delist_flag").alias("source_flag"), F.lit(True).alias("known"))
    f = t["features"].join(p, ["permno", "observation_date"], "left")
    return counted(
        f,
        {
            "feature_source_exists": F.col("known").isNull(),
            "feature_not_terminal": F.col("source_flag") == "Y",
            "feature_values_preserved": F.col("known") & (q.differs("price_raw", "source_price") | q.differs("observed_total_return", "source_return")),
        },
    )


def check_evaluation_subset(t: Tables, plan: Mapping) -> DataFrame:
    inside = F.col("decision_date").between(day(plan, "eval_start"), day(plan, "eval_end"))
    return counted(t["evaluation"], {"evaluation_range": ~inside}).unionByName(rows_of(bag_diff(t["features"].where(inside), t["evaluation"]), "evaluation_is_subset"))


def check_panel_range(t: Tables, plan: Mapping) -> DataFrame:
    return counted(t["panel"], {"panel_range": ~F.col("date").between(day(plan, "process_start"), day(plan, "eval_end"))})


def check_training_labels(t: Tables, plan: Mapping) -> DataFrame:
    cutoff = F.lit(plan["cutoff"]).cast("timestamp")
    l = t["labels"].select("permno", "decision_date", F.col("forward_vendor_return").alias("label_value"), "label_status")
    x = t["training"].join(l, ["permno", "decision_date"], "left")
    inside = F.col("decision_date").between(day(plan, "train_start"), day(plan, "train_end")) if plan.get("train_start") else F.lit(False)
    return counted(
        x,
        {
            "training_observed": q.differs("label_status", F.lit(OBSERVED)),
            "training_available": ~F.coalesce((F.col("label_available_at") <= cutoff) & (F.col("label_end_time") <= cutoff), F.lit(False)),
            "training_finite": ~F.coalesce(q.finite("forward_vendor_return"), F.lit(False)),
            "training_range": ~inside,
            "training_equals_labels": q.differs("forward_vendor_return", "label_value"),
        },
    )


def check_audit_totals(t: Tables) -> DataFrame:
    """Audit against features, training, summary, and its own rules."""
    keys = ["permno", "decision_date"]
    due = t["summary"].select(F.col("feature_rows").alias("n"), F.col("training_included").alias("k"))
    real = t["audit"].select(F.lit(-1).cast("bigint").alias("n"), F.when(F.col("training_included"), -1).otherwise(0).cast("bigint").alias("k"))
    off = due.unionByName(real).agg(F.coalesce(F.abs(F.sum("n")) + F.abs(F.sum("k")), F.lit(0)).cast("bigint").alias("violations")).select(F.lit("summary_totals").alias("check"), "violations")
    return all_of(
        [
            rows_of(bag_diff(t["features"].select(*keys), t["audit"].select(*keys)), "audit_has_features"),
            rows_of(bag_diff(t["audit"].where("training_included").select(*keys), t["training"].select(*keys)), "training_is_included"),
            counted(
                t["audit"],
                {"included_is_usable": F.col("training_included") & ((F.col("outcome_disposition") != "USABLE_AT_CUTOFF") | ~F.col("training_candidate") | (F.col("sample_role") != "TRAINING") | (F.col("label_status") != OBSERVED))},
            ),
            off,
        ]
    )


def check_label_states(t: Tables, horizon: int) -> DataFrame:
    observed = F.col("label_status") == OBSERVED
    return counted(
        t["labels"],
        {
            "unobserved_is_null": ~observed & (F.col("forward_vendor_return").isNotNull() | F.col("available_at").isNotNull()),
            "complete_has_horizon": observed & ((F.col("observed_sessions") != horizon) | (F.col("valid_sessions") != horizon)),
        },
    )


def check_return_policy(t: Tables) -> DataFrame:
    valid = F.col("return_quality") == "VALID_VENDOR_RETURN"
    return counted(
        t["panel"],
        {
            "vendor_return_preserved": q.differs("ret_total", "ret_total_vendor"),
            "valid_used_once": valid & q.differs("ret_total", "ret_total_backtest"),
            "unresolved_not_filled": ~valid & F.col("ret_total_backtest").isNotNull(),
            "terminal_is_no_signal": (F.col("delist_flag") == "Y") & F.col("ret_total_for_signal").isNotNull(),
            "ledger_fails_closed": (F.col("event_terms_incomplete") | F.col("event_terms_incomplete").isNull()) & (F.col("ledger_status") != "unsupported"),
        },
    )


def check_terminal(t: Tables) -> DataFrame:
    e, r = t["events"], t["reconciliation"]
    matched = F.col("terminal_reconciliation").isin(*q.MATCHED)
    stored = e.where("return_storage_date is not null")
    return all_of(
        [
            counted(
                t["panel"],
                {
                    "terminal_values_equal": matched & q.differs("ret_total", "delisting_return"),
                    "valid_terminal_has_event": (F.col("delist_flag") == "Y") & (F.col("return_quality") == "VALID_VENDOR_RETURN") & F.col("terminal_event_date").isNull(),
                },
            ),
            rows_of(duplicate_keys(stored, ["permno", "return_storage_date"]), "one_row_per_event"),
            counted(e, {"storage_after_event": F.col("return_storage_date") <= F.col("event_date")}),
            rows_of(e.join(r, ["permno", "event_date"], "left_anti"), "no_event_lost"),
            rows_of(t["panel"].where(q.is_terminal()).join(r.select("permno", F.col("actual_daily_date").alias("date")), ["permno", "date"], "left_anti"), "no_terminal_row_lost"),
            counted(
                r.where(F.col("reconciliation_status").isin(*q.MATCHED)),
                {
                    "reconciliation_keeps_dates": q.differs("actual_daily_date", "return_storage_date") | q.differs("delist_flag", F.lit("Y")) | q.differs("ret_total", "delisting_return")
                    | F.coalesce(F.col("event_date") >= F.col("return_storage_date"), F.lit(True))
                },
            ),
        ]
    )


def check_events(t: Tables) -> DataFrame:
    p = t["panel"].select("permno", F.col("date").alias("observed_date"), F.col("ret_total").alias("source_return"))
    return counted(t["evidence"].join(p, ["permno", "observed_date"], "left"), {"evidence_keeps_outcome": q.differs("ret_total_vendor", "source_return")})


def check_display(t: Tables, plan: Mapping, tolerance: float = 1e-9) -> DataFrame:
    base, value, out = F.col("base_wealth_index"), F.col("wealth_index"), F.col("index_base100")
    return counted(
        t["display"],
        {
            "base_zero_or_missing_is_null": (base.isNull() | (base == 0)) & out.isNotNull(),
            "display_formula": F.abs(out - 100 * value / F.nullif(base, F.lit(0.0))) > tolerance,
            "base_is_100": (F.col("date") == day(plan, "base_date")) & (F.abs(out - 100) > tolerance),
            "base_value_equal": (F.col("date") == day(plan, "base_date")) & q.differs("wealth_index", "base_wealth_index"),
            "base_observed_as_planned": (F.col("date") == day(plan, "base_date")) & ~F.col("has_base"),
        },
    )


def check_counts(t: Tables, status: DataFrame, report: DataFrame | None = None) -> DataFrame:
    """The counts that a run reports against its tables: ``status`` of ``run_status`` and, if
    given, the total of ``dropout_report``."""

    def off(name: str, due: DataFrame, rows: DataFrame) -> DataFrame:
        both = due.toDF("n").unionByName(rows.select(F.lit(-1).cast("bigint").alias("n")))
        return both.agg(F.abs(F.sum("n")).alias("violations")).select(F.lit(name).alias("check"), "violations")

    parts = [
        off("unresolved_equals_status", status.select("unresolved_returns"), t["panel"].where(F.col("return_quality") != "VALID_VENDOR_RETURN")),
        off("unresolved_events_equal_status", status.select("unresolved_events"), t["reconciliation"].where(~F.col("reconciliation_status").isin(*q.MATCHED))),
    ]
    if report is not None:
        parts.append(off("candidates_equal_report", report.where("kind = 'total'").select("candidates"), t["audit"].where("training_candidate")))
    return all_of(parts)


EVENT_FIELDS = ("delisting_return", "action_type", "status_type", "reason_type", "payment_type", "successor_permno")


def check_terminal_evidence(t: Tables) -> DataFrame:
    """Terminal rows of the panel keep every field of their source event."""
    source = t["events"].select("permno", F.col("event_date").alias("terminal_event_date"), F.lit(True).alias("_known"), *(F.col(c).alias(f"_{c}") for c in EVENT_FIELDS))
    rows = t["panel"].where(q.is_terminal() & F.col("terminal_event_date").isNotNull()).join(source, ["permno", "terminal_event_date"], "left")
    changed = reduce(lambda a, b: a | b, (q.differs(c, f"_{c}") for c in EVENT_FIELDS))
    return counted(rows, {"terminal_evidence_preserved": F.col("_known").isNull() | changed})


def check_source_preserved(t: Tables, plan: Mapping) -> DataFrame:
    source = t["daily"].where(F.col("date").between(day(plan, "process_start"), day(plan, "eval_end"))).select(*DAILY.names)
    return rows_of(bag_diff(source, t["panel"].select(*DAILY.names)), "source_rows_preserved")


def check_inputs(t: Tables) -> DataFrame:
    """The input layers: keys, returns, intervals, overlaps, coverage, terminal agreement."""
    from pyspark.sql import Window

    daily, history, events, cal = t["daily"], t["history"], t["events"], t["calendar"]
    own = Window.partitionBy("permno").orderBy("valid_from", F.asc_nulls_last("valid_to"))
    lagged = history.withColumn("previous_end", F.lag(open_end()).over(own))
    terminal = match_by_key(daily.where("delist_flag = 'Y'"), events)
    return all_of(
        [
            rows_of(duplicate_keys(daily, ["permno", "date"]), "daily_keys_unique"),
            counted(daily, {"daily_keys_not_null": F.col("permno").isNull() | F.col("date").isNull(), "daily_returns_valid": q.return_validity("ret_total").isin("NONFINITE", "BELOW_MINUS_ONE")}),
            rows_of(duplicate_keys(history, ["permno", "valid_from"]), "history_keys_unique"),
            counted(lagged, {"history_intervals": F.col("valid_to") < F.col("valid_from"), "history_no_overlap": F.col("previous_end") >= F.col("valid_from")}),
            rows_of(duplicate_keys(events, ["permno", "event_date"]), "event_keys_unique"),
            rows_of(calendar_gaps(daily, cal), "calendar_covered"),
            counted(terminal, {"terminal_has_event": ~F.col("has_event"), "terminal_dates": F.col("date_mismatch"), "terminal_values": F.col("value_mismatch")}),
        ]
    )


def check_causality(build, daily: DataFrame, upto: str, changed: DataFrame) -> DataFrame:
    """``build`` makes features from daily rows; those decided by ``upto`` must be the same
    from rows whose future was cut off or changed."""
    limit = F.col("decision_date") <= F.lit(upto).cast("date")
    past = daily.where(F.col("date") <= F.lit(upto).cast("date"))
    names = {"causal_if_cut": build(past), "causal_if_changed": build(changed)}
    whole = build(daily).where(limit)
    # the whole is built once and held against both others in one shuffle
    signed = whole.select("*", F.explode(F.array(*map(F.lit, names))).alias("check"), F.lit(1).alias("sign"))
    for name, other in names.items():
        signed = signed.unionByName(other.where(limit).select("*", F.lit(name).alias("check"), F.lit(-1).alias("sign")))
    off = signed.groupBy("check", *whole.columns).agg(F.sum("sign").alias("surplus")).where("surplus <> 0").select("check", F.lit(1).cast("bigint").alias("violations"))
    none = all_of([constant(daily.sparkSession, name, 0) for name in names])
    return off.unionByName(none).groupBy("check").agg(F.sum("violations").alias("violations"))


def run_checks(t: Tables, plan: Mapping, config: Mapping, status: DataFrame, report: DataFrame | None = None, published: tuple[SparkSession, str, str] | None = None) -> DataFrame:
    """``check, violations, passed`` of all checks on the tables of a run; with ``published``
    (session, root, run) also of its files against their manifest."""
    parts = [
        check_schema(t, {"daily": DAILY.names}), check_keys(t), check_leakage_columns(t), check_availability(t, config["offset"]), check_feature_sources(t),
        check_evaluation_subset(t, plan), check_panel_range(t, plan), check_training_labels(t, plan), check_audit_totals(t), check_label_states(t, config["horizon"]),
        check_return_policy(t), check_terminal(t), check_events(t), check_display(t, plan), check_counts(t, status, report), check_source_preserved(t, plan), check_terminal_evidence(t), check_inputs(t),
        *([check_artifacts(*published)] if published else []),
    ]
    return all_of(parts).withColumn("passed", F.col("violations") == 0)
