"""Training set and the audit of every feature row that is not in it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quality import first_match
from ..schemas import ContractError
from .joins import attach_labels, training_join, with_exists

SESSION_GAPS = ("SESSION_GAP", "MISSING_DECISION_OBSERVATION")
INCOMPLETE = ("INCOMPLETE_RETURN", "UNKNOWN_AVAILABILITY")


def training_audit(features: DataFrame, labels: DataFrame, events: DataFrame, plan: dict) -> DataFrame:
    """Every feature row with its role, one exclusive disposition, and overlapping flags.

    ``plan`` has ``train_start`` and ``train_end`` (both null without training),
    ``eval_start``, ``eval_end`` and ``cutoff``. Contains outcomes: never an input.
    """
    day = lambda name: F.lit(plan[name]).cast("date")
    cutoff = F.lit(plan["cutoff"]).cast("timestamp")
    joined = with_exists(attach_labels(features, labels), events, "permno", "eventual_delisting_in_snapshot")
    training = F.col("decision_date").between(day("train_start"), day("train_end")) if plan.get("train_start") else F.lit(False)
    role = first_match([(training, "TRAINING"), (F.col("decision_date").between(day("eval_start"), day("eval_end")), "EVALUATION")], F.lit("PREPARATION"))
    outcome = first_match(
        [
            (~F.col("eligible_for_research"), "FEATURE_NOT_ELIGIBLE"),
            (~F.col("has_label"), "MISSING_DECISION_OBSERVATION"),
            (F.col("terminal_sessions") > 0, "TERMINAL_OUTCOME"),
            (F.col("period_end_truncated"), "PERIOD_END_TRUNCATED"),
            (F.col("has_session_gap"), "SESSION_GAP"),
            (F.col("missing_return_sessions") > 0, "MISSING_RETURN"),
            (F.col("label_status") != "OBSERVED_APPROXIMATE_AVAILABILITY", "INCOMPLETE_RETURN"),
            ((F.col("label_end_time") > cutoff) | (F.col("label_available_at") > cutoff), "LABEL_IMMATURE_CUTOFF"),
            (F.col("label_available_at").isNull() | F.col("forward_vendor_return").isNull(), "UNKNOWN_AVAILABILITY"),
        ],
        F.lit("USABLE_AT_CUTOFF"),
    )
    usable = F.col("outcome_disposition") == "USABLE_AT_CUTOFF"
    disposition = F.when(F.col("sample_role") != "TRAINING", "OUTSIDE_TRAINING_WINDOW").when(usable, "INCLUDED").otherwise(F.col("outcome_disposition"))
    return joined.select(
        "permno", "decision_date", F.year("decision_date").cast("bigint").alias("decision_year"), F.col("primary_exchange").alias("exchange_observed"),
        role.alias("sample_role"), F.col("eligible_for_research").alias("feature_eligible"), (training & F.col("eligible_for_research")).alias("training_candidate"),
        "eventual_delisting_in_snapshot", F.coalesce("label_status", F.lit("MISSING_DECISION_OBSERVATION")).alias("label_status"), "label_end_date",
        "label_end_time", "label_available_at", "expected_available_at", "terminal_sessions", "missing_return_sessions", "incomplete_return_sessions",
        "period_end_truncated", "has_session_gap", ((F.col("expected_available_at") > cutoff) | (F.col("label_end_time") > cutoff)).alias("immature_at_cutoff"),
        outcome.alias("outcome_disposition"),
    ).withColumns({"training_included": F.col("training_candidate") & usable, "training_disposition": disposition})


def training_set(features: DataFrame, labels: DataFrame, audit: DataFrame, required: bool = False) -> DataFrame:
    out = training_join(features, labels, audit)
    if required and out.isEmpty():
        raise ContractError("no eligible mature training row")
    return out


def dropout_summary(audit: DataFrame) -> DataFrame:
    """Candidates, included and excluded rows by role, year, exchange and eventual fate."""
    candidate, included, why = F.col("training_candidate"), F.col("training_included"), F.col("training_disposition")
    lost = lambda *codes: F.count_if(candidate & why.isin(*codes))
    counted = audit.groupBy("sample_role", "decision_year", "exchange_observed", "eventual_delisting_in_snapshot").agg(
        F.count(F.lit(1)).alias("feature_rows"), F.count_if(candidate).alias("training_candidates"), F.count_if(included).alias("training_included"),
        F.count_if(candidate & ~included).alias("training_excluded"), lost("TERMINAL_OUTCOME").alias("terminal_excluded"),
        lost("LABEL_IMMATURE_CUTOFF").alias("immature_excluded"), lost("PERIOD_END_TRUNCATED").alias("truncated_excluded"),
        lost(*SESSION_GAPS).alias("session_gap_excluded"), lost("MISSING_RETURN").alias("missing_return_excluded"), lost(*INCOMPLETE).alias("incomplete_excluded"),
    )
    return counted.withColumn("dropout_rate", F.try_divide(F.col("training_excluded").cast("double"), F.col("training_candidates").cast("double")))


def dropout_report(audit: DataFrame, threshold: float = 0.10) -> DataFrame:
    """Rows of three kinds: the total, each disposition of a candidate, each training group
    whose dropout rate reaches the threshold."""
    candidates = audit.where("training_candidate")
    none = F.lit(None).cast("double")
    total = candidates.agg(F.count(F.lit(1)).alias("candidates"), F.count_if(~F.col("training_included")).alias("excluded")).select(
        F.lit("total").alias("kind"), F.lit("all").alias("name"), "candidates", "excluded", F.try_divide(F.col("excluded").cast("double"), F.col("candidates").cast("double")).alias("rate")
    )
    reasons = candidates.groupBy("training_disposition").agg(F.count(F.lit(1)).alias("candidates"), F.count_if(~F.col("training_included")).alias("excluded"))
    by_reason = reasons.select(F.lit("disposition").alias("kind"), F.col("training_disposition").alias("name"), "candidates", "excluded", none.alias("rate"))
    name = F.concat_ws("|", F.col("decision_year").cast("string"), F.coalesce("exchange_observed", F.lit("?")), F.col("eventual_delisting_in_snapshot").cast("string"))
    high = dropout_summary(audit).where((F.col("sample_role") == "TRAINING") & (F.col("dropout_rate") >= threshold))
    warned = high.select(F.lit("warning").alias("kind"), name.alias("name"), F.col("training_candidates").alias("candidates"), F.col("training_excluded").alias("excluded"), F.col("dropout_rate").alias("rate"))
    return total.unionByName(by_reason).unionByName(warned)


def run_status(panel: DataFrame, reconciliation: DataFrame, policy: str = "report") -> DataFrame:
    """One row of open questions and the status of a run; policy ``fail`` raises on any."""
    no = F.lit(False)
    rows = panel.select(
        (F.col("return_quality") != "VALID_VENDOR_RETURN").alias("a"), (~F.col("has_metadata")).alias("b"), F.col("requires_review").alias("c"), no.alias("d")
    )
    events = reconciliation.select(no.alias("a"), no.alias("b"), no.alias("c"), (~F.col("reconciliation_status").isin("MATCHED_VALUE", "MATCHED_NULL")).alias("d"))
    names = ("unresolved_returns", "missing_metadata", "review_rows", "unresolved_events")
    counts = rows.unionByName(events).agg(*(F.count_if(c).alias(n) for c, n in zip("abcd", names)))
    open_returns = (F.col("unresolved_returns") > 0) | (F.col("unresolved_events") > 0)
    status = first_match([(open_returns, "INCOMPLETE_RETURNS"), (F.col("missing_metadata") > 0, "INCOMPLETE_METADATA")], F.lit("RESEARCH_ONLY"))
    out = counts.withColumn("status", status)
    if policy == "fail" and not out.where("review_rows > 0 or unresolved_events > 0").isEmpty():
        raise ContractError("the run has rows or events that need a review")
    return out
