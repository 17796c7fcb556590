"""As-of features: what a decision may see, and nothing later."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import asof_sessions

OBSERVED = (
    "available_at", "price_raw", "price_flag", "market_cap_kusd", "market_cap_flag", "volume_raw_shares", "ret_missing_flag", "return_quality",
    "execution_status", "ticker_asof", "cusip_asof", "primary_exchange", "security_type", "security_subtype", "share_type", "share_class",
    "us_incorporated_flag", "trading_status_flag", "conditional_type",
)


def build_features(factors: DataFrame, cal: DataFrame, offset: int, eval_end: str) -> DataFrame:
    """Ordinary rows, ``offset`` sessions old at their decision and available by then, for
    decisions up to ``eval_end``. No column of an outcome is carried."""
    seen = asof_sessions(factors.where("delist_flag = 'N'"), cal, offset).where(F.col("decision_date") <= F.lit(eval_end).cast("date"))
    return observed_at_decision(seen)


def observed_at_decision(seen: DataFrame, *extra: str) -> DataFrame:
    """The columns of features, after ``extra``, of rows that stand with their decision."""
    eligible = F.col("baseline_eligible_observed") & F.col("has_required_history")
    return seen.select(
        *extra, "permno", "decision_date", "decision_time", F.col("date").alias("observation_date"), *OBSERVED,
        F.col("ret_total_for_signal").alias("observed_total_return"), "momentum", "has_required_history", "baseline_eligible_observed",
        eligible.alias("eligible_for_research"), "metadata_quality", "availability_basis", F.lit("APPROXIMATE_PIT").alias("pit_status"),
    )


def evaluation_features(features: DataFrame, eval_start: str, eval_end: str) -> DataFrame:
    return features.where(F.col("decision_date").between(F.lit(eval_start).cast("date"), F.lit(eval_end).cast("date")))
