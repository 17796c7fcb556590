"""Forward labels and their maturity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.quality import first_match
from .factors import log_growth
from .joins import with_label_end


def forward_window(panel: DataFrame, horizon: int) -> DataFrame:
    """Counts and growth over the sessions after a row up to ``horizon`` later, by session
    index, so that a missing session is missed and not skipped."""
    w = Window.partitionBy("permno").orderBy("session_index").rangeBetween(1, horizon)
    r, signal = F.col("ret_total"), F.col("ret_total_for_signal")
    return panel.withColumns(
        {
            "observed_sessions": F.count(F.lit(1)).over(w),
            "valid_sessions": F.count(signal).over(w),
            "terminal_sessions": F.count(F.when(F.col("delist_flag") == "Y", 1)).over(w),
            "missing_return_sessions": F.count(F.when(r.isNull(), 1)).over(w),
            "incomplete_return_sessions": F.count(F.when(r.isNotNull() & signal.isNull(), 1)).over(w),
            "observed_available_at": F.max("return_available_at").over(w),
            "loss_sessions": F.count(F.when(signal == -1, 1)).over(w),
            "forward_log": F.sum(log_growth(signal)).over(w),
        }
    )


def build_labels(panel: DataFrame, cal: DataFrame, horizon: int, eval_end: str) -> DataFrame:
    """A label for each row whose horizon the calendar holds: a status, and a value and
    availability only where every session of the horizon was observed."""
    return labelled(with_label_end(forward_window(panel, horizon), cal, horizon), F.lit(horizon), F.lit(eval_end).cast("date"))


def labelled(windows: DataFrame, horizon: Column, eval_end: Column, *extra: str) -> DataFrame:
    """The columns of labels, after ``extra``, of rows with their forward windows."""
    cut = F.col("label_end_date") > eval_end
    status = first_match(
        [
            (F.col("terminal_sessions") > 0, "TERMINAL_OUTCOME"),
            (cut, "PERIOD_END_TRUNCATED"),
            (F.col("observed_sessions") < horizon, "SESSION_GAP"),
            (F.col("missing_return_sessions") > 0, "MISSING_RETURN"),
            (F.col("valid_sessions") < horizon, "INCOMPLETE_RETURN"),
        ],
        F.lit("OBSERVED_APPROXIMATE_AVAILABILITY"),
    )
    observed = F.col("label_status") == "OBSERVED_APPROXIMATE_AVAILABILITY"
    growth = F.when(F.col("loss_sessions") > 0, -1.0).otherwise(F.exp("forward_log") - 1)
    return windows.withColumn("label_status", status).select(
        *extra, "permno", F.col("date").alias("decision_date"), "label_end_date", "label_end_time", "expected_available_at",
        F.when(observed, F.col("observed_available_at")).alias("available_at"), F.when(observed, growth).alias("forward_vendor_return"), "label_status",
        "observed_sessions", "valid_sessions", "terminal_sessions", "missing_return_sessions", "incomplete_return_sessions",
        cut.alias("period_end_truncated"), ((F.col("observed_sessions") < horizon) & ~cut).alias("has_session_gap"),
    )


def mature_labels(labels: DataFrame, cutoff: str) -> DataFrame:
    """Labels that have ended and are available by the cutoff; unknown times are not."""
    limit = F.lit(cutoff).cast("timestamp")
    return labels.where(F.coalesce((F.col("label_end_time") <= limit) & (F.col("available_at") <= limit), F.lit(False)))
