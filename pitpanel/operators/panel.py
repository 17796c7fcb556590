"""Terminal events, the row-preserving panel, reconciliation both ways and universe flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import quality as q
from ..schemas import DAILY, HISTORY, TERMINAL, ContractError, require_columns
from .calendar import next_session
from .joins import events_to_panel, interval_join, match_events
from .normalize import duplicate_keys, optional_column

STORAGE = ("return_storage_date", "deldlydt")
MISSING_FLAGS = ("event_ret_missing_flag", "delisting_ret_missing_flag", "delretmisstype")


def terminal_events(events: DataFrame, cal: DataFrame, check: bool = True) -> DataFrame:
    """Terminal events with the session on which the daily table stores their return.

    A source column gives it, null staying unknown; without one it is the next session. A
    storage date not after its event, and two events of an entity on one, raise.
    """
    require_columns(events, TERMINAL)
    source, has_source = optional_column(events, STORAGE, "date")
    flag, has_flag = optional_column(events, MISSING_FLAGS, "string")
    kept = events.select(*TERMINAL.names, source.alias("source_return_storage_date"), flag.alias("event_ret_missing_flag"))
    if has_source:
        kept = kept.withColumn("return_storage_date", F.col("source_return_storage_date"))
    else:
        kept = next_session(kept, cal, "event_date", "return_storage_date")
    basis = "SOURCE_STORAGE_DATE" if has_source else "NEXT_SESSION_FALLBACK_NOT_SOURCE_DATE"
    out = kept.withColumns({"event_missing_flag_present": F.lit(has_flag), "storage_date_basis": F.lit(basis)})
    if check:
        if not out.where("return_storage_date <= event_date").isEmpty():
            raise ContractError("a storage date must follow its event")
        if not duplicate_keys(out.where("return_storage_date is not null"), ["permno", "return_storage_date"]).isEmpty():
            raise ContractError("two events of an entity are stored on one date")
    return out


def reconcile_terminal(panel: DataFrame, events: DataFrame) -> DataFrame:
    return match_events(panel, events).withColumn("terminal_reconciliation", q.terminal_state())


def build_panel(daily: DataFrame, history: DataFrame, events: DataFrame, cal: DataFrame) -> DataFrame:
    """The daily rows that fall on sessions with their attributes, terminal event, grades
    and derived returns. ``events`` is the result of ``terminal_events``.

    Attributes come by interval, events by exact storage date, so a row stays one row if
    intervals don't overlap and storage dates are unique; ``assert_row_preserving`` checks.
    """
    require_columns(daily, DAILY), require_columns(history, HISTORY)
    attributes = [c for c in HISTORY.names if c not in ("permno", "valid_from", "valid_to", "ticker", "cusip")]
    h = history.select("permno", "valid_from", "valid_to", F.col("ticker").alias("ticker_asof"), F.col("cusip").alias("cusip_asof"), *attributes)
    d = daily.select(*DAILY.names).join(cal.select("date", "session_index", "available_at"), "date")
    d = interval_join(d, h).withColumn("has_metadata", F.col("_key").isNotNull()).withColumnRenamed("valid_from", "metadata_effective_from").drop("_key", "valid_to")
    e = events.withColumnRenamed("event_date", "terminal_event_date")
    graded = reconcile_terminal(d, e).withColumns({"return_quality": q.return_quality(), "metadata_quality": q.metadata_quality(), "baseline_eligible_observed": q.baseline_eligible()})
    valid = F.col("return_quality") == "VALID_VENDOR_RETURN"
    terminal, flag = q.is_terminal(), F.col("distribution_return_flag")
    incomplete = terminal | ~flag.isin("NO", "NA") | flag.isNull()
    return graded.withColumns(
        {
            "ret_total_vendor": F.col("ret_total"),
            "ret_total_backtest": F.when(valid, F.col("ret_total")),
            "ret_total_for_signal": F.when(valid & (F.col("delist_flag") == "N"), F.col("ret_total")),
            "return_source": F.when(terminal, "TERMINAL_EMBEDDED").otherwise("DAILY"),
            "return_was_reconstructed": F.lit(False),
            "daily_record_type": q.first_match([(terminal, "TERMINAL_RETURN_STORAGE"), (F.col("delist_flag") == "N", "ORDINARY_DAILY")], F.lit("UNKNOWN_SOURCE_FLAG")),
            "is_delisting_return": terminal,
            "is_eventual_outcome": terminal,
            "event_terms_incomplete": incomplete,
            "ledger_status": F.when(incomplete, "unsupported").otherwise("no_posting_required"),
            "availability_basis": F.lit("ASSUMED_SESSION_LAG_NOT_HISTORICAL_VINTAGE"),
            "return_available_at": F.when(terminal, F.lit(None).cast("timestamp")).otherwise(F.col("available_at")),
            "requires_review": ~valid | ~F.col("has_metadata"),
            "execution_status": F.lit("UNSUPPORTED_MISSING_OPEN_AND_EXECUTION_MODEL"),
        }
    )


def reverse_reconciliation(events: DataFrame, daily: DataFrame) -> DataFrame:
    """Both directions of the audit: each event with the state of the daily row that should
    store it, and each terminal daily row that no event explains."""
    found = events_to_panel(events, daily)
    absent = F.col("actual_daily_date").isNull()
    status = q.first_match(
        [
            (F.col("return_storage_date").isNull(), "MISSING_SOURCE_STORAGE_DATE"),
            (absent, "MISSING_TERMINAL_DAILY_ROW"),
            (q.differs("delist_flag", F.lit("Y")), "EXPECTED_TERMINAL_FLAG"),
            (q.differs("ret_total", "delisting_return"), "TERMINAL_RETURN_MISMATCH"),
            (F.col("event_missing_flag_present") & q.differs("ret_missing_flag", "event_ret_missing_flag"), "TERMINAL_MISSING_FLAG_MISMATCH"),
            (F.col("ret_total").isNull(), "MATCHED_NULL"),
        ],
        F.lit("MATCHED_VALUE"),
    )
    columns = ["permno", "observed_date", "event_date", "return_storage_date", "storage_date_basis", "actual_daily_date", "delist_flag", "ret_total", "delisting_return", "ret_missing_flag", "event_ret_missing_flag", "reconciliation_status"]
    forward = found.withColumns({"observed_date": F.coalesce("return_storage_date", "event_date"), "reconciliation_status": status}).select(*columns)
    stored = events.select("permno", F.col("return_storage_date").alias("date"))
    alone = daily.where(q.is_terminal()).join(stored, ["permno", "date"], "left_anti")
    none = lambda kind: F.lit(None).cast(kind)
    backward = alone.select(
        "permno", F.col("date").alias("observed_date"), none("date").alias("event_date"), none("date").alias("return_storage_date"),
        F.lit("NO_MATCHING_EVENT").alias("storage_date_basis"), F.col("date").alias("actual_daily_date"), "delist_flag", "ret_total",
        none("double").alias("delisting_return"), "ret_missing_flag", none("string").alias("event_ret_missing_flag"), F.lit("UNMATCHED_TERMINAL_EVENT").alias("reconciliation_status"),
    )
    return forward.unionByName(backward)


def universe_flags(panel: DataFrame, history: DataFrame) -> DataFrame:
    """Rows with their attributes by intervals that have an end, and universe flags, null
    where no interval matches."""
    joined = interval_join(panel, history, open_end=False).drop("_key")
    primary = F.col("primary_exchange").isin("N", "A", "Q")
    active, regular = F.col("trading_status_flag") == "A", F.col("conditional_type") == "RW"
    return joined.withColumns(
        {"is_common_stock": q.common_stock(), "is_primary_exchange": primary, "is_active": active, "is_regular_way": regular}
    ).withColumn("is_investable", F.col("is_common_stock") & F.col("is_primary_exchange") & F.col("is_active") & F.col("is_regular_way"))
