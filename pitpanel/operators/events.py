"""Event evidence, classifications, held outcomes and accounting steps, as Columns and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import quality as q
from ..schemas import ContractError


def event_evidence(panel: DataFrame) -> DataFrame:
    """A row for each daily row that an economic event may lie behind."""
    flag, terminal = F.col("distribution_return_flag"), q.is_terminal()
    some = panel.where(q.differs("delist_flag", F.lit("N")) | ~flag.isin("NO", "NA") | flag.isNull())
    codes = q.literal_map({k: "|".join(v) or "none" for k, v in q.DISTRIBUTION_EFFECTS.items()})
    effect = F.coalesce(q.literal_map(q.TERMINAL_ACTIONS)[F.col("action_type")], F.when(terminal, F.lit("unknown_terminal_action")), codes[flag], F.lit("unknown"))
    return some.select(
        "permno", F.col("date").alias("observed_date"), F.col("terminal_event_date").alias("effective_date"), "terminal_reconciliation",
        F.when(F.col("terminal_event_date").isNotNull(), "SOURCE_EVENT_DATE").otherwise("UNKNOWN_DAILY_IMPACT_DATE_ONLY").alias("effective_date_basis"),
        F.lit(None).cast("timestamp").alias("announced_at"), "return_available_at", flag.alias("source_code"), "action_type", "successor_permno",
        effect.alias("effect"),
        F.when(F.col("return_quality") == "VALID_VENDOR_RETURN", "VENDOR_RETURN_ONCE").otherwise("INCOMPLETE").alias("research_status"),
        F.lit("UNSUPPORTED").alias("event_ledger_status"), "ret_total_vendor", "ret_total_backtest", "return_quality",
    )


# Categories of explicit event types that are known but carry no terms.
DETAILED = ("split", "reverse_split", "stock_dividend", "cash_dividend", "merger", "stock_exchange", "spin_off", "rights_distribution")


def classify_events(events: DataFrame) -> DataFrame:
    """Adds category, status, reason and ledger status. A known action code gives the
    category; without a code an ``event_type`` column, if there, does. A successor is kept
    but never linked."""
    code = F.col("action_type")
    explicit = F.col("event_type") if "event_type" in events.columns else F.lit(None).cast("string")
    by_code = q.literal_map(q.TERMINAL_ACTIONS)[code]
    category = F.coalesce(by_code, F.when(code.isNull(), explicit), F.lit("unknown"))
    identity = F.col("category").isin("ticker_change", "name_change")
    known = F.col("category").isin(*DETAILED, "lost_source", "unknown")
    supported = F.coalesce(code.isin(*q.SUPPORTED_ACTIONS), F.lit(False))
    out = events.withColumn("category", category).withColumns(
        {
            "event_status": q.first_match([(supported, "requires_return_reconciliation"), (identity, "identity_only")], F.lit("unsupported")),
            "event_reason": q.first_match(
                [
                    (supported, "matched terminal return only"), (identity, "no economic posting"), (F.col("category") == "unknown", "unknown code"),
                    (F.col("category") == "lost_source", "no final recovery value"), (~known, "unsupported type"),
                ],
                F.lit("terms are absent"),
            ),
            "event_ledger_status": F.when(identity & ~supported, "no_posting_required").otherwise("unsupported"),
            "successor_auto_linked": F.lit(False),
        }
    )
    return out.withColumn("category", F.when(supported | identity | known, F.col("category")).otherwise("unknown"))


def classify_distributions(daily: DataFrame) -> DataFrame:
    """Adds the effects of the daily distribution code and how they may be used."""
    out = daily.withColumn("effects", F.coalesce(q.effects(), F.array(F.lit("unknown"))))
    valid = (q.return_validity("ret_total") == "VALID") & F.col("ret_missing_flag").eqNullSafe(F.lit("NA"))
    some = F.size("effects") > 0
    status = q.first_match([(F.array_contains("effects", "unknown"), "unknown"), (~some, "none"), (valid, "vendor_return_only")], F.lit("missing_return"))
    return out.withColumns({"distribution_status": status, "distribution_ledger": F.when(some, "unsupported").otherwise("no_posting_required"), "terms_incomplete": some})


def resolve_returns(daily: DataFrame, events: DataFrame, fail: bool = False) -> DataFrame:
    """Daily rows with the event of their entity stored on their date, the released return
    and why it is held back. Contradictions between the two are named in ``violation``;
    with ``fail`` any of them raises."""
    e = events.select("permno", F.lit(True).alias("has_event"), "event_date", F.col("return_storage_date").alias("date"), "delisting_return", "action_type", "event_missing_flag_present", "event_ret_missing_flag")
    out = daily.join(e, ["permno", "date"], "left").withColumn("has_event", F.coalesce("has_event", F.lit(False)))
    quality, theirs = q.return_validity("ret_total"), q.return_validity("delisting_return")
    terminal = F.coalesce(q.is_terminal(), F.lit(False))
    matched = terminal & F.col("has_event")
    violation = q.first_match(
        [
            (matched & (F.col("event_date") >= F.col("date")), "STORAGE_NOT_AFTER_EVENT"),
            (matched & (quality == "VALID") & (theirs == "VALID") & (F.col("ret_total") != F.col("delisting_return")), "RETURNS_DISAGREE"),
            (matched & (quality != theirs), "VALIDITY_DISAGREES"),
            (matched & F.col("event_missing_flag_present") & q.differs("event_ret_missing_flag", "ret_missing_flag"), "MISSING_FLAGS_DISAGREE"),
        ]
    )
    issue = q.daily_return_issue()
    plain = F.when(issue.isin("MISSING_RETURN", "INVALID_RETURN"), quality).otherwise(issue)
    reason = (
        F.when(terminal & ~F.col("has_event"), "UNRECONCILED_TERMINAL_RETURN")
        .when(matched & ~F.coalesce(F.col("action_type").isin(*q.SUPPORTED_ACTIONS), F.lit(False)), "UNSUPPORTED_TERMINAL_EVENT")
        .when(matched & (quality == "MISSING"), "MISSING_TERMINAL_RETURN")
        .when(matched & (quality != "VALID"), quality)
        .when(matched & F.col("event_missing_flag_present") & q.differs("event_ret_missing_flag", F.lit("NA")), "INCOMPLETE_EVENT_RETURN")
        .otherwise(plain)
    )
    out = out.withColumns({"violation": violation, "return_validity": quality, "review_reason": reason})
    out = out.withColumns(
        {
            "ret_released": F.when(F.col("review_reason").isNull() & F.col("violation").isNull(), F.col("ret_total")),
            "usable_as_feature": ~terminal & F.col("review_reason").isNull(),
        }
    )
    if fail and not out.where("violation is not null").isEmpty():
        raise ContractError("daily rows and terminal events contradict each other")
    return out


def identity_changes(history: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Intervals whose ticker differs from the one before; an entity's first is none."""
    own = Window.partitionBy("permno").orderBy("valid_from")
    out = history.withColumn("previous_ticker", F.lag("ticker").over(own)).where(F.col("previous_ticker").isNotNull() & q.differs("ticker", "previous_ticker"))
    if start is not None:
        out = out.where(F.col("valid_from").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return out.select("permno", F.col("valid_from").alias("effective_date"), "previous_ticker", "ticker")


def held_outcomes(holdings: DataFrame, panel: DataFrame, accounting_mode: str = "total_return") -> DataFrame:
    """One row per expected holding (``interval_date, permno``): how many observations it has
    and why its outcome can't be used, null if it can. ``cash_shares`` also refuses whatever
    would need a settlement. All intervals are judged at once."""
    obs = panel.withColumns({"interval_date": F.col("date"), "_seen": F.lit(True)})
    joined = holdings.select("interval_date", "permno").join(obs, ["interval_date", "permno"], "left")
    copies = F.count("_seen").over(Window.partitionBy("interval_date", "permno"))
    terminal = F.coalesce(q.is_terminal(), F.lit(False))
    known = F.coalesce(F.col("distribution_return_flag").isin(*q.DISTRIBUTION_EFFECTS), F.lit(False))
    plain = F.coalesce(
        F.when(q.return_validity("ret_total_backtest") != "VALID", F.coalesce("return_quality", F.lit("MISSING_OR_INVALID_HELD_RETURN"))),
        F.when(~F.col("return_quality").isin("VALID", "VALID_VENDOR_RETURN"), F.col("return_quality")),
        q.first_match(
            [
                (F.col("requires_review"), "HELD_OUTCOME_REQUIRES_REVIEW"),
                (q.differs("ret_missing_flag", F.lit("NA")), "INCOMPLETE_VENDOR_RETURN"),
                (~F.coalesce(F.col("delist_flag").isin("N", "Y"), F.lit(False)), "UNKNOWN_DELISTING_FLAG"),
                (terminal & ~F.coalesce(F.col("terminal_reconciliation").isin(*q.MATCHED), F.lit(False)), "UNRECONCILED_TERMINAL_RETURN"),
                (~known, "UNKNOWN_HELD_DISTRIBUTION"),
                (terminal & ~F.coalesce(F.col("action_type").isin(*q.SUPPORTED_ACTIONS), F.lit(True)), "UNSUPPORTED_TERMINAL_EVENT"),
            ]
        ),
    )
    settled = terminal | F.coalesce(F.col("event_terms_incomplete"), F.lit(False)) | F.coalesce(F.col("ledger_status") == "unsupported", F.lit(False))
    cash = F.when(settled, "UNSUPPORTED_CASH_SHARE_SETTLEMENT") if accounting_mode == "cash_shares" else F.lit(None).cast("string")
    reason = F.when(F.col("_seen").isNull(), "MISSING_HELD_SECURITY").otherwise(F.coalesce(cash, plain, F.when(F.col("observations") > 1, "DUPLICATE_HELD_OBSERVATION")))
    judged = joined.withColumn("observations", copies).withColumn("reason", reason)
    return judged.groupBy("interval_date", "permno").agg(F.max("observations").alias("observations"), F.min("reason").alias("reason"))


def apply_splits(positions: DataFrame, splits: DataFrame) -> DataFrame:
    """Positions (``permno, date, shares``) with verified ratios (``permno, date, ratio``) applied
    on their date; what is not finite or has no positive ratio is a violation, not a quantity."""
    out = positions.join(splits, ["permno", "date"], "left")
    ok = q.finite("shares") & (F.col("ratio").isNull() | (q.finite("ratio") & (F.col("ratio") > 0)))
    quantity = F.col("shares") * F.coalesce("ratio", F.lit(1.0))
    bad = ~F.coalesce(ok & q.finite(quantity), F.lit(False))
    return out.withColumns({"adjusted_shares": F.when(~bad, quantity), "violation": bad})


def wealth_step(df: DataFrame, wealth: str = "wealth", ret: str = "ret_total", cash: str | None = None) -> DataFrame:
    """Adds ``wealth * (1 + return)``; an invalid return or a cash posting is a violation."""
    bad = (q.return_validity(ret) != "VALID") | ~F.coalesce(q.finite(wealth) & (F.col(wealth) >= 0), F.lit(False))
    if cash is not None:
        bad = bad | (F.coalesce(F.col(cash), F.lit(0.0)) != 0)
    return df.withColumns({"wealth_after": F.when(~bad, F.col(wealth) * (1 + F.col(ret))), "violation": bad})
