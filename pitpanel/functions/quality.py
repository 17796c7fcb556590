"""Return-quality grades and other predicates as Columns. All keep three-valued logic."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes of the daily distribution flag and what they stand for.
DISTRIBUTION_EFFECTS = {
    "C1": ("cash_dividend",),
    "C2": ("cash_dividend",),
    "CS": ("cash_dividend", "split_or_stock_dividend"),
    "D1": ("delisting",),
    "D2": ("delisting",),
    "F1": ("non_split_share_factor",),
    "M2": ("multiple_actions",),
    "MU": ("multiple_actions",),
    "N1": ("non_ordinary_distribution",),
    "NA": (),
    "NO": (),
    "O1": ("other_action",),
    "P1": ("non_split_price_factor",),
    "S1": ("split_or_stock_dividend",),
    "S2": ("split_or_stock_dividend",),
    "T1": ("tender_offer",),
}
# Codes of terminal actions; the returns of these four kinds can be supported.
TERMINAL_ACTIONS = {
    "MER": "merger_or_stock_exchange",
    "GEX": "security_exchange",
    "GLI": "liquidation",
    "GDR": "delisting",
    "LOS": "lost_source",
}
SUPPORTED_ACTIONS = ("GDR", "GEX", "GLI", "MER")
MATCHED = ("MATCHED_VALUE", "MATCHED_NULL")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c: Column | str) -> Column:
    """Whether a double is neither NaN nor infinite; null for null."""
    return F.abs(col(c)) < F.lit(float("inf"))


def differs(a: Column | str, b: Column | str) -> Column:
    """Null-safe inequality: never null."""
    return ~col(a).eqNullSafe(col(b))


def literal_map(names: dict[str, object]) -> Column:
    return F.create_map(*(F.lit(x) for pair in names.items() for x in pair))


def first_match(rules: list[tuple[Column, str]], otherwise: Column | None = None) -> Column:
    """The code of the first rule that is true."""
    out = reduce(lambda so_far, rule: so_far.when(rule[0], F.lit(rule[1])), rules[1:], F.when(rules[0][0], F.lit(rules[0][1])))
    return out if otherwise is None else out.otherwise(otherwise)


def return_validity(c: Column | str) -> Column:
    """VALID, MISSING, NONFINITE or BELOW_MINUS_ONE; zero and -1 are valid."""
    r = col(c)
    return first_match([(r.isNull(), "MISSING"), (~finite(r), "NONFINITE"), (r < -1, "BELOW_MINUS_ONE")], F.lit("VALID"))


def daily_return_issue() -> Column:
    """First defect of a daily row's return and flags, null if none."""
    r, known = F.col("ret_total"), F.col("distribution_return_flag").isin(*DISTRIBUTION_EFFECTS)
    return first_match(
        [
            (r.isNull(), "MISSING_RETURN"),
            (~finite(r) | (r < -1), "INVALID_RETURN"),
            (differs("ret_missing_flag", F.lit("NA")), "INCOMPLETE_VENDOR_RETURN"),
            (~F.coalesce(known, F.lit(False)), "UNKNOWN_DISTRIBUTION_FLAG"),
            (~F.coalesce(F.col("delist_flag").isin("N", "Y"), F.lit(False)), "UNKNOWN_DELISTING_FLAG"),
        ]
    )


def is_terminal() -> Column:
    """Whether a row stores a terminal outcome; null for a null flag."""
    return F.col("delist_flag") == "Y"


def terminal_state() -> Column:
    """How a terminal row and its matched event agree. An unmatched event's columns are null
    and ``event_matched`` is false."""
    return first_match(
        [
            (differs("delist_flag", F.lit("Y")), "NOT_TERMINAL_RETURN"),
            (~F.col("event_matched"), "UNMATCHED_TERMINAL_EVENT"),
            (differs("ret_total", "delisting_return"), "TERMINAL_RETURN_MISMATCH"),
            (F.col("event_missing_flag_present") & differs("ret_missing_flag", "event_ret_missing_flag"), "TERMINAL_MISSING_FLAG_MISMATCH"),
            (F.col("ret_total").isNull(), "MATCHED_NULL"),
        ],
        F.lit("MATCHED_VALUE"),
    )


def return_quality() -> Column:
    """The grade of a row: a failed reconciliation, else the daily issue, else what the
    event lacks, else VALID_VENDOR_RETURN."""
    return F.coalesce(
        F.when(is_terminal() & ~F.col("terminal_reconciliation").isin(*MATCHED), F.col("terminal_reconciliation")),
        daily_return_issue(),
        first_match(
            [
                (is_terminal() & ~F.coalesce(F.col("action_type").isin(*SUPPORTED_ACTIONS), F.lit(False)), "UNSUPPORTED_TERMINAL_EVENT"),
                (is_terminal() & F.col("event_missing_flag_present") & differs("event_ret_missing_flag", F.lit("NA")), "INCOMPLETE_EVENT_RETURN"),
            ]
        ),
        F.lit("VALID_VENDOR_RETURN"),
    )


def metadata_quality() -> Column:
    return first_match([(F.col("has_metadata"), "EFFECTIVE_INTERVAL_APPROXIMATE_PIT"), (is_terminal(), "TERMINAL_OUTSIDE_METADATA")], F.lit("MISSING_METADATA"))


def common_stock() -> Column:
    return (
        (F.col("share_type") == "NS") & (F.col("security_type") == "EQTY") & (F.col("security_subtype") == "COM")
        & (F.col("us_incorporated_flag") == "Y") & F.col("issuer_type").isin("ACOR", "CORP")
    )


def baseline_eligible() -> Column:
    """A common stock, traded regular-way on a primary exchange; false without metadata."""
    traded = F.col("primary_exchange").isin("N", "A", "Q") & (F.col("trading_status_flag") == "A") & (F.col("conditional_type") == "RW")
    return F.coalesce(common_stock() & traded, F.lit(False))


def effects(flag: Column | str = "distribution_return_flag") -> Column:
    """The effects of a distribution code as an array; null for an unknown code."""
    return F.coalesce(*(F.when(col(flag) == code, F.array(*map(F.lit, found)).cast("array<string>")) for code, found in DISTRIBUTION_EFFECTS.items()))
