"""Wealth paths and rebased indices, for display only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.quality import finite, first_match
from .factors import by_session, log_growth
from .joins import with_base


def seedable() -> Column:
    """The date of an ordinary row with a finite positive price, else null."""
    return F.when((F.col("price_raw") > 0) & finite("price_raw") & (F.col("delist_flag") == "N"), F.col("date"))


def seed_date(panel: DataFrame) -> DataFrame:
    """Adds the first date with a finite positive price on an ordinary row."""
    return panel.withColumn("seed_date", F.min(seedable()).over(Window.partitionBy("permno")))


def path_of(marked: DataFrame) -> DataFrame:
    """The path by ``seed_date`` and, up to each row, the missing returns and gaps ``_broken``,
    the total losses ``_lost`` and the log growth ``_growth`` since the seed."""
    early = F.col("seed_date").isNull() | (F.col("date") < F.col("seed_date"))
    status = first_match([(early, "NO_VALID_ANCHOR"), (F.col("_broken") > 0, "MISSING_RETURN_OR_SESSION_GAP"), (F.col("_lost") > 0, "ZERO_WEALTH")], F.lit("VALID"))
    out = marked.withColumn("index_status", status)
    value = F.when(F.col("index_status") == "ZERO_WEALTH", 0.0).when(F.col("index_status") == "VALID", F.exp("_growth"))
    return out.select("permno", "date", "session_index", F.when(~early, F.col("seed_date")).alias("index_anchor_date"), value.alias("wealth_index"), "index_status")


def steps(c: str = "ret_total_backtest") -> dict[str, Column]:
    """What a row after the seed adds to ``_broken``, ``_lost`` and ``_growth``, by its ``gap``."""
    after, r = F.col("date") > F.col("seed_date"), F.col(c)
    return {
        "_broken": F.when(after & (r.isNull() | F.col("gap")), 1).otherwise(0),
        "_lost": F.when(after & (r == -1), 1).otherwise(0),
        "_growth": F.when(after, log_growth(r)).otherwise(0.0),
    }


def wealth_path(panel: DataFrame) -> DataFrame:
    """Growth since the seed, whose own return doesn't count. A missing return or a session
    gap makes it null for good, a total loss 0 for good."""
    upto = by_session(Window.unboundedPreceding, 0)
    gap = F.col("session_index") - F.lag("session_index").over(by_session()) != 1
    marked = seed_date(panel).withColumn("gap", gap)
    return path_of(marked.withColumns({name: F.sum(step).over(upto) for name, step in steps().items()}))


def rebase(wealth: DataFrame, base_date: str) -> DataFrame:
    """The index at 100 on a base date that the entity was observed on, and why not otherwise."""
    out = with_base(wealth, base_date, ["wealth_index"])
    base, own = F.col("base_wealth_index"), F.col("wealth_index")
    status = first_match(
        [(~F.col("has_base"), "BASE_OBSERVATION_ABSENT"), (base.isNull(), "BASE_VALUE_MISSING"), (base == 0, "BASE_VALUE_ZERO"), (own.isNull(), "PATH_INCOMPLETE")],
        F.lit("VALID"),
    )
    late = ~F.col("has_base") & (F.col("index_anchor_date") > F.lit(base_date).cast("date"))
    return out.withColumns(
        {"index_base100": F.when((base > 0) & finite(base), 100 * own / base), "rebase_status": status, "later_first_valid_base100": F.when(late, 100 * own)}
    )


def rebase_with_fallback(index: DataFrame, base_date: str, fallback: str = "none") -> DataFrame:
    """As ``rebase``; with ``first_valid_after_base`` a missing base gives way to the first
    positive value after it. A base of zero has no fallback."""
    day, own = F.lit(base_date).cast("date"), Window.partitionBy("permno")
    value = F.col("wealth_index")
    at_base = F.max(F.when(F.col("date") == day, value)).over(own)
    later = (F.col("date") > day) & (value > 0)
    first = F.min(F.when(later, F.col("date"))).over(own)
    out = index.withColumns({"_base": at_base, "_first": first, "_first_value": F.min_by(F.when(later, value), F.when(later, F.col("date"))).over(own)})
    missing = F.col("_base").isNull()
    use = missing & F.col("_first").isNotNull() & F.lit(fallback == "first_valid_after_base")
    status = first_match([(F.col("_base") == 0, "zero_base"), (use, "first_valid_after_base"), (missing, "missing_base")], F.lit("exact_base"))
    chosen = F.when(use, F.col("_first_value")).otherwise(F.nullif(F.col("_base"), F.lit(0.0)))
    return out.withColumns(
        {"status": status, "actual_base_date": F.when(use, F.col("_first")).when(F.col("_base") > 0, day), "rebased": 100 * (value / chosen)}
    ).drop("_base", "_first", "_first_value")


def compound_returns(df: DataFrame, ret: str = "ret_total", initial: float = 1.0, name: str = "wealth") -> DataFrame:
    """Wealth after each row of an entity: null for good once a return is missing, 0 for good
    after a total loss. The rows of a key are read in session order."""
    upto, r = by_session(Window.unboundedPreceding, 0), F.col(ret)
    missing = F.count(F.when(r.isNull(), 1)).over(upto)
    lost = F.count(F.when(r == -1, 1)).over(upto)
    growth = F.exp(F.sum(log_growth(r)).over(upto))
    return df.withColumn(name, F.when(missing > 0, F.lit(None).cast("double")).when(lost > 0, 0.0).otherwise(initial * growth))


def portfolio_index(df: DataFrame, ret: str = "ret_total", initial: float = 100.0) -> DataFrame:
    """``permno, step, index``: the initial mark at step 0, then the compounded returns."""
    step = F.row_number().over(by_session()).cast("bigint")
    path = compound_returns(df, ret, initial, "index").withColumn("step", step).select("permno", "step", "index")
    start = df.select("permno").distinct().select("permno", F.lit(0).cast("bigint").alias("step"), F.lit(initial).alias("index"))
    return start.unionByName(path)
