"""Long series in segments: the unbounded windows of an entity as a scan over mergeable states.

The windows of ``factors`` and ``index`` keep all rows of an entity in one task. Here its rows
are cut into segments of SIZE sessions. Each segment gives a small state (first seed, last
session, missing returns, total losses, log growth, ended); the states of an entity are
scanned in order, some hundred times fewer than its rows, and each segment then finishes
alone with the state that all before it have left. So one entity spreads over all tasks.

Between runs the state is stored: ``operators.monthly`` continues a series from the state at
the end of a month with the same functions. Entities are not null (a row without one is left
alone with its segment).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from . import index as ix
from .factors import log_growth

SIZE = 4096
KEY = "permno"


def cut(df: DataFrame, size: int = SIZE) -> DataFrame:
    return df.withColumn("_segment", F.floor(F.col("session_index") / size))


def inside(*frame: int) -> WindowSpec:
    """The rows of an entity's segment by session."""
    w = Window.partitionBy(KEY, "_segment").orderBy("session_index")
    return w.rowsBetween(*frame) if frame else w


UPTO = (Window.unboundedPreceding, 0)


def scanned(df: DataFrame, states: dict[str, tuple[Column, str]]) -> DataFrame:
    """Adds to each row what all earlier segments of its entity have left: ``name`` holds the
    aggregate of a segment, merged over the segments before by min, max, sum or bool_or."""
    own = df.groupBy(KEY, "_segment").agg(*(value.alias(name) for name, (value, _) in states.items()))
    before = Window.partitionBy(KEY).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    left = own.select(KEY, "_segment", *(getattr(F, how)(name).over(before).alias(name) for name, (_, how) in states.items()))
    return df.join(left.hint("merge"), [KEY, "_segment"], "left")


def ending() -> Column:
    return (F.col("ret_total_backtest") == -1) | (F.col("delist_flag") == "Y")


def ended_after(df: DataFrame) -> DataFrame:
    """Adds ``economic_series_ended`` to rows with ``_ended`` from before their segment."""
    here = F.bool_or(ending()).over(inside(*UPTO))
    return df.withColumn("economic_series_ended", F.coalesce(F.col("_ended") | here, F.col("_ended"), here, F.lit(False)))


def series_ended(panel: DataFrame, size: int = SIZE) -> DataFrame:
    """As ``factors.series_ended``."""
    return ended_after(scanned(cut(panel, size), {"_ended": (F.bool_or(ending()), "bool_or")})).drop("_ended", "_segment")


def windowed(df: DataFrame, lookback: int) -> DataFrame:
    """Adds ``has_required_history`` and ``momentum`` to rows that stand with the last sessions
    before their segment; those are marked ``_halo`` and are dropped."""
    w = inside().rangeBetween(1 - lookback, 0)
    r = F.col("ret_total_for_signal")
    seen = {"_n": F.count(F.lit(1)).over(w), "_valid": F.count(r).over(w), "_losses": F.count(F.when(r == -1, 1)).over(w), "_log": F.sum(log_growth(r)).over(w)}
    whole = ~F.col("economic_series_ended") & (F.col("_n") == lookback) & (F.col("_valid") == lookback)
    value = F.when(F.col("_losses") > 0, -1.0).otherwise(F.exp("_log") - 1)
    out = df.withColumns(seen).withColumn("has_required_history", whole).withColumn("momentum", F.when(F.col("has_required_history"), value))
    return out.where(~F.col("_halo")).drop("_halo", *seen)


def momentum(panel: DataFrame, lookback: int, size: int = SIZE) -> DataFrame:
    """Adds what ``factors.momentum`` does, without its counts. The last sessions of a segment
    are copied to the next one, ``lookback`` in ``size`` rows."""
    size = max(size, lookback)
    own = cut(series_ended(panel, size), size).withColumn("_halo", F.lit(False))
    tail = own.where(F.col("session_index") % size > size - lookback).withColumns({"_segment": F.col("_segment") + 1, "_halo": F.lit(True)})
    return windowed(own.unionByName(tail), lookback).drop("_segment")


def seeded(df: DataFrame) -> DataFrame:
    """Adds ``seed_date`` and ``gap`` by ``_seed`` and ``_last``, the first seed and the last
    session before the segment. A later seed of the segment itself is one for its own rows."""
    first = F.min(ix.seedable()).over(Window.partitionBy(KEY, "_segment"))
    before = F.coalesce(F.lag("session_index").over(inside()), F.col("_last"))
    return df.withColumns({"seed_date": F.coalesce(F.col("_seed"), first), "gap": F.col("session_index") - before != 1})


def totals(df: DataFrame, steps: dict[str, Column]) -> DataFrame:
    """Adds running totals: what came before the segment (``<name>_before``) and its own steps."""
    before = {name: F.coalesce(F.col(name + "_before"), F.lit(0)) for name in steps}
    return df.withColumns({name: before[name] + F.sum(step).over(inside(*UPTO)) for name, step in steps.items()})


def wealth_path(panel: DataFrame, size: int = SIZE) -> DataFrame:
    """As ``index.wealth_path``: one scan for seeds and last sessions, one for the totals."""
    first = scanned(cut(panel, size), {"_seed": (F.min(ix.seedable()), "min"), "_last": (F.max("session_index"), "max")})
    marked = seeded(first)
    steps = ix.steps()
    return ix.path_of(totals(scanned(marked, {name + "_before": (F.sum(step), "sum") for name, step in steps.items()}), steps))


def compound_returns(df: DataFrame, ret: str = "ret_total", initial: float = 1.0, name: str = "wealth", size: int = SIZE) -> DataFrame:
    """As ``index.compound_returns``."""
    r = F.col(ret)
    steps = {"_missing": F.when(r.isNull(), 1).otherwise(0), "_lost": F.when(r == -1, 1).otherwise(0), "_growth": log_growth(r)}
    out = totals(scanned(cut(df, size), {n + "_before": (F.sum(step), "sum") for n, step in steps.items()}), steps)
    value = F.when(F.col("_missing") > 0, F.lit(None).cast("double")).when(F.col("_lost") > 0, 0.0).otherwise(initial * F.exp("_growth"))
    return out.withColumn(name, value).select(*df.columns, name)
