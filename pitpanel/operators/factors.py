"""Rolling windows that never skip a missing return, never bridge a gap, and end for good at
a loss of everything or a terminal row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def by_session(*frame: int) -> WindowSpec:
    """An entity's rows by session. All windows order alike, so Spark sorts once for them."""
    w = Window.partitionBy("permno").orderBy("session_index")
    return w.rowsBetween(*frame) if frame else w


def log_growth(c: str | Column) -> Column:
    """log(1 + r), and 0 for a null return or a loss of everything, which are counted apart."""
    r = F.col(c) if isinstance(c, str) else c
    return F.when(r > -1, F.log(1 + r)).otherwise(0.0)


def rolling_stats(panel: DataFrame, lookback: int) -> DataFrame:
    w = by_session(1 - lookback, 0)
    r = F.col("ret_total_for_signal")
    return panel.withColumns(
        {
            "window_rows": F.count(F.lit(1)).over(w),
            "valid_rows": F.count(r).over(w),
            "first_session": F.min("session_index").over(w),
            "loss_rows": F.count(F.when(r == -1, 1)).over(w),
            "log_growth": F.sum(log_growth(r)).over(w),
        }
    )


def series_ended(panel: DataFrame, upto: int = 0) -> DataFrame:
    """Adds whether a total loss or a terminal row has occurred, up to ``upto`` rows ahead."""
    end = (F.col("ret_total_backtest") == -1) | (F.col("delist_flag") == "Y")
    return panel.withColumn("economic_series_ended", F.coalesce(F.bool_or(end).over(by_session(Window.unboundedPreceding, upto)), F.lit(False)))


def momentum(panel: DataFrame, lookback: int) -> DataFrame:
    """Adds the compounded return of the last ``lookback`` sessions and whether all of them
    are there, valid, without a gap, in a series that has not ended."""
    out = rolling_stats(series_ended(panel), lookback)
    whole = (F.col("window_rows") == lookback) & (F.col("valid_rows") == lookback) & (F.col("session_index") - F.col("first_session") == lookback - 1)
    out = out.withColumn("has_required_history", ~F.col("economic_series_ended") & whole)
    value = F.when(F.col("loss_rows") > 0, -1.0).otherwise(F.exp("log_growth") - 1)
    return out.withColumn("momentum", F.when(F.col("has_required_history"), value))


def rolling_momentum(df: DataFrame, lookback: int, ret: str = "ret_total") -> DataFrame:
    """Momentum of rows that already stand on consecutive sessions. The row of a total loss
    still reports -1; later rows report nothing."""
    own, before = by_session(1 - lookback, 0), by_session(Window.unboundedPreceding, -1)
    r = F.col(ret)
    ended = F.coalesce(F.bool_or(r == -1).over(before), F.lit(False))
    full = (F.count(F.lit(1)).over(own) == lookback) & (F.count(r).over(own) == lookback) & ~ended
    value = F.when(F.min(r).over(own) == -1, -1.0).otherwise(F.exp(F.sum(log_growth(r)).over(own)) - 1)
    return df.withColumn("momentum", F.when(full, value))


def factors_upto(cached: DataFrame, end: str) -> DataFrame:
    """A longer cached factor table cut at ``end``: every frame looks back, so rows stay right."""
    return cached.where(F.col("date") <= F.lit(end).cast("date"))
