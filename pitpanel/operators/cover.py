"""From overlapping intervals to a disjoint cover."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import interval_join
from .normalize import open_end as end_of

END = "9999-12-31"


def disjoint_cover(hist: DataFrame, key: str = "permno", frm: str = "valid_from", to: str = "valid_to", policy: str = "latest") -> DataFrame:
    """The columns of ``hist`` over disjoint pieces of time, and ``covers``, how many intervals
    hold a piece. Pieces begin and end where an interval does.

    A piece has the columns of the interval that starts last, of several the one that ends
    last, then that of the greatest row; with ``policy="reject"`` pieces with more than one
    interval are left out. A null end is open and stays null. Rows without a key or a start and
    those that end before they start cover nothing; repeated rows count each. ``hist`` has no
    column ``covers``.

    Starts and ends of a day are added up before a key's days are ordered, so a key has a row
    a day at most there. The interval that started last is known from that pass; only where
    it has ended before the piece are the others looked up, by ``interval_join``.
    """
    if policy not in ("latest", "reject"):
        raise ValueError(f"unknown policy {policy}")
    last = F.lit(END).cast("date")
    held = hist.where(F.col(key).isNotNull() & F.col(frm).isNotNull()).select(
        F.col(key).alias("_k"), F.col(frm).cast("date").alias("_from"), end_of(F.col(to)).cast("date").alias("_end"), F.struct(*hist.columns).alias("_row")
    )
    held = held.where(F.col("_end") >= F.col("_from"))
    top = F.struct("_from", "_end", "_row")
    starts = held.select("_k", F.col("_from").alias("_at"), F.lit(1).alias("_step"), top.alias("_top"))
    ends = held.where(F.col("_end") < last).select("_k", F.date_add("_end", 1).alias("_at"), F.lit(-1).alias("_step"), F.lit(None).cast(starts.schema["_top"].dataType).alias("_top"))
    days = starts.unionByName(ends).groupBy("_k", "_at").agg(F.sum("_step").alias("_step"), F.max("_top").alias("_top"))
    line = Window.partitionBy("_k").orderBy("_at")
    upto = line.rowsBetween(Window.unboundedPreceding, 0)
    pieces = days.select("_k", "_at", F.date_sub(F.lead("_at").over(line), 1).alias("_until"), F.sum("_step").over(upto).alias("covers"), F.max("_top").over(upto).alias("_top"))
    pieces = pieces.where("covers > 0" if policy == "latest" else "covers = 1")
    known = F.col("_top._end") >= F.col("_at")
    sure = pieces.where(known).select("_k", "_at", "_until", "covers", F.col("_top._row").alias("_row"))
    open_ones = pieces.where(~known).select("_k", "_at", "_until", "covers")
    others = held.select("_k", "_from", "_end", "_row")
    met = interval_join(open_ones, others, "_k", "_at", "_from", "_end", how="inner")
    found = met.groupBy(open_ones["_k"], "_at", "_until", "covers").agg(F.max(top)["_row"].alias("_row"))
    own = {frm: F.col("_at"), to: F.col("_until")}
    return sure.unionByName(found).select(*(own.get(c, F.col(f"_row.`{c}`")).alias(c) for c in hist.columns), "covers")
