"""Joins: validity intervals, events, sessions, existence, base dates."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import ContractError
from .normalize import open_end as end_of

#: An end from here on counts as open when lengths are measured.
FAR = datetime.date(9000, 1, 1)
EPOCH = datetime.date(1970, 1, 1)


#: Keys with at least so many intervals are joined by time buckets, the KEYS with most of them
#: at most: their widths are broadcast, a row of some 40 bytes each, so that table is bounded.
MANY, KEYS = 64, 1 << 16


def bucket_widths(hist: DataFrame, key: str, frm: str, end: Column, many: int = MANY, keys: int = KEYS) -> DataFrame:
    """``_key, _lo, _hi, _width`` of the keys with many intervals: the first start, the last
    bound that isn't open, and the mean length of the intervals in days, cut at ``_hi``.

    With the mean as width a key's intervals touch two buckets more than it has intervals
    for each of them, on average, and a row meets about twice the intervals that hold it.
    """
    is_open, days = end >= F.lit(FAR), lambda at: F.datediff(at, F.lit(EPOCH)).cast("long")
    bounds = hist.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(frm).alias("_lo"),
        F.greatest(F.max(frm), F.max(F.when(~is_open, end))).alias("_hi"),
        F.count_if(is_open).alias("_open"),
        F.sum(F.when(is_open, 0).otherwise(days(end)) - days(F.col(frm))).alias("_days"),
    )
    width = F.greatest(F.lit(1), F.ceil((F.col("_days") + F.col("_open") * days(F.col("_hi"))) / F.col("_n")))
    most = bounds.where(F.col("_n") >= many).orderBy(F.desc("_n"), key).limit(keys)
    return most.select(F.col(key).alias("_key"), "_lo", "_hi", width.cast("long").alias("_width"))


def interval_join(
    df: DataFrame, hist: DataFrame, key: str = "permno", date: str = "date", frm: str = "valid_from", to: str = "valid_to",
    open_end: bool = True, how: str = "left", many: int = MANY,
) -> DataFrame:
    """Each row with the intervals of its key that hold its date, ends included; ``_key`` is
    null where none does. A null end is open, or matches nothing with ``open_end=False``;
    null keys and dates match nothing, intervals may overlap.

    Keys with few intervals are joined by the key, and the range is tested within. A key with
    many is cut into buckets of time: its intervals go to all buckets that they touch, a row to
    the one of its date, so a row meets few others than its own intervals, each match is found
    once, and the rows of one key spread over the tasks. Rows without a key spread likewise.
    """
    end = end_of(to) if open_end else F.col(to)
    h = hist.where(F.col(key).isNotNull() & (end >= F.col(frm)))
    widths = F.broadcast(bucket_widths(h, key, frm, end, many))
    place = lambda at: F.floor(F.datediff(F.greatest(F.least(at, F.col("_hi")), F.col("_lo")), F.col("_lo")) / F.col("_width"))
    touched = F.when(F.col("_width").isNotNull(), F.sequence(place(F.col(frm)), place(end))).otherwise(F.array(F.lit(0).cast("long")))
    carried = [F.col(c) for c in hist.columns if c != key]
    parts = h.join(widths, F.col(key) == F.col("_key"), "left").select(F.col(key).alias("_key"), *carried, F.explode(touched).alias("_part"))
    alone = F.when(F.col(key).isNull(), F.xxhash64(*df.columns) % 4096)
    own = df.join(widths, F.col(key) == F.col("_key"), "left").withColumn("_bucket", F.coalesce(alone, place(F.col(date)), F.lit(0))).drop("_key", "_lo", "_hi", "_width")
    inside = (own[date] >= parts[frm]) & (own[date] <= (end_of(parts[to]) if open_end else parts[to]))
    return own.join(parts, (own[key] == parts["_key"]) & (own["_bucket"] == parts["_part"]) & inside, how).drop("_bucket", "_part")


def interval_totals(
    df: DataFrame, hist: DataFrame, value: str, key: str = "permno", date: str = "date", frm: str = "valid_from", to: str = "valid_to", open_end: bool = True,
) -> DataFrame:
    """What ``interval_join`` finds, added up by key and date: ``rows`` of ``df``, and of the
    intervals that hold the date their number (``intervals``), how many have a ``value``
    (``valued``) and the sum of these (``total``, null if none has). Values are integers and are
    added up exactly; bounds and dates are dates. Null keys, dates and ends are as there.

    No pair is made: starts, ends and rows of a day are counted before a key's days are ordered,
    and running totals give what holds there. The work is that of one pass over both tables,
    however many intervals hold a row, and a key has a row a day at most.
    """
    end, kind = end_of(to) if open_end else F.col(to), "decimal(20,0)"
    held = hist.where(F.col(key).isNotNull() & (end >= F.col(frm))).select(key, F.col(frm).alias("_from"), end.alias("_end"), F.col(value).cast(kind).alias("_value"))

    def steps(rows: DataFrame, at: Column, sign: int) -> DataFrame:
        signed = F.col("_value") if sign > 0 else -F.col("_value")
        return rows.select(key, at.alias(date), F.lit(0).alias("_rows"), F.lit(sign).alias("_held"), F.when(signed.isNotNull(), sign).otherwise(0).alias("_valued"), signed.alias("_sum"))

    own = df.select(key, date, F.lit(1).alias("_rows"), F.lit(0).alias("_held"), F.lit(0).alias("_valued"), F.lit(None).cast(kind).alias("_sum"))
    line = own.unionByName(steps(held, F.col("_from"), 1)).unionByName(steps(held.where(F.col("_end") < F.expr("date '9999-12-31'")), F.date_add("_end", 1), -1))
    days = line.groupBy(key, date).agg(*(F.sum(c).alias(c) for c in ("_rows", "_held", "_valued", "_sum")))
    upto = Window.partitionBy(key).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    run = days.select(key, date, F.col("_rows").alias("rows"), F.sum("_held").over(upto).alias("intervals"), F.sum("_valued").over(upto).alias("valued"), F.sum("_sum").over(upto).alias("_sum"))
    return run.where("rows > 0").select(key, date, "rows", "intervals", "valued", F.when(F.col("valued") > 0, F.col("_sum")).alias("total"))


def carried_join(
    df: DataFrame, hist: DataFrame, key: str = "permno", date: str = "date", frm: str = "valid_from", to: str = "valid_to", open_end: bool = True,
) -> DataFrame:
    """As ``interval_join`` for histories whose intervals of a key are disjoint: both sides
    are ordered by date within the key and the last interval is carried forward, so a row
    meets one interval however many its key has. Rows without a key or date match none."""
    carried = [c for c in hist.columns if c != key]
    own = df.withColumns({"_at": F.col(date).cast("date"), "_row": F.struct(*df.columns), "_interval": F.lit(None).cast(hist.select(*carried).schema)})
    starts = hist.where(F.col(key).isNotNull() & F.col(frm).isNotNull()).select(
        F.col(key), F.col(frm).cast("date").alias("_at"), F.lit(None).cast(df.schema).alias("_row"), F.struct(*carried).alias("_interval")
    )
    line = starts.unionByName(own.select(key, "_at", "_row", "_interval"))
    # rows without a key meet nothing, so they are dealt out instead of sorted together
    spread = F.when(F.col(key).isNull(), F.xxhash64("_row") % 1024)
    upto = Window.partitionBy(key, spread).orderBy("_at", F.col("_row").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    found = line.withColumn("_interval", F.last("_interval", ignorenulls=True).over(upto)).where("_row is not null")
    end = F.col(f"_interval.{to}")
    inside = F.col(key).isNotNull() & (F.col("_at") <= (end_of(end) if open_end else end))
    return found.withColumn("_interval", F.when(inside, F.col("_interval"))).select("_row.*", *(F.col(f"_interval.{c}").alias(c) for c in carried))


def ambiguous(joined: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that a join has multiplied."""
    return joined.groupBy(*keys).agg(F.count(F.lit(1)).alias("matches")).where("matches > 1")


def assert_row_preserving(left: DataFrame, joined: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``joined`` itself; raises with some of the keys if its rows are not those of ``left``."""
    if left.count() != joined.count():
        raise ContractError(f"a join changed the rows; such keys: {ambiguous(joined, keys).limit(5).collect()}")
    return joined


def diagnose_unmatched(df: DataFrame, hist: DataFrame, key: str = "permno", date: str = "date", frm: str = "valid_from", to: str = "valid_to") -> DataFrame:
    """Per key: rows without an interval, their dates, and the bounds of the key's history."""
    bounds = hist.groupBy(key).agg(F.count(F.lit(1)).alias("intervals"), F.min(frm).alias("history_from"), F.max(end_of(to)).alias("history_to"))
    matched = interval_join(df.select(key, date), hist.select(key, frm, to), key, date, frm, to)
    rows = matched.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_key").isNull()).alias("unmatched"),
        F.min(F.when(F.col("_key").isNull(), F.col(date))).alias("first_unmatched"), F.max(F.when(F.col("_key").isNull(), F.col(date))).alias("last_unmatched"),
    )
    out = rows.where("unmatched > 0").join(bounds, key, "left").withColumn("intervals", F.coalesce("intervals", F.lit(0)).cast("bigint"))
    return out.withColumn("rate", F.col("unmatched") / F.col("rows"))


def match_events(panel: DataFrame, events: DataFrame) -> DataFrame:
    """Terminal rows with the event stored on their date; other rows match none."""
    e = events.select(F.col("permno").alias("_event_key"), *(c for c in events.columns if c != "permno"))
    on = (F.col("delist_flag") == "Y") & (panel["permno"] == e["_event_key"]) & (panel["date"] == e["return_storage_date"])
    return panel.join(e, on, "left").withColumn("event_matched", F.col("_event_key").isNotNull()).drop("_event_key")


def asof_sessions(obs: DataFrame, cal: DataFrame, offset: int) -> DataFrame:
    """Observations with the decision ``offset`` sessions later, if they are available by then."""
    later = cal.select((F.col("session_index") - offset).alias("session_index"), F.col("date").alias("decision_date"), "decision_time")
    return obs.join(later, "session_index").where(F.col("decision_time") >= F.col("available_at"))


def with_label_end(df: DataFrame, cal: DataFrame, horizon: int) -> DataFrame:
    """Rows with the session ``horizon`` later; those past the calendar drop out."""
    later = cal.select(
        (F.col("session_index") - horizon).alias("session_index"), F.col("date").alias("label_end_date"), F.col("close_at").alias("label_end_time"),
        F.col("available_at").alias("expected_available_at"),
    )
    return df.join(later, "session_index")


def attach_labels(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Every feature row, with its label if there is one."""
    marked = labels.withColumnRenamed("available_at", "label_available_at").withColumn("has_label", F.lit(True))
    return features.join(marked, ["permno", "decision_date"], "left").withColumn("has_label", F.coalesce("has_label", F.lit(False)))


def training_join(features: DataFrame, labels: DataFrame, audit: DataFrame) -> DataFrame:
    """Features and labels of the rows that the audit includes."""
    keys = ["permno", "decision_date"]
    parts = labels.select(*keys, "label_end_date", "label_end_time", F.col("available_at").alias("label_available_at"), "forward_vendor_return")
    return features.join(audit.where("training_included").select(*keys), keys).join(parts, keys)


def with_base(df: DataFrame, base_date: str, columns: Sequence[str]) -> DataFrame:
    """Adds the columns' values on the base date, as ``base_<column>``, and ``has_base``."""
    base = df.where(F.col("date") == F.lit(base_date).cast("date")).select("permno", F.lit(True).alias("has_base"), *(F.col(c).alias(f"base_{c}") for c in columns))
    return df.join(base, "permno", "left").withColumn("has_base", F.coalesce("has_base", F.lit(False)))


def with_exists(df: DataFrame, other: DataFrame, key: str, flag: str) -> DataFrame:
    """Adds whether ``other`` has a row with the key; never null, rows never multiply."""
    keys = other.select(key).where(F.col(key).isNotNull()).distinct().withColumn(flag, F.lit(True))
    return df.join(keys, key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def missing_in(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` without a row of ``other`` that has equal keys."""
    return df.join(other.select(*keys), list(keys), "left_anti")


def events_to_panel(events: DataFrame, daily: DataFrame) -> DataFrame:
    """Each event with the daily row of its entity on its storage date."""
    d = daily.select(F.col("permno").alias("_daily_key"), F.col("date").alias("actual_daily_date"), "delist_flag", "ret_total", "ret_missing_flag")
    return events.join(d, (events["permno"] == d["_daily_key"]) & (events["return_storage_date"] == d["actual_daily_date"]), "left").drop("_daily_key")


def match_by_key(terminal: DataFrame, events: DataFrame) -> DataFrame:
    """Terminal rows with the events of their entity, whatever the date, and how they agree."""
    e = events.select("permno", F.lit(True).alias("has_event"), "return_storage_date", "delisting_return")
    out = terminal.join(e, "permno", "left").withColumn("has_event", F.coalesce("has_event", F.lit(False)))
    return out.withColumns(
        {"date_mismatch": F.col("has_event") & ~F.col("date").eqNullSafe(F.col("return_storage_date")), "value_mismatch": F.col("has_event") & ~F.col("ret_total").eqNullSafe(F.col("delisting_return"))}
    )


def named(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds expressions under names that later ones can use."""
    return df.withColumns(columns)
