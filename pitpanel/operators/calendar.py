"""Session calendar, shifts by sessions, coverage and gaps.

The calendar has a row for each session, so it is small beside any panel; joins leave it to
Spark to broadcast it by its measured size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import ContractError

ZONE = "America/New_York"


def session_calendar(
    spark: SparkSession, start: str, end: str, holidays: DataFrame | None = None, early_closes: DataFrame | None = None,
    lag: int = 1, decision: str = "after_close", zone: str = ZONE,
) -> DataFrame:
    """``date, session_index, open_at, close_at, decision_time, available_at`` of the weekdays
    from ``start`` to ``end`` that aren't ``holidays`` (``date``). ``early_closes`` (``date``)
    close at 13:00. Opening 9:30 and close 16:00 are local times, across clock changes.

    A decision falls 60 minutes after the close or, ``preopen``, one before the opening.
    What a session shows is available 30 minutes after the close ``lag`` sessions later;
    sessions past ``end`` are laid out for that and cut off again.
    """
    if decision not in ("after_close", "preopen") or lag < 0:
        raise ContractError("decision must be after_close or preopen, lag not negative")
    padded = f"date_add(date '{end}', {4 * lag + 30})"
    days = spark.sql(f"select explode(sequence(date '{start}', {padded}, interval 1 day)) as date").where("weekday(date) < 5")
    if holidays is not None:
        days = days.join(holidays.select("date").distinct(), "date", "left_anti")
    short = F.lit(False)
    if early_closes is not None:
        days = days.join(early_closes.select("date", F.lit(True).alias("short")).distinct(), "date", "left")
        short = F.coalesce("short", F.lit(False))
    at = lambda clock: F.to_utc_timestamp(F.concat_ws(" ", F.col("date").cast("string"), clock), zone)
    by_date = Window.orderBy("date")  # one row a session: thousands in all
    out = days.withColumns(
        {
            "session_index": (F.row_number().over(by_date) - 1).cast("bigint"),
            "open_at": at(F.lit("09:30:00")),
            "close_at": at(F.when(short, "13:00:00").otherwise("16:00:00")),
        }
    )
    chosen = F.col("close_at") + F.expr("interval 60 minutes") if decision == "after_close" else F.col("open_at") - F.expr("interval 1 minute")
    out = out.withColumn("decision_time", chosen).withColumn("available_at", F.lead("close_at", lag).over(by_date) + F.expr("interval 30 minutes"))
    return out.where(F.col("date") <= F.lit(end).cast("date")).select("date", "session_index", "open_at", "close_at", "decision_time", "available_at")


def shift_sessions(df: DataFrame, cal: DataFrame, column: str, n: int, name: str = "shifted", strict: bool = False) -> DataFrame:
    """Adds the session ``n`` after that in ``column``; null for what is no session or is
    shifted out of the calendar, or an error if ``strict``."""
    here = cal.select(F.col("date").alias("_from"), (F.col("session_index") + n).alias("_index"))
    there = cal.select(F.col("date").alias(name), F.col("session_index").alias("_index"))
    moved = here.join(there, "_index").select("_from", name)  # calendar by calendar
    out = df.join(moved, df[column] == moved["_from"], "left").drop("_from")
    if strict and not out.where(F.col(name).isNull()).isEmpty():
        raise ContractError(f"{column} has dates that can't be shifted by {n} sessions")
    return out


def latest_observable(df: DataFrame, cal: DataFrame, column: str, lag: int = 1, decision: str = "after_close", name: str = "observable") -> DataFrame:
    return shift_sessions(df, cal, column, -lag - int(decision == "preopen"), name)


def next_session(df: DataFrame, cal: DataFrame, column: str, name: str = "next_session") -> DataFrame:
    """Adds the first session strictly after a date. Each distinct date is placed among the
    sessions once, in one ordered pass, and joined back; no range join."""
    dates = df.select(F.col(column).alias("_day")).where(F.col(column).isNotNull()).distinct()
    line = dates.select("_day", F.lit(None).cast("date").alias("_session")).unionByName(cal.select(F.col("date").alias("_day"), F.col("date").alias("_session")))
    line = line.withColumn("_day_n", F.unix_date("_day"))
    # latest first, so that the minimum runs on instead of starting anew at each row
    ahead = Window.orderBy(F.desc("_day_n")).rangeBetween(Window.unboundedPreceding, -1)
    found = line.withColumn(name, F.min("_session").over(ahead)).where("_session is null").select("_day", name)
    return df.join(found, df[column] == found["_day"], "left").drop("_day")


def calendar_gaps(df: DataFrame, cal: DataFrame, column: str = "date") -> DataFrame:
    """``date, problem``: sessions without rows, and dates that are no session."""
    seen, due = df.select(F.col(column).alias("date")).distinct(), cal.select("date")
    missing = due.join(seen, "date", "left_anti").withColumn("problem", F.lit("MISSING_SESSION"))
    return missing.unionByName(seen.join(due, "date", "left_anti").withColumn("problem", F.lit("UNEXPECTED_DATE")))


def with_session(df: DataFrame, cal: DataFrame, column: str = "date") -> DataFrame:
    """Rows on sessions, with the calendar's columns."""
    c = cal if column == "date" else cal.withColumnRenamed("date", column)
    return df.join(c, column)


def session_gaps(panel: DataFrame) -> DataFrame:
    """Rows of an entity that don't follow the session before."""
    own = Window.partitionBy("permno").orderBy("session_index")
    return panel.withColumn("previous_session", F.lag("session_index").over(own)).where(F.col("session_index") - F.col("previous_session") != 1)


def at(cal: DataFrame, offset: int | Column) -> DataFrame:
    """The calendar keyed by the index of the session ``offset`` before."""
    return cal.withColumn("session_index", F.col("session_index") - offset)
