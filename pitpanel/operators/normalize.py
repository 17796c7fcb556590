"""Normalization (casts and renames), keys, duplicates, intervals and profiles.

Every check is a DataFrame of counts or of offending rows; several conditions on a table
are counted in one pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.quality import return_validity
from ..schemas import DAILY, HISTORY, TERMINAL, ContractError


def normalize(raw: DataFrame, schema: StructType, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Strict casts to a contract's types; ``renames`` maps contract names to raw names.
    A value that can't be cast raises when it is read."""
    named = renames or {}
    return raw.select(*(F.col(named.get(f.name, f.name)).cast(f.dataType).alias(f.name) for f in schema.fields))


def normalize_daily(raw: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    return normalize(raw, DAILY, renames)


def normalize_history(raw: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    return normalize(raw, HISTORY, renames)


def normalize_events(raw: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    return normalize(raw, TERMINAL, renames)


def conditional_counts(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """One row: ``rows`` and how many rows meet each predicate."""
    return df.agg(F.count(F.lit(1)).alias("rows"), *(F.count_if(p).alias(name) for name, p in predicates.items()))


def key_stats(df: DataFrame, key: str, date: str) -> DataFrame:
    """Null keys, null dates and dates that can't be read."""
    unread = F.col(date).isNotNull() & F.col(date).cast("string").try_cast("date").isNull()
    return conditional_counts(df, {"null_keys": F.col(key).isNull(), "null_dates": F.col(date).isNull(), "invalid_dates": unread})


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def count_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: counts of both sides and whether they are equal."""
    sides = before.select(F.lit(True).alias("is_before")).unionByName(after.select(F.lit(False).alias("is_before")))
    both = sides.agg(F.count_if("is_before").alias("rows_before"), F.count_if(~F.col("is_before")).alias("rows_after"))
    return both.withColumn("conserved", F.col("rows_before") == F.col("rows_after"))


def assert_same_count(before: DataFrame, after: DataFrame) -> DataFrame:
    """``after`` itself; raises if a step lost or made rows."""
    found = count_change(before, after).first()
    if not found["conserved"]:
        raise ContractError(f"rows changed from {found['rows_before']} to {found['rows_after']}")
    return after


def check_partition(df: DataFrame, date: str = "date", year: str = "year", month: str = "month") -> DataFrame:
    """Per partition: rows, bounds, and rows that belong elsewhere."""
    strays = (F.year(date) != F.col(year)) | (F.month(date) != F.col(month)) | F.col(date).isNull()
    return df.groupBy(year, month).agg(F.count(F.lit(1)).alias("rows"), F.min(date).alias("min_date"), F.max(date).alias("max_date"), F.count_if(strays).alias("misplaced"))


def bad_intervals(df: DataFrame, key: str = "permno", frm: str = "valid_from", to: str = "valid_to") -> DataFrame:
    return df.where(F.col(key).isNull() | F.col(frm).isNull() | (F.col(to) < F.col(frm)))


def open_end(to: Column | str = "valid_to") -> Column:
    """End of a closed interval; null is open."""
    return F.coalesce(F.col(to) if isinstance(to, str) else to, F.expr("date '9999-12-31'"))


def previous(df: DataFrame, key: str, order: Sequence[str], column: Column | str, name: str) -> DataFrame:
    """Adds the value of the row before within a key."""
    value = F.col(column) if isinstance(column, str) else column
    return df.withColumn(name, F.lag(value).over(Window.partitionBy(key).orderBy(*order)))


def overlaps(df: DataFrame, key: str = "permno", frm: str = "valid_from", to: str = "valid_to", all_pairs: bool = False) -> DataFrame:
    """Intervals that start before an earlier one of their key has ended.

    By default the one just before is looked at, which finds whether any overlap exists;
    ``all_pairs`` looks at the latest end of all before and so finds every such interval.
    """
    own = Window.partitionBy(key).orderBy(frm, F.asc_nulls_last(to))
    before = F.max(open_end(to)).over(own.rowsBetween(Window.unboundedPreceding, -1)) if all_pairs else F.lag(open_end(to)).over(own)
    return df.withColumn("previous_end", before).where(F.col("previous_end") >= F.col(frm))


def bag_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one side has more often, and which side: counts of equal rows are compared
    in one shuffle."""
    side = lambda df, sign: df.select("*", F.lit(sign).alias("sign"))
    both = side(a, 1).unionByName(side(b, -1))
    extra = both.groupBy(*a.columns).agg(F.sum("sign").alias("surplus")).where("surplus <> 0")
    return extra.withColumn("side", F.when(F.col("surplus") > 0, "left").otherwise("right"))


#: So many copies of a row are laid out at a time.
COPIES = 1 << 16


def each_copy(diff: DataFrame) -> DataFrame:
    """``bag_diff`` as ``except all`` lists it: a row for each surplus copy, its ``surplus`` 1 or
    -1. Blocks of copies come first, so a row that is there very often makes no long array."""
    copies = F.abs("surplus")
    blocks = diff.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((copies - 1) / COPIES))))
    each = blocks.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.least(F.lit(COPIES).cast("bigint"), copies - F.col("_block") * COPIES))))
    return each.withColumn("surplus", F.signum("surplus").cast("bigint")).drop("_block", "_copy")


def optional_column(df: DataFrame, names: Sequence[str], kind: str) -> tuple[Column, bool]:
    """The one column of ``df`` among ``names`` (case is ignored), cast, and whether it is
    there; a null of that type if none is. Two at once are an error."""
    found = [c for c in df.columns if c.lower() in {n.lower() for n in names}]
    if len(found) > 1:
        raise ContractError(f"ambiguous optional columns: {', '.join(found)}")
    return (F.col(found[0]) if found else F.lit(None)).cast(kind), bool(found)


def return_profile(c: str, missing_flag: str | None = None) -> dict[str, Column]:
    state = return_validity(c)
    out = {
        "missing": state == "MISSING", "zero": F.col(c) == 0, "minus_one": F.col(c) == -1,
        "invalid": state.isin("NONFINITE", "BELOW_MINUS_ONE"),
    }
    if missing_flag:
        out["numeric_with_warning"] = F.col(c).isNotNull() & ~F.col(missing_flag).eqNullSafe(F.lit("NA"))
    return out


def profile_events(df: DataFrame) -> DataFrame:
    keys = F.count_distinct(F.struct("permno", "event_date"))
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("permno").alias("entities"), F.min("event_date").alias("min_date"),
        F.max("event_date").alias("max_date"), (F.count(F.lit(1)) - keys).alias("surplus_keys"),
        *(F.count_if(p).alias(n) for n, p in return_profile("delisting_return").items()),
    )


def profile_history(df: DataFrame) -> DataFrame:
    own = Window.partitionBy("permno").orderBy("valid_from", F.asc_nulls_last("valid_to"))
    marked = df.withColumn("previous_end", F.lag(open_end()).over(own))
    return marked.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("permno").alias("entities"), F.min("valid_from").alias("min_from"),
        F.max("valid_to").alias("max_to"), F.count_if(F.col("valid_from").isNull() | (F.col("valid_to") < F.col("valid_from"))).alias("invalid_intervals"),
        F.count_if(F.col("previous_end") >= F.col("valid_from")).alias("overlaps"),
    )


def profile_daily(df: DataFrame) -> DataFrame:
    keys = F.count_distinct(F.struct("permno", "date"))
    return df.groupBy(F.year("date").cast("bigint").alias("year"), F.month("date").cast("bigint").alias("month")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("permno").alias("entities"), (F.count(F.lit(1)) - keys).alias("surplus_keys"),
        F.count_if(F.col("permno").isNull() | F.col("date").isNull()).alias("null_keys"),
        *(F.count_if(p).alias(n) for n, p in return_profile("ret_total", "ret_missing_flag").items()),
    )


def flag_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))


def positive_returns(df: DataFrame, c: str = "ret_total") -> DataFrame:
    return df.where(F.col(c) > 0).select("permno", "date", c)


def implied_return_check(df: DataFrame, terms: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Return implied by prices and outside terms (``permno, date, ratio, cash``) against the
    stored one; only rows with a price before."""
    own = Window.partitionBy("permno").orderBy("date")
    priced = df.withColumn("previous_price", F.lag("price_raw").over(own)).join(terms, ["permno", "date"])
    implied = (F.col("ratio") * F.col("price_raw") + F.col("cash")) / F.col("previous_price") - 1
    out = priced.where(F.col("previous_price") > 0).withColumn("implied_return", implied)
    return out.withColumn("agrees", F.abs(F.col("implied_return") - F.col("ret_total")) <= tolerance)
