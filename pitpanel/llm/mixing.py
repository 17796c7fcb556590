"""Mixing sources to target weights without sorting documents.

Every document has a fixed hash. Within a source the mix takes the documents below a hash
threshold. The threshold comes from histograms: words summed by (source, hash bucket)
give the bucket where the budget runs out, and only that bucket is split into finer
buckets, a few times over. What leaves the executors is a histogram of a fixed number of
buckets per source; documents are filtered by comparing a hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, fresh, row_key, stored, text_of

#: Weights that repeat over the sources in code-point order.
WEIGHTS = (1, 2, 3)
#: Times that a document is taken at most.
REPEATS = 3
#: Bits of the hash that each histogram splits on, and number of histograms.
BITS, LEVELS = 12, 3


def words() -> Column:
    return F.regexp_count(text_of(), F.lit(f"({WORD})")).cast("long")


def position(key: Column | str) -> Column:
    """A hash of ``BITS * LEVELS`` bits: the first hexadecimal digits of a row's key."""
    return F.conv(F.substring(key, 1, BITS * LEVELS // 4), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, key``: words of the text and the key of id and text."""
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), words().alias("size"), row_key().alias("key"))


def targets(per_source: DataFrame) -> DataFrame:
    """Adds ``target`` to ``source, source_size``: weights share the total; a source stops
    at ``REPEATS`` times its size and the excess goes to the others by weight.

    Sources are ordered by cap per weight. If the level that the sources from one on could
    share is below that source's cap per weight, no later source is capped either, so the
    highest such level is the common one. One row per source is all that is sorted here.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    place = (F.row_number().over(by_name) - 1) % len(WEIGHTS)
    weighted = per_source.withColumn("w", F.element_at(F.array(*map(F.lit, WEIGHTS)), (place + 1).cast("int")).cast("long"))
    ranked = weighted.withColumn("cap", F.col("source_size") * REPEATS).withColumn("ratio", F.col("cap") / F.col("w"))
    by_ratio = Window.orderBy("ratio", F.asc_nulls_last("source"))
    everything = Window.partitionBy(F.lit(1))
    level = (F.sum("source_size").over(everything) - F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, 0)) + F.col("cap")) / (
        F.sum("w").over(everything) - F.sum("w").over(by_ratio.rowsBetween(Window.unboundedPreceding, 0)) + F.col("w")
    )
    leveled = ranked.withColumn("level", level)
    common = F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).over(everything)
    return leveled.withColumn("common", common).select(
        "source",
        "source_size",
        F.when(F.col("common").isNull() | (F.col("ratio") <= F.col("common")), F.col("cap").cast("double"))
        .otherwise(F.col("w") * F.col("common"))
        .alias("target"),
    )


def budgets(targeted: DataFrame) -> DataFrame:
    """``times`` whole passes over a source and the ``budget`` that is left after them."""
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    return targeted.withColumn("times", times).withColumn("budget", F.col("target") - F.col("times") * F.col("source_size"))


def boundary(sizes: DataFrame, bounds: DataFrame, level: int) -> DataFrame:
    """One histogram: the bucket of each source in which its budget runs out.

    ``bounds`` has ``source, prefix, before, budget``: the boundary bucket so far and the
    words below it. Only rows of that bucket are summed.
    """
    shift = BITS * (LEVELS - 1 - level)
    same = (F.col("s.source").eqNullSafe(F.col("b.source"))) & (F.shiftright("s.h", shift + BITS) == F.col("b.prefix"))
    counts = (
        sizes.alias("s")
        .join(bounds.alias("b"), same)
        .groupBy(F.col("s.source").alias("source"), F.shiftright("s.h", shift).alias("prefix"), "b.before", "b.budget")
        .agg(F.sum("s.size").alias("n"))
    )
    upto = Window.partitionBy("source").orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
    summed = counts.withColumn("upto", F.col("before") + F.sum("n").over(upto))
    crossed = summed.where(F.col("upto") > F.col("budget"))
    return crossed.groupBy("source").agg(
        F.min("prefix").alias("prefix"), F.min_by(F.col("upto") - F.col("n"), "prefix").alias("before"), F.min_by("n", "prefix").alias("n"), F.first("budget").alias("budget")
    )


def edges(sizes: DataFrame, budgeted: DataFrame) -> DataFrame:
    """``source, edge, copies``: rows whose key is less than ``edge`` are taken once more, and
    so many of those that have this very key: as many as bring the sum nearest to the budget.
    ``copies`` is 0 unless it is some of several; all of them lie below a longer edge."""
    hashed = sizes.withColumn("h", position("key"))
    bounds = budgeted.select("source", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("before"), "budget")
    for level in range(LEVELS):
        bounds = stored(boundary(hashed, bounds, level), f"mix-bounds-{level}").select("source", "prefix", "before", "budget")
    # the rows of one hash: copies of one row, and by chance a second key
    last = hashed.alias("s").join(bounds.alias("b"), F.col("s.source").eqNullSafe(F.col("b.source")) & (F.col("s.h") == F.col("b.prefix")))
    keys = last.groupBy(F.col("b.source").alias("source"), "s.key", "b.before", "b.budget").agg(F.first("s.size").alias("size"), F.count(F.lit(1)).alias("rows"))
    upto = F.col("before") + F.sum(F.col("size") * F.col("rows")).over(Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, 0))
    crossed = keys.withColumn("upto", upto).where(F.col("upto") > F.col("budget"))
    first = crossed.groupBy("source").agg(F.min(F.struct("key", "size", "rows", "budget", (F.col("upto") - F.col("size") * F.col("rows")).alias("before"))).alias("f")).select("source", "f.*")
    left = F.col("budget") - F.col("before")
    whole = F.floor(left / F.col("size"))
    rest = left - whole * F.col("size")
    copies = (whole + F.when(F.col("size") - rest < rest, 1).otherwise(0)).cast("long")
    every = copies >= F.col("rows")
    return first.select("source", F.when(every, F.concat("key", F.lit("~"))).otherwise(F.col("key")).alias("edge"), F.when(every, 0).otherwise(copies).alias("copies"))


def plan(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target, times, edge, copies``: what the mix takes of each source."""
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    budgeted = stored(budgets(targets(per_source)), "mix-budgets")
    joined = budgeted.alias("p").join(edges(sizes, budgeted).alias("t"), F.col("p.source").eqNullSafe(F.col("t.source")), "left")
    # one row per source; Spark broadcasts it if it is small enough
    return stored(joined.select("p.source", "p.source_size", "p.target", "p.times", F.coalesce("t.edge", F.lit("")).alias("edge"), F.coalesce("t.copies", F.lit(0)).alias("copies")), "mix-plan")


def first_copies(rows: DataFrame, same: list[str], variant: str, copies: str, name: str) -> DataFrame:
    """``rows`` with ``name``: whether a row is one of the first ``copies`` of those that are
    equal in ``same``, by ``variant``; rows of one variant are alike, so it doesn't matter
    which of them these are. They are counted by file, and numbered in their file."""
    rows = stored(rows, "mix-copies")
    file, place, n, before, number = fresh(rows, "copy_file", "copy_place", "copy_n", "copy_before", "copy_number")
    at = rows.select("*", F.col("_metadata.file_name").alias(file), F.col("_metadata.row_index").alias(place))
    counts = at.groupBy(*same, variant, file).agg(F.count(F.lit(1)).alias(n))
    earlier = Window.partitionBy(*same).orderBy(variant, file).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn(before, F.coalesce(F.sum(n).over(earlier), F.lit(0))).drop(n)
    keys = [*same, variant, file]
    renamed = offsets.toDF(*(f"{c}_of" if c in keys else c for c in offsets.columns))
    numbered = at.withColumn(number, F.row_number().over(Window.partitionBy(*keys).orderBy(place)))
    joined = numbered.join(renamed, [F.col(c).eqNullSafe(F.col(f"{c}_of")) for c in keys])
    return joined.withColumn(name, F.col(before) + F.col(number) <= F.col(copies)).select(*rows.columns, name)


def mix(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for each row of ``docs``.

    Sources are ordered by code point, null last, and weigh 1, 2, 3, repeating. ``taken``
    is ``size`` times the passes over the source, and once more below its threshold.
    Null text: size 0. Repeated rows share a key; if the budget runs out among them, so many
    of them are taken once more as bring the sum nearest to it. All of a run is a function of
    the rows, so reruns agree. A source without words has target 0. Other columns are
    ignored; an empty table gives an empty result.
    """
    sizes = stored(sized(docs), "mix-sizes")
    parts = plan(sizes)
    joined = sizes.alias("s").join(parts.alias("p"), F.col("s.source").eqNullSafe(F.col("p.source"))).select("s.*", "p.source_size", "p.target", "p.times", "p.edge", "p.copies")
    more = F.col("key") < F.col("edge")
    out = joined.withColumn("more", more)
    if not parts.where("copies > 0").isEmpty():
        some = (F.col("key") == F.col("edge")) & (F.col("copies") > 0)
        few = first_copies(joined.where(some).withColumn("variant", F.lit(0)), ["source"], "variant", "copies", "more").drop("variant")
        out = out.where(~some).unionByName(few)
    taken = F.col("size") * (F.col("times") + F.col("more").cast("long"))
    return out.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))


def take(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with all their columns and ``size`` and
    ``taken``; columns of these names are replaced. Rows without words are never taken. Of
    repeated rows among which a budget runs out, those come first whose other columns have
    the smaller hash."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("size", "taken")])
    sizes = stored(sized(docs), "mix-sizes")
    own, key, variant, more, *theirs = fresh(docs, "mix_own", "mix_key", "mix_variant", "mix_more", "mix_source", "mix_times", "mix_edge", "mix_copies")
    parts = plan(sizes).select(*(F.col(c).alias(n) for c, n in zip(("source", "times", "edge", "copies"), theirs)))
    source, times, edge, copies = (F.col(n) for n in theirs)
    joined = docs.withColumns({own: F.col("source").cast("string"), key: row_key()}).join(parts, F.col(own).eqNullSafe(source))
    out = joined.withColumn(more, F.col(key) < edge)
    if not parts.where(copies > 0).isEmpty():
        some = (F.col(key) == edge) & (copies > 0)
        few = first_copies(joined.where(some).withColumn(variant, F.xxhash64(*docs.columns)), [own], variant, theirs[3], more).drop(variant)
        out = out.where(~some).unionByName(few)
    # the words are counted again only of rows that are taken
    taken = out.where((times > 0) | F.col(more)).withColumn("size", words()).where("size > 0")
    return taken.withColumn("taken", (F.col("size") * (times + F.col(more).cast("long"))).cast("long")).select(*docs.columns, "size", "taken")
