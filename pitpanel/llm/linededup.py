"""Removal of boilerplate lines that spread over many sites, with DataFrame functions only.

A line hash gets a HyperLogLog sketch of the sites that it occurs on. Sketches are made in
each task and merged by the aggregation, so a line costs a bounded sketch however often it
occurs. Lines whose estimate lies near the threshold get an exact distinct count; only
they are counted exactly. Lines over the threshold go from every document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, row_key, stored, text_of

#: Sites from which on a line is boilerplate, and the shortest such line.
SITES, LEAST_CHARS = 8, 16
WHITE = " \t\r\x0b\x0c"
#: Sketches have 2**LG registers; an estimate off the threshold by more than BAND of it
#: (over six standard errors, and never less than one site) is trusted.
LG, BAND = 11, 0.2


def lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``key, site, place, h``: a row for each line that is long enough to count. ``h`` is
    128 bits of the trimmed line."""
    keyed = docs.select(row_key().alias("key"), F.col("source").cast("string").alias("site"), text_of().alias("text"))  # one key a row, not one a line
    t = keyed.select("key", "site", F.posexplode(F.split("text", "\n", -1)).alias("place", "line"))
    line = F.trim(F.col("line"), F.lit(WHITE))
    return t.select("key", "site", "place", line.alias("line")).where(F.length("line") >= least_chars).select(
        "key", "site", "place", F.struct(F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), F.col("line")).alias("b")).alias("h")
    )


def spread(found: DataFrame, sites: int = SITES) -> DataFrame:
    """``h`` of the lines on at least ``sites`` distinct sites, a null site being one."""
    site = F.xxhash64(F.coalesce("site", F.lit("")), F.col("site").isNull())
    sketched = found.groupBy("h").agg(F.hll_sketch_agg(site, F.lit(LG)).alias("sketch"))
    band = max(1.0, BAND * sites)
    rated = stored(
        sketched.select("h", F.hll_sketch_estimate("sketch").alias("estimate")).where(F.col("estimate") >= sites - band), "line-spread"
    )
    near = rated.where(F.col("estimate") <= sites + band)
    pairs = found.join(near.select("h"), "h", "left_semi").select("h", site.alias("s")).distinct()
    exact = pairs.groupBy("h").agg(F.count("s").alias("n")).where(F.col("n") >= sites)
    return stored(rated.where(F.col("estimate") > sites + band).select("h").unionByName(exact.select("h")), "boilerplate-lines")


def without_boilerplate(docs: DataFrame, sites: int = SITES, least_chars: int = LEAST_CHARS, keep_whole: bool = False) -> DataFrame:
    """The rows of ``docs`` with all their columns; ``text`` loses its boilerplate lines,
    ``n_chars``, if there, is counted anew, and ``n_lines`` and ``n_removed`` are added.

    Lines are compared without the white space at their ends; those of fewer than
    ``least_chars`` characters stay, and so does a line repeated in one site only. With
    ``keep_whole`` a document that would lose every line that counts stays as it is: a
    copy of a whole document, which near-dedup judges. Null text stays null with 0 lines;
    empty text has one line. Repeated rows are treated alike; no document goes, and one of
    nothing but boilerplate is left with an empty text. Columns of these names in ``docs``
    are replaced.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("n_lines", "n_removed")])
    key, gone, rest, parts = fresh(docs, "row_key", "gone", "kept_lines", "all_lines")
    found = lines(docs, least_chars)
    removed = (
        found.join(spread(found, sites), "h", "left_semi").select("key", "place").distinct()
        .groupBy("key").agg(F.sort_array(F.collect_set("place")).alias(gone)).withColumnRenamed("key", key)
    )  # a document's own lines only
    marked = docs.withColumn(key, row_key()).join(removed, key, "left").withColumn(parts, F.split("text", "\n", -1))
    some = F.col(gone).isNotNull()
    if keep_whole:
        some &= F.size(gone) < F.size(F.filter(parts, lambda line: F.length(F.trim(line, F.lit(WHITE))) >= least_chars))
    # the stretches between removed lines, each cut out once, so that the work grows with the lines
    ends = F.concat(gone, F.array(F.size(parts)))
    stretches = F.transform(
        F.arrays_zip(F.concat(F.array(F.lit(-1)), gone).alias("a"), ends.alias("b")), lambda x: F.slice(F.col(parts), x["a"] + 2, x["b"] - x["a"] - 1)
    )
    out = marked.withColumn(rest, F.when(some, F.flatten(stretches)))
    out = out.withColumn("text", F.when(F.col(rest).isNotNull(), F.array_join(rest, "\n")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    counts = {"n_lines": F.when(F.col(parts).isNull(), 0).otherwise(F.size(parts)), "n_removed": F.when(F.col(rest).isNotNull(), F.size(gone)).otherwise(0)}
    return out.withColumns({n: c.cast("long") for n, c in counts.items()}).drop(key, gone, rest, parts)
