"""Shared helpers of the corpus operators: tables, temporary tables, column names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import scratch

#: Characters that separate words in every operator: space and U+0009 to U+000D.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives
    lost executors, as nothing of it stays with an executor."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.stored_at = path
    return back


def discard(df: DataFrame) -> None:
    """Delete what ``stored`` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have (Spark compares them without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_of(column: Column | str = "text") -> Column:
    """The whole text; a null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """128-bit content key of a row. Rows with equal key have equal id and text, so a
    repeated or null id never joins with another text."""
    t = text_of(text)
    return F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), t).cast("binary"))


def looked_up(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the columns of ``table``, which has a row for each key at most; null keys
    are equal. Rows without a match get nulls.

    A key of more than one in 1,024 of the rows is looked up in a broadcast table: there are
    fewer than 1,024 such keys, whatever the data. The other keys meet in a shuffle, so no
    task gets the rows of a hot key. Both frames are read twice, so they should be stored.
    """
    both = rows.withColumns({c: F.lit(None) for c in table.columns if c not in keys})
    names = fresh(both, *(f"key_{i}" for i in range(len(keys))), "n_of_key")
    own, n = names[:-1], names[-1]
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(n))
    total = counts.agg(F.sum(n)).first()[0] or 0
    hot = [tuple(r)[:-1] for r in counts.where(F.col(n) * 1024 > total).collect()]
    renamed = table.withColumnsRenamed(dict(zip(keys, own, strict=True)))
    equal = [rows[k].eqNullSafe(F.col(o)) for k, o in zip(keys, own, strict=True)]
    if not hot:
        return rows.join(renamed.hint("merge"), equal, "left").drop(*own)
    schema = rows.select(*keys).schema
    marks = rows.sparkSession.createDataFrame(hot, schema).toDF(*own)
    few = renamed.join(F.broadcast(marks.toDF(*keys)), [F.col(o).eqNullSafe(F.col(k)) for k, o in zip(keys, own, strict=True)], "left_semi")
    often = rows.join(F.broadcast(marks), equal, "left_semi").join(F.broadcast(few), equal, "left").drop(*own)
    rest = rows.join(F.broadcast(marks), equal, "left_anti").join(renamed.hint("merge"), equal, "left").drop(*own)
    return often.unionByName(rest)
