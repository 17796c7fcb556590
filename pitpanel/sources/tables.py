"""Reading, writing, fingerprints, manifests and immutable runs.

Paths may lie in any store that Spark reads. Skip, rebuild and reuse decisions are joins
between months and manifest rows; only those small tables reach the driver.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.aggregates import sorted_output
from ..schemas import ContractError


def read_table(spark: SparkSession, paths: Sequence[str] | str, schema: StructType | None = None) -> DataFrame:
    """An explicit list of Parquet files, the contract's columns only; folder names that look
    like partitions are not read as columns."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = spark.read.option("recursiveFileLookup", "true").parquet(*paths)
    return df if schema is None else df.select(*schema.names)


def read_panel(spark: SparkSession, root: str, year: int | None = None, month: int | None = None) -> DataFrame:
    """A panel in ``year=/month=`` folders; a year or month prunes folders."""
    df = spark.read.parquet(root)
    for name, value in (("year", year), ("month", month)):
        df = df if value is None else df.where(F.col(name) == value)
    return df


def file_name(levels: int = 1) -> Column:
    """The last so many parts of a row's file path. Folders of partitions may hold files of the
    same name; with the folders' levels the names differ."""
    return F.array_join(F.slice(F.split(F.col("_metadata.file_path"), "/"), -levels, levels), "/")


def file_counts(df: DataFrame, manifest: DataFrame | None = None, levels: int = 1) -> DataFrame:
    """Rows per file; with a manifest (``file, rows``) also whether they agree."""
    name = file_name(levels)
    found = df.select(name.alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("rows"))
    if manifest is None:
        return found
    both = found.join(manifest.select("file", F.col("rows").alias("rows_due")), "file", "full_outer")
    return both.withColumn("agrees", F.col("rows").eqNullSafe(F.col("rows_due")))


def write_table(df: DataFrame, path: str, sort: Sequence[str], mode: str = "errorifexists") -> None:
    """Sorted by ranges of the keys, so files have narrow bounds that scans can skip by."""
    sorted_output(df, sort).write.mode(mode).option("compression", "zstd").parquet(path)


def fingerprint(df: DataFrame, by: Sequence[str] = (), hashed: Column | None = None) -> DataFrame:
    """Per group: row count and two sums over row hashes that no order of rows changes. Equal
    bags have equal fingerprints; the sum tells repeated rows apart, which xor cancels.
    ``hashed`` is a hash of the row as a long, one of all columns if not given."""
    h = F.xxhash64(*[c for c in df.columns]) if hashed is None else hashed
    return df.withColumn("_h", h).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("_h").alias("xor"), F.sum(F.col("_h").cast("decimal(38,0)")).alias("sum")
    )


def months_of(df: DataFrame, date: str = "date") -> DataFrame:
    return df.withColumns({"year": F.year(date).cast("int"), "month": F.month(date).cast("int")})


def missing_months(df: DataFrame, start: str, end: str, date: str = "date") -> DataFrame:
    """``year, month`` between two dates without a row."""
    span = f"explode(sequence(trunc(date '{start}', 'MM'), date '{end}', interval 1 month))"
    due = df.sparkSession.sql(f"select {span} as day").select(F.year("day").alias("year"), F.month("day").alias("month"))
    return due.join(months_of(df.select(date), date).select("year", "month").distinct(), ["year", "month"], "left_anti")


def pending_months(inputs: DataFrame, manifest: DataFrame, policy: str) -> DataFrame:
    """Months whose content or policy differs from what a manifest (``year, month, n, xor, sum,
    policy``) has built."""
    now = fingerprint(months_of(inputs), ["year", "month"]).withColumn("policy", F.lit(policy))
    return now.join(manifest, ["year", "month", "n", "xor", "sum", "policy"], "left_anti")


def write_months(df: DataFrame, root: str, manifest: DataFrame | None = None, policy: str = "1", force: bool = False, file_rows: int = 5_000_000) -> DataFrame:
    """Write the months that the manifest lacks, replacing what is there of them, and return
    their new manifest rows. ``force`` writes all. A month that was written but not
    committed to the manifest is written again. A month of more than ``file_rows`` rows is
    dealt out to several tasks and files, by a hash of its rows."""
    spark, whole = df.sparkSession, months_of(df)
    due = fingerprint(whole, ["year", "month"]).withColumn("policy", F.lit(policy))
    if manifest is not None and not force:
        due = pending_months(df, manifest, policy)
    rows = due.collect()  # one per month
    due = spark.createDataFrame(rows, due.schema)
    parts = F.broadcast(due.select("year", "month", F.ceil(F.col("n") / file_rows).alias("_parts")))  # a row for each month
    part = whole.join(parts, ["year", "month"]).withColumn("_part", F.pmod(F.xxhash64(*df.columns), "_parts"))
    dealt = part.repartition("year", "month", "_part").drop("_part", "_parts")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").option("compression", "zstd").parquet(root)
    return due


def verify_written(df: DataFrame, path: str, mode: str = "errorifexists") -> int:
    """Write, counting on the way, read back, and raise unless the counts agree."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path)
    back = df.sparkSession.read.parquet(path).count()
    if back != seen.get["rows"]:
        raise ContractError(f"{seen.get['rows']} rows were written and {back} read back")
    return back


def manifest(df: DataFrame, dataset: str, date: str = "date", policy: str = "1", by: Sequence[str] = ()) -> DataFrame:
    """One row per group: rows, date bounds, column names and the policy they were built by."""
    out = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.min(date).alias("min_date"), F.max(date).alias("max_date"))
    return out.withColumns({"dataset": F.lit(dataset), "columns": F.lit(",".join(df.columns)), "policy": F.lit(policy)})


def run_id(config: Mapping, inputs: Mapping[str, DataFrame]) -> str:
    """A name that changes with the configuration or with any input row."""
    prints = {name: [str(x) for x in fingerprint(df).first()] for name, df in sorted(inputs.items())}
    return hashlib.sha256(json.dumps([dict(config), prints], sort_keys=True, default=str).encode()).hexdigest()[:24]


def publish_run(tables: Mapping[str, DataFrame], root: str, name: str, inputs: Sequence[str] = ()) -> DataFrame:
    """Write each table of a run into its own folder and a manifest last. A run that exists is
    never replaced and nothing is written below an input."""
    folder = f"{root.rstrip('/')}/{name}"
    if any(f"{folder}/".startswith(f"{i.rstrip('/')}/") for i in inputs):
        raise ContractError("a run can't be written below its inputs")
    rows = None
    for table, df in sorted(tables.items()):
        df.write.mode("errorifexists").option("compression", "zstd").parquet(f"{folder}/{table}")
        own = fingerprint(df.sparkSession.read.parquet(f"{folder}/{table}")).withColumn("table", F.lit(table))
        rows = own if rows is None else rows.unionByName(own)
    rows = rows.select("table", "n", "xor", F.col("sum").cast("string").alias("sum"))
    rows.coalesce(1).write.mode("errorifexists").json(f"{folder}/manifest")
    return rows


def verify_run(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``table, rows_agree, agrees``: each table of a run read again and held against its
    manifest, by its row count and by its whole content."""
    folder = f"{root.rstrip('/')}/{name}"
    due = spark.read.schema("table string, n long, xor long, sum string").json(f"{folder}/manifest")
    found = None
    for r in due.select("table").collect():  # a run has a dozen tables
        own = fingerprint(spark.read.parquet(f"{folder}/{r['table']}")).withColumn("table", F.lit(r["table"]))
        found = own if found is None else found.unionByName(own)
    found = found.select("table", F.col("n").alias("n2"), F.col("xor").alias("xor2"), F.col("sum").cast("string").alias("sum2"))
    same: Column = (F.col("n") == F.col("n2")) & F.col("xor").eqNullSafe(F.col("xor2")) & F.col("sum").eqNullSafe(F.col("sum2"))
    count = F.coalesce(F.col("n") == F.col("n2"), F.lit(False))
    return due.join(found, "table", "left").select("table", count.alias("rows_agree"), F.coalesce(same, F.lit(False)).alias("agrees"))
