"""A table in parts, by period and bucket of keys, with a versioned ledger.

Parts are written aside, each write into a folder of its own, and become the table by one
small file: ``_ledger/<version>``, created only if it isn't there. So a write that dies leaves
the table as it was, two writers can't both follow one version, and a reader sees a version
whole. The ledger has a line for each part: where it lies, how many rows it has, what they
hash to, and a note. It is read by the driver, as parts are periods x buckets, not rows.

A ledger file without its last line was torn by a crash; it is passed over, its number isn't
used again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ContractError
from .tables import fingerprint

Key = tuple[int, int]


class Conflict(ContractError):
    """Another writer has changed the same parts since they were read."""


@dataclass(frozen=True)
class Part:
    period: int
    bucket: int
    path: str | None
    n: int
    xor: int
    sum: str
    note: str = ""

    @property
    def key(self) -> Key:
        return self.period, self.bucket

    @property
    def content(self) -> tuple[int, int, str]:
        return self.n, self.xor, self.sum


class Months:
    """Months since the year 0."""

    @staticmethod
    def of(date: Column) -> Column:
        return (F.year(date) * 12 + F.month(date) - 1).cast("int")

    @staticmethod
    def first(period: Column) -> Column:
        return F.make_date((period / 12).cast("int"), period % 12 + 1, F.lit(1))


class Weeks:
    """Weeks since 1970, from Monday on."""

    @staticmethod
    def of(date: Column) -> Column:
        return F.floor(F.datediff(date, F.lit("1970-01-05").cast("date")) / 7).cast("int")

    @staticmethod
    def first(period: Column) -> Column:
        return F.date_add(F.lit("1970-01-05").cast("date"), period * 7)


class Store:
    def __init__(self, spark: SparkSession, root: str, key: str = "permno", date: str = "date", period: type = Months, buckets: int = 16):
        self.spark, self.root, self.key, self.date, self.period, self.buckets = spark, root.rstrip("/"), key, date, period, buckets

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """All version numbers that have been taken, torn ones too."""
        path, fs = self._path("_ledger")
        return sorted(int(f.getPath().getName()) for f in fs.listStatus(path) if f.getPath().getName().isdigit()) if fs.exists(path) else []

    def _load(self, version: int) -> dict[Key, Part] | None:
        path, fs = self._path(f"_ledger/{version:012d}")
        stream = fs.open(path)
        try:
            lines = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").splitlines()
        finally:
            stream.close()
        if not lines or lines[-1] != f"end {len(lines) - 1}":
            return None
        parts = [Part(**json.loads(line)) for line in lines[:-1]]
        return {p.key: p for p in parts}

    def ledger(self) -> tuple[int, dict[Key, Part]]:
        """The last whole version and its parts; 0 and none at first."""
        for version in reversed(self.versions()):
            parts = self._load(version)
            if parts is not None:
                return version, parts
        return 0, {}

    def _create(self, version: int, parts: Mapping[Key, Part]) -> bool:
        path, fs = self._path(f"_ledger/{version:012d}")
        from py4j.protocol import Py4JJavaError

        try:
            out = fs.create(path, False)
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        lines = [json.dumps(asdict(p)) for _, p in sorted(parts.items())]
        out.write("".join(f"{x}\n" for x in [*lines, f"end {len(lines)}"]).encode())
        out.close()
        return True

    def commit(self, version: int, changed: Mapping[Key, Part]) -> int:
        """Make ``changed``, prepared on top of ``version``, part of the table. If others have
        committed since, it goes on top of theirs, unless they changed one of its parts."""
        base = (self._load(version) or {}) if version else {}
        while True:
            taken, (now, parts) = self.versions(), self.ledger()
            if now != version and (mine := sorted(k for k in changed if parts.get(k) != base.get(k))):
                raise Conflict(f"parts {mine[:5]} were changed by version {now}")
            following = max(taken, default=0) + 1
            if self._create(following, {**parts, **changed}):
                return following

    def marked(self, df: DataFrame) -> DataFrame:
        return df.withColumns({"_period": self.period.of(F.col(self.date)), "_bucket": F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")})

    def prepare(self, df: DataFrame, replace: Iterable[Key] | None = None, notes: Mapping[Key, str] | None = None) -> tuple[int, dict[Key, Part]]:
        """Write the parts of ``df`` that differ from the table's and return the version they
        build on and what to commit. ``df`` replaces all parts of its periods, or exactly those
        of ``replace``; a part that it has no rows of becomes empty."""
        version, old = self.ledger()
        rows = self.marked(df)
        found = {(r["_period"], r["_bucket"]): r for r in fingerprint(rows, ["_period", "_bucket"], F.xxhash64(*df.columns)).collect()}  # a row for each part
        due = set(replace) if replace is not None else set(found) | {k for k in old if k[0] in {p for p, _ in found}}
        if stray := sorted(k for k in found if k not in due):
            raise ContractError(f"rows outside the parts to replace: {stray[:5]}")
        note = (notes or {}).get
        content = {k: (r["n"], r["xor"], str(r["sum"])) for k, r in found.items()}
        fresh = [k for k in content if k not in old or old[k].content != content[k]]
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        if fresh:
            wanted = F.broadcast(self.spark.createDataFrame(fresh, "_period int, _bucket int"))
            rows.join(wanted, ["_period", "_bucket"], "left_semi").repartition("_period", "_bucket").write.partitionBy("_period", "_bucket").option("compression", "zstd").parquet(folder)
        changed = {}
        for k in due:
            if k in content:
                path = f"{folder}/_period={k[0]}/_bucket={k[1]}" if k in fresh else old[k].path
                part = Part(*k, path, *content[k], note(k, ""))
            else:
                part = Part(*k, None, 0, 0, "0", note(k, ""))
            if old.get(k) != part:
                changed[k] = part
        return version, changed

    def write(self, df: DataFrame, replace: Iterable[Key] | None = None, notes: Mapping[Key, str] | None = None) -> set[Key]:
        """Write and commit; the parts whose rows or note have changed."""
        version, changed = self.prepare(df, replace, notes)
        if changed:
            self.commit(version, changed)
        return set(changed)

    def read(self, schema: str, keys: Iterable[Key] | None = None) -> DataFrame:
        """The rows of the parts, of all if ``keys`` is not given. No other file is opened."""
        _, parts = self.ledger()
        chosen = parts if keys is None else {k: parts[k] for k in keys if k in parts}
        paths = sorted(p.path for p in chosen.values() if p.path)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
