"""Queries on tables where rows are equal or values are zero, against their SQL."""

import datetime
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from pitpanel.operators import normalize as no
from pitpanel.queries import ORACLES, QUERIES


def compared(spark, folder, name, columns):
    con = duckdb.connect()
    for f in folder.iterdir():
        con.execute(f"create view {f.stem} as select * from '{f}/*.parquet'")
    want = Counter(map(tuple, con.execute("select {} from ({}) x".format(", ".join(f'"{c}"' for c in columns.split(", ")), ORACLES[name])).fetchall()))
    got = Counter(tuple(r) for r in QUERIES[name](spark, str(folder)).selectExpr(*columns.split(", ")).collect())
    assert got == want
    return got


def test_table_diff_lists_each_copy(spark, tmp_path):
    """Key 5 is changed and key 7 lost; rows of both stand up to three times."""
    rows = [(5, 1, 9.0), (5, 1, 9.0), (5, 1, 10.0), (7, 2, 3.0), (7, 2, 3.0), (7, 2, 3.0), (8, 1, 1.0), (8, 1, 1.0)]
    df = spark.createDataFrame([(*r, datetime.datetime(1997, 1, 2)) for r in rows], "l_orderkey long, l_linenumber int, l_quantity double, l_shipdate timestamp_ntz")
    df.write.parquet(str(tmp_path / "lineitem.parquet"))
    got = compared(spark, tmp_path, "n10_table_diff", "l_orderkey, l_linenumber, year, quantity, surplus, side")
    assert got[7, 2, 1997, 3.0, 1, "left"] == 3 and got[5, 1, 1997, 9.0, 1, "left"] == 2


@pytest.mark.parametrize("n", [1, no.COPIES, no.COPIES + 1, 3 * no.COPIES - 1])
def test_each_copy_in_blocks(spark, n):
    diff = spark.createDataFrame([("a", n, "left"), ("b", -n, "right")], "k string, surplus long, side string")
    got = {r.k: (r.n, r.s) for r in no.each_copy(diff).groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("surplus").alias("s")).collect()}
    assert got == {"a": (n, n), "b": (n, -n)}


def test_causality_with_odd_next_prices(spark, tmp_path):
    """The first price after the date is 0, null, infinite, NaN or plain; some entities have none."""
    at = lambda d, h: datetime.datetime(2024, 1, d, h)
    ahead = {1: 0.0, 2: None, 3: float("inf"), 4: float("nan"), 5: 20.0, 6: 1e-300}
    rows = [(10 * u + i, at(d, 9), u, "view", 10.0 + i) for u in range(1, 9) for i, d in enumerate((15, 16, 17))]
    rows += [(10 * u + 5, at(18, 9), u, "view", v) for u, v in ahead.items()] + [(10 * u + 6, at(19, 9), u, "view", 7.0) for u in ahead]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").write.parquet(str(tmp_path / "events.parquet"))
    got = compared(spark, tmp_path, "k19_check_causality", "check, violations")
    assert dict(got)["leak:causal_if_cut", 8] == 1 and dict(got)["causal_if_cut", 0] == 1
