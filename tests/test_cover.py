"""Disjoint covers against a count of every day."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from pitpanel.operators.cover import disjoint_cover
from pitpanel.operators.joins import carried_join

D0 = datetime.date(2020, 1, 1)
SCHEMA = "permno long, valid_from date, valid_to date, covers string, tag long"


def day(i):
    return D0 + datetime.timedelta(days=i)


def spells(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(160):
        a = rng.randrange(60)
        b = None if rng.random() < 0.05 else a + rng.choice([-2, 0, 1, 3, 8, 30])
        rows.append((rng.choice([1, 1, 1, 2, 3, 4, None]), None if rng.random() < 0.03 else day(a), None if b is None else day(b), "x", rng.choice([i, 7])))
    return [*rows, rows[5], rows[5], (9, day(3), datetime.date(9999, 12, 31), "y", 1)]


def expected(rows, policy):
    """tag and number of intervals of each key and day."""
    out = {}
    for k in {r[0] for r in rows} - {None}:
        for i in range(100):
            held = [r for r in rows if r[0] == k and r[1] and r[1] <= day(i) <= (r[2] or datetime.date.max)]
            if held and (policy == "latest" or len(held) == 1):
                out[k, day(i)] = (max(held, key=lambda r: (r[1], r[2] or datetime.date.max, r[2] is not None, r[3], r[4]))[4], len(held))
    return out


@pytest.mark.parametrize("policy", ["latest", "reject"])
@pytest.mark.parametrize("seed", [1, 2])
def test_each_day(spark, seed, policy):
    rows = spells(seed)
    hist = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("covers", "name").repartition(5)
    cover = disjoint_cover(hist, policy=policy).cache()
    got, due = {}, expected(rows, policy)
    for r in cover.collect():
        for i in range(100):
            if r.valid_from <= day(i) <= (r.valid_to or datetime.date.max):
                assert (r.permno, day(i)) not in got  # disjoint
                got[r.permno, day(i)] = (r.tag, r.covers)
    assert got == due
    asked = spark.createDataFrame([(k, day(i)) for k in (1, 2, 3, 4, 9, 5) for i in range(100)], "permno long, date date")
    met = carried_join(asked, cover).where(F.col("tag").isNotNull()).collect()
    assert {(r.permno, r.date): (r.tag, r.covers) for r in met} == due


def test_none_and_unknown(spark):
    hist = spark.createDataFrame(spells(1), SCHEMA).drop("covers")
    assert disjoint_cover(hist.limit(0)).collect() == []
    with pytest.raises(ValueError):
        disjoint_cover(hist, policy="first")
