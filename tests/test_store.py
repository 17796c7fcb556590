"""The store of parts: crashes, two writers, torn ledgers; and runs that continue from states."""

import datetime

import pytest
from pyspark.sql import functions as F

from pitpanel.operators import factors, index, monthly
from pitpanel.sources.shared import scratch
from pitpanel.sources.store import Conflict, Months, Store, Weeks
from test_segments import SCHEMA, panel_rows, rounded

D0 = datetime.date(2021, 1, 1)
ROW = "permno long, date date, v double"


def frame(spark, rows):
    return spark.createDataFrame([(k, D0 + datetime.timedelta(days=d), v) for k, d, v in rows], ROW)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def root(spark):
    return scratch(spark, "store")


def test_only_changed_parts_are_written(spark, root):
    store = Store(spark, root, buckets=4)
    first = frame(spark, [(k, d, 1.0) for k in range(8) for d in range(0, 120, 10)])
    assert len(store.write(first)) == len({(r[0], r[1]) for r in store.marked(first).select("_period", "_bucket").distinct().collect()})
    assert store.write(first) == set() and store.versions() == [1]
    paths = {k: p.path for k, p in store.ledger()[1].items()}
    second = first.withColumn("v", F.when((F.col("permno") == 3) & (F.month("date") == 2), 9.0).otherwise(F.col("v")))
    changed = store.write(second)
    assert len(changed) == 1 and rows_of(store.read(ROW)) == rows_of(second)
    assert {k for k, p in store.ledger()[1].items() if p.path != paths[k]} == changed
    # a month that is given replaces the month; others stay
    store.write(second.where("permno = 1 and month(date) = 1"))
    assert rows_of(store.read(ROW)) == rows_of(second.where("month(date) > 1 or permno = 1"))


def test_crash_between_write_and_commit(spark, root):
    store, df = Store(spark, root, buckets=2), frame(spark, [(1, 0, 1.0), (2, 40, 2.0)])
    store.prepare(df)  # the writer dies here: files are there, the ledger is not
    assert store.ledger() == (0, {}) and store.read(ROW).collect() == []
    store.write(df)
    more = frame(spark, [(1, 0, 5.0)])
    store.prepare(more)
    again = Store(spark, root, buckets=2)
    assert rows_of(again.read(ROW)) == rows_of(df)
    assert again.write(more) and rows_of(again.read(ROW)) == rows_of(more.unionByName(df.where("permno = 2")))


def test_two_writers(spark, root):
    a, b = Store(spark, root, buckets=2), Store(spark, root, buckets=2)
    a.write(frame(spark, [(1, 0, 1.0), (1, 40, 1.0)]))
    version, mine = a.prepare(frame(spark, [(1, 0, 2.0)]))
    other, theirs = b.prepare(frame(spark, [(1, 40, 3.0)]))
    same, clash = b.prepare(frame(spark, [(1, 0, 4.0)]))
    assert version == other == same == 1
    assert b.commit(other, theirs) == 2 and a.commit(version, mine) == 3  # other parts: on top of each other
    assert [r[2] for r in rows_of(a.read(ROW))] == [2.0, 3.0]
    with pytest.raises(Conflict):
        b.commit(same, clash)
    assert [r[2] for r in rows_of(b.read(ROW))] == [2.0, 3.0]


def test_a_version_is_created_once(spark, root):
    a, b = Store(spark, root), Store(spark, root)
    assert a._create(1, {}) and not b._create(1, {})


def test_torn_ledger_is_passed_over(spark, root):
    store, df = Store(spark, root, buckets=1), frame(spark, [(1, 0, 1.0)])
    store.write(df)
    path, fs = store._path("_ledger/000000000002")
    out = fs.create(path, False)
    out.write(b'{"period": 1, "buck')
    out.close()
    assert store.ledger()[0] == 1 and rows_of(store.read(ROW)) == rows_of(df)
    store.write(frame(spark, [(1, 0, 7.0)]))
    assert store.ledger()[0] == 3 and store.versions() == [1, 2, 3]


def test_periods(spark):
    d = F.col("date")
    df = spark.sql("select explode(sequence(date'1969-12-01', date'2024-03-31')) as date")
    for p in (Months, Weeks):
        assert df.where((p.of(p.first(p.of(d))) != p.of(d)) | (p.first(p.of(d)) > d)).isEmpty()


def full(panel, lookback):
    f = factors.momentum(panel, lookback).select("permno", "session_index", "economic_series_ended", "has_required_history", "momentum")
    return f.join(index.wealth_path(panel).select("permno", "session_index", "index_status", "wealth_index"), ["permno", "session_index"])


COLUMNS = ("economic_series_ended", "has_required_history", "momentum", "index_status", "wealth_index")


def test_incremental_equals_full_and_reads_only_what_is_due(spark, root, monkeypatch):
    panel = spark.createDataFrame(panel_rows(5, entities=20, sessions=90), SCHEMA).withColumn("permno", F.col("permno").cast("long")).cache()
    given, facts, states = (Store(spark, f"{root}/{n}", period=Weeks, buckets=4) for n in ("panel", "factors", "states"))
    read, opened = given.read, []

    def watched(schema, keys=None):
        df = read(schema, keys)
        opened.extend(tuple(int(p.split("=")[1]) for p in f.split("/")[-3:-1]) for f in df.inputFiles())
        return df

    monkeypatch.setattr(given, "read", watched)
    columns = [c.split()[0] for c in monthly.PANEL.split(", ")]
    parts = given.marked(panel).select("_period").distinct()
    weeks = sorted(r[0] for r in parts.collect())
    upto = lambda df, i: df.where(given.period.of(F.col("date")) <= weeks[i]).select(*columns)
    for i in (3, 4, len(weeks) - 1):  # some weeks, one more, all
        given.write(upto(panel, i))
        opened.clear()
        monthly.update(given, facts, states, 6)
        assert rounded(facts.read(monthly.FACTORS), *COLUMNS) == rounded(full(upto(panel, i), 6), *COLUMNS)
        assert {p for p, _ in opened} == set(weeks[: i + 1] if i == 3 else weeks[4:5] if i == 4 else weeks[5:])
    # nothing has changed
    opened.clear()
    assert monthly.update(given, facts, states, 6) == set() and opened == []
    # one entity's return is corrected late: its bucket only, from that week on
    late = panel.withColumn("ret_total_backtest", F.when((F.col("permno") == 3) & (F.col("session_index") == 45), 0.07).otherwise(F.col("ret_total_backtest")))
    changed = given.write(late.select(*columns))
    assert len(changed) == 1
    (week, bucket), = changed
    opened.clear()
    redone = monthly.update(given, facts, states, 6)
    assert redone == {(w, bucket) for w in weeks if w >= week} and {b for _, b in opened} == {bucket} and min(opened)[0] == week
    assert rounded(facts.read(monthly.FACTORS), *COLUMNS) == rounded(full(late.select(*columns), 6), *COLUMNS)
    # another lookback is another run
    assert len(monthly.update(given, facts, states, 3)) == 4 * len(weeks)
    assert rounded(facts.read(monthly.FACTORS), *COLUMNS) == rounded(full(late.select(*columns), 3), *COLUMNS)
