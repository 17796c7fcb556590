"""Tables that many steps read are built once: what those steps read are the written files."""

from pitpanel.queries import QUERIES
from pitpanel.queries import runs as ru
from pitpanel.queries.base import PUBLISHED, Run
from pitpanel.sources.store import Store

SF = "/root/testdata/sf0.001"


def read_by(df):
    """The first part of the folders that a table is read from: the name it was stored under."""
    return {f.split("/")[-2].rsplit("-", 1)[0] for f in df.inputFiles()}


def test_suite_reads_written_tables(spark):
    found = read_by(QUERIES["k_run_checks"](spark, SF))
    assert "events.parquet" not in " ".join(found) and {"run-run_panel", "run-features", "run-audit", "run-display"} <= found
    assert not any("sf0" in f for f in found)


def test_published_tables_come_from_kept_ones(spark, monkeypatch):
    given = {}
    publish = ru.ta.publish_run
    monkeypatch.setattr(ru.ta, "publish_run", lambda tables, *a: (given.update(tables), publish(tables, *a))[1])
    QUERIES["k1_check_artifacts"](spark, SF)
    assert {n: read_by(df) for n, df in given.items() if n != "features"} == {n: {f"run-{p}"} for n, p in (("panel", "run_panel"), ("reconciliation", "reconciliation"), ("labels", "labels"))}
    assert read_by(given["features"]) == {"run-run_panel", "run-cal"}


def test_stores_are_given_written_rows(spark, monkeypatch):
    given, write = [], Store.write
    monkeypatch.setattr(Store, "write", lambda self, df, *a: (given.append(read_by(df)), write(self, df, *a))[1])
    QUERIES["s15_incremental_run"](spark, SF)
    assert given.count({"incremental-panel"}) == 2 and len(given) >= 6
    assert all(g in ({"incremental-panel"}, {"monthly-factors"}, {"monthly-states"}) for g in given)


def test_a_kept_table_equals_a_built_one(spark):
    built, kept = Run(spark, SF), Run(spark, SF, keep=PUBLISHED)
    for name in ("cal", "terminal", "run_panel"):
        a, b = getattr(built, name), getattr(kept, name)
        assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
