"""Literal fixtures: one month of sessions and six entities, and small series."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pitpanel.operators import audit, calendar, events, factors, features, index, joins, labels, normalize, panel
from pitpanel.operators.checks import check_causality, run_checks
from pitpanel.plans.windows import missing_sessions, plan_windows, planned_sessions
from pitpanel.schemas import DAILY, HISTORY, TERMINAL, ContractError, require_columns
from pitpanel.sources import extract, tables

D = lambda text: date.fromisoformat(text)
EVAL_START, EVAL_END, LOOKBACK, HORIZON = "2024-01-22", "2024-01-26", 3, 2
PLAN = {"train_start": "2024-01-12", "train_end": "2024-01-17", "eval_start": EVAL_START, "eval_end": EVAL_END, "cutoff": "2024-01-22 22:00:00"}


@pytest.fixture(scope="module")
def cal(spark):
    holidays = spark.createDataFrame([(D("2024-01-01"),), (D("2024-01-15"),)], "date date")
    return calendar.session_calendar(spark, "2024-01-01", "2024-01-31", holidays).cache()


def days(cal):
    return [r["date"] for r in cal.orderBy("date").collect()]


def daily_rows(sessions):
    out = []
    for d in sessions:
        row = {"date": d, "price_raw": 100.0, "ret_total": 0.0, "delist_flag": "N", "distribution_return_flag": "NO", "ret_missing_flag": "NA"}
        out.append(row | {"permno": 100, "ret_total": 0.01})
        for entity, final in ((200, -1.0), (201, None)):
            if d < D("2024-01-19"):
                out.append(row | {"permno": entity})
            elif d == D("2024-01-19"):
                out.append(row | {"permno": entity, "ret_total": final, "delist_flag": "Y", "distribution_return_flag": "D1"})
        out.append(row | {"permno": 300, "ret_total": None if d == D("2024-01-17") else 0.0})
        if d >= D("2024-01-23"):
            out.append(row | {"permno": 400})
        price = 100.0 if d < D("2024-01-16") else 50.0 if d < D("2024-01-18") else 49.0
        flag = {D("2024-01-16"): "S1", D("2024-01-18"): "C1"}.get(d, "NO")
        out.append(row | {"permno": 500, "price_raw": price, "distribution_return_flag": flag})
    return out


@pytest.fixture(scope="module")
def daily(spark, cal):
    rows = [
        (r["permno"], r["date"], r["price_raw"], 1e6, r["ret_total"], r["ret_total"], 1e4, r["delist_flag"], "A", "A", r["ret_missing_flag"], r["distribution_return_flag"])
        for r in daily_rows(days(cal))
    ]
    return spark.createDataFrame(rows, DAILY).cache()


@pytest.fixture(scope="module")
def history(spark):
    common = ("N", "NS", "EQTY", "COM", "Y", "CORP", "A", "RW", "X")
    spans = [(100, "2024-01-02", "2024-01-15", "OLD"), (100, "2024-01-16", "2024-01-31", "NEW")]
    spans += [(e, "2024-01-02", "2024-01-18", "T") for e in (200, 201)] + [(e, "2024-01-02", None, "T") for e in (300, 400, 500)]
    rows = [(e, D(a), D(b) if b else None, t, "C", *common) for e, a, b, t in spans]
    return spark.createDataFrame(rows, HISTORY).cache()


@pytest.fixture(scope="module")
def terminal(spark):
    rows = [(200, D("2024-01-18"), -1.0, "GDR", "S", "R", "P", None, None), (201, D("2024-01-18"), None, "GDR", "S", "R", "P", None, None)]
    return spark.createDataFrame(rows, TERMINAL).cache()


@pytest.fixture(scope="module")
def run(daily, history, terminal, cal):
    ev = panel.terminal_events(terminal, cal)
    p = panel.build_panel(daily, history, ev, cal).cache()
    f = features.build_features(factors.momentum(p, LOOKBACK), cal, 1, EVAL_END).cache()
    la = labels.build_labels(p.where(F.col("date") <= D(EVAL_END)), cal, HORIZON, EVAL_END).cache()
    return {"events": ev, "panel": p, "features": f, "labels": la, "audit": audit.training_audit(f, la, terminal, PLAN).cache()}


def one(df, **keys):
    for k, v in keys.items():
        df = df.where(F.col(k) == v)
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_calendar(spark, cal):
    assert len(days(cal)) == 21 and one(cal, date=D("2024-01-02"))["session_index"] == 0
    c = calendar.session_calendar(spark, "2024-03-08", "2024-03-11")
    assert [r["open_at"].hour for r in c.orderBy("date").collect()] == [14, 13]
    early = spark.createDataFrame([(D("2024-11-29"),)], "date date")
    assert one(calendar.session_calendar(spark, "2024-11-29", "2024-11-29", None, early), date=D("2024-11-29"))["close_at"] == datetime(2024, 11, 29, 18)
    before = calendar.session_calendar(spark, "2024-01-22", "2024-01-22", decision="preopen")
    assert one(before, date=D("2024-01-22"))["decision_time"] == datetime(2024, 1, 22, 14, 29)
    with pytest.raises(ContractError):
        calendar.session_calendar(spark, "2024-01-01", "2024-01-02", decision="noon")


def test_shift_and_next(spark, cal):
    df = spark.createDataFrame([(D("2024-01-12"),), (D("2024-01-13"),), (D("2024-01-31"),), (None,)], "day date")
    assert {r["day"]: r["shifted"] for r in calendar.shift_sessions(df, cal, "day", 1).collect()} == {D("2024-01-12"): D("2024-01-16"), D("2024-01-13"): None, D("2024-01-31"): None, None: None}
    assert {r["day"]: r["next_session"] for r in calendar.next_session(df, cal, "day").collect()} == {D("2024-01-12"): D("2024-01-16"), D("2024-01-13"): D("2024-01-16"), D("2024-01-31"): None, None: None}
    with pytest.raises(ContractError):
        calendar.shift_sessions(df, cal, "day", 1, strict=True)


def test_features(run):
    r = one(run["features"], permno=100, decision_date=D("2024-01-22"))
    assert r["observation_date"] == D("2024-01-19") and abs(r["momentum"] - (1.01**3 - 1)) < 1e-12 and r["available_at"] <= r["decision_time"]
    assert one(run["features"], permno=100, decision_date=D("2024-01-17"))["ticker_asof"] == "NEW"
    assert run["features"].where("permno = 200 and decision_date > '2024-01-19'").count() == 0


def test_preopen(daily, history, terminal, spark):
    holidays = spark.createDataFrame([(D("2024-01-01"),), (D("2024-01-15"),)], "date date")
    cal = calendar.session_calendar(spark, "2024-01-01", "2024-01-31", holidays, lag=0, decision="preopen")
    p = panel.build_panel(daily, history, panel.terminal_events(terminal, cal), cal)
    f = features.build_features(factors.momentum(p, LOOKBACK), cal, 1, EVAL_END)
    assert one(f, permno=100, decision_date=D("2024-01-22"))["observation_date"] == D("2024-01-19")


def test_panel_grades(run, daily):
    p = run["panel"]
    assert p.count() == daily.count()
    loss, gone = one(p, permno=200, date=D("2024-01-19")), one(p, permno=201, date=D("2024-01-19"))
    assert (loss["ret_total_backtest"], loss["return_source"], loss["has_metadata"], loss["terminal_reconciliation"]) == (-1.0, "TERMINAL_EMBEDDED", False, "MATCHED_VALUE")
    assert loss["ret_total_for_signal"] is None and loss["metadata_quality"] == "TERMINAL_OUTSIDE_METADATA"
    assert (gone["ret_total_backtest"], gone["return_quality"], gone["terminal_reconciliation"]) == (None, "MISSING_RETURN", "MATCHED_NULL")


def test_wealth_and_display(run):
    w = index.wealth_path(run["panel"])
    state = lambda e, d: tuple(one(w, permno=e, date=D(d))[c] for c in ("wealth_index", "index_status"))
    assert state(200, "2024-01-19") == (0.0, "ZERO_WEALTH")
    assert state(300, "2024-01-17") == (None, "MISSING_RETURN_OR_SESSION_GAP") == state(300, "2024-01-31")
    assert {r["wealth_index"] for r in w.where("permno = 500").collect()} == {1.0}
    r = one(index.rebase(w, EVAL_START), permno=400, date=D("2024-01-23"))
    assert (r["index_base100"], r["rebase_status"], r["later_first_valid_base100"]) == (None, "BASE_OBSERVATION_ABSENT", 100.0)


def test_labels_and_audit(run):
    assert one(run["labels"], permno=100, decision_date=D("2024-01-26"))["label_status"] == "PERIOD_END_TRUNCATED"
    assert one(run["labels"], permno=200, decision_date=D("2024-01-18"))["label_status"] == "TERMINAL_OUTCOME"
    state = lambda d: one(run["audit"], permno=100, decision_date=D(d))["outcome_disposition"]
    assert state("2024-01-22") == "LABEL_IMMATURE_CUTOFF" and state("2024-01-26") == "PERIOD_END_TRUNCATED"
    a = run["audit"]
    assert sum(r["feature_rows"] for r in audit.dropout_summary(a).collect()) == a.count() == run["features"].count()
    assert audit.training_set(run["features"], run["labels"], a, True).where("permno = 100").count() == 3
    with pytest.raises(ContractError):
        audit.training_set(run["features"], run["labels"].limit(0), a, True)


def test_gap_is_not_bridged(daily, history, terminal, cal):
    p = panel.build_panel(daily.where("not (permno = 100 and date = '2024-01-16')"), history, panel.terminal_events(terminal, cal), cal)
    la = labels.build_labels(p, cal, HORIZON, EVAL_END)
    f = features.build_features(factors.momentum(p, LOOKBACK), cal, 1, EVAL_END)
    a = audit.training_audit(f, la, terminal, PLAN).where("permno = 100 and feature_eligible")
    found = {r["decision_date"]: r["outcome_disposition"] for r in a.collect()}
    assert found[D("2024-01-12")] == "SESSION_GAP" and found[D("2024-01-16")] == "MISSING_DECISION_OBSERVATION"


def test_reverse_reconciliation(daily, terminal, cal):
    moved = terminal.withColumn("event_date", F.when(F.col("permno") == 200, D("2024-01-17")).otherwise(F.col("event_date")))
    states = lambda ev, d: sorted((r["permno"], r["reconciliation_status"]) for r in panel.reverse_reconciliation(panel.terminal_events(ev, cal), d).collect())
    assert states(moved, daily) == [(200, "EXPECTED_TERMINAL_FLAG"), (200, "UNMATCHED_TERMINAL_EVENT"), (201, "MATCHED_NULL")]
    assert states(terminal, daily.where("delist_flag = 'N' or permno = 201")) == [(200, "MISSING_TERMINAL_DAILY_ROW"), (201, "MATCHED_NULL")]


def test_storage_dates(terminal, cal):
    given = terminal.withColumn("DelDlyDt", F.lit("2024-01-19").cast("date"))
    assert {r["storage_date_basis"] for r in panel.terminal_events(given, cal).collect()} == {"SOURCE_STORAGE_DATE"}
    with pytest.raises(ContractError):
        panel.terminal_events(given.withColumn("return_storage_date", F.col("DelDlyDt")), cal)
    with pytest.raises(ContractError):
        panel.terminal_events(terminal.withColumn("deldlydt", F.col("event_date")), cal)


@pytest.mark.parametrize(
    ("ret", "flag", "dist", "delist", "grade"),
    [
        (float("nan"), "NA", "NO", "N", "INVALID_RETURN"), (float("inf"), "NA", "NO", "N", "INVALID_RETURN"), (-1.01, "NA", "NO", "N", "INVALID_RETURN"),
        (-1.0, "NA", "NO", "N", "VALID_VENDOR_RETURN"), (0.0, "NA", "NO", "N", "VALID_VENDOR_RETURN"), (None, "NA", "NO", "N", "MISSING_RETURN"),
        (0.1, "MV", "NO", "N", "INCOMPLETE_VENDOR_RETURN"), (0.1, None, "NO", "N", "INCOMPLETE_VENDOR_RETURN"), (0.1, "NA", "ZZ", "N", "UNKNOWN_DISTRIBUTION_FLAG"),
        (0.1, "NA", None, "N", "UNKNOWN_DISTRIBUTION_FLAG"), (0.1, "NA", "NO", None, "UNKNOWN_DELISTING_FLAG"), (0.1, "NA", "NO", "Y", "UNMATCHED_TERMINAL_EVENT"),
    ],
)
def test_grades(spark, history, terminal, cal, ret, flag, dist, delist, grade):
    row = [(300, D("2024-01-10"), 100.0, 1e6, ret, ret, 1e4, delist, "A", "A", flag, dist)]
    p = panel.build_panel(spark.createDataFrame(row, DAILY), history, panel.terminal_events(terminal, cal), cal)
    assert p.first()["return_quality"] == grade


def test_event_missing_flags(daily, history, terminal, cal):
    flagged = terminal.withColumn("delretmisstype", F.lit("MV"))
    p = panel.build_panel(daily, history, panel.terminal_events(flagged, cal), cal)
    assert one(p, permno=200, date=D("2024-01-19"))["return_quality"] == "TERMINAL_MISSING_FLAG_MISMATCH"


def series(spark, values):
    return spark.createDataFrame([(1, i, D("2024-01-02") + timedelta(i), v) for i, v in enumerate(values)], "permno long, session_index long, date date, ret_total double")


@pytest.mark.parametrize(("given", "path"), [([0.0, None, 0.1], [1.0, None, None]), ([-1.0, 0.5, 0.0], [0.0, 0.0, 0.0]), ([-1.0, None], [0.0, None])])
def test_compounding(spark, given, path):
    assert [r["wealth"] for r in index.compound_returns(series(spark, given)).orderBy("session_index").collect()] == path


def test_record_momentum(spark):
    got = [r["momentum"] for r in factors.rolling_momentum(series(spark, [0.1, -1.0, 0.2, 0.3]), 2).orderBy("session_index").collect()]
    assert got == [None, -1.0, None, None]
    assert [r["index"] for r in index.portfolio_index(series(spark, [0.1, -1.0])).orderBy("step").collect()] == pytest.approx([100.0, 110.0, 0.0])


def test_rebase_fallback(spark):
    rows = [(1, D("2024-01-02"), None), (1, D("2024-01-03"), 2.0), (1, D("2024-01-04"), 3.0), (2, D("2024-01-02"), 0.0), (2, D("2024-01-03"), 0.0)]
    ix = spark.createDataFrame(rows, "permno long, date date, wealth_index double")
    got = {(r["permno"], r["date"].day): (r["status"], r["rebased"]) for r in index.rebase_with_fallback(ix, "2024-01-02", "first_valid_after_base").collect()}
    assert got[(1, 4)] == ("first_valid_after_base", 150.0) and got[(2, 3)] == ("zero_base", None)
    assert {r["status"] for r in index.rebase_with_fallback(ix, "2024-01-02").where("permno = 1").collect()} == {"missing_base"}


def test_causality(daily, history, terminal, cal):
    ev = panel.terminal_events(terminal, cal)

    def build(d):
        return features.build_features(factors.momentum(panel.build_panel(d, history, ev, cal), LOOKBACK), cal, 1, EVAL_END)

    changed = daily.withColumn("ret_total", F.when(F.col("date") > D("2024-01-17"), 0.5).otherwise(F.col("ret_total")))
    assert {r["violations"] for r in check_causality(build, daily, "2024-01-17", changed).collect()} == {0}
    past = daily.withColumn("ret_total", F.when(F.col("date") == D("2024-01-10"), 0.5).otherwise(F.col("ret_total")))
    assert {r["check"] for r in check_causality(build, daily, "2024-01-17", past).where("violations > 0").collect()} == {"causal_if_changed"}


def test_held_outcomes(spark, run):
    holdings = spark.createDataFrame([(D("2024-01-19"), e) for e in (100, 200, 201, 500, 999)], "interval_date date, permno long")
    got = {r["permno"]: r["reason"] for r in events.held_outcomes(holdings, run["panel"]).collect()}
    assert got == {100: None, 200: "HELD_OUTCOME_REQUIRES_REVIEW", 201: "MISSING_RETURN", 500: None, 999: "MISSING_HELD_SECURITY"}
    twice = run["panel"].unionByName(run["panel"].where("permno = 100"))
    assert {r["permno"]: r["reason"] for r in events.held_outcomes(holdings, twice).collect()}[100] == "DUPLICATE_HELD_OBSERVATION"
    cash = {r["permno"]: r["reason"] for r in events.held_outcomes(holdings, run["panel"], "cash_shares").collect()}
    assert cash[200] == "UNSUPPORTED_CASH_SHARE_SETTLEMENT" and cash[100] is None


def test_accounting_steps(spark):
    pos = spark.createDataFrame([(1, D("2024-01-02"), 10.0), (2, D("2024-01-02"), 10.0), (3, D("2024-01-02"), float("nan"))], "permno long, date date, shares double")
    splits = spark.createDataFrame([(1, D("2024-01-02"), 2.0), (2, D("2024-01-02"), 0.0)], "permno long, date date, ratio double")
    assert {r["permno"]: (r["adjusted_shares"], r["violation"]) for r in events.apply_splits(pos, splits).collect()} == {1: (20.0, False), 2: (None, True), 3: (None, True)}
    steps = spark.createDataFrame([(1.0, 0.5, 0.0), (1.0, None, 0.0), (1.0, 0.1, 5.0)], "wealth double, ret_total double, cash double")
    assert [r["wealth_after"] for r in events.wealth_step(steps, cash="cash").collect()] == [1.5, None, None]


def test_identity(history):
    r = one(events.identity_changes(history), permno=100)
    assert (r["previous_ticker"], r["ticker"], r["effective_date"]) == ("OLD", "NEW", D("2024-01-16"))


def test_plan(spark, cal):
    config = "config_id long, eval_start date, eval_end date, lookback long, training long, horizon long, lag long, preopen boolean"
    rows = [(1, D(EVAL_START), D(EVAL_END), 3, 3, 2, 1, False), (2, D("2024-01-20"), D(EVAL_END), 3, 3, 2, 1, False), (3, D(EVAL_START), D(EVAL_END), 30, 0, 2, 1, False)]
    plan = plan_windows(cal, spark.createDataFrame(rows, config), "2024-01-02", "2024-01-31").cache()
    got = {r["config_id"]: r for r in plan.collect()}
    assert (got[1]["training_start"], got[1]["training_end"], got[1]["process_start"], got[1]["problem"]) == (D("2024-01-12"), D("2024-01-17"), D("2024-01-09"), None)
    assert got[2]["problem"] == "EVALUATION_BOUND_IS_NO_SESSION" and got[3]["problem"] == "NOT_ENOUGH_HISTORY"
    assert planned_sessions(plan, cal).where("role = 'EVALUATION'").count() == 5
    seen = cal.where("date <> '2024-01-10'")
    assert [r["date"] for r in missing_sessions(plan, cal, seen).collect()] == [D("2024-01-10")]
    with pytest.raises(ContractError):
        plan_windows(cal, spark.createDataFrame(rows, config), "2024-01-02", "2024-01-31", strict=True)


def test_contracts(spark, daily, history):
    with pytest.raises(ContractError):
        require_columns(daily.drop("date"), DAILY)
    with pytest.raises(ContractError):
        normalize.assert_same_count(daily, daily.limit(1))
    doubled = history.unionByName(history.where("permno = 100").limit(1))
    with pytest.raises(ContractError):
        joins.assert_row_preserving(daily, joins.interval_join(daily, doubled), ["permno", "date"])
    with pytest.raises(ContractError):
        extract.clip(daily, "2030-01-01", "2030-02-01")
    assert extract.clip(daily, "2020-01-01", "2024-01-10") == ("2024-01-02", "2024-01-10")


def test_interval_faults(spark):
    rows = [(1, D("2024-01-01"), D("2024-12-31")), (1, D("2024-02-01"), D("2024-02-10")), (1, D("2024-03-01"), None), (2, D("2024-05-01"), D("2024-04-01"))]
    h = spark.createDataFrame(rows, "permno long, valid_from date, valid_to date")
    assert normalize.overlaps(h).count() == 1 and normalize.overlaps(h, all_pairs=True).count() == 2
    assert normalize.bad_intervals(h).count() == 1


def test_writes(spark, tmp_path, daily):
    root = str(tmp_path)
    first = tables.write_months(daily, f"{root}/months")
    assert tables.pending_months(daily, first, "1").count() == 0 and tables.pending_months(daily, first, "2").count() == 1
    changed = daily.withColumn("price_raw", F.col("price_raw") + 1)
    assert tables.write_months(changed, f"{root}/months", first).count() == 1
    assert tables.read_panel(spark, f"{root}/months", 2024, 1).where("price_raw >= 50").count() == daily.count()
    assert tables.verify_written(daily, f"{root}/verified") == daily.count()
    name = tables.run_id({"a": 1}, {"daily": daily})
    assert name == tables.run_id({"a": 1}, {"daily": daily.orderBy(F.desc("date"))}) != tables.run_id({"a": 2}, {"daily": daily})
    tables.publish_run({"daily": daily}, root, name)
    assert [r["agrees"] for r in tables.verify_run(spark, root, name).collect()] == [True]
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        tables.publish_run({"daily": daily}, root, name)
    with pytest.raises(ContractError):
        tables.publish_run({"daily": daily}, root, name, [root])
    daily.limit(3).write.mode("overwrite").parquet(f"{root}/{name}/daily")
    assert [r["agrees"] for r in tables.verify_run(spark, root, name).collect()] == [False]
    counts = tables.file_counts(spark.read.parquet(f"{root}/verified"))
    assert {r["agrees"] for r in tables.file_counts(spark.read.parquet(f"{root}/verified"), counts).collect()} == {True}


@pytest.fixture(scope="module")
def published(spark, run, daily, history, terminal, cal, tmp_path_factory):
    """The tables of a run, its plan and how its checks come out with some tables changed."""
    plan = PLAN | {"process_start": "2024-01-01", "base_date": EVAL_START}
    stored = panel.terminal_events(terminal, cal)
    t = {"daily": daily, "history": history, "events": stored, "calendar": cal, "panel": run["panel"].where(F.col("date") <= F.lit(EVAL_END).cast("date")), "reconciliation": panel.reverse_reconciliation(stored, daily)}
    t["evidence"] = events.event_evidence(t["panel"])
    t["features"] = features.build_features(factors.momentum(t["panel"], LOOKBACK), cal, 1, EVAL_END)
    t["evaluation"] = features.evaluation_features(t["features"], EVAL_START, EVAL_END)
    t["labels"] = labels.build_labels(t["panel"], cal, HORIZON, EVAL_END)
    t["audit"] = audit.training_audit(t["features"], t["labels"], terminal, PLAN)
    t["training"] = audit.training_set(t["features"], t["labels"], t["audit"])
    t["summary"] = audit.dropout_summary(t["audit"])
    t["display"] = index.rebase(index.wealth_path(t["panel"]), EVAL_START)
    status, report = audit.run_status(t["panel"], t["reconciliation"]), audit.dropout_report(t["audit"])
    root = str(tmp_path_factory.mktemp("published"))
    names = ("panel", "features", "evaluation", "training", "labels", "display", "evidence", "calendar", "audit", "summary", "reconciliation", "daily")
    tables.publish_run({n: t[n] for n in names}, root, "run")
    stored_t = t | {n: spark.read.parquet(f"{root}/run/{n}") for n in names}

    def violations(changed, *only):
        found = run_checks(stored_t | changed, plan, {"offset": 1, "horizon": HORIZON}, status, report, None if only else (spark, root, "run"))
        rows = (found.where(F.col("check").isin(*only)) if only else found).collect()
        assert all(r["passed"] == (r["violations"] == 0) for r in rows)
        return {r["check"]: r["violations"] for r in rows}

    return stored_t, violations


def test_run_checks_pass_on_an_undamaged_run(published):
    found = published[1]({})
    assert len(found) >= 80 and {n: v for n, v in found.items() if v} == {}


def test_dropped_candidate_is_caught(published):
    t, violations = published
    found = violations({"audit": t["audit"].where("not (permno = 100 and decision_date = date '2024-01-16')")}, "audit_has_features", "candidates_equal_report", "summary_totals")
    assert found["audit_has_features"] == 1 and found["candidates_equal_report"] == 1 and found["summary_totals"] > 0


def test_terminal_outcome_marked_as_included_is_caught(published):
    t, violations = published
    marked = F.col("training_included") | (F.col("training_candidate") & (F.col("outcome_disposition") == "TERMINAL_OUTCOME"))
    found = violations({"audit": t["audit"].withColumn("training_included", marked)}, "included_is_usable", "training_is_included")
    assert found["included_is_usable"] > 0 and found["training_is_included"] > 0


def test_dropped_reconciliation_is_caught(published):
    t, violations = published
    found = violations({"reconciliation": t["reconciliation"].where("permno <> 200")}, "no_terminal_row_lost", "no_event_lost")
    assert found["no_terminal_row_lost"] == 1 and found["no_event_lost"] == 1


@pytest.mark.parametrize(
    "table, column, value, check",
    [
        ("features", "price_raw", "price_raw + 1", "feature_values_preserved"),
        ("features", "available_at", "decision_time + interval 1 second", "feature_available"),
        ("features", "observation_date", "decision_date", "feature_offset"),
        ("evaluation", "decision_date", "date '2024-01-16'", "evaluation_range"),
        ("training", "forward_vendor_return", "forward_vendor_return + 1", "training_equals_labels"),
        ("labels", "forward_vendor_return", "1.0D", "unobserved_is_null"),
        ("labels", "observed_sessions", "1L", "complete_has_horizon"),
        ("panel", "ret_total_backtest", "0.0D", "unresolved_not_filled"),
        ("panel", "ret_total", "ret_total + 1", "source_rows_preserved"),
        ("panel", "action_type", "'LOS'", "terminal_evidence_preserved"),
        ("panel", "ledger_status", "'no_posting_required'", "ledger_fails_closed"),
        ("evidence", "ret_total_vendor", "0.5D", "evidence_keeps_outcome"),
        ("display", "index_base100", "index_base100 + 1", "base_is_100"),
        ("reconciliation", "actual_daily_date", "event_date", "reconciliation_keeps_dates"),
    ],
)
def test_damage_is_caught(published, table, column, value, check):
    t, violations = published
    assert violations({table: t[table].withColumn(column, F.expr(value))}, check)[check] > 0


def test_carried_join(spark):
    rows = [(1, D("2020-01-01") + timedelta(days=i % 400), i) for i in range(4000)] + [(2, D("2020-03-01"), -1), (3, None, -2), (None, D("2020-01-05"), -3), (None, D("2020-01-05"), -3)]
    spans = [(1, D("2020-01-01") + timedelta(days=4 * i), D("2020-01-01") + timedelta(days=4 * i + i % 4) if i < 90 else None, f"v{i}") for i in range(91)] + [(2, D("2020-04-01"), None, "late"), (None, D("2020-01-01"), None, "x")]
    df, h = spark.createDataFrame(rows, "permno long, date date, n long"), spark.createDataFrame(spans, "permno long, valid_from date, valid_to date, v string")
    for open_end in (True, False):
        due = joins.interval_join(df, h, open_end=open_end).select("permno", "date", "n", "valid_from", "valid_to", "v")
        got = joins.carried_join(df, h, open_end=open_end)
        assert got.columns == due.columns and sorted(map(str, got.collect())) == sorted(map(str, due.collect()))


def test_months_are_pruned_split_and_typed(spark, tmp_path, daily):
    root = str(tmp_path / "months")
    whole = daily.unionByName(daily.withColumn("date", F.add_months("date", 1)))
    tables.write_months(whole, root, file_rows=20)
    january = tables.read_panel(spark, root, 2024, 1)
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and january.count() == daily.count()
    assert len(january.inputFiles()) > 1 and tables.read_panel(spark, root).count() == whole.count()
    tables.write_months(daily.limit(5), root, force=True)  # replaces January only
    assert tables.read_panel(spark, root).count() == 5 + daily.count()
    assert require_columns(daily, DAILY, types=True) is daily
    with pytest.raises(ContractError, match="permno is string, not bigint"):
        require_columns(daily.withColumn("permno", F.col("permno").cast("string")), DAILY, types=True)


def test_empty_tables(daily, history, terminal, cal):
    none = daily.limit(0)
    p = panel.build_panel(none, history.limit(0), panel.terminal_events(terminal.limit(0), cal), cal)
    assert p.count() == 0 and index.wealth_path(p).count() == 0
    assert features.build_features(factors.momentum(p, 3), cal, 1, EVAL_END).count() == 0
    assert normalize.conditional_counts(none, {"x": F.col("ret_total").isNull()}).first()["rows"] == 0
