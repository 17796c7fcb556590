"""Windows, features, labels, audits, aggregates and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as ag
from ..operators import audit as au
from ..operators import factors as fa
from ..operators import index as ix
from ..operators import labels as la
from ..operators import normalize as no
from ..operators import panel as pa
from ..operators import segments as sg
from .base import AUDIT, FACTORS, FEATURES, LABELS, LOOKBACK, P, PANEL, PLAN, RATE, SUMMARY, WEALTH, HORIZON, Run, near, query, sql_near, table
from .joins import REVERSE, UNIVERSE

# fmt: off
BY = "partition by permno order by session_index"
UPTO = f"({BY} rows between unbounded preceding and current row)"


@query(f"{FACTORS} select permno, date, window_rows, valid_rows, first_session, loss_rows from factors")
def w1_rolling_stats(spark, sf):
    return fa.rolling_stats(Run(spark, sf).run_panel, LOOKBACK).select("permno", "date", "window_rows", "valid_rows", "first_session", "loss_rows")


@query(f"{FACTORS} select permno, date, economic_series_ended from factors")
def w2_series_ended(spark, sf):
    return fa.series_ended(Run(spark, sf).run_panel).select("permno", "date", "economic_series_ended")


SEGMENT = 5  # sessions; so short that the given months have several


@query(f"{FACTORS} select permno, date, economic_series_ended from factors")
def w2_series_ended_in_segments(spark, sf):
    return sg.series_ended(Run(spark, sf).run_panel, SEGMENT).select("permno", "date", "economic_series_ended")


@query(f"{FACTORS} select permno, date, has_required_history, {sql_near('momentum')} as momentum from factors")
def w3_momentum_in_segments(spark, sf):
    found = sg.momentum(Run(spark, sf).run_panel, LOOKBACK, SEGMENT)
    return found.select("permno", "date", "has_required_history", near("momentum").alias("momentum"))


@query(f"{FACTORS} select permno, date, has_required_history, {sql_near('momentum')} as momentum from factors")
def w3_momentum(spark, sf):
    return Run(spark, sf).factors.select("permno", "date", "has_required_history", near("momentum").alias("momentum"))


@query(f"{LABELS} select permno, date, observed_sessions, valid_sessions, terminal_sessions, missing_return_sessions, incomplete_return_sessions, {sql_near('forward_log')} as forward_log from ahead")
def w4_forward_window(spark, sf):
    return la.forward_window(Run(spark, sf).run_panel, HORIZON).select(
        "permno", "date", "observed_sessions", "valid_sessions", "terminal_sessions", "missing_return_sessions", "incomplete_return_sessions", near("forward_log").alias("forward_log"))


@query(f"{WEALTH} select permno, date, seed_date from seeded")
def w5_seed_date(spark, sf):
    return ix.seed_date(Run(spark, sf).run_panel).select("permno", "date", "seed_date")


@query(f"{WEALTH} select permno, date, index_anchor_date, index_status, {sql_near('wealth_index')} as wealth_index from wealth")
def w6_wealth_path(spark, sf):
    return Run(spark, sf).wealth.select("permno", "date", "index_anchor_date", "index_status", near("wealth_index").alias("wealth_index"))


@query(f"""{WEALTH}, r as (select w.*, b.permno is not null as has_base, b.wealth_index as base from wealth w left join wealth b on b.permno = w.permno and b.date = date '{PLAN['base_date']}')
  select permno, date, {sql_near('case when base > 0 and isfinite(base) then 100 * wealth_index / base end')} as index_base100,
    case when not has_base then 'BASE_OBSERVATION_ABSENT' when base is null then 'BASE_VALUE_MISSING' when base = 0 then 'BASE_VALUE_ZERO' when wealth_index is null then 'PATH_INCOMPLETE' else 'VALID' end as rebase_status,
    {sql_near(f"case when not has_base and index_anchor_date > date '{PLAN['base_date']}' then 100 * wealth_index end")} as later_first_valid_base100 from r""")
def w7_rebase(spark, sf):
    return Run(spark, sf).display.select("permno", "date", near("index_base100").alias("index_base100"), "rebase_status", near("later_first_valid_base100").alias("later_first_valid_base100"))


@query(f"""{WEALTH}, m as (select permno, max(case when date = date '{PLAN['base_date']}' then wealth_index end) as base,
      min(case when date > date '{PLAN['base_date']}' and wealth_index > 0 then date end) as first from wealth group by 1),
  v as (select m.*, w.wealth_index as first_value from m left join wealth w on w.permno = m.permno and w.date = m.first)
  select w.permno, w.date, case when base = 0 then 'zero_base' when base is not null then 'exact_base' when first is not null then 'first_valid_after_base' else 'missing_base' end as status,
    case when base > 0 then date '{PLAN['base_date']}' when base is null then first end as actual_base_date,
    {sql_near('100 * (wealth_index / case when base is null then first_value when base > 0 then base end)')} as rebased from wealth w join v on v.permno = w.permno""")
def w8_rebase_with_fallback(spark, sf):
    return ix.rebase_with_fallback(Run(spark, sf).wealth, PLAN["base_date"], "first_valid_after_base").select("permno", "date", "status", "actual_base_date", near("rebased").alias("rebased"))


@query(f"{WEALTH} select permno, date, index_anchor_date, index_status, {sql_near('wealth_index')} as wealth_index from wealth")
def w6_wealth_path_in_segments(spark, sf):
    found = sg.wealth_path(Run(spark, sf).run_panel, SEGMENT)
    return found.select("permno", "date", "index_anchor_date", "index_status", near("wealth_index").alias("wealth_index"))


COMPOUND = "if(count(*) over w = count(ret_total) over w, {0} * product(1 + ret_total) over w, null)"
WIN = f"window w as ({BY} rows between unbounded preceding and current row)"


@query(f"{PANEL} select permno, date, {sql_near(COMPOUND.format('1.0'))} as wealth from panel {WIN}")
def w9_compound_returns(spark, sf):
    return ix.compound_returns(Run(spark, sf).run_panel).select("permno", "date", near("wealth").alias("wealth"))


@query(f"{PANEL} select permno, date, {sql_near(COMPOUND.format('1.0'))} as wealth from panel {WIN}")
def w9_compound_returns_in_segments(spark, sf):
    return sg.compound_returns(Run(spark, sf).run_panel, size=SEGMENT).select("permno", "date", near("wealth").alias("wealth"))


@query(f"""{PANEL}, x as (select permno, date, ret_total, count(*) over w as n, count(ret_total) over w as k, product(1 + ret_total) over w as g,
    coalesce(bool_or(ret_total = -1) over ({BY} rows between unbounded preceding and 1 preceding), false) as ended from panel window w as ({BY} rows between {LOOKBACK - 1} preceding and current row))
  select permno, date, {sql_near(f"case when n = {LOOKBACK} and k = {LOOKBACK} and not ended then g - 1 end")} as momentum from x""")
def w10_rolling_momentum(spark, sf):
    return fa.rolling_momentum(Run(spark, sf).run_panel, LOOKBACK).select("permno", "date", near("momentum").alias("momentum"))


@query(f"""{PANEL} select permno, cast(0 as bigint) as step, 100.0::double as index from (select distinct permno from panel) d
  union all select permno, row_number() over ({BY}) as step, {sql_near(COMPOUND.format('100.0'))} as index from panel {WIN}""")
def w11_portfolio_index(spark, sf):
    return ix.portfolio_index(Run(spark, sf).run_panel).select("permno", "step", near("index").alias("index"))


@query(f"{PANEL} select permno, date, lag(price_raw) over ({BY}) as previous_price from panel")
def w12_previous(spark, sf):
    return no.previous(Run(spark, sf).run_panel, "permno", ["session_index"], "price_raw", "previous_price").select("permno", "date", "previous_price")


@query(f"{FEATURES} select permno, decision_date, observation_date, price_raw, observed_total_return, {sql_near('momentum')} as momentum, has_required_history, eligible_for_research, metadata_quality from features")
def f1_build_features(spark, sf):
    return Run(spark, sf).features.select("permno", "decision_date", "observation_date", "price_raw", "observed_total_return", near("momentum").alias("momentum"), "has_required_history", "eligible_for_research", "metadata_quality")


@query(f"{FEATURES} select permno, decision_date, {sql_near('momentum')} as momentum from features where decision_date between date '{PLAN['eval_start']}' and date '{PLAN['eval_end']}'")
def f2_evaluation_features(spark, sf):
    return Run(spark, sf).evaluation.select("permno", "decision_date", near("momentum").alias("momentum"))


@query(f"{LABELS} select permno, decision_date, label_end_date, label_status, period_end_truncated, has_session_gap, {sql_near('forward_vendor_return')} as forward_vendor_return, available_at is null as availability_unknown from labels")
def f3_build_labels(spark, sf):
    return Run(spark, sf).labels.select("permno", "decision_date", "label_end_date", "label_status", "period_end_truncated", "has_session_gap", near("forward_vendor_return").alias("forward_vendor_return"), F.col("available_at").isNull().alias("availability_unknown"))


@query(f"{LABELS} select permno, decision_date, label_end_date, {sql_near('forward_vendor_return')} as forward_vendor_return from labels where label_end_time <= timestamp '{PLAN['cutoff']}' and available_at <= timestamp '{PLAN['cutoff']}'")
def f4_mature_labels(spark, sf):
    return la.mature_labels(Run(spark, sf).labels, PLAN["cutoff"]).select("permno", "decision_date", "label_end_date", near("forward_vendor_return").alias("forward_vendor_return"))


@query(f"{AUDIT} select permno, decision_date, decision_year, exchange_observed, sample_role, training_candidate, eventual_delisting_in_snapshot, label_status, outcome_disposition, training_included, training_disposition from audit")
def f5_training_audit(spark, sf):
    return Run(spark, sf).audit.select("permno", "decision_date", "decision_year", "exchange_observed", "sample_role", "training_candidate", "eventual_delisting_in_snapshot", "label_status", "outcome_disposition", "training_included", "training_disposition")


@query(f"""{AUDIT} select f.permno, f.decision_date, f.price_raw, {sql_near('f.momentum')} as momentum, {sql_near('a.forward_vendor_return')} as label from features f
  join audit a on a.permno = f.permno and a.decision_date = f.decision_date where a.training_included""")
def f6_training_set(spark, sf):
    return Run(spark, sf).training.select("permno", "decision_date", "price_raw", near("momentum").alias("momentum"), near("forward_vendor_return").alias("label"))


@query(f"{SUMMARY} select *, {RATE.format('training_excluded', 'training_candidates')} as dropout_rate from summary")
def f7_dropout_summary(spark, sf):
    return Run(spark, sf).summary


@query(f"""{SUMMARY}, c as (select * from audit where training_candidate)
  select 'total' as kind, 'all' as name, count(*) as candidates, count(*) filter (where not training_included) as excluded, {RATE.format('count(*) filter (where not training_included)', 'count(*)')} as rate from c
  union all select 'disposition', training_disposition, count(*), count(*) filter (where not training_included), null from c group by 2
  union all select 'warning', concat_ws('|', cast(decision_year as varchar), coalesce(exchange_observed, '?'), cast(eventual_delisting_in_snapshot as varchar)), training_candidates, training_excluded, {RATE.format('training_excluded', 'training_candidates')}
    from summary where sample_role = 'TRAINING' and {RATE.format('training_excluded', 'training_candidates')} >= 0.1""")
def f8_dropout_report(spark, sf):
    return au.dropout_report(Run(spark, sf).audit)


@query(f"""{PANEL}, rec as ({REVERSE}), n as (select (select count(*) from panel where return_quality <> 'VALID_VENDOR_RETURN') as unresolved_returns, (select count(*) from panel where not has_metadata) as missing_metadata,
    (select count(*) from panel where requires_review) as review_rows, (select count(*) from rec where reconciliation_status not in ('MATCHED_VALUE', 'MATCHED_NULL')) as unresolved_events)
  select *, case when unresolved_returns > 0 or unresolved_events > 0 then 'INCOMPLETE_RETURNS' when missing_metadata > 0 then 'INCOMPLETE_METADATA' else 'RESEARCH_ONLY' end as status from n""")
def f9_run_status(spark, sf):
    return Run(spark, sf).status


@query(f"{PANEL} select return_quality, metadata_quality, terminal_reconciliation, count(*) as rows from fullpanel group by 1, 2, 3")
def a1_status_counts(spark, sf):
    return ag.status_counts(Run(spark, sf).panel, ["return_quality", "metadata_quality", "terminal_reconciliation"])


@query(f"{P} select count(*) as rows, count(*) filter (where ret_total is null) as missing, count(*) filter (where ret_total = -1) as losses, count(*) filter (where price_raw > 100) as dear from daily")
def a2_conditional_counts(spark, sf):
    r = F.col("ret_total")
    return no.conditional_counts(Run(spark, sf).daily, {"missing": r.isNull(), "losses": r == -1, "dear": F.col("price_raw") > 100})


@query(f"{UNIVERSE} select count(*) as rows, count(distinct permno) as entities, count(distinct case when is_investable then permno end) as investable_entities from universe")
def a3_universe_summary(spark, sf):
    r = Run(spark, sf)
    return ag.universe_summary(pa.universe_flags(r.daily, r.history))


@query(f"{UNIVERSE} select date, count(*) filter (where is_investable) as investable, count(*) as rows from universe group by 1")
def a4_investable_by_date(spark, sf):
    r = Run(spark, sf)
    return ag.investable_by_date(pa.universe_flags(r.daily, r.history))


CLASS = "share_type, security_type, security_subtype, us_incorporated_flag, issuer_type"


@query(f"{P} select {CLASS}, count(*) as intervals, count(distinct permno) as entities from history group by {CLASS} order by entities desc, intervals desc, {CLASS} limit 40")
def a5_classification_top(spark, sf):
    return ag.classification_top(Run(spark, sf).history)


@query(f"{P} select primary_exchange, conditional_type, trading_status_flag, count(*) as intervals, count(distinct permno) as entities from history group by 1, 2, 3")
def a6_exchange_status(spark, sf):
    return ag.exchange_status(Run(spark, sf).history)


@query(f"{P} select count(*) as rows, count(distinct (permno, delist_flag)) as distinct_keys from daily")
def a7_distinct_keys(spark, sf):
    return ag.distinct_keys(Run(spark, sf).daily, ["permno", "delist_flag"])


@query(f"""{P}, x as (select d.*, e.permno is not null as has_event, e.return_storage_date as stored, e.delisting_return from daily d left join terminal e on e.permno = d.permno where d.delist_flag = 'Y')
  select count(*) as rows, count(*) filter (where not has_event) as no_event, count(*) filter (where has_event and date is distinct from stored) as date_mismatches,
    count(*) filter (where has_event and ret_total is distinct from delisting_return) as value_mismatches, count(*) filter (where ret_total is null) as missing_returns,
    count(*) filter (where ret_total is not null and ret_missing_flag is distinct from 'NA') as numeric_with_warning from x""")
def a8_terminal_totals(spark, sf):
    r = Run(spark, sf)
    return ag.terminal_totals(r.daily, r.events)


@query(f"""{P}, x as (select h.* from daily d left join history h on h.permno = d.permno and d.date >= h.valid_from and d.date <= coalesce(h.valid_to, date '9999-12-31') where d.delist_flag = 'Y')
  select count(*) as rows, count(permno) as with_metadata, count(*) filter (where primary_exchange in ('N', 'A', 'Q') and trading_status_flag = 'A') as pass_entry_filter from x""")
def a9_terminal_entry_check(spark, sf):
    r = Run(spark, sf)
    return ag.terminal_entry_check(r.daily, r.history)


@query(f"{P} select permno, date, price_raw from daily order by permno, date")
def o1_sorted_output(spark, sf):
    return ag.sorted_output(Run(spark, sf).daily.select("permno", "date", "price_raw"), ["permno", "date"])


@query("select l_orderkey, l_linenumber, l_extendedprice from lineitem order by l_extendedprice desc, l_orderkey, l_linenumber limit 40")
def o2_top_k(spark, sf):
    return ag.top_k(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"), [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber"], 40)


@query(f"{P} select permno, date as day, price_raw, null as ticker from daily union all select permno, valid_from, null, ticker from history")
def o3_union_aligned(spark, sf):
    r = Run(spark, sf)
    return ag.union_aligned(r.daily.select("permno", F.col("date").alias("day"), "price_raw"), r.history.select("permno", F.col("valid_from").alias("day"), "ticker"))


@query(f"{P} select date from daily except select valid_from from history where permno % 29 = 0")
def o4_set_difference(spark, sf):
    r = Run(spark, sf)
    return ag.set_difference(r.daily.select("date"), r.history.where("permno % 29 = 0").select(F.col("valid_from").alias("date")))


@query(f"""{P}, a as (select permno, delist_flag from daily), b as (select permno, 'N' as delist_flag from daily), l as (select * from a except all select * from b), r as (select * from b except all select * from a)
  select (select count(*) from l) as only_left, (select count(*) from r) as only_right, (select count(*) from l) = 0 and (select count(*) from r) = 0 as equal""")
def o5_bag_equal(spark, sf):
    d = Run(spark, sf).daily
    return ag.bag_equal(d.select("permno", "delist_flag"), d.select("permno", F.lit("N").alias("delist_flag")))


@query(f"{P} select distinct date from daily")
def o6_distinct_dates(spark, sf):
    return ag.distinct_dates(Run(spark, sf).daily)


@query(f"""{P} select permno, date, ret_total between -0.01 and 0.01 as small_move, distribution_return_flag in ('C1', 'S1') as is_distribution, distribution_return_flag not in ('NO', 'NA') as not_plain,
  delist_flag is distinct from 'N' as differs_from_n, delist_flag = 'Y' or distribution_return_flag not in ('NO', 'NA') or distribution_return_flag is null as terms_incomplete from daily""")
def o7_predicates(spark, sf):
    return ag.predicate_flags(Run(spark, sf).daily)


@query(f"{P} select 'missing' as label, count(*) filter (where ret_total is null) as value from daily union all select 'terminal', count(*) filter (where delist_flag = 'Y') from daily")
def o8_named_counts(spark, sf):
    return ag.named_counts(Run(spark, sf).daily, {"missing": F.col("ret_total").isNull(), "terminal": F.col("delist_flag") == "Y"})
