"""Sources, normalization, calendar and plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import calendar as ca
from ..operators import differences as di
from ..operators import normalize as no
from ..operators import sweep as sw
from ..plans import windows as pl
from ..schemas import DAILY, require_columns
from ..sources import extract as ex
from ..sources import tables as ta
from ..sources.shared import scratch
from .base import B, END, FACTORS, P, PANEL, Run, near, query, sql_near, table

# fmt: off
DAYS = ", ".join(DAILY.names)


@query("select l_orderkey, l_linenumber, l_quantity from lineitem")
def s1_read_table(spark, sf):
    return ta.read_table(spark, [f"{sf}/lineitem.parquet"]).select("l_orderkey", "l_linenumber", "l_quantity")


@query("select event_id, user_id, event_type, year(ts) as year, month(ts) as month from events")
def s2_read_panel(spark, sf):
    """Written in ``year=/month=`` folders and read back by them."""
    root = scratch(spark, "panel-months")
    ta.write_months(table(spark, sf, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("date").alias("date")), root)
    return ta.read_panel(spark, root).select("event_id", "user_id", "event_type", F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month"))


@query(f"{P} select {DAYS} from daily")
def s3_require_columns(spark, sf):
    return require_columns(Run(spark, sf).daily, DAILY).select(*DAILY.names)


@query("""select year, rows, due as rows_due, rows is not distinct from due as agrees from
  (select year(o_orderdate) as year, count(*) as rows, if(year(o_orderdate) % 2 = 0, count(*), count(*) - 1) as due from orders group by 1 union all select 1900, null, 5)""")
def s4_file_counts(spark, sf):
    """A file for each year against a manifest that is one row off for every second year and
    names a file that isn't there."""
    root = scratch(spark, "years")
    orders = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    orders.repartition("year").write.partitionBy("year").parquet(root)
    found = spark.read.parquet(root)
    files = found.groupBy(ta.file_name(2).alias("file"), F.col("year").cast("bigint").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    due = files.select("file", "year", (F.col("n") - F.when(F.col("year") % 2 == 0, 0).otherwise(1)).alias("rows"))
    due = due.unionByName(spark.createDataFrame([("absent.parquet", 1900, 5)], "file string, year long, rows long"))
    counts = ta.file_counts(found, due.select("file", "rows"), levels=2)
    return counts.join(due.select("file", "year"), "file").select("year", "rows", "rows_due", "agrees")


@query("select o_orderkey, cast(o_orderdate as date) as date, year(o_orderdate) as year, month(o_orderdate) as month from orders where o_orderdate >= date '1996-01-15' and o_orderdate < date '1996-07-11'")
def s5_extract_months(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"))
    return ex.extract_months(orders, "1996-01-15", "1996-07-10")


@query(f"{B} select permno, valid_from, valid_to, attribute from intervals where valid_from <= date '1996-12-31' and coalesce(valid_to, {END}) >= date '1996-01-01'")
def s6_extract_overlapping(spark, sf):
    return ex.extract_overlapping(Run(spark, sf).intervals(), "1996-01-01", "1996-12-31")


@query(f"{P} select permno, event_date, delisting_return from terminal where event_date between date '2024-01-05' and date '2024-01-20'")
def s7_extract_between(spark, sf):
    return ex.extract_between(Run(spark, sf).terminal, "event_date", "2024-01-05", "2024-01-20").select("permno", "event_date", "delisting_return")


@query("select min(cast(l_shipdate as date)) as min_date, max(cast(l_shipdate as date)) as max_date, count(*) as rows from lineitem")
def s8_source_coverage(spark, sf):
    return ex.source_coverage(table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("date")))


@query("""select count(*) as rows, count(*) filter (where o_custkey is null or o_orderdate is null) as null_keys, count(*) - count(distinct (o_custkey, o_orderdate)) as surplus_keys, cast(0 as bigint) as invalid_dates,
  count(*) filter (where o_orderdate < date '1993-01-01' or o_orderdate > date '1997-12-31') as out_of_range, false as accepted from orders""")
def s9_gate_extract(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    return ex.gate_extract(orders, ["o_custkey", "o_orderdate"], "o_orderdate", "1993-01-01", "1997-12-31")


@query("select year(o_orderdate) as year, month(o_orderdate) as month, count(*) as rows, min(cast(o_orderdate as date)) as min_date, max(cast(o_orderdate as date)) as max_date from orders group by 1, 2")
def s13_manifest(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"))
    months = ta.months_of(orders).withColumns({"year": F.col("year").cast("bigint"), "month": F.col("month").cast("bigint")})
    return ta.manifest(months, "orders", by=["year", "month"]).select("year", "month", "rows", "min_date", "max_date")


@query("""select l_returnflag, count(*) as n, bit_xor(h) as xor, cast(sum(h) as varchar) as sum from
  (select l_returnflag, cast((cast(l_orderkey as bigint) * 8 + l_linenumber) * 2654435761 + round(l_extendedprice * 100) as bigint) as h from lineitem) x group by 1""")
def s14_fingerprint(spark, sf):
    """By a row hash that SQL can say too; the default one is xxHash64 of all columns."""
    key = F.col("l_orderkey").cast("bigint") * 8 + F.col("l_linenumber")
    h = (key * 2654435761 + F.round(F.col("l_extendedprice") * 100)).cast("bigint")
    return ta.fingerprint(table(spark, sf, "lineitem"), ["l_returnflag"], h).withColumn("sum", F.col("sum").cast("string"))


@query()
def s14_fingerprint_all_columns(spark, sf):
    return ta.fingerprint(table(spark, sf, "lineitem"), ["l_returnflag"])


@query("""select distinct year(o_orderdate) as year, month(o_orderdate) as month from orders where o_orderkey in (select min(o_orderkey) from orders group by year(o_orderdate), month(o_orderdate)) and month(o_orderdate) % 2 = 0""")
def s15_pending_months(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"))
    # of the months built before, the even ones have since got a row changed
    before = orders.where("month(date) % 2 = 1").unionByName(orders.where("month(date) % 2 = 0").withColumn("o_orderkey", F.col("o_orderkey") + 1))
    built = ta.fingerprint(ta.months_of(before), ["year", "month"]).withColumn("policy", F.lit("1"))
    return ta.pending_months(orders, built, "1").select(F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month"))


@query("""with due as (select unnest(generate_series(date '1991-01-01', date '1999-12-31', interval 1 month)) as d), seen as (select distinct year(o_orderdate) as y, month(o_orderdate) as m from orders)
  select year(d) as year, month(d) as month from due where not exists (select 1 from seen where y = year(d) and m = month(d))""")
def s16_missing_months(spark, sf):
    found = ta.missing_months(table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("date")), "1991-01-01", "1999-12-31")
    return found.select(F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month"))


@query(f"{FACTORS} select permno, date, has_required_history, {sql_near('momentum')} as momentum from factors where date <= date '2024-01-15'")
def s17_factors_upto(spark, sf):
    from ..operators.factors import factors_upto

    return factors_upto(Run(spark, sf).factors, "2024-01-15").select("permno", "date", "has_required_history", near("momentum").alias("momentum"))


@query(f"{P} select permno, date, price_raw, cast(ret_total as varchar) is null as ret_missing, delist_flag from daily")
def n1_normalize_daily(spark, sf):
    d = Run(spark, sf).daily
    raw = d.select(*(F.col(c).cast("decimal(18,6)").alias(f"raw_{c}") if t == "double" else F.col(c).cast("string").alias(f"raw_{c}") for c, t in d.dtypes))
    exact = d.select("permno", "date", F.col("price_raw").alias("exact"))
    out = no.normalize_daily(raw, {c: f"raw_{c}" for c in DAILY.names}).join(exact, ["permno", "date"])
    same = F.abs(F.col("price_raw") - F.col("exact")) < 1e-6
    return out.select("permno", "date", F.when(same, F.col("exact")).alias("price_raw"), F.col("ret_total").isNull().alias("ret_missing"), "delist_flag")


@query(f"{P} select permno, valid_from, valid_to, ticker, cusip, primary_exchange, share_class from history")
def n2_normalize_history(spark, sf):
    h = Run(spark, sf).history
    return no.normalize_history(h.select(*(F.col(c).cast("string").alias(c) for c in h.columns))).select("permno", "valid_from", "valid_to", "ticker", "cusip", "primary_exchange", "share_class")


@query(f"{P} select permno, event_date, delisting_return, action_type, successor_permno, successor_permco from terminal")
def n3_normalize_events(spark, sf):
    t = Run(spark, sf).terminal
    return no.normalize_events(t.select(*(F.col(c).cast("string").alias(c) for c in t.columns))).select("permno", "event_date", "delisting_return", "action_type", "successor_permno", "successor_permco")


DIRTY = "case when o_orderkey % 11 = 0 then 'n/a' when o_orderkey % 13 = 0 then null else cast(cast(o_orderdate as date) as varchar) end"


@query(f"select count(*) as rows, count(*) filter (where k is null) as null_keys, count(*) filter (where d is null) as null_dates, count(*) filter (where d is not null and try_cast(d as date) is null) as invalid_dates from (select case when o_orderkey % 17 <> 0 then o_custkey end as k, {DIRTY} as d from orders) x")
def n4_key_stats(spark, sf):
    o = table(spark, sf, "orders")
    day = F.when(F.col("o_orderkey") % 11 == 0, "n/a").when(F.col("o_orderkey") % 13 == 0, None).otherwise(F.col("o_orderdate").cast("date").cast("string"))
    return no.key_stats(o.select(F.when(F.col("o_orderkey") % 17 != 0, F.col("o_custkey")).alias("k"), day.alias("d")), "k", "d")


@query("select o_custkey, o_orderdate, count(*) as copies from orders group by 1, 2 having count(*) > 1")
def n5_duplicate_keys(spark, sf):
    return no.duplicate_keys(table(spark, sf, "orders"), ["o_custkey", "o_orderdate"])


@query("select (select count(*) from orders) as rows_before, (select count(*) from orders where o_orderkey % 7 <> 0) as rows_after, (select count(*) from orders) = (select count(*) from orders where o_orderkey % 7 <> 0) as conserved")
def n6_count_change(spark, sf):
    o = table(spark, sf, "orders")
    return no.count_change(o, o.where("o_orderkey % 7 <> 0"))


@query("""select year(o_orderdate) as year, cast(case when o_orderkey % 19 = 0 then 1 else month(o_orderdate) end as bigint) as month, count(*) as rows, min(cast(o_orderdate as date)) as min_date, max(cast(o_orderdate as date)) as max_date,
  count(*) filter (where o_orderkey % 19 = 0 and month(o_orderdate) <> 1) as misplaced from orders group by 1, 2""")
def n7_check_partition(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"))
    placed = o.withColumns({"year": F.year("date").cast("bigint"), "month": F.when(F.col("o_orderkey") % 19 == 0, 1).otherwise(F.month("date")).cast("bigint")})
    return no.check_partition(placed)


SHIFTED = "select permno, valid_from, case when permno % 10 = 0 then cast(valid_from - interval 3 day as date) when permno % 10 = 1 then cast(valid_to + interval 40 day as date) else valid_to end as valid_to from intervals"


def _shifted(r: Run):
    to = F.when(F.col("permno") % 10 == 0, F.date_sub("valid_from", 3)).when(F.col("permno") % 10 == 1, F.date_add("valid_to", 40)).otherwise(F.col("valid_to"))
    return r.intervals().select("permno", "valid_from", to.alias("valid_to"))


@query(f"{B}, x as ({SHIFTED}) select * from x where permno is null or valid_from is null or valid_to < valid_from")
def n8_bad_intervals(spark, sf):
    return no.bad_intervals(_shifted(Run(spark, sf)))


@query(f"{B}, x as ({SHIFTED}), y as (select *, lag(coalesce(valid_to, {END})) over (partition by permno order by valid_from, valid_to) as previous_end from x) select * from y where previous_end >= valid_from")
def n9_overlaps(spark, sf):
    return no.overlaps(_shifted(Run(spark, sf)))


@query(f"{B}, x as ({SHIFTED}), y as (select *, max(coalesce(valid_to, {END})) over (partition by permno order by valid_from, valid_to rows between unbounded preceding and 1 preceding) as previous_end from x) select * from y where previous_end >= valid_from")
def n9_overlaps_all(spark, sf):
    return no.overlaps(_shifted(Run(spark, sf)), all_pairs=True)


@query(f"""{P}, a as (select permno, delist_flag from daily), b as (select permno, 'N' as delist_flag from daily)
  select permno, delist_flag, sum(s) as surplus, case when sum(s) > 0 then 'left' else 'right' end as side from (select *, 1 as s from a union all select *, -1 from b) x group by 1, 2 having sum(s) <> 0""")
def n10_bag_diff(spark, sf):
    d = Run(spark, sf).daily
    return no.bag_diff(d.select("permno", "delist_flag"), d.select("permno", F.lit("N").alias("delist_flag")))


CHANGED = "select l_orderkey, l_linenumber, year(l_shipdate) as year, if(l_orderkey % 997 = 5, l_quantity + 1, l_quantity) as quantity from lineitem where l_orderkey % 1009 <> 7"


@query(f"""with a as (select l_orderkey, l_linenumber, year(l_shipdate) as year, l_quantity as quantity from lineitem), b as ({CHANGED})
  select *, 1 as surplus, 'left' as side from (select * from a except all select * from b) x union all select *, -1, 'right' from (select * from b except all select * from a) y""")
def n10_table_diff(spark, sf):
    """Changed and lost rows by fingerprints of year and bucket; only differing buckets are read.
    Equal rows stand as often as one side has more of them."""
    year = F.year("l_shipdate").cast("bigint").alias("year")
    a = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", year, F.col("l_quantity").alias("quantity"))
    more = F.when(F.col("l_orderkey") % 997 == 5, F.col("quantity") + 1).otherwise(F.col("quantity"))
    return no.each_copy(di.table_diff(a, a.where("l_orderkey % 1009 <> 7").withColumn("quantity", more), ["year"], ["l_orderkey"]))


@query(f"{P} select permno, event_date, return_storage_date as storage, cast(null as varchar) as flag, true as has_storage, false as has_flag from terminal")
def n11_optional_column(spark, sf):
    t = Run(spark, sf).terminal.withColumnRenamed("return_storage_date", "DelDlyDt")
    (storage, has), (flag, has_flag) = no.optional_column(t, ("return_storage_date", "deldlydt"), "date"), no.optional_column(t, ("delretmisstype",), "string")
    return t.select("permno", "event_date", storage.alias("storage"), flag.alias("flag"), F.lit(has).alias("has_storage"), F.lit(has_flag).alias("has_flag"))


FOUR = "count(*) filter (where {0} is null) as missing, count(*) filter (where {0} = 0) as zero, count(*) filter (where {0} = -1) as minus_one, count(*) filter (where not isfinite({0}) or {0} < -1) as invalid"


@query(f"{P} select count(*) as rows, count(distinct permno) as entities, min(event_date) as min_date, max(event_date) as max_date, count(*) - count(distinct (permno, event_date)) as surplus_keys, {FOUR.format('delisting_return')} from terminal")
def n12_profile_events(spark, sf):
    return no.profile_events(Run(spark, sf).terminal)


@query(f"""{P}, x as (select *, lag(coalesce(valid_to, {END})) over (partition by permno order by valid_from, valid_to) as pe from history)
  select count(*) as rows, count(distinct permno) as entities, min(valid_from) as min_from, max(valid_to) as max_to, count(*) filter (where valid_from is null or valid_to < valid_from) as invalid_intervals, count(*) filter (where pe >= valid_from) as overlaps from x""")
def n13_profile_history(spark, sf):
    return no.profile_history(Run(spark, sf).history)


@query(f"""{P} select year(date) as year, month(date) as month, count(*) as rows, count(distinct permno) as entities, count(*) - count(distinct (permno, date)) as surplus_keys, count(*) filter (where permno is null or date is null) as null_keys,
  {FOUR.format('ret_total')}, count(*) filter (where ret_total is not null and ret_missing_flag is distinct from 'NA') as numeric_with_warning from daily group by 1, 2""")
def n14_profile_daily(spark, sf):
    return no.profile_daily(Run(spark, sf).daily)


@query(f"{P} select delist_flag, ret_missing_flag, distribution_return_flag, count(*) as rows from daily group by 1, 2, 3")
def n15_flag_counts(spark, sf):
    return no.flag_counts(Run(spark, sf).daily, "delist_flag", "ret_missing_flag", "distribution_return_flag")


@query(f"{P} select permno, date, ret_total from daily where ret_total > 0")
def n16_positive_returns(spark, sf):
    return no.positive_returns(Run(spark, sf).daily)


@query(f"""{P}, x as (select *, lag(price_raw) over (partition by permno order by date) as previous_price from daily)
  select permno, date, ratio * price_raw / previous_price - 1 as implied_return, abs(ratio * price_raw / previous_price - 1 - ret_total) <= 0.5 as agrees
  from (select *, case when distribution_return_flag = 'S1' then 2.0::double else 1.0::double end as ratio from x) y where previous_price > 0""")
def n17_implied_return_check(spark, sf):
    d = Run(spark, sf).daily
    terms = d.select("permno", "date", F.when(F.col("distribution_return_flag") == "S1", 2.0).otherwise(1.0).alias("ratio"), F.lit(0.0).alias("cash"))
    return no.implied_return_check(d, terms, 0.5).select("permno", "date", "implied_return", "agrees")


def _span(spark, sf):
    return table(spark, sf, "orders").agg(F.min(F.col("o_orderdate").cast("date")).cast("string").alias("a"), F.max(F.col("o_orderdate").cast("date")).cast("string").alias("b")).first()


def _closed(spark, sf):
    """Days without an order on a weekday with a day-of-month divisible by 10 stand for holidays."""
    return table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("date")).where("day(date) % 10 = 0").distinct()


def _calendar(spark, sf, **how):
    a, b = _span(spark, sf)
    early = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("date")).where("day(date) = 24").distinct()
    return ca.session_calendar(spark, a, b, _closed(spark, sf), early, **how)


SESSIONS = """with span as (select min(cast(o_orderdate as date)) as a, max(cast(o_orderdate as date)) as b from orders),
  shut as (select distinct cast(o_orderdate as date) as d from orders where day(o_orderdate) % 10 = 0), early as (select distinct cast(o_orderdate as date) as d from orders where day(o_orderdate) = 24),
  days as (select cast(unnest(generate_series(a, b + interval 34 day, interval 1 day)) as date) as date from span),
  padded as (select date, row_number() over (order by date) - 1 as session_index from days where isodow(date) < 6 and date not in (select d from shut)),
  sessions as (select p.* from padded p, span s where p.date <= s.b)"""
#: New York is five hours behind UTC, four from the second (from 2007; before, the first Sunday of April) to the autumn change.
DST = """case when year(date) >= 2007 then date >= cast(date_trunc('month', make_date(year(date), 3, 1)) as date) + cast((7 - isodow(make_date(year(date), 3, 1))) % 7 + 7 as integer)
    and date < make_date(year(date), 11, 1) + cast((7 - isodow(make_date(year(date), 11, 1))) % 7 as integer)
  else date >= make_date(year(date), 4, 1) + cast((7 - isodow(make_date(year(date), 4, 1))) % 7 as integer)
    and date < make_date(year(date), 10, 31) - cast(isodow(make_date(year(date), 10, 31)) % 7 as integer) end"""


@query(f"{SESSIONS} select date, session_index from sessions")
def c1_session_calendar(spark, sf):
    return _calendar(spark, sf).select("date", "session_index")


HOURS = f"{SESSIONS}, hours as (select date, session_index, case when {DST} then 13 else 14 end as open_hour, case when date in (select d from early) then 13 else 16 end + case when {DST} then 4 else 5 end as close_hour from padded)"


@query(f"{HOURS} select date, cast(open_hour as bigint) as open_hour, cast(close_hour as bigint) as close_hour from hours, span where date <= b")
def c2_open_close_utc(spark, sf):
    return _calendar(spark, sf).select("date", F.hour("open_at").cast("bigint").alias("open_hour"), F.hour("close_at").cast("bigint").alias("close_hour"))


@query(f"{HOURS} select date, cast(open_hour as bigint) as decision_hour, cast(29 as bigint) as decision_minute from hours, span where date <= b")
def c3_preopen_decision(spark, sf):
    return _calendar(spark, sf, decision="preopen").select("date", F.hour("decision_time").cast("bigint").alias("decision_hour"), F.minute("decision_time").cast("bigint").alias("decision_minute"))


@query(f"{HOURS}, x as (select date, lead(date, 1) over (order by date) as available_date, lead(close_hour, 1) over (order by date) as available_hour from hours) select date, available_date, cast(available_hour as bigint) as available_hour from x, span where date <= b")
def c4_available_at(spark, sf):
    return _calendar(spark, sf).select("date", F.to_date("available_at").alias("available_date"), F.hour("available_at").cast("bigint").alias("available_hour"))


@query(f"{SESSIONS} select l_orderkey, l_linenumber, cast(l_shipdate as date) as day, t.date as shifted from lineitem left join sessions s on s.date = cast(l_shipdate as date) left join sessions t on t.session_index = s.session_index + 3")
def c5_shift_sessions(spark, sf):
    d = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("day"))
    return ca.shift_sessions(d, _calendar(spark, sf), "day", 3)


@query(f"{SESSIONS} select l_orderkey, l_linenumber, cast(l_shipdate as date) as day, t.date as observable from lineitem left join sessions s on s.date = cast(l_shipdate as date) left join sessions t on t.session_index = s.session_index - 2")
def c6_latest_observable(spark, sf):
    d = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("day"))
    return ca.latest_observable(d, _calendar(spark, sf), "day", 1, "preopen")


@query(f"{SESSIONS}, d as (select distinct cast(l_shipdate as date) as day from lineitem), n as (select day, (select min(date) from sessions where date > day) as next_session from d) select l_orderkey, l_linenumber, n.day, next_session from lineitem join n on n.day = cast(l_shipdate as date)")
def c7_next_session(spark, sf):
    d = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("day"))
    return ca.next_session(d, _calendar(spark, sf), "day")


@query(f"{SESSIONS}, d as (select distinct cast(l_shipdate as date) as date from lineitem) select date, 'MISSING_SESSION' as problem from sessions where date not in (select date from d) union all select date, 'UNEXPECTED_DATE' from d where date not in (select date from sessions)")
def c8_calendar_gaps(spark, sf):
    return ca.calendar_gaps(table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("date")), _calendar(spark, sf))


@query(f"{P}, x as (select permno, date, session_index, lag(session_index) over (partition by permno order by session_index) as previous_session from dailyx) select permno, date, previous_session from x where session_index - previous_session <> 1")
def c9_session_gaps(spark, sf):
    r = Run(spark, sf)
    return ca.session_gaps(ca.with_session(r.daily, r.cal)).select("permno", "date", "previous_session")


CONFIGS = f"""configs as (select cast(user_id as bigint) as config_id, cast(date '2024-01-16' + cast(user_id % 8 as integer) as date) as eval_start, cast(date '2024-01-26' + cast(user_id % 3 as integer) as date) as eval_end,
  cast(2 + user_id % 9 as bigint) as lookback, cast(user_id % 5 as bigint) as training, cast(1 + user_id % 3 as bigint) as horizon, cast(1 as bigint) as lag, user_id % 2 = 0 as preopen from (select distinct user_id from events) u)"""
PLAN_TAIL = """o as (select c.*, lag + case when preopen then 1 else 0 end as off, s.session_index as ie, e.session_index as ee, s.decision_time as cutoff from configs c join calendar s on s.date = c.eval_start join calendar e on e.date = c.eval_end),
  t as (select *, case when training > 0 then ie - horizon - off end as ilast, case when training > 0 then ie - horizon - off - training + 1 end as ifirst from o),
  p as (select *, coalesce(ifirst, ie) - off - lookback + 1 as ip from t),
  plans as (select p.*, a.date as process_start, b.date as training_start, c.date as training_end, case when a.date is null or a.date < date '2024-01-01' then 'NOT_ENOUGH_HISTORY' end as problem
    from p left join calendar a on a.session_index = p.ip left join calendar b on b.session_index = p.ifirst left join calendar c on c.session_index = p.ilast)"""
PLANNED = f"{P}, {CONFIGS}, {PLAN_TAIL}"


def _configs(users):
    u = F.col("user_id")
    return users.distinct().select(
        u.cast("bigint").alias("config_id"), F.date_add(F.lit("2024-01-16").cast("date"), (u % 8).cast("int")).alias("eval_start"), F.date_add(F.lit("2024-01-26").cast("date"), (u % 3).cast("int")).alias("eval_end"),
        (2 + u % 9).alias("lookback"), (u % 5).alias("training"), (1 + u % 3).alias("horizon"), F.lit(1).cast("bigint").alias("lag"), (u % 2 == 0).alias("preopen"))


def _plans(r: Run):
    return pl.plan_windows(r.cal, _configs(table(r.spark, r.sf_dir, "events").select("user_id")), "2024-01-01", "2024-01-30")


@query(f"{PLANNED} select config_id, process_start, training_start, training_end, eval_start, eval_end, ee - ip + 1 as loaded_sessions from plans")
def c10_plan_windows(spark, sf):
    return _plans(Run(spark, sf)).select("config_id", "process_start", "training_start", "training_end", "eval_start", "eval_end", "loaded_sessions")


@query(f"{PLANNED} select config_id, problem from plans")
def c11_plan_checks(spark, sf):
    return _plans(Run(spark, sf)).select("config_id", "problem")


# Many configurations at once; as many in any table, so that the result grows with the panel.
SWEEP = 24
SWEPT = f"""{PANEL}, {CONFIGS.replace("select distinct user_id from events", f"select distinct user_id % {SWEEP} as user_id from events")}, {PLAN_TAIL},
  mine as (select p.config_id, p.lookback, p.horizon, p.off, p.eval_end, x.* from plans p join fullpanel x on x.session_index between p.ip and p.ee where p.problem is null)"""
SWEPT_FACTORS = f"""{SWEPT},
  ends as (select config_id, permno, min(date) as end_date from mine where delist_flag = 'Y' or ret_total_backtest = -1 group by all),
  back as (select a.config_id, a.permno, a.date, count(b.ret_total_for_signal) = a.lookback as whole, product(1 + b.ret_total_for_signal) as growth
    from mine a join mine b on b.config_id = a.config_id and b.permno = a.permno and b.session_index > a.session_index - a.lookback and b.session_index <= a.session_index
    group by a.config_id, a.permno, a.date, a.lookback),
  swept as (select m.*, b.growth - 1 as value, b.whole and not ifnull(m.date >= e.end_date, false) as has_required_history
    from mine m join back b using (config_id, permno, date) left join ends e using (config_id, permno)),
  decided as (select w.*, c.date as decision_date from swept w join calendar c on c.session_index = w.session_index + w.off
    where w.delist_flag = 'N' and c.decision_time >= w.available_at and c.date <= w.eval_end)"""
SWEPT_LABELS = f"""{SWEPT},
  ahead as (select a.config_id, a.permno, a.date, a.session_index, a.horizon, a.eval_end, count(b.date) as observed_sessions, count(b.ret_total_for_signal) as valid_sessions,
      count(*) filter (b.delist_flag = 'Y') as terminal_sessions, count(b.date) - count(b.ret_total) as missing_return_sessions, product(1 + b.ret_total_for_signal) as growth
    from mine a left join mine b on b.config_id = a.config_id and b.permno = a.permno and b.session_index > a.session_index and b.session_index <= a.session_index + a.horizon
    group by a.config_id, a.permno, a.date, a.session_index, a.horizon, a.eval_end),
  named as (select a.*, c.date as label_end_date, case when terminal_sessions > 0 then 'TERMINAL_OUTCOME' when c.date > eval_end then 'PERIOD_END_TRUNCATED'
      when observed_sessions < horizon then 'SESSION_GAP' when missing_return_sessions > 0 then 'MISSING_RETURN' when valid_sessions < horizon then 'INCOMPLETE_RETURN'
      else 'OBSERVED_APPROXIMATE_AVAILABILITY' end as label_status
    from ahead a join calendar c on c.session_index = a.session_index + a.horizon)"""


def _swept(spark, sf):
    """The running totals of the panel, the configurations by session, the calendar."""
    r = Run(spark, sf)
    configs = _configs(table(spark, sf, "events").select((F.col("user_id") % SWEEP).alias("user_id")))
    wanted = sw.configured(pl.plan_windows(r.cal, configs, "2024-01-01", "2024-01-30"), configs, r.cal)
    return sw.running(r.panel), wanted, r.cal


@query(f"{SWEPT_FACTORS} select config_id, permno, decision_date, has_required_history, {sql_near('case when has_required_history then value end')} as momentum, baseline_eligible_observed and has_required_history as eligible_for_research from decided")
def c10_sweep_features(spark, sf):
    return sw.sweep_features(*_swept(spark, sf)).select("config_id", "permno", "decision_date", "has_required_history", near("momentum").alias("momentum"), "eligible_for_research")


@query(f"""{SWEPT_LABELS} select config_id, permno, date as decision_date, label_end_date, label_status, observed_sessions, valid_sessions, terminal_sessions,
  {sql_near("case when label_status = 'OBSERVED_APPROXIMATE_AVAILABILITY' then growth - 1 end")} as forward_vendor_return from named""")
def c10_sweep_labels(spark, sf):
    return sw.sweep_labels(*_swept(spark, sf)).select(
        "config_id", "permno", "decision_date", "label_end_date", "label_status", "observed_sessions", "valid_sessions", "terminal_sessions", near("forward_vendor_return").alias("forward_vendor_return"))


@query(f"""{PLANNED} select config_id, c.date, 'LOADED' as role from plans join calendar c on c.date between process_start and eval_end where problem is null
  union all select config_id, c.date, 'TRAINING' from plans join calendar c on c.date between training_start and training_end where problem is null
  union all select config_id, c.date, 'EVALUATION' from plans join calendar c on c.date between eval_start and eval_end where problem is null""")
def c10_planned_sessions(spark, sf):
    r = Run(spark, sf)
    return pl.planned_sessions(_plans(r), r.cal)
