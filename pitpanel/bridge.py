"""Panels made from the given tables, by SQL text that Spark and any SQL oracle read alike.

``events`` becomes a daily panel with history and terminal events; ``orders`` and
``lineitem`` become facts and validity intervals at scale. Every session of the panel is a
date that occurs; closes and decisions fall on fixed hours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PANEL_SQL = """with last_ev as (
  select user_id as permno, cast(ts as date) as date, max(event_id) as eid,
         max_by(value, event_id) as v, max_by(event_type, event_id) as et
  from events group by user_id, cast(ts as date)),
cal as (select date, cast(row_number() over (order by date) - 1 as bigint) as session_index
        from (select distinct date from last_ev) x),
calendar as (select date, session_index,
  cast(date as timestamp) + interval 14 hour as open_at, cast(date as timestamp) + interval 21 hour as close_at,
  cast(date as timestamp) + interval 22 hour as decision_time,
  cast(date as timestamp) + interval 1 day + interval 21 hour + interval 30 minute as available_at from cal),
kept as (select l.*, c.session_index from last_ev l join cal c on c.date = l.date
         where l.permno % 7 <> 0 or c.session_index <= 11 + l.permno % 10),
tagged as (select *, max(session_index) over (partition by permno) as last_idx from kept),
dailyx as (select permno, date, session_index, v as price_raw, v * 1000 as market_cap_kusd,
  case when et = 'error' and eid % 3 = 0 then null when v > 250 then cast(-1.0 as double)
       else (least(v, cast(100.0 as double)) - 50) / 1000 end as ret_total,
  cast(10000 as double) as volume_raw_shares,
  case when permno % 7 = 0 and session_index = last_idx then 'Y' when eid % 97 = 0 then null else 'N' end as delist_flag,
  'A' as price_flag, 'A' as market_cap_flag,
  case when eid % 41 = 0 then 'MV' else 'NA' end as ret_missing_flag,
  case when eid % 53 = 0 then 'ZZ' when et = 'purchase' and eid % 5 = 0 then 'C1'
       when et = 'view' and eid % 11 = 0 then 'S1' else 'NO' end as distribution_return_flag
  from tagged),
daily as (select permno, date, price_raw, market_cap_kusd, ret_total, ret_total as ret_ex_div, volume_raw_shares, delist_flag,
  price_flag, market_cap_flag, ret_missing_flag, distribution_return_flag from dailyx),
terminal as (select d.permno, c.date as event_date,
  case when d.permno % 21 = 0 then coalesce(d.ret_total, 0) - 0.25 else d.ret_total end as delisting_return,
  case d.permno % 5 when 0 then 'MER' when 1 then 'GEX' when 2 then 'GLI' when 3 then 'GDR' else 'LOS' end as action_type,
  'S' as status_type, 'R' as reason_type, 'P' as payment_type, d.permno + 1 as successor_permno, d.permno + 2 as successor_permco,
  d.date as return_storage_date
  from dailyx d join cal c on c.session_index = d.session_index - 1
  where d.delist_flag = 'Y' and d.permno % 35 <> 0),
history as (select permno, date as valid_from,
  cast(lead(date) over (partition by permno order by date) - interval 1 day as date) as valid_to,
  concat('T', cast(eid % 4 as string)) as ticker, concat('C', cast(permno as string)) as cusip,
  case eid % 4 when 0 then 'N' when 1 then 'A' when 2 then 'Q' else 'X' end as primary_exchange,
  'NS' as share_type, 'EQTY' as security_type, case when eid % 13 = 0 then 'ADR' else 'COM' end as security_subtype,
  'Y' as us_incorporated_flag, case when eid % 2 = 0 then 'CORP' else 'ACOR' end as issuer_type,
  case when eid % 9 = 0 then 'H' else 'A' end as trading_status_flag, 'RW' as conditional_type, 'A' as share_class
  from last_ev where et = 'signup')"""

INTERVAL_SQL = """with ranked as (select o_custkey, o_orderdate, o_orderpriority,
    row_number() over (partition by o_custkey, o_orderdate order by o_orderkey desc) as rn from orders),
intervals as (select o_custkey as permno, cast(o_orderdate as date) as valid_from,
    cast(lead(cast(o_orderdate as date)) over (partition by o_custkey order by o_orderdate) - interval 1 day as date) as valid_to,
    o_orderpriority as attribute from ranked where rn = 1),
facts as (select o.o_custkey as permno, cast(l.l_shipdate as date) as date, l.l_orderkey as order_id, l.l_linenumber as line_id,
    l.l_quantity as quantity from lineitem l join orders o on o.o_orderkey = l.l_orderkey)"""


#: Few keys with many overlapping intervals, some of them open, and rows on the same keys.
BUSY_SQL = """with spells as (select c.c_nationkey as permno, cast(o.o_orderdate as date) as valid_from,
    case when o.o_orderkey % 50 = 0 then null else cast(o.o_orderdate as date) + cast(o.o_orderkey % 40 as int) end as valid_to,
    o.o_orderkey as spell from orders o join customer c on c.c_custkey = o.o_custkey),
visits as (select s.s_nationkey as permno, cast(l.l_shipdate as date) as date, l.l_quantity as quantity
    from lineitem l join supplier s on s.s_suppkey = l.l_suppkey)"""


def _select(spark: SparkSession, sf_dir: str, text: str, tables: tuple[str, ...], name: str) -> DataFrame:
    for t in tables:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(f"bridge_{t}")
        for before in ("from", "join"):
            text = text.replace(f"{before} {t}", f"{before} bridge_{t}")
    return spark.sql(f"{text} select * from {name}")


def panel_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``daily``, ``terminal``, ``history`` or ``calendar`` of the panel."""
    return _select(spark, sf_dir, PANEL_SQL, ("events",), name)


def busy_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``spells`` or ``visits``."""
    return _select(spark, sf_dir, BUSY_SQL, ("orders", "customer", "lineitem", "supplier"), name)


def interval_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``intervals`` or ``facts``."""
    return _select(spark, sf_dir, INTERVAL_SQL, ("orders", "lineitem"), name)
