"""The queries of several years as SQL for DuckDB."""

from __future__ import annotations

_LATE = "o_orderkey % 10 = 3"
_EARLY = "year(o_orderdate) < 1999"


def _merged(name: str, before: str | None, batch: str) -> str:
    """Change points after a batch of orders is merged into those of ``before``."""
    old = f"select o_custkey, since, o_orderstatus, o_orderpriority, 0 as new, 0 as seq from {before} union all" if before else ""
    return f"""
    {name} as (
      select o_custkey, since, o_orderstatus, o_orderpriority from (
        select * from (
          {old} select o_custkey, o_orderdate as since, o_orderstatus, o_orderpriority, 1 as new, o_orderkey as seq
          from orders where {batch})
        qualify row_number() over (partition by o_custkey, since order by new desc, seq desc) = 1)
      qualify row_number() over (partition by o_custkey order by since) = 1
        or (o_orderstatus, o_orderpriority) is distinct from lag((o_orderstatus, o_orderpriority)) over
          (partition by o_custkey order by since))"""


_AMOUNTS = """
  held as (
    select o_custkey, date_trunc('month', o_orderdate)::date as period, count(*) as n_facts,
           arg_max(o_totalprice::decimal(14,2), (o_orderdate, o_orderkey)) as balance, sum(o_totalprice::decimal(14,2)) as amount
    from orders group by all
  ), spans as (
    select *, coalesce(lead(period) over (partition by o_custkey order by period), period + interval 1 month)::date as following
    from held
  ), snapshot as (
    select o_custkey, unnest(generate_series(period::timestamp, following - interval 1 month, interval 1 month))::date as month,
           period, n_facts, balance, amount
    from spans
  ), monthly as (
    select month as period, c_nationkey, count(*) as n_keys,
           coalesce(sum(n_facts) filter (month = period), 0)::bigint as n_facts, sum(balance) as balance,
           coalesce(sum(amount) filter (month = period), 0) as amount
    from snapshot join customer on o_custkey = c_custkey group by month, c_nationkey
  )"""

_SPANS = """
  spans as (
    select o_orderkey, o_custkey, o_orderdate as opened, greatest(max(l_shipdate), o_orderdate + interval 1 day) as closed
    from orders left join lineitem on l_orderkey = o_orderkey group by o_orderkey, o_custkey, o_orderdate
  )"""

YEARS = {
    "scd2_history": f"""
        with {_merged("a", None, f"{_EARLY} and not ({_LATE})")},
             {_merged("b", "a", f"not ({_EARLY}) and not ({_LATE})")},
             {_merged("c", "b", _LATE)}
        select o_custkey, o_orderstatus, o_orderpriority, epoch_us(since) as valid_from,
               epoch_us(lead(since) over (partition by o_custkey order by since)) as valid_to
        from c""",
    "fact_as_of": f"""
        with {_merged("versions", None, "true")},
             lines as (
               select l_orderkey, l_linenumber, l_partkey, l_shipdate, o_custkey from lineitem join orders on l_orderkey = o_orderkey)
        select l_orderkey, l_linenumber, l_partkey, epoch_us(l_shipdate) as l_shipdate, l.o_custkey, o_orderstatus, o_orderpriority
        from lines l asof left join versions v on l.o_custkey = v.o_custkey and l.l_shipdate >= v.since""",
    "year_dimension": """
        with ends as (select min(year(o_orderdate)) as a, max(year(o_orderdate)) as b from orders),
             years as (select unnest(range(a, b + 1)) as year from ends)
        select md5(year::varchar) as year_sk, year, make_date(year, 1, 1)::varchar as first_day,
               make_date(year, 12, 31)::varchar as last_day,
               date_diff('day', make_date(year, 1, 1), make_date(year + 1, 1, 1)) as n_days,
               month(make_date(year, 2, 28) + 1) = 2 as is_leap
        from years""",
    "snapshot_by_month": f"""
        with {_AMOUNTS}
        select c_nationkey, period::varchar as period, n_keys, n_facts, balance::double as balance, amount::double as amount
        from monthly""",
    "snapshot_by_year": f"""
        with {_AMOUNTS}
        select c_nationkey, date_trunc('year', period)::date::varchar as period, arg_max(n_keys, period) as n_keys,
               sum(n_facts)::bigint as n_facts, arg_max(balance, period)::double as balance, sum(amount)::double as amount
        from monthly group by c_nationkey, date_trunc('year', period)""",
    "release_load": """
        with cells as (
          select (year(o_orderdate) - 1995) // 3 as part, o_orderkey, o_totalprice::decimal(14,2)::double as total,
                 case when o_orderstatus <> 'P' then o_orderstatus end as status
          from orders where not ((year(o_orderdate) - 1995) // 3 = 1 and o_orderkey % 4 = 1)
        )
        select 'r' || part as release, o_orderkey::varchar as order_key,
               case when o_orderkey % 50 = 7 then 'rejected' when part = 1 and o_orderkey % 4 = 2 then 'C' else status end as status,
               case when o_orderkey % 50 <> 7 then total end as total
        from cells""",
    "release_diff": """
        with made as (
          select case when o_orderkey % 97 <> 5 then o_orderkey end as o_orderkey,
                 case when o_orderkey % 6 <> 1 then o_orderstatus end as o_orderstatus, o_orderpriority,
                 o_totalprice::decimal(14,2) as o_totalprice, o_orderkey as number
          from orders
        ), old as (
          select * exclude (number) from made where number % 7 <> 3
          union all select * exclude (number) from made where number % 11 = 0
        ), new as (
          select * exclude (number) replace (
            case when number % 13 = 4 then 'X' else o_orderstatus end as o_orderstatus,
            case when number % 17 <> 9 then o_totalprice end as o_totalprice)
          from (select * from made where number % 5 <> 2 union all select * from made where number % 22 = 0)
        ), gone as (select * from old except all select * from new), come as (select * from new except all select * from old),
        lost as (
          select o_orderkey, count(*) as n, list(o_orderstatus order by o_orderstatus) as s, list(o_orderpriority order by
                 o_orderpriority) as p, list(o_totalprice order by o_totalprice) as t from gone group by o_orderkey
        ), gained as (
          select o_orderkey, count(*) as n, list(o_orderstatus order by o_orderstatus) as s, list(o_orderpriority order by
                 o_orderpriority) as p, list(o_totalprice order by o_totalprice) as t from come group by o_orderkey
        )
        select coalesce(l.o_orderkey, g.o_orderkey) as o_orderkey,
               case when l.n is null then 'added' when g.n is null then 'removed' else 'changed' end as change,
               coalesce(l.n, 0) as n_removed, coalesce(g.n, 0) as n_added,
               case when l.n is not null and g.n is not null then array_to_string(list_filter([
                 case when l.s is distinct from g.s then 'o_orderstatus' end, case when l.p is distinct from g.p then 'o_orderpriority' end,
                 case when l.t is distinct from g.t then 'o_totalprice' end], lambda c: c is not null), ',') end as changed_columns
        from lost l full join gained g on l.o_orderkey is not distinct from g.o_orderkey""",
    "distinct_by_window": """
        with months as (
          select distinct o_orderpriority, o_custkey, date_trunc('month', o_orderdate)::date as month from orders
        ), inside as (
          select o_orderpriority, o_custkey, unnest([month, (month + interval 1 month)::date, (month + interval 2 month)::date]) as period
          from months
        )
        select o_orderpriority, period::varchar as period, count(distinct o_custkey) as n_distinct, true as sketch_is_close
        from inside where period <= (select max(month) from months) group by all""",
    "open_order_overlaps": f"""
        with {_SPANS}
        select a.o_custkey, a.o_orderkey as o_orderkey_a, b.o_orderkey as o_orderkey_b,
               epoch_us(greatest(a.opened, b.opened)) as overlap_from, epoch_us(least(a.closed, b.closed)) as overlap_to
        from spans a join spans b on a.o_custkey = b.o_custkey and a.o_orderkey < b.o_orderkey
        where a.opened < b.closed and b.opened < a.closed""",
    "event_sessions": """
        with marked as (
          select *, case when ts - lag(ts) over (partition by user_id order by ts) <= interval 6 hours then 0 else 1 end as opens
          from events
        ), numbered as (select *, sum(opens) over (partition by user_id order by ts rows unbounded preceding) as session from marked)
        select user_id, epoch_us(min(ts)) as session_start, epoch_us(max(ts)) as session_end, count(*) as n_events,
               sum(value::decimal(18,2))::double as value
        from numbered group by user_id, session""",
}
