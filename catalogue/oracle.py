"""The same results in SQL over the given tables, for a second engine to check."""

from __future__ import annotations

from catalogue.changes import ORACLE as CHANGES
from tierflow.functions.position import BIN_COUNT, bin_label

_TELEMETRY = """
telemetry as (
  select event_id, user_id::varchar as AccountId, (user_id % 25)::varchar as SiteId,
    case when event_id % 10 = 0 then '[]'
         when event_id % 10 <> 1 then '[' || ((user_id * 7) % 30)::varchar || '] ' end
      as HouseIdSet,
    ts as LocalDateTime,
    case when event_type <> 'error' then value end as reading,
    case when event_type <> 'click' then value end as latest,
    value as total, event_type
  from events)"""

_HOUSES = r"""
houses as (
  select s_suppkey::bigint as HouseRowId, s_nationkey::bigint as HouseAccountRowId,
    s_name as HouseName,
    try_cast(regexp_extract(s_name, '(\d+)$', 1) as bigint) as HouseNameOrdinalKey,
    (row_number() over (partition by s_nationkey order by
      try_cast(regexp_extract(s_name, '(\d+)$', 1) as bigint) nulls last,
      s_suppkey))::int as HouseOrdinal,
    null::varchar as HouseAlias, null::varchar as HouseTown
  from supplier)"""

_SITES = r"""
sites as (
  select n_regionkey::bigint as SiteIdKey, n_nationkey::bigint as SiteRowId,
    n_name as SiteName,
    try_cast(regexp_extract(n_name, '(\d+)$', 1) as bigint) as SiteNameOrdinalKey,
    (row_number() over (partition by n_regionkey order by
      try_cast(regexp_extract(n_name, '(\d+)$', 1) as bigint) nulls last,
      n_nationkey nulls last))::int as SiteOrdinal,
    null::varchar as SiteAlias, null::varchar as SiteLocation
  from nation)"""

_DASHBOARD = (
    _TELEMETRY
    + ","
    + _HOUSES
    + ","
    + _SITES
    + r""",
cleaned as (
  select t.* exclude (HouseIdSet),
    regexp_replace(HouseIdSet, '^[\[\]\s]+|[\[\]\s]+$', '', 'g') as bare
  from telemetry t),
identified as (
  select *, case when bare = '' then SiteId else bare end as HouseIdSet from cleaned),
dashboard as (
  select i.*, AccountId as HouseId, c_name as Customer, HouseName, HouseAlias,
    SiteName, SiteAlias, HouseOrdinal
  from identified i
  left join sites on try_cast(trim(HouseIdSet) as bigint) = SiteRowId
  left join houses on try_cast(SiteId as bigint) = HouseAccountRowId
    and SiteOrdinal = HouseOrdinal
  left join customer on try_cast(AccountId as bigint) = c_custkey)"""
)


def _stats(day: str, extra: str = "") -> str:
    return f"""with {_DASHBOARD}
select {day} as "Date", AccountId, SiteId, Customer, HouseIdSet, HouseId, HouseName,
  HouseAlias, SiteName, SiteAlias, count(*) as row_count,
  round(avg(reading), 8) as reading_mean,
  round(max(reading) - min(reading), 4) as span_mean,
  arg_max(latest, (LocalDateTime, event_id)) filter (where latest is not null)
    as latest_mean,
  round(sum(total), 4) as total_mean,
  count(*) - count(reading) as reading_null_count,
  count(*) - count(reading) as span_null_count,
  count(*) - count(latest) as latest_null_count,
  count(*) - count(total) as total_null_count,
  max(LocalDateTime) as last_record_local_ts,
  round((count(*) - count(reading)) / count(*), 6) as reading_null_fraction,
  round((count(*) - count(reading)) / count(*), 6) as span_null_fraction,
  round((count(*) - count(latest)) / count(*), 6) as latest_null_fraction,
  round((count(*) - count(total)) / count(*), 6) as total_null_fraction,
  round(case when LocalDateTime::date = date '2024-01-15' then 6.0 else 24.0 end::double,
    8) as elapsed_utc_hours,
  round(case when LocalDateTime::date = date '2024-01-15' then 0.25 else 1.0 end::double,
    6) as day_progress_fraction{extra}
from dashboard
group by LocalDateTime::date, AccountId, SiteId, Customer, HouseIdSet, HouseId,
  HouseName, HouseAlias, SiteName, SiteAlias"""


def _metric(how: str, expression: str) -> str:
    return f"""with {_TELEMETRY}
select LocalDateTime::date as "Date", AccountId, {expression} as reading_{how}
from telemetry group by all"""


_CELLS = """
cells as (
  select date_trunc('month', l_shipdate)::date as "Date",
    (l_suppkey % 25)::varchar as AccountId, (l_suppkey % 5)::varchar as SiteId,
    '[' || (l_suppkey % 3)::varchar || ']' as HouseIdSet,
    l_returnflag as beltids, l_linenumber as linenmbr,
    floor(least(greatest(l_quantity * 2.2::double - 5, 0.0::double), 99.999::double))::int
      as position_bin,
    coalesce(case when l_linestatus = 'F' then l_extendedprice end, 0.0) as cell
  from lineitem)"""

_MATRIX_KEYS = '"Date", AccountId, SiteId, HouseIdSet, beltids, linenmbr'

_WIDE_COLUMNS = ",\n  ".join(
    f"round(sum(cell) filter (where position_bin = {i}), 2) as {bin_label(i)}"
    for i in range(BIN_COUNT)
)

_HELD = """
held as (
  select (user_id % 3 + 1)::int as table_id, strftime(ts, '%Y-%m-%d') as day,
    count(*) as cnt
  from events group by all),
runs as (
  select table_id, (floor((extract(day from day::date) - 1) / 7))::int as week,
    sum(cnt)::bigint as row_count, count(*)::int as partition_count,
    min(day) as from_date, max(day) as to_date
  from held group by all)"""

# The third week failed; table 1's fifth is undated, and that table then counts
# every day on disk as done.
_DONE = (
    _HELD
    + """,
done as (
  select distinct table_id, day from held h
  where (floor((extract(day from day::date) - 1) / 7))::int <> 2
    or exists (select 1 from runs r
      where r.table_id = h.table_id and r.table_id = 1 and r.week = 4))"""
)

_WANTED = """
windows as (
  select (user_id % 3 + 1)::int as table_id, min(ts)::date as low,
    max(ts)::date + 3 as high
  from events group by 1),
wanted as (
  select table_id,
    strftime(unnest(generate_series(low::timestamp, high::timestamp, interval 1 day)),
      '%Y-%m-%d') as day
  from windows where table_id <> 3)"""



def _odd_id(key: str) -> str:
    return f"""case when {key} % 11 = 3 or {key} % 13 = 5 then null
    when {key} % 7 = 2 then {key} - 1 else {key} end::bigint"""


def _odd_name(key: str, name: str) -> str:
    return f"""case when {key} % 5 = 0 then 'Annex'
    when {key} % 5 = 1 then 'Unit ' || ({key} % 4)::varchar else {name} end"""


_SUFFIX = r"try_cast(regexp_extract({}, '(\d+)$', 1) as bigint)"

_FANOUT = _DASHBOARD.replace("n_nationkey", "(n_nationkey % 13)")

HARD = {
    "range_filter_times": """
select event_id from events
where ts::date between date '2024-01-05' and date '2024-01-09'""",
    "account_lookup_hard": f"""
select {_odd_id("c_custkey")} as AccountRowId,
  min(case when c_custkey % 9 <> 0 then c_name end) as Customer
from customer group by 1 having AccountRowId is not null""",
    "house_lookup_hard": f"""
with named as (
  select {_odd_id("s_suppkey")} as HouseRowId,
    case when s_suppkey % 17 <> 0 then s_nationkey end::bigint as HouseAccountRowId,
    {_odd_name("s_suppkey", "s_name")} as HouseName,
    {_SUFFIX.format(_odd_name("s_suppkey", "s_name"))} as HouseNameOrdinalKey,
    'a' || s_suppkey::varchar as HouseAlias,
    case when s_suppkey % 3 <> 0 then 't' end as HouseTown
  from supplier),
numbered as (
  select *, (row_number() over (partition by HouseAccountRowId order by
    HouseNameOrdinalKey nulls last, HouseRowId, HouseName, HouseAlias,
    HouseTown nulls last))::int as HouseOrdinal
  from named where HouseRowId is not null and HouseAccountRowId is not null)
select * from numbered
qualify row_number() over (partition by HouseRowId
  order by HouseOrdinal, HouseAccountRowId, HouseName) = 1""",
    "site_lookup_hard": f"""
with named as (
  select n_regionkey::bigint as SiteIdKey, {_odd_id("n_nationkey")} as SiteRowId,
    {_odd_name("n_nationkey", "n_name")} as SiteName,
    {_SUFFIX.format(_odd_name("n_nationkey", "n_name"))} as SiteNameOrdinalKey,
    'a' || n_nationkey::varchar as SiteAlias, n_name as SiteLocation
  from nation),
numbered as (
  select *, (row_number() over (partition by SiteIdKey order by
    SiteNameOrdinalKey nulls last, SiteRowId nulls last, SiteName,
    SiteAlias))::int as SiteOrdinal
  from named)
select * from numbered
qualify row_number() over (partition by SiteIdKey, SiteRowId order by SiteOrdinal) = 1""",
    "dashboard_fanout": f"""with {_FANOUT}
select event_id, HouseIdSet, SiteName, HouseName, Customer from dashboard""",
    "metric_last_ties": """
select ts::date as "Date", user_id,
  max(hour(ts)::bigint * 100000000 + case when event_id % 3 <> 0 then event_id else 0 end)
    as reading_last
from events group by all""",
    "partition_files": """
select distinct strftime(ts, '%Y-%m-%d') as day, true as files, true as bytes
from events""",
    "upsert_hard": """
with all_rows as (
  select case when o_orderkey % 10 <> 0 then o_orderkey end as k, o_custkey,
    o_totalprice, o_orderkey as o,
    strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') as PartitionDate
  from orders),
target as (select * from all_rows where o % 3 <> 0),
source as (
  select k, o_custkey, round(o_totalprice + 1, 2) as o_totalprice, PartitionDate
  from all_rows where o % 2 = 0
  union all
  select -o, o_custkey, o_totalprice, PartitionDate
  from all_rows, range(2) where o % 50 = 1)
select t.k, t.o_custkey, coalesce(s.o_totalprice, t.o_totalprice) as o_totalprice,
  t.PartitionDate
from target t left join source s using (PartitionDate, k, o_custkey)
union all
select s.k, s.o_custkey, s.o_totalprice, s.PartitionDate
from source s anti join target t using (PartitionDate, k, o_custkey)""",
    "run_ledger_steps": f"""with {_HELD}
select 'run-' || week::varchar as run_id, 'table_' || runs.table_id::varchar as dataset,
  runs.table_id,
  case week when 2 then 'FAILED' when 3 then 'SKIPPED' else 'SUCCESS' end as status,
  from_date, to_date,
  case week when 2 then null when 3 then 0 else row_count end as row_count,
  case week when 2 then null when 3 then 0 else partition_count end as partition_count,
  case week when 2 then null when 3 then '' else (
    select string_agg(day, ',' order by day) from held
    where held.table_id = runs.table_id
      and (floor((extract(day from day::date) - 1) / 7))::int = week) end
    as partition_dates,
  case week when 2 then null when 3 then 0.0 else 1.5 end::double
    as write_duration_seconds,
  case week when 2 then 'broken' end as error_message
from runs""",
    "publish_late_rows": f"""
select "Date", count(*) as groups, sum(row_count)::bigint as row_count,
  round(sum(total_mean), 2) as total
from ({_stats("strftime(LocalDateTime::date, '%Y-%m-%d')")}) group by 1""",
    "conform_plain_dates": """
select event_id, t::int as source_table_id, strftime(ts, '%Y-%m-%d') as PartitionDate
from events, range(1, 4) r(t)
where ts::date between date '2024-01-01' and date '2024-01-20'""",
    "skipped_then_merged": """
select 'table_1' as dataset, count(*) as row_count,
  count(distinct ts::date)::int as day_count
from events""",
    "gold_matrices": f"""with {_TELEMETRY},
cells as (
  select strftime(LocalDateTime, '%Y-%m-%d') as "Date", AccountId, SiteId, HouseIdSet,
    event_type as beltids, (event_id % 4)::int as linenmbr,
    floor(least(greatest(total - 5, 0.0::double), 99.999::double))::int as bin,
    coalesce(reading, 0.0) as cell
  from telemetry where total is not null),
summed as (
  select "Date", AccountId, SiteId, HouseIdSet, beltids, linenmbr,
    count(distinct bin) as bins, round(sum(cell), 2) as total
  from cells group by all)
select *, unnest(['long', 'wide']) as matrix from summed""",
}

ORACLE = {
    "scan_partitioned": """
select event_id, user_id, value, strftime(ts, '%Y-%m-%d') as day from events
where ts::date in (date '2024-01-03', date '2024-01-04', date '2024-01-11',
  date '2024-01-20', date '2024-02-15')""",
    "silver_range_scan": """
select o_orderkey, o_totalprice,
  strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') as PartitionDate
from orders
where date_trunc('month', o_orderdate) between date '1996-03-01' and date '1998-12-01'""",
    "range_filter": """
select o_orderkey, o_orderdate from orders
where o_orderdate >= timestamp '1996-01-01' and o_orderdate <= timestamp '1997-06-30'""",
    "csv_lookup_roundtrip": """
select s_suppkey::varchar as Id, s_nationkey::varchar as AccountId, s_name as Name
from supplier""",
    "preview_topk": """
select c_custkey, c_name from customer order by c_name, c_custkey limit 10""",
    "conform_cast": """
select event_id,
  case event_id % 4
    when 0 then strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
    when 1 then strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f')
    when 2 then strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f') end as "at",
  case when event_id % 4 in (0, 1) then strftime(ts, '%Y-%m-%d') end as "on",
  try_cast(event_id as tinyint)::int as small,
  case when event_id % 4 <> 3 then value end as amount,
  user_id::varchar as label,
  ((event_id % 4 = 3)::int + (event_id % 4 not in (0, 1))::int
    + (event_id > 127)::int + (event_id % 4 = 3 and value is not null)::int)
    as rejected
from events""",
    "partition_date": """
select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as PartitionDate,
  year(o_orderdate)::int as year, month(o_orderdate)::int as month
from orders where o_orderkey % 2 = 0 or o_orderkey % 5 <> 0""",
    "row_metadata": """
select event_id, 7 as source_table_id, 'barn' as source_system, true as has_file,
  '2024-01-15' as ingestion_date,
  epoch_us(timestamp '2024-01-15 06:00:00') as ingested_micros
from events""",
    "date_expr": """
select event_id,
  strftime(case event_id % 4 when 0 then ts::date when 1 then ts::date
    when 2 then ts::date + 2 else ts::date + 5 end, '%Y-%m-%d') as day
from events""",
    "bigint_or_null": """
select p_partkey,
  case p_partkey % 5 when 0 then p_size::bigint when 1 then p_size::bigint
    when 4 then try_cast(repeat('9', p_size % 30) as bigint) end as number
from part""",
    "numeric_suffix": r"""
select s_suppkey, try_cast(regexp_extract(s_name, '(\d+)$', 1) as bigint) as suffix
from supplier""",
    "normalize_identifier": rf"""with {_TELEMETRY}
select event_id,
  regexp_replace(case when event_id % 7 = 0 then HouseIdSet || ',' || HouseIdSet
    else HouseIdSet end, '^[\[\]\s]+|[\[\]\s]+$', '', 'g') as identifier
from telemetry""",
    "position_bin": """
select l_orderkey, l_linenumber,
  case when l_linenumber <> 7 then floor(least(greatest(
    l_quantity * 2.2::double - 5, 0.0::double), 99.999::double))::int end
    as position_bin
from lineitem""",
    "account_lookup": """
select c_custkey::bigint as AccountRowId, c_name as Customer from customer""",
    "house_lookup": f"with {_HOUSES} select * from houses",
    "site_lookup": f"with {_SITES} select * from sites",
    "dashboard_join": f"""with {_DASHBOARD}
select event_id, AccountId, SiteId, HouseIdSet, HouseId, Customer, HouseName,
  HouseAlias, SiteName, SiteAlias, HouseOrdinal, reading
from dashboard""",
    "daily_stats": _stats("LocalDateTime::date"),
    "metric_sum": _metric("sum", "round(sum(reading), 4)"),
    "metric_max": _metric("max", "round(max(reading), 4)"),
    "metric_min": _metric("min", "round(min(reading), 4)"),
    "metric_last": _metric(
        "last",
        "round(arg_max(reading, (LocalDateTime, event_id)) "
        "filter (where reading is not null), 4)",
    ),
    "metric_delta": _metric("delta", "round(max(reading) - min(reading), 4)"),
    "metric_mean": _metric("mean", "round(avg(reading), 8)"),
    "null_fraction": f"""with {_TELEMETRY}
select AccountId, event_type, count(*) as row_count,
  count(*) - count(latest) as latest_null_count,
  round((count(*) - count(latest)) / count(*), 6) as latest_null_fraction
from telemetry group by all""",
    "day_progress": """
select ts::date as "Date", count(*) as row_count,
  case when ts::date = date '2024-01-15' then 6.0 else 24.0 end::double
    as elapsed_utc_hours,
  case when ts::date = date '2024-01-15' then 0.25 else 1.0 end::double
    as day_progress_fraction
from events group by ts::date""",
    "matrix_long": f"""with {_CELLS}
select {_MATRIX_KEYS}, position_bin, round(sum(cell), 2) as eggsincrease_sum,
  count(*) as sample_count
from cells group by all""",
    "matrix_wide": f"""with {_CELLS}
select {_MATRIX_KEYS},
  {_WIDE_COLUMNS}
from cells group by {_MATRIX_KEYS}""",
    "partition_dates": "select distinct strftime(ts, '%Y-%m-%d') as day from events",
    "replace_partitions": """
select event_id,
  round(case when ts >= timestamp '2024-01-16' then value + 1000 else value end, 2)
    as value,
  year(ts)::int as year, month(ts)::int as month,
  strftime(ts, '%Y-%m-%d') as PartitionDate
from events""",
    "gold_write_roundtrip": """
select user_id, count(*) as row_count, year(ts)::int as year, month(ts)::int as month,
  strftime(ts, '%Y-%m-%d') as "Date"
from events group by all""",
    "schema_evolution": """
select event_id, case when ts >= timestamp '2024-01-16' then value * 2 end as doubled,
  strftime(ts, '%Y-%m-%d') as PartitionDate
from events""",
    "upsert": """
with target as (
  select o_orderkey, o_totalprice, o_orderstatus,
    strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') as PartitionDate
  from orders),
source as (
  select case when o_orderstatus = 'F' then o_orderkey else -1 - o_orderkey end
      as o_orderkey,
    round(o_totalprice + 1, 2) as o_totalprice, PartitionDate
  from target)
select t.o_orderkey, coalesce(s.o_totalprice, t.o_totalprice) as o_totalprice,
  t.o_orderstatus, t.PartitionDate
from target t left join source s using (PartitionDate, o_orderkey)
union all
select s.o_orderkey, s.o_totalprice, null, s.PartitionDate
from source s anti join target t using (PartitionDate, o_orderkey)""",
    "run_ledger": f"""with {_HELD}
select table_id, case when week = 2 then 'FAILED' else 'SUCCESS' end as status,
  count(*) as runs, sum(row_count)::bigint as row_count,
  sum(partition_count)::bigint as partition_count,
  min(from_date) as from_date, max(to_date) as to_date
from runs group by all""",
    "logged_dates": f"with {_DONE} select table_id, day from done",
    "backfill_calendar": f"with {_WANTED} select table_id, day from wanted",
    "backfill_gaps": f"""with {_DONE}, {_WANTED}
select table_id, day from wanted where (table_id, day) not in (select * from done)""",
    "backfill_forced": f"""with {_DONE}, {_WANTED}
select table_id, day, table_id = 2 as forced from wanted
where table_id = 2 or (table_id, day) not in (select * from done)""",
    "verify_outputs": """
select 'events' as dataset, count(*) as row_count,
  count(distinct ts::date)::int as day_count,
  strftime(min(ts), '%Y-%m-%d') as first_day, strftime(max(ts), '%Y-%m-%d') as last_day
from events
union all
select 'orders', count(*), count(distinct date_trunc('month', o_orderdate))::int,
  strftime(date_trunc('month', min(o_orderdate)), '%Y-%m-%d'),
  strftime(date_trunc('month', max(o_orderdate)), '%Y-%m-%d')
from orders
union all
select 'absent', 0, 0, null, null""",
    "silver_conform": f"""with {_TELEMETRY}
select event_id, AccountId, HouseIdSet, LocalDateTime, reading,
  (event_id % 4)::int as linenmbr,
  strftime(LocalDateTime, '%Y-%m-%d') as PartitionDate,
  year(LocalDateTime)::int as year, month(LocalDateTime)::int as month,
  1 as source_table_id, 'barn' as source_system, '2024-01-15' as ingestion_date
from telemetry""",
    "gold_end_to_end": _stats(
        "strftime(LocalDateTime::date, '%Y-%m-%d')",
        """,
  year(LocalDateTime::date)::int as year, month(LocalDateTime::date)::int as month""",
    ),
    **HARD,
    **CHANGES,
}
