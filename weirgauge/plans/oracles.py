"""ANSI SQL with the same answers as the named queries, for an independent engine.

The statements are written from the semantics of each check, not from the Spark
plans: totals and deltas use a full outer join here, coverage uses joins and
distinct counts, thresholds use the plain quotient.
"""

from __future__ import annotations

from weirgauge.plans import fixed_values as V

EVENT_DAY = "date '2024-01-15'"
ORDER_DAY = "date '1998-10-03'"


def _counts(table: str, column: str, day: str, days: int = 7) -> str:
    return (
        f"select '{table}' as source_table, {column}::date as record_date, count(*) as record_count from {table} "
        f"where {column}::date between {day} - {days} and {day} group by {column}::date"
    )


def _baseline(counts: str, day: str) -> str:
    return f"""
    select source_table,
           max(record_count) filter (record_date = {day}) as current_record_count,
           cast(sum(record_count) filter (record_date < {day}) as bigint) as baseline_rows,
           count(*) filter (record_date < {day}) as baseline_days,
           avg(record_count) filter (record_date < {day}) as expected_record_count
    from ({counts}) group by source_table"""


def _volume(counts: str, day: str, extra: str = "", joins: str = "", digits: int = 4) -> str:
    return f"""
    select b.source_table, cast({day} as varchar) as record_date, current_record_count,
           round(expected_record_count, {digits}) as expected_record_count,
           round(abs(current_record_count - expected_record_count) / expected_record_count * 100, 2) as deviation_pct,
           case when abs(current_record_count - expected_record_count) / expected_record_count > 0.2
                then 'ALERT' else 'OK' end as status {extra}
    from ({_baseline(counts, day)}) b {joins}
    where current_record_count is not null and baseline_days > 0"""


SALES_COUNTS = f"{_counts('orders', 'o_orderdate', ORDER_DAY)} union all {_counts('lineitem', 'l_shipdate', ORDER_DAY)}"
EVENT_COUNTS = _counts("events", "ts", EVENT_DAY)


OUTAGE_DAY, SILENT_DAY = "date '2001-08-05'", "date '2024-01-31'"
OUTAGE_COUNTS = f"{_counts('orders', 'o_orderdate', OUTAGE_DAY)} union all {_counts('lineitem', 'l_shipdate', OUTAGE_DAY)}"
OUTAGES = f"""
    select e.source_table, cast({OUTAGE_DAY} as varchar) as record_date, 0::bigint as current_record_count,
           round(avg(c.record_count), 4) as expected_record_count,
           case when count(c.record_count) > 0 then 100.0::double end as deviation_pct,
           case when count(c.record_count) > 0 then 'ALERT' else 'NO_DATA' end as status,
           cast(max(c.record_date) as varchar) as last_record_date, 'no rows on the day' as likely_cause
    from (values ('orders'), ('lineitem'), ('returns')) e(source_table)
         left join ({OUTAGE_COUNTS}) c on c.source_table = e.source_table
    where e.source_table not in (select source_table from ({OUTAGE_COUNTS}) where record_date = {OUTAGE_DAY})
    group by e.source_table"""


def _dense(counts: str, tables: str, first: str, last: str) -> str:
    """Counts with zero for the days of each table (name, first day) that have none."""
    return f"""
    select s.source_table, s.record_date, coalesce(c.record_count, 0) as record_count
    from (select source_table, unnest(generate_series(greatest(since, {first}), {last}, interval 1 day))::date as record_date
          from (values {tables}) e(source_table, since)) s
         left join ({counts}) c on c.source_table = s.source_table and c.record_date = s.record_date"""


_HISTORY = " union all ".join(
    f"select '{table}' as source_table, {column}::date as record_date, count(*) as record_count from {table} group by all"
    for table, column in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"))
)
_HISTORY_DENSE = _dense(
    _HISTORY,
    "('orders', date '1994-12-25'), ('lineitem', date '1996-01-10')",
    "date '1994-12-25'",
    "date '2001-12-31'",
)


def _groups(table: str, keys: str, where: str = "true") -> str:
    return f"select {keys}, count(*) as row_count from {table} where {where} group by {keys} having count(*) > 1"


def _stats(groups: str) -> str:
    return (
        f"select count(*) as duplicate_key_groups, "
        f"cast(coalesce(sum(row_count - 1), 0) as bigint) as extra_duplicate_rows from ({groups})"
    )


def _worst(groups: str, keys: str) -> str:
    order = f"row_count desc, {keys}"
    return f"select *, cast(row_number() over (order by {order}) as int) as rank from ({groups}) order by {order} limit 5"


EVENT_DAYS = "(select *, ts::date as event_day from events)"
EVENT_KEY = "user_id, event_type, event_day"
LINE_KEY = "l_orderkey, l_linenumber"
EVENT_DAY_GROUPS = _groups(EVENT_DAYS, EVENT_KEY, f"event_day = {EVENT_DAY}")


def _report_arm(name: str, groups: str, keys: str, columns: str) -> str:
    return f"""
    select '{name}' as source_table, s.*, w.rank, {columns}, w.row_count, case when w.rank is null then null
           else '{keys}' end as field
    from ({_stats(groups)}) s left join ({_worst(groups, keys)}) w on true"""


_NONE = {"l_orderkey": "bigint", "l_linenumber": "int", "o_orderkey": "bigint", "user_id": "bigint", "event_type": "varchar"}


def _report_columns(*own: str) -> str:
    return ", ".join(f"w.{c}" if c in own else f"cast(null as {kind}) as {c}" for c, kind in _NONE.items())


def _backfill(parts: list[tuple[str, str]], first: str, last: str) -> str:
    counts = " union all ".join(
        f"select '{t}' as source_table, {c}::date as record_date, count(*) as n from {t} "
        f"where {c}::date between {first} - 7 and {last} group by {c}::date"
        for t, c in parts
    )
    return f"""
    with counts as ({counts}),
    framed as (
        select *, avg(n) over (partition by source_table order by record_date
                               range between interval 7 days preceding and interval 1 day preceding) as expected
        from counts)
    select source_table, cast(record_date as varchar) as record_date, n as current_record_count,
           round(expected, 4) as expected_record_count,
           round(abs(n - expected) / expected * 100, 2) as deviation_pct,
           case when abs(n - expected) / expected > 0.2 then 'ALERT' else 'OK' end as status
    from framed where record_date >= {first}"""


# -- change -----------------------------------------------------------------------


def _sides(name: str, key: str, label: str, current: str, previous: str) -> str:
    """Per-entity full outer join of two grouped sides; NULL keys never match."""
    return f"""
    select '{name}' as check_name, coalesce(c.k, p.k) as entity, coalesce(c.label, p.label) as name,
           c.v as current_value, p.v as previous_value, coalesce(c.v, 0) - coalesce(p.v, 0) as delta
    from (select {key} as k, max({label}) as label, sum(m) as v from ({current}) group by 1) c
    full outer join (select {key} as k, max({label}) as label, sum(m) as v from ({previous}) group by 1) p
      on c.k = p.k"""


def _drivers(sides: str) -> str:
    return f"""
    select * from (
        select check_name, cast(row_number() over (partition by check_name order by abs(delta) desc, entity) as int)
                 as rank, entity, name, delta from ({sides})) where rank <= 5"""


def _event_side(day: str, where: str) -> str:
    return f"select *, value::decimal(18,2) as m, null::varchar as no_name from events where ts::date = {day} and {where}"


def _event_sides(name: str, where: str) -> str:
    return _sides(
        name, "user_id", "no_name", _event_side(EVENT_DAY, where), _event_side(f"{EVENT_DAY} - 1", where)
    )


EVENT_SIDES = f"{_event_sides('event_value', 'true')} union all " + _event_sides(
    "purchase_value", "event_type = 'purchase'"
)


def _order_side(day: str) -> str:
    return f"select *, o_totalprice::decimal(18,2) as m from orders where o_orderdate::date = {day}"


ORDER_SIDES = _sides(
    "order_value", "o_custkey", "o_orderpriority", _order_side(ORDER_DAY), _order_side(f"{ORDER_DAY} - 1")
)


def _total_row(name: str, current: str, previous: str) -> str:
    return f"""
    select '{name}' as check_name, (select sum(m) from ({current})) as c, (select sum(m) from ({previous})) as p"""


EVENT_TOTALS = " union all ".join(
    _total_row(name, _event_side(EVENT_DAY, where), _event_side(f"{EVENT_DAY} - 1", where))
    for name, where in (("event_value", "true"), ("purchase_value", "event_type = 'purchase'"))
)
ORDER_TOTALS = _total_row("order_value", _order_side(ORDER_DAY), _order_side(f"{ORDER_DAY} - 1"))


def _change(totals: str, breach: str, day: str) -> str:
    return f"""
    select check_name, c::double as current_value, p::double as previous_value, cast({day} as varchar) as alert_date,
           round(abs(c - p), 2)::double as abs_difference,
           round(abs(c - p)::double / nullif(p, 0)::double * 100, 2) as change_pct,
           case when {breach} then 'ALERT' else 'OK' end as status
    from ({totals})"""


# -- coverage -----------------------------------------------------------------------

COVERAGE_RULES = [
    ("any_activity", "purchase", 0, "true"),
    ("morning_view", "purchase", 0, "event_type = 'view' and hour(ts) < 12"),
    ("previous_day_signup", "signup", 1, "event_type like 'cl%'"),
]
EVENT_FACTS = "\n union all ".join(
    f"""
    select '{name}' as check_name, '{source}' as source_table, {EVENT_DAY} - {lag} as check_date, b.user_id,
           coalesce(u.total, 0) as usage_value
    from (select distinct user_id from events
          where ts::date = {EVENT_DAY} and event_type <> 'error' and event_type in ('view', 'click')) b
    join events e on e.user_id = b.user_id and e.ts::date = {EVENT_DAY} and e.event_type <> 'error' and ({extra})
    left join (select user_id, sum(coalesce(value::decimal(18,2), 0)) as total from events
               where event_type = '{source}' and ts::date = {EVENT_DAY} - {lag} group by user_id) u
      on u.user_id = b.user_id"""
    for name, source, lag, extra in COVERAGE_RULES
)


def _coverage(facts: str, key: str) -> str:
    return f"""
    select check_name, source_table, cast(check_date as varchar) as check_date,
           count(distinct {key}) as eligible,
           count(distinct {key}) filter (usage_value > 0) as with_usage,
           round(count(distinct {key}) filter (usage_value > 0) / count(distinct {key}) * 100, 2) as coverage_pct,
           case when count(distinct {key}) filter (usage_value > 0) / count(distinct {key}) < 0.5
                then 'ALERT' else 'OK' end as status
    from ({facts}) group by all"""


def _sample(facts: str, key: str, distinct: bool) -> str:
    return f"""
    select check_name, source_table, cast(check_date as varchar) as check_date, cast(rank as int) as rank, {key}
    from (select *, row_number() over (partition by check_name order by {key}) as rank
          from (select {'distinct' if distinct else ''} check_name, source_table, check_date, {key}
                from ({facts}) where usage_value = 0))
    where rank <= 10"""


# -- the revenue monitor ---------------------------------------------------------------

DERIVED = """
with src as (
    select *, value::decimal(18,2) as amount, ts::date as d,
           case event_type when 'click' then 'PAY001' when 'view' then 'UK0001' when 'error' then 'UK0002'
                           else 'COR0001' end as product,
           case when value < 25 then 'arr' else 'carr' end as revenue,
           case when value < 250 then 'actual' else 'budget' end as model
    from events),
t_daily as (
    select user_id as company_id, 'Account ' || user_id as account_name, product as product_code,
           revenue as revenue_type, model as model_type, d as date_id, event_type <> 'error' as is_active_product,
           case when value < 2 then 'Churned' when value < 4 then 'Pending Churn' else 'Customer' end
             as account_status,
           case when hour(ts) < 12 then 'yes' else 'no' end as grouping_ind,
           amount as end_budget_usd, floor(value)::bigint as number_of_employees
    from src),
t_snap as (
    select user_id as company_id, 'Account ' || user_id as account_name, product as product_code,
           revenue as revenue_type, model as model_type, d + late as date_key, d as date_id,
           amount as end_budget_usd, floor(value)::bigint as number_of_employees,
           (amount * 1000)::decimal(18,2) as natural_growth_budget_usd
    from src, (values (0), (1)) v(late)
    where late = 0 or event_type = 'signup'),
t_usage as (
    select user_id as company_id,
           case event_type when 'click' then 'fact company usage' when 'view' then 'Billing_Group'
                           when 'purchase' then 'pento_payroll_usage' else 'other' end as source_table,
           d as date_id, case when value >= 1 then floor(value / 20)::bigint end as active_employees
    from src),
t_buckets as (
    select user_id as company_id, product as product_code, revenue as revenue_type, model as model_type,
           event_type as bucket_name, d as date_id
    from src where event_type in ('purchase', 'signup'))
"""

_ROWS = "model_type = 'actual' and revenue_type = 'arr' and is_active_product"
MONITOR_FACTS = "\n union all ".join(
    f"""
    select '{name}' as check_name, '{source}' as source_table, {EVENT_DAY} - {lag} as check_date, b.company_id,
           coalesce(u.total, 0) as usage_value
    from (select distinct company_id from t_daily
          where {_ROWS} and date_id = {EVENT_DAY} and account_status in ('Customer', 'Pending Churn')) b
    semi join (select * from t_daily where {_ROWS} and date_id = {EVENT_DAY} and {extra}) e
      on e.company_id = b.company_id
    left join (select company_id, sum(coalesce(active_employees, 0)) as total from t_usage
               where source_table = '{source}' and date_id = {EVENT_DAY} - {lag} group by company_id) u
      on u.company_id = b.company_id"""
    for name, source, lag, extra in V.COVERAGE_CHECKS
)

_CARR = "model_type = 'actual' and revenue_type = 'carr'"


def _t_side(table: str, measure: str, lag: int, extra: str = "") -> str:
    pins = f"date_id = {EVENT_DAY} - {lag}" + (f" and date_key = {EVENT_DAY} - {lag}" if table == "t_snap" else "")
    return f"select company_id, account_name, {measure} as m from {table} where {_CARR} and {pins} {extra}"


_CORE = "and product_code = 'COR0001'"
CHANGE_SIDES = {
    V.END_BUCKET: (_t_side("t_daily", "end_budget_usd", 0), _t_side("t_snap", "end_budget_usd", 1)),
    V.EMPLOYEES: (
        _t_side("t_daily", "number_of_employees", 0, _CORE),
        _t_side("t_snap", "number_of_employees", 1, _CORE),
    ),
    V.GROWTH: (
        _t_side("t_snap", "natural_growth_budget_usd", 1),
        _t_side("t_snap", "natural_growth_budget_usd", 2),
    ),
}
MONITOR_SIDES = " union all ".join(
    _sides(name, "company_id", "account_name", *sides) for name, sides in CHANGE_SIDES.items()
)
_T_TABLES = {
    V.DAILY: ("t_daily", "date_id", "company_id, product_code, revenue_type, model_type, date_id"),
    V.SNAPSHOT: ("t_snap", "date_key", "company_id, product_code, revenue_type, model_type, date_key, date_id"),
    V.USAGE: ("t_usage", "date_id", "company_id, source_table, date_id"),
    V.BUCKETS: ("t_buckets", "date_id", "company_id, product_code, revenue_type, model_type, date_id"),
}
MONITOR_COUNTS = " union all ".join(
    f"select '{label}' as source_table, {column} as record_date, count(*) as record_count from {table} "
    f"where {column} between {EVENT_DAY} - 7 and {EVENT_DAY} group by {column}"
    for label, (table, column, _) in _T_TABLES.items()
)


def _monitor_groups(label: str) -> str:
    table, column, keys = _T_TABLES[label]
    return _groups(table, keys, f"{column} = {EVENT_DAY}")


MONITOR_CARD = f"""{DERIVED},
facts as ({MONITOR_FACTS}),
cov as ({_coverage("select * from facts", "company_id")}),
tot as ({" union all ".join(_total_row(name, *sides) for name, sides in CHANGE_SIDES.items())}),
base as ({_baseline(MONITOR_COUNTS, EVENT_DAY)}),
card as (
    select 'missing_usage_data' as alert_type, check_name as issue_type, source_table, check_date as alert_date,
           eligible::double as metric_1, with_usage::double as metric_2, coverage_pct as metric_3,
           null::double as metric_4, status
    from cov
    union all
    select check_name, check_name,
           case check_name when 'end_bucket_change' then 'MRT_WTFL_DAILY / MRT_WTFL_DAILY_SNAP'
                           when 'core_employee_count_change' then 'COR0001' else 'carr_current' end,
           cast(case check_name when 'natural_growth_change' then {EVENT_DAY} - 1 else {EVENT_DAY} end as varchar),
           c::double, p::double,
           case check_name when 'natural_growth_change' then round(abs(c - p), 2)::double
                           else round(abs(c - p)::double / nullif(p, 0)::double * 100, 2) end,
           case check_name when 'natural_growth_change'
                then round(abs(c - p)::double / nullif(p, 0)::double * 100, 2) end,
           case when check_name = 'natural_growth_change' and abs(c - p) > 800000 then 'ALERT'
                when check_name <> 'natural_growth_change' and p > 0 and abs(c - p)::double / p::double > 0.1
                then 'ALERT' else 'OK' end
    from tot
    union all
    select 'volume_anomaly', 'volume_anomaly_' || lower(source_table), source_table, cast({EVENT_DAY} as varchar),
           current_record_count::double, round(expected_record_count, 4),
           round(abs(current_record_count - expected_record_count) / expected_record_count * 100, 2), null,
           case when abs(current_record_count - expected_record_count) / expected_record_count > 0.2
                then 'ALERT' else 'OK' end
    from base where current_record_count is not null and baseline_days > 0
    union all
    select 'volume_anomaly', 'volume_anomaly_mrt_wtfl_unpivot', source_table, cast({EVENT_DAY} as varchar),
           current_record_count::double, round(expected_record_count, 2),
           round(abs(current_record_count - expected_record_count) / expected_record_count, 2),
           round(current_record_count - expected_record_count, 4),
           case when abs(current_record_count - expected_record_count) / expected_record_count > 0.2
                then 'ALERT' else 'OK' end
    from base where current_record_count is not null and source_table = 'MRT_WTFL_DAILY'),
drivers as ({_drivers(MONITOR_SIDES)}),
sample as ({_sample("select * from facts", "company_id", True)})
"""

_DUPLICATES = " union all ".join(
    f"""
    select '{label}' as checked_table, s.*, w.rank, w.company_id, {product} as product_code,
           {source} as usage_source, w.row_count
    from ({_stats(_monitor_groups(label))}) s left join ({_worst(_monitor_groups(label), _T_TABLES[label][2])}) w on true"""
    for label, product, source in (
        (V.DAILY, "w.product_code", "null::varchar"),
        (V.SNAPSHOT, "w.product_code", "null::varchar"),
        (V.USAGE, "null::varchar", "w.source_table"),
        (V.BUCKETS, "w.product_code", "null::varchar"),
    )
)
_BUCKET_GROUPS = _groups("t_buckets", "company_id, bucket_name, date_id", f"date_id = {EVENT_DAY}")
_DUP_STATS = " union all ".join(
    f"select '{label}' as source_table, * from ({_stats(_monitor_groups(label))})" for label in _T_TABLES
)

# One (issue, member, text) row per scalar of interest in the JSON details.
MONITOR_DETAIL = f"""{MONITOR_CARD}, dups as ({_DUP_STATS})
select issue_type, unnest(['total_eligible_companies', 'companies_with_usage', 'threshold_pct', 'measure_field'])
         as member,
       unnest([(metric_1::bigint)::varchar, (metric_2::bigint)::varchar, '50', 'active_employees']) as content
from card where alert_type = 'missing_usage_data'
union all
select check_name, unnest(['current_value', 'previous_value', 'date', 'measure_field']),
       unnest([c::decimal(38,2)::varchar, p::decimal(38,2)::varchar, '2024-01-15', 'end_budget_usd'])
from tot where check_name = 'end_bucket_change'
union all
select check_name, unnest(['current_employee_count', 'previous_employee_count', 'date', 'measure_field']),
       unnest([c::bigint::varchar, p::bigint::varchar, '2024-01-15', 'number_of_employees'])
from tot where check_name = 'core_employee_count_change'
union all
select check_name, unnest(['prev_day_natural_growth', 'two_days_ago_natural_growth', 'date', 'measure_field']),
       unnest([c::decimal(38,2)::varchar, p::decimal(38,2)::varchar, '2024-01-14', 'natural_growth_budget_usd'])
from tot where check_name = 'natural_growth_change'
union all
select issue_type, unnest(['current_record_count', 'duplicate_key_groups', 'extra_duplicate_rows', 'likely_cause', 'date']),
       unnest([(metric_1::bigint)::varchar, duplicate_key_groups::varchar, extra_duplicate_rows::varchar,
               case when duplicate_key_groups > 0 then 'duplicate rows on natural key'
                    else 'row count deviation vs 7-day average' end, '2024-01-15'])
from card join dups using (source_table)
where alert_type = 'volume_anomaly' and issue_type <> 'volume_anomaly_mrt_wtfl_unpivot'
union all
select issue_type, unnest(['current_record_count', 'likely_cause', 'date']),
       unnest([(metric_1::bigint)::varchar, 'row count deviation vs 7-day average', '2024-01-15'])
from card where issue_type = 'volume_anomaly_mrt_wtfl_unpivot'
"""

_MONEY = "format('{{:,.2f}}', {0}::double)"
_COUNT = "format('{{:,}}', {0}::bigint)"
_PCT = "format('{{:.1f}}', round({0}, 1))"


def _driver_lines(name: str, money: bool) -> str:
    figure = f"'$' || {_MONEY.format('delta')}" if money else _COUNT.format("delta")
    return (
        f"(select string_agg(chr(10) || '• ' || name || ' (`' || entity || '`): ' || {figure}, '' order by rank) "
        f"from drivers where check_name = '{name}')"
    )


_KEY_LINES = " union all ".join(
    f"select '{label}' as source_table, rank, company_id || ' / ' || {second} as shown, row_count "
    f"from ({_worst(_monitor_groups(label), _T_TABLES[label][2])})"
    for label, second in (
        (V.DAILY, "product_code"),
        (V.SNAPSHOT, "product_code"),
        (V.USAGE, "source_table"),
        (V.BUCKETS, "product_code"),
    )
)
# Message texts are built by concatenation here and by templates in the engine.
MONITOR_MESSAGES = f"""{MONITOR_CARD}, dups as ({_DUP_STATS}),
key_lines as (select source_table, string_agg(chr(10) || '• `' || shown || '`: ' || {_COUNT.format("row_count")}
                || ' rows', '' order by rank) as lines from ({_KEY_LINES}) group by source_table),
fired as (select * from card where status = 'ALERT'),
texts as (
select alert_type, issue_type,
       ':warning: *Waterfall Alert — Missing Usage Data*' || chr(10) ||
       'Source: `' || source_table || '` | Date: `' || alert_date || '`' || chr(10) ||
       'Eligible: `' || {_COUNT.format("metric_1")} || '` | With usage: `' || {_COUNT.format("metric_2")} || '` (' ||
       {_PCT.format("metric_3")} || '%)' || chr(10) ||
       'Field: `active_employees` on `PROD_DWH.WATERFALL.MRT_USAGE`' || chr(10) ||
       'Root cause: sample companies missing usage' ||
       coalesce((select string_agg(chr(10) || '• `' || company_id || '`', '' order by rank) from sample s
                 where s.check_name = issue_type), '') as message
from fired where alert_type = 'missing_usage_data'
union all
select alert_type, issue_type,
       ':warning: *Waterfall Alert — End Bucket Change*' || chr(10) ||
       'Date: `' || alert_date || '` | Field: `end_budget_usd`' || chr(10) ||
       'Today (`MRT_WTFL_DAILY`): `$' || {_MONEY.format("metric_1")} ||
       '` | Yesterday snap (`MRT_WTFL_DAILY_SNAP`): `$' || {_MONEY.format("metric_2")} || '` | Change: ' ||
       {_PCT.format("metric_3")} || '%' || chr(10) ||
       'Root cause — top company drivers (largest `end_budget_usd` deltas):' ||
       {_driver_lines("end_bucket_change", True)}
from fired where alert_type = 'end_bucket_change'
union all
select alert_type, issue_type,
       ':warning: *Waterfall Alert — Core Employee Count Change*' || chr(10) ||
       'Date: `' || alert_date || '` | Product: Core (COR0001) | Field: `number_of_employees`' || chr(10) ||
       'Today: `' || {_COUNT.format("metric_1")} || '` | Yesterday snap: `' || {_COUNT.format("metric_2")} ||
       '` | Change: ' || {_PCT.format("metric_3")} || '%' || chr(10) || 'Root cause — top company drivers:' ||
       {_driver_lines("core_employee_count_change", False)}
from fired where alert_type = 'core_employee_count_change'
union all
select alert_type, issue_type,
       ':warning: *Waterfall Alert — Natural Growth Change*' || chr(10) ||
       'Bucket: CARR_CURRENT | Date: `' || alert_date ||
       '` | Field: `natural_growth_budget_usd` on `MRT_WTFL_DAILY_SNAP`' || chr(10) ||
       'Yesterday: `$' || {_MONEY.format("metric_1")} || '` | 2 days ago: `$' || {_MONEY.format("metric_2")} || '`' ||
       chr(10) || 'Abs diff: `$' || {_MONEY.format("metric_3")} || '` | Pct diff: ' || {_PCT.format("metric_4")} ||
       '%' || chr(10) || 'Root cause — top company drivers:' || {_driver_lines("natural_growth_change", True)}
from fired where alert_type = 'natural_growth_change'
union all
select alert_type, issue_type,
       ':warning: *Waterfall Alert — Volume Anomaly*' || chr(10) ||
       'Table: `' || source_table || '` | Date: `' || alert_date || '`' || chr(10) ||
       'Current rows: `' || {_COUNT.format("metric_1")} || '` | Expected (7d avg): `' || {_MONEY.format("metric_2")} ||
       '` | Deviation: ' || {_PCT.format("case when metric_4 is null then metric_3 else metric_3 * 100 end")} || '%' ||
       chr(10) || 'Root cause: `' ||
       case when metric_4 is null and duplicate_key_groups > 0 then 'duplicate rows on natural key'
            else 'row count deviation vs 7-day average' end || '`' ||
       case when metric_4 is null then ' — duplicate groups: `' || {_COUNT.format("duplicate_key_groups")} ||
            '`, extra rows: `' || {_COUNT.format("extra_duplicate_rows")} || '`' || coalesce(lines, '') else '' end
from fired join dups using (source_table) left join key_lines using (source_table)
where alert_type = 'volume_anomaly')
select * from texts
union all
select 'all_clear', 'all_clear', ':white_check_mark: Waterfall monitors — all checks passed for 2024-01-15.'
where not exists (select * from fired)
"""

_DETERMINED = "select alert_type, issue_type, source_table, alert_date"
_SINGLE_CHANGE = {
    V.END_BUCKET: "metric_1 as current_value, metric_2 as previous_value, metric_3 as diff_pct",
    V.EMPLOYEES: "metric_1 as current_value, metric_2 as previous_value, metric_3 as diff_pct",
    V.GROWTH: (
        "metric_1 as prev_day_value, metric_2 as two_days_ago_value, metric_3 as abs_difference, "
        "metric_4 as diff_pct"
    ),
}
_SHOWN_BREACH = {V.END_BUCKET: "metric_3 > 10", V.EMPLOYEES: "metric_3 > 10", V.GROWTH: "metric_3 > 800000"}

# Members of the detail lists of every check, or of the alerts only.
_KEY_MEMBERS = " union all ".join(
    f"select '{label}' as source_table, rank, company_id, row_count "
    f"from ({_worst(_monitor_groups(label), _T_TABLES[label][2])})"
    for label in _T_TABLES
)


def _list_members(where: str) -> str:
    return f"""{MONITOR_CARD}, key_members as ({_KEY_MEMBERS}), wanted as (select * from card where {where})
    select issue_type, 'sample_missing_companies' as member, rank::int as rank, company_id::varchar as company_id,
           null::varchar as account_name, null::double as delta, null::bigint as row_count
    from wanted join sample on check_name = issue_type where alert_type = 'missing_usage_data'
    union all
    select issue_type, 'top_drivers', rank::int, entity::varchar, name, delta::double, null
    from wanted join drivers on check_name = issue_type where alert_type not in ('missing_usage_data', 'volume_anomaly')
    union all
    select issue_type, 'top_duplicate_keys', rank::int, k.company_id::varchar, null, null, row_count
    from wanted join key_members k using (source_table)
    where alert_type = 'volume_anomaly' and issue_type <> 'volume_anomaly_mrt_wtfl_unpivot'"""


_WHOLE_LOAD = "    from events),\nt_daily"
_HALF_LOAD = f"    from events where ts::date <> {EVENT_DAY} or hour(ts) < 12),\nt_daily"


def _half_day(sql: str) -> str:
    """The same over a load that stopped at noon of the day."""
    if _WHOLE_LOAD not in sql:
        raise ValueError("the derived tables have another source")
    return sql.replace(_WHOLE_LOAD, _HALF_LOAD)


MONITOR_CONSTANTS = f"""{MONITOR_CARD}, rows as (
select issue_type, unnest(['coverage_pct', 'table', 'source_table']) as member,
       unnest([metric_3::double::varchar, '{V.DATABASE}.{V.USAGE}', source_table]) as content
from card where alert_type = 'missing_usage_data'
union all
select issue_type, unnest(['expected_record_count', 'deviation_pct', 'source_table', 'field']),
       unnest([round(base.expected_record_count, 2)::varchar, metric_3::double::varchar, source_table, 'all rows'])
from card join base using (source_table)
where alert_type = 'volume_anomaly' and issue_type <> 'volume_anomaly_mrt_wtfl_unpivot'
union all
select issue_type, unnest(['expected_record_count', 'deviation_pct', 'diff_record', 'source_table', 'status']),
       unnest([metric_2::double::varchar, metric_3::double::varchar,
               round(current_record_count - base.expected_record_count, 2)::varchar, source_table, status])
from card join base using (source_table) where issue_type = 'volume_anomaly_mrt_wtfl_unpivot')
select * from rows where content is not null"""

_DAY_VALUES = "select ts::date as d, sum(value::decimal(18,2))::double as v from events group by 1"

ORACLES: dict[str, str] = {
    "volume_outages": OUTAGES,
    "volume_scorecard_expected": f"{_volume(OUTAGE_COUNTS, OUTAGE_DAY)} union all "
    f"select source_table, record_date, current_record_count, expected_record_count, deviation_pct, status from ({OUTAGES})",
    "volume_scorecard_zero_days": _volume(
        _dense(
            OUTAGE_COUNTS,
            f"('orders', {OUTAGE_DAY} - 7), ('lineitem', {OUTAGE_DAY} - 7)",
            f"{OUTAGE_DAY} - 7",
            OUTAGE_DAY,
        ),
        OUTAGE_DAY,
    ),
    "volume_backfill_zero_days": f"""
    select a.source_table, cast(a.record_date as varchar) as record_date, a.record_count as current_record_count,
           round(avg(b.record_count), 4) as expected_record_count,
           round(abs(a.record_count - avg(b.record_count)) / nullif(avg(b.record_count), 0) * 100, 2) as deviation_pct,
           case when abs(a.record_count * count(b.record_count) - sum(b.record_count)) > 0.2 * sum(b.record_count)
                     and sum(b.record_count) > 0
                then 'ALERT' else 'OK' end as status
    from ({_HISTORY_DENSE}) a left join ({_HISTORY_DENSE}) b on b.source_table = a.source_table
         and b.record_date between a.record_date - 7 and a.record_date - 1
    where a.record_date >= date '1995-01-01'
    group by a.source_table, a.record_date, a.record_count""",
    "change_mixed_measures": """
    select 'fine' as check_name, 10.0::double as change_pct, 5::int as n_drivers, 'ALERT' as status where exists (from events)
    union all select 'whole', 0.0, 5, 'OK' where exists (from events)
    union all select 'broken', round(abs(sum(value) - sum(value / 2)) / sum(value / 2) * 100, 1), 5,
                     case when sum(value) > 0 then 'ALERT' else 'OK' end from events""",
    "change_no_data": f"""
    select 'event_value' as check_name, null::double as current_value,
           (select sum(value::decimal(18,2))::double from events where ts::date = {SILENT_DAY} - 1) as previous_value,
           'NO_DATA' as status
    union all select 'purchase_value', null, (select sum(value::decimal(18,2))::double from events
                     where ts::date = {SILENT_DAY} - 1 and event_type = 'purchase'), 'NO_DATA'""",
    "state_volume_baseline": f"select * replace (round(expected_record_count, 4) as expected_record_count) "
    f"from ({_baseline(SALES_COUNTS, ORDER_DAY)})",
    "state_entity_deltas": f"select check_name, entity, current_value::double as current_value, "
    f"previous_value::double as previous_value, delta::double as delta from ({EVENT_SIDES})",
    "published_history": f"""
    select 'change' as alert_type, 'event_value' as issue_type, 'events' as source_table, cast(c.d as varchar) as alert_date,
           c.v as metric_1, p.v as metric_2, round(abs(c.v - p.v) / p.v * 100, 2) as metric_3, null::double as metric_4,
           '{{"check":"event_value"}}' as detail, cast(c.d as varchar) as record_date
    from ({_DAY_VALUES}) c join ({_DAY_VALUES}) p on p.d = c.d - 1
    where c.d between date '2024-01-14' and date '2024-01-16' and abs(c.v - p.v) / p.v > 0.02""",
    "contract_on_write": """
    with e as (select case when event_id % 7 <> 0 then event_type end as event_type from events)
    select 'not_null' as rule, 'event_type' as column_name, count(*) as violations from e where event_type is null
    union all select 'accepted_values', 'event_type', count(*) from e
              where event_type not in ('click', 'purchase', 'signup', 'view')
    union all select 'retired_value', 'event_type', count(*) from e where lower(event_type) like '%err%'""",
    "volume_daily_counts": f"select source_table, cast(record_date as varchar) as record_date, record_count "
    f"from ({SALES_COUNTS})",
    "volume_baseline": f"select * replace (round(expected_record_count, 4) as expected_record_count) "
    f"from ({_baseline(SALES_COUNTS, ORDER_DAY)})",
    "volume_scorecard": _volume(
        EVENT_COUNTS,
        EVENT_DAY,
        ", duplicate_key_groups, extra_duplicate_rows, case when duplicate_key_groups > 0 then "
        "'duplicate rows on natural key' else 'row count deviation vs 7-day average' end as likely_cause",
        f"cross join ({_stats(EVENT_DAY_GROUPS)}) d",
    ),
    "volume_scorecard_sales": _volume(SALES_COUNTS, ORDER_DAY),
    "volume_single_table": f"""
    select source_table, cast({EVENT_DAY} as varchar) as record_date, current_record_count,
           round(current_record_count - expected_record_count, 4) as diff_record,
           round(expected_record_count, 2) as expected_record_count,
           round(abs(current_record_count - expected_record_count) / expected_record_count, 2) as deviation_ratio,
           case when abs(current_record_count - expected_record_count) / expected_record_count > 0.2
                then 'ALERT' else 'OK' end as status
    from ({_baseline(EVENT_COUNTS, EVENT_DAY)}) where current_record_count is not null""",
    "volume_backfill_events": _backfill([("events", "ts")], "date '2024-01-01'", "date '2024-01-30'"),
    "volume_backfill_sales": _backfill(
        [("orders", "o_orderdate"), ("lineitem", "l_shipdate")], "date '1995-01-01'", "date '2001-12-31'"
    ),
    "duplicate_stats": _stats(_groups("lineitem", LINE_KEY)),
    "duplicate_stats_day": _stats(EVENT_DAY_GROUPS),
    "duplicate_keys": f"select rank, l_orderkey, l_linenumber, row_count "
    f"from ({_worst(_groups('lineitem', LINE_KEY), LINE_KEY)})",
    "duplicate_keys_day": f"select rank, user_id, event_type, row_count from ({_worst(EVENT_DAY_GROUPS, EVENT_KEY)})",
    "duplicate_lines_screened": _groups(
        "lineitem",
        "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_shipdate, l_returnflag, l_linestatus",
    ),
    "duplicate_events_screened": _stats(_groups("events", "user_id, event_type")),
    "duplicate_report": " union all ".join(
        [
            _report_arm("lineitem", _groups("lineitem", LINE_KEY), LINE_KEY, _report_columns("l_orderkey", "l_linenumber")),
            _report_arm("orders", _groups("orders", "o_orderkey"), "o_orderkey", _report_columns("o_orderkey")),
            _report_arm("events", _groups(EVENT_DAYS, EVENT_KEY), EVENT_KEY, _report_columns("user_id", "event_type")),
        ]
    ),
    "side_totals": f"select check_name, c::double as current_value, p::double as previous_value from ({EVENT_TOTALS})",
    "ratio_change": _change(EVENT_TOTALS, "p > 0 and abs(c - p)::double / p::double > 0.1", EVENT_DAY),
    "change_fine_measure": f"""
    with t as (
      select sum(f) filter (where d = {EVENT_DAY}) as c, sum(f) filter (where d = {EVENT_DAY} - 1) as p
      from (select ts::date as d, cast(cast(value as decimal(18,2)) * 0.0000001 as decimal(20,9)) as f from events)
    )
    select 'fine' as check_name, cast(c as decimal(38,9))::varchar as current_value,
           cast(p as decimal(38,9))::varchar as previous_value,
           round(abs(c - p)::double / p::double * 100, 2) as change_pct,
           case when p > 0 and abs(c - p)::double / p::double > 0.1 then 'ALERT' else 'OK' end as status from t""",
    "change_double_measure": f"""
    with t as (
      select count(*) filter (where ts::date = {EVENT_DAY}) as c, count(*) filter (where ts::date = {EVENT_DAY} - 1) as p
      from events
    )
    select 'huge' as check_name, c as n_current, p as n_previous,
           case when abs(c - p) > 0.1 * p then 'ALERT' else 'OK' end as status from t
    union all select 'odd', null, p, 'ALERT' from t""",
    "abs_change": _change(ORDER_TOTALS, "abs(c - p) > 800000", ORDER_DAY),
    "entity_deltas": f"select check_name, entity, current_value::double as current_value, "
    f"previous_value::double as previous_value, delta::double as delta from ({EVENT_SIDES})",
    "top_drivers": f"select check_name, rank, entity, c_name as name, delta::double as delta "
    f"from ({_drivers(EVENT_SIDES)}) left join customer on c_custkey = entity",
    "top_drivers_named": f"select check_name, rank, entity, name, delta::double as delta from ({_drivers(ORDER_SIDES)})",
    "eligible_population": f"select distinct user_id from events where ts::date = {EVENT_DAY} "
    "and event_type in ('view', 'click')",
    "prefix_eligibility": f"""
    with typed as (select l_suppkey, p_type like 'ECON%' as prefixed from lineitem join part on l_partkey = p_partkey
                   where l_shipdate::date = {ORDER_DAY})
    select distinct case when prefixed then 'prefix' else 'other' end as rule, l_suppkey from typed""",
    "refined_eligibility": f"""
    select distinct l_suppkey from lineitem
    where l_shipdate::date = {ORDER_DAY} and l_suppkey in
        (select l_suppkey from lineitem join part on l_partkey = p_partkey where p_type like 'ECON%')""",
    "entity_measure": f"select user_id, sum(value::decimal(18,2))::double as usage_value from events "
    f"where event_type = 'purchase' and ts::date = {EVENT_DAY} - 1 group by user_id",
    "entity_facts": f"select check_name, source_table, cast(check_date as varchar) as check_date, user_id, "
    f"max(usage_value)::double as usage_value, count(*) as matching_rows from ({EVENT_FACTS}) group by all",
    "coverage_scorecard": _coverage(EVENT_FACTS, "user_id"),
    "coverage_alerts": f"""
    select check_name, eligible, with_usage, least(10, missing)::int as sample_size
    from ({_coverage(EVENT_FACTS, "user_id")}) join
         (select check_name, count(distinct user_id) filter (usage_value = 0) as missing from ({EVENT_FACTS})
          group by check_name) using (check_name)
    where status = 'ALERT'""",
    "missing_sample": _sample(EVENT_FACTS, "user_id", True),
    "missing_sample_repeated": _sample(EVENT_FACTS, "user_id", False),
    "contract_not_null": "select event_id, null::varchar as event_type from events where event_type = 'error'",
    "contract_accepted_values": "select event_type, count(*) as n_rows from events "
    "where event_type not in ('click', 'purchase', 'signup', 'view') group by event_type",
    "contract_forbidden": "select event_type, count(*) as n_rows from events "
    "where lower(event_type) like '%err%' group by event_type",
    "contract_report": """
    with e as (select case when event_id % 7 <> 0 then event_type end as event_type from events)
    select 'not_null' as rule, 'event_type' as column_name, count(*) as violations from e where event_type is null
    union all select 'accepted_values', 'event_type', count(*) from e
              where event_type not in ('click', 'purchase', 'signup', 'view')
    union all select 'retired_value', 'event_type', count(*) from e where lower(event_type) like '%err%'""",
    "monitor_scorecard": f"{MONITOR_CARD} select * from card",
    "monitor_alerts": f"{MONITOR_CARD} select * exclude (status) from card where status = 'ALERT'",
    "monitor_report": f"""{MONITOR_CARD}, dups as ({_DUP_STATS})
    select alert_type, issue_type, source_table, alert_date,
           (select count(*) from sample where check_name = issue_type)::int as n_sample_missing_companies,
           (select count(*) from drivers where check_name = issue_type)::int as n_top_drivers,
           case when alert_type = 'volume_anomaly' and issue_type <> 'volume_anomaly_mrt_wtfl_unpivot'
                then least(5, (select duplicate_key_groups from dups where dups.source_table = card.source_table))
                else 0 end::int as n_top_duplicate_keys
    from card where status = 'ALERT' order by alert_type, issue_type""",
    "monitor_contract": f"""{MONITOR_CARD}, fired as (select * from card where status = 'ALERT')
    select 'not_null' as rule, 'alert_type' as column_name, count(*) filter (alert_type is null) as violations from fired
    union all select 'accepted_values', 'alert_type',
                     count(*) filter (alert_type not in ({", ".join(f"'{t}'" for t in V.ALERT_TYPES)})) from fired
    union all select 'retired_value', 'issue_type',
                     count(*) filter (lower(issue_type) like '%' || lower('{V.RETIRED_ISSUE}') || '%') from fired""",
    "monitor_drivers": f"{MONITOR_CARD} select check_name, rank, entity, name, delta::double as delta from drivers",
    "monitor_detail": MONITOR_DETAIL,
    "monitor_detail_lists": _list_members("true"),
    "monitor_detail_constants": MONITOR_CONSTANTS,
    "monitor_variant": f"""{MONITOR_CARD}, key_members as ({_KEY_MEMBERS})
    select issue_type,
           case when alert_type in ('missing_usage_data', 'volume_anomaly') then metric_1::bigint end as n,
           case alert_type when 'missing_usage_data' then 'active_employees' when 'end_bucket_change' then 'end_budget_usd'
                when 'core_employee_count_change' then 'number_of_employees'
                when 'natural_growth_change' then 'natural_growth_budget_usd' end as measure_field,
           case when alert_type = 'missing_usage_data' then (select count(*) from sample where check_name = issue_type)
                when issue_type = 'volume_anomaly_mrt_wtfl_unpivot' then 0
                when alert_type = 'volume_anomaly'
                then (select count(*) from key_members k where k.source_table = card.source_table)
                else (select count(*) from drivers where check_name = issue_type) end::int as listed,
           false as null_field
    from card""",
    "messages_by_day": f"select '2024-01-15' as record_date, message from ({MONITOR_MESSAGES})",
    "volume_counts_from_statistics": """
    select cast(ts::date as varchar) as event_day, count(*) as record_count, min(event_id) as min_event_id,
           max(event_id) as max_event_id
    from events where ts::date between date '2024-01-08' and date '2024-01-15' group by 1""",
    "monitor_volume_alerts": _half_day(f"{MONITOR_CARD} select * exclude (status) from card where status = 'ALERT'"),
    "monitor_volume_report": _half_day(_list_members("status = 'ALERT'")),
    "monitor_volume_messages": _half_day(MONITOR_MESSAGES),
    "monitor_duplicates": f"{DERIVED} {_DUPLICATES}",
    "monitor_duplicates_by_bucket": f"{DERIVED} select s.*, w.rank, w.company_id, w.bucket_name, w.row_count "
    f"from ({_stats(_BUCKET_GROUPS)}) s left join ({_worst(_BUCKET_GROUPS, 'company_id, bucket_name, date_id')}) w on true",
    "monitor_sample": f"{MONITOR_CARD} select check_name, rank, company_id from sample",
    "monitor_messages": MONITOR_MESSAGES,
    "all_clear": f"""
    select 'all_clear' as alert_type, 'all_clear' as issue_type,
           ':white_check_mark: Waterfall monitors — all checks passed for 2024-01-15.' as message
    where not exists (select * from ({_volume(EVENT_COUNTS, EVENT_DAY)}) where status = 'ALERT')""",
    "check_missing_usage_data": f"{MONITOR_CARD} {_DETERMINED}, metric_1::bigint as total_eligible_companies, "
    "metric_2::bigint as companies_with_usage, metric_3 as coverage_pct, status from card "
    "where alert_type = 'missing_usage_data'",
    "check_volume_anomaly": f"{MONITOR_CARD} {_DETERMINED}, metric_1::bigint as current_record_count, "
    "round(base.expected_record_count, 2) as expected_record_count, metric_3 as deviation_pct, "
    "case when metric_3 > 20 then 'ALERT' else 'OK' end as status from card join base using (source_table) "
    "where alert_type = 'volume_anomaly' and issue_type <> 'volume_anomaly_mrt_wtfl_unpivot'",
    f"check_{V.SINGLE_TABLE_ISSUE}": f"{MONITOR_CARD} {_DETERMINED}, metric_1::bigint as current_record_count, "
    "metric_4 as diff_record, metric_2 as expected_record_count, metric_3 as deviation_pct, status from card "
    "where issue_type = 'volume_anomaly_mrt_wtfl_unpivot'",
    **{
        f"check_{name}": f"{MONITOR_CARD} {_DETERMINED}, {columns}, "
        f"case when {_SHOWN_BREACH[name]} then 'ALERT' else 'OK' end as status from card where issue_type = '{name}'"
        for name, columns in _SINGLE_CHANGE.items()
    },
}
