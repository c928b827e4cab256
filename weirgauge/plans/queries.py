"""Named queries over the benchmark tables, one or more per operator."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weirgauge.functions.expr import OK, as_date, date_of, day
from weirgauge.operators import change, contracts, coverage, duplicates, envelope, presence, report, volume
from weirgauge.operators.envelope import METRICS
from weirgauge.operators.state import DailyState
from weirgauge.plans import bindings as B
from weirgauge.plans import fixed_values as V
from weirgauge.sources import publish, read_table
from weirgauge.sources.daily import read_days, read_text_days, scratch, write_checked, write_day, write_text_day
from weirgauge.sources.statistics import statistics

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return B.comparable(function(spark, sf_dir))

    run.__name__, run.__doc__ = function.__name__, function.__doc__
    QUERIES[function.__name__] = run
    return function


# -- volume -----------------------------------------------------------------


@query
def volume_daily_counts(spark, sf_dir):
    """Rows per table and day over the trailing week."""
    return volume.daily_counts(B.counted_sales(spark, sf_dir), B.ORDER_DAY)


@query
def volume_baseline(spark, sf_dir):
    """Trailing mean over the days that have rows."""
    counts = volume.daily_counts(B.counted_sales(spark, sf_dir), B.ORDER_DAY)
    return _shown(volume.trailing_baseline(counts, B.ORDER_DAY))


def _event_duplicates(spark, sf_dir):
    rows = B.event_day_key(B.events(spark, sf_dir))
    spec = duplicates.KeySpec(rows, ("user_id", "event_type", "event_day"), ("user_id", "event_type"), "ts")
    return duplicates.duplicate_report({"events": spec}, B.EVENT_DAY)


def _shown(card, *columns):
    """Doubles rounded to four digits, for comparison across engines."""
    doubles = columns or ("expected_record_count",)
    return card.selectExpr(*[f"round({c}, 4) as {c}" if c in doubles else c for c in card.columns])


@query
def volume_scorecard(spark, sf_dir):
    """Event volume with duplicate diagnostics and likely cause."""
    card = volume.volume_scorecard(
        B.counted_events(spark, sf_dir), B.EVENT_DAY, duplicates=_event_duplicates(spark, sf_dir)
    )
    return _shown(card).drop("top_duplicate_keys")


@query
def volume_scorecard_sales(spark, sf_dir):
    """Two tables in one pass; some days have no rows."""
    return _shown(volume.volume_scorecard(B.counted_sales(spark, sf_dir), B.ORDER_DAY))


@query
def volume_single_table(spark, sf_dir):
    table = B.counted_events(spark, sf_dir)["events"]
    card = volume.volume_scorecard_single(table, "events", B.EVENT_DAY)
    return _shown(card, "diff_record")


@query
def volume_backfill_events(spark, sf_dir):
    """The check for each of the thirty days of events."""
    return _shown(volume.volume_backfill(B.counted_events(spark, sf_dir), "2024-01-01", "2024-01-30"))


@query
def volume_backfill_sales(spark, sf_dir):
    """The check for every day of the whole order and shipment history."""
    return _shown(volume.volume_backfill(B.counted_sales(spark, sf_dir), "1995-01-01", "2001-12-31"))


# -- expected tables and days ---------------------------------------------------


def _expected(spark):
    return presence.catalogue(spark, {"orders": None, "lineitem": None, "returns": None, "refunds": B.FAR_DAY})


@query
def volume_outages(spark, sf_dir):
    """Expected tables without rows on a day: one that had some in the week before, one that never had any."""
    counts = volume.daily_counts(B.counted_sales(spark, sf_dir), B.OUTAGE_DAY)
    return _shown(presence.outages(counts, _expected(spark), B.OUTAGE_DAY))


@query
def volume_scorecard_expected(spark, sf_dir):
    """The scorecard with a row for expected tables that are silent today."""
    return _shown(volume.volume_scorecard(B.counted_sales(spark, sf_dir), B.OUTAGE_DAY, expected=_expected(spark)))


@query
def volume_scorecard_zero_days(spark, sf_dir):
    """Days without rows count as zero, today and in the average."""
    tables = B.counted_sales(spark, sf_dir)
    expected = presence.catalogue(spark, dict.fromkeys(tables))
    return _shown(volume.volume_scorecard(tables, B.OUTAGE_DAY, expected=expected, zero_days=True))


@query
def volume_backfill_zero_days(spark, sf_dir):
    """The check for every day of the history, with zero for the days without rows."""
    tables = B.counted_sales(spark, sf_dir)
    expected = presence.catalogue(spark, {"orders": None, "lineitem": "1996-01-10"})
    return _shown(volume.volume_backfill(tables, "1995-01-01", "2001-12-31", expected=expected))


# -- kept by day -----------------------------------------------------------------


@query
def state_volume_baseline(spark, sf_dir):
    """Trailing mean from counts that were kept day by day, one of them twice."""
    state = DailyState(spark, scratch(spark, "state"))
    last = as_date(B.ORDER_DAY)
    for lag in (7, 6, 5, 4, 3, 2, 1, 0, 3):
        state.update_counts(B.counted_sales(spark, sf_dir), last - dt.timedelta(days=lag))
    return _shown(volume.trailing_baseline(state.counts(last), last))


@query
def state_entity_deltas(spark, sf_dir):
    """Changes by user from two kept days, the second of them written again."""
    checks, state = [B.EVENT_CHANGE, B.PURCHASE_CHANGE], DailyState(spark, scratch(spark, "state"))
    last = as_date(B.EVENT_DAY)
    for lag in (1, 0, 0):
        state.update_entities(B.pinned_events(spark, sf_dir), checks, last - dt.timedelta(days=lag), "user_id")
    return change.entity_deltas(state.entity_rollup(checks, last), checks).select(
        "check_name", "entity", "current_value", "previous_value", "delta"
    )


@query
def published_history(spark, sf_dir):
    """Alerts of three days in one table, the second published twice; read back with their day."""
    path = scratch(spark, "alerts")
    check = change.ChangeCheck(
        "event_value", change.Side("events"), change.Side("events", 1), "amount", "0.02"
    )
    for as_of in B.PUBLISHED_DAYS:
        card = change.change_scorecard(B.pinned_events(spark, sf_dir), [check], as_of, "user_id")
        record = envelope.envelope(
            card,
            ("'change'", "check_name", "'events'", "alert_date"),
            ("cast(current_value as double)", "cast(previous_value as double)", "change_pct"),
            envelope.detail({"check": "check_name"}),
        )
        write_day(envelope.alerts(record), path, as_of, envelope.RECORD_SCHEMA)
    return read_days(spark, path)


@query
def contract_on_write(spark, sf_dir):
    """Violations counted on the rows while they are written."""
    rows = B.events(spark, sf_dir).selectExpr("event_id", "case when event_id % 7 <> 0 then event_type end as event_type")
    rules = [
        contracts.not_null("event_type"),
        contracts.accepted_values("event_type", [t for t in B.EVENT_TYPES if t != "error"]),
        contracts.retired_value("event_type", "ERR"),
    ]
    return write_checked(rows, scratch(spark, "checked"), B.EVENT_DAY, rules, "event_id bigint, event_type string")


# -- duplicates -----------------------------------------------------------------

ON_EVENT_DAY = f"{date_of('ts')} = {day(B.EVENT_DAY)}"
LINE_KEY = ("l_orderkey", "l_linenumber")


@query
def duplicate_stats(spark, sf_dir):
    """Duplicated line keys of the whole table."""
    return duplicates.duplicate_stats(duplicates.duplicate_groups(B.lineitem(spark, sf_dir), LINE_KEY))


@query
def duplicate_stats_day(spark, sf_dir):
    rows = B.event_day_key(B.events(spark, sf_dir)).where(ON_EVENT_DAY)
    return duplicates.duplicate_stats(duplicates.duplicate_groups(rows, ("user_id", "event_type", "event_day")))


@query
def duplicate_keys(spark, sf_dir):
    """The five worst line keys of the whole table."""
    groups = duplicates.duplicate_groups(B.lineitem(spark, sf_dir), LINE_KEY)
    return duplicates.top_duplicates(groups, LINE_KEY, LINE_KEY)


@query
def duplicate_keys_day(spark, sf_dir):
    """Grouped by user, type and day; only user and type are shown."""
    rows = B.event_day_key(B.events(spark, sf_dir)).where(ON_EVENT_DAY)
    keys = ("user_id", "event_type", "event_day")
    return duplicates.top_duplicates(duplicates.duplicate_groups(rows, keys), keys, ("user_id", "event_type"))


WIDE_KEY = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate", "l_returnflag", "l_linestatus")


@query
def duplicate_lines_screened(spark, sf_dir):
    """Lines of the whole table that agree in part, supplier, amounts, day and flags; unique ones are not exchanged."""
    return duplicates.screened_groups(B.lineitem(spark, sf_dir), WIDE_KEY)


@query
def duplicate_events_screened(spark, sf_dir):
    """Statistics of user and type over the whole table, where most keys repeat."""
    groups = duplicates.screened_groups(B.events(spark, sf_dir), ("user_id", "event_type"))
    return duplicates.duplicate_stats(groups)


@query
def duplicate_report(spark, sf_dir):
    """Statistics and worst keys of three whole tables, keys as rows."""
    specs = {
        "lineitem": duplicates.KeySpec(B.lineitem(spark, sf_dir), LINE_KEY, LINE_KEY),
        "orders": duplicates.KeySpec(B.orders(spark, sf_dir), ("o_orderkey",), ("o_orderkey",)),
        "events": duplicates.KeySpec(
            B.event_day_key(B.events(spark, sf_dir)),
            ("user_id", "event_type", "event_day"),
            ("user_id", "event_type"),
        ),
    }
    return _key_rows(duplicates.duplicate_report(specs)).selectExpr(
        "source_table", "duplicate_key_groups", "extra_duplicate_rows", "pos + 1 as rank", "k.*"
    )


def _key_rows(table):
    return table.selectExpr("*", "posexplode_outer(top_duplicate_keys) as (pos, k)")


# -- change -----------------------------------------------------------------------


@query
def side_totals(spark, sf_dir):
    """Totals of two days and two predicates from one scan."""
    checks = [B.EVENT_CHANGE, B.PURCHASE_CHANGE]
    return change.side_totals(B.pinned_events(spark, sf_dir), checks, B.EVENT_DAY)


@query
def ratio_change(spark, sf_dir):
    checks = [B.EVENT_CHANGE, B.PURCHASE_CHANGE]
    return change.change_scorecard(B.pinned_events(spark, sf_dir), checks, B.EVENT_DAY, "user_id").drop("top_drivers")


@query
def change_fine_measure(spark, sf_dir):
    """A measure with nine digits after the point: totals keep all of them (compared as text)."""
    rows = B.events(spark, sf_dir).selectExpr("*", "cast(amount * 0.0000001 as decimal(20,9)) as fine")
    check = change.ChangeCheck("fine", change.Side("events"), change.Side("events", 1), "fine", "0.1")
    tables = {"events": change.PinnedTable(rows, ("ts",))}
    card = change.change_scorecard(tables, [check], B.EVENT_DAY, "user_id")
    shown = [f"cast(cast({c} as decimal(38,9)) as string) as {c}" for c in ("current_value", "previous_value")]
    return card.selectExpr("check_name", *shown, "change_pct", "status")


@query
def change_double_measure(spark, sf_dir):
    """Totals beyond any decimal, and one that is not a number, which counts as a breach."""
    rows = B.events(spark, sf_dir).selectExpr(
        "ts", "user_id", "1e36d as huge", f"if({ON_EVENT_DAY}, double('NaN'), 1d) as odd"
    )
    sides = (change.Side("events"), change.Side("events", 1))
    checks = [change.ChangeCheck("huge", *sides, "huge", "0.1"), change.ChangeCheck("odd", *sides, "odd", "0.1")]
    card = change.change_scorecard({"events": change.PinnedTable(rows, ("ts",))}, checks, B.EVENT_DAY, "user_id")
    rows_of = "cast(round({} / 1e36d) as bigint) as n_{}"
    return card.where("check_name = 'huge'").selectExpr(
        "check_name", rows_of.format("current_value", "current"), rows_of.format("previous_value", "previous"), "status"
    ).unionByName(
        card.where("check_name = 'odd'").selectExpr(
            "check_name", "cast(null as bigint) as n_current", "cast(previous_value as bigint) as n_previous", "status"
        )
    )


@query
def change_mixed_measures(spark, sf_dir):
    """Checks of different types together, each tested in its own: decimals of seventeen digits, whole numbers beyond 32
    digits, and doubles."""
    rows = B.events(spark, sf_dir).selectExpr(
        "ts",
        "user_id",
        f"cast(if(event_id = 0, 11000000000000000.01, if({ON_EVENT_DAY}, 0, 0)) as decimal(20,2)) as fine",
        "cast(1e30 as decimal(38,0)) as whole",
        "value as broken",
    )
    today = rows.selectExpr("cast(timestamp_ntz '2024-03-02 00:00:00' as timestamp_ntz) as ts", "user_id", "fine", "whole", "broken")
    before = rows.selectExpr(
        "cast(timestamp_ntz '2024-03-01 00:00:00' as timestamp_ntz) as ts",
        "user_id",
        "cast(if(fine > 0, 10000000000000000.00, 0) as decimal(20,2)) as fine",
        "whole",
        "broken / 2 as broken",
    )
    sides = (change.Side("t"), change.Side("t", 1))
    checks = [change.ChangeCheck(c, *sides, c, "0.1") for c in ("fine", "whole", "broken")]
    tables = {"t": change.PinnedTable(today.unionByName(before), ("ts",))}
    card = change.change_scorecard(tables, checks, "2024-03-02", "user_id")
    return card.selectExpr("check_name", "round(change_pct, 1) as change_pct", "size(top_drivers) as n_drivers", "status")


@query
def change_no_data(spark, sf_dir):
    """A day after the last event: no total to compare, which is told from OK."""
    checks = [B.EVENT_CHANGE, B.PURCHASE_CHANGE]
    card = change.change_scorecard(B.pinned_events(spark, sf_dir), checks, B.SILENT_DAY, "user_id", no_data=True)
    return card.select("check_name", "current_value", "previous_value", "status")


@query
def abs_change(spark, sf_dir):
    """Absolute test; a day without rows gives missing totals and no alert."""
    card = change.change_scorecard(B.pinned_orders(spark, sf_dir), [B.ORDER_CHANGE], B.ORDER_DAY, "o_custkey")
    return card.drop("top_drivers")


@query
def entity_deltas(spark, sf_dir):
    """Signed change of every user present on either day."""
    checks = [B.EVENT_CHANGE, B.PURCHASE_CHANGE]
    rollup = change.entity_rollup(B.pinned_events(spark, sf_dir), checks, B.EVENT_DAY, "user_id")
    return change.entity_deltas(rollup, checks).select(
        "check_name", "entity", "current_value", "previous_value", "delta"
    )


@query
def top_drivers(spark, sf_dir):
    """Five users with the largest change per check, names from the customer table."""
    drivers = change.top_drivers(
        B.pinned_events(spark, sf_dir), [B.EVENT_CHANGE, B.PURCHASE_CHANGE], B.EVENT_DAY, "user_id"
    )
    return change.label_drivers(drivers, read_table(spark, "customer", sf_dir), "c_custkey", "c_name")


@query
def top_drivers_named(spark, sf_dir):
    """Names carried by the table itself, looked up for the winners only."""
    return change.top_drivers(
        B.pinned_orders(spark, sf_dir), [B.ORDER_CHANGE], B.ORDER_DAY, "o_custkey", "o_orderpriority"
    )


# -- coverage -----------------------------------------------------------------------


@query
def eligible_population(spark, sf_dir):
    return coverage.eligible(B.events(spark, sf_dir), "user_id", B.EVENT_COVERAGE.member, "ts", B.EVENT_DAY)


@query
def prefix_eligibility(spark, sf_dir):
    """Suppliers shipping on the day, by the type prefix of their parts; both prefixes in one pass."""
    today = B.lineitem(spark, sf_dir).where(f"{date_of('l_shipdate')} = {day(B.ORDER_DAY)}")
    part = read_table(spark, "part", sf_dir).selectExpr("p_partkey as l_partkey", "p_type")
    rules = {"prefix": "p_type like 'ECON%'", "other": "p_type not like 'ECON%'"}
    return coverage.refine_each(today.join(part, "l_partkey"), "l_suppkey", rules)


@query
def refined_eligibility(spark, sf_dir):
    """Suppliers shipping on the day that also shipped a part of the prefix on any day."""
    rows = B.lineitem(spark, sf_dir)
    part = read_table(spark, "part", sf_dir).selectExpr("p_partkey as l_partkey", "p_type")
    suppliers = coverage.eligible(rows, "l_suppkey", "true", "l_shipdate", B.ORDER_DAY)
    return coverage.refine(suppliers, rows.join(part, "l_partkey"), "l_suppkey", "p_type like 'ECON%'")


@query
def entity_measure(spark, sf_dir):
    return coverage.measure(
        B.events(spark, sf_dir), "user_id", "amount", "event_type = 'purchase'", "ts", B.EVENT_DAY, lag=1
    )


def _facts(spark, sf_dir):
    rows = B.events(spark, sf_dir)
    return coverage.entity_facts(rows, rows, B.EVENT_COVERAGE, B.EVENT_DAY)


@query
def entity_facts(spark, sf_dir):
    return _facts(spark, sf_dir)


@query
def coverage_scorecard(spark, sf_dir):
    return coverage.coverage_scorecard(_facts(spark, sf_dir), "user_id").drop("sample_missing")


@query
def coverage_alerts(spark, sf_dir):
    card = coverage.coverage_scorecard(_facts(spark, sf_dir), "user_id").where("status = 'ALERT'")
    return card.selectExpr("check_name", "eligible", "with_usage", "size(sample_missing) as sample_size")


@query
def missing_sample(spark, sf_dir):
    return coverage.missing_sample_rows(_facts(spark, sf_dir), "user_id")


@query
def missing_sample_repeated(spark, sf_dir):
    """The sample with an entity listed once per matching row."""
    return coverage.missing_sample_rows(_facts(spark, sf_dir), "user_id", dedupe=False)


# -- contracts ------------------------------------------------------------------------

WITHOUT_ERROR = tuple(t for t in B.EVENT_TYPES if t != "error")


@query
def contract_not_null(spark, sf_dir):
    """The events whose type is missing once errors count as missing."""
    rows = B.events(spark, sf_dir).selectExpr("event_id", "nullif(event_type, 'error') as event_type")
    return contracts.expect_not_null(rows, "event_type")


@query
def contract_accepted_values(spark, sf_dir):
    return contracts.expect_in(B.events(spark, sf_dir), "event_type", WITHOUT_ERROR)


@query
def contract_forbidden(spark, sf_dir):
    return contracts.expect_absent(B.events(spark, sf_dir), "event_type", "ERR")


@query
def contract_report(spark, sf_dir):
    rules = [
        contracts.not_null("event_type"),
        contracts.accepted_values("event_type", WITHOUT_ERROR),
        contracts.retired_value("event_type", "err"),
    ]
    rows = B.events(spark, sf_dir).selectExpr("if(event_id % 7 = 0, null, event_type) as event_type")
    return contracts.contract_report(rows, rules)


# -- the revenue monitor -----------------------------------------------------------------


def _rounded(card):
    return _shown(card.drop("detail"), *METRICS)


@query
def monitor_scorecard(spark, sf_dir):
    """All ten checks of the monitor, breached or not."""
    return _rounded(B.revenue_monitor(spark, sf_dir).scorecard())


@query
def monitor_alerts(spark, sf_dir):
    """The alert union, published under a name and read back through it."""
    view = B.revenue_monitor(spark, sf_dir).publish(f"weirgauge_alerts_{uuid.uuid4().hex}")
    return _rounded(view)


@query
def monitor_report(spark, sf_dir):
    """The ordered report; of the detail, the size of its lists."""
    table = B.revenue_monitor(spark, sf_dir).report()
    sizes = [
        f"coalesce(json_array_length(get_json_object(detail, '$.{member}')), 0) as n_{member}"
        for member in ("sample_missing_companies", "top_drivers", "top_duplicate_keys")
    ]
    return table.selectExpr("alert_type", "issue_type", "source_table", "alert_date", *sizes)


@query
def monitor_contract(spark, sf_dir):
    monitor = B.revenue_monitor(spark, sf_dir)
    return monitor.contract(monitor.alerts())


@query
def monitor_drivers(spark, sf_dir):
    """Drivers of the three change checks as rows."""
    card = B.revenue_monitor(spark, sf_dir).change_card()
    return card.selectExpr("check_name", "posexplode(top_drivers) as (pos, d)").selectExpr(
        "check_name", "pos + 1 as rank", "d.entity", "d.name", "d.delta"
    )


@query
def monitor_detail(spark, sf_dir):
    """Scalar members of the JSON detail of every check, as rows of text."""
    card = B.revenue_monitor(spark, sf_dir).scorecard()
    counts = ("total_eligible_companies", "companies_with_usage", "threshold_pct", "current_employee_count",
              "previous_employee_count", "current_record_count", "duplicate_key_groups", "extra_duplicate_rows")
    amounts = ("current_value", "previous_value", "prev_day_natural_growth", "two_days_ago_natural_growth")
    texts = ("likely_cause", "measure_field", "date")
    kinds = {**dict.fromkeys(counts, "bigint"), **dict.fromkeys(amounts, "decimal(38,2)"), **dict.fromkeys(texts, "string")}
    schema = ", ".join(f"{member} {kind}" for member, kind in kinds.items())
    pairs = ", ".join(f"struct('{member}' as member, cast(d.{member} as string) as content)" for member in kinds)
    parsed = card.selectExpr("issue_type", f"from_json(detail, '{schema}') as d")
    return parsed.selectExpr("issue_type", f"inline(array({pairs}))").where("content is not null")


def _list_rows(card):
    """Members of the lists in the JSON detail, as rows in their order."""
    lists = ("sample_missing_companies", "top_drivers", "top_duplicate_keys")
    parsed = [f"from_json(get_json_object(detail, '$.{m}'), 'array<map<string,string>>') as {m}" for m in lists]
    packed = ", ".join(f"transform({m}, (x, i) -> struct('{m}' as member, i + 1 as rank, x as item))" for m in lists)
    rows = card.selectExpr("issue_type", *parsed).selectExpr("issue_type", f"inline(flatten(array_compact(array({packed}))))")
    deltas = "map_values(map_filter(item, (k, v) -> startswith(k, 'delta_')))"
    return rows.selectExpr(
        "issue_type",
        "member",
        "rank",
        "item['company_id'] as company_id",
        "item['account_name'] as account_name",
        f"cast(get({deltas}, 0) as double) as delta",
        "cast(item['row_count'] as bigint) as row_count",
    )


@query
def monitor_detail_lists(spark, sf_dir):
    """Members of the sample, driver and key lists of every check."""
    return _list_rows(B.revenue_monitor(spark, sf_dir).scorecard())


@query
def monitor_detail_constants(spark, sf_dir):
    """Percentages and fixed members of the JSON detail, as rows of text."""
    card = B.revenue_monitor(spark, sf_dir, detail_constants={V.VOLUME: {"field": "all rows"}}).scorecard()
    members = ("coverage_pct", "expected_record_count", "deviation_pct", "diff_record", "table", "source_table", "field", "status")
    pairs = ", ".join(f"struct('{m}' as member, get_json_object(detail, '$.{m}') as content)" for m in members)
    figures = "('coverage_pct', 'expected_record_count', 'deviation_pct', 'diff_record')"
    rows = card.selectExpr("issue_type", f"inline(array({pairs}))").where("content is not null")
    return rows.selectExpr(
        "issue_type",
        "member",
        f"case when member in {figures} then cast(round(cast(content as double), 2) as string) else content end as content",
    ).where("issue_type not in ('end_bucket_change', 'core_employee_count_change', 'natural_growth_change')")


@query
def monitor_variant(spark, sf_dir):
    """Members of the details as variants: a number, a text, the length of a list, and whether a member is null."""
    card = B.revenue_monitor(spark, sf_dir, null_members=True).scorecard()
    numbers = ("total_eligible_companies", "current_record_count")
    lists = ("sample_missing_companies", "top_drivers", "top_duplicate_keys")
    number_of = ", ".join(f"try_variant_get(detail, '$.{m}', 'bigint')" for m in numbers)
    length_of = ", ".join(f"size(try_variant_get(detail, '$.{m}', 'array<variant>'))" for m in lists)
    return envelope.with_variant(card).selectExpr(
        "issue_type",
        f"coalesce({number_of}) as n",
        "try_variant_get(detail, '$.measure_field', 'string') as measure_field",
        f"coalesce({length_of}, 0) as listed",
        "coalesce(is_variant_null(try_variant_get(detail, '$.top_duplicate_keys[0].field', 'variant')), false) as null_field",
    )


@query
def messages_by_day(spark, sf_dir):
    """Messages as text files by day, one day written twice, read back for that day."""
    path = scratch(spark, "messages")
    messages = B.revenue_monitor(spark, sf_dir).messages()
    write_text_day(messages.limit(1), "message", path, B.PUBLISHED_DAYS[0])
    for _ in range(2):
        write_text_day(messages, "message", path, B.EVENT_DAY)
    return read_text_days(spark, path, B.EVENT_DAY, B.EVENT_DAY).withColumnRenamed("value", "message")


@query
def volume_counts_from_statistics(spark, sf_dir):
    """Daily counts and extremes of events partitioned by day, from the files' footers."""
    path = scratch(spark, "events")
    rows = read_table(spark, "events", sf_dir).selectExpr("event_id", "user_id", "cast(ts as date) as event_day")
    rows.repartition("event_day").write.partitionBy("event_day").parquet(path)
    return statistics(spark, path, "event_day", "2024-01-08", "2024-01-15", ["event_id"])


@query
def monitor_volume_alerts(spark, sf_dir):
    """The alert union after a load that stopped at noon: the volume arms fire."""
    return _rounded(B.revenue_monitor(spark, sf_dir, loaded=B.HALF_DAY).alerts())


@query
def monitor_volume_report(spark, sf_dir):
    """The list members of the alerts of that day."""
    return _list_rows(B.revenue_monitor(spark, sf_dir, loaded=B.HALF_DAY).alerts())


@query
def monitor_volume_messages(spark, sf_dir):
    """Messages of that day, among them both volume templates."""
    return B.revenue_monitor(spark, sf_dir, loaded=B.HALF_DAY).messages()


@query
def monitor_duplicates(spark, sf_dir):
    """Duplicate diagnostics of the four tables, worst keys as rows."""
    return _key_rows(B.revenue_monitor(spark, sf_dir).duplicate_card()).selectExpr(
        "source_table as checked_table",
        "duplicate_key_groups",
        "extra_duplicate_rows",
        "pos + 1 as rank",
        "k.company_id",
        "k.product_code",
        "k.source_table as usage_source",
        "k.row_count",
    )


@query
def monitor_duplicates_by_bucket(spark, sf_dir):
    """The bucket table checked on its other natural key."""
    monitor = B.revenue_monitor(spark, sf_dir, bucket_keys=V.BUCKET_KEYS_BY_NAME)
    return _key_rows(monitor.duplicate_card([V.BUCKETS])).selectExpr(
        "duplicate_key_groups",
        "extra_duplicate_rows",
        "pos + 1 as rank",
        "k.company_id",
        "k.bucket_name",
        "k.row_count",
    )


@query
def monitor_sample(spark, sf_dir):
    """Companies without usage per coverage sub-check, as rows."""
    card = B.revenue_monitor(spark, sf_dir).coverage_card()
    return card.selectExpr("check_name", "posexplode(sample_missing) as (pos, c)").selectExpr(
        "check_name", "pos + 1 as rank", "c.company_id"
    )


@query
def monitor_messages(spark, sf_dir):
    """The text message of every alert."""
    return B.revenue_monitor(spark, sf_dir).messages()


@query
def all_clear(spark, sf_dir):
    """One row exactly when the event volume check raised nothing."""
    card = volume.volume_scorecard(B.counted_events(spark, sf_dir), B.EVENT_DAY)
    return report.all_clear(card.where(f"status <> '{OK}'"), B.EVENT_DAY, V.ALL_CLEAR)


def _check(name: str) -> None:
    def run(spark, sf_dir):
        frame = B.revenue_monitor(spark, sf_dir).check(name).drop("detail")
        if "diff_record" in frame.columns:
            frame = _shown(frame, "diff_record")
        return frame

    run.__name__ = f"check_{name}"
    run.__doc__ = "A single check under its own column names."
    query(run)


for _name in (*V.ALERT_TYPES, V.SINGLE_TABLE_ISSUE):
    _check(_name)
