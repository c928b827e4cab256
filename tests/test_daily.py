"""Expected tables and days, results kept by day, and contracts checked while writing."""

from decimal import Decimal

import plans_util as pu
import pytest
from fixture_tables import D, ago

from weirgauge.operators import change, contracts, envelope, presence, volume
from weirgauge.operators.state import DailyState
from weirgauge.sources.daily import read_days, read_text_days, schema_differences, scratch, write_checked, write_day, write_text_day
from weirgauge.sources.statistics import statistics


def counted(spark, per_day):
    rows = [(ago(lag),) for lag, n in per_day.items() for _ in range(n)]
    return volume.DailyTable(spark.createDataFrame(rows, "d date"), "d")


@pytest.fixture
def tables(spark):
    return {"busy": counted(spark, {0: 6, 1: 5}), "silent": counted(spark, {2: 4, 3: 2}), "old": counted(spark, {9: 5})}


def test_outages_name_silent_tables(spark, tables):
    expected = presence.catalogue(spark, {"busy": None, "silent": None, "old": None, "never": None, "later": ago(-1)})
    rows = {r.source_table: r for r in presence.outages(volume.daily_counts(tables, D), expected, D).collect()}
    assert {t: r.status for t, r in rows.items()} == {"silent": "ALERT", "old": "NO_DATA", "never": "NO_DATA"}
    assert (rows["silent"].expected_record_count, rows["silent"].deviation_pct, rows["silent"].last_record_date) == (3.0, 100.0, ago(2))
    card = {r.source_table: r.status for r in volume.volume_scorecard(tables, D, expected=expected).collect()}
    assert card == {"busy": "OK", "silent": "ALERT", "old": "NO_DATA", "never": "NO_DATA"}
    assert [r.source_table for r in volume.volume_scorecard(tables, D).collect()] == ["busy"]  # off by default


def test_outages_read_each_table_once(spark, tables):
    expected = presence.catalogue(spark, dict.fromkeys(tables))
    plan = pu.executed_plan(presence.outages(volume.daily_counts(tables, D), expected, D))
    assert pu.no_pairwise_join(plan)


def test_zero_days_enter_the_average(spark, tables):
    expected = presence.catalogue(spark, {"busy": ago(1), "silent": None})
    counts = presence.zero_filled(volume.daily_counts(tables, D), expected, f"date '{ago(7)}'", f"date '{D}'")
    got = {(r.source_table, r.record_date): r.record_count for r in counts.collect()}
    assert got == {("busy", ago(1)): 5, ("busy", D): 6} | {("silent", ago(i)): {2: 4, 3: 2}.get(i, 0) for i in range(8)}
    rows = {r.source_table: r for r in volume.volume_scorecard(tables, D, expected=expected, zero_days=True).collect()}
    assert rows["silent"].current_record_count == 0 and rows["silent"].status == "ALERT"
    assert rows["silent"].expected_record_count == pytest.approx(6 / 7) and rows["busy"].expected_record_count == 5.0


def test_a_rerun_replaces_its_day_only_even_by_nothing(spark):
    path = scratch(spark, "days")
    frame = lambda *x: spark.createDataFrame([(i,) for i in x], "n long")
    write_day(frame(1, 2), path, ago(1))
    write_day(frame(3), path, D)
    write_day(frame(4), path, D, "n bigint")
    seen = lambda **k: {(r.record_date, r.n) for r in read_days(spark, path, **k).collect()}
    assert seen() == {(ago(1), 1), (ago(1), 2), (D, 4)} and seen(first=D) == {(D, 4)} and seen(last=ago(1)) == {(ago(1), 1), (ago(1), 2)}
    write_day(frame(), path, D)
    assert seen() == {(ago(1), 1), (ago(1), 2)}
    plan = pu.executed_plan(read_days(spark, path, D, D))
    assert "PartitionFilters: [isnotnull(record_date" in plan


def test_published_rows_keep_their_schema(spark):
    right = spark.createDataFrame([], envelope.RECORD_SCHEMA)
    assert schema_differences(right, envelope.RECORD_SCHEMA) == []
    assert schema_differences(right.select(*reversed(right.columns)), envelope.RECORD_SCHEMA) == ["columns are in another order"]
    wrong = right.withColumnRenamed("detail", "details")
    with pytest.raises(ValueError, match="detail string is missing; details string is not expected"):
        write_day(wrong, scratch(spark, "alerts"), D, envelope.RECORD_SCHEMA)


def test_contract_counts_ride_on_the_write(spark):
    rows = spark.createDataFrame([("a",), (None,), ("Old",), ("old x",)], "kind string")
    rules = [contracts.not_null("kind"), contracts.accepted_values("kind", ["a"]), contracts.retired_value("kind", "OLD")]
    path = scratch(spark, "checked")
    made = write_checked(rows, path, D, rules)
    assert sorted(map(tuple, made.collect())) == sorted(map(tuple, contracts.contract_report(rows, rules).collect()))
    assert read_days(spark, path).count() == 4


def test_state_answers_as_the_tables_do(spark):
    rows = [("a", D, 5, 1.5), ("a", ago(1), 3, 1.0), ("b", ago(1), 4, 2.0), (None, D, 1, 0.5), (None, ago(1), 7, None), ("c", D, None, 9.0)]
    source = spark.createDataFrame(rows, "who string, d date, n long, x double")
    tables = {"t": change.PinnedTable(source, ("d",))}
    sides = (change.Side("t"), change.Side("t", 1))
    checks = [change.ChangeCheck("n", *sides, "n", "0.1"), change.ChangeCheck("x", *sides, "x", "0.1", "who <> 'b'")]
    state = DailyState(spark, scratch(spark, "state"))
    for on in (ago(1), D, D, ago(1)):
        state.update_entities(tables, checks, on, "who")
    kept = state.entity_rollup(checks, D)
    whole = change.entity_rollup(tables, checks, D, "who")
    key = lambda df: sorted(map(str, change.entity_deltas(df, checks).drop("null_side").collect()))
    assert key(kept) == key(whole)
    assert sorted(map(str, change.totals(kept, checks).collect())) == sorted(map(str, change.side_totals(tables, checks, D).collect()))


def test_state_reads_the_new_day_only(spark):
    path = scratch(spark, "source")
    for lag in range(3):
        write_day(spark.createDataFrame([(1,)] * (lag + 1), "n long"), path, ago(lag))
    source = {"t": volume.DailyTable(spark.read.parquet(path), "record_date")}
    plan = pu.executed_plan(volume.daily_counts(source, D, 0))
    assert pu.scans(plan) == 1 and "PartitionFilters: [isnotnull(record_date" in plan
    state = DailyState(spark, scratch(spark, "state"))
    for lag in (2, 1, 0, 1):
        state.update_counts(source, ago(lag))
    assert {(r.record_date, r.record_count) for r in state.counts(D).collect()} == {(ago(i), i + 1) for i in range(3)}


def test_checks_of_other_types_change_nothing(spark):
    rows = [(1, D, Decimal("11000000000000000.01"), Decimal(10) ** 33, 1.0), (1, ago(1), Decimal("10000000000000000.00"), Decimal(10) ** 33, 2.0)]
    source = spark.createDataFrame(rows, "who long, d date, fine decimal(20,2), whole decimal(38,0), broken double")
    tables, sides = {"t": change.PinnedTable(source, ("d",))}, (change.Side("t"), change.Side("t", 1))
    every = {c: change.ChangeCheck(c, *sides, c, "0.1") for c in ("fine", "whole", "broken")}
    want = {"fine": "ALERT", "whole": "OK", "broken": "ALERT"}
    for own in (["fine"], ["whole"], ["fine", "broken"], ["fine", "whole"], ["fine", "whole", "broken"]):
        card = change.change_scorecard(tables, [every[c] for c in own], D, "who").collect()
        assert {r.check_name: r.status for r in card} == {c: want[c] for c in own}, own


def test_equal_doubles_are_ranked_by_their_exact_size(spark):
    rows = [(i, D, Decimal(10) ** 20 + i, 0.0) for i in range(8)]
    source = spark.createDataFrame(rows, "who long, d date, fine decimal(30,0), broken double")
    tables, sides = {"t": change.PinnedTable(source, ("d",))}, (change.Side("t"), change.Side("t", 1))
    checks = [change.ChangeCheck("fine", *sides, "fine", "0.1"), change.ChangeCheck("broken", *sides, "broken", "0.1")]
    top = change.top_drivers(tables, checks, D, "who").where("check_name = 'fine'").orderBy("rank").collect()
    assert [r.entity for r in top] == [7, 6, 5, 4, 3]


def test_missing_totals_are_told_apart_on_request(spark):
    source = spark.createDataFrame([(1, ago(1), 5)], "who long, d date, n long")
    tables = {"t": change.PinnedTable(source, ("d",))}
    check = change.ChangeCheck("n", change.Side("t"), change.Side("t", 1), "n", "0.1")
    for asked, status in ((False, "OK"), (True, "NO_DATA")):
        card = change.change_scorecard(tables, [check], D, "who", no_data=asked)
        assert [r.status for r in card.collect()] == [status]
    record = envelope.envelope(card, ("'change'", "check_name", "'t'", "alert_date"), ("current_value",), envelope.detail({"c": "check_name"}))
    assert envelope.alerts(record).count() == 0 and envelope.alerts(record, no_data=True).count() == 1


def test_large_double_differences_do_not_fail_the_detail(spark):
    from weirgauge.functions.expr import plain

    got = spark.sql(f"select {plain('1e37d')} as huge, {plain('1.005d')} as small").first()
    assert got.huge is None and got.small in (Decimal("1.00"), Decimal("1.01"))


def test_texts_by_day(spark):
    path = scratch(spark, "texts")
    frame = lambda *x: spark.createDataFrame([(t,) for t in x], "message string")
    write_text_day(frame("one\nline two", "gone"), "message", path, D)
    write_text_day(frame("one\n\n\nline two"), "message", path, D)
    write_text_day(frame("before"), "message", path, ago(1))
    assert {tuple(r) for r in read_text_days(spark, path).collect()} == {(D, "one\nline two"), (ago(1), "before")}
    assert [r.value for r in read_text_days(spark, path, last=ago(1)).collect()] == ["before"]
    write_text_day(frame(), "message", path, ago(1))
    assert [r.record_date for r in read_text_days(spark, path).collect()] == [D]
    frame("half a day").write.text(f"{path}/record_date={ago(2)}")  # a run that was cut off
    assert [r.record_date for r in read_text_days(spark, path).collect()] == [D]


def test_counts_come_from_footers(spark):
    path = scratch(spark, "counted")
    spark.createDataFrame([(i, ago(i % 3)) for i in range(90)], "n long, d date").write.partitionBy("d").parquet(path)
    made = statistics(spark, path, "d", ago(1), D, ["n"])
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(n), MAX(n)]" in plan and "PushedGroupBy: [d]" in plan
    assert {tuple(r) for r in made.collect()} == {(ago(0), 30, 0, 87), (ago(1), 30, 1, 88)}


def test_null_members_of_a_variant(spark):
    rows = spark.createDataFrame([(1, None)], "a long, b string")
    for keep, want in ((False, False), (True, True)):
        record = rows.selectExpr(f"{envelope.detail({'a': 'a', 'b': 'b'}, keep)} as detail")
        got = envelope.with_variant(record).selectExpr("variant_get(detail, '$.a', 'bigint') as a", "is_variant_null(variant_get(detail, '$.b', 'variant')) as n").first()
        assert got.a == 1 and bool(got.n) is want
