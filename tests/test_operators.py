"""Single operators on hand-made frames."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from fixture_tables import D, ago

from weirgauge.functions.expr import as_date, exceeds_ratio, percent
from weirgauge.operators import change, contracts, coverage, duplicates, envelope, report, volume
from weirgauge.plans import fixed_values as V
from weirgauge.sources import publish, read_published, read_table, write_messages


def counted(spark, per_day):
    """A table with the given number of rows per lag."""
    rows = [(ago(lag),) for lag, n in per_day.items() for _ in range(n)]
    return volume.DailyTable(spark.createDataFrame(rows, "d date"), "d")


# -- volume -----------------------------------------------------------------


def test_daily_counts_cover_eight_days_and_skip_empty_ones(spark):
    table = counted(spark, {0: 3, 2: 1, 7: 2, 8: 5})
    rows = volume.daily_counts({"t": table}, D).collect()
    assert {(r["record_date"], r["record_count"]) for r in rows} == {(D, 3), (ago(2), 1), (ago(7), 2)}


def test_baseline_averages_days_present(spark):
    base = volume.trailing_baseline(volume.daily_counts({"t": counted(spark, {0: 4, 1: 6, 3: 2, 6: 1})}, D), D)
    row = base.collect()[0]
    assert (row["current_record_count"], row["baseline_rows"], row["baseline_days"]) == (4, 9, 3)
    assert row["expected_record_count"] == 3.0


@pytest.mark.parametrize(
    ("per_day", "status"),
    [
        ({0: 6, 1: 5}, "OK"),  # exactly twenty percent up
        ({0: 4, 1: 5}, "OK"),  # and down
        ({0: 2, 1: 1, 2: 2, 3: 2}, "OK"),  # 2 against 5/3: exactly twenty percent of an inexact mean
        ({0: 7, 1: 5}, "ALERT"),
        ({0: 3, 1: 5}, "ALERT"),
    ],
)
def test_volume_boundary(spark, per_day, status):
    assert volume.volume_scorecard({"t": counted(spark, per_day)}, D).collect()[0]["status"] == status


def test_table_without_today_or_without_history_has_no_row(spark):
    tables = {"silent": counted(spark, {1: 5}), "new": counted(spark, {0: 5})}
    assert volume.volume_scorecard(tables, D).collect() == []


def test_single_table_reports_signed_difference(spark):
    row = volume.volume_scorecard_single(counted(spark, {0: 3, 1: 5}), "t", D).collect()[0]
    assert (row["diff_record"], row["deviation_ratio"], row["status"]) == (-2.0, 0.4, "ALERT")


def test_backfill_agrees_with_daily_runs(spark):
    per_day = {0: 9, 1: 4, 2: 4, 4: 5, 9: 7, 10: 3, 16: 2}
    table = {"t": counted(spark, per_day)}
    rows = {r["record_date"]: r for r in volume.volume_backfill(table, ago(16), D).collect()}
    assert set(rows) == {ago(lag) for lag in per_day}
    for lag in per_day:
        single = volume.volume_scorecard(table, ago(lag)).collect()
        got = rows[ago(lag)]
        if single:
            assert single[0].asDict() == got.asDict()
        else:
            assert (got["expected_record_count"], got["status"]) == (None, "OK")


# -- duplicates -----------------------------------------------------------------


def test_duplicate_stats_and_ties(spark):
    rows = [("b", 1)] * 3 + [("a", 2)] * 3 + [("c", 1)] * 2 + [("d", 1)] + [(None, 1)] * 3
    df = spark.createDataFrame(rows, "k string, x int")
    groups = duplicates.duplicate_groups(df, ("k", "x"))
    assert duplicates.duplicate_stats(groups).collect()[0].asDict() == {
        "duplicate_key_groups": 4,
        "extra_duplicate_rows": 7,
    }
    top = duplicates.top_duplicates(groups, ("k", "x"), ("k",), n=3).collect()
    assert [tuple(r) for r in top] == [(1, "a", 3), (2, "b", 3), (3, None, 3)]


@pytest.mark.parametrize(("cells", "most"), [(None, 1 << 20), (7, 1 << 20), (7, 3), (1000, 1 << 20)])
def test_screened_groups_equal_the_groups(spark, cells, most):
    r = random.Random(5)
    rows = [(r.choice([None, "", "k", f"k{r.randrange(300)}"]), r.choice([None, 0.0, -0.0, float("nan"), r.random()]), 1) for _ in range(600)]
    df = spark.createDataFrame(rows, "`a b` string, x double, cell int").repartition(4)
    keys = ("a b", "x")
    want = sorted(map(str, duplicates.duplicate_groups(df, keys).collect()))
    assert want and sorted(map(str, duplicates.screened_groups(df, keys, cells, most).collect())) == want
    assert duplicates.screened_groups(df.limit(0), keys).count() == 0


def test_no_duplicates_give_zero_and_an_empty_array(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    row = duplicates.duplicate_report({"t": duplicates.KeySpec(df, ("k",), ("k",))}).collect()[0]
    assert (row["duplicate_key_groups"], row["extra_duplicate_rows"], row["top_duplicate_keys"]) == (0, 0, [])


def test_surplus_is_rows_minus_distinct_keys(spark):
    df = spark.range(1000).selectExpr("id * id % 37 as k", "id % 3 as x")
    stats = duplicates.duplicate_stats(duplicates.duplicate_groups(df, ("k", "x"))).collect()[0]
    assert stats["extra_duplicate_rows"] == 1000 - df.distinct().count()


# -- coverage -----------------------------------------------------------------------

SPEC = coverage.CoverageSpec(
    checks=[coverage.CoverageCheck("all", "s"), coverage.CoverageCheck("flagged", "s", "flag = 'y'", lag=1)],
    key="k",
    rows="active",
    member="good",
    population_date="d",
    source="src",
    value="v",
    measure_date="d",
)


def population(spark):
    rows = [
        ("a", D, True, True, "n"),
        ("a", D, True, False, "y"),  # the flag sits on a row that is not a member row
        ("b", D, True, True, None),
        ("c", D, False, True, "y"),
        ("d", ago(1), True, True, "y"),
        (None, D, True, True, "y"),
        ("e", D, True, False, "y"),
    ]
    return spark.createDataFrame(rows, "k string, d date, active boolean, good boolean, flag string")


def usage(spark):
    rows = [("a", D, "s", 2), ("a", D, "s", None), ("b", D, "other", 5), ("a", ago(1), "s", 0), ("e", D, "s", 1)]
    return spark.createDataFrame(rows, "k string, d date, src string, v bigint")


def test_facts_equal_the_composed_building_blocks(spark):
    pop, use = population(spark), usage(spark)
    facts = {(r["check_name"], r["k"]): r["usage_value"] for r in coverage.entity_facts(pop, use, SPEC, D).collect()}
    base = coverage.eligible(pop, "k", f"{SPEC.rows} and {SPEC.member}", "d", D)
    assert {r["k"] for r in base.collect()} == {"a", "b", None}
    composed = {}
    for c in SPEC.checks:
        chosen = coverage.refine(base, pop.where(f"d = date '{D}' and {SPEC.rows}"), "k", c.extra)
        sums = coverage.measure(use, "k", "v", f"src = '{c.source}'", "d", D, c.lag)
        for r in chosen.join(sums, "k", "left").collect():
            composed[c.name, r["k"]] = r["usage_value"] or 0
    assert facts == composed == {("all", "a"): 2, ("all", "b"): 0, ("flagged", "a"): 0}


def test_half_covered_is_not_an_alert(spark):
    card = {r["check_name"]: r for r in coverage.coverage_scorecard(
        coverage.entity_facts(population(spark), usage(spark), SPEC, D), "k").collect()}
    assert (card["all"]["coverage_pct"], card["all"]["status"]) == (50.0, "OK")
    assert (card["flagged"]["coverage_pct"], card["flagged"]["status"]) == (0.0, "ALERT")
    assert [r["k"] for r in card["all"]["sample_missing"]] == ["b"]
    assert card["flagged"]["check_date"] == ago(1)


# -- change -----------------------------------------------------------------------


def sides(spark, rows):
    rows = [(k, d, None if m is None else Decimal(m), kind) for k, d, m, kind in rows]
    table = spark.createDataFrame(rows, "k bigint, d date, m decimal(18,2), kind string")
    return {"t": change.PinnedTable(table, ("d",))}


CHECK = change.ChangeCheck("c", change.Side("t"), change.Side("t", 1), "m", "0.10")
KIND_X = change.ChangeCheck("x", change.Side("t"), change.Side("t", 1), "m", "0.10", "kind = 'x'")


def test_deltas_sum_to_the_total_change(spark):
    rows = [(k, ago(k % 3), k * 7 % 50, "x" if k % 2 else None) for k in range(60)]
    rows += [(k % 9, ago(k % 2), k, "x") for k in range(40)]
    tables = sides(spark, rows)
    deltas = change.entity_deltas(change.entity_rollup(tables, [CHECK, KIND_X], D, "k"), [CHECK, KIND_X])
    summed = {r[0]: r[1] for r in deltas.groupBy("check_name").sum("delta").collect()}
    totals = {r["check_name"]: r for r in change.side_totals(tables, [CHECK, KIND_X], D).collect()}
    for name in ("c", "x"):
        assert summed[name] == totals[name]["current_value"] - totals[name]["previous_value"]
    card = {r["check_name"]: r for r in change.change_scorecard(tables, [CHECK, KIND_X], D, "k").collect()}
    for name in ("c", "x"):
        assert card[name]["current_value"] == totals[name]["current_value"]
        assert card[name]["previous_value"] == totals[name]["previous_value"]


def test_entity_on_one_side_and_null_values(spark):
    tables = sides(spark, [(1, D, 5, "x"), (2, ago(1), 3, "x"), (3, D, None, "x"), (4, D, 1, None)])
    top = change.top_drivers(tables, [KIND_X], D, "k").collect()
    assert [(r["rank"], r["entity"], float(r["delta"])) for r in top] == [(1, 1, 5.0), (2, 2, -3.0), (3, 3, 0.0)]
    row = change.side_totals(tables, [KIND_X], D).collect()[0]
    assert (float(row["current_value"]), float(row["previous_value"])) == (5.0, 3.0)


def test_all_null_side_stays_null(spark):
    row = change.change_scorecard(sides(spark, [(1, D, None, "x"), (1, ago(1), 4, "x")]), [CHECK], D, "k").collect()[0]
    assert (row["current_value"], row["status"]) == (None, "OK")


def test_labels_from_a_dimension(spark):
    tables = sides(spark, [(1, D, 5, "x"), (2, D, 9, "x")])
    names = spark.createDataFrame([(1, "one"), (7, "seven")], "id bigint, title string")
    labelled = change.label_drivers(change.top_drivers(tables, [CHECK], D, "k"), names, "id", "title")
    assert sorted((r["rank"], r["name"]) for r in labelled.collect()) == [(1, None), (2, "one")]


# -- records, reports, contracts, sources ------------------------------------------------


def test_contracts(spark):
    df = spark.createDataFrame([("a",), ("b",), ("B_old",), (None,)], "v string")
    assert contracts.expect_not_null(df, "v").count() == 1
    assert [tuple(r) for r in contracts.expect_in(df, "v", ["a", "b"]).collect()] == [("B_old", 1)]
    assert [tuple(r) for r in contracts.expect_absent(df, "v", "Old").collect()] == [("B_old", 1)]
    rules = [contracts.not_null("v"), contracts.accepted_values("v", ["a"]), contracts.retired_value("v", "old")]
    got = {(r["rule"], r["violations"]) for r in contracts.contract_report(df, rules).collect()}
    assert got == {("not_null", 1), ("accepted_values", 2), ("retired_value", 1)}


def record(spark, alert_type, issue, detail):
    card = spark.createDataFrame([(detail,)], "payload string").selectExpr("payload", "'ALERT' as status")
    return envelope.alerts(
        envelope.envelope(card, [f"'{alert_type}'", f"'{issue}'", "'src'", f"date '{D}'"], ["1", "2"], "payload")
    )


def test_golden_message_numbers(spark):
    detail = (
        '{"total_eligible_companies":1240,"companies_with_usage":412,"coverage_pct":33.25,"source_table":"src",'
        '"measure_field":"f","table":"t","sample_missing_companies":[]}'
    )
    text = report.render(record(spark, V.MISSING_USAGE, "x", detail), V.MESSAGES).collect()[0]["message"]
    assert "Eligible: `1,240` | With usage: `412` (33.3%)" in text


def test_message_of_missing_figures_and_large_amounts(spark):
    detail = (
        '{"prev_day_natural_growth":12345678901234567.89,"two_days_ago_natural_growth":0.00,"date":"2024-01-14",'
        '"abs_difference":12345678901234567.89,"top_drivers":[]}'
    )
    text = report.render(record(spark, V.GROWTH, V.GROWTH, detail), V.MESSAGES).collect()[0]["message"]
    assert "Yesterday: `$12,345,678,901,234,567.89`" in text
    assert "Pct diff: n/a%" in text


def test_all_clear_only_without_alerts(spark):
    some = record(spark, V.GROWTH, V.GROWTH, "{}")
    assert report.all_clear(some, D, V.ALL_CLEAR).count() == 0
    assert report.all_clear(some.where("false"), D, V.ALL_CLEAR).count() == 1


def test_publish_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "m1"), ("b", "m2")], "alert_type string, message string")
    assert publish(df, "seen_view").count() == 2
    publish(df, "seen_table", as_table=True)
    assert read_published(spark, "seen_table").count() == 2
    write_messages(df, str(tmp_path / "out.parquet"))
    assert read_table(spark, "out", str(tmp_path)).count() == 2
    write_messages(df, str(tmp_path / "out.txt"), as_text=True)
    assert spark.read.text(str(tmp_path / "out.txt"), lineSep="\n\n").count() == 2


def test_expression_helpers(spark):
    assert as_date("2024-01-15") == as_date(dt.datetime(2024, 1, 15, 3)) == D
    row = spark.range(1).selectExpr(
        f"{percent('1', '0')} as none", f"{percent('1', '3')} as third", f"{exceeds_ratio('0.3', '3', '0.1')} as hit"
    ).collect()[0]
    assert (row["none"], row["third"], row["hit"]) == (None, 33.33, True)
