"""The miniature end-to-end fixture and its variants."""

import json

import fixture_tables as fx
import pytest
from fixture_tables import D, ago

from weirgauge.plans import fixed_values as V
from weirgauge.plans.revenue_monitor import RevenueMonitor


def monitor(spark, **changed):
    options = {k: changed.pop(k) for k in ("bucket_keys", "dedupe", "detail_constants") if k in changed}
    return RevenueMonitor(**fx.frames(spark, **changed), as_of=D, **options)


def by_issue(frame):
    return {row["issue_type"]: row for row in frame.collect()}


EXPECTED = {
    "fact_company_usage": (D, 4.0, 1.0, 25.0, None, "ALERT"),
    "bllng_group": (ago(1), 3.0, 2.0, 66.67, None, "OK"),
    "pento_payroll_usage": (D, 2.0, 1.0, 50.0, None, "OK"),
    "end_bucket_change": (D, 2000.0, 1750.0, 14.29, None, "ALERT"),
    "core_employee_count_change": (D, 80.0, 70.0, 14.29, None, "ALERT"),
    "natural_growth_change": (ago(1), 900000.0, 100000.0, 800000.0, 800.0, "OK"),
    "volume_anomaly_mrt_wtfl_daily": (D, 11.0, 9.0, 22.22, None, "ALERT"),
    "volume_anomaly_mrt_usage": (D, 5.0, 2.0, 150.0, None, "ALERT"),
    "volume_anomaly_fact_waterfall_buckets": (D, 4.0, 5.0, 20.0, None, "OK"),
    "volume_anomaly_mrt_wtfl_unpivot": (D, 11.0, 9.0, 0.22, 2.0, "ALERT"),
}


@pytest.fixture(scope="module")
def card(spark):
    return by_issue(monitor(spark).scorecard())


def test_scorecard_metrics(card):
    got = {
        issue: tuple(row[c] for c in ("alert_date", "metric_1", "metric_2", "metric_3", "metric_4", "status"))
        for issue, row in card.items()
    }
    assert got == EXPECTED


def test_snapshot_without_rows_today_has_no_volume_row(card):
    assert "volume_anomaly_mrt_wtfl_daily_snap" not in card


def test_details(card):
    detail = {issue: json.loads(row["detail"]) for issue, row in card.items()}
    assert [c["company_id"] for c in detail["fact_company_usage"]["sample_missing_companies"]] == ["c2", "c3", "c6"]
    assert detail["fact_company_usage"]["threshold_pct"] == 50

    def drivers(issue, member):
        return [(d["company_id"], d["account_name"], d[member]) for d in detail[issue]["top_drivers"]]

    assert drivers("end_bucket_change", "delta_end_budget_usd") == [
        ("c7", "Eta", 300), ("c8", "Theta", -250), ("c1", "Alpha", 200), ("c2", "Beta", 0)
    ]
    assert drivers("core_employee_count_change", "delta_number_of_employees") == [
        ("c7", "Eta", 20), ("c8", "Theta", -20), ("c1", "Alpha", 10)
    ]
    assert drivers("natural_growth_change", "delta_natural_growth_budget_usd")[0] == ("c1", "Alpha", 800000)
    usage = detail["volume_anomaly_mrt_usage"]
    assert (usage["duplicate_key_groups"], usage["extra_duplicate_rows"]) == (1, 1)
    assert usage["likely_cause"] == "duplicate rows on natural key"
    assert usage["top_duplicate_keys"] == [
        {
            "company_id": "c2",
            "source_table": "fact company usage",
            "row_count": 2,
            "field": "company_id, source_table, date_id",
        }
    ]
    daily = detail["volume_anomaly_mrt_wtfl_daily"]
    assert daily["top_duplicate_keys"] == []
    assert daily["likely_cause"] == "row count deviation vs 7-day average"


def test_detail_members_match_the_contract(card):
    detail = {issue: set(json.loads(row["detail"])) for issue, row in card.items()}
    assert detail["end_bucket_change"] == {
        "current_value", "previous_value", "diff_pct", "date", "measure_field", "today_table", "previous_table",
        "top_drivers",
    }
    assert detail["core_employee_count_change"] == {
        "current_employee_count", "previous_employee_count", "diff_pct", "date", "product", "product_code",
        "measure_field", "today_table", "previous_table", "top_drivers",
    }
    assert detail["natural_growth_change"] == {
        "prev_day_natural_growth", "two_days_ago_natural_growth", "abs_difference", "diff_pct", "date",
        "bucket_type", "measure_field", "table", "top_drivers",
    }
    assert detail["volume_anomaly_mrt_wtfl_unpivot"] == {
        "current_record_count", "diff_record", "expected_record_count", "deviation_pct", "status", "date",
        "source_table", "likely_cause",
    }
    assert detail["fact_company_usage"] == {
        "total_eligible_companies", "companies_with_usage", "coverage_pct", "threshold_pct", "source_table",
        "measure_field", "table", "sample_missing_companies",
    }


def test_alert_record_and_report_order(spark):
    m = monitor(spark)
    alerts = m.alerts()
    assert alerts.columns == [
        "alert_type", "issue_type", "source_table", "alert_date", "metric_1", "metric_2", "metric_3", "metric_4",
        "detail",
    ]
    report = m.report()
    assert report.columns == ["alert_type", "issue_type", "source_table", "alert_date", "detail"]
    assert [r["issue_type"] for r in report.collect()] == [
        "core_employee_count_change",
        "end_bucket_change",
        "fact_company_usage",
        "volume_anomaly_mrt_usage",
        "volume_anomaly_mrt_wtfl_daily",
        "volume_anomaly_mrt_wtfl_unpivot",
    ]
    assert {r["violations"] for r in m.contract(alerts).collect()} == {0}


def test_published_table_feeds_messages(spark):
    m = monitor(spark)
    table = m.publish("published_alerts", as_table=True)
    texts = {r["issue_type"]: r["message"] for r in m.messages(table).collect()}
    assert len(texts) == 6
    assert texts["end_bucket_change"].splitlines() == [
        ":warning: *Waterfall Alert — End Bucket Change*",
        "Date: `2024-01-15` | Field: `end_budget_usd`",
        "Today (`MRT_WTFL_DAILY`): `$2,000.00` | Yesterday snap (`MRT_WTFL_DAILY_SNAP`): `$1,750.00` | Change: 14.3%",
        "Root cause — top company drivers (largest `end_budget_usd` deltas):",
        "• Eta (`c7`): $300.00",
        "• Theta (`c8`): $-250.00",
        "• Alpha (`c1`): $200.00",
        "• Beta (`c2`): $0.00",
    ]
    assert "Deviation: 22.0%" in texts["volume_anomaly_mrt_wtfl_unpivot"]
    assert texts["volume_anomaly_mrt_usage"].endswith("• `c2 / fact company usage`: 2 rows")


def test_all_clear_when_nothing_fires(spark):
    quiet = dict(daily=[], snapshot=[], usage=[], buckets=[])
    rows = monitor(spark, **quiet).messages().collect()
    assert [r["message"] for r in rows] == [
        ":white_check_mark: Waterfall monitors — all checks passed for 2024-01-15."
    ]


def test_empty_tables_give_change_rows_without_alert(spark):
    rows = by_issue(monitor(spark, daily=[], snapshot=[], usage=[], buckets=[]).scorecard())
    assert set(rows) == {"end_bucket_change", "core_employee_count_change", "natural_growth_change"}
    assert all(r["metric_1"] is None and r["status"] == "OK" for r in rows.values())
    assert json.loads(rows["end_bucket_change"]["detail"])["top_drivers"] == []


def carr_pair(current, previous):
    """End-bucket rows with the given totals (None leaves the side out)."""
    daily = [] if current is None else [fx.carr("c1", "Alpha", "PAY001", current, 0)]
    snapshot = [] if previous is None else [fx.snap("c1", "Alpha", "PAY001", 1, 1, previous, 0, 0)]
    return dict(daily=daily, snapshot=snapshot)


@pytest.mark.parametrize(
    ("current", "previous", "status"),
    [
        (110, 100, "OK"),  # exactly ten percent
        (1.1, 1.0, "OK"),
        (110.01, 100, "ALERT"),
        (90, 100, "OK"),
        (89.99, 100, "ALERT"),
        (5, 0, "OK"),  # previous total zero
        (5, -10, "OK"),  # signed denominator
        (None, 100, "OK"),  # no rows today
        (100, None, "OK"),  # no rows yesterday
    ],
)
def test_ratio_boundaries(spark, current, previous, status):
    row = monitor(spark, **carr_pair(current, previous)).change_card([V.END_BUCKET]).collect()[0]
    assert row["status"] == status


def test_exact_and_rounded_thresholds_differ_at_ten_point_004(spark):
    m = monitor(spark, **carr_pair("1100.04", 1000))
    assert m.change_card([V.END_BUCKET]).collect()[0]["status"] == "ALERT"
    standalone = m.check(V.END_BUCKET).collect()[0]
    assert (float(standalone["diff_pct"]), standalone["status"]) == (10.0, "OK")


@pytest.mark.parametrize(
    ("now", "before", "status", "pct"),
    [(900000, 100000, "OK", 800.0), (900000.01, 100000, "ALERT", 800.0), (900000, 0, "ALERT", None)],
)
def test_absolute_boundaries(spark, now, before, status, pct):
    snapshot = [
        fx.snap("c1", "Alpha", "PAY001", 1, 1, 0, 0, now),
        fx.snap("c1", "Alpha", "PAY001", 2, 2, 0, 0, before),
    ]
    row = monitor(spark, snapshot=snapshot).change_card([V.GROWTH]).collect()[0]
    assert (row["status"], row["change_pct"]) == (status, pct)


def test_null_companies_are_separate_drivers_per_side(spark):
    daily = [fx.carr(None, "Nobody", "PAY001", 70, 0)]
    snapshot = [fx.snap(None, "No one", "PAY001", 1, 1, 30, 0, 0)]
    row = monitor(spark, daily=daily, snapshot=snapshot).change_card([V.END_BUCKET]).collect()[0]
    assert [(d["entity"], d["name"], float(d["delta"])) for d in row["top_drivers"]] == [
        (None, "Nobody", 70.0),
        (None, "No one", -30.0),
    ]
    assert (float(row["current_value"]), float(row["previous_value"])) == (70.0, 30.0)


def test_driver_name_prefers_the_current_side(spark):
    daily = [fx.carr("c1", n, "PAY001", 10, 0) for n in ("Aaa", "Bbb", None)]
    snapshot = [
        fx.snap("c1", "Zzz", "PAY001", 1, 1, 5, 0, 0),
        fx.snap("c2", "Old", "PAY001", 1, 1, 5, 0, 0),
    ]
    row = monitor(spark, daily=daily, snapshot=snapshot).change_card([V.END_BUCKET]).collect()[0]
    assert [(d["entity"], d["name"]) for d in row["top_drivers"]] == [("c1", "Bbb"), ("c2", "Old")]


def test_sample_repeats_only_without_dedupe(spark):
    rows = [fx.arr("c1", "Alpha", f"P{i}", "Customer", "no", True) for i in range(12)]
    rows += [fx.arr("c2", "Beta", "P1", "Customer", "no", True)]

    def sample(**options):
        cards = monitor(spark, daily=rows, usage=[], **options).coverage_card().collect()
        card = next(r for r in cards if r["check_name"] == "fact_company_usage")
        return (card["eligible"], [c["company_id"] for c in card["sample_missing"]])

    assert sample() == (2, ["c1", "c2"])
    assert sample(dedupe=False) == (2, ["c1"] * 10)


def test_negative_usage_is_neither_usage_nor_missing(spark):
    rows = [fx.arr(c, c, "P1", "Customer", "no", True) for c in ("c1", "c2", "c3")]
    usage = [("c1", "fact company usage", D, -3), ("c2", "fact company usage", D, None), (None, "fact company usage", D, 9)]
    card = monitor(spark, daily=rows, usage=usage).coverage_card().collect()[0]
    assert (card["eligible"], card["with_usage"]) == (3, 0)
    assert [c["company_id"] for c in card["sample_missing"]] == ["c2", "c3"]


def test_null_product_fails_both_prefix_predicates(spark):
    rows = [fx.arr("c1", "Alpha", None, "Customer", "yes", True)]
    cards = monitor(spark, daily=rows, usage=[]).coverage_card().collect()
    assert [c["check_name"] for c in cards] == ["fact_company_usage"]


def test_bucket_key_is_a_parameter(spark):
    rows = [("c1", "P1", "carr", "actual", "base", D), ("c1", "P2", "carr", "actual", "base", D)]
    by_product = monitor(spark, buckets=rows).duplicate_card([V.BUCKETS]).collect()[0]
    by_name = monitor(spark, buckets=rows, bucket_keys=V.BUCKET_KEYS_BY_NAME).duplicate_card([V.BUCKETS]).collect()[0]
    assert (by_product["duplicate_key_groups"], by_name["duplicate_key_groups"]) == (0, 1)
    assert by_name["top_duplicate_keys"][0]["bucket_name"] == "base"


def test_standalone_checks_have_their_own_columns(spark):
    m = monitor(spark)
    keys = ["alert_type", "issue_type", "source_table", "alert_date"]
    wanted = {
        V.MISSING_USAGE: ["total_eligible_companies", "companies_with_usage", "coverage_pct"],
        V.END_BUCKET: ["current_value", "previous_value", "diff_pct"],
        V.EMPLOYEES: ["current_value", "previous_value", "diff_pct"],
        V.VOLUME: ["current_record_count", "expected_record_count", "deviation_pct"],
        V.SINGLE_TABLE_ISSUE: ["current_record_count", "diff_record", "expected_record_count", "deviation_pct"],
        V.GROWTH: ["prev_day_value", "two_days_ago_value", "abs_difference", "diff_pct"],
    }
    for name, columns in wanted.items():
        assert m.check(name).columns == [*keys, *columns, "status", "detail"]


def test_extra_detail_constants(spark):
    m = monitor(spark, detail_constants={V.SINGLE_TABLE_ISSUE: {"team": "finance"}})
    row = by_issue(m.single_volume_arm())[V.SINGLE_TABLE_ISSUE]
    assert json.loads(row["detail"])["team"] == "finance"


def test_result_does_not_depend_on_partitioning(spark, card):
    m = monitor(spark)
    shuffled = RevenueMonitor(
        daily=m.daily.repartition(7),
        snapshot=m.snapshot.repartition(3).orderBy("account_name"),
        usage=m.usage.repartition(5),
        buckets=m.buckets.repartition(2),
        as_of=D,
    )
    assert by_issue(shuffled.scorecard()) == card
