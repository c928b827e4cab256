"""The revenue monitor: five checks over four tables, as configuration of the operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from weirgauge.functions.expr import deviation_cause, plain, struct, text
from weirgauge.operators import envelope as env
from weirgauge.operators.change import ChangeCheck, PinnedTable, Side, change_scorecard
from weirgauge.operators.contracts import accepted_values, contract_report, not_null, retired_value
from weirgauge.operators.coverage import CoverageCheck, CoverageSpec, coverage_scorecard, entity_facts
from weirgauge.operators.duplicates import KeySpec, duplicate_report
from weirgauge.operators.report import messages
from weirgauge.operators.volume import (
    DailyTable,
    daily_counts,
    single_scorecard,
    volume_scorecard,
    volume_scorecard_single,
)
from weirgauge.plans import fixed_values as V
from weirgauge.sources import publish, read_tables

COVERAGE = CoverageSpec(
    checks=[CoverageCheck(name, source, extra, lag) for name, source, lag, extra in V.COVERAGE_CHECKS],
    key="company_id",
    rows=V.ACTIVE_ARR,
    member=V.CUSTOMER,
    population_date="date_id",
    source="source_table",
    value="active_employees",
    measure_date="date_id",
)


@dataclass(frozen=True)
class ChangeReport:
    """How a change check is printed: names of its figures in the detail and in its own result."""

    check: ChangeCheck
    source_table: str
    figures: Mapping[str, str]
    columns: Mapping[str, str]
    constants: Mapping[str, str]
    driver_constants: Mapping[str, str]

    def shown(self, column: str, whole: bool = False) -> str:
        """Totals as they are, never rounded (``whole``: of an integer measure); other figures with two digits."""
        if column not in ("current_value", "previous_value"):
            return plain(column)
        return f"cast({column} as decimal(38,0))" if whole else column


_TODAY, _SNAP_1, _SNAP_2 = Side(V.DAILY), Side(V.SNAPSHOT, 1), Side(V.SNAPSHOT, 2)
_BOTH_TABLES = {"today_table": f"{V.DATABASE}.{V.DAILY}", "previous_table": f"{V.DATABASE}.{V.SNAPSHOT}"}
_RATIO_COLUMNS = {"current_value": "current_value", "previous_value": "previous_value", "diff_pct": "change_pct"}

CHANGES = {
    V.END_BUCKET: ChangeReport(
        ChangeCheck(V.END_BUCKET, _TODAY, _SNAP_1, "end_budget_usd", V.CHANGE_SHARE, V.ACTUAL_CARR),
        source_table=f"{V.DAILY} / {V.SNAPSHOT}",
        figures=_RATIO_COLUMNS,
        columns=_RATIO_COLUMNS,
        constants={"measure_field": "end_budget_usd", **_BOTH_TABLES},
        driver_constants={"table": f"{V.DAILY} vs {V.SNAPSHOT}", "field": "end_budget_usd"},
    ),
    V.EMPLOYEES: ChangeReport(
        ChangeCheck(
            V.EMPLOYEES,
            _TODAY,
            _SNAP_1,
            "number_of_employees",
            V.CHANGE_SHARE,
            f"{V.ACTUAL_CARR} and product_code = '{V.CORE_PRODUCT}'",
        ),
        source_table=V.CORE_PRODUCT,
        figures={
            "current_employee_count": "current_value",
            "previous_employee_count": "previous_value",
            "diff_pct": "change_pct",
        },
        columns=_RATIO_COLUMNS,
        constants={
            "product": "Core",
            "product_code": V.CORE_PRODUCT,
            "measure_field": "number_of_employees",
            **_BOTH_TABLES,
        },
        driver_constants={
            "table": f"{V.DAILY} vs {V.SNAPSHOT}",
            "field": "number_of_employees",
            "product_code": V.CORE_PRODUCT,
        },
    ),
    V.GROWTH: ChangeReport(
        ChangeCheck(
            V.GROWTH, _SNAP_1, _SNAP_2, "natural_growth_budget_usd", V.GROWTH_AMOUNT, V.ACTUAL_CARR, absolute=True
        ),
        source_table="carr_current",
        figures={
            "prev_day_natural_growth": "current_value",
            "two_days_ago_natural_growth": "previous_value",
            "abs_difference": "abs_difference",
            "diff_pct": "change_pct",
        },
        columns={
            "prev_day_value": "current_value",
            "two_days_ago_value": "previous_value",
            "abs_difference": "abs_difference",
            "diff_pct": "change_pct",
        },
        constants={
            "bucket_type": "carr_current",
            "measure_field": "natural_growth_budget_usd",
            "table": f"{V.DATABASE}.{V.SNAPSHOT}",
        },
        driver_constants={"table": V.SNAPSHOT, "field": "natural_growth_budget_usd"},
    ),
}

VOLUME_ISSUE = f"concat('{V.VOLUME}_', lower(source_table))"


@dataclass(frozen=True)
class RevenueMonitor:
    """The monitor bound to its four tables and a day.

    ``dedupe=False`` repeats an entity in the missing sample once per product
    row. ``detail_constants`` adds fixed members to the detail of an alert or
    issue type. ``null_members`` keeps members that are NULL in the detail.
    """

    daily: DataFrame
    snapshot: DataFrame
    usage: DataFrame
    buckets: DataFrame
    as_of: dt.date | str
    bucket_keys: Sequence[str] = V.BUCKET_KEYS
    dedupe: bool = True
    detail_constants: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    null_members: bool = False

    @classmethod
    def read(
        cls, spark: SparkSession, as_of: dt.date | str, location: str | None = None, **options
    ) -> RevenueMonitor:
        """Bind tables ``daily, snapshot, usage, buckets`` found under a path or in the catalog."""
        tables = read_tables(spark, ("daily", "snapshot", "usage", "buckets"), location)
        return cls(**tables, as_of=as_of, **options)

    # -- typed scorecards ---------------------------------------------------

    def coverage_card(self) -> DataFrame:
        facts = entity_facts(self.daily, self.usage, COVERAGE, self.as_of)
        return coverage_scorecard(facts, COVERAGE.key, V.COVERAGE_SHARE, V.SAMPLE_SIZE, self.dedupe)

    def change_card(self, names: Sequence[str] = tuple(CHANGES), rounded: bool = False) -> DataFrame:
        tables = {
            V.DAILY: PinnedTable(self.daily, ("date_id",)),
            V.SNAPSHOT: PinnedTable(self.snapshot, ("date_key", "date_id")),
        }
        checks = [CHANGES[name].check for name in names]
        return change_scorecard(tables, checks, self.as_of, "company_id", "account_name", V.TOP_SIZE, rounded)

    def _counted(self) -> dict[str, DailyTable]:
        return {
            V.DAILY: DailyTable(self.daily, "date_id"),
            V.SNAPSHOT: DailyTable(self.snapshot, "date_key"),
            V.USAGE: DailyTable(self.usage, "date_id"),
            V.BUCKETS: DailyTable(self.buckets, "date_id"),
        }

    def duplicate_card(self, tables: Sequence[str] = (V.DAILY, V.SNAPSHOT, V.USAGE, V.BUCKETS)) -> DataFrame:
        product, source = ("company_id", "product_code"), ("company_id", "source_table")
        bucket = [k for k in self.bucket_keys if k in ("company_id", "product_code", "bucket_name")]
        specs = {
            V.DAILY: KeySpec(self.daily, V.DAILY_KEYS, product, "date_id"),
            V.SNAPSHOT: KeySpec(self.snapshot, V.SNAPSHOT_KEYS, product, "date_key"),
            V.USAGE: KeySpec(self.usage, V.USAGE_KEYS, source, "date_id"),
            V.BUCKETS: KeySpec(self.buckets, self.bucket_keys, bucket, "date_id"),
        }
        return duplicate_report({name: specs[name] for name in tables}, self.as_of, V.TOP_SIZE)

    def volume_card(self, rounded: bool = False, with_duplicates: bool = True) -> DataFrame:
        duplicates = self.duplicate_card() if with_duplicates else None
        return volume_scorecard(
            self._counted(), self.as_of, V.VOLUME_DAYS, V.VOLUME_SHARE, duplicates, rounded
        )

    def single_volume_card(self, shared: bool = False) -> DataFrame:
        """The single-table check; ``shared`` takes it from the counts of all tables, where those are made anyway."""
        if shared:
            counts = daily_counts(self._counted(), self.as_of, V.VOLUME_DAYS)
            return single_scorecard(counts, V.DAILY, self.as_of, V.VOLUME_DAYS, V.VOLUME_SHARE)
        table = self._counted()[V.DAILY]
        return volume_scorecard_single(table, V.DAILY, self.as_of, V.VOLUME_DAYS, V.VOLUME_SHARE)

    # -- details ------------------------------------------------------------

    def _detail(self, issue: str, members: Mapping[str, str]) -> str:
        extra = {member: text(value) for member, value in self.detail_constants.get(issue, {}).items()}
        return env.detail({**members, **extra}, self.null_members)

    @staticmethod
    def _coverage_members() -> dict[str, str]:
        return {
            "total_eligible_companies": "eligible",
            "companies_with_usage": "with_usage",
            "coverage_pct": plain("coverage_pct"),
            "threshold_pct": "50",
            "source_table": "source_table",
        }

    def _is_whole(self, report: ChangeReport) -> bool:
        """Whether the measure is an integer on both sides, so that its totals have no digits after the point."""
        tables = {V.DAILY: self.daily, V.SNAPSHOT: self.snapshot}
        sides = (report.check.current, report.check.previous)
        return all(isinstance(tables[s.table].schema[report.check.measure].dataType, T.IntegralType) for s in sides)

    def _change_detail(self, report: ChangeReport) -> str:
        whole = self._is_whole(report)
        driver = {
            "company_id": "driver.entity",
            "account_name": "driver.name",
            f"delta_{report.check.measure}": "cast(driver.delta as decimal(38,0))" if whole else "driver.delta",
            **{member: text(value) for member, value in report.driver_constants.items()},
        }
        members = {
            **{shown: report.shown(column, whole) for shown, column in report.figures.items()},
            "date": "alert_date",
            **{member: text(value) for member, value in report.constants.items()},
            "top_drivers": f"transform(top_drivers, driver -> {struct(driver)})",
        }
        return self._detail(report.check.name, members)

    @staticmethod
    def _volume_members() -> dict[str, str]:
        return {
            "current_record_count": "current_record_count",
            "expected_record_count": plain("expected_record_count"),
            "deviation_pct": plain("deviation_pct"),
            "date": "record_date",
            "source_table": "source_table",
        }

    @staticmethod
    def _single_members() -> dict[str, str]:
        return {
            "current_record_count": "current_record_count",
            "diff_record": plain("diff_record", 6),
            "expected_record_count": plain("expected_record_count"),
            "deviation_pct": plain("deviation_ratio"),
            "status": "status",
            "date": "record_date",
            "source_table": "source_table",
        }

    # -- arms in the common record ------------------------------------------

    def coverage_arm(self) -> DataFrame:
        members = {
            **self._coverage_members(),
            "measure_field": text(COVERAGE.value),
            "table": text(f"{V.DATABASE}.{V.USAGE}"),
            "sample_missing_companies": "sample_missing",
        }
        return env.envelope(
            self.coverage_card(),
            [text(V.MISSING_USAGE), "check_name", "source_table", "check_date"],
            ["eligible", "with_usage", "coverage_pct"],
            self._detail(V.MISSING_USAGE, members),
        )

    def change_arm(self) -> DataFrame:
        """The three change checks; they come out of one rollup."""
        sources = " ".join(f"when {text(n)} then {text(r.source_table)}" for n, r in CHANGES.items())
        details = " ".join(f"when {text(n)} then {self._change_detail(r)}" for n, r in CHANGES.items())
        by_amount = f"check_name = {text(V.GROWTH)}"
        return env.envelope(
            self.change_card(),
            ["check_name", "check_name", f"case check_name {sources} end", "alert_date"],
            [
                "current_value",
                "previous_value",
                f"case when {by_amount} then cast(abs_difference as double) else change_pct end",
                f"case when {by_amount} then change_pct end",
            ],
            f"case check_name {details} end",
        )

    def volume_arm(self) -> DataFrame:
        diagnostics = ("duplicate_key_groups", "extra_duplicate_rows", "top_duplicate_keys", "likely_cause")
        return env.envelope(
            self.volume_card(),
            [text(V.VOLUME), VOLUME_ISSUE, "source_table", "record_date"],
            ["current_record_count", "expected_record_count", "deviation_pct"],
            self._detail(V.VOLUME, {**self._volume_members(), **{member: member for member in diagnostics}}),
        )

    def single_volume_arm(self) -> DataFrame:
        members = {**self._single_members(), "likely_cause": deviation_cause(V.VOLUME_DAYS)}
        return env.envelope(
            self.single_volume_card(shared=True),
            [text(V.VOLUME), text(V.SINGLE_TABLE_ISSUE), "source_table", "record_date"],
            ["current_record_count", "expected_record_count", "deviation_ratio", "diff_record"],
            self._detail(V.SINGLE_TABLE_ISSUE, members),
        )

    # -- results ------------------------------------------------------------

    def scorecard(self) -> DataFrame:
        """Every check with its metrics, status and detail."""
        return env.scorecard(self.coverage_arm(), self.change_arm(), self.volume_arm(), self.single_volume_arm())

    def alerts(self) -> DataFrame:
        """The breached checks in the nine-column record."""
        return env.alerts(self.scorecard())

    def report(self) -> DataFrame:
        return env.ordered_report(self.alerts())

    def publish(self, name: str, as_table: bool = False) -> DataFrame:
        return publish(self.alerts(), name, as_table)

    def messages(self, alert_rows: DataFrame | None = None) -> DataFrame:
        """Messages of the run; pass a published alert table to avoid evaluating the checks again."""
        rows = self.alerts() if alert_rows is None else alert_rows
        return messages(rows, V.MESSAGES, self.as_of, V.ALL_CLEAR)

    @staticmethod
    def contract(alert_rows: DataFrame) -> DataFrame:
        """Rules on the published alerts: type present and in the closed set, nothing retired."""
        rules = [
            not_null("alert_type"),
            accepted_values("alert_type", V.ALERT_TYPES),
            retired_value("issue_type", V.RETIRED_ISSUE),
        ]
        return contract_report(alert_rows, rules)

    # -- single checks for debugging ------------------------------------------

    def check(self, name: str) -> DataFrame:
        """A single check by alert type (or the single-table volume issue), breached or not."""
        if name == V.MISSING_USAGE:
            return self.check_coverage()
        if name == V.VOLUME:
            return self.check_volume()
        if name == V.SINGLE_TABLE_ISSUE:
            return self.check_volume_single()
        return self.check_change(name)

    def check_coverage(self) -> DataFrame:
        return self.coverage_card().selectExpr(
            f"{text(V.MISSING_USAGE)} as alert_type",
            "check_name as issue_type",
            "source_table",
            "check_date as alert_date",
            "eligible as total_eligible_companies",
            "with_usage as companies_with_usage",
            "coverage_pct",
            "status",
            f"{env.detail(self._coverage_members())} as detail",
        )

    def check_change(self, name: str) -> DataFrame:
        """One change check under its own column names; tests the figure as shown."""
        report = CHANGES[name]
        return self.change_card([name], rounded=True).selectExpr(
            f"{text(name)} as alert_type",
            f"{text(name)} as issue_type",
            f"{text(report.source_table)} as source_table",
            "alert_date",
            *[f"{report.shown(column, self._is_whole(report))} as {shown}" for shown, column in report.columns.items()],
            "status",
            f"{self._change_detail(report)} as detail",
        )

    def check_volume(self) -> DataFrame:
        """Volume per table without diagnostics; tests the figure as shown."""
        return self.volume_card(rounded=True, with_duplicates=False).selectExpr(
            f"{text(V.VOLUME)} as alert_type",
            f"{VOLUME_ISSUE} as issue_type",
            "source_table",
            "record_date as alert_date",
            "current_record_count",
            "round(expected_record_count, 2) as expected_record_count",
            "deviation_pct",
            "status",
            f"{env.detail(self._volume_members())} as detail",
        )

    def check_volume_single(self) -> DataFrame:
        return self.single_volume_card().selectExpr(
            f"{text(V.VOLUME)} as alert_type",
            f"{text(V.SINGLE_TABLE_ISSUE)} as issue_type",
            "source_table",
            "record_date as alert_date",
            "current_record_count",
            "diff_record",
            "expected_record_count",
            "deviation_ratio as deviation_pct",
            "status",
            f"{env.detail(self._single_members())} as detail",
        )
