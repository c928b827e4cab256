"""Fixed values of the revenue monitor.

Fixed values: names, predicates, thresholds and message texts below have to be
exactly these for the results to agree with the monitor this profile replaces.
"""

from weirgauge.operators.report import MessageTemplate

# Table names as printed in alerts.
DATABASE = "PROD_DWH.WATERFALL"
DAILY = "MRT_WTFL_DAILY"
SNAPSHOT = "MRT_WTFL_DAILY_SNAP"
USAGE = "MRT_USAGE"
BUCKETS = "FACT_WATERFALL_BUCKETS"

# Alert types: the closed set of the output contract.
MISSING_USAGE = "missing_usage_data"
END_BUCKET = "end_bucket_change"
EMPLOYEES = "core_employee_count_change"
VOLUME = "volume_anomaly"
GROWTH = "natural_growth_change"
ALERT_TYPES = (MISSING_USAGE, END_BUCKET, EMPLOYEES, VOLUME, GROWTH)
RETIRED_ISSUE = "unique_combination"
SINGLE_TABLE_ISSUE = "volume_anomaly_mrt_wtfl_unpivot"

# Row predicates.
ACTIVE_ARR = "model_type = 'actual' and revenue_type = 'arr' and is_active_product"
CUSTOMER = "account_status in ('Customer', 'Pending Churn')"
ACTUAL_CARR = "model_type = 'actual' and revenue_type = 'carr'"
CORE_PRODUCT = "COR0001"

# Coverage sub-checks: check name, usage source, days back, extra eligibility.
COVERAGE_CHECKS = (
    ("fact_company_usage", "fact company usage", 0, "true"),
    ("bllng_group", "Billing_Group", 1, "grouping_ind = 'yes' and product_code not like 'UK%'"),
    ("pento_payroll_usage", "pento_payroll_usage", 0, "product_code like 'UK%'"),
)

# Thresholds; all tests are strict.
COVERAGE_SHARE = "0.5"
CHANGE_SHARE = "0.10"
GROWTH_AMOUNT = "800000"
VOLUME_SHARE = "0.20"
VOLUME_DAYS = 7
SAMPLE_SIZE = 10
TOP_SIZE = 5

# Natural keys of the duplicate diagnostics and the columns shown per key.
DAILY_KEYS = ("company_id", "product_code", "revenue_type", "model_type", "date_id")
SNAPSHOT_KEYS = ("company_id", "product_code", "revenue_type", "model_type", "date_key", "date_id")
USAGE_KEYS = ("company_id", "source_table", "date_id")
BUCKET_KEYS = DAILY_KEYS
BUCKET_KEYS_BY_NAME = ("company_id", "bucket_name", "date_id")

# Message texts.
ALL_CLEAR = ":white_check_mark: Waterfall monitors — all checks passed for {date}."
MESSAGES = {
    MISSING_USAGE: MessageTemplate(
        ":warning: *Waterfall Alert — Missing Usage Data*\n"
        "Source: `{source_table}` | Date: `{alert_date}`\n"
        "Eligible: `{total_eligible_companies:count}` | With usage: `{companies_with_usage:count}`"
        " ({coverage_pct:pct}%)\n"
        "Field: `{measure_field}` on `{table}`\n"
        "Root cause: sample companies missing usage{sample_missing_companies:list}",
        {"sample_missing_companies": "`{company_id}`"},
    ),
    END_BUCKET: MessageTemplate(
        ":warning: *Waterfall Alert — End Bucket Change*\n"
        "Date: `{date}` | Field: `end_budget_usd`\n"
        "Today (`MRT_WTFL_DAILY`): `${current_value:money}` | "
        "Yesterday snap (`MRT_WTFL_DAILY_SNAP`): `${previous_value:money}` | Change: {diff_pct:pct}%\n"
        "Root cause — top company drivers (largest `end_budget_usd` deltas):{top_drivers:list}",
        {"top_drivers": "{account_name} (`{company_id}`): ${delta_end_budget_usd:money}"},
    ),
    EMPLOYEES: MessageTemplate(
        ":warning: *Waterfall Alert — Core Employee Count Change*\n"
        "Date: `{date}` | Product: Core (COR0001) | Field: `number_of_employees`\n"
        "Today: `{current_employee_count:count}` | Yesterday snap: `{previous_employee_count:count}`"
        " | Change: {diff_pct:pct}%\n"
        "Root cause — top company drivers:{top_drivers:list}",
        {"top_drivers": "{account_name} (`{company_id}`): {delta_number_of_employees:count}"},
    ),
    VOLUME: MessageTemplate(
        ":warning: *Waterfall Alert — Volume Anomaly*\n"
        "Table: `{source_table}` | Date: `{date}`\n"
        "Current rows: `{current_record_count:count}` | Expected (7d avg): `{expected_record_count:money}`"
        " | Deviation: {deviation_pct:pct}%\n"
        "Root cause: `{likely_cause}` — duplicate groups: `{duplicate_key_groups:count}`,"
        " extra rows: `{extra_duplicate_rows:count}`{top_duplicate_keys:list}",
        {"top_duplicate_keys": "`{company_id+product_code+source_table+bucket_name:path}`: {row_count:count} rows"},
    ),
    # The single-table arm reports its deviation as a ratio and has no duplicate figures.
    SINGLE_TABLE_ISSUE: MessageTemplate(
        ":warning: *Waterfall Alert — Volume Anomaly*\n"
        "Table: `{source_table}` | Date: `{date}`\n"
        "Current rows: `{current_record_count:count}` | Expected (7d avg): `{expected_record_count:money}`"
        " | Deviation: {deviation_pct:share}%\n"
        "Root cause: `{likely_cause}`"
    ),
    GROWTH: MessageTemplate(
        ":warning: *Waterfall Alert — Natural Growth Change*\n"
        "Bucket: CARR_CURRENT | Date: `{date}` | Field: `natural_growth_budget_usd` on `MRT_WTFL_DAILY_SNAP`\n"
        "Yesterday: `${prev_day_natural_growth:money}` | 2 days ago: `${two_days_ago_natural_growth:money}`\n"
        "Abs diff: `${abs_difference:money}` | Pct diff: {diff_pct:pct}%\n"
        "Root cause — top company drivers:{top_drivers:list}",
        {"top_drivers": "{account_name} (`{company_id}`): ${delta_natural_growth_budget_usd:money}"},
    ),
}
