"""The miniature tables of the end-to-end fixture (as-of day 2024-01-15)."""

import datetime as dt
from decimal import Decimal

D = dt.date(2024, 1, 15)


def ago(days: int) -> dt.date:
    return D - dt.timedelta(days=days)


DAILY_SCHEMA = (
    "company_id string, account_name string, product_code string, revenue_type string, model_type string, "
    "date_id date, is_active_product boolean, account_status string, grouping_ind string, "
    "end_budget_usd decimal(18,2), number_of_employees bigint"
)
SNAPSHOT_SCHEMA = (
    "company_id string, account_name string, product_code string, revenue_type string, model_type string, "
    "date_key date, date_id date, end_budget_usd decimal(18,2), number_of_employees bigint, "
    "natural_growth_budget_usd decimal(18,2)"
)
USAGE_SCHEMA = "company_id string, source_table string, date_id date, active_employees bigint"
BUCKETS_SCHEMA = (
    "company_id string, product_code string, revenue_type string, model_type string, bucket_name string, date_id date"
)


def money(value):
    return None if value is None else Decimal(str(value))


def arr(company, name, product, status, grouping, active):
    return (company, name, product, "arr", "actual", D, active, status, grouping, money(0), 0)


def carr(company, name, product, end, employees, day=D):
    return (company, name, product, "carr", "actual", day, True, "Customer", "no", money(end), employees)


def snap(company, name, product, key_lag, id_lag, end, employees, growth):
    return (
        company, name, product, "carr", "actual", ago(key_lag), ago(id_lag), money(end), employees, money(growth),
    )


def daily_rows():
    rows = [
        arr("c1", "Alpha", "PAY001", "Customer", "yes", True),
        arr("c1", "Alpha", "COR0001", "Customer", "no", True),
        arr("c2", "Beta", "UK0001", "Customer", "no", True),
        arr("c3", "Gamma", "PAY001", "Pending Churn", "yes", True),
        arr("c4", "Delta", "COR0001", "Churned", "no", True),
        arr("c5", "Epsilon", "PAY001", "Customer", "yes", False),
        arr("c6", "Zeta", "UK0001", "Customer", "no", True),
        arr("c6", "Zeta", "PAY001", "Churned", "yes", True),
        carr("c1", "Alpha", "COR0001", 1200, 60),
        carr("c2", "Beta", "PAY001", 500, 0),
        carr("c7", "Eta", "COR0001", 300, 20),
    ]
    for lag, number in ((1, 8), (2, 10)):
        rows += [
            (f"f{i}", f"F{i}", "X", "other", "actual", ago(lag), True, "Customer", "no", money(0), 0)
            for i in range(number)
        ]
    return rows


def snapshot_rows():
    return [
        snap("c1", "Alpha", "COR0001", 1, 1, 1000, 50, 900000),
        snap("c2", "Beta", "PAY001", 1, 1, 500, 0, 0),
        snap("c8", "Theta", "COR0001", 1, 1, 250, 20, 0),
        snap("c1", "Alpha", "COR0001", 1, 2, 99999, 999, 999),
        snap("c1", "Alpha", "COR0001", 2, 2, 900, 50, 100000),
        snap("c2", "Beta", "PAY001", 2, 2, 500, 0, 0),
    ]


def usage_rows():
    fact, group, payroll = "fact company usage", "Billing_Group", "pento_payroll_usage"
    return [
        ("c1", fact, D, 10),
        ("c2", fact, D, 0),
        ("c2", fact, D, 0),
        ("c6", group, D, 3),
        ("c2", payroll, D, 4),
        ("c1", group, ago(1), 5),
        ("c3", group, ago(1), 7),
    ]


def bucket_rows():
    def one(i, day):
        return (f"c{i}", "PAY001", "carr", "actual", "base", day)

    return [one(i, ago(1)) for i in range(5)] + [one(i, D) for i in range(4)]


def frames(spark, daily=None, snapshot=None, usage=None, buckets=None):
    return {
        "daily": spark.createDataFrame(daily_rows() if daily is None else daily, DAILY_SCHEMA),
        "snapshot": spark.createDataFrame(snapshot_rows() if snapshot is None else snapshot, SNAPSHOT_SCHEMA),
        "usage": spark.createDataFrame(usage_rows() if usage is None else usage, USAGE_SCHEMA),
        "buckets": spark.createDataFrame(bucket_rows() if buckets is None else buckets, BUCKETS_SCHEMA),
    }
