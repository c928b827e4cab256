"""The operators bound to the benchmark tables (events, orders, lineitem, part, customer).

The revenue monitor needs four tables the benchmark data does not have; they are
derived from ``events`` by projection, one input row giving one or two output rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from weirgauge.functions.expr import name, text
from weirgauge.operators.change import ChangeCheck, PinnedTable, Side
from weirgauge.operators.coverage import CoverageCheck, CoverageSpec
from weirgauge.operators.volume import DailyTable
from weirgauge.plans.revenue_monitor import RevenueMonitor
from weirgauge.sources import read_table

EVENT_DAY = "2024-01-15"
ORDER_DAY = "1998-10-03"
#: A day on which shipments go on and orders have ended; one after the last event; one before which nothing is expected.
OUTAGE_DAY, SILENT_DAY, FAR_DAY = "2001-08-05", "2024-01-31", "2030-01-01"
PUBLISHED_DAYS = ("2024-01-14", "2024-01-15", "2024-01-16", "2024-01-15")
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def comparable(df: DataFrame) -> DataFrame:
    """Dates as ISO text and decimals as doubles, the forms every engine agrees on."""
    forms = {T.DateType: "string", T.DecimalType: "double"}
    return df.selectExpr(
        *[
            f"cast({name(c.name)} as {forms[type(c.dataType)]}) as {name(c.name)}"
            if type(c.dataType) in forms
            else name(c.name)
            for c in df.schema.fields
        ]
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, "events", sf_dir).selectExpr("*", "cast(value as decimal(18,2)) as amount")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, "orders", sf_dir).selectExpr("*", "cast(o_totalprice as decimal(18,2)) as amount")


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, "lineitem", sf_dir)


def event_day_key(df: DataFrame) -> DataFrame:
    return df.selectExpr("*", "cast(ts as date) as event_day")


# -- counted tables -----------------------------------------------------------


def counted_events(spark, sf_dir) -> dict[str, DailyTable]:
    return {"events": DailyTable(events(spark, sf_dir), "ts")}


def counted_sales(spark, sf_dir) -> dict[str, DailyTable]:
    return {
        "orders": DailyTable(orders(spark, sf_dir), "o_orderdate"),
        "lineitem": DailyTable(lineitem(spark, sf_dir), "l_shipdate"),
    }


# -- change checks --------------------------------------------------------------

EVENT_CHANGE = ChangeCheck("event_value", Side("events"), Side("events", 1), "amount", "0.10")
PURCHASE_CHANGE = ChangeCheck(
    "purchase_value", Side("events"), Side("events", 1), "amount", "0.10", "event_type = 'purchase'"
)
ORDER_CHANGE = ChangeCheck(
    "order_value", Side("orders"), Side("orders", 1), "amount", "800000", absolute=True
)


def pinned_events(spark, sf_dir) -> dict[str, PinnedTable]:
    return {"events": PinnedTable(events(spark, sf_dir), ("ts",))}


def pinned_orders(spark, sf_dir) -> dict[str, PinnedTable]:
    return {"orders": PinnedTable(orders(spark, sf_dir), ("o_orderdate",))}


# -- coverage -------------------------------------------------------------------

# Users active on the day, split by kind of activity; the measure is their spending.
EVENT_COVERAGE = CoverageSpec(
    checks=[
        CoverageCheck("any_activity", "purchase"),
        CoverageCheck("morning_view", "purchase", "event_type = 'view' and hour(ts) < 12"),
        CoverageCheck("previous_day_signup", "signup", "event_type like 'cl%'", lag=1),
    ],
    key="user_id",
    rows="event_type <> 'error'",
    member="event_type in ('view', 'click')",
    population_date="ts",
    source="event_type",
    value="amount",
    measure_date="ts",
)


# -- the revenue monitor over derived tables ------------------------------------------


PRODUCTS = {"click": "PAY001", "view": "UK0001", "purchase": "COR0001", "signup": "COR0001", "error": "UK0002"}
SOURCES = {"click": "fact company usage", "view": "Billing_Group", "purchase": "pento_payroll_usage"}


def _recode(mapping: dict[str, str], default: str = "null") -> str:
    arms = " ".join(f"when {text(source)} then {text(target)}" for source, target in mapping.items())
    return f"case event_type {arms} else {default} end"


KEYS = (
    "user_id as company_id",
    "concat('Account ', user_id) as account_name",
    f"{_recode(PRODUCTS)} as product_code",
    "case when value < 25 then 'arr' else 'carr' end as revenue_type",
    "case when value < 250 then 'actual' else 'budget' end as model_type",
)
MEASURES = ("amount as end_budget_usd", "cast(floor(value) as bigint) as number_of_employees")
EVENT_DATE = "cast(ts as date)"


def derived_daily(rows: DataFrame) -> DataFrame:
    return rows.selectExpr(
        *KEYS,
        f"{EVENT_DATE} as date_id",
        "event_type <> 'error' as is_active_product",
        "case when value < 2 then 'Churned' when value < 4 then 'Pending Churn' else 'Customer' end as account_status",
        "case when hour(ts) < 12 then 'yes' else 'no' end as grouping_ind",
        *MEASURES,
    )


def derived_snapshot(rows: DataFrame) -> DataFrame:
    """Every business day as seen on that day; signups are restated in the next day's snapshot."""
    restated = f"array({EVENT_DATE}, case when event_type = 'signup' then date_add({EVENT_DATE}, 1) end)"
    return rows.selectExpr(
        *KEYS,
        f"explode({restated}) as date_key",
        f"{EVENT_DATE} as date_id",
        *MEASURES,
        "cast(amount * 1000 as decimal(18,2)) as natural_growth_budget_usd",
    ).where("date_key is not null")


def derived_usage(rows: DataFrame) -> DataFrame:
    return rows.selectExpr(
        "user_id as company_id",
        f"{_recode(SOURCES, text('other'))} as source_table",
        f"{EVENT_DATE} as date_id",
        "case when value >= 1 then cast(floor(value / 20) as bigint) end as active_employees",
    )


def derived_buckets(rows: DataFrame) -> DataFrame:
    return rows.where("event_type in ('purchase', 'signup')").selectExpr(
        *KEYS, "event_type as bucket_name", f"{EVENT_DATE} as date_id"
    )


#: A load that stopped at noon of the day.
HALF_DAY = f"cast(ts as date) <> date '{EVENT_DAY}' or hour(ts) < 12"


def revenue_monitor(
    spark: SparkSession, sf_dir: str, as_of: str = EVENT_DAY, loaded: str = "true", **options
) -> RevenueMonitor:
    rows = events(spark, sf_dir).where(loaded)
    return RevenueMonitor(
        daily=derived_daily(rows),
        snapshot=derived_snapshot(rows),
        usage=derived_usage(rows),
        buckets=derived_buckets(rows),
        as_of=as_of,
        **options,
    )
