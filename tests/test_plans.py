"""Shape of the physical plans: scans, exchanges, pruning, and behaviour under skew."""

import datetime as dt

import fixture_tables as fx
import plans_util as pu
import pytest
from fixture_tables import D

from weirgauge.operators import change, coverage, duplicates, volume
from weirgauge.plans.revenue_monitor import RevenueMonitor


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    for name, frame in fx.frames(spark).items():
        date = "date_key" if name == "snapshot" else "date_id"
        frame.write.partitionBy(date).parquet(f"{path}/{name}.parquet")
    return RevenueMonitor.read(spark, D, path)


def test_coverage_reads_each_table_once_and_shuffles_entities_once(stored):
    plan = pu.executed_plan(stored.coverage_card())
    assert pu.scans(plan) == 2
    assert pu.count(plan, "ReusedExchange") == 1
    assert "SortMergeJoin" not in plan and pu.no_pairwise_join(plan)
    assert pu.count(plan, "WindowGroupLimit") == 2


def test_change_reads_values_once_and_names_once(stored):
    plan = pu.executed_plan(stored.change_card())
    # daily and snapshot for the values, and again only key and name for the winners
    assert pu.scans(plan) == 4
    assert pu.count(plan, "ReusedExchange") == 1
    assert pu.no_pairwise_join(plan)


def test_totals_need_one_scan_and_one_single_row_exchange(spark, stored):
    table = {"t": change.PinnedTable(stored.snapshot, ("date_key", "date_id"))}
    check = change.ChangeCheck("c", change.Side("t", 1), change.Side("t", 2), "end_budget_usd", "0.1")
    plan = pu.executed_plan(change.side_totals(table, [check], D))
    assert pu.scans(plan) == 1 and pu.count(plan, "Exchange") == 1


def test_volume_reads_only_the_date_column(stored):
    table = volume.DailyTable(stored.daily, "date_id")
    plan = pu.executed_plan(volume.volume_scorecard({"t": table}, D))
    assert pu.scans(plan) == 1
    assert "PartitionFilters: [isnotnull(date_id" in plan
    assert "ReadSchema: struct<>" in plan


def test_duplicates_share_one_grouped_exchange(stored):
    groups = duplicates.KeySpec(stored.daily, ("company_id", "product_code"), ("company_id",), "date_id")
    plan = pu.executed_plan(duplicates.duplicate_report({"t": groups}, D))
    assert pu.scans(plan) == 1 and pu.count(plan, "ReusedExchange") == 1
    assert pu.count(plan, "TakeOrderedAndProject") == 1 and pu.no_pairwise_join(plan)


def test_groupings_of_a_report_end_in_stages_of_their_own(spark):
    """In one stage they would share its tasks, and those that get one task each would run in the same one."""
    tables = {n: spark.range(4000).selectExpr(f"id % {n} as {k}") for n, k in ((300, "a"), (400, "b"), (500, "c"))}
    found = duplicates.duplicate_report({str(n): duplicates.KeySpec(t, t.columns, t.columns) for n, t in tables.items()})
    lines = pu.executed_plan(found).splitlines()
    depths = [len(line) - len(line.lstrip(" :+-*()0123456789")) for line in lines]
    worst = [i for i, line in enumerate(lines) if "TakeOrderedAndProject" in line]
    assert len(worst) == len(tables)
    for i in worst:
        above = [j for j in range(i) if depths[j] < min(depths[j + 1 : i + 1])]
        union = max(j for j in above if "Union" in lines[j])
        # between the grouping and the union there is an exchange
        assert any("ShuffleQueryStage" in lines[j] for j in above if j > union)
    top = {r.source_table: (r.duplicate_key_groups, r.top_duplicate_keys[0].row_count) for r in found.collect()}
    assert top == {"300": (300, 14), "400": (400, 10), "500": (500, 8)}


def test_no_string_aggregate_in_the_entity_rollup(stored):
    tables = {"t": change.PinnedTable(stored.daily, ("date_id",))}
    check = change.ChangeCheck("c", change.Side("t"), change.Side("t", 1), "end_budget_usd", "0.1")
    plan = pu.executed_plan(change.entity_rollup(tables, [check], D, "company_id"))
    assert "SortAggregate" not in plan and pu.count(plan, "HashAggregate") == 2


def test_whole_monitor_has_no_pairwise_join_and_no_python(stored):
    plan = pu.executed_plan(stored.scorecard())
    assert pu.no_pairwise_join(plan)
    assert "Python" not in plan and "Pandas" not in plan
    assert pu.scans(plan) <= 14


def test_single_table_arm_reads_the_shared_counts(stored):
    own, shared = stored.single_volume_card(), stored.single_volume_card(shared=True)
    assert own.collect() == shared.collect() != []
    together = stored.volume_card(with_duplicates=False).select("source_table").union(shared.select("source_table"))
    plan = pu.executed_plan(together)
    assert pu.scans(plan) == 4 and pu.count(plan, "ReusedExchange") == 1


def test_volume_with_diagnostics_of_one_table_has_no_join(stored):
    keys = duplicates.KeySpec(stored.daily, ("company_id", "product_code"), ("company_id",), "date_id")
    found = duplicates.duplicate_report({"t": keys}, D)
    plan = pu.executed_plan(volume.volume_scorecard({"t": volume.DailyTable(stored.daily, "date_id")}, D, duplicates=found))
    assert pu.no_pairwise_join(plan) and "Join" not in plan


def test_rules_of_a_refinement_share_one_grouping(stored):
    rules = {"all": "true", "none": "false", "unknown": "null"}
    found = coverage.refine_each(stored.daily, "company_id", rules)
    plan = pu.executed_plan(found)
    assert pu.scans(plan) == 1 and pu.count(plan, "Exchange") == 1
    entities = {r.company_id for r in stored.daily.select("company_id").distinct().collect()} - {None}
    assert {(r.rule, r.company_id) for r in found.collect()} == {("all", e) for e in entities}


def test_days_are_pushed_to_the_scan(stored):
    plan = pu.executed_plan(stored.coverage_card())
    assert "PartitionFilters: [isnotnull(date_id" in plan and "PushedFilters" in plan


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """200,000 rows over two days, half of them owned by one entity."""
    path = str(tmp_path_factory.mktemp("skew") / "rows")
    spark.range(200_000, numPartitions=8).selectExpr(
        "case when id % 2 = 0 then 0 else id end as k",
        f"case when id % 3 = 0 then date '{D}' else date '{D - dt.timedelta(days=1)}' end as d",
        "cast(id % 100 as decimal(18,2)) as m",
        "concat('n', id % 5) as label",
        "'s' as src",
        "true as active",
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_hot_entity_results(skewed):
    check = change.ChangeCheck("c", change.Side("t"), change.Side("t", 1), "m", "0.1")
    row = change.change_scorecard({"t": change.PinnedTable(skewed, ("d",))}, [check], D, "k", "label").collect()[0]
    today = skewed.where(f"d = date '{D}'").agg({"m": "sum"}).collect()[0][0]
    assert row["current_value"] == today
    assert row["top_drivers"][0]["entity"] == 0 and row["top_drivers"][0]["name"] == "n4"


def test_hot_key_in_duplicates_and_coverage(skewed):
    stats = duplicates.top_duplicates(duplicates.duplicate_groups(skewed, ("k",)), ("k",), ("k",)).collect()
    assert (stats[0]["k"], stats[0]["row_count"]) == (0, 100_000)
    spec = coverage.CoverageSpec(
        [coverage.CoverageCheck("c", "s")], "k", "active", "m >= 0", "d", "src", "m", "d"
    )
    card = coverage.coverage_scorecard(coverage.entity_facts(skewed, skewed, spec, D), "k").collect()[0]
    assert card["eligible"] == skewed.where(f"d = date '{D}'").select("k").distinct().count()


def test_hot_entity_is_combined_before_the_shuffle(spark, skewed):
    """The exchange of a grouped check carries at most one row per key and task."""
    groups = duplicates.duplicate_groups(skewed, ("k",))
    groups.collect()
    plan = groups._jdf.queryExecution().executedPlan()
    written = _shuffle_records(plan)
    distinct = skewed.select("k").distinct().count()
    tasks = skewed.rdd.getNumPartitions()
    assert written <= distinct + tasks


def test_screen_leaves_unique_keys_where_they_are(spark):
    """The exchange of keys carries only those that may repeat; a screen that is too full is left out."""
    rows = spark.range(20000).selectExpr("id % 19990 as a", "concat('key ', id % 19990) as b", "id as cell")
    repeated = [(i, f"key {i}", 2) for i in range(10)]
    for options, most in ({}, 20), ({"most": 9}, 40000):
        groups = duplicates.screened_groups(rows, ("a", "b"), **options)
        assert sorted(tuple(r) for r in groups.collect()) == repeated
        written = _shuffle_records(groups._jdf.queryExecution().executedPlan())
        assert 10 <= written <= most and (written >= 19990 or not options)


def _shuffle_records(plan):
    stage = plan.finalPhysicalPlan() if hasattr(plan, "finalPhysicalPlan") else plan
    stack = [stage]
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name == "Exchange":
            return node.metrics().apply("shuffleRecordsWritten").value()
        if name in ("ShuffleQueryStage", "AQEShuffleRead"):
            stack.append(node.plan() if name == "ShuffleQueryStage" else node.children().head())
            continue
        children = node.children()
        stack.extend(children.apply(i) for i in range(children.size()))
    raise AssertionError("no exchange found")
