"""Facts about physical plans, read from the text of the executed plan."""

import re


def executed_plan(df) -> str:
    """Final adaptive plan: run the query, then read what was run."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def count(plan: str, operator: str) -> int:
    return len(re.findall(rf"\b{operator}\b", plan))


def scans(plan: str) -> int:
    return count(plan, "FileScan")


def no_pairwise_join(plan: str) -> bool:
    return "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
