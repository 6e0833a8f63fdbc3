"""What a plan will cost, from its text: counts of the nodes that move or hold rows, and advice."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def profile(df: DataFrame) -> dict:
    """exchanges, sorts, python nodes, broadcasts, scans with their pushed filters and columns, and advice."""
    text = plan_text(df)
    count = lambda p: len(re.findall(p, text))
    scans = [{"columns": c, "filters": f} for f, c in re.findall(r"PushedFilters: \[([^\]]*)\].*?ReadSchema: struct<([^>]*)>", text)]
    out = {"exchanges": count(r"(?<!Broadcast)Exchange (?:hash|range|Single|Round)"), "sorts": count(r"\bSort \["), "broadcasts": count("BroadcastExchange"), "python": count("MapInArrow|MapInPandas|ArrowEvalPython|BatchEvalPython|FlatMapGroups"), "scans": scans}
    advice = []
    if count("CartesianProduct|BroadcastNestedLoopJoin"):
        advice.append("a cross or theta join: rows multiply; give it an equality or a band")
    if count("BatchEvalPython"):
        advice.append("a row-at-a-time UDF: use built-in functions or an Arrow UDF")
    if count("SinglePartition"):
        advice.append("one partition holds all rows of an exchange: check that what reaches it is small")
    if any(not s["filters"] for s in scans) and count(r"\bFilter \("):
        advice.append("a filter stands above a scan that pushes none down")
    out["advice"] = advice
    return out
