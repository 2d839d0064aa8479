"""Plan review helpers: read ``explain`` output and count what matters at
scale (exchanges, Python evaluation, broadcasts)."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "FlatMapCoGroupsInPandas", "AggregateInPandas", "WindowInPandas", "PythonUDF")


def plan_text(df: DataFrame, mode: str = "simple") -> str:
    """``df.explain(mode)`` as a string.  Before execution an adaptive plan
    prints its initial (static) physical plan, which is what we inspect."""
    conf = df.sparkSession.conf
    old = conf.get("spark.sql.maxMetadataStringLength")
    conf.set("spark.sql.maxMetadataStringLength", "1000000")   # untruncated scan filters
    buf = io.StringIO()
    try:
        with contextlib.redirect_stdout(buf):
            df.explain(mode=mode)
    finally:
        conf.set("spark.sql.maxMetadataStringLength", old)
    return buf.getvalue()


def final_plan_text(df: DataFrame) -> str:
    """The adaptive plan that ran, after an action on ``df`` itself."""
    text = plan_text(df)
    if "== Final Plan ==" not in text:
        raise ValueError("no action has run on this frame")
    return text.split("== Final Plan ==")[1].split("== Initial Plan ==")[0]


def hash_exchanges(plan: str) -> list[str]:
    """The hash-partitioning exchanges, one line each."""
    return [ln.strip() for ln in plan.splitlines() if re.search(r"Exchange hashpartitioning", ln)]


def exchanges(plan: str) -> list[str]:
    return [ln.strip() for ln in plan.splitlines() if re.search(r"\bExchange\b", ln)
            and "BroadcastExchange" not in ln and "ReusedExchange" not in ln]


def _subtrees(plan: str) -> dict[str, str]:
    """Exchange line -> normalised text of the subtree below it."""
    lines = plan.splitlines()
    out = {}
    for i, ln in enumerate(lines):
        if not re.search(r"\bExchange hashpartitioning|\bExchange SinglePartition|\bExchange rangepartitioning", ln):
            continue
        indent = len(ln) - len(ln.lstrip(" :+-"))
        body = [ln]
        for nxt in lines[i + 1:]:
            if len(nxt) - len(nxt.lstrip(" :+-")) <= indent:
                break
            body.append(nxt.strip(" :+-"))
        out[f"{i}"] = re.sub(r"#\d+L?|plan_id=\d+", "", "\n".join(x.strip(" :+-") for x in body))
    return out


def distinct_shuffles(plan: str) -> int:
    """Shuffles counted once per distinct subtree: identical exchanges are
    computed once (exchange/stage reuse)."""
    return len(set(_subtrees(plan).values()))


def python_nodes(plan: str) -> list[str]:
    return [ln.strip() for ln in plan.splitlines() if any(n in ln for n in PYTHON_NODES)]


def summary(df: DataFrame) -> dict[str, int]:
    """Counts of the nodes worth watching in ``df``'s static plan."""
    plan = plan_text(df)
    return {
        "shuffle_exchanges": len(exchanges(plan)),
        "distinct_shuffles": distinct_shuffles(plan),
        "broadcast_exchanges": plan.count("BroadcastExchange"),
        "sort_merge_joins": plan.count("SortMergeJoin"),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "window_group_limits": plan.count("WindowGroupLimit"),
        "python_nodes": len(python_nodes(plan)),
    }
