"""Data-quality constraints: declared, measured in few passes, and enforced.

All row-wise constraints of a table (completeness, sign, allowed values, column
order, bounds, data type) come out of a single aggregation over the table. Each
uniqueness constraint adds one grouping on its own columns, combined on the map side
first, so a value held by a third of the rows costs one row per task.

NULL rules: uniqueness counts the keys that occur exactly once over all rows;
non-negative and allowed-values let NULL pass; less-than does not.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from tarnlake.session import staged

SUCCESS, FAILURE = "Success", "Failure"
RESULT_COLUMNS = ["check_name", "constraint_name", "metric", "status"]


class QualityError(Exception):
    """Raised by the gate when a constraint failed."""


@dataclass(frozen=True)
class Check:
    """One constraint: `kind` over `columns`, passing when the metric meets `threshold`."""

    kind: str
    columns: tuple[str, ...]
    threshold: float = 1.0
    values: tuple = ()
    data_type: str = ""

    @property
    def name(self) -> str:
        extra = f", {self.data_type}" if self.data_type else ""
        return f"{self.kind}({','.join(self.columns)}{extra})"


def complete(column: str) -> Check:
    return Check("is_complete", (column,))


def unique(column: str) -> Check:
    return Check("is_unique", (column,))


def uniqueness(columns: Sequence[str], at_least: float = 1.0) -> Check:
    return Check("has_uniqueness", tuple(columns), at_least)


def non_negative(column: str) -> Check:
    return Check("non_negative", (column,))


def contained_in(column: str, values: Iterable) -> Check:
    return Check("contains", (column,), values=tuple(values))


def less_than(left: str, right: str) -> Check:
    return Check("is_less_than", (left, right))


def minimum(column: str, bound: float) -> Check:
    return Check("has_min", (column,), bound)


def maximum(column: str, bound: float) -> Check:
    return Check("has_max", (column,), bound)


def data_type(column: str, kind: str) -> Check:
    return Check("has_data_type", (column,), data_type=kind)


def compile_checks(config: Mapping[str, Any]) -> list[Check]:
    """Checks from a configuration `{"checks": [{"type", "column", "params"}, ...]}`."""
    build = {
        "is_complete": lambda c, p: complete(c),
        "is_unique": lambda c, p: unique(c),
        "has_uniqueness": lambda c, p: uniqueness([c] if isinstance(c, str) else c, p.get("threshold", 1.0)),
        "non_negative": lambda c, p: non_negative(c),
        "contains": lambda c, p: contained_in(c, p["allowed_values"]),
        "is_less_than": lambda c, p: less_than(*c),
        "has_min": lambda c, p: minimum(c, p["value"]),
        "has_max": lambda c, p: maximum(c, p["value"]),
        "has_data_type": lambda c, p: data_type(c, p["data_type"]),
    }
    checks = []
    for entry in config.get("checks", []):
        kind = entry["type"]
        if kind not in build:
            raise ValueError(f"unknown check type: {kind}")
        check = build[kind](entry["column"], entry.get("params", {}))
        if check not in checks:
            checks.append(check)
    return checks


def share(test: Column) -> Column:
    """Rows the test is true for over all rows; 1 for an empty table."""
    return F.coalesce(
        F.count(F.when(test, 1)).cast("double") / F.nullif(F.count(F.lit(1)), F.lit(0)), F.lit(1.0)
    )


def _row_metric(check: Check) -> Column:
    c = F.col(check.columns[0])
    if check.kind == "is_complete":
        return share(c.isNotNull())
    if check.kind == "non_negative":
        return share(c.isNull() | (c >= 0))
    if check.kind == "contains":
        return share(c.isNull() | c.isin(*check.values))
    if check.kind == "is_less_than":
        return share(c < F.col(check.columns[1]))
    if check.kind == "has_min":
        return F.min(c).cast("double") + F.lit(0.0)  # no negative zero
    if check.kind == "has_max":
        return F.max(c).cast("double") + F.lit(0.0)
    return share(c.isNull() | c.try_cast(check.data_type).isNotNull())


def _passes(check: Check) -> Column:
    metric = F.col("metric")
    if check.kind == "has_max":
        return metric <= F.lit(float(check.threshold))
    return metric >= F.lit(float(check.threshold))


def unique_share(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: share of rows whose key occurs exactly once (column `metric`)."""
    sizes = df.groupBy(*columns).count()
    once = F.coalesce(F.sum(F.when(F.col("count") == 1, 1).otherwise(0)).cast("double"), F.lit(0.0))
    rows = F.sum("count")
    return sizes.agg(F.when(rows > 0, once / rows).otherwise(F.lit(1.0)).alias("metric"))


def run_checks(df: DataFrame, checks: Sequence[Check], name: str = "quality") -> DataFrame:
    """One result row per check: check_name, constraint_name, metric, status."""
    grouped = [c for c in checks if c.kind in ("is_unique", "has_uniqueness")]
    row_wise = [c for c in checks if c not in grouped]

    def finish(metric: DataFrame, check: Check) -> Column:
        return F.struct(F.lit(check.name).alias("constraint_name"), metric.alias("metric"))

    parts = []
    if row_wise:
        one = df.agg(*[_row_metric(c).alias(f"m{i}") for i, c in enumerate(row_wise)])
        parts.append(one.select(F.inline(F.array(*[finish(F.col(f"m{i}"), c) for i, c in enumerate(row_wise)]))))
    for check in grouped:
        parts.append(unique_share(df, check.columns).select(F.lit(check.name).alias("constraint_name"), "metric"))
    metrics = reduce(DataFrame.unionByName, parts)
    verdict = F.lit(None).cast("boolean")
    for check in checks:
        verdict = F.when(F.col("constraint_name") == check.name, _passes(check)).otherwise(verdict)
    status = F.when(F.coalesce(verdict, F.lit(False)), F.lit(SUCCESS)).otherwise(F.lit(FAILURE))
    return metrics.select(F.lit(name).alias("check_name"), "constraint_name", "metric", status.alias("status"))


def tag_results(results: DataFrame, dag_id: str, run_id: str, checked_at: Column) -> DataFrame:
    """Results with the run they belong to, ready to append to the audit history."""
    return results.select(
        "*", F.lit(dag_id).alias("dag_id"), F.lit(run_id).alias("run_id"), checked_at.alias("checked_at")
    )


def gate(results: DataFrame) -> None:
    """Raise when any constraint failed; the message lists them (one row per check)."""
    failed = [r["constraint_name"] for r in results.filter(F.col("status") == FAILURE).collect()]
    if failed:
        raise QualityError("data quality checks failed: " + "; ".join(sorted(failed)))


_NUMERIC = {"byte", "short", "integer", "long", "float", "double", "decimal"}


def profile(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = False) -> DataFrame:
    """One row per column: rows, nulls, distinct values, min, max, mean, standard deviation.

    A single pass with approximate distinct counts. `exact` counts them by one narrow
    grouping per column instead, each reading that column alone. Mean and deviation
    are given for numeric columns.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    measures = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        number = c.cast("double") if f.dataType.typeName() in _NUMERIC else F.lit(None).cast("double")
        measures += [
            F.count(c).alias(f"n{i}"),
            F.min(c).cast("string").alias(f"lo{i}"), F.max(c).cast("string").alias(f"hi{i}"),
            F.avg(number).alias(f"avg{i}"), F.stddev(number).alias(f"sd{i}"),
        ]
        if not exact:
            measures.append(F.approx_count_distinct(c).alias(f"d{i}"))
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"), F.col("rows"), (F.col("rows") - F.col(f"n{i}")).alias("nulls"),
            *([] if exact else [F.col(f"d{i}").alias("distinct_values")]),
            F.col(f"lo{i}").alias("min_value"), F.col(f"hi{i}").alias("max_value"),
            F.col(f"avg{i}").alias("mean"), F.col(f"sd{i}").alias("std_dev"),
        )
        for i, f in enumerate(fields)
    ]
    measured = df.agg(*measures).select(F.inline(F.array(*rows)))
    if not exact:
        return measured
    counts = [
        df.agg(F.count_distinct(f"`{f.name}`").alias("distinct_values")).select(
            F.lit(f.name).alias("column_name"), "distinct_values"
        )
        for f in fields
    ]
    return measured.join(reduce(DataFrame.unionByName, counts), "column_name")


def key_distribution(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row on how rows spread over keys: the look that tells whether a join will be skewed."""
    sizes = df.groupBy(*keys).count()
    return sizes.agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.sum("count").alias("n_rows"),
        F.min("count").alias("min_rows"),
        F.max("count").alias("max_rows"),
        (F.sum("count").cast("double") / F.count(F.lit(1))).alias("avg_rows"),
        (F.max("count").cast("double") / F.sum("count")).alias("top_share"),
    )


def write_audit_publish(built: DataFrame, checks: Sequence[Check], publish, name: str = "quality", stored: bool = False):
    """Write `built` once to the shared folder, check that table, and publish it only if every check passes.

    The rows that are checked are the rows that are published, whatever the input does meanwhile. Returns
    what `publish(table)` returns. A stage table that was written for this is `stored` already and is checked as it is.
    """
    written = built if stored else staged(built, f"audit-{name}")
    gate(run_checks(written, checks, name))
    return publish(written)
