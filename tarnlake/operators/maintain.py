"""Table definition and layout."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


_RANK_BITS = 6


def empty_table(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def conform(df: DataFrame, schema: str | T.StructType) -> DataFrame:
    """Rows in the table's column order and types; missing columns NULL, unknown ones rejected."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    unknown = set(df.columns) - set(schema.names)
    if unknown:
        raise ValueError(f"columns not in the table: {sorted(unknown)}")
    return df.select(*[
        (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def add_column(df: DataFrame, name: str, value: Column, after: str | None = None, first: bool = False) -> DataFrame:
    """Add a column at the end, first, or after another one."""
    names = list(df.columns)
    at = 0 if first else len(names) if after is None else names.index(after) + 1
    return df.withColumn(name, value).select(*names[:at], name, *names[at:])


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def balanced(df: DataFrame, *by: str) -> DataFrame:
    """Let AQE even out the output files: small ones are joined, large ones split."""
    return df.hint("rebalance", *by)


def clustered(df: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by lookup keys, so files carry narrow min/max ranges to skip by."""
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def _as_number(df: DataFrame, name: str) -> Column:
    """A value's place in the order of its column as a number; of text the first seven bytes count."""
    kind, c = df.schema[name].dataType.typeName(), F.col(f"`{name}`")
    if kind == "string":
        return F.conv(F.hex(F.rpad(F.substring(c.cast("binary"), 1, 7), 7, F.lit(b"\x00"))), 16, 10).cast("double")
    if kind == "date":
        return F.unix_date(c).cast("double")
    return (F.unix_micros(c.cast("timestamp")) if kind.startswith("timestamp") else c).cast("double")


def clustered_by_all(df: DataFrame, *columns: str, partitions: int | None = None, bits: int = _RANK_BITS) -> DataFrame:
    """Range-partition and sort by several columns at once, so that a filter on any of them skips most files.

    Each column's values are ranked among 2^`bits` ranges of about equal row counts, cut at approximate quantiles, and the ranks' bits are
    interleaved, the first column's in front; rows are partitioned by ranges of that number, equal numbers by the columns
    themselves, so that one frequent value does not make one large file. NULLs rank lowest. Reads its input twice; the quantiles are
    looked up when this is called.
    """
    numbers = [_as_number(df, c) for c in columns]
    places = F.array(*(F.lit(i / (1 << bits)) for i in range(1, 1 << bits)))
    cuts = df.agg(*(F.percentile_approx(n, places, 100 << bits).alias(f"c{i}") for i, n in enumerate(numbers))).first()
    code = F.lit(0).cast("long")
    for i, n in enumerate(numbers):
        below = [F.when(n > F.lit(float(v)), 1).otherwise(0) for v in sorted(set(cuts[i] or []))]
        rank = reduce(Column.__add__, below, F.lit(0)).cast("long")
        for b in range(bits):
            code = code + F.shiftleft(F.shiftright(rank, b).bitwiseAND(F.lit(1).cast("long")), b * len(columns) + len(columns) - 1 - i)
    by = ["__code", *(f"`{c}`" for c in columns)]
    coded = df.withColumn("__code", code)
    ranged = coded.repartitionByRange(partitions, *by) if partitions else coded.repartitionByRange(*by)
    return ranged.sortWithinPartitions(*by).drop("__code")


def analyze(spark: SparkSession, table: str, columns: Sequence[str] | None = None) -> None:
    """Statistics for the cost-based optimizer."""
    what = f"FOR COLUMNS {', '.join(columns)}" if columns else "FOR ALL COLUMNS"
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS {what}")


def statistics(spark: SparkSession, table: str, columns: Sequence[str]) -> DataFrame:
    """What `analyze` left in the catalog: rows, NULLs, least and greatest value (as text) per column. Reads no data."""
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    counted = re.search(r"(\d+) rows", about.get("Statistics") or "")
    rows = []
    for c in columns:
        known = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table} `{c}`").collect()}
        value = {k: None if v in (None, "NULL") else v for k, v in known.items()}
        nulls = value.get("num_nulls")
        rows.append((c, int(counted.group(1)) if counted else None, None if nulls is None else int(nulls), value.get("min"), value.get("max")))
    return spark.createDataFrame(rows, "column_name string, n_rows long, n_nulls long, min_value string, max_value string")
