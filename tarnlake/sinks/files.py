"""Writing tables as parquet and JSON."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.types import LongType, StringType, StructType
from pyspark.sql.utils import AnalysisException

from tarnlake.operators.maintain import balanced
from tarnlake.session import freeing

_MANIFEST = "app string, batch_id long, columns string"


def write_table(
    df: DataFrame, path: str, partitions: int | None = None, codec: str = "snappy", even: bool = True
) -> None:
    """Full overwrite, in a fixed number of files or (`even`) in files AQE sizes.

    Both cost a shuffle; rows that are well spread already are written as they are
    with `even=False`.
    """
    shaped = df.repartition(partitions) if partitions else balanced(df) if even else df
    shaped.write.mode("overwrite").option("compression", codec).parquet(path)


def write_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Overwrite only the partitions present in `df`.

    Rebalancing on the partition columns gives few files per partition and still
    splits a partition that holds much of the data.
    """
    with freeing(df.sparkSession):
        balanced(df, *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    """Append; columns may be new (read back with `read_evolving`)."""
    df.write.mode("append").parquet(path)


def append_batch(df: DataFrame, path: str, app: str, batch_id: int) -> None:
    """Append a batch once, however often it is written.

    A batch owns the directory of its application and id; a replay overwrites that directory and no other. A line in the manifest
    follows when the rows are there: `read_batches` takes what the manifest names.
    """
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}/app={app}/batch_id={batch_id}")
    line = spark.createDataFrame([(app, batch_id, df.schema.json())], _MANIFEST)
    line.coalesce(1).write.mode("overwrite").json(f"{path}/_finished/{app}-{batch_id}")


def finished_batches(spark: SparkSession, path: str) -> list[Row]:
    """(app, batch_id, columns) of the batches the manifest names, in order; one line each."""
    try:
        found = spark.read.schema(_MANIFEST).json(f"{path}/_finished/*")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return found.orderBy("app", "batch_id").collect()


def read_batches(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows of all finished batches with `app` and `batch_id`, or None before the first. Folders without a line in the manifest are not
    looked at. Columns are those of all batches; a batch without one of them reads NULL."""
    batches = finished_batches(spark, path)
    if not batches:
        return None
    fields = {f.name: f for b in batches for f in StructType.fromJson(json.loads(b["columns"])).fields}
    schema = StructType(list(fields.values())).add("app", StringType()).add("batch_id", LongType())
    return spark.read.schema(schema).option("basePath", path).parquet(*(f"{path}/app={b['app']}/batch_id={b['batch_id']}" for b in batches))


def write_json(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*by).json(path)


def save_as(df: DataFrame, table: str) -> None:
    """CREATE TABLE AS SELECT."""
    df.write.mode("overwrite").saveAsTable(table)


def copy_layer(spark: SparkSession, source: str, target: str, by: Sequence[str] = ()) -> None:
    """Copy a table from one layer to the next."""
    df = spark.read.parquet(source)
    if by:
        write_partitions(df, target, by)
    else:
        write_table(df, target)


def compact(spark: SparkSession, source: str, target: str) -> None:
    """Rewrite many small files as few even ones, into a new directory."""
    balanced(spark.read.parquet(source)).write.mode("overwrite").parquet(target)
