"""File scans: delimited text and parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] | None = None,
    schema: str | T.StructType | None = None,
    sep: str = "|",
    trailing: bool = True,
) -> DataFrame:
    """Headerless delimited files (a path, glob or list).

    With `schema` the files are read once. With `columns` alone the types are
    inferred, which costs a second scan. `trailing` names the filler column that a
    separator at the line end creates, and drops it.
    """
    reader = spark.read.option("sep", sep).option("header", False)
    filler = "__filler"
    if schema is not None:
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        full = T.StructType([*schema.fields, T.StructField(filler, T.StringType())]) if trailing else schema
        df = reader.schema(full).csv(path)
    else:
        df = reader.option("inferSchema", True).option("preferDate", True).csv(path)
        df = df.toDF(*columns, *([filler] if trailing else []))
    return df.drop(filler)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Parquet whose files may differ in columns: the union of them all."""
    return spark.read.option("mergeSchema", True).parquet(path)


def sql_table(spark: SparkSession, path: str, where: str = "true", columns: str = "*") -> DataFrame:
    """SQL over a path."""
    return spark.sql(f"SELECT {columns} FROM parquet.`{path}` WHERE {where}")


def row_count(df: DataFrame, name: str) -> DataFrame:
    """One row; Spark answers it from parquet footers where it can."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")


def head(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """First n rows; with an order, a per-task top n and one merge."""
    return (df.orderBy(*order) if order else df).limit(n)


def inline(spark: SparkSession, rows: Sequence[Sequence], schema: str | T.StructType) -> DataFrame:
    """A few rows written in the program, with a DDL schema."""
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Catalog listing."""
    return spark.sql(f"SHOW TABLES{f' IN {database}' if database else ''}")


def null_rows(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Rows where a column is NULL."""
    rows = df.filter(F.col(column).isNull())
    return rows if n is None else rows.limit(n)
