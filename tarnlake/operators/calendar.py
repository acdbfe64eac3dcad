"""Calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def date_dim(days: DataFrame, column: str) -> DataFrame:
    """Calendar attributes of distinct days."""
    d = F.col(column)                 # fixed values: the names of the attributes, which readers of the dimension rely on
    return days.select(
        d.alias("sk_datekey"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name_long"),
        F.date_format(d, "EEE").alias("day_name_short"),
        F.weekofyear(d).alias("week_of_year"),
        F.quarter(d).alias("quarter"),
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_id"),
    )


def calendar(spark: SparkSession, first: str = "1990-01-01", last: str = "2020-12-31") -> DataFrame:
    """The calendar between two days, both included."""
    span = F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last)))
    return date_dim(spark.range(1).select(F.explode(span).alias("day")), "day")


def calendar_of(df: DataFrame, column: str) -> DataFrame:
    """The calendar from the first to the last day found in a table."""
    day = F.col(column).cast("date")
    span = df.agg(F.min(day).alias("a"), F.max(day).alias("b"))
    return date_dim(span.select(F.explode(F.sequence("a", "b")).alias("day")), "day")
