"""Product sales: daily, weekly and customer aggregates, kept up to date from a change feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tarnlake.functions import exact_sum, exact_total, hundredths, ntz
from tarnlake.operators import changefeed, incremental
from tarnlake.plans.inputs import (
    LINE_NUMBERED, SALES, SALES_AFTER, SALES_BEFORE, SALES_CHANGE_TS, SALES_KEY, SALES_LOAD_TS, Tables,
    days_as_timestamps, sales_after, sales_before, ts,
)

KEYS = ["product_id", "order_date"]


def daily(rows: DataFrame, committed) -> DataFrame:
    return rows.groupBy(*KEYS).agg(
        exact_total(hundredths("qty"), 2).cast("decimal(25,2)").alias("sold_qty"),
        F.count(F.lit(1)).alias("n_rows"),
        F.max(committed).alias("record_commit_timestamp"),
    )


def weekly(rows: DataFrame) -> DataFrame:
    """Sold quantity by product, week (Monday) and the order's latest state."""
    return rows.groupBy(
        "product_id", ntz(F.date_trunc("week", "order_date")).alias("week_date"), "order_state"
    ).agg(exact_sum(hundredths("qty")).alias("sold_qty"))


def customer_revenue(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Revenue (quantity x unit price) by customer and order day."""
    unit = F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity"))
    per_order = lines.groupBy("l_orderkey").agg(F.sum(hundredths("l_quantity") * unit).alias("amount"))
    return (
        orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy(F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").cast("date").alias("order_date"))
        .agg(exact_sum(F.col("amount"), 4).alias("revenue"))
    )


def _out(df: DataFrame) -> DataFrame:
    return df.withColumn("sold_qty", F.col("sold_qty").cast("double")).select(
        *KEYS, "sold_qty", "record_commit_timestamp"
    )


def _feed(t: Tables) -> DataFrame:
    """Change feed of the sales table between its two states."""
    return t.layer("sales_feed", lambda: changefeed.diff(
        sales_before(t.sales), sales_after(t.sales), SALES_KEY, 1, ts(SALES_CHANGE_TS)
    ))


def _current(t: Tables) -> DataFrame:
    """The daily aggregate as last written."""
    return t.layer("daily_sales", lambda: daily(sales_before(t.sales), ts(SALES_LOAD_TS)))


def _recomputed(t: Tables) -> DataFrame:
    current = _current(t).drop("n_rows")
    return _out(incremental.recompute_affected(current, sales_after(t.sales), _feed(t), KEYS, "qty"))


def _from_deltas(t: Tables) -> DataFrame:
    return _out(incremental.apply_deltas(_current(t), _feed(t), KEYS, "qty", stored=True))


QUERIES = {
    "daily_product_sales": lambda t: _out(daily(t.sales, ts(SALES_LOAD_TS))),
    "weekly_product_sales": lambda t: weekly(t.sales).orderBy("product_id", "week_date"),
    "customer_revenue": lambda t: customer_revenue(t.line_numbered, t.orders),
    "incr_daily_agg": _recomputed,
    "incr_daily_agg_deltas": _from_deltas,
}

_DAILY = "select product_id, order_date, cast(sum(qty) as double) as sold_qty from {} group by 1, 2"
# A pair keeps its commit time when its total did not change.
_INCR = f"""select n.product_id, n.order_date, n.sold_qty,
  case when o.sold_qty = n.sold_qty then timestamp '{SALES_LOAD_TS}' else timestamp '{SALES_CHANGE_TS}' end
    as record_commit_timestamp
  from ({_DAILY.format(SALES_AFTER)}) n left join ({_DAILY.format(SALES_BEFORE)}) o
    on o.product_id = n.product_id and o.order_date = n.order_date"""
ORACLE = {
    "daily_product_sales": f"""select *, timestamp '{SALES_LOAD_TS}' as record_commit_timestamp
  from ({_DAILY.format(SALES)})""",
    "weekly_product_sales": f"""select product_id, cast(date_trunc('week', order_date) as timestamp) as week_date,
  order_state, cast(sum(qty) as double) as sold_qty from {SALES} group by 1, 2, 3 order by 1, 2""",
    "customer_revenue": f"""select o_custkey as customer_id, cast(o_orderdate as date) as order_date,
  cast(sum(cast(l_quantity as decimal(15,2)) * cast(floor(l_extendedprice * 100 / l_quantity) / 100 as decimal(15,2)))
    as double) as revenue from {LINE_NUMBERED} l join orders on l_orderkey = o_orderkey group by 1, 2""",
    "incr_daily_agg": _INCR,
    "incr_daily_agg_deltas": _INCR,
}

for _name in ("daily_product_sales", "customer_revenue", "incr_daily_agg", "incr_daily_agg_deltas"):
    QUERIES[_name], ORACLE[_name] = days_as_timestamps(QUERIES[_name], ORACLE[_name], "order_date")
