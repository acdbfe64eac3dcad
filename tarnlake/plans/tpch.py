"""TPC-H Q1-Q6 and Q12 on the raw tables.

Joins carry no hints: Spark broadcasts a side only when its measured size is under the
threshold, and AQE splits skewed partitions of the others. Line items are
summed per order before they meet the orders, so a hot key shrinks on the map side.
"""

from __future__ import annotations

from datetime import date, timedelta
from pyspark.sql import DataFrame, functions as F

from tarnlake.functions import average, exact_sum, hundredths
from tarnlake.plans.inputs import LINE_EXT, PARTSUPP, Tables, line_ext, ts


def _day(text: str):
    return ts(f"{text} 00:00:00")


def revenue():
    """Discounted price of a line in units of 10^-4."""
    return hundredths("l_extendedprice") * (100 - hundredths("l_discount"))


def pricing_summary(lineitem: DataFrame, cutoff: str = "1998-12-01", days: int = 90) -> DataFrame:
    last = str(date.fromisoformat(cutoff) - timedelta(days=days))
    discounted = revenue()
    return (
        lineitem.filter(F.col("l_shipdate") <= _day(last))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            exact_sum(hundredths("l_quantity")).alias("sum_qty"),
            exact_sum(hundredths("l_extendedprice")).alias("sum_base_price"),
            exact_sum(discounted, 4).alias("sum_disc_price"),
            exact_sum(discounted * (100 + hundredths("l_tax")), 6).alias("sum_charge"),
            average(hundredths("l_quantity")).alias("avg_qty"),
            average(hundredths("l_extendedprice")).alias("avg_price"),
            average(hundredths("l_discount")).alias("avg_disc"),
            F.count(F.lit(1)).alias("count_order"),
        )
        .sort("l_returnflag", "l_linestatus")
    )


def minimum_cost_supplier(
    part: DataFrame, supplier: DataFrame, partsupp: DataFrame, nation: DataFrame, region: DataFrame,
    size: int = 15, kind: str = "%BRASS", area: str = "EUROPE",
) -> DataFrame:
    """Suppliers of an area that offer a part at the area's lowest cost."""
    parts = part.filter((F.col("p_size") == size) & F.col("p_type").like(kind)).select("p_partkey", "p_brand")
    places = nation.join(region.filter(F.col("r_name") == area), F.col("n_regionkey") == F.col("r_regionkey"))
    suppliers = supplier.join(places, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", "s_acctbal", "s_name", "n_name"
    )
    offers = partsupp.join(parts, F.col("ps_partkey") == F.col("p_partkey")).join(
        suppliers, F.col("ps_suppkey") == F.col("s_suppkey")
    )
    lowest = offers.groupBy(F.col("p_partkey").alias("k")).agg(F.min("ps_supplycost").alias("lowest"))
    return (
        offers.join(lowest, (F.col("p_partkey") == F.col("k")) & (F.col("ps_supplycost") == F.col("lowest")))
        .select("s_acctbal", "s_name", "n_name", "p_partkey", "p_brand")
        .sort(F.desc("s_acctbal"), "n_name", "s_name", "p_partkey")
    )


def shipping_priority(
    customer: DataFrame, orders: DataFrame, lineitem: DataFrame, segment: str = "BUILDING", day: str = "1995-03-15"
) -> DataFrame:
    """Orders of a segment not yet shipped. Lines meet the qualifying orders first, so that a broadcast or a runtime
    filter cuts them before they are grouped; the grouping is by the join's key."""
    buyers = customer.filter(F.col("c_mktsegment") == segment).select("c_custkey")
    placed = orders.filter(F.col("o_orderdate") < _day(day)).join(
        buyers, F.col("o_custkey") == F.col("c_custkey"), "left_semi"
    )
    return (
        lineitem.filter(F.col("l_shipdate") > _day(day))
        .join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_orderkey", "o_orderdate").agg(exact_sum(revenue(), 4).alias("revenue"))
        .select("l_orderkey", "revenue", "o_orderdate")
        .sort(F.desc("revenue"), "o_orderdate", "l_orderkey")
    )


def _in_months(first: str, months: int):
    until = F.add_months(F.to_date(F.lit(first)), months).cast("timestamp_ntz")       # folds to a literal
    return lambda c: (F.col(c) >= _day(first)) & (F.col(c) < until)


def order_priority(orders: DataFrame, lines: DataFrame, first: str = "1993-07-01") -> DataFrame:
    """Orders of a quarter with a late line: semi join."""
    late = lines.filter(F.col("l_commitdate") < F.col("l_receiptdate")).select("l_orderkey")
    return (
        orders.filter(_in_months(first, 3)("o_orderdate"))
        .join(late, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
        .groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("order_count"))
        .sort("o_orderpriority")
    )


def order_priority_distinct(orders: DataFrame, lines: DataFrame, first: str = "1993-07-01") -> DataFrame:
    """The same as an inner join and a distinct count."""
    late = lines.filter(F.col("l_commitdate") < F.col("l_receiptdate")).select("l_orderkey")
    return (
        orders.filter(_in_months(first, 3)("o_orderdate"))
        .join(late, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("o_orderpriority").agg(F.count_distinct("o_orderkey").alias("order_count"))
        .sort("o_orderpriority")
    )


def local_supplier_volume(
    customer: DataFrame, orders: DataFrame, lineitem: DataFrame, supplier: DataFrame, nation: DataFrame,
    region: DataFrame, area: str = "ASIA", first: str = "1994-01-01",
) -> DataFrame:
    """Revenue where customer and supplier share a nation of the area."""
    places = nation.join(region.filter(F.col("r_name") == area), F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name"
    )
    buyers = customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_nationkey", "n_name"
    )
    placed = orders.filter(_in_months(first, 12)("o_orderdate")).join(
        buyers, F.col("o_custkey") == F.col("c_custkey")
    ).select("o_orderkey", "c_nationkey", "n_name")
    sold = lineitem.select("l_orderkey", "l_suppkey", revenue().alias("amount"))
    return (
        sold.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(
            supplier.select("s_suppkey", "s_nationkey"),
            (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("c_nationkey") == F.col("s_nationkey")),
        )
        .groupBy("n_name").agg(exact_sum(F.col("amount"), 4).alias("revenue"))
        .sort(F.desc("revenue"))
    )


def revenue_change(
    lineitem: DataFrame, first: str = "1994-01-01", low: int = 5, high: int = 7, quantity: int = 24
) -> DataFrame:
    """Revenue a band of discounts (in whole percent) gave away.

    The band is widened by half a percent on each side, which selects the same two-decimal
    rates without comparing doubles for equality, and is a range the scan can prune by.
    """
    band = (F.col("l_discount") >= (low - 0.5) / 100) & (F.col("l_discount") < (high + 0.5) / 100)
    given_away = hundredths("l_extendedprice") * hundredths("l_discount")
    return lineitem.filter(
        _in_months(first, 12)("l_shipdate") & band & (F.col("l_quantity") < quantity)
    ).agg(exact_sum(given_away, 4).alias("revenue"))


def ship_modes(
    orders: DataFrame, lines: DataFrame, modes: tuple[str, ...] = ("MAIL", "SHIP"), first: str = "1994-01-01"
) -> DataFrame:
    """Late lines per ship mode, split by order priority."""
    late = lines.filter(
        F.col("l_shipmode").isin(*modes)
        & (F.col("l_commitdate") < F.col("l_receiptdate"))
        & (F.col("l_shipdate") < F.col("l_commitdate"))
        & _in_months(first, 12)("l_receiptdate")
    ).select("l_orderkey", "l_shipmode")
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return (
        late.join(orders.select("o_orderkey", "o_orderpriority"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_shipmode")
        .agg(
            F.sum(F.when(urgent, 1).otherwise(0)).alias("high_line_count"),
            F.sum(F.when(urgent, 0).otherwise(1)).alias("low_line_count"),
        )
        .sort("l_shipmode")
    )


# --- registered queries ---------------------------------------------------------------

def _q2(t: Tables) -> DataFrame:
    return minimum_cost_supplier(t.part, t.supplier, t.partsupp, t.nation, t.region, kind="%ARD")


def _q5(t: Tables) -> DataFrame:
    return local_supplier_volume(t.customer, t.orders, t.lineitem, t.supplier, t.nation, t.region, first="1996-01-01")


def _q3(t: Tables) -> DataFrame:
    return shipping_priority(t.customer, t.orders, t.lineitem)


QUERIES = {
    "tpch_q1": lambda t: pricing_summary(t.lineitem),
    "tpch_q2": _q2,
    "tpch_q3": _q3,
    "tpch_q3_top10": lambda t: _q3(t).limit(10),
    "tpch_q4": lambda t: order_priority(t.orders, line_ext(t.lineitem), "1996-07-01"),
    "tpch_q4_distinct": lambda t: order_priority_distinct(t.orders, line_ext(t.lineitem), "1996-07-01"),
    "tpch_q5": _q5,
    "tpch_q6": lambda t: revenue_change(t.lineitem, "1996-01-01"),
    "tpch_q12": lambda t: ship_modes(t.orders, line_ext(t.lineitem), first="1996-01-01"),
}

_PRICE = "cast(l_extendedprice as decimal(15,2))"
_DISC = "cast(l_discount as decimal(4,2))"
_QTY = "cast(l_quantity as decimal(15,2))"
REVENUE_SQL = f"{_PRICE} * (1 - {_DISC})"


def pricing_sql(table: str, last: str) -> str:
    return f"""select l_returnflag, l_linestatus, cast(sum({_QTY}) as double) as sum_qty,
  cast(sum({_PRICE}) as double) as sum_base_price, cast(sum({REVENUE_SQL}) as double) as sum_disc_price,
  cast(sum({REVENUE_SQL} * (1 + cast(l_tax as decimal(4,2)))) as double) as sum_charge,
  cast(sum({_QTY}) as double) / count({_QTY}) as avg_qty,
  cast(sum({_PRICE}) as double) / count({_PRICE}) as avg_price,
  cast(sum({_DISC}) as double) / count({_DISC}) as avg_disc, count(*) as count_order
  from {table} where l_shipdate <= timestamp '{last} 00:00:00' group by 1, 2 order by 1, 2"""


_Q3 = f"""select l_orderkey, cast(sum({REVENUE_SQL}) as double) as revenue, o_orderdate
  from customer, orders, lineitem
  where c_mktsegment = 'BUILDING' and c_custkey = o_custkey and l_orderkey = o_orderkey
    and o_orderdate < timestamp '1995-03-15 00:00:00' and l_shipdate > timestamp '1995-03-15 00:00:00'
  group by l_orderkey, o_orderdate order by revenue desc, o_orderdate, l_orderkey"""
_QUARTER = "o_orderdate >= timestamp '1996-07-01 00:00:00' and o_orderdate < timestamp '1996-10-01 00:00:00'"

ORACLE = {
    "tpch_q1": pricing_sql("lineitem", "1998-09-02"),
    "tpch_q2": f"""with offers as (select s_acctbal, s_name, n_name, p_partkey, p_brand, ps_supplycost
    from part, supplier, {PARTSUPP} ps, nation, region
    where p_partkey = ps_partkey and s_suppkey = ps_suppkey and p_size = 15 and p_type like '%ARD'
      and s_nationkey = n_nationkey and n_regionkey = r_regionkey and r_name = 'EUROPE')
  select s_acctbal, s_name, n_name, p_partkey, p_brand from offers o
  where ps_supplycost = (select min(ps_supplycost) from offers i where i.p_partkey = o.p_partkey)
  order by s_acctbal desc, n_name, s_name, p_partkey""",
    "tpch_q3": _Q3,
    "tpch_q3_top10": f"{_Q3} limit 10",
    "tpch_q4": f"""select o_orderpriority, count(*) as order_count from orders where {_QUARTER}
  and exists (select 1 from {LINE_EXT} l where l_orderkey = o_orderkey and l_commitdate < l_receiptdate)
  group by 1 order by 1""",
    "tpch_q4_distinct": f"""select o_orderpriority, count(distinct o_orderkey) as order_count
  from orders join {LINE_EXT} l on l_orderkey = o_orderkey
  where {_QUARTER} and l_commitdate < l_receiptdate group by 1 order by 1""",
    "tpch_q5": f"""select n_name, cast(sum({REVENUE_SQL}) as double) as revenue
  from customer, orders, lineitem, supplier, nation, region
  where c_custkey = o_custkey and l_orderkey = o_orderkey and l_suppkey = s_suppkey
    and c_nationkey = s_nationkey and s_nationkey = n_nationkey and n_regionkey = r_regionkey and r_name = 'ASIA'
    and o_orderdate >= timestamp '1996-01-01 00:00:00' and o_orderdate < timestamp '1997-01-01 00:00:00'
  group by n_name order by revenue desc""",
    "tpch_q6": f"""select cast(sum({_PRICE} * {_DISC}) as double) as revenue from lineitem
  where l_shipdate >= timestamp '1996-01-01 00:00:00' and l_shipdate < timestamp '1997-01-01 00:00:00'
    and {_DISC} between 0.05 and 0.07 and l_quantity < 24""",
    "tpch_q12": f"""select l_shipmode,
  cast(sum(case when o_orderpriority in ('1-URGENT', '2-HIGH') then 1 else 0 end) as bigint) as high_line_count,
  cast(sum(case when o_orderpriority in ('1-URGENT', '2-HIGH') then 0 else 1 end) as bigint) as low_line_count
  from orders join {LINE_EXT} l on l_orderkey = o_orderkey
  where l_shipmode in ('MAIL', 'SHIP') and l_commitdate < l_receiptdate and l_shipdate < l_commitdate
    and l_receiptdate >= timestamp '1996-01-01 00:00:00' and l_receiptdate < timestamp '1997-01-01 00:00:00'
  group by 1 order by 1""",
}
