"""Star schema: denormalized models, dimensions, bridges, the line-item fact, and queries on them.

The fact build meets seven inputs, but line items are shuffled at most twice: the
inputs at order grain (order dimension, order-customer bridge, customer dimension) are
joined with each other first, and so are those at part-supplier grain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tarnlake.functions import exact_sum, row_hash
from tarnlake.operators import scd2, surrogate
from tarnlake.operators.merge import Insert, Update, all_columns, merge_apply, one_per_key, sizeable
from tarnlake.plans.inputs import (
    LINE_EXT, LINE_NUMBERED, LOAD_TS, PARTSUPP, Tables, line_ext, line_numbered, ts,
)
from tarnlake.plans.tpch import REVENUE_SQL, pricing_sql, pricing_summary, revenue
from tarnlake.session import staged


# --- models ---------------------------------------------------------------------------

def with_place(entity: DataFrame, nation: DataFrame, region: DataFrame, nation_key: str) -> DataFrame:
    """Entity with the names of its nation and region (left outer, so no entity is lost)."""
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        "n_nationkey", F.col("n_name").alias("n_nation"), F.col("r_name").alias("r_region")
    )
    return entity.join(places, F.col(nation_key) == F.col("n_nationkey"), "left").drop("n_nationkey", nation_key)


def customer_model(t: Tables) -> DataFrame:
    return with_place(t.customer, t.nation, t.region, "c_nationkey")


def supplier_model(t: Tables) -> DataFrame:
    return with_place(t.supplier, t.nation, t.region, "s_nationkey")


def order_model(t: Tables) -> DataFrame:
    return t.orders.drop("o_custkey")


def part_supplier_model(t: Tables) -> DataFrame:
    return surrogate.assign(
        t.partsupp, "part_supplier_key", ["ps_partkey", "ps_suppkey"]
    )


_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount",
         "l_tax", "l_shipdate", "l_returnflag", "l_linestatus"]


def line_item_model(t: Tables) -> DataFrame:
    owners = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    lines = t.lineitem.join(owners, F.col("l_orderkey") == F.col("o_orderkey"), "left").drop("o_orderkey")
    return surrogate.assign(lines, "line_order_key")


def _line_item_checked(t: Tables) -> DataFrame:
    """The model with a verdict on its key, whose values follow no order: each of 1 .. rows occurs once."""
    model = staged(line_item_model(t), "line-item-model")
    key = F.col("line_order_key")
    n = F.count(F.lit(1))
    dense = model.agg(((F.min(key) == 1) & (F.max(key) == n) & (F.count_distinct(key) == n)).alias("ok")).scalar()
    return model.select(*_LINE, "c_custkey", dense.alias("key_is_dense"))


# --- dimensions and bridges ------------------------------------------------------------

def _dim(model: DataFrame, key: str, name: str) -> DataFrame:
    return scd2.as_dimension(surrogate.assign(model, name, [key]), ts(LOAD_TS))


_DIMS = {
    "customer": (customer_model, "c_custkey", "sk_custkey"),
    "order": (order_model, "o_orderkey", "sk_orderkey"),
    "part": (lambda t: t.part, "p_partkey", "sk_partkey"),
    "supplier": (supplier_model, "s_suppkey", "sk_suppkey"),
}


def dims(t: Tables, *names: str) -> dict[str, DataFrame]:
    """The dimensions as stored tables: those named, or all."""
    def build(name: str) -> DataFrame:
        model, key, sk = _DIMS[name]
        return t.layer(f"dim_{name}", lambda: _dim(model(t), key, sk))

    return {name: build(name) for name in names or _DIMS}


def bridge_order_customer(orders: DataFrame, dim_order: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Orders and customers by surrogate key, both resolved to their active version."""
    pairs = orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return (
        pairs.join(scd2.current(dim_order).select("o_orderkey", "sk_orderkey"), "o_orderkey")
        .join(scd2.current(dim_customer).select("c_custkey", "sk_custkey"), "c_custkey")
        .select("sk_orderkey", "sk_custkey", "o_orderkey", "c_custkey")
    )


def bridge_part_supp(offers: DataFrame, dim_part: DataFrame, dim_supplier: DataFrame) -> DataFrame:
    parts = scd2.current(dim_part).select("p_partkey", "sk_partkey")
    suppliers = scd2.current(dim_supplier).select("s_suppkey", "sk_suppkey")
    return (
        offers.join(parts, F.col("ps_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("ps_suppkey") == F.col("s_suppkey"))
        .select("sk_partkey", "sk_suppkey", "p_partkey", "s_suppkey", "ps_availqty", "ps_supplycost")
    )


_ORDER_SIDE = ["o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice"]
_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
             "l_commitdate", "l_receiptdate", "l_shipmode"]


def fact_line_item(
    lines: DataFrame, dim: dict[str, DataFrame], order_customer: DataFrame, part_supp: DataFrame
) -> DataFrame:
    """Line items with surrogate keys and the order's attributes (inner joins on active versions).

    What `line_ext` derives from a line is derived when the line need not be moved any more.
    """
    by_order = (
        scd2.current(dim["order"]).select("o_orderkey", "sk_orderkey", *_ORDER_SIDE)
        .join(order_customer.select("o_orderkey", "sk_custkey"), "o_orderkey")
        .join(scd2.current(dim["customer"]).select("sk_custkey"), "sk_custkey", "left_semi")
    )
    by_offer = (
        part_supp.join(scd2.current(dim["part"]).select("sk_partkey"), "sk_partkey", "left_semi")
        .join(scd2.current(dim["supplier"]).select("sk_suppkey"), "sk_suppkey", "left_semi")
    )
    met = lines.join(by_order, F.col("l_orderkey") == F.col("o_orderkey")).join(
        by_offer, (F.col("l_partkey") == F.col("p_partkey")) & (F.col("l_suppkey") == F.col("s_suppkey")))
    return (
        line_ext(met)
        .select("sk_orderkey", "sk_partkey", "sk_suppkey", "sk_custkey", "l_orderkey", "l_linenumber", *_ORDER_SIDE,
                "ps_supplycost", "ps_availqty", *_MEASURES)
    )


def _order_customer(t: Tables) -> DataFrame:
    d = dims(t, "order", "customer")
    return bridge_order_customer(t.orders, d["order"], d["customer"])


def _part_supp(t: Tables) -> DataFrame:
    d = dims(t, "part", "supplier")
    return bridge_part_supp(t.partsupp, d["part"], d["supplier"])


def build_fact(t: Tables) -> DataFrame:
    return fact_line_item(
        line_numbered(t.lineitem), dims(t), t.layer("bridge_order_customer", lambda: _order_customer(t)),
        t.layer("bridge_part_supp", lambda: _part_supp(t)),
    )


def fact(t: Tables) -> DataFrame:
    """The fact as a stored table."""
    return t.layer("fact_line_item", lambda: build_fact(t))


def upsert_session(fact: DataFrame, rows: DataFrame, session_id: str, stage: bool = False) -> DataFrame:
    """Write a session's rows (one per order and line, else it raises): a rerun of the session replaces what it wrote before.

    `stage` them when they come out of joins rather than a table; a table is looked at first, and many rows meet the fact in one join.
    """
    one_per_key(rows, ["l_orderkey", "l_linenumber"])
    tracked = [c for c in rows.columns if c not in ("l_orderkey", "l_linenumber")]
    source = rows.withColumn("record_track_hash", row_hash(tracked)).withColumn("session_id", F.lit(session_id))
    changed = F.col("source.record_track_hash") != F.col("target.record_track_hash")
    return merge_apply(
        fact, source, ["l_orderkey", "l_linenumber", "session_id"],
        matched=[Update(all_columns(source), when=changed)], not_matched=[Insert(all_columns(source))],
        unique_source=True, stage=stage, together=not stage and sizeable(rows, ["l_orderkey", "l_linenumber"]),
    )


def _session_rows(lines: DataFrame) -> DataFrame:
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")


def _upserted(t: Tables) -> DataFrame:
    """Session A wrote all lines; its rerun sees corrected quantities and only lines shipped from 1998 on."""
    lines = _session_rows(t.line_numbered)
    first = t.layer("fact_session_a", lambda: lines.select(
        "*", row_hash(["l_partkey", "l_quantity", "l_shipdate"]).alias("record_track_hash"),
        F.lit("A").alias("session_id"),
    ))
    rerun = lines.filter(F.col("l_shipdate") >= ts("1998-01-01 00:00:00")).withColumn(
        "l_quantity", F.col("l_quantity") + 1
    )
    other = lines.filter(F.col("l_shipdate") >= ts("2001-01-01 00:00:00"))
    second = staged(upsert_session(first, rerun, "A"), "fact-session-a-rerun")  # each upsert writes its table
    return upsert_session(second, other, "B").drop("record_track_hash")


# --- queries on the star ----------------------------------------------------------------

def cheapest_offers(offers: DataFrame, suppliers: DataFrame, parts: DataFrame, area: str, size: int, kind: str) -> DataFrame:
    """Offers at the lowest cost an area's suppliers ask for a part.

    The lowest cost is the area's, but any supplier meeting it is listed.
    """
    wanted = parts.filter((F.col("p_size") == size) & F.col("p_type").like(kind)).select("p_partkey", "p_brand")
    of_area = suppliers.filter(F.col("r_region") == area).select("s_suppkey")
    lowest = (
        offers.join(wanted, F.col("ps_partkey") == F.col("p_partkey"), "left_semi")
        .join(of_area, F.col("ps_suppkey") == F.col("s_suppkey"), "left_semi")
        .groupBy("ps_partkey").agg(F.min("ps_supplycost").alias("min_supply_cost"))
    )
    return (
        offers.join(lowest, "ps_partkey").filter(F.col("ps_supplycost") == F.col("min_supply_cost"))
        .join(suppliers, F.col("ps_suppkey") == F.col("s_suppkey"))
        .join(wanted, F.col("ps_partkey") == F.col("p_partkey"))
        .select("ps_partkey", "ps_suppkey", "min_supply_cost", "s_name", "n_nation", "s_acctbal", "p_brand")
        .sort("ps_partkey", F.desc("s_acctbal"), "ps_suppkey")
    )


def _of_customers(t: Tables, lines: DataFrame, column: str, value: str) -> DataFrame:
    """Lines of the customers with an attribute, by surrogate key."""
    buyers = scd2.current(dims(t, "customer")["customer"]).filter(F.col(column) == value).select("sk_custkey", "n_nation")
    return lines.join(buyers, "sk_custkey")


def _within(column: str, first: str, last: str) -> Column:
    return (F.col(column) >= ts(f"{first} 00:00:00")) & (F.col(column) < ts(f"{last} 00:00:00"))


def _q3(t: Tables) -> DataFrame:
    placed = fact(t).filter(
        (F.col("o_orderdate") < ts("1995-03-15 00:00:00")) & (F.col("l_shipdate") > ts("1995-03-15 00:00:00"))
    )
    return (
        _of_customers(t, placed, "c_mktsegment", "BUILDING")
        .groupBy("l_orderkey", "o_orderdate").agg(exact_sum(revenue(), 4).alias("revenue"))
        .sort(F.desc("revenue"), "o_orderdate", "l_orderkey")
    )


def _q4(t: Tables) -> DataFrame:
    """Commit date before ship date, over 90 days (the raw query: before receipt, over a quarter)."""
    return (
        fact(t)
        .filter(_within("o_orderdate", "1996-07-01", "1996-09-29") & (F.col("l_commitdate") < F.col("l_shipdate")))
        .groupBy("o_orderpriority").agg(F.count_distinct("l_orderkey").alias("order_count"))
        .sort("o_orderpriority")
    )


def _q5(t: Tables) -> DataFrame:
    """Revenue by customer nation over 365 days; the supplier's nation does not matter here."""
    placed = fact(t).filter(_within("o_orderdate", "1996-01-01", "1996-12-31"))
    return (
        _of_customers(t, placed, "r_region", "ASIA")
        .groupBy("n_nation").agg(exact_sum(revenue(), 4).alias("revenue")).sort(F.desc("revenue"))
    )


def _q2(t: Tables) -> DataFrame:
    d = dims(t, "part", "supplier")
    return cheapest_offers(
        t.partsupp, scd2.current(d["supplier"]), scd2.current(d["part"]), "EUROPE", 15, "%ARD"
    )


QUERIES = {
    "model_customer_dim": customer_model,
    "model_supplier_dim": supplier_model,
    "model_order_dim": order_model,
    "model_part_supplier_fact": part_supplier_model,
    "model_line_item_fact": _line_item_checked,
    "bridge_order_customer": _order_customer,
    "bridge_part_supp": _part_supp,
    "fact_line_item": build_fact,
    "fact_upsert_session": _upserted,
    "tpch_q1_star": lambda t: pricing_summary(fact(t), days=3),
    "tpch_q2_star": _q2,
    "tpch_q3_star": _q3,
    "tpch_q4_star": _q4,
    "tpch_q5_star": _q5,
}


def _ranked(table: str, key: str, name: str) -> str:
    return f"(select {key}, row_number() over (order by {key}) as {name} from {table})"


_SK_C, _SK_O = _ranked("customer", "c_custkey", "sk_custkey"), _ranked("orders", "o_orderkey", "sk_orderkey")
_SK_P, _SK_S = _ranked("part", "p_partkey", "sk_partkey"), _ranked("supplier", "s_suppkey", "sk_suppkey")
_NUMBERED_EXT = LINE_EXT.replace("from lineitem l", f"from {LINE_NUMBERED} l")
_ORDER_LINES = f"{_NUMBERED_EXT} l join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey"


def _placed(entity: str, prefix: str) -> str:
    return f"""select e.* exclude ({prefix}_nationkey), n_name as n_nation, r_name as r_region from {entity} e
  left join nation on {prefix}_nationkey = n_nationkey left join region on n_regionkey = r_regionkey"""


_RERUN = "timestamp '1998-01-01 00:00:00'"
ORACLE = {
    "model_customer_dim": _placed("customer", "c"),
    "model_supplier_dim": _placed("supplier", "s"),
    "model_order_dim": "select * exclude (o_custkey) from orders",
    "model_part_supplier_fact": f"""select *, row_number() over (order by ps_partkey, ps_suppkey) as part_supplier_key
  from {PARTSUPP}""",
    "model_line_item_fact": f"""select {', '.join(_LINE)}, o_custkey as c_custkey, true as key_is_dense
  from lineitem left join orders on l_orderkey = o_orderkey""",
    "bridge_order_customer": f"""select sk_orderkey, sk_custkey, o_orderkey, c_custkey from orders
  join {_SK_O} using (o_orderkey) join {_SK_C} on c_custkey = o_custkey""",
    "bridge_part_supp": f"""select sk_partkey, sk_suppkey, p_partkey, s_suppkey, ps_availqty, ps_supplycost
  from {PARTSUPP} join {_SK_P} on p_partkey = ps_partkey join {_SK_S} on s_suppkey = ps_suppkey""",
    "fact_line_item": f"""select sk_orderkey, sk_partkey, sk_suppkey, sk_custkey, l_orderkey, l_linenumber,
  {', '.join(_ORDER_SIDE)}, ps_supplycost, ps_availqty, {', '.join(_MEASURES)}
  from {_NUMBERED_EXT} l join orders o on l_orderkey = o.o_orderkey join {_SK_O} so on so.o_orderkey = o.o_orderkey
  join {_SK_C} on c_custkey = o_custkey join {_SK_P} on p_partkey = l_partkey join {_SK_S} on s_suppkey = l_suppkey
  join {PARTSUPP} on ps_partkey = l_partkey and ps_suppkey = l_suppkey""",
    "fact_upsert_session": f"""select l_orderkey, l_linenumber, l_partkey,
    case when l_shipdate >= {_RERUN} then l_quantity + 1 else l_quantity end as l_quantity, l_shipdate,
    'A' as session_id from {LINE_NUMBERED}
  union all select l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate, 'B' from {LINE_NUMBERED}
    where l_shipdate >= timestamp '2001-01-01 00:00:00'""",
    "tpch_q1_star": pricing_sql(LINE_NUMBERED, "1998-11-28"),
    "tpch_q2_star": f"""with offers as (select * from {PARTSUPP}), low as (select ps_partkey,
    min(ps_supplycost) as min_supply_cost from offers join part on p_partkey = ps_partkey
    join supplier on s_suppkey = ps_suppkey join nation on s_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey
    where r_name = 'EUROPE' and p_size = 15 and p_type like '%ARD' group by 1)
  select o.ps_partkey, o.ps_suppkey, min_supply_cost, s_name, n_name as n_nation, s_acctbal, p_brand
  from offers o join low on low.ps_partkey = o.ps_partkey and ps_supplycost = min_supply_cost
  join supplier on s_suppkey = ps_suppkey join nation on s_nationkey = n_nationkey join part on p_partkey = o.ps_partkey
  order by 1, s_acctbal desc, 2""",
    "tpch_q3_star": f"""select l_orderkey, o_orderdate, cast(sum({REVENUE_SQL}) as double) as revenue
  from {_ORDER_LINES} where c_mktsegment = 'BUILDING' and o_orderdate < timestamp '1995-03-15 00:00:00'
  and l_shipdate > timestamp '1995-03-15 00:00:00' group by 1, 2 order by revenue desc, 2, 1""",
    "tpch_q4_star": f"""select o_orderpriority, count(distinct l_orderkey) as order_count from {_ORDER_LINES}
  where o_orderdate >= timestamp '1996-07-01 00:00:00' and o_orderdate < timestamp '1996-09-29 00:00:00'
  and l_commitdate < l_shipdate group by 1 order by 1""",
    "tpch_q5_star": f"""select n_name as n_nation, cast(sum({REVENUE_SQL}) as double) as revenue from {_ORDER_LINES}
  join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
  where r_name = 'ASIA' and o_orderdate >= timestamp '1996-01-01 00:00:00'
  and o_orderdate < timestamp '1996-12-31 00:00:00' group by 1 order by 2 desc""",
}
