"""Publishing the star schema: dimensions, bridges and the fact after a change, laid over what the warehouse holds.

The warehouse holds the first load. Then customers of one segment are credited, large parts get dearer, suppliers in debt are
credited and open orders are finished. Every changed row gets a new version with a new surrogate key, bridges and the fact take
up the new keys, and each stage table is published by its own key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tarnlake.operators import scd2, surrogate
from tarnlake.plans import star
from tarnlake.plans.inputs import CHANGE_TS, LOAD_TS, Tables, end_as_text, line_numbered, money_plus, ts
from tarnlake.session import staged


def _raised(df: DataFrame, column: str, when: str, amount: int) -> DataFrame:
    return df.withColumn(column, F.when(F.expr(when), money_plus(column, amount)).otherwise(F.col(column)))


# Per dimension: natural key, surrogate key, tracked columns.
DIMENSIONS = {
    "customer": ("c_custkey", "sk_custkey", ["c_acctbal"]),
    "part": ("p_partkey", "sk_partkey", ["p_retailprice"]),
    "supplier": ("s_suppkey", "sk_suppkey", ["s_acctbal"]),
    "order": ("o_orderkey", "sk_orderkey", ["o_orderstatus"]),
}
_RAISES = {
    "customer": ("c_acctbal", "c_mktsegment = 'BUILDING'", 100),
    "part": ("p_retailprice", "p_size > 25", 10),
    "supplier": ("s_acctbal", "s_acctbal < 0", 500),
}


def _changed(t: Tables, name: str) -> DataFrame:
    """The source of a dimension after the change."""
    if name == "order":
        finished = F.when(F.col("o_orderstatus") == "O", "F").otherwise(F.col("o_orderstatus"))
        return star.order_model(t).withColumn("o_orderstatus", finished)
    models = {"customer": star.customer_model, "part": lambda tables: tables.part, "supplier": star.supplier_model}
    return _raised(models[name](t), *_RAISES[name])


def stage(dim: DataFrame, source: DataFrame, keys: Sequence[str], tracked: Sequence[str], name: str) -> DataFrame:
    """Stage table: the source applied to what the warehouse holds, new versions numbered after the old ones.

    What is applied is stored, and the new versions are, under their numbers; the two together are the table, so nothing is written again.
    """
    applied = staged(scd2.apply_snapshot(dim, source, keys, tracked, ts(CHANGE_TS)), "stage")
    return surrogate.assign_missing(applied, name, keys, dim)


def _dimension(t: Tables, name: str) -> DataFrame:
    key, sk, tracked = DIMENSIONS[name]
    held = star.dims(t, name)[name]
    return scd2.publish(stage(held, _changed(t, name), [key], tracked, sk), held, sk)


def _published(t: Tables, *names: str) -> dict[str, DataFrame]:
    """The published dimensions as stored tables: those named, or all."""
    return {name: t.layer(f"published_{name}", lambda name=name: _dimension(t, name)) for name in names or DIMENSIONS}


def _bridge(held: DataFrame, resolved: DataFrame, keys: list[str], sk: str) -> DataFrame:
    """Pairs as the warehouse holds them and as the published dimensions resolve them."""
    first = scd2.as_dimension(surrogate.assign(held, sk, keys), ts(LOAD_TS))     # stored when it is numbered
    tracked = [c for c in resolved.columns if c not in keys]
    resolved = staged(resolved, "resolved")             # joined once: its keys are looked at before it is applied
    return scd2.publish(stage(first, resolved, keys, tracked, sk), first, sk)


def _order_customer(t: Tables) -> DataFrame:
    d = _published(t, "order", "customer")
    held = t.layer("bridge_order_customer", lambda: star._order_customer(t))
    return _bridge(held, star.bridge_order_customer(t.orders, d["order"], d["customer"]),
                   ["o_orderkey", "c_custkey"], "sk_ordercust_key")


def _part_supp(t: Tables) -> DataFrame:
    d = _published(t, "part", "supplier")
    held = t.layer("bridge_part_supp", lambda: star._part_supp(t))
    return _bridge(held, star.bridge_part_supp(t.partsupp, d["part"], d["supplier"]),
                   ["p_partkey", "s_suppkey"], "sk_partsupp_key")


LINES_AT_ONCE = 1 << 25


def _line_item(t: Tables) -> DataFrame:
    """The fact after the change, published by its natural key: lines whose order, customer, part or supplier changed get a new version.

    The warehouse is the stored fact, all of it active since its load. A large stage is applied in slices.
    """
    order_customer = t.layer("published_order_customer", lambda: _order_customer(t))
    part_supp = t.layer("published_part_supp", lambda: _part_supp(t))
    fresh = star.fact_line_item(line_numbered(t.lineitem), _published(t), scd2.current(order_customer), scd2.current(part_supp))
    keys = ["l_orderkey", "l_linenumber"]
    held = scd2.as_dimension(star.fact(t), ts(LOAD_TS))
    rows = t.layer("stage_line_item", lambda: fresh)
    return scd2.apply_snapshot(held, rows, keys, [c for c in rows.columns if c not in keys], ts(CHANGE_TS), LINES_AT_ONCE)


QUERIES = {
    "publish_customer_dim": lambda t: _dimension(t, "customer"),
    "publish_part_dim": lambda t: _dimension(t, "part"),
    "publish_supplier_dim": lambda t: _dimension(t, "supplier"),
    "publish_order_dim": lambda t: _dimension(t, "order"),
    "publish_order_customer_bridge": _order_customer,
    "publish_part_supp_bridge": _part_supp,
    "publish_line_item_fact": _line_item,
}

_OPEN = f"timestamp '{scd2.OPEN_END}'"


def _versions_sql(old: str, new: str, keys: list[str], tracked: list[str], sk: str | None) -> str:
    """Versions after a snapshot: `old` rows closed where `new` differs, the differing ones opened and numbered after the old."""
    same = " and ".join(f"o.{k} = n.{k}" for k in keys)
    differs = " or ".join(f"o.{c} is distinct from n.{c}" for c in tracked)
    number = f", row_number() over (order by {', '.join(keys)})"
    first = f"select *{f'{number} as {sk}' if sk else ''} from ({old})"
    later = f", (select count(*) from o) + row_number() over (order by {', '.join('n.' + k for k in keys)}) as {sk}" if sk else ""
    hit = f"exists (select 1 from c where {' and '.join(f'c.{k} = o.{k}' for k in keys)})"
    return f"""(with o as ({first}), n as ({new}), c as (select n.* from n join o on {same} where {differs})
  select o.*, not {hit} as record_active_flag, timestamp '{LOAD_TS}' as record_start_date,
    case when {hit} then timestamp '{CHANGE_TS}' else {_OPEN} end as record_end_date from o
  union all by name select n.*{later}, true as record_active_flag, timestamp '{CHANGE_TS}' as record_start_date,
    {_OPEN} as record_end_date from c n)"""


def _raise_sql(source: str, column: str, when: str, amount: int) -> str:
    raised = f"cast(cast({column} as decimal(15,2)) + {amount} as double)"
    return f"select * replace (case when {when} then {raised} else {column} end as {column}) from ({source})"


_SOURCES = {"customer": star.ORACLE["model_customer_dim"], "part": "select * from part", "supplier": star.ORACLE["model_supplier_dim"],
            "order": star.ORACLE["model_order_dim"]}
_FINISHED = "select * replace (case when o_orderstatus = 'O' then 'F' else o_orderstatus end as o_orderstatus) from"
_DIMS = {
    name: _versions_sql(_SOURCES[name], _raise_sql(_SOURCES[name], *_RAISES[name]) if name in _RAISES else f"{_FINISHED} ({_SOURCES[name]})",
                        [key], tracked, sk)
    for name, (key, sk, tracked) in DIMENSIONS.items()
}


def _with_new_keys(sql: str) -> str:
    """SQL over the first load's surrogate keys, over those of the active versions instead."""
    firsts = {"customer": star._SK_C, "order": star._SK_O, "part": star._SK_P, "supplier": star._SK_S}
    for name, first in firsts.items():
        key, sk, _ = DIMENSIONS[name]
        sql = sql.replace(first, f"(select {key}, {sk} from {_DIMS[name]} where record_active_flag)")
    return sql


_FACT = star.ORACLE["fact_line_item"]
_FACT_COLUMNS = ["sk_orderkey", "sk_partkey", "sk_suppkey", "sk_custkey", *star._ORDER_SIDE, "ps_supplycost", "ps_availqty", *star._MEASURES]
ORACLE = {f"publish_{name}_dim": f"select * from {sql}" for name, sql in _DIMS.items()} | {
    "publish_order_customer_bridge": "select * from " + _versions_sql(
        star.ORACLE["bridge_order_customer"], _with_new_keys(star.ORACLE["bridge_order_customer"]), ["o_orderkey", "c_custkey"],
        ["sk_orderkey", "sk_custkey"], "sk_ordercust_key"),
    "publish_part_supp_bridge": "select * from " + _versions_sql(
        star.ORACLE["bridge_part_supp"], _with_new_keys(star.ORACLE["bridge_part_supp"]), ["p_partkey", "s_suppkey"],
        ["sk_partkey", "sk_suppkey", "ps_availqty", "ps_supplycost"], "sk_partsupp_key"),
    "publish_line_item_fact": "select * from " + _versions_sql(
        _FACT, _with_new_keys(_FACT).replace("join orders o on", f"join ({_FINISHED} orders) o on"), ["l_orderkey", "l_linenumber"],
        _FACT_COLUMNS, None),
}

for _name in QUERIES:
    QUERIES[_name], ORACLE[_name] = end_as_text(QUERIES[_name], ORACLE[_name])
