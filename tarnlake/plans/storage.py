"""Sources, sinks and table maintenance: whole tables written to the shared folder and read back."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tarnlake.functions.wire import path_safe
from tarnlake.operators import maintain
from tarnlake.operators.incremental import lookback_window
from tarnlake.plans.inputs import CHANGE_TS, LOAD_TS, Tables, customer_next, money_plus
from tarnlake.session import job_parameter, job_parameters, staged, work_path
from tarnlake.sinks import files as sinks
from tarnlake.sources import files, snapshots

_COUNTED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
_ORDERS_DDL = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice decimal(15,2), "
               "o_orderdate timestamp_ntz, o_orderpriority string")


def _to_delimited(df: DataFrame, path: str) -> str:
    """Lines ending with the separator, as the source files have them."""
    df.withColumn("__end", F.lit("")).write.option("sep", "|").option("emptyValue", "").csv(path)
    return path


def _inferred(t: Tables) -> DataFrame:
    path = _to_delimited(t.supplier, work_path(t.spark, "supplier-text"))
    return files.read_delimited(t.spark, path, t.supplier.columns)


def _typed(t: Tables) -> DataFrame:
    path = _to_delimited(t.orders, work_path(t.spark, "orders-text"))
    typed = files.read_delimited(t.spark, path, schema=_ORDERS_DDL)
    return typed.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


def _glob(t: Tables) -> DataFrame:
    """Two drops of the same file set, read through a glob."""
    root = work_path(t.spark, "parts-text")
    _to_delimited(t.part.filter(F.col("p_size") <= 25), f"{root}/part.tbl.1")
    _to_delimited(t.part.filter(F.col("p_size") > 25), f"{root}/part.tbl.2")
    schema = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    return files.read_delimited(t.spark, f"{root}/part.tbl.*", schema=schema)


def _counts(t: Tables) -> DataFrame:
    return reduce(DataFrame.unionByName, [files.row_count(getattr(t, n), n) for n in _COUNTED])


def _roundtrip(t: Tables) -> DataFrame:
    path = work_path(t.spark, "lineitem")
    sinks.write_table(t.lineitem, path)
    return files.read_table(t.spark, path)


def _layer_copy(t: Tables) -> DataFrame:
    path = work_path(t.spark, "events-layer")
    sinks.copy_layer(t.spark, t.path("events"), path, ["event_type"])
    return files.read_table(t.spark, path).select(*t.events.columns)


def _dynamic_partition(t: Tables) -> DataFrame:
    """All events by type, then the errors again with a corrected value: only their partition is replaced."""
    path = work_path(t.spark, "events-by-type")
    sinks.write_partitions(t.events, path, ["event_type"])
    fixed = t.events.filter(F.col("event_type") == "error").withColumn("value", money_plus("value", 1))
    sinks.write_partitions(fixed, path, ["event_type"])
    return files.read_table(t.spark, path).select("event_id", "event_type", "user_id", "value")


def _schema_evolve(t: Tables) -> DataFrame:
    """An append that brings a new column: older rows read NULL."""
    path = work_path(t.spark, "suppliers")
    sinks.append_table(t.supplier.select("s_suppkey", "s_name"), path)
    sinks.append_table(t.customer.select(
        F.col("c_custkey").alias("s_suppkey"), F.col("c_name").alias("s_name"), F.col("c_mktsegment").alias("segment")
    ), path)
    return files.read_evolving(t.spark, path).select("s_suppkey", "s_name", "segment")


def _history(t: Tables) -> DataFrame:
    """Commit list after a load and a change."""
    path = work_path(t.spark, "customer-versions")
    snapshots.write(t.customer, path, "load", datetime.fromisoformat(LOAD_TS))
    snapshots.write(customer_next(t.customer, t.supplier), path, "change", datetime.fromisoformat(CHANGE_TS))
    return snapshots.history(t.spark, path)


def _compacted(t: Tables) -> DataFrame:
    """Rows before and after compaction, and whether there are fewer files than before."""
    small, large = work_path(t.spark, "events-small"), work_path(t.spark, "events-large")
    sinks.write_table(t.events, small, partitions=64)
    sinks.compact(t.spark, small, large)

    def count(path: str, name: str) -> DataFrame:
        return t.spark.read.parquet(path).groupBy("_metadata.file_path").count().agg(
            F.lit(name).alias("state"), F.count(F.lit(1)).alias("files"), F.sum("count").alias("n_rows")
        )

    before = count(small, "before")
    fewer = F.col("files") < before.select("files").scalar()
    return before.unionByName(count(large, "after")).select("state", "n_rows", fewer.alias("fewer_files"))


def _json(t: Tables) -> DataFrame:
    """Customers as JSON lines, a folder per segment, read back."""
    path = work_path(t.spark, "customers-json")
    sinks.write_json(t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"), path, ["c_mktsegment"])
    return t.spark.read.schema("c_custkey bigint, c_name string, c_acctbal double, c_mktsegment string").json(path)


def _clustered(t: Tables) -> DataFrame:
    path = work_path(t.spark, "orders-clustered")
    maintain.clustered(t.orders, "o_custkey", "o_orderkey").write.parquet(path)
    return files.read_table(t.spark, path)


def _clustered_by_all(t: Tables) -> DataFrame:
    """Orders in files that a filter on the customer, the day or the price can skip."""
    path = work_path(t.spark, "orders-by-three")
    maintain.clustered_by_all(t.orders, "o_custkey", "o_orderdate", "o_totalprice").write.parquet(path)
    return files.read_table(t.spark, path)


def _part_dim(t: Tables) -> DataFrame:
    """Create-table-as-select into a path of its own."""
    path = work_path(t.spark, "part-dim")
    sinks.write_table(t.part, path)
    return files.sql_table(t.spark, path)


# The priorities of orders and the days each may take.
_PRIORITIES = [("1-URGENT", 1), ("2-HIGH", 3), ("3-MEDIUM", 7), ("4-NOT SPECIFIED", None), ("5-LOW", 30)]


def _inline(t: Tables) -> DataFrame:
    """Orders per priority beside a small table written in the program."""
    allowed = files.inline(t.spark, _PRIORITIES, "priority string, days int")
    return t.orders.join(allowed, F.col("o_orderpriority") == F.col("priority"), "left").groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_orders"), F.count("days").alias("n_limited"))


@contextmanager
def _database(t: Tables) -> Iterator[str]:
    """A database of its own below the shared folder. Results that read its tables must be written before the block ends."""
    name = f"tarn_{uuid.uuid4().hex}"
    t.spark.sql(f"CREATE DATABASE {name} LOCATION '{work_path(t.spark, name)}'")
    try:
        yield name
    finally:
        t.spark.sql(f"DROP DATABASE {name} CASCADE")


def _listed(t: Tables) -> DataFrame:
    """Three tables saved to the catalog, listed from there and counted by name."""
    names = ["customer", "orders", "supplier"]
    with _database(t) as database:
        for name in names:
            sinks.save_as(getattr(t, name), f"{database}.{name}")
        listed = files.tables(t.spark, database).filter(~F.col("isTemporary")).select(F.col("tableName").alias("table_name"))
        counts = reduce(DataFrame.unionByName, [files.row_count(t.spark.table(f"{database}.{n}"), n) for n in names])
        return staged(listed.join(counts, "table_name"), "listing")


_COUNTED_COLUMNS = ["o_orderkey", "o_custkey", "order_day"]


def _analyzed(t: Tables) -> DataFrame:
    """Catalog statistics of orders."""
    with _database(t) as database:
        sinks.save_as(t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("order_day")), f"{database}.orders")
        maintain.analyze(t.spark, f"{database}.orders", _COUNTED_COLUMNS)
        return maintain.statistics(t.spark, f"{database}.orders", _COUNTED_COLUMNS)


def run_window(t: Tables) -> DataFrame:
    """What a run told its table, column and window by session settings reads: late data of three days before the window too."""
    def given(name: str, default: str) -> str:
        return job_parameter(t.spark, name, default)

    return lookback_window(getattr(t, given("table", "events")), given("column", "ts"),
                           datetime.fromisoformat(given("from_timestamp", "1970-01-01")), datetime.fromisoformat(given("to_timestamp", "9999-12-31")))


def _told(t: Tables) -> DataFrame:
    """The run told nothing, over all events, and the run told to take the orders of the first half of 1996."""
    events = run_window(t).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("events").alias("table_name"), "n_rows")
    with job_parameters(t.spark, table="orders", column="o_orderdate", from_timestamp="1996-01-01", to_timestamp="1996-07-01"):
        orders = run_window(t).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("orders").alias("table_name"), "n_rows")
    return events.unionByName(orders)


def _run_folders(t: Tables) -> DataFrame:
    """Events by daily run, the run's id in a form that can name a folder; written to such folders and read back."""
    path = work_path(t.spark, "runs")
    day = F.date_format(F.date_trunc("day", F.col("ts").cast("timestamp")), "yyyy-MM-dd'T'HH:mm:ss")
    runs = t.events.select("event_id", path_safe(F.concat(F.lit("scheduled__"), day, F.lit("+00:00"))).alias("run_id"))
    sinks.write_partitions(runs, path, ["run_id"])
    return files.read_table(t.spark, path).groupBy(F.col("run_id").cast("string").alias("run_id")).agg(F.count(F.lit(1)).alias("n_events"))


QUERIES = {
    "src_delimited_roundtrip": _inferred,
    "src_delimited_schema": _typed,
    "src_delimited_glob": _glob,
    "row_counts": _counts,
    "src_head_n": lambda t: files.head(t.orders, 100, F.desc("o_totalprice"), "o_orderkey"),
    "src_sql_path": lambda t: files.sql_table(
        t.spark, t.path("orders"), "o_orderstatus = 'F' and o_totalprice > 100000", "o_orderkey, o_totalprice"
    ),
    "sink_parquet_roundtrip": _roundtrip,
    "sink_layer_copy": _layer_copy,
    "sink_dynamic_partition": _dynamic_partition,
    "sink_schema_evolve": _schema_evolve,
    "table_history": _history,
    "compact_table": _compacted,
    "sink_json_partitions": _json,
    "cluster_by_range": _clustered,
    "cluster_by_all": _clustered_by_all,
    "model_part_dim": _part_dim,
    "src_inline_rows": _inline,
    "src_catalog_listing": _listed,
    "table_statistics": _analyzed,
    "job_parameters": _told,
    "path_safe_runs": _run_folders,
}

ORACLE = {
    "src_inline_rows": f"""select o_orderpriority, count(*) as n_orders, count(d) as n_limited from orders left join (values
    {', '.join(f"('{p}', {'null' if d is None else d})" for p, d in _PRIORITIES)}) a(p, d) on p = o_orderpriority group by 1""",
    "src_catalog_listing": "\nunion all ".join(
        f"select '{n}' as table_name, count(*) as row_count from {n}" for n in ("customer", "orders", "supplier")),
    "table_statistics": "\nunion all ".join(
        f"""select '{n}' as column_name, count(*) as n_rows, count(*) - count({c}) as n_nulls,
    cast(min({c}) as varchar) as min_value, cast(max({c}) as varchar) as max_value from orders"""
        for n, c in (("o_orderkey", "o_orderkey"), ("o_custkey", "o_custkey"), ("order_day", "cast(o_orderdate as date)"))),
    "job_parameters": """select 'events' as table_name, count(*) as n_rows from events
  union all select 'orders', count(*) from orders
    where o_orderdate >= timestamp '1995-12-29 00:00:00' and o_orderdate < timestamp '1996-07-01 00:00:00'""",
    "path_safe_runs": """select 'scheduled__' || strftime(date_trunc('day', ts), '%Y-%m-%dT%H-%M-%S') || 'Z' as run_id, count(*) as n_events
  from events group by 1""",
    "sink_json_partitions": "select c_custkey, c_name, c_acctbal, c_mktsegment from customer",
    "compact_table": """select 'before' as state, count(*) as n_rows, false as fewer_files from events
  union all select 'after', count(*), true from events""",
    "src_delimited_roundtrip": """select cast(s_suppkey as int) as s_suppkey, s_name, s_nationkey, s_acctbal
  from supplier""",
    "src_delimited_schema": """select o_orderkey, o_custkey, o_orderstatus,
  cast(cast(o_totalprice as decimal(15,2)) as double) as o_totalprice, o_orderdate, o_orderpriority from orders""",
    "src_delimited_glob": "select * from part",
    "row_counts": "\nunion all ".join(f"select '{n}' as table_name, count(*) as row_count from {n}" for n in _COUNTED),
    "src_head_n": "select * from orders order by o_totalprice desc, o_orderkey limit 100",
    "src_sql_path": """select o_orderkey, o_totalprice from orders
  where o_orderstatus = 'F' and o_totalprice > 100000""",
    "sink_parquet_roundtrip": "select * from lineitem",
    "sink_layer_copy": "select * from events",
    "sink_dynamic_partition": """select event_id, event_type, user_id, case when event_type = 'error'
  then cast(cast(value as decimal(15,2)) + 1 as double) else value end as value from events""",
    "sink_schema_evolve": """select s_suppkey, s_name, cast(null as varchar) as segment from supplier
  union all select c_custkey, c_name, c_mktsegment from customer""",
    "table_history": f"""select cast(0 as bigint) as version, timestamp '{LOAD_TS}' as committed_at, 'load' as operation,
    count(*) as num_rows, '' as note from customer
  union all select 1, timestamp '{CHANGE_TS}', 'change',
    (select count(*) from customer) + (select count(*) from supplier), ''""",
    "cluster_by_range": "select * from orders",
    "cluster_by_all": "select * from orders",
    "model_part_dim": "select * from part",
}
