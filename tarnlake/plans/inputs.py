"""Input tables, and views standing in for columns the driver tables lack.

Every view exists twice, as a DataFrame and as SQL text for the checking engine,
and always covers the whole table.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from tarnlake.session import STORED_CODEC, freeing, staging, work_path
from tarnlake.sinks.files import write_table

_LAYERS: dict[tuple[str, str, str, str], str] = {}
_SCHEMAS: dict[tuple[str, str], StructType] = {}

SPLIT_TS = "2024-01-16 00:00:00"   # change events before it are the base, the rest the increment


class Tables:
    """Parquet tables of one directory, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def path(self, name: str) -> str:
        return f"{self.dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        return self._read(self.path(name))

    def _read(self, path: str) -> DataFrame:
        """Scan with a known schema: footers are looked at once per state of the tables and not per query."""
        known = (path, self.state)
        if known not in _SCHEMAS:
            _SCHEMAS[known] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[known]).parquet(path)

    @cached_property
    def state(self) -> str:
        """Names, sizes and times of the tables: what was derived from another state is not used again."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.dir)
        found = where.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(where)
        return " ".join(sorted(f"{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}" for f in found))

    def layer(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """Derived table of this directory (a raw view, a dimension, a fact, a feed).

        Layers are stored tables: written to the shared folder when a session first needs
        them, read from there by every query on top. Only inputs are kept this way; what a
        query computes from them runs on every call. What was staged to build a layer goes when it is written.
        """
        key = (self.spark.sparkContext.applicationId, self.dir, self.state, name)
        if key not in _LAYERS:
            path = work_path(self.spark, name, keep=True)       # outlives a staging block it may be asked for in
            with staging(self.spark):
                rows = build()
                with freeing(self.spark):
                    write_table(rows, path, codec=STORED_CODEC, even=False)
            _LAYERS[key] = path
        return self._read(_LAYERS[key])

    @property
    def line_numbered(self) -> DataFrame:
        return self.layer("line_numbered", lambda: line_numbered(self.lineitem))

    @property
    def partsupp(self) -> DataFrame:
        return self.layer("partsupp", lambda: partsupp(self.lineitem))

    @property
    def sales(self) -> DataFrame:
        return self.layer("sales", lambda: sales(line_numbered(self.lineitem), self.orders))


def ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


# Results are also read by clients such as pandas, whose timestamps end in 2262 and whose integers
# become floats beside a NULL. Registered queries show such columns as text, and dates as timestamps.

def end_as_text(query: Callable, sql: str) -> tuple[Callable, str]:
    """Query and SQL with `record_end_date` (9999-12-31 when open) as text."""
    def text() -> Column:
        return F.date_format(F.col("record_end_date").cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS")

    shown = "strftime(record_end_date, '%Y-%m-%d %H:%M:%S.%f') as record_end_date"
    return (
        lambda t: query(t).withColumn("record_end_date", text()),
        f"select * exclude (record_end_date), {shown} from ({sql})",
    )


def _cast(query: Callable, sql: str, spark_type: str, sql_type: str, columns: tuple[str, ...]) -> tuple[Callable, str]:
    shown = ", ".join(f"cast({c} as {sql_type}) as {c}" for c in columns)
    return (
        lambda t: query(t).withColumns({c: F.col(c).cast(spark_type) for c in columns}),
        f"select * exclude ({', '.join(columns)}), {shown} from ({sql})",
    )


def ints_as_text(query: Callable, sql: str, *columns: str) -> tuple[Callable, str]:
    """Query and SQL with nullable integer columns as text."""
    return _cast(query, sql, "string", "varchar", columns)


def days_as_timestamps(query: Callable, sql: str, *columns: str) -> tuple[Callable, str]:
    """Query and SQL with dates as the midnights they start at."""
    return _cast(query, sql, "timestamp_ntz", "timestamp", columns)


# --- line items with commit / receipt dates and ship mode -----------------------------

_MODES = ["MAIL", "SHIP", "AIR", "RAIL", "TRUCK", "FOB"]


def line_ext(lineitem: DataFrame) -> DataFrame:
    n = (F.col("l_orderkey") + F.col("l_linenumber")) % 7
    mode = F.when(n == 0, _MODES[0])
    for i, name in enumerate(_MODES[1:], 1):
        mode = mode.when(n == i, name)
    commit = (F.col("l_orderkey") * 7 + F.col("l_linenumber")).cast("int") % 60 - 30
    return lineitem.select(
        "*",
        (F.col("l_shipdate") + F.make_dt_interval(commit)).alias("l_commitdate"),
        (F.col("l_shipdate") + F.make_dt_interval(1 + (F.col("l_orderkey") % 30).cast("int"))).alias("l_receiptdate"),
        mode.otherwise("REG AIR").alias("l_shipmode"),
    )


LINE_EXT = """(select l.*,
  l_shipdate + to_days(cast(l_orderkey * 7 + l_linenumber as int) % 60 - 30) as l_commitdate,
  l_shipdate + to_days(1 + cast(l_orderkey % 30 as int)) as l_receiptdate,
  case (l_orderkey + l_linenumber) % 7 when 0 then 'MAIL' when 1 then 'SHIP' when 2 then 'AIR'
    when 3 then 'RAIL' when 4 then 'TRUCK' when 5 then 'FOB' else 'REG AIR' end as l_shipmode
  from lineitem l)"""


# --- line items under a unique line number ---------------------------------------------
# The source repeats (order, line) for different sales. The lines of an order are numbered afresh, so
# every sale stays and (order, line) identifies it.

_LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_shipdate",
               "l_returnflag", "l_linestatus"]


def line_numbered(lineitem: DataFrame) -> DataFrame:
    number = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*_LINE_ORDER))
    return lineitem.withColumn("l_linenumber", number.cast(lineitem.schema["l_linenumber"].dataType))


LINE_NUMBERED = f"""(select * replace (cast(row_number() over (
  partition by l_orderkey order by {', '.join(_LINE_ORDER)}) as int) as l_linenumber) from lineitem)"""


# --- part suppliers: the pairs seen in line items ------------------------------------

def partsupp(lineitem: DataFrame) -> DataFrame:
    unit = F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity")) / 100
    return lineitem.groupBy(F.col("l_partkey").alias("ps_partkey"), F.col("l_suppkey").alias("ps_suppkey")).agg(
        F.sum("l_quantity").cast("int").alias("ps_availqty"), F.min(unit).alias("ps_supplycost")
    )


PARTSUPP = """(select l_partkey as ps_partkey, l_suppkey as ps_suppkey,
  cast(sum(l_quantity) as int) as ps_availqty, min(floor(l_extendedprice * 100 / l_quantity) / 100) as ps_supplycost
  from lineitem group by 1, 2)"""


# --- change log from events ----------------------------------------------------------

def change_log(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return events.select(
        F.col("event_id").alias("lsn"),
        F.col("user_id").alias("id"),
        F.when(kind == "error", "d").when(kind == "signup", "c").when(kind == "view", "r").otherwise("u").alias("op"),
        kind.alias("state"),
        F.col("value").alias("amount"),
        F.col("ts").alias("event_ts"),
    )


CHANGE_LOG = """(select event_id as lsn, user_id as id,
  case event_type when 'error' then 'd' when 'signup' then 'c' when 'view' then 'r' else 'u' end as op,
  event_type as state, value as amount, ts as event_ts from events)"""


def base_changes(events: DataFrame) -> DataFrame:
    return change_log(events).filter(F.col("event_ts") < ts(SPLIT_TS))


def new_changes(events: DataFrame) -> DataFrame:
    return change_log(events).filter(F.col("event_ts") >= ts(SPLIT_TS))


BASE_CHANGES = f"(select * from {CHANGE_LOG} where event_ts < timestamp '{SPLIT_TS}')"
NEW_CHANGES = f"(select * from {CHANGE_LOG} where event_ts >= timestamp '{SPLIT_TS}')"


# --- two snapshots of the customer table ---------------------------------------------
# The later one: BUILDING customers were credited 100, and every supplier became a
# customer (under a negative key, so keys never meet).

CUSTOMER_FIELDS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
LOAD_TS, CHANGE_TS = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def customer_next(customer: DataFrame, supplier: DataFrame) -> DataFrame:
    credited = F.when(F.col("c_mktsegment") == "BUILDING", money_plus("c_acctbal", 100)).otherwise(F.col("c_acctbal"))
    return customer.select(*CUSTOMER_FIELDS).withColumn("c_acctbal", credited).unionByName(new_customers(supplier))


def money_plus(column: str, amount: int):
    return (F.col(column).cast("decimal(15,2)") + F.lit(amount)).cast("double")


def new_customers(supplier: DataFrame) -> DataFrame:
    return supplier.select(
        (-1 - F.col("s_suppkey")).alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal"),
        F.lit("MACHINERY").alias("c_mktsegment"),
    )


def customer_changes(customer: DataFrame, supplier: DataFrame) -> DataFrame:
    """Only the rows that changed, with their event time."""
    credited = customer.filter(F.col("c_mktsegment") == "BUILDING").select(*CUSTOMER_FIELDS)
    return credited.withColumn("c_acctbal", money_plus("c_acctbal", 100)).unionByName(
        new_customers(supplier)
    ).withColumn("event_ts", ts(CHANGE_TS))


CUSTOMER_NEXT = """(select c_custkey, c_name, c_nationkey,
  case when c_mktsegment = 'BUILDING' then cast(cast(c_acctbal as decimal(15,2)) + 100 as double) else c_acctbal end
    as c_acctbal, c_mktsegment from customer
  union all select -1 - s_suppkey, s_name, s_nationkey, s_acctbal, 'MACHINERY' from supplier)"""


# --- sales: line items with the day they were ordered, before and after a change --------

_RETURNS_FROM, _RECOUNT_FROM, _NEW_FROM = "2001-01-01", "2001-03-01", "2001-06-01"
SALES_KEY = ["order_id", "line_id"]
SALES_LOAD_TS, SALES_CHANGE_TS = "2001-06-01 00:00:00", "2001-12-01 00:00:00"


def sales(lines: DataFrame, orders: DataFrame) -> DataFrame:
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_id"),
        F.col("l_partkey").alias("product_id"), F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("l_quantity").cast("decimal(15,2)").alias("qty"),
        F.col("l_shipdate").alias("ship_ts"), F.col("l_returnflag").alias("return_flag"),
        F.col("o_orderstatus").alias("order_state"),
    )


SALES = f"""(select l_orderkey as order_id, l_linenumber as line_id, l_partkey as product_id,
  cast(o_orderdate as date) as order_date, cast(l_quantity as decimal(15,2)) as qty, l_shipdate as ship_ts,
  l_returnflag as return_flag, o_orderstatus as order_state
  from {LINE_NUMBERED} l join orders on l_orderkey = o_orderkey)"""

_SALES_FIELDS = "order_id, line_id, product_id, order_date, qty"


def sales_before(all_sales: DataFrame) -> DataFrame:
    """Lines shipped before June 2001."""
    return all_sales.filter(F.col("ship_ts") < ts(_NEW_FROM)).select(*_SALES_FIELDS.split(", "))


def sales_after(all_sales: DataFrame) -> DataFrame:
    """Later lines added, returned ones of 2001 gone, spring lines recounted, pending orders moved a day."""
    shipped = F.col("ship_ts")
    returned = (F.col("return_flag") == "R") & (shipped >= ts(_RETURNS_FROM)) & (shipped < ts(_NEW_FROM))
    recounted = (shipped >= ts(_RECOUNT_FROM)) & (shipped < ts(_NEW_FROM))
    moved = (F.col("order_state") == "P") & (shipped >= ts(_RETURNS_FROM))
    return all_sales.filter(~returned).select(
        "order_id", "line_id", "product_id",
        F.when(moved, F.date_add("order_date", 1)).otherwise(F.col("order_date")).alias("order_date"),
        F.when(recounted, F.col("qty") + 1).otherwise(F.col("qty")).cast("decimal(15,2)").alias("qty"),
    )


SALES_BEFORE = f"(select {_SALES_FIELDS} from {SALES} where ship_ts < timestamp '{_NEW_FROM} 00:00:00')"
SALES_AFTER = f"""(select order_id, line_id, product_id,
  case when order_state = 'P' and ship_ts >= timestamp '{_RETURNS_FROM} 00:00:00'
    then cast(order_date + 1 as date) else order_date end as order_date,
  cast(case when ship_ts >= timestamp '{_RECOUNT_FROM} 00:00:00' and ship_ts < timestamp '{_NEW_FROM} 00:00:00'
    then qty + 1 else qty end as decimal(15,2)) as qty
  from {SALES} where not (return_flag = 'R' and ship_ts >= timestamp '{_RETURNS_FROM} 00:00:00'
    and ship_ts < timestamp '{_NEW_FROM} 00:00:00'))"""
