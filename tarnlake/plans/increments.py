"""Incremental maintenance from stored versions: bounds, change feed, net changes, history."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tarnlake.operators import calendar, changefeed, incremental, scd2
from tarnlake.operators.merge import Delete, Insert, Update, all_columns
from tarnlake.plans.inputs import Tables, days_as_timestamps, end_as_text, ts
from tarnlake.session import staged, work_path
from tarnlake.sinks import files as sinks
from tarnlake.sources import snapshots

KEY, TRACKED = ["s_suppkey"], ["s_name", "s_nationkey", "s_acctbal"]
COMMIT = "record_commit_timestamp"
_TIMES = [datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)]
_NATION, _THIRD, _CLOSED, _BACK = 3, 3, 7, 14


def _plus(column: F.Column, amount: int) -> F.Column:
    return (column.cast("decimal(15,2)") + amount).cast("double")


def _versions(t: Tables) -> str:
    """Three stored versions of the suppliers: as they are; even ones credited, every seventh closed and some opened anew; then every third
    charged and half of the closed ones back."""
    path = work_path(t.spark, "supplier-versions")
    first = t.supplier.select(*KEY, *TRACKED)
    snapshots.write(first, path, "load", _TIMES[0])
    key, balance = F.col("source.s_suppkey"), F.col("target.s_acctbal")
    opened = first.filter(F.col("s_nationkey") == _NATION).withColumn("s_suppkey", -1 - F.col("s_suppkey"))
    snapshots.merge(
        t.spark, path, first.unionByName(opened), KEY, "merge", _TIMES[1],
        matched=[Delete(when=key % _CLOSED == 0), Update({"s_acctbal": _plus(balance, 100)}, when=key % 2 == 0)],
        not_matched=[Insert(all_columns(first))], unique_source=True)
    snapshots.merge(
        t.spark, path, first.filter(F.col("s_suppkey") % _BACK == 0).unionByName(
            snapshots.read(t.spark, path).filter(F.col("s_suppkey") % _THIRD == 0)), KEY, "merge", _TIMES[2],
        matched=[Update({"s_acctbal": _plus(balance, -50)})], not_matched=[Insert(all_columns(first))], unique_source=True)
    return path


def advance(t: Tables, dim_path: str, path: str, interval_end: datetime) -> bool:
    """One incremental run over what was committed since the last one, up to the end of the interval; was there anything?

    The dimension's own commit notes the last version it holds. Bounds come from the commit list, so a run that finds
    nothing new reads no version, and one that does reads the change rows of the new versions alone.
    """
    done = snapshots.last(t.spark, dim_path)
    processed = t.spark.range(1).select(ts(str(done["committed_at"])).alias("last_processed_ts"))
    bounds = incremental.bounds(snapshots.feed_bounds(t.spark, path), processed, F.lit(str(interval_end))).first()
    due = [] if bounds["end_ts"] is None else snapshots.versions_between(
        t.spark, path, bounds["start_ts"], bounds["end_ts"], after=int(done["note"]))
    if not due:
        return False
    net = changefeed.net_changes(snapshots.changes(t.spark, path, due[0], due[-1]), KEY)
    net = staged(net.select(*KEY, *TRACKED, changefeed.TYPE, changefeed.COMMITTED), "net-changes")
    dim = scd2.apply_changes(snapshots.read(t.spark, dim_path), net, KEY, TRACKED, changefeed.COMMITTED, changefeed.COMMITTED,
                             deleted=F.col(changefeed.TYPE) == "delete")
    snapshots.write(dim, dim_path, "apply", bounds["end_ts"], note=str(due[-1]))
    return True


def incr_dim_supplier(t: Tables) -> DataFrame:
    """Supplier history kept by three runs over stored versions; the last one finds nothing new."""
    path, dim_path = _versions(t), work_path(t.spark, "dim-supplier")
    first = scd2.as_dimension(snapshots.read(t.spark, path, 0), ts(str(_TIMES[0])))
    snapshots.write(first.withColumn(COMMIT, ts(str(_TIMES[0]))), dim_path, "load", _TIMES[0], note="0")
    for end in (datetime(2024, 2, 15), datetime(2024, 4, 1), datetime(2024, 5, 1)):
        advance(t, dim_path, path, end)
    return snapshots.read(t.spark, dim_path)


def feed_of_versions(t: Tables) -> DataFrame:
    """Change feed of stored versions 1 and 2, as their writers left it."""
    return snapshots.changes(t.spark, _versions(t), 1, 2)


def append_model(t: Tables) -> DataFrame:
    """INSERT INTO ... SELECT: a model's rows appended to a stored table in two loads."""
    path = work_path(t.spark, "part-model")
    for load, kind in enumerate(("<= 25", "> 25")):
        rows = t.part.filter(f"p_size {kind}").select("p_partkey", "p_brand", "p_size").withColumn("load_id", F.lit(load))
        sinks.append_table(rows, path)
    return t.spark.read.parquet(path)


def orders_by_calendar(t: Tables) -> DataFrame:
    """Orders placed on each day of the full calendar, 1990 to 2020, days without orders included."""
    placed = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("sk_datekey")).agg(F.count(F.lit(1)).alias("n_orders"))
    return calendar.calendar(t.spark).join(placed, "sk_datekey", "left").select(
        "sk_datekey", "year", "month_name", "week_of_year", "date_id", F.coalesce("n_orders", F.lit(0)).alias("n_orders"))


QUERIES = {
    "incr_dim_supplier": incr_dim_supplier,
    "cdf_of_versions": feed_of_versions,
    "append_model": append_model,
    "orders_by_calendar": orders_by_calendar,
}

_BASE = "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier"


def _moved(amount: int) -> str:
    return f"cast(cast(s_acctbal as decimal(15,2)) + {amount} as double)"


_V1 = f"""(select s_suppkey, s_name, s_nationkey, case when s_suppkey % 2 = 0 then {_moved(100)} else s_acctbal end as s_acctbal
  from supplier where s_suppkey % {_CLOSED} <> 0
  union all select -1 - s_suppkey, s_name, s_nationkey, s_acctbal from supplier where s_nationkey = {_NATION})"""
_V2 = f"""(select s_suppkey, s_name, s_nationkey, case when s_suppkey % {_THIRD} = 0 then {_moved(-50)} else s_acctbal end as s_acctbal
  from {_V1} union all {_BASE} where s_suppkey % {_BACK} = 0)"""
_T = [f"timestamp '{at}'" for at in _TIMES]


def _feed_sql(old: str, new: str, version: int) -> str:
    same = " and ".join(f"n.{c} is not distinct from o.{c}" for c in TRACKED)
    tail = f"{version}::bigint as _commit_version, {_T[version]} as _commit_timestamp"
    return f"""select n.*, case when o.s_suppkey is null then 'insert' else 'update_postimage' end as _change_type, {tail}
  from {new} n left join {old} o using (s_suppkey) where o.s_suppkey is null or not ({same})
  union all select o.*, 'update_preimage', {tail} from {new} n join {old} o using (s_suppkey) where not ({same})
  union all select o.*, 'delete', {tail} from {old} o where s_suppkey not in (select s_suppkey from {new})"""


_OPEN = f"timestamp '{scd2.OPEN_END}'"
# what holds of each key at each of the three moments, and the moments at which that changes
_ALL = f"""(select *, 0 as i from ({_BASE}) union all select *, 1 from {_V1} union all select *, 2 from {_V2})"""
_GRID = f"""(select k.s_suppkey, m.i, m.moment, a.s_name, a.s_nationkey, a.s_acctbal, a.s_suppkey is not null as held
  from (select distinct s_suppkey from {_ALL}) k cross join (values (0, {_T[0]}), (1, {_T[1]}), (2, {_T[2]})) m(i, moment)
  left join {_ALL} a on a.s_suppkey = k.s_suppkey and a.i = m.i)"""
_POINTS = f"""(select * from (select *, lag(s_acctbal) over w as was, coalesce(lag(held) over w, false) as was_held from {_GRID}
  window w as (partition by s_suppkey order by i)) where held <> was_held or (held and was is distinct from s_acctbal))"""
ORACLE = {
    "cdf_of_versions": f"{_feed_sql(f'({_BASE})', _V1, 1)} union all {_feed_sql(_V1, _V2, 2)}",
    # closing a version stamps it with the commit that closed it
    "incr_dim_supplier": f"""select * exclude (held) from (
  select s_suppkey, s_name, s_nationkey, s_acctbal, held, lead(moment) over w is null as record_active_flag,
    moment as record_start_date, coalesce(lead(moment) over w, {_OPEN}) as record_end_date,
    coalesce(lead(moment) over w, moment) as record_commit_timestamp
  from {_POINTS} window w as (partition by s_suppkey order by moment)) where held""",
    "append_model": "select p_partkey, p_brand, p_size, case when p_size <= 25 then 0 else 1 end as load_id from part",
    "orders_by_calendar": """select cast(d as date) as sk_datekey, cast(year(d) as int) as "year", strftime(d, '%B') as month_name,
    cast(weekofyear(d) as int) as week_of_year, cast(strftime(d, '%Y%m%d') as int) as date_id, coalesce(n, 0) as n_orders
  from (select unnest(generate_series(timestamp '1990-01-01', timestamp '2020-12-31', interval 1 day)) as d)
  left join (select cast(o_orderdate as date) as day, count(*) as n from orders group by 1) on day = cast(d as date)""",
}
QUERIES["incr_dim_supplier"], ORACLE["incr_dim_supplier"] = end_as_text(QUERIES["incr_dim_supplier"], ORACLE["incr_dim_supplier"])
QUERIES["orders_by_calendar"], ORACLE["orders_by_calendar"] = days_as_timestamps(
    QUERIES["orders_by_calendar"], ORACLE["orders_by_calendar"], "sk_datekey")
