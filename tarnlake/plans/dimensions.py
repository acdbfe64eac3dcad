"""Type-2 history: applying snapshots, change batches and event logs to dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tarnlake.functions import row_hash
from tarnlake.operators import asof, calendar, cdc, maintain, scd2, surrogate
from tarnlake.operators.quality import complete, contained_in, unique, write_audit_publish
from tarnlake.plans.inputs import (
    BASE_CHANGES, CHANGE_LOG, CHANGE_TS, CUSTOMER_FIELDS, CUSTOMER_NEXT, LOAD_TS, NEW_CHANGES, PARTSUPP, Tables,
    base_changes, change_log, customer_changes, customer_next, days_as_timestamps, end_as_text, ints_as_text,
    new_changes, partsupp, ts,
)
from tarnlake.session import staged, work_path
from tarnlake.sources.files import null_rows

TRACKED = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def existing(t: Tables) -> DataFrame:
    """The customer dimension as its first load left it."""
    return t.layer("dim_existing", lambda: first_load(t))


def first_load(t: Tables) -> DataFrame:
    """Customer dimension after its first load, with surrogate keys in key order."""
    rows = t.customer.select(*CUSTOMER_FIELDS)
    numbered = surrogate.assign(rows, "sk_custkey", ["c_custkey"])
    return scd2.as_dimension(numbered, ts(LOAD_TS))


def _next(t: Tables) -> DataFrame:
    return customer_next(t.customer, t.supplier)


def _applied(t: Tables) -> DataFrame:
    return scd2.apply_snapshot(existing(t).drop("sk_custkey"), _next(t), ["c_custkey"], TRACKED, ts(CHANGE_TS))


def _applied_batch(t: Tables) -> DataFrame:
    """The same outcome from the changed rows alone."""
    changes = customer_changes(t.customer, t.supplier)
    return scd2.apply_changes(existing(t).drop("sk_custkey"), changes, ["c_custkey"], TRACKED, "event_ts")


def state_versions(log: DataFrame) -> DataFrame:
    """Versions of `state` per id; a delete closes the version before it."""
    return scd2.history(log, ["id"], "lsn", ["state"], "event_ts", F.col("op") == "d")


def _full_versions(log: DataFrame) -> DataFrame:
    """Versions of (state, amount) per id; a delete closes the version before it."""
    return scd2.history(
        log, ["id"], "lsn", ["state", "amount"], "event_ts", F.col("op") == "d"
    )


def _event_time(t: Tables) -> DataFrame:
    """Versions built from the base log, then each id's newest later event, deletes among them, as one change batch."""
    dim = t.layer("state_versions_base", lambda: state_versions(base_changes(t.events)).select(
        "id", "state", scd2.ACTIVE, scd2.START, scd2.END, F.col(scd2.START).alias("record_commit_timestamp")
    ))
    changes = cdc.latest_changes(new_changes(t.events), ["id"], ["lsn"])
    return scd2.apply_changes(
        dim, changes.withColumn("committed", ts("2024-02-01 00:00:00")), ["id"], ["state"], "event_ts", "committed",
        deleted=F.col("op") == "d",
    )


def _arrived(t: Tables, *turns: int) -> DataFrame:
    """The part of the log that arrives in some of three turns: every third event each."""
    return change_log(t.events).filter((F.col("lsn") % 3).isin(*turns))


_SPLICED = {"keys": ["id"], "sequence": "lsn", "event_ts": "event_ts"}


def _splice(t: Tables) -> DataFrame:
    """History of (state, amount) from three interleaved batches, the last third first."""
    how = {**_SPLICED, "tracked": ["state", "amount"], "deleted": F.col("op") == "d"}
    dim = staged(scd2.timeline(_arrived(t, 2), **how), "timeline")
    for turn in (0, 1):
        dim = staged(scd2.splice(dim, _arrived(t, turn), **how), "timeline")
    return scd2.versions(dim).select("id", "lsn", "op", "state", "amount", scd2.ACTIVE, scd2.START, scd2.END)


def _repinned(t: Tables) -> DataFrame:
    """Events pinned to the versions known when two thirds of the log had come, then again where the last third changed them."""
    how = {**_SPLICED, "tracked": ["state"], "deleted": F.col("op") == "d"}
    old = t.layer("state_timeline", lambda: scd2.timeline(_arrived(t, 0, 1), **how))
    facts = t.layer("fact_two_thirds", lambda: _pin(t, scd2.versions(old)))
    late = _arrived(t, 2)
    new = staged(scd2.splice(old, late, **how), "timeline")
    touched = late.select("id").distinct()
    spans = staged(scd2.changed_spans(*(
        scd2.versions(dim.join(touched, "id", "left_semi")).select("id", "state", "lsn", scd2.START, scd2.END) for dim in (old, new)), ["id"]), "spans")
    return asof.repin(facts, spans.withColumnRenamed("id", "user_id"), _named(scd2.versions(new)), ["user_id"], "ts", scd2.START, scd2.END,
                      ["version_state", "version_lsn"])


def _event_batch(t: Tables) -> DataFrame:
    """A mixed batch of inserts, updates and deletes: touched ids are rebuilt from the retained log."""
    log, batch = base_changes(t.events), new_changes(t.events)
    touched = batch.select("id").distinct()
    full = staged(log.join(touched, ["id"], "left_semi").unionByName(batch), "touched-log")
    return scd2.rebuild_touched(_versions_base(t), touched, ["id"], _full_versions(full))


def _versions_base(t: Tables) -> DataFrame:
    return t.layer("versions_base", lambda: _full_versions(base_changes(t.events)))


def _bridge_versions(t: Tables) -> DataFrame:
    """Part-supplier bridge: offers known before 2000, then all offers, on a composite key."""
    early = t.lineitem.filter(F.col("l_shipdate") < ts("2000-01-01 00:00:00"))
    old = t.layer("partsupp_early", lambda: scd2.as_dimension(partsupp(early), ts(LOAD_TS)))
    return scd2.apply_snapshot(
        old, t.partsupp, ["ps_partkey", "ps_suppkey"], ["ps_availqty", "ps_supplycost"], ts(CHANGE_TS)
    )


def _surrogates(t: Tables) -> DataFrame:
    fresh = _next(t).join(t.customer, ["c_custkey"], "left_anti").select("c_custkey", "c_name")
    return surrogate.assign(
        fresh, "sk_custkey", ["c_custkey"], existing(t)
    )


def _stable(t: Tables) -> DataFrame:
    """Numbers of three loads of customers, the third a repetition of the first: keys keep theirs, new ones get the next."""
    path = work_path(t.spark, "customer-keys")
    loads = [t.customer.filter(F.col("c_nationkey") < 12), _next(t), t.customer.filter(F.col("c_nationkey") < 12)]
    return reduce(DataFrame.unionByName, [
        surrogate.assign_stable(rows.select("c_custkey", "c_name"), "sk_custkey", ["c_custkey"], path).withColumn("load_id", F.lit(i))
        for i, rows in enumerate(loads)])


def _hash_changed(t: Tables) -> DataFrame:
    old = t.customer.select("c_custkey", row_hash(TRACKED).alias("old_hash"))
    new = _next(t).select("c_custkey", row_hash(TRACKED).alias("new_hash"))
    return old.join(new, "c_custkey").filter(F.col("old_hash") != F.col("new_hash")).select("c_custkey")


def _published(t: Tables) -> DataFrame:
    return scd2.publish(t.layer("dim_stage", lambda: _stage(t)), existing(t), "sk_custkey")


def _stage(t: Tables) -> DataFrame:
    """Stage dimension after the change batch, its new versions numbered after the old ones."""
    applied = t.layer("dim_applied", lambda: scd2.apply_changes(
        existing(t), customer_changes(t.customer, t.supplier), ["c_custkey"], TRACKED, "event_ts"
    ))
    fresh = surrogate.assign(
        applied.filter(F.col("sk_custkey").isNull()).drop("sk_custkey"), "sk_custkey", ["c_custkey"],
        existing(t),
    )
    return applied.filter(F.col("sk_custkey").isNotNull()).unionByName(fresh)


def _wap_order_dim(t: Tables) -> DataFrame:
    built = scd2.as_dimension(
        t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"), ts(LOAD_TS)
    )
    checks = [unique("o_orderkey"), complete("o_orderstatus"), contained_in("o_orderstatus", ["O", "F", "P"])]
    return write_audit_publish(built, checks, scd2.current, "order_dim")


def _null_start(t: Tables) -> DataFrame:
    """Customers without a dimension row show a NULL start date; the first hundred by key."""
    dim = scd2.current(existing(t)).select("c_custkey", scd2.START)
    rows = _next(t).select("c_custkey", "c_name").join(dim, ["c_custkey"], "left")
    return null_rows(rows, scd2.START).orderBy("c_custkey").limit(100)


_SCHEMA = "c_custkey bigint, c_name string, c_address string, c_acctbal decimal(15,2), c_nationkey bigint"


def _evolved(t: Tables) -> DataFrame:
    wider = maintain.add_column(t.customer, "c_tier", F.when(F.col("c_acctbal") > 5000, "gold").otherwise("plain"),
                                after="c_name")
    return maintain.drop_columns(wider, "c_mktsegment")


def _named(versions: DataFrame) -> DataFrame:
    return versions.select(
        F.col("id").alias("user_id"), F.col("state").alias("version_state"), F.col("lsn").alias("version_lsn"),
        scd2.START, scd2.END,
    )


def _pin(t: Tables, versions: DataFrame, join=asof.point_in_time_join) -> DataFrame:
    events = t.events.select("event_id", "user_id", "ts", "event_type")
    return join(events, _named(versions), ["user_id"], "ts", scd2.START, scd2.END, ["version_state", "version_lsn"])


def _pit(t: Tables, join=asof.point_in_time_join) -> DataFrame:
    return _pin(t, _state_dim(t), join)


def _state_dim(t: Tables) -> DataFrame:
    """All versions of each id's state, with surrogate keys."""
    return t.layer("dim_state", lambda: surrogate.assign(
        state_versions(change_log(t.events)), "state_sk", ["lsn"]
    ))


def _facts(t: Tables) -> DataFrame:
    """Events pinned to the version valid when they happened."""
    return asof.point_in_time_join(
        t.events.select("event_id", F.col("user_id").alias("id"), "ts"), _state_dim(t), ["id"], "ts",
        scd2.START, scd2.END, ["state_sk"],
    ).drop("id")


def _pinned(t: Tables) -> DataFrame:
    return asof.pinned_and_latest(t.layer("fact_events", lambda: _facts(t)), _state_dim(t), "state_sk", "id", "state")


QUERIES = {
    "scd2_current": lambda t: scd2.current(_applied(t)),
    "scd2_changed_keys": lambda t: scd2.changed_rows(existing(t), _next(t), ["c_custkey"], TRACKED),
    "scd2_staged_rows": lambda t: scd2.staged_rows(existing(t), _next(t), ["c_custkey"], TRACKED),
    "scd2_apply": _applied,
    "scd2_apply_batch": _applied_batch,
    "scd2_apply_event_time": _event_time,
    "scd2_apply_composite": _bridge_versions,
    "scd2_splice": _splice,
    "scd2_apply_events": _event_batch,
    "scd2_history": lambda t: _full_versions(change_log(t.events)),
    "scd2_rank_versions": lambda t: scd2.rank_versions(
        change_log(t.events).select("id", "lsn", "state"), ["id"], "lsn"
    ),
    "anti_unseen_versions": lambda t: scd2.unseen_versions(
        new_changes(t.events), _versions_base(t), ["id"], ["state", "amount"]
    ),
    "dim_first_load": first_load,
    "surrogate_keys": _surrogates,
    "surrogate_stable": _stable,
    "row_hash_changed": _hash_changed,
    "evolve_columns": _evolved,
    "conform_schema": lambda t: maintain.conform(
        t.customer.select("c_custkey", "c_name", "c_acctbal", "c_nationkey"), _SCHEMA
    ).withColumn("c_acctbal", F.col("c_acctbal").cast("double")),
    "publish_dim": _published,
    "wap_order_dim": _wap_order_dim,
    "null_start_rows": _null_start,
    "date_dim": lambda t: calendar.calendar_of(t.orders, "o_orderdate"),
    "pit_join_left": lambda t: _pit(t),
    "pit_join_interval": lambda t: _pit(t, asof.interval_join),
    "pit_pinned_vs_latest": _pinned,
    "repin_facts": _repinned,
}

_OPEN = f"timestamp '{scd2.OPEN_END}'"
_FIELDS = ", ".join(CUSTOMER_FIELDS)
_CHANGED = " or ".join(f"c.{x} is distinct from n.{x}" for x in TRACKED)
_KEYS_CHANGED = f"(select n.* from {CUSTOMER_NEXT} n join customer c using (c_custkey) where {_CHANGED})"
_FRESH = f"(select * from {CUSTOMER_NEXT} where c_custkey not in (select c_custkey from customer))"
_SK = "(select *, row_number() over (order by c_custkey) as sk_custkey from customer)"


def _kept(source: str, extra: str = "") -> str:
    """Versions of the first load, closed where the customer changed."""
    changed = f"c_custkey in (select c_custkey from {_KEYS_CHANGED})"
    return f"""select {_FIELDS}{extra}, not ({changed}) as record_active_flag,
    timestamp '{LOAD_TS}' as record_start_date,
    case when {changed} then timestamp '{CHANGE_TS}' else {_OPEN} end as record_end_date from {source}"""


_OPENED = f"(select * from {_KEYS_CHANGED} union all select * from {_FRESH})"
_DIM = f"""({_kept('customer')}
  union all select {_FIELDS}, true, timestamp '{CHANGE_TS}', {_OPEN} from {_OPENED})"""
_DIM_SK = f"""({_kept(_SK, ', sk_custkey')}
  union all select {_FIELDS}, (select count(*) from customer) + row_number() over (order by c_custkey), true,
    timestamp '{CHANGE_TS}', {_OPEN} from {_OPENED})"""


def history_sql(log: str, tracked: list[str]) -> str:
    gone = "op = 'd'"
    same = " and ".join(f"lag({c}) over w is not distinct from {c}" for c in tracked)
    return f"""(select * exclude (gone, was_gone, same_as_before, first_of_key),
    lead(event_ts) over v is null as record_active_flag, event_ts as record_start_date,
    coalesce(lead(event_ts) over v, {_OPEN}) as record_end_date, gone
  from (select *, {gone} as gone, lag({gone}) over w as was_gone, {same} as same_as_before,
      lag(lsn) over w is null as first_of_key from {log} window w as (partition by id order by lsn))
  where (gone and not coalesce(was_gone, true)) or (not gone and (first_of_key or was_gone or not same_as_before))
  window v as (partition by id order by lsn))"""


_FULL = history_sql(CHANGE_LOG, ["state", "amount"])
_STATES = history_sql(CHANGE_LOG, ["state"])
_BASE_STATES = history_sql(BASE_CHANGES, ["state"])
_BASE_FULL = history_sql(BASE_CHANGES, ["state", "amount"])
_LAST = f"""(select * from (select *, row_number() over (partition by id order by lsn desc) as rn
    from {NEW_CHANGES}) where rn = 1)"""
_OLD_OFFERS = PARTSUPP.replace("from lineitem", "from lineitem where l_shipdate < timestamp '2000-01-01 00:00:00'")
_OFFER_SAME = "o.ps_availqty is not distinct from n.ps_availqty and o.ps_supplycost is not distinct from n.ps_supplycost"
_PIT = f"""select event_id, user_id, ts, event_type, v.state as version_state, v.lsn as version_lsn
  from events e left join (select * from {_STATES} where not gone) v
    on v.id = e.user_id and e.ts >= v.record_start_date and e.ts < v.record_end_date"""
_STATE_SK = f"(select *, row_number() over (order by lsn) as state_sk from {_STATES} where not gone)"

ORACLE = {
    "scd2_current": f"select * from {_DIM} where record_active_flag",
    "scd2_changed_keys": f"select * from {_KEYS_CHANGED}",
    "scd2_staged_rows": f"""select *, 'insert' as merge_action from {_FRESH}
  union all select *, unnest(['close', 'insert']) from {_KEYS_CHANGED}""",
    "scd2_apply": f"select * from {_DIM}",
    "scd2_apply_batch": f"select * from {_DIM}",
    "scd2_apply_event_time": f"""with dim as (select * from {_BASE_STATES} where not gone), late as (
    select n.*, d.id is not null as known from {_LAST} n left join (select * from dim where record_active_flag) d on d.id = n.id
      left join (select id, max(record_end_date) as last_end from dim where not record_active_flag group by id) c on c.id = n.id
      where (d.id is null and n.op <> 'd' and coalesce(n.event_ts >= c.last_end, true))
        or (n.event_ts > d.record_start_date and (n.op = 'd' or n.state <> d.state)))
  select d.id, d.state, d.record_active_flag and c.id is null as record_active_flag, d.record_start_date,
    case when d.record_active_flag and c.id is not null then c.event_ts else d.record_end_date end as record_end_date,
    case when d.record_active_flag and c.id is not null then timestamp '2024-02-01 00:00:00'
      else d.record_start_date end as record_commit_timestamp
  from dim d left join late c on c.id = d.id and c.known
  union all select id, state, true, event_ts, {_OPEN}, timestamp '2024-02-01 00:00:00' from late where op <> 'd'""",
    "scd2_splice": f"""select id, lsn, op, state, amount, record_active_flag, record_start_date, record_end_date
  from {_FULL} where not gone""",
    "scd2_apply_composite": f"""with o as (select * from {_OLD_OFFERS}), n as (select * from {PARTSUPP})
  select o.*, coalesce({_OFFER_SAME}, true) as record_active_flag, timestamp '{LOAD_TS}' as record_start_date,
    case when n.ps_partkey is null or ({_OFFER_SAME}) then {_OPEN} else timestamp '{CHANGE_TS}' end as record_end_date
  from o left join n on o.ps_partkey = n.ps_partkey and o.ps_suppkey = n.ps_suppkey
  union all select n.*, true, timestamp '{CHANGE_TS}', {_OPEN} from n left join o
    on o.ps_partkey = n.ps_partkey and o.ps_suppkey = n.ps_suppkey where o.ps_partkey is null or not ({_OFFER_SAME})""",
    "scd2_apply_events": f"select * exclude (gone) from {_FULL} where not gone",
    "scd2_history": f"select * exclude (gone) from {_FULL} where not gone",
    "scd2_rank_versions": f"""select id, lsn, state, row_number() over (partition by id order by lsn desc) as version_rank,
  row_number() over (partition by id order by lsn desc) = 1 as record_active_flag from {CHANGE_LOG}""",
    "anti_unseen_versions": f"""select * from {NEW_CHANGES} e where not exists (select 1
  from {_BASE_FULL} d where not gone and d.id = e.id and d.state is not distinct from e.state
    and d.amount is not distinct from e.amount)""",
    "dim_first_load": f"""select {_FIELDS}, sk_custkey, true as record_active_flag,
  timestamp '{LOAD_TS}' as record_start_date, {_OPEN} as record_end_date from {_SK}""",
    "surrogate_keys": f"""select c_custkey, c_name, (select count(*) from customer)
  + row_number() over (order by c_custkey) as sk_custkey from {_FRESH}""",
    "surrogate_stable": f"""with one as (select c_custkey, c_name from customer where c_nationkey < 12), two as (select c_custkey, c_name from {CUSTOMER_NEXT}),
  numbers as (select c_custkey, row_number() over (order by c_custkey) as sk_custkey from one
    union all select c_custkey, (select count(*) from one) + row_number() over (order by c_custkey) from two
      where c_custkey not in (select c_custkey from one))
  select l.*, sk_custkey from (select *, 0 as load_id from one union all select *, 1 from two union all select *, 2 from one) l
    join numbers using (c_custkey)""",
    "row_hash_changed": f"select c_custkey from {_KEYS_CHANGED}",
    "evolve_columns": """select c_custkey, c_name, case when c_acctbal > 5000 then 'gold' else 'plain' end as c_tier,
  c_nationkey, c_acctbal from customer""",
    "conform_schema": """select c_custkey, c_name, cast(null as varchar) as c_address,
  cast(cast(c_acctbal as decimal(15,2)) as double) as c_acctbal, cast(c_nationkey as bigint) as c_nationkey
  from customer""",
    "publish_dim": f"select * from {_DIM_SK}",
    "wap_order_dim": f"""select o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
  true as record_active_flag, timestamp '{LOAD_TS}' as record_start_date, {_OPEN} as record_end_date from orders""",
    "null_start_rows": f"""select c_custkey, c_name, cast(null as timestamp) as record_start_date from {_FRESH}
  order by c_custkey limit 100""",
    "date_dim": """select cast(d as date) as sk_datekey, cast(year(d) as int) as "year", cast(month(d) as int) as "month",
  strftime(d, '%B') as month_name, cast(dayofweek(d) + 1 as int) as day_of_week, strftime(d, '%A') as day_name_long,
  strftime(d, '%a') as day_name_short, cast(weekofyear(d) as int) as week_of_year, cast(quarter(d) as int) as "quarter",
  cast(strftime(d, '%Y%m%d') as int) as date_id
  from (select unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day)) as d from orders)""",
    "pit_join_left": _PIT,
    "pit_join_interval": _PIT,
    "repin_facts": _PIT,
    "pit_pinned_vs_latest": f"""with dim as (select * from {_STATE_SK}),
  f as (select event_id, ts, state_sk from events e join dim v
    on v.id = e.user_id and e.ts >= v.record_start_date and e.ts < v.record_end_date)
  select f.event_id, f.ts, f.state_sk, d.id, d.state as state_pinned, l.state_sk as state_sk_latest,
    l.state as state_latest from f join dim d using (state_sk) join dim l on l.id = d.id and l.record_active_flag""",
}

for _name in ("scd2_current", "scd2_apply", "scd2_apply_batch", "scd2_apply_event_time", "scd2_apply_composite",
              "scd2_splice", "scd2_apply_events", "scd2_history", "dim_first_load", "publish_dim", "wap_order_dim"):
    QUERIES[_name], ORACLE[_name] = end_as_text(QUERIES[_name], ORACLE[_name])
for _name in ("pit_join_left", "pit_join_interval", "repin_facts"):
    QUERIES[_name], ORACLE[_name] = ints_as_text(QUERIES[_name], ORACLE[_name], "version_lsn")
QUERIES["date_dim"], ORACLE["date_dim"] = days_as_timestamps(QUERIES["date_dim"], ORACLE["date_dim"], "sk_datekey")
