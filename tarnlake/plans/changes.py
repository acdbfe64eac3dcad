"""Change capture: current state, change feed and incremental windows, from the event log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tarnlake.functions import (
    decode_decimal, encode_decimal, epoch_micros, epoch_millis, from_epoch_micros, from_epoch_millis,
)
from tarnlake.operators import cdc, changefeed, incremental
from tarnlake.operators.latest import dedup, latest_by
from tarnlake.operators.merge import Insert, Update, all_columns, delete_where, merge_apply
from tarnlake.plans.inputs import (
    BASE_CHANGES, CHANGE_LOG, CHANGE_TS, CUSTOMER_FIELDS, CUSTOMER_NEXT, LOAD_TS, NEW_CHANGES, Tables,
    base_changes, change_log, customer_next, days_as_timestamps, ints_as_text, new_changes, ts,
)
from tarnlake.session import work_path
from tarnlake.streaming import quarantine

ROW_DDL = "id bigint, state string, amount string, modified bigint"


def event_stream(events: DataFrame) -> DataFrame:
    """The event log as change-event JSON, amounts encoded as the wire does."""
    log = change_log(events)
    row = F.struct(
        "id", "state", encode_decimal(F.col("amount").cast("decimal(15,2)")).alias("amount"),
        epoch_micros("event_ts").alias("modified"),
    )
    none = F.lit(None).cast(row_type())
    millis = epoch_millis("event_ts")
    payload = F.struct(
        F.when(F.col("op").isin("u", "d"), row).otherwise(none).alias("before"),
        F.when(F.col("op") != "d", row).otherwise(none).alias("after"),
        F.struct(F.lit("events").alias("table"), millis.alias("ts_ms"), F.col("lsn")).alias("source"),
        F.col("op"),
        millis.alias("ts_ms"),
    )
    return log.select(F.to_json(F.struct(payload.alias("payload"))).alias("value"))


def row_type() -> str:
    return "struct<id:bigint,state:string,amount:string,modified:bigint>"


def _parsed(t: Tables) -> DataFrame:
    return cdc.parse_events(event_stream(t.events), ROW_DDL)


def _flattened(t: Tables) -> DataFrame:
    return cdc.flatten(_parsed(t)).select(
        "before__id", "before__state", "after__id", "after__state", "source__lsn", "source__ts_ms", "op"
    )


def _dotted(t: Tables) -> DataFrame:
    """The same with dotted names, read back through quoting."""
    return cdc.flatten(_parsed(t), ".").select(
        F.col("`before.id`").alias("before_id"), F.col("`after.id`").alias("after_id"),
        F.col("`source.lsn`").alias("source_lsn"), "op",
    )


def _normalized(t: Tables) -> DataFrame:
    log = cdc.normalize(cdc.flatten(_parsed(t)), ["id", "state", "amount", "modified"])
    return log.select(
        "id", "state", decode_decimal(F.col("amount"), 2).cast("double").alias("amount"),
        from_epoch_micros("modified").alias("modified_ts"), "op", "lsn", "event_ts_ms",
    )


def state_of(log: DataFrame) -> DataFrame:
    """Current-state table after a log (first load)."""
    return cdc.to_state(latest_by(log, ["id"], ["lsn"]))


def base_state(t: Tables) -> DataFrame:
    """The current-state table as the base log left it."""
    return t.layer("state_base", lambda: state_of(base_changes(t.events)))


def _applied(t: Tables) -> DataFrame:
    return cdc.apply_changes(base_state(t), new_changes(t.events), ["id"], "lsn")


_SIGNED_UP = "2024-01-02 00:00:00"


def _early_target(t: Tables) -> DataFrame:
    """Users that signed up in the first day."""
    log = change_log(t.events)
    return t.layer("state_early", lambda: state_of(
        log.filter((F.col("op") == "c") & (F.col("event_ts") < ts(_SIGNED_UP)))
    ))


def _first_batch(t: Tables) -> DataFrame:
    """Every update and delete of the log, as one batch: most come for users not signed up yet."""
    return change_log(t.events).filter(F.col("op").isin("u", "d"))


def _quarantine(t: Tables) -> DataFrame:
    return cdc.out_of_order(_first_batch(t), _early_target(t), ["id"])


_PER_DAY = ["id", "day"]


def _quarantined(t: Tables) -> DataFrame:
    """State per user and day after three batches, the newest third of the events first, beside the events that still wait for
    a sign-up or view of their user and day."""
    path = work_path(t.spark, "state-with-quarantine")
    log = change_log(t.events).withColumn("day", F.col("event_ts").cast("date"))
    write = quarantine.upsert(path, _PER_DAY, "lsn", lambda: datetime(2024, 2, 1))
    for number, third in enumerate((2, 0, 1)):
        write(log.filter(F.col("lsn") % 3 == third), number)
    columns = ["id", "day", "lsn", "state", "amount"]
    state = quarantine.current(t.spark, path).select(*columns, F.col("delete_ts").isNotNull().alias("deleted"), F.lit(False).alias("waits"))
    return state.unionByName(quarantine.held(t.spark, path).select(*columns, (F.col("op") == "d").alias("deleted"), F.lit(True).alias("waits")))


def _upsert(t: Tables) -> DataFrame:
    """Suppliers and customers share an account table: plain upsert by key."""
    accounts = t.customer.select("c_custkey", "c_name", "c_acctbal").toDF("k", "name", "bal")
    incoming = t.supplier.select("s_suppkey", "s_name", "s_acctbal").toDF("k", "name", "bal")
    incoming = incoming.unionByName(incoming.withColumn("k", -1 - F.col("k")))
    return merge_apply(
        accounts, incoming, ["k"],
        matched=[Update(when=F.col("source.bal") > F.col("target.bal"), set={"bal": F.col("source.bal")})],
        not_matched=[Insert(all_columns(incoming))],
    )


def feed(t: Tables) -> DataFrame:
    """The feed as a stored table."""
    return t.layer("customer_feed", lambda: build_feed(t))


def build_feed(t: Tables) -> DataFrame:
    """Change feed of the customer table: version 0 is the load, version 1 the later snapshot."""
    first = t.customer.select(*CUSTOMER_FIELDS)
    load = first.select(
        "*", F.lit("insert").alias(changefeed.TYPE), F.lit(0).cast("long").alias(changefeed.VERSION),
        ts(LOAD_TS).alias(changefeed.COMMITTED),
    )
    later = changefeed.diff(first, customer_next(t.customer, t.supplier), ["c_custkey"], 1, ts(CHANGE_TS))
    return load.unionByName(later)


def _bounds(t: Tables) -> DataFrame:
    processed = t.spark.range(1).select(ts(LOAD_TS).alias("last_processed_ts"))
    return incremental.bounds(changefeed.bounds(feed(t)), processed, ts("2024-01-15 00:00:00"))


def _epochs(t: Tables) -> DataFrame:
    millis = t.events.select("event_id", epoch_millis("ts").alias("ms"), epoch_micros("ts").alias("us"))
    return millis.select(
        "event_id", "ms", "us", from_epoch_millis("ms").alias("ts_of_ms"), from_epoch_micros("us").alias("ts_of_us")
    )


def _json_props(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        F.from_json("props", "k bigint").getField("k").alias("k_parsed"),
        F.get_json_object("props", "$.k").alias("k_text"),
    )


# name, scale written, bytes of sign in front, and how much smaller the scale read is
_WIRE_FORMS = [("bytes16", 2, 8, 0), ("bytes40", 2, 32, 0), ("scale_minus2", 0, 0, 2), ("scale45", 2, 12, -43)]


def _widened(encoded: Column, extra: int) -> Column:
    """The same number with more sign bytes in front."""
    digits = F.hex(F.unbase64(encoded))
    sign = F.when(F.substring(digits, 1, 1) >= "8", "FF").otherwise("00")
    return F.base64(F.unhex(F.concat(F.repeat(sign, extra), digits)))


def _decoded(t: Tables) -> DataFrame:
    """Balances through the wire encoding and back, with a fixed and with a per-row scale."""
    bal = F.col("s_acctbal").cast("decimal(15,2)")
    scale = F.when(F.col("s_acctbal") < 0, 3).otherwise(4)
    per_row = F.when(F.col("s_acctbal") < 0, encode_decimal(bal, 3)).otherwise(encode_decimal(bal, 4))
    return t.supplier.select(
        "s_suppkey",
        decode_decimal(encode_decimal(bal), 2).cast("double").alias("fixed"),
        decode_decimal(per_row, scale).cast("double").alias("per_row"),
        *(decode_decimal(_widened(encode_decimal(bal, own), extra), own - shift).cast("double").alias(name)
          for name, own, extra, shift in _WIRE_FORMS),
    )


_WINDOW = (datetime(2024, 1, 20), datetime(2024, 1, 21))

QUERIES = {
    "cdc_flatten": _flattened,
    "cdc_flatten_dotted": _dotted,
    "cdc_normalize": _normalized,
    "cdc_latest": lambda t: cdc.latest_changes(change_log(t.events), ["id"], ["lsn"]),
    "cdc_apply_changes": _applied,
    "out_of_order_events": _quarantine,
    "quarantine_state": _quarantined,
    "cdc_with_retry": lambda t: cdc.with_retry(new_changes(t.events), _quarantine(t)),
    "dedup_keys": lambda t: dedup(change_log(t.events), ["id", "op"], ["lsn"]),
    "merge_upsert": _upsert,
    "delete_where": lambda t: delete_where(t.customer, "c_acctbal < 0 or c_mktsegment = 'FURNITURE'"),
    "lookback_window": lambda t: incremental.lookback_window(change_log(t.events), "event_ts", *_WINDOW),
    "incremental_since_max": lambda t: incremental.since_last(
        change_log(t.events), "event_ts", base_state(t), "event_ts"
    ),
    "cdf_diff": build_feed,
    "cdf_range": lambda t: changefeed.read_range(feed(t), from_version=1),
    "cdf_postimages": lambda t: changefeed.post_images(feed(t)),
    "cdf_bounds": lambda t: changefeed.bounds(feed(t)),
    "cdf_net_changes": lambda t: changefeed.net_changes(feed(t), ["c_custkey"]),
    "cdf_replay": lambda t: changefeed.replay(
        t.customer.select(*CUSTOMER_FIELDS), changefeed.read_range(feed(t), from_ts=ts(CHANGE_TS)), ["c_custkey"]
    ),
    "incremental_bounds": _bounds,
    "epoch_to_ts": _epochs,
    "json_props": _json_props,
    "decode_decimal": _decoded,
}

_LATEST = """select * exclude (rn) from (select *,
    row_number() over (partition by id order by lsn desc) as rn from {}) where rn = 1"""
_STATE = "select * exclude (op), case when op = 'd' then event_ts end as delete_ts from ({})"
_EARLY = f"(select distinct id from {CHANGE_LOG} where op = 'c' and event_ts < timestamp '{_SIGNED_UP}')"
_OOO = f"select * from {CHANGE_LOG} where op in ('u', 'd') and id not in (select id from {_EARLY})"
_SAME = " and ".join(f"o.{c} is not distinct from n.{c}" for c in CUSTOMER_FIELDS)
_OLD_ROW = ", ".join(f"o.{c}" for c in CUSTOMER_FIELDS)
_NEW_ROW = ", ".join(f"n.{c}" for c in CUSTOMER_FIELDS)
_V1 = f"cast(1 as bigint) as _commit_version, timestamp '{CHANGE_TS}' as _commit_timestamp"
_FEED = f"""(select {', '.join(CUSTOMER_FIELDS)}, 'insert' as _change_type, cast(0 as bigint) as _commit_version,
    timestamp '{LOAD_TS}' as _commit_timestamp from customer
  union all select {_OLD_ROW}, 'update_preimage', {_V1} from customer o join {CUSTOMER_NEXT} n using (c_custkey)
    where not ({_SAME})
  union all select {_NEW_ROW}, 'update_postimage', {_V1} from customer o join {CUSTOMER_NEXT} n using (c_custkey)
    where not ({_SAME})
  union all select {_NEW_ROW}, 'insert', {_V1} from {CUSTOMER_NEXT} n
    where c_custkey not in (select c_custkey from customer))"""

ORACLE = {
    "cdc_flatten": f"""select case when op in ('u', 'd') then id end as before__id,
  case when op in ('u', 'd') then state end as before__state, case when op <> 'd' then id end as after__id,
  case when op <> 'd' then state end as after__state, lsn as source__lsn, epoch_us(event_ts) // 1000 as source__ts_ms, op
  from {CHANGE_LOG}""",
    "cdc_flatten_dotted": f"""select case when op in ('u', 'd') then id end as before_id,
  case when op <> 'd' then id end as after_id, lsn as source_lsn, op from {CHANGE_LOG}""",
    "cdc_normalize": f"""select id, state, amount, event_ts as modified_ts, op, lsn,
  epoch_us(event_ts) // 1000 as event_ts_ms from {CHANGE_LOG}""",
    "cdc_latest": _LATEST.format(CHANGE_LOG),
    "cdc_apply_changes": _STATE.format(_LATEST.format(CHANGE_LOG)),
    "out_of_order_events": _OOO,
    "cdc_with_retry": f"select * from {NEW_CHANGES} union all {_OOO}",
    "quarantine_state": f"""select id, day, lsn, state, amount, op = 'd' as deleted, not based as waits from (
    select *, row_number() over (partition by id, day order by lsn desc) as rn, bool_or(op in ('c', 'r')) over (partition by id, day) as based
    from (select *, cast(event_ts as date) as day from {CHANGE_LOG})) where not based or rn = 1""",
    "dedup_keys": f"""select * exclude (rn) from (select *, row_number() over (partition by id, op order by lsn) as rn
  from {CHANGE_LOG}) where rn = 1""",
    "merge_upsert": """with incoming as (select s_suppkey as k, s_name as name, s_acctbal as bal from supplier
    union all select -1 - s_suppkey, s_name, s_acctbal from supplier)
  select c_custkey as k, c_name as name, case when bal > c_acctbal then bal else c_acctbal end as bal
  from customer left join incoming on c_custkey = k
  union all select k, name, bal from incoming where k not in (select c_custkey from customer)""",
    "delete_where": "select * from customer where not (c_acctbal < 0 or c_mktsegment = 'FURNITURE')",
    "lookback_window": f"""select * from {CHANGE_LOG} where event_ts >= timestamp '2024-01-17 00:00:00'
  and event_ts < timestamp '2024-01-21 00:00:00'""",
    "incremental_since_max": f"""select * from {CHANGE_LOG}
  where event_ts >= (select max(event_ts) from {BASE_CHANGES})""",
    "cdf_diff": f"select * from {_FEED}",
    "cdf_range": f"select * from {_FEED} where _commit_version >= 1",
    "cdf_postimages": f"select * from {_FEED} where _change_type <> 'update_preimage'",
    "cdf_bounds": f"""select min(_commit_timestamp) as first_commit_ts, max(_commit_timestamp) as last_commit_ts,
  min(_commit_version) as first_version, max(_commit_version) as last_version from {_FEED}""",
    "cdf_net_changes": f"""select * exclude (rn) from (select *, row_number() over (partition by c_custkey
  order by _commit_version desc) as rn from {_FEED} where _change_type <> 'update_preimage') where rn = 1""",
    "cdf_replay": f"select * from {CUSTOMER_NEXT}",
    "incremental_bounds": f"""select cast(null as bigint) as start_version,
  greatest(min(_commit_timestamp), timestamp '{LOAD_TS}') as start_ts,
  least(max(_commit_timestamp), timestamp '2024-01-15 00:00:00') as end_ts from {_FEED}""",
    "epoch_to_ts": """select event_id, epoch_us(ts) // 1000 as ms, epoch_us(ts) as us,
  make_timestamp(epoch_us(ts) // 1000 * 1000) as ts_of_ms, ts as ts_of_us from events""",
    "json_props": """select event_id, cast(json_extract_string(props, '$.k') as bigint) as k_parsed,
  json_extract_string(props, '$.k') as k_text from events""",
    "decode_decimal": """select s_suppkey, s_acctbal as fixed, s_acctbal as per_row, s_acctbal as bytes16, s_acctbal as bytes40,
  cast(round(cast(s_acctbal as decimal(15,2)), 0) * 100 as double) as scale_minus2, 0.0::double as scale45 from supplier""",
}

for _name, _columns in {
    "cdc_flatten": ["before__id", "after__id"], "cdc_flatten_dotted": ["before_id", "after_id"],
    "incremental_bounds": ["start_version"],
}.items():
    QUERIES[_name], ORACLE[_name] = ints_as_text(QUERIES[_name], ORACLE[_name], *_columns)
QUERIES["quarantine_state"], ORACLE["quarantine_state"] = days_as_timestamps(QUERIES["quarantine_state"], ORACLE["quarantine_state"], "day")
