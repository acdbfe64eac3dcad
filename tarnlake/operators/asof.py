"""Point-in-time joins: each event meets the version of its key valid at event time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tarnlake.functions import epoch_micros
from tarnlake.operators.merge import by_key, sizeable
from tarnlake.operators.runs import ROWS_PER_TASK, carry_forward, split
from tarnlake.session import staged

_EV, _VER, _AT, _ORDER = "__event", "__version", "__at", "__order"
FEW_VERSIONS = 64


def point_in_time_join(
    events: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    event_ts: str,
    start: str,
    end: str,
    take: Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Left join on key and `start <= event_ts < end`, in one sort per key and no pair expansion.

    Versions of a key must not overlap; those that hold at no time (start not before end) are passed over. Both
    inputs are laid on one time line and each event looks back at the newest version; the cost does not depend on the
    number of versions per key. Events without a full key meet nothing and pass around the join. Keys
    too large for a task are cut along time (see `runs`), which reads the inputs more than once: hand in tables, or
    `staged` results.
    """
    keys = list(keys)
    carried = list(dict.fromkeys([*take, end]))
    versions = _lasting(by_key(versions, keys)[0], start, end)
    keyed, loose = by_key(events, keys)
    line = (
        keyed.select(
            *keys, F.col(event_ts).alias(_AT), F.struct(*events.columns).alias(_EV), F.lit(None).alias(_VER)
        )
        .unionByName(
            versions.select(
                *keys, F.col(start).alias(_AT), F.lit(None).alias(_EV), F.struct(*carried).alias(_VER)
            )
        )
        # at equal times a version comes before the events it applies to
        .withColumn(_ORDER, F.struct(F.col(_AT), F.col(_EV).isNotNull(), F.col(f"{_VER}.{end}")))
    )
    line = split(line, keys, epoch_micros(_AT), rows_per_task)
    met = carry_forward(line, keys, _ORDER, F.col(_VER).isNotNull(), [f"{_VER}.*"], "__met")
    met = met.filter(F.col(_EV).isNotNull())
    valid = F.col(_AT) < F.col(f"__met.{end}")
    met = met.select(f"{_EV}.*", *[F.when(valid, F.col(f"__met.{c}")).alias(c) for c in take])
    return met.unionByName(loose.select("*", *_nothing(versions, take)))


def _lasting(versions: DataFrame, start: str, end: str) -> DataFrame:
    return versions.filter(F.col(start) < F.col(end))


def _nothing(versions: DataFrame, take: Sequence[str]) -> list[Column]:
    return [F.lit(None).cast(versions.schema[c].dataType).alias(c) for c in take]


def interval_join(
    events: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    event_ts: str,
    start: str,
    end: str,
    take: Sequence[str],
    few: int = FEW_VERSIONS,
) -> DataFrame:
    """The same join, with the same result, as an equi-join with a range residual for keys of few versions.

    While the versions fit a broadcast the events are not shuffled at all. Spark measures that by their files, where versions take a tenth to
    a fiftieth of what they take in the driver; so their keys are counted first, and versions of many keys are not broadcast. An event is held against at most `few` versions; the events of keys that have more
    take the time line instead. Which keys those are is found and stored when this is called; usually there are none. If there are,
    the events are stored too, as they are read more than once.
    """
    keys = list(keys)
    versions = _lasting(by_key(versions, keys)[0], start, end).select(*dict.fromkeys([*keys, start, end, *take]))
    many = staged(versions.groupBy(*keys).count().filter(F.col("count") > few).select(*keys), "many-versions")
    inside: Column = (F.col(f"e.{event_ts}") >= F.col(f"v.{start}")) & (F.col(f"e.{event_ts}") < F.col(f"v.{end}"))
    for k in keys:
        inside = (F.col(f"e.{k}") == F.col(f"v.{k}")) & inside
    alone = many.isEmpty()
    if not alone:
        events = staged(events, "events")
    keyed, loose = by_key(events, keys)
    loose = loose.select("*", *_nothing(versions, take))
    light = keyed if alone else keyed.join(many, keys, "left_anti").select(*events.columns)
    few_versions = versions if alone else versions.join(many, keys, "left_anti").select(*versions.columns)
    few_versions = few_versions.alias("v")
    if sizeable(versions, keys):
        few_versions = few_versions.hint("merge")
    met = light.alias("e").join(few_versions, inside, "left").select("e.*", *[F.col(f"v.{c}") for c in take])
    met = met.unionByName(loose)
    if alone:
        return met
    heavy = point_in_time_join(
        keyed.join(many, keys, "left_semi").select(*events.columns),
        versions.join(many, keys, "left_semi").select(*versions.columns),
        keys, event_ts, start, end, take,
    )
    return met.unionByName(heavy)


def _inside_spans(facts: DataFrame, spans: DataFrame, keys: Sequence[str], event_ts: str) -> DataFrame:
    """Facts with `__again`: does the fact's time fall into what changed of its key (one span per key, else facts repeat)."""
    same = reduce(lambda a, b: a & b, [F.col(f"f.`{k}`") == F.col(f"s.`{k}`") for k in keys])
    at = F.col(f"f.{event_ts}")
    again = F.coalesce((at >= F.col("s.span_start")) & (at < F.col("s.span_end")), F.lit(False))
    return facts.alias("f").join(spans.alias("s"), same, "left").select("f.*", again.alias("__again"))


def repinned(
    facts: DataFrame,
    spans: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    event_ts: str,
    start: str,
    end: str,
    take: Sequence[str],
) -> DataFrame:
    """The facts whose version may have changed, pinned again: those whose time falls into the span of their key.

    `spans` holds (keys, span_start, span_end), one row per key, as `scd2.changed_spans` gives them. The facts meet the spans, which Spark
    broadcasts if they are small enough, and only the facts inside go through a point-in-time join, with the versions of the changed
    keys. Those facts are written when this is called.
    """
    keys = list(keys)
    inside = _inside_spans(facts, spans, keys, event_ts).filter("__again").select(*(f"`{c}`" for c in facts.columns if c not in take))
    touched = versions.join(spans.select(*keys), keys, "left_semi").select(*versions.columns)
    pinned = point_in_time_join(staged(inside, "facts-again"), touched, keys, event_ts, start, end, take)
    return pinned.select(*(f"`{c}`" for c in facts.columns))


def repin(
    facts: DataFrame,
    spans: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    event_ts: str,
    start: str,
    end: str,
    take: Sequence[str],
) -> DataFrame:
    """All facts after a change of the dimension: those of changed spans pinned again, the others as they are."""
    kept = _inside_spans(facts, spans, keys, event_ts).filter("NOT __again").drop("__again")
    return kept.unionByName(repinned(facts, spans, versions, keys, event_ts, start, end, take))


def pinned_and_latest(
    facts: DataFrame, dim: DataFrame, surrogate: str, natural: str, attribute: str
) -> DataFrame:
    """Fact rows with the dimension attribute at the pinned version and at the active one."""
    pinned = dim.select(surrogate, natural, F.col(attribute).alias(f"{attribute}_pinned"))
    latest = dim.filter("record_active_flag").select(
        natural, F.col(surrogate).alias(f"{surrogate}_latest"), F.col(attribute).alias(f"{attribute}_latest")
    )
    return facts.join(pinned, surrogate).join(latest, natural)
