"""Type-2 history: dimension rows with validity intervals.

Conventions: intervals are half-open `[record_start_date, record_end_date)`, an
open interval ends at 9999-12-31, and a key has at most one active row. New
versions always carry the new attribute values.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tarnlake.functions import differs
from tarnlake.operators.latest import latest_by
from tarnlake.operators.merge import Update, by_key, merge_apply, one_per_key
from tarnlake.operators.runs import ROWS_PER_TASK, following, is_split, numbered, previous, split, unsplit
from tarnlake.session import staged

ACTIVE, START, END = "record_active_flag", "record_start_date", "record_end_date"
KIND, VERSION, SAME, DELETED = "record_kind", "version", "same", "delete"      # rows of a timeline
OPEN_END = "9999-12-31 00:00:00"


def open_end(kind: str = "timestamp_ntz") -> Column:
    return F.lit(OPEN_END).cast(kind)


def as_dimension(source: DataFrame, start: Column, kind: str = "timestamp_ntz") -> DataFrame:
    """First load: every source row becomes an active version."""
    return source.select(
        "*", F.lit(True).alias(ACTIVE), start.cast(kind).alias(START), open_end(kind).alias(END)
    )


def current(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col(ACTIVE))


def _match(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}") == F.col(f"{right}.{k}") for k in keys])


def changed_rows(dim: DataFrame, source: DataFrame, keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """Source rows whose active version holds other values (equi-join, inequality residual)."""
    return (
        source.alias("s")
        .join(current(dim).alias("d"), _match("s", "d", keys))
        .filter(differs("s", "d", tracked))
        .select("s.*")
    )


def staged_rows(
    dim: DataFrame, source: DataFrame, keys: Sequence[str], tracked: Sequence[str]
) -> DataFrame:
    """What an apply would do, as rows: `close` and `insert` for a changed key, `insert` for a new one."""
    pairs = source.alias("s").join(current(dim).alias("d"), _match("s", "d", keys), "left")
    fresh = F.col(f"d.{ACTIVE}").isNull()
    steps = F.when(fresh, F.array(F.lit("insert"))).when(
        differs("s", "d", tracked), F.array(F.lit("close"), F.lit("insert"))
    )
    return pairs.select("s.*", F.explode(steps).alias("merge_action"))


def apply_snapshot(
    dim: DataFrame, source: DataFrame, keys: Sequence[str], tracked: Sequence[str], as_of: Column, rows_at_once: int | None = None
) -> DataFrame:
    """Apply a full source snapshot (one row per key, else it raises) as of one moment.

    Active rows and source meet once, in a full outer join, and each pair unfolds
    into the one or two rows it leaves behind, so both sides shuffle once. History rows
    pass by untouched. Keys missing from the source stay as they are. Source rows without a full key change nothing: no
    version could be told to be theirs the next time. A source of more than `rows_at_once` rows, a stored table, is applied in slices of
    the keys, each of which is written before the next, so that disks hold the shuffled rows of one slice at a time.
    """
    kind = dim.schema[START].dataType
    keys = list(keys)
    one_per_key(source, keys)
    source = by_key(source, keys)[0]
    names = dim.columns
    bounds = {ACTIVE, START, END}
    in_dim, in_source = F.col(f"d.{ACTIVE}").isNotNull(), F.col(f"s.{keys[0]}").isNotNull()

    def row(kept: dict[str, Column], side: str) -> Column:
        have = set(source.columns) | bounds if side == "s" else set(names)
        return F.struct(*[
            (kept[f.name] if f.name in kept else F.col(f"{side}.`{f.name}`") if f.name in have else F.lit(None))
            .cast(f.dataType).alias(f.name) for f in dim.schema.fields
        ])

    now = as_of.cast(kind)
    closed = row({ACTIVE: F.lit(False), END: now}, "d")
    opened = row({ACTIVE: F.lit(True), START: now, END: open_end().cast(kind)}, "s")
    left_behind = (
        F.when(~in_dim, F.array(opened))
        .when(in_source & differs("s", "d", tracked), F.array(closed, opened))
        .otherwise(F.array(row({}, "d")))
    )

    def met(slot: Column) -> DataFrame:
        d, s = current(dim).filter(slot).alias("d"), source.filter(slot).alias("s")
        return d.join(s, _match("d", "s", keys), "full").select(F.explode(left_behind).alias("r")).select("r.*")

    n = 1 if rows_at_once is None else -(-source.count() // rows_at_once)
    if n <= 1 or any(dim.schema[k].dataType != source.schema[k].dataType for k in keys):
        applied = met(F.lit(True))
    else:
        applied = reduce(DataFrame.unionByName, [staged(met(F.pmod(F.xxhash64(*keys), F.lit(n)) == i), "applied-slice") for i in range(n)])
    return dim.filter(~F.col(ACTIVE)).unionByName(applied)


def apply_changes(
    dim: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    event_ts: str,
    commit_ts: str | None = None,
    commit_column: str = "record_commit_timestamp",
    deleted: Column | None = None,
) -> DataFrame:
    """Apply a batch of changes (one row per key, else it raises) with event-time bounds.

    The rows that open or close a version are worked out from the touched keys and written when this is called; the
    dimension is then only left-joined with them, so a batch small enough to broadcast leaves it
    unshuffled. A row for which `deleted` holds closes the active version and opens none. A key without an active version is
    inserted, including one that returns after deletion, but not by a change from before its last end. A change that is not
    newer than the active version's start is passed over, which makes a replay a no-op; `late_changes` gives those that came
    late, for `splice`. An empty batch leaves the dimension as it is. Rows without a full key change nothing.
    """
    keys = list(keys)
    kind = dim.schema[START].dataType
    if changes.isEmpty():
        return dim
    one_per_key(changes, keys)
    seen = _met(dim, changes, keys, tracked, event_ts, deleted)
    known, gone = F.col("__known"), F.col("__gone")
    opens = ~gone & ((~known & ~F.col("__late")) | (F.col("__newer") & F.col("__differs")))
    closes = F.col("__newer") & (gone | F.col("__differs"))
    acting = staged(seen.filter(opens | closes).select(
        *(f"`{c}`" for c in changes.columns), (known & closes).alias("__closes"), opens.alias("__opens")), "scd2-acting")
    closing = acting.filter("__closes").select(
        *keys, F.col(event_ts).cast(kind).alias("__end"),
        *([F.col(commit_ts).alias("__commit")] if commit_ts else []),
    )
    hit = F.col(f"t.{ACTIVE}") & F.col("c.__end").isNotNull()
    updates = {ACTIVE: F.lit(False), END: F.col("c.__end")}
    if commit_ts:
        updates[commit_column] = F.col("c.__commit")
    kept = dim.alias("t").join(closing.alias("c"), _match("t", "c", keys), "left").select(*[
        (F.when(hit, updates[c]).otherwise(F.col(f"t.`{c}`")) if c in updates else F.col(f"t.`{c}`")).alias(c)
        for c in dim.columns
    ])
    given = {ACTIVE: F.lit(True), START: F.col(event_ts), END: open_end()}
    if commit_ts:
        given[commit_column] = F.col(commit_ts)
    inserted = acting.filter("__opens").select(*[
        given.get(f.name, F.col(f"`{f.name}`") if f.name in changes.columns else F.lit(None))
        .cast(f.dataType).alias(f.name) for f in dim.schema.fields
    ])
    return kept.unionByName(inserted)


def _met(dim: DataFrame, changes: DataFrame, keys: list[str], tracked: Sequence[str], event_ts: str, deleted: Column | None) -> DataFrame:
    """Changes with a full key and what the dimension says to each: is there an active version, does the change differ from it, is it
    newer, or older than what the dimension already knows of the key."""
    kind = dim.schema[START].dataType
    changes = by_key(changes, keys)[0].withColumn("__gone", F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False)))
    touched = dim.select(*keys, *[c for c in tracked if c not in keys], ACTIVE, START, END).join(
        changes.select(*keys).distinct(), keys, "left_semi")
    ends = touched.filter(~F.col(ACTIVE)).groupBy(*keys).agg(F.max(END).alias("__last_end"))
    pairs = (
        changes.alias("s").join(current(touched).drop(END).alias("d"), _match("s", "d", keys), "left")
        .join(ends.alias("c"), _match("s", "c", keys), "left")
    )
    at, start = F.col(f"s.{event_ts}").cast(kind), F.col(f"d.{START}")
    return pairs.select(
        "s.*", F.col(f"d.{ACTIVE}").isNotNull().alias("__known"), differs("s", "d", tracked).alias("__differs"),
        F.coalesce(at > start, F.lit(False)).alias("__newer"),
        F.coalesce(at < F.coalesce(start, F.col("c.__last_end")), F.lit(False)).alias("__late"))


def late_changes(dim: DataFrame, changes: DataFrame, keys: Sequence[str], event_ts: str) -> DataFrame:
    """Changes from before what the dimension knows of their key last: the start of its active version or, without one, its last end.

    `apply_changes` passes over them; `splice` puts them where they belong.
    """
    return _met(dim, changes, list(keys), [], event_ts, None).filter("__late").select(*(f"`{c}`" for c in changes.columns))


def history(
    log: DataFrame,
    keys: Sequence[str],
    sequence: str,
    tracked: Sequence[str],
    event_ts: str,
    deleted: Column | None = None,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """All versions of every key from a change log, ordered by an integer `sequence`.

    A row opens a version when it is the first of its key, differs from the row
    before it, or follows a delete; the next opening or delete closes it. Where no key is too large for a task,
    two windows over one shuffle and sort do it. Otherwise large keys are cut along the sequence (see `runs`) and the openings
    are stored between the two looks; sizes of keys are counted first, so hand in a table, or a `staged` result - unless `rows_per_task` is
    None, which says that no key is large: the log is then read once, and log rows that lie together by a part of the key stay where they are.
    """
    seen = _turns(log, keys, sequence, tracked, deleted, rows_per_task)
    points = seen.filter(F.col("__turns")).drop("__turns")
    if is_split(seen):
        points = staged(points, "history-points")
    closed = following(points, keys, sequence, [F.col(event_ts).alias("__at")], "__next")
    kind = log.schema[event_ts].dataType
    return closed.filter(~F.col("__gone")).select(
        *log.columns,
        F.col("__next").isNull().alias(ACTIVE),
        F.col(event_ts).alias(START),
        F.coalesce(F.col("__next.__at"), open_end().cast(kind)).alias(END),
    )


def _turns(
    log: DataFrame, keys: Sequence[str], sequence: str, tracked: Sequence[str], deleted: Column | None, rows_per_task: int | None
) -> DataFrame:
    """Rows of a log with `__gone`, and `__turns` where a row opens a version or, as a delete, closes one."""
    gone = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
    marked = split(log.withColumn("__gone", gone), keys, F.col(sequence), rows_per_task)
    seen = previous(marked, keys, sequence, [*tracked, "__gone"], "__prev")
    changed = reduce(
        lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"__prev.{c}")) for c in tracked], F.lit(False)
    )
    first = F.col("__prev").isNull() | F.col("__prev.__gone")
    closes = F.col("__gone") & ~F.coalesce(F.col("__prev.__gone"), F.lit(True))
    return seen.withColumn("__turns", closes | (~F.col("__gone") & (first | changed))).drop("__prev")


def timeline(
    log: DataFrame,
    keys: Sequence[str],
    sequence: str,
    tracked: Sequence[str],
    event_ts: str,
    deleted: Column | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """The history of a log in the form `splice` keeps up to date: every row of the log stays a row.

    `record_kind` tells which: `version` for the rows of `history`; `same` for a row that repeated the values before it, and `delete`. The
    latter two hold at no time (they end when they start), so joins pass over them; they are what a later splice needs to
    know where the values it puts in end.
    """
    seen = staged(_turns(log, keys, sequence, tracked, deleted, rows_per_task), "timeline-turns")
    kind = log.schema[event_ts].dataType
    ends = following(seen.filter("__turns"), keys, sequence, [F.col(event_ts).alias("__at")], "__next").filter("NOT __gone")
    versions = ends.select(
        *log.columns, F.lit(VERSION).alias(KIND), F.col("__next").isNull().alias(ACTIVE), F.col(event_ts).alias(START),
        F.coalesce(F.col("__next.__at"), open_end().cast(kind)).alias(END))
    marks = seen.filter("__gone OR NOT __turns").select(
        *log.columns, F.when(F.col("__gone"), DELETED).otherwise(SAME).alias(KIND), F.lit(False).alias(ACTIVE),
        F.col(event_ts).alias(START), F.col(event_ts).alias(END))
    return versions.unionByName(marks)


def versions(dim: DataFrame) -> DataFrame:
    """The versions of a timeline: what `history` gives for the log so far."""
    return dim.filter(F.col(KIND) == VERSION).drop(KIND)


def splice(
    dim: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    sequence: str,
    tracked: Sequence[str],
    event_ts: str,
    deleted: Column | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Put changes of any age, deletes among them, into a timeline; any number per key, in batches of any order.

    A change inside a version cuts it in two, one before the first version opens one in front, a delete closes without opening. The result
    is the timeline of all changes so far, ordered by `sequence`, whatever the batches were. Only the rows of touched keys are read for it,
    from the dimension itself: there is no log to keep. A change met again, by key and sequence, takes the place of what it left before,
    so replays change nothing. Columns the changes lack are NULL; rows without a full key change nothing.
    """
    keys = list(keys)
    arrived = by_key(changes, keys)[0].withColumn("__gone", F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False)))
    payload = [c for c in dim.columns if c not in (KIND, ACTIVE, START, END)]
    touched = staged(arrived.select(*keys).distinct(), "touched-keys")
    fields = {f.name: f.dataType for f in dim.schema.fields}
    arrived = arrived.select(
        *[(F.col(f"`{c}`") if c in arrived.columns else F.lit(None)).cast(fields[c]).alias(c) for c in payload],
        F.col(event_ts).cast(fields[START]).alias("__at"), "__gone", F.lit(1).alias("__arrived"))
    known = dim.join(touched, keys, "left_semi").select(
        *(f"`{c}`" for c in payload), F.col(START).alias("__at"), (F.col(KIND) == DELETED).alias("__gone"), F.lit(0).alias("__arrived"))
    points = staged(latest_by(known.unionByName(arrived), [*keys, sequence], ["__arrived", "__at"]).drop("__arrived").withColumnRenamed(
        "__gone", "__was_gone"), "splice-points")
    spliced = timeline(points, keys, sequence, tracked, "__at", F.col("__was_gone"), rows_per_task)
    return dim.join(touched, keys, "left_anti").select(*(f"`{c}`" for c in dim.columns)).unionByName(
        spliced.select(*(f"`{c}`" for c in dim.columns)))


def changed_spans(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, span_start, span_end) of the time within which anything differs between two states of a dimension, one row per key.

    Rows that both hold fall away by counting, so the states meet in one aggregation and not in a join; versions that hold at no time
    count for nothing. Hand in the rows of touched keys where those are known.
    """
    keys = list(keys)
    names = [c for c in after.columns if c in before.columns]
    both = before.select(*names, F.lit(-1).alias("__side")).unionByName(after.select(*names, F.lit(1).alias("__side")))
    lasting = both.filter(F.col(START) < F.col(END))
    moved = lasting.groupBy(*(f"`{c}`" for c in names)).agg(F.sum("__side").alias("__n")).filter("__n <> 0")
    return moved.groupBy(*keys).agg(F.min(START).alias("span_start"), F.max(END).alias("span_end"))


def rebuild_touched(
    dim: DataFrame, touched: DataFrame, keys: Sequence[str], rebuilt: DataFrame
) -> DataFrame:
    """Replace all versions of the touched keys by rebuilt ones (late or out-of-order changes)."""
    keys = list(keys)
    return dim.join(touched.select(*keys).distinct(), keys, "left_anti").select(*dim.columns).unionByName(
        rebuilt.select(*dim.columns)
    )


def rank_versions(
    df: DataFrame, keys: Sequence[str], sequence: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Versions numbered newest first; number 1 is active."""
    cut = split(df, keys, F.col(sequence), rows_per_task)
    ranked = unsplit(numbered(cut, keys, sequence, "version_rank", descending=True))
    return ranked.withColumn(ACTIVE, F.col("version_rank") == 1)


def unseen_versions(events: DataFrame, dim: DataFrame, keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """Events whose (key, values) no version of the dimension holds, NULLs comparing equal."""
    cond = reduce(
        lambda a, b: a & b,
        [F.col(f"e.{k}") == F.col(f"d.{k}") for k in keys]
        + [F.col(f"e.{c}").eqNullSafe(F.col(f"d.{c}")) for c in tracked],
    )
    held = dim.select(*keys, *tracked).distinct()
    return events.alias("e").join(held.alias("d"), cond, "left_anti")


def publish(stage: DataFrame, warehouse: DataFrame, surrogate: str) -> DataFrame:
    """Stage to warehouse by surrogate key (one row per key, else it raises): closed rows are closed there too, new ones inserted.

    Keys of both are looked at when this is called, so hand in tables. Rows numbered above all the warehouse holds are new as they
    stand; of the others those it lacks, few if any, are noted. So of the stage only closed keys and their ends meet the warehouse.
    """
    top = warehouse.agg(F.max(surrogate)).first()[0]
    above = F.col(surrogate).isNull() | (F.lit(True) if top is None else F.col(surrogate) > F.lit(top))
    sides = stage.select(surrogate, F.lit(1).alias("__staged")).unionByName(warehouse.select(surrogate, F.lit(0).alias("__staged")))
    met = sides.filter(F.col(surrogate).isNotNull()).groupBy(surrogate).agg(
        F.sum("__staged").alias("__rows"), (F.min("__staged") == 1).alias("__new"))
    odd = staged(met.filter((F.col("__rows") > 1) | (F.col("__new") & ~above)), "published-keys")
    if not odd.filter("__rows > 1").isEmpty():
        raise ValueError(f"several rows for one key ({surrogate}): reduce them by a sequence first")
    closed = stage.filter(~F.col(ACTIVE)).select(surrogate, ACTIVE, END)
    held = merge_apply(
        warehouse, closed, [surrogate],
        matched=[Update(when=F.col(f"target.{ACTIVE}"), set={ACTIVE: F.lit(False), END: F.col(f"source.{END}")})], unique_source=True)
    fresh = stage.filter(above).unionByName(stage.filter(~above).join(odd.select(surrogate), surrogate, "left_semi").select(*stage.columns))
    return held.unionByName(fresh.select(*[
        (F.col(f"`{f.name}`") if f.name in stage.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in warehouse.schema.fields]))
