"""Conditional merge of a source into a target, without a table format.

The target is never put through a full outer join. Matched rows are updated by a
left join from the target, and the unmatched source rows are found from the
target's key column alone. With a small batch of changes both joins broadcast the
batch (Spark checks its size, at planning and again at run time) and the target
is streamed through without a shuffle; with a large batch they become
shuffled joins whose build side holds one row per key, however many
rows the batch has for it. A batch known to be `sizeable` would be shuffled, and
the target with it, by both joins: then one full outer join of rows with a full key
does the work of both, and each side is moved once.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tarnlake.session import freeing, staged

_COUNT, _ACTION, _HERE = "__source_rows", "__action", "__here"
_STORED_SHARE = 4      # a row in memory takes about as many times the bytes it takes in a file
# What became of a row, in the column KIND of `merge_outcome`; all but `keep` are change rows of a feed.
KIND = "__kind"
KEEP, INSERT, PRE, POST, DELETE = "keep", "insert", "update_preimage", "update_postimage", "delete"


@dataclass(frozen=True)
class Update:
    """WHEN MATCHED [AND when] THEN UPDATE SET ..."""

    set: Mapping[str, Column]
    when: Column | None = None


@dataclass(frozen=True)
class Delete:
    """WHEN MATCHED [AND when] THEN DELETE"""

    when: Column | None = None


@dataclass(frozen=True)
class Insert:
    """WHEN NOT MATCHED [AND when] THEN INSERT; columns not named become NULL."""

    values: Mapping[str, Column] = field(default_factory=dict)
    when: Column | None = None


def all_columns(df: DataFrame, side: str = "source", but: Sequence[str] = ()) -> dict[str, Column]:
    """Assignment of every column of `df` but some: the computed SET list of a merge."""
    return {c: F.col(f"{side}.`{c}`") for c in df.columns if c not in set(but)}


def _all_set(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def by_key(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a full key, and rows with a NULL in it.

    The latter match nothing, and would all meet in one task of a join: let them pass around it.
    """
    return df.filter(_all_set(keys)), df.filter(~_all_set(keys))


def one_per_key(source: DataFrame, keys: Sequence[str]) -> None:
    """Raise when several rows share a key: which of them holds would be arbitrary. Looked up when this is called."""
    repeated = by_key(source, keys)[0].groupBy(*keys).count().filter("count > 1")
    with freeing(source.sparkSession):
        found = not repeated.isEmpty()
    if found:
        raise ValueError(f"several rows for one key ({', '.join(keys)}): reduce them by a sequence first")


def unmatched(source: DataFrame, target: DataFrame, on: Sequence[str]) -> DataFrame:
    """Source rows whose key is not in the target.

    The target gives only its key column, and of that only the keys the source has.
    """
    on = list(on)
    hits = target.select(*on).join(source.select(*on).distinct(), on, "left_semi").distinct()
    return source.join(hits, on, "left_anti").select(*source.columns)


def sizeable(rows: DataFrame, keys: Sequence[str]) -> bool:
    """Whether `rows`, reduced to one per key, are clearly more than Spark would broadcast.

    Keys are counted when this is called, in a pass without a shuffle: ask for tables, not for what has to be computed first.
    """
    limit = _bytes(rows.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    if limit <= 0:
        return True
    width = 8 + sum(20 if f.dataType.typeName() == "string" else 8 for f in rows.schema.fields)
    return rows.agg(F.approx_count_distinct(F.xxhash64(*keys))).first()[0] * width > limit * _STORED_SHARE


def _bytes(size: str) -> int:
    """A size as Spark's settings have it: bytes, or a number with a unit."""
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([a-z]*)\s*", size.lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit[:1] if unit[:1] not in ("", "b") else " ")


def _fill(values: Mapping[str, Column], target: DataFrame) -> list[Column]:
    return [
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in target.schema.fields
    ]


@dataclass(frozen=True)
class _Decided:
    """Target rows beside their source rows with the clause that acts on each, the columns that leaves, and the rows inserted."""

    pairs: DataFrame
    columns: list[Column]
    deletes: list[int]
    inserts: list[DataFrame]


def _matched(
    target: DataFrame, present: Column, matched: Sequence[Update | Delete], unique_source: bool = True,
) -> tuple[Column, list[Column], list[int]]:
    """Which clause acts on a target row, if any (else -1), the columns that leaves, and which clauses delete."""
    action = F.when(~present, F.lit(-1))
    if not unique_source:
        action = action.when(
            F.col(f"source.{_COUNT}") > 1,
            F.raise_error(F.lit("merge: several source rows match one target row")).cast("int"),
        )
    for i, clause in enumerate(matched):
        action = action.when(F.lit(True) if clause.when is None else F.coalesce(clause.when, F.lit(False)), F.lit(i))
    columns = []
    for f in target.schema.fields:
        value = F.col(f"target.`{f.name}`")
        chosen = None
        for i, clause in enumerate(matched):
            if isinstance(clause, Update) and f.name in clause.set:
                step = (F.col(_ACTION) == i, clause.set[f.name].cast(f.dataType))
                chosen = F.when(*step) if chosen is None else chosen.when(*step)
        columns.append((value if chosen is None else chosen.otherwise(value)).alias(f.name))
    return action.otherwise(F.lit(-1)), columns, [i for i, clause in enumerate(matched) if isinstance(clause, Delete)]


def _decide(
    target: DataFrame, source: DataFrame, on: Sequence[str], matched: Sequence[Update | Delete], not_matched: Sequence[Insert],
    unique_source: bool, stage: bool,
) -> _Decided:
    on = list(on)
    if stage:
        source = staged(source, "merge-source")
    present = F.col(f"source.{_COUNT}").isNotNull()
    if unique_source:
        keyed = source.withColumn(_COUNT, F.lit(1))
    else:
        others = [c for c in source.columns if c not in on]
        keyed = by_key(source, on)[0].groupBy(*on).agg(
            F.count(F.lit(1)).alias(_COUNT), *[F.first(c).alias(c) for c in others]
        )
    same_key = reduce(lambda a, b: a & b, [F.col(f"target.{k}") == F.col(f"source.{k}") for k in on])
    pairs = target.alias("target").join(keyed.alias("source"), same_key, "left")
    action, columns, deletes = _matched(target, present, matched, unique_source)
    decided = pairs.withColumn(_ACTION, action)
    if not unique_source:  # a filter on the action keeps the ambiguity error from being pruned away
        decided = decided.filter(F.col(_ACTION) >= -1)
    inserts = []
    if not_matched:
        if unique_source:
            fresh = unmatched(source, target, on)
        else:
            full, loose = by_key(source, on)
            fresh = unmatched(full, target, on).unionByName(loose)
        fresh = fresh.alias("source")
        taken = F.lit(False)
        for clause in not_matched:
            holds = F.lit(True) if clause.when is None else F.coalesce(clause.when, F.lit(False))
            inserts.append(fresh.filter(holds & ~taken).select(*_fill(clause.values, target)))
            taken = taken | holds
    return _Decided(decided, columns, deletes, inserts)


def merge_apply(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    matched: Sequence[Update | Delete] = (),
    not_matched: Sequence[Insert] = (),
    unique_source: bool = False,
    stage: bool = False,
    together: bool = False,
) -> DataFrame:
    """Result of merging `source` into `target` on equal keys.

    Clauses refer to columns as `target.x` and `source.x`; the first clause whose
    condition holds wins. Several source rows for one target row raise. Set
    `unique_source` when the source has one row per key (saves its grouping), and
    `stage` when it is the outcome of a computation: it is then written once rather
    than computed for each of the two joins. Set `together` when the source is `sizeable` and
    has one row per key: it is then computed and moved once, and not staged.
    """
    if together:
        if not unique_source:
            raise ValueError("only a source with one row per key is merged by one join")
        return _merge_together(target, source, list(on), matched, not_matched)
    d = _decide(target, source, on, matched, not_matched, unique_source, stage)
    left = d.pairs.filter(~F.col(_ACTION).isin(d.deletes)) if d.deletes else d.pairs
    return reduce(DataFrame.unionByName, d.inserts, left.select(*d.columns))


def _merge_together(
    target: DataFrame, source: DataFrame, on: Sequence[str], matched: Sequence[Update | Delete], not_matched: Sequence[Insert],
) -> DataFrame:
    """The merge by one full outer join; the source has a row per key. Rows without a full key match nothing and stay out of the join."""
    (held, loose_target), (full, loose) = by_key(target, on), by_key(source, on)
    same_key = reduce(lambda a, b: a & b, [F.col(f"target.{k}") == F.col(f"source.{k}") for k in on])
    pairs = held.withColumn(_HERE, F.lit(True)).alias("target").join(full.withColumn(_COUNT, F.lit(1)).alias("source"), same_key, "full")
    here = F.col(f"target.{_HERE}").isNotNull()
    action, columns, deletes = _matched(target, F.col(f"source.{_COUNT}").isNotNull(), matched)
    fresh, values = F.lit(-1), {f.name: F.lit(None).cast(f.dataType) for f in target.schema.fields}
    for i, clause in reversed(list(enumerate(not_matched))):
        holds = F.lit(True) if clause.when is None else F.coalesce(clause.when, F.lit(False))
        fresh = F.when(holds, F.lit(i)).otherwise(fresh)
        values = {f.name: F.when(holds, clause.values.get(f.name, F.lit(None)).cast(f.dataType)).otherwise(values[f.name]) for f in target.schema.fields}
    kept = ~F.col(_ACTION).isin(deletes) if deletes else F.lit(True)
    joined = pairs.withColumn(_ACTION, F.when(here, action)).filter(F.when(here, kept).otherwise(fresh >= 0)).select(
        *[F.when(here, old).otherwise(values[f.name]).alias(f.name) for f, old in zip(target.schema.fields, columns)])
    inserted = loose.alias("source").filter(fresh >= 0).select(*[value.alias(name) for name, value in values.items()])
    return joined.unionByName(loose_target).unionByName(inserted)


def merge_outcome(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    matched: Sequence[Update | Delete] = (),
    not_matched: Sequence[Insert] = (),
    unique_source: bool = False,
    stage: bool = False,
) -> DataFrame:
    """The same merge with what became of each row, in column `__kind`.

    Rows of kind `keep`, `update_postimage` and `insert` are the result; those of every kind but `keep` are what changed, with
    pre-images of updated and images of deleted rows. An update that leaves every column as it was keeps the row.
    """
    d = _decide(target, source, on, matched, not_matched, unique_source, stage)
    names = target.columns
    old = [F.col(f"target.`{c}`").alias(c) for c in names]
    same = reduce(lambda a, b: a & b, [o.eqNullSafe(n) for o, n in zip(old, d.columns)])

    def row(columns: list[Column], kind: str) -> Column:
        return F.struct(*columns, F.lit(kind).alias(KIND))

    kinds = F.when(F.col(_ACTION) < 0, F.array(row(old, KEEP)))
    if d.deletes:
        kinds = kinds.when(F.col(_ACTION).isin(d.deletes), F.array(row(old, DELETE)))
    kinds = kinds.when(same, F.array(row(old, KEEP))).otherwise(F.array(row(old, PRE), row(d.columns, POST)))
    rows = d.pairs.select(F.explode(kinds).alias("r")).select("r.*")
    return reduce(DataFrame.unionByName, [i.withColumn(KIND, F.lit(INSERT)) for i in d.inserts], rows)


def delete_where(target: DataFrame, predicate: Column | str) -> DataFrame:
    """Target without the rows the predicate is true for (NULL keeps the row)."""
    test = F.expr(predicate) if isinstance(predicate, str) else predicate
    return target.filter(~F.coalesce(test, F.lit(False)))
