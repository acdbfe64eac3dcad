"""Looking along the rows of a key, when one key may hold much of the table.

A window over the key alone puts every row of a key in one task. `split` finds the keys
that are too large for that and cuts their rows into slices along the order; the
functions below then sort within (key, slice) and let only one value per slice
travel between slices. Where no key is too large, which is the usual case, the table comes back as it is and
is read by one plain window.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tarnlake.session import staged

ROWS_PER_TASK = 1 << 23
_OVERSAMPLE = 4               # slices are planned this much smaller, for cuts that are approximate
_CUTS = 1024                  # places at which the order of a large key, or of a slice that is still too large, can be cut
SLICE, _HOT, _EDGE, _ALONG = "__slice", "__hot", "__edge", "__along"


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in keys])


def split(df: DataFrame, keys: Sequence[str], along: Column, rows_per_task: int | None = ROWS_PER_TASK) -> DataFrame:
    """Mark rows with a slice number that never decreases along the order; `df` itself where no key is too large.

    `along` is the order as an integer (a sequence number, epoch microseconds). A key, NULL or not,
    of more than `rows_per_task` rows is cut at quantiles of its order, into as many slices as its row count asks
    for, so bursts make no large slice. Where that takes more than `_CUTS` places, slices that are still too large are cut again, and
    so on; only rows of equal order stay together. `unsplit` removes the marks. The
    sizes of the keys are counted and stored when this is called. Where the caller knows that no key is large (`rows_per_task` None)
    nothing is counted.
    """
    keys = list(keys)
    if rows_per_task is None:
        return df
    placed = df.withColumn(_ALONG, along.cast("long"))
    large = _large(placed, keys, rows_per_task)
    if large is None:
        return df
    parts, marked = [], placed.withColumn(_HOT, F.lit(None).cast("boolean"))
    while large is not None:
        part = f"{SLICE}{len(parts)}"
        cuts = _cuts(marked, [*keys, *parts], large, rows_per_task)
        same = _same("r", "l", [*keys, *parts])
        number = F.expr(f"size(filter(l.__cuts, c -> c < r.{_ALONG}))").cast("long")
        marked = marked.alias("r").join(cuts.alias("l"), same, "left").select(
            *[F.col(f"r.`{c}`") for c in marked.columns if c != _HOT], F.coalesce(number, F.lit(0)).alias(part),
            (F.coalesce(F.col(f"r.{_HOT}"), F.lit(False)) | F.col("l.__cuts").isNotNull()).alias(_HOT))
        parts.append(part)
        if len(parts) * 10 > 50:                                   # 10 bits a step: more than any table has rows
            break
        large = _large(marked.filter(_HOT), [*keys, *parts], rows_per_task, spread=True)
    slot = reduce(lambda a, b: a * _CUTS + b, [F.col(p) for p in parts])
    return marked.select(*[F.col(f"`{c}`") for c in df.columns], slot.alias(SLICE), F.col(_HOT))


def _large(placed: DataFrame, keys: list[str], rows_per_task: int, spread: bool = False) -> DataFrame | None:
    """Keys of more than `rows_per_task` rows, if there are any; with `spread` only those whose rows differ in order, as others cannot be cut."""
    sizes = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.min(_ALONG).alias("__low"), F.max(_ALONG).alias("__high"))
    sizes = sizes.filter(F.col("__n") > rows_per_task)
    large = staged((sizes.filter("__low < __high") if spread else sizes).drop("__low", "__high"), "large-keys")
    return None if large.isEmpty() else large


def _cuts(placed: DataFrame, keys: list[str], large: DataFrame, rows_per_task: int) -> DataFrame:
    """Where to cut each of the large keys: the highest order of each slice but the last, at most `_CUTS` - 1 of them."""
    places = F.array(*(F.lit(i / _CUTS) for i in range(1, _CUTS)))
    found = (
        placed.alias("r").join(large.alias("l"), _same("r", "l", keys))
        .groupBy(*[F.col(f"r.`{k}`").alias(k) for k in keys])
        .agg(F.max("l.__n").alias("__n"), F.percentile_approx(f"r.{_ALONG}", places, 100 * _CUTS).alias("__all"))
    )
    pieces = F.least(F.lit(_CUTS), F.ceil(F.col("__n") * _OVERSAMPLE / rows_per_task)).cast("int")
    wanted = F.transform(F.sequence(F.lit(1), F.greatest(pieces - 1, F.lit(1))),
                         lambda i: F.element_at("__all", (i * F.lit(_CUTS) / pieces).cast("int")))
    return staged(found.select(*keys, F.array_distinct(wanted).alias("__cuts")), "large-key-cuts")


def unsplit(df: DataFrame) -> DataFrame:
    return df.drop(SLICE, _HOT)


def is_split(df: DataFrame) -> bool:
    return SLICE in df.columns


def _window(df: DataFrame, keys: Sequence[str], by: Column) -> WindowSpec:
    return Window.partitionBy(*keys, *([SLICE] if SLICE in df.columns else [])).orderBy(by)


def _with_edges(inner: DataFrame, rows: DataFrame, keys: Sequence[str], value: Column, across: Column) -> DataFrame:
    """Join each slice of a large key with `across`, evaluated over one `value` per slice of its key.

    The values are aggregated from the large keys' rows alone, on the map side first; there are as many as slices,
    and they are stored, so Spark knows their size.
    """
    edges = rows.filter(_HOT).groupBy(*keys, SLICE).agg(value.alias(_EDGE)).withColumn(_EDGE, across)
    edges = staged(edges, "slice-edges")
    joined = inner.alias("r").join(edges.alias("l"), _same("r", "l", [*keys, SLICE]), "left")
    return joined.select(*[F.col(f"r.`{c}`") for c in inner.columns], F.col(f"l.{_EDGE}").alias(_EDGE))


def _neighbour(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence, name: str, back: bool) -> DataFrame:
    step, edge = (F.lag, F.max_by) if back else (F.lead, F.min_by)
    payload = F.struct(*columns)
    inner = df.withColumn(name, step(payload).over(_window(df, keys, F.col(order).asc())))
    if SLICE not in df.columns:
        return inner
    across = step(_EDGE).over(Window.partitionBy(*keys).orderBy(SLICE))
    joined = _with_edges(inner, df, keys, edge(payload, F.col(order)), across)
    return joined.select(*df.columns, F.coalesce(F.col(name), F.col(_EDGE)).alias(name))


def previous(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence, name: str) -> DataFrame:
    """Add struct `name` holding `columns` of the row before (NULL struct on the first row)."""
    return _neighbour(df, keys, order, columns, name, back=True)


def following(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence, name: str) -> DataFrame:
    """Add struct `name` holding `columns` of the row after (NULL struct on the last row)."""
    return _neighbour(df, keys, order, columns, name, back=False)


def carry_forward(
    df: DataFrame, keys: Sequence[str], order: str, mark: Column, columns: Sequence[str], name: str
) -> DataFrame:
    """Add struct `name`: `columns` of the nearest marked row at or before this one.

    `order` is one column that totally orders the rows of a key (a struct where
    ties need breaking).
    """
    payload = F.struct(*columns)
    so_far = _window(df, keys, F.col(order).asc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = df.withColumn(name, F.last(F.when(mark, payload), ignorenulls=True).over(so_far))
    if SLICE not in df.columns:
        return inner
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    last_marked = F.max_by(payload, F.when(mark, F.col(order)))
    joined = _with_edges(inner, df, keys, last_marked, F.last(_EDGE, ignorenulls=True).over(before))
    return joined.select(*df.columns, F.coalesce(F.col(name), F.col(_EDGE)).alias(name))


def numbered(df: DataFrame, keys: Sequence[str], order: str, name: str, descending: bool = False) -> DataFrame:
    """Add `name`: position 1, 2, ... of the row among the rows of its key."""
    w = _window(df, keys, F.col(order).desc() if descending else F.col(order).asc())
    inner = df.withColumn(name, F.row_number().over(w).cast("long"))
    if SLICE not in df.columns:
        return inner
    slots = F.col(SLICE).desc() if descending else F.col(SLICE).asc()
    before = Window.partitionBy(*keys).orderBy(slots).rowsBetween(Window.unboundedPreceding, -1)
    joined = _with_edges(inner, df, keys, F.count(F.lit(1)), F.sum(_EDGE).over(before))
    return joined.select(*df.columns, (F.col(name) + F.coalesce(F.col(_EDGE), F.lit(0))).alias(name))
