"""Vector codes: each part of a vector is replaced by the number of its nearest codebook entry.

Components become integers first, so distances and means are exact and no result hangs on how rows are spread. The codebooks
are fitted by Lloyd rounds over all vectors. A round after the first looks only where something can have changed: a part whose
entry stayed where it was keeps its distance from it, and as every other entry that did not move is no nearer than before, only
the moved entries are compared with that stored distance. Parts whose entry moved look through the whole codebook. Of entries
equally near the one with the lower number wins, as in a full search.

A round is one pass over the vectors with their entries and distances, written to the shared folder, and one sum of a row per
task, part, entry and position; what comes to the driver are the codebooks, whose size is a parameter times the dimension.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tarnlake.llm.common import arrow_map, staged, work_path
from tarnlake.session import remove

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
_EXACT = 1 << 53              # integers up to here are exact as doubles
_ROWS = 4096                  # vectors compared at once


def bounds(dimension: int, parts: int) -> list[int]:
    """Where parts start and end; they are equal where the dimension is a multiple of their number."""
    return [i * dimension // parts for i in range(parts + 1)]


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest entry of each row and its squared distance; the lower number wins a tie.

    Products of matrices are taken in doubles where every sum stays exact, in 64-bit integers elsewhere.
    """
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)), 1)
    kind = np.float64 if 4 * x.shape[1] * top * top < _EXACT else np.int64
    a, b = x.astype(kind), entries.astype(kind)
    found, far = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
    norms = (b * b).sum(axis=1)
    for at in range(0, len(x), _ROWS):
        part = a[at:at + _ROWS]
        distance = (part * part).sum(axis=1)[:, None] - 2 * (part @ b.T) + norms
        best = distance.argmin(axis=1)
        found[at:at + _ROWS], far[at:at + _ROWS] = best, distance[np.arange(len(part)), best]
    return found, far


def reassign(x: np.ndarray, entries: np.ndarray, moved: np.ndarray, held: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entries after some of them moved, given those held before and the exact distances to them."""
    held, far = held.copy(), far.copy()
    again = np.flatnonzero(moved[held])
    if len(again):
        held_again, far_again = nearest(x[again], entries)
    active = np.flatnonzero(moved)
    fixed = np.flatnonzero(~moved[held])
    if len(active) and len(fixed):
        near, distance = nearest(x[fixed], entries[active])
        near = active[near]
        better = (distance < far[fixed]) | ((distance == far[fixed]) & (near < held[fixed]))
        held[fixed[better]], far[fixed[better]] = near[better], distance[better]
    if len(again):
        held[again], far[again] = held_again, far_again
    return held, far


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _lists(values: np.ndarray) -> pa.Array:
    width = values.shape[1]
    return pa.FixedSizeListArray.from_arrays(pa.array(values.reshape(-1)), width).cast(pa.list_(pa.from_numpy_dtype(values.dtype)))


def _assigner(shared):
    """Rows with entries and distances; the first round has none to start from, so it looks at all entries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, books, moved = shared.value
        for batch in batches:
            x = _matrix(batch.column(2), cuts[-1]).astype(np.int64)
            held, far = np.empty((len(x), len(books)), np.int64), np.empty((len(x), len(books)), np.int64)
            if moved is not None:
                before, distances = _matrix(batch.column(3), len(books)), _matrix(batch.column(4), len(books))
            for p, book in enumerate(books):
                part = x[:, cuts[p]:cuts[p + 1]]
                held[:, p], far[:, p] = nearest(part, book) if moved is None else reassign(
                    part, book, moved[p], before[:, p].astype(np.int64), distances[:, p])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], _lists(held.astype(np.int32)), _lists(far)], ["id", "label", "vector", "entries", "distances"])
    return run


def _summer(shared):
    """Sums of the vectors' parts by entry: one row per position, position -1 for their number; one set of rows per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, books, _ = shared.value
        sums = [np.zeros(book.shape, np.int64) for book in books]
        sizes = [np.zeros(len(book), np.int64) for book in books]
        for batch in batches:
            x, held = _matrix(batch.column(0), cuts[-1]).astype(np.int64), _matrix(batch.column(1), len(books))
            for p in range(len(books)):
                if not len(x):
                    continue
                order = np.argsort(held[:, p], kind="stable")
                used, first = np.unique(held[order, p], return_index=True)
                sums[p][used] += np.add.reduceat(x[order, cuts[p]:cuts[p + 1]], first, axis=0)
                sizes[p] += np.bincount(held[:, p], minlength=len(books[p]))
        for p in range(len(books)):
            used = np.flatnonzero(sizes[p])
            values = np.concatenate([sizes[p][used, None], sums[p][used]], axis=1)
            width = values.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(values.size, p, np.int32)), pa.array(np.repeat(used, width).astype(np.int32)),
                 pa.array(np.tile(np.arange(-1, width - 1, dtype=np.int32), len(used))), pa.array(values.reshape(-1))],
                ["part", "entry", "position", "value"])
    return run


def _means(state: DataFrame, shared, books: list[np.ndarray]) -> list[np.ndarray]:
    """Codebooks with every used entry replaced by the mean of its parts, rounded down; unused entries stay."""
    sums = arrow_map(state.select("vector", "entries"), _summer(shared), "part int, entry int, position int, value long")
    total = sums.groupBy("part", "entry", "position").agg(F.sum("value").alias("value")).collect()   # as many as the codebooks hold
    size = {(r["part"], r["entry"]): r["value"] for r in total if r["position"] < 0}
    after = [book.copy() for book in books]
    for r in total:
        if r["position"] >= 0:
            after[r["part"]][r["entry"], r["position"]] = r["value"] // size[r["part"], r["entry"]]
    return after


def largest(dimension: Column) -> Column:
    """Magnitude of integers up to which all squared distances of a vector add up within 64 bits."""
    return F.floor(F.sqrt(F.lit(float(1 << 60)) / dimension))


def integers(vectors: DataFrame, id_column: str, vector_column: str, label_column: str, scale: int = SCALE) -> DataFrame:
    """(id, label, vector array<long>) of the rows that can be coded, components scaled and rounded down."""
    x = F.col(f"`{vector_column}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label_column}`").alias("label"), x.alias("vector"))
    fits = F.forall("vector", lambda c: F.coalesce(F.abs(c * scale) < F.col("limit"), F.lit(False)))     # NaN is larger than any number
    usable = rows.withColumn("limit", largest(F.size("vector"))).filter((F.size("vector") > 0) & fits)
    return usable.select("id", "label", F.transform("vector", lambda c: F.floor(c * scale).cast("long")).alias("vector"))


class _Rows:
    """The table a round reads; the one before it goes when the next is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.path = spark, None

    def put(self, df: DataFrame) -> DataFrame:
        before, self.path = self.path, work_path(self.spark, "vector-codes")
        df.write.parquet(self.path)
        if before:
            remove(self.spark, before)
        return self.spark.read.schema(df.schema).parquet(self.path)


def encode(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
           parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list[np.ndarray]]:
    """(id, label, vector, entries, distances) of every vector, and the codebooks.

    Left out are null and empty vectors, those with a null, NaN or infinite component, those whose components are too large for
    distances to fit 64 bits, and vectors of another length than most (of equally frequent lengths the least counts). The first
    codebooks are the parts of the `entries` vectors with the smallest ids, null ids last, equal ids by their
    vectors; fewer vectors make smaller codebooks. Repeated rows count as often as they occur. Without vectors there are no
    rows and the codebooks are empty.
    """
    spark = vectors.sparkSession
    table = _Rows(spark)
    rows = table.put(integers(vectors, id_column, vector_column, label_column, scale))
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    dimension = lengths["n"] if lengths else parts
    rows = rows.filter(F.size("vector") == dimension)
    state = "id {}, label {}, vector array<long>, entries array<int>, distances array<long>".format(
        *(rows.schema[c].dataType.simpleString() for c in ("id", "label")))
    first = rows.orderBy(F.asc_nulls_last("id"), "vector").limit(entries).select("vector").collect()
    cuts = bounds(dimension, parts)
    start = np.array([r["vector"] for r in first], np.int64).reshape(-1, dimension)
    books = [start[:, a:b] for a, b in zip(cuts, cuts[1:])]
    if not first:
        return spark.createDataFrame([], state), books
    moved = None
    for left in range(rounds, -1, -1):
        shared = spark.sparkContext.broadcast((cuts, books, moved))     # entries x dimension integers
        if moved is None or any(m.any() for m in moved):
            rows = table.put(arrow_map(rows, _assigner(shared), state))
        if left:
            after = _means(rows, shared, books)
            moved = [(new != old).any(axis=1) for new, old in zip(after, books)]
            books = after
        shared.destroy()
    return rows, books


def codes(state: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(id, label, code, error, label_error, codebooks_sha256) of the rows `encode` gives.

    The code has the entries in hex, in part order, two digits each (more where codebooks have over 256 entries); a label's errors
    are added up, nulls together, and are null where the sum exceeds 64 bits.
    """
    digits = max(2, len(f"{max(len(b) for b in books) - 1:x}"))
    error = F.aggregate("distances", F.lit(0).cast("long"), lambda a, b: a + b)
    code = F.concat(*(F.lpad(F.lower(F.hex(F.col("entries")[p].cast("long"))), digits, "0") for p in range(len(books))))
    rows = state.select("id", "label", code.alias("code"), error.alias("error"))
    sums = staged(rows.groupBy("label").agg(F.try_sum("error").alias("label_error")), "label-errors")
    text = ",".join(str(v) for book in books for v in book.reshape(-1).tolist())
    return rows.alias("r").join(sums.alias("s"), F.expr("r.label <=> s.label"), "left").select(
        "r.*", "s.label_error", F.lit(hashlib.sha256(text.encode()).hexdigest()).alias("codebooks_sha256"))
