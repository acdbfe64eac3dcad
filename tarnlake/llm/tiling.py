"""Benchmark decontamination by greedy string tiling.

A document is contaminated by a benchmark item when tiles cover enough of the item. Tiles are common
runs of at least `min_match` words, marked longest first and never overlapping, wherever they stand, so a passage whose
parts were moved about is still covered. Words are runs of letters, digits and bytes above ASCII; A-Z are lower-cased.

Documents and items meet by a join of seeds, the runs of `min_match` words (a shorter item is one seed):

1. the items' seeds set the bits of a filter of fixed size; documents are read once, and of their runs only those the filter passes
   are stored, each once per document. No item goes through the driver, and the benchmark's size changes the number of rows, not of readings;
2. counting those rows tells how frequent each seed is. An item is looked for by its rarest seeds alone, as many as it takes that a
   document without any of them cannot reach the coverage: the other seeds cover too little of the item. Seeds that stand everywhere are thus never joined,
   and an item of which too much is in no document at all is given up;
3. documents that share such a seed with an item are the candidate pairs. Only their texts are shuffled; a pair whose shared seeds cover too little is given
   up, the others are tiled by running Karp-Rabin matching.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tarnlake.llm import tokens
from tarnlake.llm.common import arrow_map, row_key, ship, staged

MIN_MATCH = 5
COVERAGE = 0.8
_ITEM_WORDS = 1 << 20          # words of items a task keeps at hand
FILTER_BITS = 25               # the filter has 2^25 bits, 4 MB
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
SEPARATOR = np.ones(256, dtype=bool)
SEPARATOR[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = False
HIT_SCHEMA = "text_key long, item_id {item}, matched long, item_words long"


def _words(texts: pa.Array) -> tuple[tokens.Words, np.ndarray]:
    w = tokens.words(texts, SEPARATOR)
    w.data = _LOWER[w.data]
    return w, tokens.word_hashes(w)


def _seeder(min_match: int):
    """Seeds of each item: (item, words, length, seed, within), one row per seed and place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.chunks(batch):
                w, hashes = _words(part.column(1))
                length = np.minimum(w.counts, min_match)           # an item shorter than a tile must match as a whole
                doc, left = w.doc, w.positions_left()
                for n in sorted(set(length.tolist()) - {0}):
                    at = np.flatnonzero((length[doc] == n) & (left >= n))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(doc[at])), pa.array(w.counts[doc[at]].astype(np.int64)),
                         pa.array(np.full(len(at), n, np.int32)), pa.array(tokens.gram_hashes(hashes, n)[at].view(np.int64)),
                         pa.array((at - w.first[doc[at]]).astype(np.int32))], ["item", "words", "length", "seed", "within"])
    return run


def seed_filter(seeds: DataFrame) -> tuple[list[int], np.ndarray]:
    """Lengths of the seeds, and a bit per value of their last bits, put together from Spark's bitmaps of 32,768 bits."""
    bit = F.col("seed").bitwiseAND(F.lit((1 << FILTER_BITS) - 1)) + 1
    marked = seeds.select(F.bitmap_bucket_number(bit).alias("bucket"), F.bitmap_bit_position(bit).alias("position"))
    parts = marked.groupBy("bucket").agg(F.bitmap_construct_agg("position").alias("bits")).collect()      # at most 1,024 of 4 KB
    bits = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for r in parts:
        at = (r["bucket"] - 1) * 4096
        bits[at:at + 4096] = np.frombuffer(r["bits"], np.uint8)
    return [r["length"] for r in seeds.select("length").distinct().collect()], bits


def _prober(shared):
    """Runs of each document that the filter passes: (doc_id, text_key, length, seed), each once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, bits = shared.value
        for batch in batches:
            for part in tokens.chunks(batch):
                w, hashes = _words(part.column(2))
                left, doc = w.positions_left(), w.doc
                for n in lengths:
                    own = tokens.gram_hashes(hashes, n)
                    low = (own & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)
                    at = np.flatnonzero((bits[low >> 3] >> (low & 7).astype(np.uint8) & 1).astype(bool) & (left >= n))
                    order = at[np.lexsort((own[at], doc[at]))]
                    if not len(order):
                        continue
                    fresh = np.concatenate(([True], (own[order][1:] != own[order][:-1]) | (doc[order][1:] != doc[order][:-1])))
                    rows = pa.array(doc[order][fresh])
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(rows), part.column(1).take(rows), pa.array(np.full(len(rows), n, np.int32)),
                         pa.array(own[order][fresh].view(np.int64))], ["doc_id", "text_key", "length", "seed"])
    return run


def covered(within: np.ndarray, length: int) -> int:
    """Words that seeds at these places cover."""
    place = np.unique(within)
    return int(np.minimum(np.diff(place, append=place[-1] + length), length).sum()) if len(place) else 0


def _telling(coverage: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """The rarest seeds of one item, as many as leave too little of it without them."""
        need, length = math.ceil(coverage * int(rows["words"].iloc[0]) - 1e-9), int(rows["length"].iloc[0])
        seeds = rows.groupby("seed").agg(docs=("docs", "first")).reset_index().sort_values(["docs", "seed"])
        rank = dict(zip(seeds["seed"], range(len(seeds))))
        place, turn = rows["within"].to_numpy(), rows["seed"].map(rank).to_numpy()
        low, high = 1, len(seeds)                                # how many are taken; all leave nothing
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if covered(place[turn >= middle], length) < max(need, 1) else (middle + 1, high)
        taken = seeds[:low]
        return pd.DataFrame({"item": rows["item"].iloc[0], "length": length, "seed": taken["seed"], "docs": taken["docs"]})
    return run


def tile(item: list[int], text: list[int | None], min_match: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (position in item, position in text, length) of the tiles; None in `text` matches nothing.

    Rounds look for matches of a shrinking length by comparing running hashes of unmarked stretches; a match much longer
    than looked for restarts the search at its length, so that longer tiles are always marked before shorter ones.
    """
    used_a, used_b = [False] * len(item), [t is None for t in text]
    tiles: list[tuple[int, int, int]] = []
    size = max(min_match, min(len(item), 64))
    while True:
        matches = sorted(_matches(item, text, used_a, used_b, size), key=lambda m: (-m[0], m[1], m[2]))
        if matches and matches[0][0] > 2 * size:
            size = matches[0][0]
            continue
        for n, i, j in matches:
            if any(used_a[i:i + n]) or any(used_b[j:j + n]):
                break                      # what is left of it may be longer or shorter than the next: look again
            used_a[i:i + n] = used_b[j:j + n] = [True] * n
            tiles.append((i, j, n))
        if not matches:
            if size == min_match:
                return tiles
            size = max(min_match, size // 2)


def _matches(item: list, text: list, used_a: list[bool], used_b: list[bool], size: int) -> Iterator[tuple[int, int, int]]:
    """(length, position in item, position in text) of the unmarked common stretches of at least `size` words that
    can be extended on neither side."""
    index: dict[int, list[int]] = {}
    for i, h in _windows(item, used_a, size):
        index.setdefault(h, []).append(i)
    for j, h in _windows(text, used_b, size) if index else ():
        for i in index.get(h, ()):
            if item[i:i + size] != text[j:j + size]:
                continue
            if i and j and not used_a[i - 1] and not used_b[j - 1] and item[i - 1] == text[j - 1]:
                continue                   # found one word to the left already
            n = size
            while (i + n < len(item) and j + n < len(text) and not used_a[i + n] and not used_b[j + n]
                   and item[i + n] == text[j + n]):
                n += 1
            yield n, i, j


_MASK, _BASE = (1 << 61) - 1, 1_000_003


def _windows(seq: list, used: list[bool], size: int) -> Iterator[tuple[int, int]]:
    """(start, running hash) of every stretch of `size` unmarked words."""
    top, run, h = pow(_BASE, size - 1, _MASK), 0, 0
    for k, word in enumerate(seq):
        if used[k]:
            run, h = 0, 0
            continue
        if run >= size:
            h = (h - seq[k - size] * top) % _MASK
        h = (h * _BASE + word) % _MASK
        run += 1
        if run >= size:
            yield k - size + 1, h


def _tiler(min_match: int, coverage: float):
    """Pairs of a document and an item: the words that tiles cover, for pairs where they are enough. A document's pairs come one after the other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple[str | None, np.ndarray] = (None, np.zeros(0, np.uint64))
        items: dict[str, np.ndarray] = {}
        for batch in batches:
            keep, matched, sizes = [], [], []
            for row, (text, item) in enumerate(zip(batch.column(2).to_pylist(), batch.column(4).to_pylist())):
                if text != known[0]:
                    known = text, _words(pa.array([text], pa.large_string()))[1]
                if item not in items:
                    if sum(map(len, items.values())) > _ITEM_WORDS:
                        items.clear()
                    items[item] = _words(pa.array([item], pa.large_string()))[1]
                own, length = items[item], min(min_match, len(items[item]))
                n = _matched(own, known[1], length, coverage)
                if n >= coverage * len(own) - 1e-9:
                    keep.append(row)
                    matched.append(n)
                    sizes.append(len(own))
            rows = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), batch.column(3).take(rows), pa.array(matched, pa.int64()),
                 pa.array(sizes, pa.int64())], ["doc_id", "text_key", "item_id", "matched", "item_words"])
    return run


def _matched(item: np.ndarray, text: np.ndarray, length: int, coverage: float) -> int:
    """Words of the item that tiles cover, 0 where its seeds in the text cover too few."""
    if not length or len(text) < length:
        return 0
    seeds, runs = (tokens.gram_hashes(h, length)[:len(h) - length + 1] for h in (item, text))
    if covered(np.flatnonzero(np.isin(seeds, runs)), length) < coverage * len(item) - 1e-9:
        return 0
    at = np.flatnonzero(np.isin(runs, seeds))
    keep = np.unique((at[:, None] + np.arange(length)).ravel())         # other words cannot be part of a tile
    found: list[int | None] = []
    for part in np.split(text[keep], np.flatnonzero(np.diff(keep) > 1) + 1):
        found += [*part.tolist(), None]
    return sum(n for _, _, n in tile(item.tolist(), found, length))


def hits(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, text_key, item_id, matched, item_words) of every document and item it contaminates.

    Items of fewer than `min_match` words must be found as a whole; null or empty items, and null or empty
    texts, match nothing. Items that repeat give repeated hits only for different ids; rows of documents that repeat have theirs each. An empty benchmark gives no hits. `coverage`
    must be above 0. The seeds, the runs that pass the filter and the seeds looked for are written when this is called.
    """
    if not 0 < coverage <= 1:
        raise ValueError("coverage must be above 0 and at most 1")
    spark = docs.sparkSession
    items = staged(benchmark.select("item_id", F.col("text").cast("string").alias("item_text")).filter("item_text IS NOT NULL").distinct().withColumn(
        "item", F.xxhash64("item_text")), "tiling-items")
    texts = items.groupBy("item").agg(F.min("item_text").alias("text"))
    seeds = staged(arrow_map(texts, _seeder(min_match), "item long, words long, length int, seed long, within int"), "tiling-seeds")
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(seed_filter(seeds))    # of fixed size
    rows = docs.select("doc_id", row_key()[1], "text")
    runs = staged(arrow_map(rows, _prober(shared), f"doc_id {kind}, text_key long, length int, seed long"), "tiling-runs")
    shared.destroy()
    ship(spark)
    key = ["length", "seed"]
    counted = seeds.join(staged(runs.groupBy(*key).agg(F.count(F.lit(1)).alias("docs")), "tiling-counts"), key, "left").fillna(0, ["docs"])
    telling = staged(counted.groupBy("item").applyInPandas(
        _telling(coverage), "item long, length int, seed long, docs long").filter("docs > 0"), "tiling-telling")
    pairs = runs.join(telling.select(*key, "item"), key).select("doc_id", "text_key", "item").distinct()
    wanted = staged(pairs.join(items, "item").select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "item_id", "item_text"), "tiling-pairs")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__key"))
    met = rows.join(wanted, same).select("doc_id", "text_key", "text", "item_id", "item_text").sortWithinPartitions("doc_id", "text_key")
    schema = f"doc_id {kind}, " + HIT_SCHEMA.format(item=benchmark.schema["item_id"].dataType.simpleString())
    return arrow_map(met, _tiler(min_match, coverage), schema)


def verdicts(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One row per document: whether it is contaminated, by which items, and the best coverage."""
    per_doc = found.groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"),
        F.max(F.col("matched") / F.col("item_words")).alias("coverage"))
    keyed = docs.select(*row_key())
    joined = keyed.alias("d").join(
        per_doc.alias("h"), F.expr("d.doc_id <=> h.doc_id AND d.text_key = h.text_key"), "left")
    return joined.select(
        "d.doc_id", F.col("h.item_ids").isNotNull().alias("contaminated"),
        F.coalesce(F.size("h.item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("h.coverage", F.lit(0.0)).alias("coverage"), "h.item_ids")


def clean(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents, with all their columns, that no item contaminates. Rows equal in id and text share their fate."""
    keys = found.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct()
    keyed = docs.withColumn("__own", row_key()[1])
    on = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__key"))
    return keyed.join(keys, on, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
