"""Ranked lexical search: the best documents of each item, by weights of the terms they share.

Items are the stated query set. They are worked on in blocks of bounded size, each against all documents:

1. documents are read once and only what an item's term matches is stored: term number and frequency, and the document's length;
2. counts of documents per term, of documents and of terms give the weights;
3. a task takes its documents in lots. For each item the bitmaps of its terms over the lot are laid over each other, so that documents
   fall into groups with the same mask of matched terms. A mask's maximum score is the sum of the highest share each of its terms has in
   the lot. Masks are evaluated in descending order of it; when the next maximum lies below the score of the last place held so far, from this and
   earlier lots, no other document can get in and the item is finished;
4. the places held by the tasks, at most `k` each, meet in one ranking.

A block of items costs one reading of the texts. As every document meets every item anyway, reading them again for a full block (by
default a million terms) is a small part of the work, and memory does not grow with the items.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tarnlake.llm import tokens
from tarnlake.llm.common import arrow_map, staged, work_path
from tarnlake.session import remove

K = 50
BLOCK_TERMS = 1 << 20         # terms of the items worked on together
LOT_DOCS, LOT_POSTINGS = 1 << 13, 1 << 21
_MASK_BYTES = 1 << 26         # masks of one item over a lot
_FIRST = 64                   # documents evaluated before the bound is looked at again; doubled each time

# Terms are runs of ASCII letters and digits and of all characters beyond ASCII; A-Z count as a-z.
_BLANK = np.ones(256, dtype=bool)
for _low, _high in (("0", "9"), ("A", "Z"), ("a", "z")):
    _BLANK[ord(_low):ord(_high) + 1] = False
_BLANK[0x80:] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def terms(texts: pa.Array) -> tokens.Words:
    found = tokens.words(texts, _BLANK)
    return tokens.Words(_LOWER[found.data], found.bounds, found.starts, found.ends, found.first)


def _some(w: tokens.Words, at: np.ndarray) -> tokens.Words:
    return tokens.Words(w.data, w.bounds, w.starts[at], w.ends[at], np.zeros(1, np.int64))


@dataclass
class Items:
    """A block of items: ids, each one's distinct terms as numbers, and the terms' two hashes, ordered by the first."""

    ids: list
    terms: list[np.ndarray]
    found: np.ndarray
    sure: np.ndarray

    @staticmethod
    def of(ids: list, texts: list[str]) -> "Items":
        w = terms(pa.array(texts, pa.string()))
        found, first = np.unique(tokens.word_hashes(w), return_index=True)
        number = np.searchsorted(found, tokens.word_hashes(w))
        return Items(ids, [np.unique(number[a:b]) for a, b in zip(w.first, w.first[1:])], found,
                     tokens.word_hashes(_some(w, first), 1))

    def lookup(self, w: tokens.Words) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words that are terms of items, and the terms' numbers. The second hash is taken of those only."""
        hashes = tokens.word_hashes(w)
        number = np.minimum(np.searchsorted(self.found, hashes), len(self.found) - 1)
        at = np.flatnonzero(self.found[number] == hashes)
        at = at[tokens.word_hashes(_some(w, at), 1) == self.sure[number[at]]]
        return at, number[at]


def _indexer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        many = len(items.found)
        for batch in batches:
            for part in tokens.chunks(batch):
                w = terms(part.column(1))
                at, number = items.lookup(w)
                doc = np.searchsorted(w.first, at, "right") - 1
                pairs, tf = np.unique(doc * many + number, return_counts=True)
                ends = np.searchsorted(pairs, np.arange(part.num_rows + 1) * many).astype(np.int32)
                rows = pa.array(np.flatnonzero(w.counts))
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v.astype(np.int32))) for v in (pairs % many, tf)]
                columns = [part.column(0), pa.array(w.counts.astype(np.int64)), *lists]
                yield pa.RecordBatch.from_arrays([c.take(rows) for c in columns], ["doc_id", "n", "terms", "tf"])
    return run


def _counter(size: int):
    """Documents per term of a task; number -1 counts documents, -2 their terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs, length = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            df += np.bincount(batch.column(1).flatten().to_numpy(), minlength=size)
            docs, length = docs + batch.num_rows, length + int(batch.column(0).to_numpy().sum())
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(([-1, -2], held)).astype(np.int32)), pa.array(np.concatenate(([docs, length], df[held])))],
            ["term", "n"])
    return run


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


class Lot:
    """Documents of a task worked on together: postings by term, with the share of the score a term's weight is multiplied by."""

    def __init__(self, ids: pa.Array, n: np.ndarray, sizes: np.ndarray, number: np.ndarray, tf: np.ndarray, docs: int, length: int):
        self.none = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(len(n)), sizes)
        order = np.argsort(number, kind="stable")            # documents stay in order within a term
        self.doc, tf = doc[order], tf[order].astype(np.int64)
        m = 50 + (50 * n * docs) // length
        self.share = (1_000_000_000 * tf) // (1000 * tf + 20 * m[self.doc])
        self.terms, first = np.unique(number[order], return_index=True)
        self.first = np.append(first, len(order))
        self.highest = np.maximum.reduceat(self.share, first) if len(first) else np.zeros(0, np.int64)


def _groups(masks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Documents in an order that brings equal masks together, and where groups start."""
    key = masks[0]
    for word in masks[1:]:                                    # masks of more than 64 bits: number what was told apart so far
        _, before = np.unique(key, return_inverse=True)
        _, here = np.unique(word, return_inverse=True)
        key = before * (int(here.max(initial=0)) + 1) + here
    order = np.argsort(key, kind="stable")
    return order, np.flatnonzero(np.concatenate(([True], key[order][1:] != key[order][:-1]))) if len(order) else np.zeros(0, np.int64)


class Best:
    """The places an item has given so far: score, then id, null ids last."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.none, self.ids = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    @property
    def last(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else 0

    def add(self, score: np.ndarray, none: np.ndarray, ids: np.ndarray) -> None:
        in_reach = score >= max(self.last, 1)
        score, none, ids = (np.concatenate((old, new[in_reach])) for old, new in ((self.score, score), (self.none, none), (self.ids, ids)))
        order = np.lexsort((ids, none, -score))[:self.k]
        self.score, self.none, self.ids = score[order], none[order], ids[order]


def search_lot(lot: Lot, item: np.ndarray, weights: np.ndarray, best: Best) -> int:
    """Bring an item's best places up to date with a lot; returns how many documents were evaluated."""
    slot = np.searchsorted(lot.terms, item)
    held = slot < len(lot.terms)
    held[held] = lot.terms[slot[held]] == item[held]
    slot, worth = slot[held], weights[item[held]]
    done, docs = 0, len(lot.ids)
    if not len(slot):
        return done
    span = max(64, _MASK_BYTES // (8 * -(-len(slot) // 64)))
    for low in range(0, docs, span):                         # one stretch, unless the item has very many terms
        high = min(docs, low + span)
        parts = [(lot.first[s] + np.searchsorted(lot.doc[lot.first[s]:lot.first[s + 1]], [low, high])) for s in slot] if span < docs else [
            (lot.first[s], lot.first[s + 1]) for s in slot]
        masks = [np.zeros(high - low, np.uint64) for _ in range(0, len(slot), 64)]
        for k, (a, b) in enumerate(parts):
            masks[k // 64][lot.doc[a:b] - low] |= np.uint64(1 << k % 64)
        order, first = _groups(masks)
        heads = order[first]
        ceiling = np.zeros(len(heads), np.int64)
        for k in range(len(slot)):
            ceiling += (masks[k // 64][heads] >> np.uint64(k % 64) & np.uint64(1)).astype(np.int64) * (worth[k] * lot.highest[slot[k]])
        ends = np.append(first[1:], len(order))
        turn = np.argsort(-ceiling, kind="stable")
        turn = turn[:np.searchsorted(-ceiling[turn], 0)]     # masks without a term of any weight score nothing
        at, want = 0, _FIRST
        while at < len(turn) and ceiling[turn[at]] >= best.last:
            filled = np.cumsum(ends[turn[at:]] - first[turn[at:]])
            to = min(at + int(np.searchsorted(filled, want)) + 1, at + int(np.searchsorted(-ceiling[turn[at:]], -best.last, "right")))
            chosen = np.concatenate([order[first[g]:ends[g]] for g in turn[at:to]])
            score = np.zeros(len(chosen), np.int64)
            for k, (a, b) in enumerate(parts):
                has = np.flatnonzero(masks[k // 64][chosen] >> np.uint64(k % 64) & np.uint64(1))
                score[has] += worth[k] * lot.share[a + np.searchsorted(lot.doc[a:b], chosen[has] + low)]
            best.add(score, lot.none[chosen + low], lot.ids[chosen + low])
            done, at, want = done + len(chosen), to, want * 2
    return done


def _lots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    waiting, docs, postings = [], 0, 0
    for batch in batches:
        waiting.append(batch)
        docs, postings = docs + batch.num_rows, postings + len(batch.column(2).flatten())
        if docs >= LOT_DOCS or postings >= LOT_POSTINGS:
            yield pa.Table.from_batches(waiting)
            waiting, docs, postings = [], 0, 0
    if docs:
        yield pa.Table.from_batches(waiting)


def _searcher(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights, docs, length, k = shared.value
        best = [Best(k) for _ in items]
        for table in _lots(batches):
            lists = [table.column(c).combine_chunks() for c in ("doc_id", "n", "terms", "tf")]
            sizes = np.diff(lists[2].offsets.to_numpy())
            lot = Lot(lists[0], lists[1].to_numpy(), sizes, lists[2].flatten().to_numpy(), lists[3].flatten().to_numpy(), docs, length)
            for item, places in zip(items, best):
                search_lot(lot, item, weights, places)
        for at in range(0, len(best), 256):
            part = best[at:at + 256]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(at, at + len(part)), [len(b.score) for b in part])),
                 pa.array(np.concatenate([b.ids for b in part]), pa.int64(), mask=np.concatenate([b.none for b in part])),
                 pa.array(np.concatenate([b.score for b in part]))],
                ["item", "doc_id", "score"])
    return run


def _blocks(items: DataFrame, block_terms: int) -> Iterator[Items]:
    """Items in blocks of at most about `block_terms` terms; an item longer than that is a block of its own."""
    ids, texts, size = [], [], 0
    for row in items.toLocalIterator():
        length = len(terms(pa.array([row["text"]], pa.string())).starts)
        if ids and size + length > block_terms:
            yield Items.of(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(row["item_id"])
        texts.append(row["text"])
        size += max(length, 1)
    if ids:
        yield Items.of(ids, texts)


def rank(docs: DataFrame, items: DataFrame, k: int = K, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score) of the `k` best documents of each item: score above 0, highest first, then by ascending doc_id.

    A term weighs floor(1000 ln((2N + 2) / (2df + 1))) over the N documents with a term; a document gives it
    10^9 tf div (1000 tf + 20 m), where m is 50 plus 50 times its length in terms over the mean length, rounded down. Null and empty texts
    have no terms: such items have no rows, such documents are not counted. Rows count each by itself: an item's row that is
    repeated repeats its ranking, repeated documents take a place each. doc_id is an integer; null ids come last among equal scores.
    """
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    wanted = staged(items.select("item_id", F.col("text").cast("string").alias("text")).filter("text IS NOT NULL"), "search-items")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = work_path(spark, "search-places")
    blocks = 0
    for block in _blocks(wanted, block_terms):
        if not len(block.found):
            continue
        path = work_path(spark, "search-postings")
        shared = spark.sparkContext.broadcast(block)         # bounded by block_terms
        arrow_map(texts, _indexer(shared), "doc_id long, n long, terms array<int>, tf array<int>").write.parquet(path)
        postings = spark.read.parquet(path)
        counted = arrow_map(postings.select("n", "terms"), _counter(len(block.found)), "term int, n long")
        counts = {r["term"]: r["n"] for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}   # terms of the block
        shared.destroy()
        n_docs, length = counts.get(-1, 0), counts.get(-2, 0)
        weights = np.array([weight(n_docs, counts[t]) if t in counts else 0 for t in range(len(block.found))], np.int64)
        scored = [item[weights[item] > 0] for item in block.terms]
        shared = spark.sparkContext.broadcast((scored, weights, n_docs, max(length, 1), k))
        places = arrow_map(postings, _searcher(shared), "item long, doc_id long, score long")
        ids = spark.createDataFrame(list(enumerate(block.ids)), f"item long, item_id {kind}")
        places.join(ids, "item").withColumn("block", F.lit(blocks)).write.mode("append").parquet(found)
        shared.destroy()
        remove(spark, path)
        blocks += 1
    if not blocks:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    order = Window.partitionBy("block", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    places = spark.read.parquet(found).withColumn("rank", F.row_number().over(order))
    return places.filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
