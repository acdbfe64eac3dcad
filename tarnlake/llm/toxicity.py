"""Toxicity by a small convolutional network over words.

A word's embedding is the sum of the embeddings of its hash and of the hashes of its beginnings, so that inflected forms share what
their stem has learnt. Filters of several widths run over the words; each filter's values are max-pooled over four stretches of the text, and the largest
of the four and their mean, which tells one occurrence from many, go into a logistic output. All of it is numpy, forward and backward.

Every labelled row is learnt from. The rows are spread over shards of a few thousand; in each round every shard goes on from the
common weights by itself, in a task of Spark, and the weights of all shards are averaged, an embedding over the shards that moved it.
A fifth of the rows is kept back from that: on all of these the threshold of every language is set, the language being that
predicted from the text by the machines of `langid`, so scoring needs nothing but the text. A score is the network's output moved so
that its language's threshold lies at 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from copy import deepcopy
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tarnlake.llm import langid, tokens
from tarnlake.llm.common import arrow_map, ship, staged

BUCKETS, DIMENSION = 1 << 17, 16
STEMS = (3, 4, 5, 6, 8)       # bytes of a word's beginning
WIDTHS, FILTERS, STRETCHES = (1, 2, 3), 8, 4
SHARD = 8192                  # rows learnt from between two averages, about
LANGUAGE_SAMPLE = 300         # documents per language the language machines are fitted on
FEW = 10                      # rows of either class below which a language takes the threshold of all
_ROUNDS, _LEAST_STEPS, _BATCH, _STEP, _DECAY = 8, 400, 64, 0.02, 1e-5
_MEETINGS = 3                 # averages where there are several shards
_KEPT_BACK = 5
_HELD = 1 << 22               # words a shard holds in memory; with more it is learnt from as several
_BLOCK = 1024                 # embeddings averaged at once
_GRID, _FAR = 64, 30          # thresholds are set on log-odds in steps of 1 / 64, from -30 to 30
_LONG = 1 << 19               # words worked on at once; a longer text is read piece by piece

# Letters, digits and everything beyond ASCII make words; A-Z count as a-z.
_BLANK = np.ones(256, dtype=bool)
for _low, _high in (("0", "9"), ("A", "Z"), ("a", "z")):
    _BLANK[ord(_low):ord(_high) + 1] = False
_BLANK[0x80:] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


@dataclass
class Vocabulary:
    """Words of documents: the distinct ones, by a hash of 64 bits, with their embedding rows (distinct, 1 + stems), which of them
    each word is, and the bounds of the documents. Row 0 is no word."""

    distinct: np.ndarray
    rows: np.ndarray
    ids: np.ndarray
    first: np.ndarray

    @staticmethod
    def joined(parts: list["Vocabulary"]) -> "Vocabulary":
        """That of the documents of all parts, one after the other."""
        same, distinct = pd.factorize(np.concatenate([p.distinct for p in parts]))
        many = np.cumsum([0] + [len(p.distinct) for p in parts])
        ids = np.concatenate([same[at:to].astype(np.int32)[p.ids] for p, at, to in zip(parts, many, many[1:])])
        sizes = np.concatenate([np.diff(p.first) for p in parts])
        return Vocabulary(distinct, np.concatenate([p.rows for p in parts])[_places(same, len(distinct))], ids, np.concatenate(([0], np.cumsum(sizes))))


def _places(ids: np.ndarray, many: int) -> np.ndarray:
    """Where each of `many` ids occurs first."""
    out = np.empty(many, np.int64)
    out[ids[::-1]] = np.arange(len(ids))[::-1]
    return out


def vocabulary(texts: pa.Array) -> Vocabulary:
    """Words of texts. Words recur, so what follows from a word is worked out once for all its places."""
    found = tokens.words(texts, _BLANK)
    data = _LOWER[found.data]
    ids, distinct = pd.factorize(tokens.word_hashes(tokens.Words(data, found.bounds, found.starts, found.ends, found.first)))
    at = _places(ids, len(distinct))
    starts, length = found.starts[at], (found.ends - found.starts)[at]
    rows = np.empty((len(distinct), 1 + len(STEMS)), np.int32)
    rows[:, 0] = distinct % np.uint64(BUCKETS - 1) + np.uint64(1)
    run = np.zeros(len(distinct), np.uint64)
    for size in range(1, max(STEMS) + 1):
        held = length >= size
        letter = np.where(held, data[np.minimum(starts + size - 1, max(len(data) - 1, 0))] if len(data) else 0, 0)
        run = run * np.uint64(257) + letter.astype(np.uint64) + np.uint64(1)
        if size in STEMS:
            stem = tokens.mix(run * np.uint64(16) + np.uint64(size)) % np.uint64(BUCKETS - 1) + np.uint64(1)
            rows[:, 1 + STEMS.index(size)] = np.where(held, stem, 0)
    return Vocabulary(distinct, rows, ids.astype(np.int32), found.first)


def buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows of every word, (words, 1 + stems), and the bounds of the documents."""
    found = vocabulary(texts)
    return found.rows[found.ids], found.first


@dataclass
class Net:
    """Embeddings (row 0 stays zero), filters by width, bias, and output weights for the largest and the mean of a filter's pools."""

    embedding: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray

    @staticmethod
    def fresh(seed: int = 42) -> "Net":
        rng = np.random.default_rng(seed)
        embedding = rng.normal(0, 0.1, (BUCKETS, DIMENSION)).astype(np.float32)
        embedding[0] = 0
        filters = [rng.normal(0, 0.3, (w, DIMENSION, FILTERS)).astype(np.float32) for w in WIDTHS]
        many = len(WIDTHS) * FILTERS
        return Net(embedding, filters, np.zeros(many, np.float32), np.append(rng.normal(0, 0.1, 2 * many), 0.0).astype(np.float32))

    def words(self, rows: np.ndarray) -> np.ndarray:
        """Embeddings of words."""
        word = self.embedding.take(rows[:, 0], axis=0)
        for c in range(1, rows.shape[1]):
            word += self.embedding.take(rows[:, c], axis=0)
        return word

    def lay(self, rows: np.ndarray, first: np.ndarray, ids: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words' embeddings side by side, each document followed by the empty places the widest filter reaches into; where
        words stand; bounds of the documents' stretches. With `ids` these are the words, as places in `rows`."""
        docs, reach, size = len(first) - 1, max(WIDTHS) - 1, np.diff(first)
        many = len(rows) if ids is None else len(ids)
        place = np.arange(many) + np.repeat(np.arange(docs) * reach, size)
        laid = np.zeros((many + docs * reach, DIMENSION), np.float32)
        if many:
            laid[place] = self.words(rows) if ids is None else self.words(rows).take(ids, axis=0)
        begins = first[:-1] + np.arange(docs) * reach
        return laid, place, begins[:, None] + size[:, None] * np.arange(STRETCHES + 1) // STRETCHES

    def values(self, laid: np.ndarray, k: int) -> np.ndarray:
        """Values of the filters of one width at every place."""
        out = laid @ self.filters[k][0]
        for j in range(1, WIDTHS[k]):
            out[:-j] += laid[j:] @ self.filters[k][j]
        out += self.bias[k * FILTERS:(k + 1) * FILTERS]
        return out

    def odds(self, pools: np.ndarray) -> np.ndarray:
        """Log-odds from pools (documents, stretches, filters)."""
        seen = np.concatenate([pools.max(axis=1), pools.mean(axis=1)], axis=1)
        return seen.astype(np.float64) @ self.out[:-1].astype(np.float64) + float(self.out[-1])

    def forward(self, rows: np.ndarray, first: np.ndarray, ids: np.ndarray | None = None) -> np.ndarray:
        """Log-odds of each document; one without words has empty pools."""
        laid, _, cuts = self.lay(rows, first, ids)
        low, high = cuts[:, :-1].ravel(), cuts[:, 1:].ravel()
        full = np.flatnonzero(high > low)
        pools = np.zeros((len(low), len(WIDTHS) * FILTERS), np.float32)
        if len(full):
            bounds = np.stack([low[full], high[full]], axis=1).ravel()
            for k in range(len(WIDTHS)):
                pools[full, k * FILTERS:(k + 1) * FILTERS] = np.maximum(_largest(self.values(laid, k), bounds)[::2], 0)
        return self.odds(pools.reshape(len(first) - 1, STRETCHES, -1))

    def peaks(self, rows: np.ndarray, first: np.ndarray, ids: np.ndarray | None = None, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Pools (documents, stretches, filters) and the words at which they begin, a piece of about `_LONG` words at a time. With `ids`
        these are the words, as places in `rows`; `known` are the embeddings of `rows`, if there is room for them."""
        ids = np.arange(len(rows)) if ids is None else ids
        docs, size = len(first) - 1, np.diff(first)
        cuts = first[:-1, None] + size[:, None] * np.arange(STRETCHES + 1) // STRETCHES
        low, high, ends = cuts[:, :-1].ravel(), cuts[:, 1:].ravel(), np.repeat(first[1:], STRETCHES)
        pools, where = np.zeros((len(low), len(WIDTHS) * FILTERS), np.float32), np.zeros((len(low), len(WIDTHS) * FILTERS), np.int64)
        pools[high > low] = -np.inf
        for at in range(0, len(ids), _LONG):
            to = min(at + _LONG, len(ids))
            some = np.flatnonzero((low < to) & (high > at) & (high > low))
            begin, end = np.maximum(low[some], at), np.minimum(high[some], to)
            word = np.zeros((to - at + max(WIDTHS) - 1, DIMENSION), np.float32)
            reach = min(to + max(WIDTHS) - 1, len(ids))
            word[:reach - at] = self.words(rows[ids[at:reach]]) if known is None else known.take(ids[at:reach], axis=0)
            stretch = np.repeat(np.arange(len(some)), end - begin)
            left = np.repeat(ends[some], end - begin) - np.arange(at, to)           # words of the document from each on
            for k, width in enumerate(WIDTHS):
                span = slice(k * FILTERS, (k + 1) * FILTERS)
                value = word[:to - at] @ self.filters[k][0]
                for j in range(1, width):
                    more = word[j:to - at + j] @ self.filters[k][j]
                    more[left <= j] = 0
                    value += more
                value += self.bias[span]
                best = _largest(value, begin - at)
                there, f = np.divmod(np.flatnonzero(value == best.take(stretch, axis=0)), FILTERS)
                place = np.empty(best.shape, np.int64)
                place[stretch[there[::-1]], f[::-1]] = there[::-1] + at             # the first of equal ones is set last
                better = best > pools[some, span]
                where[some, span] = np.where(better, place, where[some, span])
                pools[some, span] = np.where(better, best, pools[some, span])
        shape = (docs, STRETCHES, -1)
        return np.maximum(pools, 0).reshape(shape), where.reshape(shape)

    def long(self, rows: np.ndarray) -> np.ndarray:
        """The same for one document, a piece of each stretch at a time."""
        cuts = len(rows) * np.arange(STRETCHES + 1) // STRETCHES
        pools = np.zeros((1, STRETCHES, len(WIDTHS) * FILTERS), np.float32)
        for s, (low, high) in enumerate(zip(cuts, cuts[1:])):
            for at in range(low, high, _LONG // 2):
                to = min(at + _LONG // 2, high)
                piece = rows[at:to + max(WIDTHS) - 1]         # what lies beyond the piece is only reached into
                laid = self.lay(piece, np.array([0, len(piece)]))[0]
                for k in range(len(WIDTHS)):
                    span = slice(k * FILTERS, (k + 1) * FILTERS)
                    pools[0, s, span] = np.maximum(pools[0, s, span], self.values(laid, k)[:to - at].max(axis=0))
        return self.odds(pools)


def _largest(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Largest values of each column in the runs of rows that begin there."""
    return np.maximum.reduceat(np.ascontiguousarray(values.T), begins, axis=1).T


class _Trainer:
    """Adam on filters and output, Adagrad on the embeddings a batch touches."""

    def __init__(self, net: Net):
        self.net, self.steps = net, 0
        self.dense = [*net.filters, net.bias, net.out]
        self.m, self.v = [np.zeros_like(p) for p in self.dense], [np.zeros_like(p) for p in self.dense]
        self.seen = np.full(len(net.embedding), 1e-3, np.float32)

    def rest(self) -> list[np.ndarray]:
        """All that is learnt but embeddings."""
        return [*self.dense, *self.m, *self.v]

    def learn(self, rows: np.ndarray, first: np.ndarray, label: np.ndarray, weight: np.ndarray, ids: np.ndarray | None = None) -> None:
        net, docs = self.net, len(first) - 1
        ids = np.arange(len(rows)) if ids is None else ids
        known = net.words(rows) if len(rows) <= _LONG else None
        pools, where = net.peaks(rows, first, ids, known)
        error = (1 / (1 + np.exp(-net.odds(pools))) - label) * weight / docs
        many = pools.shape[2]
        seen = np.concatenate([pools.max(axis=1), pools.mean(axis=1)], axis=1)
        back_out = np.append(error @ seen, error.sum())
        largest = np.arange(STRETCHES)[None, :, None] == pools.argmax(axis=1)[:, None, :]
        back = error[:, None, None] * (largest * net.out[:many] + net.out[many:2 * many] / STRETCHES) * (pools > 0)
        back_filters, hits, slopes = [], [], []
        ends = np.repeat(first[1:], STRETCHES)
        for k, width in enumerate(WIDTHS):
            span, filters = slice(k * FILTERS, (k + 1) * FILTERS), np.zeros_like(net.filters[k])
            at, slope = where[:, :, span].reshape(-1, FILTERS), back[:, :, span].reshape(-1, FILTERS).astype(np.float32)
            for f in range(FILTERS):
                for j in range(width):
                    hit = np.flatnonzero((slope[:, f] != 0) & (at[:, f] + j < ends))      # beyond a document there is nothing to learn
                    words, own = at[hit, f] + j, slope[hit, f]
                    filters[j, :, f] = own @ (net.words(rows[ids[words]]) if known is None else known.take(ids[words], axis=0))
                    hits.append(words)
                    slopes.append(own[:, None] * net.filters[k][j, :, f])
            back_filters.append(filters)
        self._dense([*back_filters, back.sum(axis=(0, 1)), back_out])
        hit, slope = np.concatenate(hits), np.concatenate(slopes)
        words, begin, order = _grouped(hit)
        if len(words):
            self._embeddings(rows[ids[words]], np.add.reduceat(slope.take(order, axis=0), begin))

    def _dense(self, slopes: list[np.ndarray]) -> None:
        self.steps += 1
        for p, m, v, slope in zip(self.dense, self.m, self.v, slopes):
            slope = slope + _DECAY * p
            m += 0.1 * (slope - m)
            v += 0.001 * (slope * slope - v)
            p -= _STEP * 0.5 * (m / (1 - 0.9 ** self.steps)) / (np.sqrt(v / (1 - 0.999 ** self.steps)) + 1e-8)

    def _embeddings(self, rows: np.ndarray, slope: np.ndarray) -> None:
        hit = np.flatnonzero(np.abs(slope).any(axis=1))
        if not len(hit):
            return
        used, begin, order = _grouped(rows[hit].ravel())
        total = np.add.reduceat(slope.take(hit[order // rows.shape[1]], axis=0), begin, axis=0)
        keep = used > 0
        used, total = used[keep], total[keep]
        self.seen[used] += (total * total).mean(axis=1)
        self.net.embedding[used] -= _STEP * total / np.sqrt(self.seen[used])[:, None]


def _grouped(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values, ascending; where each begins in the order that sorts them; that order, which keeps equal ones as they come.

    Value and place are sorted as one number, which is quicker than to sort places by value.
    """
    bits = int(len(values)).bit_length()
    both = np.sort((values.astype(np.int64) << bits) + np.arange(len(values)))
    found = both >> bits
    begin = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1]))) if len(found) else np.zeros(0, np.int64)
    return found[begin], begin, both & ((1 << bits) - 1)


def _study(trainer: _Trainer, docs: Vocabulary, label: np.ndarray, weight: np.ndarray, passes: int, rng: np.random.Generator) -> None:
    """Learn from documents a number of times, in a new order each time."""
    first = docs.first
    for _ in range(passes):
        order = rng.permutation(len(label))
        for at in range(0, len(order), _BATCH):
            some = order[at:at + _BATCH]
            size = (first[1:] - first[:-1])[some]
            take = np.repeat(first[some] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
            ids, own = pd.factorize(docs.ids[take])
            trainer.learn(docs.rows[own], np.concatenate(([0], np.cumsum(size))), label[some], weight[some], ids)


def threshold(odds: np.ndarray, label: np.ndarray, many: np.ndarray | None = None) -> float:
    """Log-odds above which label 1 is predicted with the best F1, in the middle of the widest gap that gives it; `many` rows each."""
    order = np.argsort(odds, kind="stable")
    n = np.ones(len(odds), np.int64) if many is None else many[order]
    x, y = odds[order], label[order].astype(np.int64) * n
    caught = y.sum() - np.concatenate(([0], np.cumsum(y)))                # of label 1 at or above each cut
    f1 = 2 * caught / np.maximum(y.sum() + n.sum() - np.concatenate(([0], np.cumsum(n))), 1)
    edges = np.concatenate(([x[0] - 1], x, [x[-1] + 1]))
    gap = np.diff(edges)
    best = max(np.flatnonzero(gap > 0), key=lambda i: (round(float(f1[i]), 9), gap[i]))
    return float((edges[best] + edges[best + 1]) / 2)


@dataclass
class Model:
    """A network with its thresholds by language, or, where only one class was there to learn from, a constant."""

    net: Net | None
    languages: langid.Model
    thresholds: dict[str, float] = field(default_factory=dict)
    general: float = 0.0
    constant: float = 0.0

    def language(self, text: np.ndarray) -> str | None:
        return self.languages.predict(langid.features(text))[0] if self.languages.labels and len(text) else None

    def spoken(self, texts: pa.Array) -> list[str | None]:
        data, bounds = tokens.buffers(texts)
        return [self.language(data[a:b]) for a, b in zip(bounds, bounds[1:])]

    def odds(self, texts: pa.Array) -> np.ndarray:
        found = vocabulary(texts)
        rows, ids, first = found.rows, found.ids, found.first
        return self.net.forward(rows, first, ids) if len(ids) <= _LONG else np.concatenate(
            [self.net.long(rows[ids[a:b]]) if b - a > _LONG else self.net.forward(rows[ids[a:b]], np.array([0, b - a])) for a, b in zip(first, first[1:])])

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Scores from 0 to 1; those of at least 0.5 are predicted to be of label 1."""
        if self.net is None:
            return np.full(len(texts), self.constant)
        moved = self.odds(texts) - np.array([self.thresholds.get(name, self.general) for name in self.spoken(texts)])
        return np.round(1 / (1 + np.exp(-np.clip(moved, -30, 30))), 6)


class _Sum:
    """What the shards of a task moved: sums by block of embeddings, with how many shards moved each, and of all else."""

    def __init__(self, start: _Trainer):
        self.start, self.shards = start, 0
        self.moved = np.zeros(len(start.seen), np.float64)
        self.sums = np.zeros((len(start.seen), DIMENSION + 1), np.float64)
        self.rest = np.zeros(sum(p.size for p in start.rest()), np.float64)

    def add(self, trainer: _Trainer) -> None:
        hit = np.flatnonzero(trainer.seen != self.start.seen)
        self.moved[hit] += 1
        self.sums[hit, :DIMENSION] += trainer.net.embedding[hit].astype(np.float64) - self.start.net.embedding[hit]
        self.sums[hit, DIMENSION] += trainer.seen[hit].astype(np.float64) - self.start.seen[hit]
        self.rest += np.concatenate([p.ravel() for p in trainer.rest()])
        self.shards += 1

    def blocks(self) -> pa.RecordBatch:
        parts = [np.append(self.rest, self.shards)]
        for at in range(0, len(self.moved), _BLOCK):
            hit = at + np.flatnonzero(self.moved[at:at + _BLOCK])
            parts.append(np.concatenate([hit[:, None], self.moved[hit, None], self.sums[hit]], axis=1).ravel())
        full = [i for i, part in enumerate(parts) if len(part)]
        return pa.RecordBatch.from_arrays([
            pa.array(full, pa.int32()), pa.array([parts[i].astype(np.float32).tobytes() for i in full], pa.binary())], ["block", "sums"])


def _add_up(rows: pd.DataFrame) -> pd.DataFrame:
    """Averages of one block: its embeddings that were moved, or (block 0) all else."""
    parts = sorted(rows["sums"])                                    # they arrive in any order
    if rows["block"].iloc[0] == 0:
        total = sum(np.frombuffer(part, np.float32).astype(np.float64) for part in parts)
        return pd.DataFrame([{"block": 0, "means": (total[:-1] / total[-1]).astype(np.float32).tobytes()}])
    found = np.concatenate([np.frombuffer(part, np.float32) for part in parts]).reshape(-1, DIMENSION + 3).astype(np.float64)
    places, own = np.unique(found[:, 0], return_inverse=True)
    total = np.zeros((len(places), DIMENSION + 2))
    np.add.at(total, own, found[:, 1:])
    means = np.concatenate([places[:, None], total[:, 1:] / total[:, :1]], axis=1)
    return pd.DataFrame([{"block": rows["block"].iloc[0], "means": means.astype(np.float32).tobytes()}])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Vocabulary, np.ndarray]]:
    """Rows (shard, text, label), which lie by shard, as the words and labels of a shard at a time."""
    held: list = []

    def whole():
        return Vocabulary.joined([found for found, _ in held]), np.concatenate([label for _, label in held])

    last, words = None, 0
    for batch in batches:
        for part in tokens.chunks(batch):
            shard = part.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1), len(shard)]
            for a, b in zip(cuts, cuts[1:]):
                if held and (shard[a] != last or words > _HELD):
                    yield last, *whole()
                    held, words = [], 0
                found = vocabulary(part.column(1).slice(a, b - a))
                held.append((found, part.column(2).slice(a, b - a).to_numpy().astype(np.float64)))
                last, words = shard[a], words + len(found.ids)
    if held:
        yield last, *whole()


def _learner(shared, weights: tuple[float, float], passes: int, turn: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _Sum(shared.value)
        for shard, docs, label in _shards(batches):
            trainer = deepcopy(shared.value)
            _study(trainer, docs, label, np.where(label > 0, weights[1], weights[0]), passes, np.random.default_rng([42, turn, int(shard)]))
            total.add(trainer)
        if total.shards:
            yield total.blocks()
    return run


def _fit(rows: DataFrame, counts: Mapping[int, int], shards: int) -> Net:
    """Train a network on `rows` (shard, text, label), which lie by shard; both classes weigh the same."""
    n = sum(counts.values())
    rounds, passes = (_MEETINGS, 2) if shards > 1 else (1, max(_ROUNDS, -(-_LEAST_STEPS * _BATCH // n)))
    state, weights = _Trainer(Net.fresh()), (n / (2 * counts[0]), n / (2 * counts[1]))
    for turn in range(rounds):
        shared = rows.sparkSession.sparkContext.broadcast(state)         # weights of fixed size
        got = arrow_map(rows, _learner(shared, weights, passes, turn), "block int, sums binary").groupBy("block").applyInPandas(
            _add_up, "block int, means binary").collect()                # at most a row per block of the weights
        state = deepcopy(state)
        state.steps += passes * -(-n // (shards * _BATCH))
        for block, means in got:
            means = np.frombuffer(means, np.float32)
            if block == 0:
                for p, mean in zip(state.rest(), np.split(means, np.cumsum([p.size for p in state.rest()])[:-1])):
                    p[...] = mean.reshape(p.shape)
            else:
                means = means.reshape(-1, DIMENSION + 2)
                hit = means[:, 0].astype(np.int64)
                state.net.embedding[hit] += means[:, 1:-1]
                state.seen[hit] += means[:, -1]
        shared.destroy()
    return state.net


def _teller(shared):
    """Rows of (text, label) as (language, step of the log-odds, label)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.chunks(batch):
                odds = np.clip(shared.value.odds(part.column(0)), -_FAR, _FAR)
                yield pa.RecordBatch.from_arrays([
                    pa.array(shared.value.spoken(part.column(0)), pa.string()), pa.array(np.rint(odds * _GRID).astype(np.int32)), part.column(1)],
                    ["language", "step", "label"])
    return run


def _set_thresholds(model: Model, back: DataFrame) -> None:
    """Set thresholds on all rows kept back. What comes to the driver is a count per language, step and label, however many rows there are."""
    shared = back.sparkSession.sparkContext.broadcast(model)
    found = arrow_map(back, _teller(shared), "language string, step int, label int").groupBy("language", "step", "label").count().toPandas()
    found = found.sort_values(["step", "label"], kind="stable")
    for name in [None, *sorted(found["language"].dropna().unique())]:
        own = found if name is None else found[found["language"] == name]
        label, many = own["label"].to_numpy(), own["count"].to_numpy()
        if min(many[label == 1].sum(), many[label == 0].sum()) >= FEW:
            cut = threshold(own["step"].to_numpy() / _GRID, label, many)
            if name is None:
                model.general = cut
            else:
                model.thresholds[name] = cut
    shared.destroy()


def train(docs: DataFrame, labels: DataFrame, languages: langid.Model, per_class: int | None = None) -> Model:
    """Fit on `labels` (doc_id, label 0 or 1) and the texts of `docs`; `languages` tells the language of a text.

    All labelled rows are used, whole: four fifths to learn from, a fifth, chosen by a hash of doc_id, for the thresholds. With `per_class` only
    about as many documents of label 1, and twice as many of label 0, are. Other labels are passed over; an id with several labels has
    the largest. Where a class is missing nothing is fitted and the score is 1 or 0, as all labels are (0 without any).
    """
    spark = docs.sparkSession
    known = labels.select("doc_id", F.col("label").cast("int").alias("label")).filter("doc_id IS NOT NULL AND label IN (0, 1)")
    known = staged(known.groupBy("doc_id").agg(F.max("label").alias("label")), "toxicity-labels")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return Model(None, languages, constant=1.0 if 1 in counts else 0.0)
    if per_class:
        some = {k: round(min(1.0, per_class * (2 - k) / n) * 1_000_000) for k, n in counts.items()}
        known = staged(known.filter(F.expr("pmod(xxhash64(doc_id, 'toxicity'), 1000000)") < F.when(F.col("label") == 1, some[1]).otherwise(some[0])),
                       "toxicity-chosen")
    shards = max(1, sum(r["count"] for r in known.groupBy("label").count().collect()) // SHARD)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(known, "doc_id").withColumns({
        "back": F.expr(f"pmod(xxhash64(doc_id, 'back'), {_KEPT_BACK}) = 0"), "turn": F.expr("xxhash64(doc_id, 'turn')")})
    rows = rows.withColumn("shard", F.expr(f"cast(pmod(turn, {shards}) AS int)"))
    rows = staged(rows.repartition(shards, "shard").sortWithinPartitions("shard", "turn", "doc_id", "text"), "toxicity-rows")
    found = {(r["back"], r["label"]): r["count"] for r in rows.groupBy("back", "label").count().collect()}
    if len({label for _, label in found}) < 2:
        return Model(None, languages, constant=float(max((label for _, label in found), default=0)))
    counts = {label: found.get((False, label), 0) for label in (0, 1)}
    learnt = rows.filter("NOT back")
    if not min(counts.values()):                     # too few to keep any back
        counts, learnt = {label: counts[label] + found.get((True, label), 0) for label in (0, 1)}, rows
    model = Model(_fit(learnt.select("shard", "text", "label"), counts, shards), languages)
    if learnt is not rows:
        _set_thresholds(model, rows.filter("back").select("text", "label"))
    return model


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.chunks(batch):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(shared.value.scores(part.column(1)))], ["doc_id", "score"])
    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every document, from its whole text alone. Null and empty texts score as texts without words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)     # weights of fixed size, one vector per pair of languages
    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), _scorer(shared), f"doc_id {kind}, score double")
