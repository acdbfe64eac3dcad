"""Words of whole texts, for a batch of documents at a time, as numpy arrays.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r. Texts are read from the
Arrow buffers as UTF-8 bytes, so nothing is decoded or copied per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20         # text worked on at once; a longer document is one chunk
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
_U = np.uint64
_BASES = (_U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93))
_C1, _C2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


@dataclass
class Words:
    """Words of consecutive documents: `starts`/`ends` into `data`, `first[d]:first[d + 1]` are those of document d."""

    data: np.ndarray
    bounds: np.ndarray         # byte bounds of the documents in `data`
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        """Document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def per_doc(self, values: np.ndarray, bounds: np.ndarray | None = None) -> np.ndarray:
        """Sum of `values` (one per word, or per byte with `bounds`) for each document."""
        total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
        return np.diff(total[self.first if bounds is None else bounds])

    def positions_left(self) -> np.ndarray:
        """Words from each word to the end of its document, itself included."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.starts))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and document bounds of a string or binary array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"") if texts.null_count else texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into row ranges of about `limit` bytes of text, to bound the working memory."""
    _, bounds = buffers(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def words(texts: pa.Array, blank: np.ndarray = BLANK) -> Words:
    """Word positions of every text of the array; `blank` tells for each byte value whether it separates words."""
    data, bounds = buffers(texts)
    solid = ~blank[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True                                   # a document's end ends a word
    before = np.concatenate(([False], solid[:-1])) & ~edge[:-1] if len(data) else solid
    after = np.concatenate((solid[1:], [False])) & ~edge[1:] if len(data) else solid
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    return Words(data, bounds, starts, ends, np.searchsorted(starts, bounds))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 bits."""
    x = (x ^ (x >> _U(30))) * _C1
    x = (x ^ (x >> _U(27))) * _C2
    return x ^ (x >> _U(31))


def word_hashes(w: Words, which: int = 0) -> np.ndarray:
    """64-bit hash of each word's bytes; `which` picks one of two independent functions."""
    if not len(w.starts):
        return np.zeros(0, np.uint64)
    lengths = w.ends - w.starts
    base, longest = _BASES[which], int(lengths.max())
    powers = np.cumprod(np.full(longest, base, np.uint64))
    solid = np.repeat(w.starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) + np.arange(lengths.sum())
    at = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    within = solid - np.repeat(w.starts, lengths)
    terms = (w.data[solid].astype(np.uint64) + _U(1)) * powers[within]
    return mix(np.add.reduceat(terms, at) + lengths.astype(np.uint64) * _C2)


def join_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two adjoining runs of words, from the hashes of the runs; the order counts."""
    x = left * _C1 + (right ^ (right >> _U(32)))
    return (x ^ (x >> _U(29))) * _C2


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` words from each word on, by doubling; the last size - 1 entries are meaningless.

    Runs may reach into the next document: callers keep positions with at least `size` words left.
    """
    def shifted(h: np.ndarray, by: int) -> np.ndarray:
        return np.concatenate((h[by:], np.zeros(min(by, len(h)), np.uint64)))

    out, covered, power, span = None, 0, hashes, 1
    while True:
        if size & span:
            out = power if out is None else join_hashes(out, shifted(power, covered))
            covered += span
        if span * 2 > size:
            return out
        power = join_hashes(power, shifted(power, span))
        span *= 2


def covered(starts: np.ndarray, lengths: np.ndarray | int, total: int) -> np.ndarray:
    """Mask of `total` positions that lie in any of the ranges."""
    steps = np.bincount(starts, minlength=total + 1)
    steps = steps - np.bincount(np.asarray(starts) + lengths, minlength=total + 1)[: total + 1] if len(starts) else steps
    return np.cumsum(steps[:total]) > 0


def squeezed(w: Words) -> tuple[bytes, np.ndarray]:
    """All words followed by one space each, and the byte position of each word in that."""
    lengths = w.ends - w.starts
    at = np.concatenate(([0], np.cumsum(lengths + 1)))
    out = np.full(int(at[-1]), 0x20, np.uint8)
    source = np.repeat(w.starts, lengths) + ramp(lengths)
    out[np.repeat(at[:-1], lengths) + ramp(lengths)] = w.data[source]
    return out.tobytes(), at


def ramp(lengths: np.ndarray) -> np.ndarray:
    """0..length-1 for each length, one after the other."""
    total = int(lengths.sum())
    return np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
