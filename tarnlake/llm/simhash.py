"""SimHash near duplicates by fuzzy hashing with the perfect Golay code.

A 64-bit fingerprint is cut into three segments of 23, 23 and 18 bits (the last is padded with zeros
to 23). The binary Golay code of length 23 puts every 23-bit word within 3 bits of exactly one of
4,096 codewords, so a word decodes to a 12-bit index. The decodings of a word and of its 23
one-bit neighbours are one or six indices: its fuzzy keys. Two words that differ in one bit share a
key, as the decoding of either is among the keys of the other.

Two fingerprints within two bits: at least one segment is free of errors, and going round the three
segments there is one such segment whose successor has at most one error. So a row (segment, its 23
bits, index of the successor) per segment on one side meets (segment, its bits, each fuzzy key of
the successor) on the other. Rows that meet are verified by their bit distance.

Keys that many different fingerprints share would join all pairs among them. All fingerprints that
touch such a key take an exact way instead: a fingerprint and its 64 one-bit neighbours are its
centres; those that share a centre are within two bits of each other, and any two within two bits
share one. A centre has at most 65 fingerprints, and links to the smallest of them are enough.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tarnlake.llm import tokens
from tarnlake.llm.common import arrow_map, row_key, staged
from tarnlake.llm.components import components

SEGMENTS = ((0, 23), (23, 23), (46, 18))     # (first bit, bits)
BUSY = 32                                    # different fingerprints per key above which pairs are found by centres
_GENERATOR = 0b110001110101                  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, the Golay code's polynomial
_SLICE = 1 << 16


def _hashes(data: bytes, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(data[s:e], seed) for s, e in zip(starts.tolist(), ends.tolist())), np.uint64, len(starts))


def _votes(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each of the 64 bits set, lowest bit first."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _SLICE):
        part = hashes[at:at + _SLICE].astype("<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return total


def simhash(text: str | None, words_per_shingle: int = 3, seed: int = 42) -> int:
    """Fingerprint of one text (the batch form below gives the same)."""
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    n = max(1, len(found) - words_per_shingle + 1)
    shingles = [b" ".join(found[i:i + words_per_shingle]) for i in range(n)]
    hashes = np.array([xxhash.xxh64_intdigest(s, seed) for s in shingles], np.uint64)
    return int(np.packbits(2 * _votes(hashes) > n, bitorder="little").view("<u8")[0])


def _fingerprinter(size: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.chunks(batch):
                w = tokens.words(part.column(1))
                data, at = tokens.squeezed(w)
                data = data.lower()                          # bytes: A-Z only
                prints = np.zeros(part.num_rows, np.uint64)
                for d, (lo, hi) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist())):
                    if hi == lo:
                        continue
                    last = max(lo, hi - size)                # first word of the last shingle
                    ends = at[np.minimum(np.arange(lo, last + 1) + size, hi)] - 1
                    votes = _votes(_hashes(data, at[lo:last + 1], ends, seed))
                    prints[d] = np.packbits(2 * votes > last + 1 - lo, bitorder="little").view("<u8")[0]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(prints.view(np.int64))], ["doc_id", "text_key", "fp"])
    return run


def fingerprints(docs: DataFrame, words_per_shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, text_key, fp long) for every document, from its whole text.

    A-Z are lower-cased, shingles count as often as they occur, a text shorter than a shingle is one
    shingle, and a null or empty text has fingerprint zero.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text", row_key()[1]), _fingerprinter(words_per_shingle, seed),
                     f"doc_id {id_type}, text_key long, fp long")


@cache
def golay_index() -> np.ndarray:
    """For each 23-bit word the index of the one codeword within 3 bits of it."""
    codewords = np.zeros(4096, np.int64)
    for i in range(12):
        codewords ^= np.where(np.arange(4096) >> i & 1, _GENERATOR << i, 0)
    bits = 1 << np.arange(23)
    errors = [0, *bits, *(a | b for i, a in enumerate(bits) for b in bits[:i]),
              *(a | b | c for i, a in enumerate(bits) for j, b in enumerate(bits[:i]) for c in bits[:j])]
    index = np.full(1 << 23, -1, np.int16)
    for e in errors:                                         # 2,048 error patterns x 4,096 codewords fill the space
        index[codewords ^ e] = np.arange(4096)
    return index


def fuzzy_keys(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in `word`, index) pairs: the codeword indices of each word and its one-bit neighbours."""
    index = golay_index()
    near = np.concatenate([index[word][:, None], index[word[:, None] ^ (1 << np.arange(23))]], axis=1)
    near.sort(axis=1)
    fresh = np.ones(near.shape, dtype=bool)
    fresh[:, 1:] = near[:, 1:] != near[:, :-1]
    row, _ = np.nonzero(fresh)
    return row, near[fresh]


def _segment(fp: np.ndarray, which: int) -> np.ndarray:
    first, size = SEGMENTS[which]
    return (fp >> np.uint64(first) & np.uint64((1 << size) - 1)).astype(np.int64)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join keys of each fingerprint: `own` marks the one with the successor's own codeword."""
    index = golay_index()
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for which in range(len(SEGMENTS)):
            exact, word = _segment(fp, which), _segment(fp, (which + 1) % len(SEGMENTS))
            row, near = fuzzy_keys(word)
            key = np.int64(which) << 60 | exact[row] << 12 | near
            yield pa.RecordBatch.from_arrays(
                [pa.array(fp[row].view(np.int64)), pa.array(key), pa.array(near == index[word][row])], ["fp", "key", "own"])


def _close(max_bits: int):
    return F.expr(f"bit_count(x ^ y) <= {max_bits}")


def links(prints: DataFrame, max_bits: int = 2, busy: int = BUSY) -> DataFrame:
    """(x, y) links among the different fingerprints `prints` (fp: long, distinct).

    Every pair within `max_bits` (at most 2) is linked, directly or through common neighbours: the
    connected components are those of the full graph.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("the segments carry pairs of at most 2 differing bits")
    keys = staged(arrow_map(prints.select("fp"), _keys, "fp long, key long, own boolean"), "simhash-keys")
    crowded = keys.filter("own").groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > busy).select("key")
    crowded = staged(crowded, "simhash-crowded")
    x = keys.filter("own").join(crowded, "key", "left_anti").select("key", F.col("fp").alias("x"))
    y = keys.select("key", F.col("fp").alias("y"))
    sparse = x.join(y, "key").filter("x <> y").filter(_close(max_bits)).select("x", "y")
    dense = keys.join(crowded, "key", "left_semi").select("fp").distinct()
    return sparse.unionAll(_by_centres(dense, max_bits))


def _by_centres(prints: DataFrame, max_bits: int) -> DataFrame:
    """Exact links by common centres. With fewer than 2 bits allowed, only the fingerprint itself or pairs
    with a fingerprint as centre count."""
    flips = F.expr("transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i))")
    centres = prints.select("fp", F.explode(F.concat(F.array("fp"), flips)).alias("centre"))
    if max_bits < 2:
        near = centres.join(prints.select(F.col("fp").alias("centre")), "centre", "left_semi").filter("fp <> centre")
        return near.filter(F.lit(max_bits > 0)).select(F.col("centre").alias("x"), F.col("fp").alias("y"))
    least = centres.groupBy("centre").agg(F.min("fp").alias("x"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return centres.join(least, "centre").filter("fp <> x").select("x", F.col("fp").alias("y")).distinct()


def grouped(docs: DataFrame, words_per_shingle: int, max_bits: int, seed: int, busy: int) -> tuple[DataFrame, DataFrame]:
    """Stored tables of the documents (doc_id, text_key, fp) and of the different fingerprints (fp, least_id, part), `part`
    being the smallest fingerprint of its component. Copies are one fingerprint from the start, so a group of
    copies of any size costs one row in the search.
    """
    rows = staged(fingerprints(docs, words_per_shingle, seed), "simhash-prints")
    prints = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-distinct")
    found = staged(links(prints, max_bits, busy), "simhash-links")
    parts = components(found.select(F.col("x").alias("a"), F.col("y").alias("b")), "simhash")
    placed = prints.join(parts, prints["fp"] == parts["node"], "left").select(
        "fp", "least_id", F.coalesce("component", "fp").alias("part"))
    return rows, staged(placed, "simhash-parts")


def near_duplicates(
    docs: DataFrame, words_per_shingle: int = 3, max_bits: int = 2, seed: int = 42, busy: int = BUSY
) -> DataFrame:
    """(doc_id, fingerprint, component_id) per document; near duplicates share a component, its smallest doc_id.

    Null and empty texts have fingerprint zero and are linked like any other. Rows with a null
    doc_id take part and get the smallest non-null id of their component, if it has one. Repeated rows give
    repeated results. Other columns are not read.
    """
    rows, placed = grouped(docs, words_per_shingle, max_bits, seed, busy)
    named = placed.groupBy("part").agg(F.min("least_id").alias("component_id"))
    ids = placed.join(named, "part").select("fp", "component_id")
    return rows.join(ids, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(
    docs: DataFrame, words_per_shingle: int = 3, max_bits: int = 2, seed: int = 42, busy: int = BUSY
) -> DataFrame:
    """The documents, with all their columns, that stay when one of each component does: that of the smallest id.

    A document without an id stays only where no other of its component has one; of several texts under the
    staying id, one stays. Rows that repeat an id and a text are one document.
    """
    rows, placed = grouped(docs, words_per_shingle, max_bits, seed, busy)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_key"))
    per_print = staged(rows.groupBy("fp").agg(first.alias("first")), "simhash-first")
    per_part = per_print.join(placed, "fp").groupBy("part").agg(F.min("first").alias("first"))
    kept = per_part.select(F.col("first.doc_id").alias("__id"), F.col("first.text_key").alias("__key"))
    keyed = docs.withColumn("__own", row_key()[1])
    on = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__key"))
    return keyed.join(kept, on, "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))
