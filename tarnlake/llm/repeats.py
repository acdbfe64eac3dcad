"""Removal of long passages that an earlier document has too, by prefix-partitioned suffix trees.

A suffix is what follows from a word on; suffixes with at least `min_words` words matter. A subtree holds the suffixes of one prefix
group: its leaves in lexical order, and between neighbours the number of words they share, which is the depth of the internal node that parts
them. Stretches of leaves that share at least `min_words` words are the subtree's deep nodes: their leaves begin with the
same passage, and all but those of the smallest id are repeats. Deeper nodes inside are longer repeats; those whose leaves follow different
words are the maximal ones (`maximal_repeats`).

Groups must fit in memory, and a suffix must not carry its own 50 words, as neighbours share 49 of them. So

* prefixes are taken where neighbours agree: of the 16-word prefixes that start and end within a suffix's first 50 words, the one with the
  smallest hash is its anchor, the leftmost if it stands there more than once. Equal passages have equal anchors, and neighbouring suffixes mostly the same, so they
  travel as one segment of text;
* prefixes have variable length. Suffixes whose anchors stand up to `span` words behind them share min_words + 1 - span words around it: 16 with
  all 35 places of the anchor in one group, 33 with 18, 50 with one. The first reading of the texts counts prefixes of 16 and 33 words
  without their texts. A prefix in one document only is given up; one whose group holds more than `GROUP_WORDS` words is lengthened;
* a group that is too large with the full `min_words` is a single deep node. It needs no tree, and is reduced to its smallest id before it is
  shuffled, so it may hold any share of all suffixes.

Rows of equal id and text are one document up to the removal. Texts are shuffled once, to meet their live segments and again their marks;
segments once, to their groups.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tarnlake.llm import tokens
from tarnlake.llm.common import arrow_map, staged

PREFIX = 16
SPAN = 18                     # places of the anchor that share a lengthened prefix
GROUP_WORDS = 1 << 15
BUFFER_BYTES = 1 << 21
SALTS = 32
NO_ID = np.iinfo(np.int64).max
_ROW = ["row_id", "doc_key"]


def _ids() -> list[Column]:
    """What tells rows apart: a hash of id and text, and the id, with the largest number for a missing one (it is smaller than no other)."""
    return [F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("row_id"),
            F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NO_ID))).alias("doc_key")]


def _shift(x: np.ndarray, by: int) -> np.ndarray:
    return np.concatenate((x[by:], np.zeros(min(by, len(x)), x.dtype)))


def anchors(hashes: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """For the suffix at each word, the smallest hash of a prefix inside its first `min_words` words, and where the leftmost such stands."""
    least, place, span, width = tokens.gram_hashes(hashes, PREFIX), np.arange(len(hashes)), 1, min_words - PREFIX + 1

    def widened(by: int) -> tuple[np.ndarray, np.ndarray]:
        later, where = _shift(least, by), _shift(place, by)
        right = later < least                                 # a tie goes to the left
        return np.where(right, later, least), np.where(right, where, place)

    while span * 2 <= width:
        least, place = widened(span)
        span *= 2
    return widened(width - span) if width > span else (least, place)


def _runs(w: tokens.Words, hashes: np.ndarray, min_words: int) -> tuple[np.ndarray, ...]:
    """(first word, suffixes, anchor) of the stretches of neighbouring suffixes of a document with one anchor; within them, the stretches
    that share a lengthened prefix: its hash, their suffixes, and where each stretch's own begin."""
    at = np.flatnonzero(w.positions_left() >= min_words)
    if not len(at):
        return at, at, np.zeros(0, np.uint64), np.zeros(0, np.uint64), at, np.zeros(1, np.int64)
    span = min(SPAN, min_words - PREFIX)
    anchor, place = (x[at] for x in anchors(hashes, min_words))
    begin = at + (place - at) % span
    longer = tokens.gram_hashes(hashes, min_words + 1 - span)[begin]
    opens = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (np.diff(at) != 1)))
    cut = opens | np.concatenate(([True], begin[1:] != begin[:-1]))
    first, pieces = np.flatnonzero(opens), np.flatnonzero(cut)
    return (at[first], np.diff(np.append(first, len(at))), anchor[first], longer[pieces], np.diff(np.append(pieces, len(at))),
            np.searchsorted(pieces, np.append(first, len(at))))


def _segmenter(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.chunks(batch):
                w = tokens.words(part.column(2))
                start, n, anchor, longer, size, own = _runs(w, tokens.word_hashes(w), min_words)
                doc = np.searchsorted(w.first, start, "right") - 1
                rows = pa.array(doc)
                # 32 bits of the lengthened prefix will do beside the anchor: where two agree by chance their groups are one
                pieces = pa.StructArray.from_arrays(
                    [pa.array((longer >> np.uint64(32)).astype(np.uint32).view(np.int32)), pa.array(size.astype(np.int32))], ["longer", "n"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), part.column(0).take(rows), part.column(1).take(rows),
                     pa.array((start - w.first[doc]).astype(np.int32)), pa.array(n.astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(own.astype(np.int32)), pieces)],
                    ["anchor", "row_id", "doc_key", "start", "n", "pieces"])
    return run


def _wanted(part: pa.RecordBatch, w: tokens.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word in the chunk, suffixes, prefix) of the runs listed in column `runs`; neighbours of one prefix become one."""
    lists = part.column(part.schema.get_field_index("runs"))
    flat, doc = lists.flatten(), np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
    start, n, prefix = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
    order = np.lexsort((start, doc))
    doc, start, n, prefix = doc[order], start[order].astype(np.int64), n[order].astype(np.int64), prefix[order]
    if not len(doc):
        return doc, start, n, prefix
    apart = (doc[1:] != doc[:-1]) | (prefix[1:] != prefix[:-1]) | (start[1:] != start[:-1] + n[:-1])
    first = np.flatnonzero(np.concatenate(([True], apart)))
    return doc[first], start[first] + w.first[:-1][doc[first]], np.add.reduceat(n, first), prefix[first]


def _shipper(min_words: int):
    """The words of each wanted segment."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.chunks(batch):
                w = tokens.words(part.column(2))
                data, at = tokens.squeezed(w)
                doc, start, n, prefix = _wanted(part, w)
                text = [data[lo:hi] for lo, hi in zip(at[start].tolist(), (at[start + n + min_words - 1] - 1).tolist())]
                rows = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(prefix), part.column(0).take(rows), part.column(1).take(rows),
                     pa.array((start - w.first[doc]).astype(np.int32)), pa.array(text, pa.binary())],
                    ["prefix", "row_id", "doc_key", "start", "words"])
    return run


def _unroller(min_words: int):
    """The suffixes of each wanted segment, by two hashes of their first `min_words` words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.chunks(batch):
                w = tokens.words(part.column(2))
                full = [tokens.gram_hashes(tokens.word_hashes(w, which), min_words) for which in (0, 1)]
                doc, start, n, _ = _wanted(part, w)
                at = np.repeat(start, n) + tokens.ramp(n)
                doc = np.repeat(doc, n)
                rows = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(h[at].view(np.int64)) for h in full), part.column(0).take(rows), part.column(1).take(rows),
                     pa.array((at - w.first[doc]).astype(np.int32))], ["h1", "h2", "row_id", "doc_key", "start"])
    return run


class Subtree:
    """Suffixes of some segments as the leaves of a tree: `order` has them in lexical order (of their words' hashes), `depth` how many
    words each shares with the leaf before it.

    `hashes` are the words of all segments, `first` their bounds, `at` the words at which suffixes begin. Suffixes end with
    their segment. Equal runs of 1, 2, 4, ... words get equal numbers, from those of half the length; the numbers of the
    longest runs give the order, and all of them, longest first, the words two neighbours share.
    """

    def __init__(self, hashes: np.ndarray, first: np.ndarray, at: np.ndarray):
        segments, size = len(first) - 1, np.diff(first)
        place = np.arange(len(hashes)) + np.repeat(np.arange(segments), size)
        _, words = np.unique(hashes, return_inverse=True)
        number = np.empty(len(hashes) + segments, np.int64)           # every segment is followed by an end that equals no other
        number[place] = words + segments
        number[first[1:] + np.arange(segments)] = np.arange(segments)
        self.levels, span = [number], 1
        while span < int(size.max(initial=0)):
            later = np.concatenate((number[span:], np.full(min(span, len(number)), -1)))
            _, number = np.unique(number * (len(number) + segments + 1) + later + 1, return_inverse=True)
            self.levels.append(number)
            span *= 2
        self.at = place[at]
        self.order = np.argsort(number[self.at], kind="stable")
        self.depth = self._shared(self.at[self.order[:-1]], self.at[self.order[1:]])

    def _shared(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        shared = np.zeros(len(x), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            number = self.levels[level]
            a, b = np.minimum(x + shared, len(number) - 1), np.minimum(y + shared, len(number) - 1)
            shared += np.where((number[a] == number[b]) & (x != y), 1 << level, 0)
        return np.concatenate(([0], shared)) if len(self.order) else shared

    def nodes(self, min_depth: int) -> np.ndarray:
        """Where among the leaves the nodes of at least that depth begin; a leaf that shares less with both neighbours is one by itself."""
        return np.flatnonzero(self.depth < min_depth)

    def maximal_repeats(self, min_depth: int) -> list[tuple[int, np.ndarray]]:
        """(depth, suffixes) of every internal node of at least that depth whose leaves do not all follow the same word."""
        before = np.where(self.at > 0, self.levels[0][np.maximum(self.at - 1, 0)], -1)[self.order]
        found, open_nodes = [], []                                    # (depth, first leaf) of the nodes a leaf lies in
        for leaf, depth in enumerate([*self.depth.tolist(), 0]):
            low = leaf - 1
            while open_nodes and open_nodes[-1][0] > depth:
                own, low = open_nodes.pop()
                if own >= min_depth and len(set(before[low:leaf].tolist())) > 1:
                    found.append((own, np.sort(self.order[low:leaf])))
            if depth and (not open_nodes or open_nodes[-1][0] < depth):
                open_nodes.append((depth, low))
        return found


def _marks(row_id: np.ndarray, doc_key: np.ndarray, first: np.ndarray, texts: pa.Array, min_words: int) -> pa.RecordBatch:
    """(row_id, doc_key, start, n): stretches of suffixes that begin as one of a smaller id does."""
    w = tokens.words(texts)
    hashes = tokens.word_hashes(w)
    at = np.flatnonzero(w.positions_left() >= min_words)
    segment = w.doc[at]
    tree = Subtree(hashes, w.first, at)
    order, nodes, ids = tree.order, tree.nodes(min_words), doc_key[segment]
    least = np.repeat(np.minimum.reduceat(ids[order], nodes), np.diff(np.append(nodes, len(order))))
    repeat = np.empty(len(at), dtype=bool)
    repeat[order] = (ids[order] > least) & (ids[order] != NO_ID)
    gone, owner = at[repeat], segment[repeat]
    begins = np.concatenate(([True], (np.diff(gone) != 1) | (owner[1:] != owner[:-1]))) if len(gone) else np.zeros(0, dtype=bool)
    begin = np.flatnonzero(begins)
    owner, n = owner[begin], np.diff(np.append(begin, len(gone)))
    start = first[owner] + gone[begin] - w.first[owner]
    return pa.RecordBatch.from_arrays(
        [pa.array(row_id[owner]), pa.array(doc_key[owner]), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))],
        ["row_id", "doc_key", "start", "n"])


def _tree_builder(min_words: int):
    """Rows arrive sorted by prefix; whole groups are gathered until the buffer is full."""
    def solve(rows: pa.Table) -> pa.RecordBatch:
        columns = [rows.column(i).combine_chunks() for i in range(5)]
        row_id, doc_key, first = (c.to_numpy(zero_copy_only=False) for c in columns[1:4])
        return _marks(row_id, doc_key, first, columns[4], min_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            prefix = batch.column(0).to_numpy(zero_copy_only=False)
            if held and sum(b.nbytes for b in held) >= BUFFER_BYTES:
                open_group = held[-1].column(0)[-1].as_py()
                same = int(np.argmax(prefix != open_group)) if (prefix != open_group).any() else len(prefix)
                if same < len(prefix):
                    yield solve(pa.Table.from_batches([*held, batch.slice(0, same)]))
                    held, batch = [], batch.slice(same)
            held.append(batch)
        if held:
            yield solve(pa.Table.from_batches(held))
    return run


def _remover(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.chunks(batch):
                w = tokens.words(part.column(1))
                data, at = tokens.squeezed(w)
                lists = part.column(2)
                flat = lists.flatten()
                doc = np.repeat(np.arange(part.num_rows), np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64))
                start, n = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(2))
                gone = tokens.covered(start + w.first[:-1][doc], n + min_words - 1, len(w.starts))
                kept = []
                for lo, hi in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
                    if not gone[lo:hi].any():
                        kept.append(data[at[lo]:at[hi] - 1] if hi > lo else b"")
                        continue
                    stay = np.flatnonzero(~gone[lo:hi])
                    pieces = np.split(stay, np.flatnonzero(np.diff(stay) != 1) + 1) if len(stay) else []
                    kept.append(b" ".join(data[at[lo + p[0]]:at[lo + p[-1] + 1] - 1] for p in pieces))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([k.decode() for k in kept], pa.string()), pa.array(w.counts.astype(np.int64)),
                     pa.array(w.per_doc(gone).astype(np.int64))], ["doc_id", "text", "n_words", "n_removed"])
    return run


def _listed(rows: DataFrame, *columns: str) -> DataFrame:
    """Runs by document, each once."""
    return rows.groupBy(*_ROW).agg(F.collect_set(F.struct(*columns)).alias("runs"))


def _met(texts: DataFrame, listed: DataFrame) -> DataFrame:
    """Texts with their runs; rows of equal id and text once. They lie together after the join, so this moves nothing."""
    return texts.join(listed, _ROW).dropDuplicates(_ROW)


def _live(runs: DataFrame, prefix: Sequence[str], min_words: int, group_words: int) -> DataFrame:
    """Prefixes that documents of different ids have, and whether their group is too `large`."""
    known = F.when(F.col("doc_key") != int(NO_ID), F.col("doc_key"))
    groups = runs.groupBy(*prefix).agg(
        F.min(known).alias("low"), F.max(known).alias("high"), F.sum(F.col("n") + (min_words - 1)).alias("words"))
    return staged(groups.filter("low < high").select(*prefix, (F.col("words") > group_words).alias("large")), "repeats-live")


def _followers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes sorted by prefix and id: those whose id is larger than the first of their prefix. Rows without row_id only say what the first is."""
    h1 = h2 = low = None
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 3))
        opens = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        first = np.flatnonzero(opens)
        least = ids[first]
        if (a[0], b[0]) == (h1, h2):                             # the prefix goes on from the batch before
            least[0] = low
        h1, h2, low = a[-1], b[-1], least[-1]
        later = (ids > np.repeat(least, np.diff(np.append(first, len(ids))))) & (ids != NO_ID)
        later &= batch.column(2).is_valid().to_numpy(zero_copy_only=False)
        at = pa.array(np.flatnonzero(later))
        yield pa.RecordBatch.from_arrays(
            [batch.column(2).take(at), batch.column(3).take(at), batch.column(4).take(at), pa.array(np.ones(len(at), np.int32))],
            ["row_id", "doc_key", "start", "n"])


def repeated(texts: DataFrame, min_words: int, group_words: int) -> DataFrame:
    """(row_id, doc_key, start, n): n suffixes from word `start` on begin with a passage that starts in a document of smaller id."""
    run = "anchor long, row_id long, doc_key long, start int, n int, pieces array<struct<longer int, n int>>"
    runs = staged(arrow_map(texts, _segmenter(min_words), run), "repeats-runs")
    wanted = runs.join(_live(runs, ["anchor"], min_words, group_words), "anchor")
    before = F.expr("aggregate(slice(pieces, 1, at), 0, (sum, piece) -> sum + piece.n)")
    crowded = wanted.filter("large").select("anchor", *_ROW, "start", "pieces", F.posexplode("pieces").alias("at", "piece")).select(
        "anchor", *_ROW, (F.col("start") + before).alias("start"), "piece.n", "piece.longer")
    lengthened = crowded.join(_live(crowded, ["anchor", "longer"], min_words, group_words), ["anchor", "longer"])

    fitting = wanted.filter("NOT large").select(*_ROW, "start", "n", F.col("anchor").alias("prefix")).unionAll(
        lengthened.filter("NOT large").select(*_ROW, "start", "n", F.xxhash64("anchor", "longer").alias("prefix")))
    segment = "prefix long, row_id long, doc_key long, start int, words binary"
    segments = arrow_map(_met(texts, _listed(fitting, "start", "n", "prefix")), _shipper(min_words), segment)
    mark = "row_id long, doc_key long, start int, n int"
    by_tree = arrow_map(segments.repartition("prefix").sortWithinPartitions("prefix"), _tree_builder(min_words), mark)

    full = lengthened.filter("large").select(*_ROW, "start", "n", F.col("anchor").alias("prefix"))
    suffix = "h1 long, h2 long, row_id long, doc_key long, start int"
    suffixes = arrow_map(_met(texts, _listed(full, "start", "n", "prefix")), _unroller(min_words), suffix)
    least = suffixes.groupBy("h1", "h2").agg(F.min("doc_key").alias("low"), F.max("doc_key").alias("high")).filter("low < high")
    # Equal suffixes are spread over several tasks by a salt; a row in each tells the smallest id there is.
    heads = least.select(
        "h1", "h2", F.lit(None).cast("long").alias("row_id"), F.col("low").alias("doc_key"), F.lit(0).alias("start"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    spread = suffixes.withColumn("salt", F.expr(f"cast(pmod(xxhash64(row_id, start), {SALTS}) AS int)")).unionByName(heads)
    by_prefix = arrow_map(
        spread.repartition("h1", "h2", "salt").sortWithinPartitions("h1", "h2", "salt", "doc_key").drop("salt"), _followers, mark)
    return by_tree.unionAll(by_prefix)


def stretches(docs: DataFrame, min_words: int = 50, group_words: int = GROUP_WORDS) -> DataFrame:
    """(doc_id, row_id, start, n_words): the longest stretches of a document whose every passage of `min_words` words starts in one of a smaller
    id too; one set per id and text. Stretches that overlap or touch are one; `start` counts words from 0."""
    texts = docs.select(*_ids(), F.coalesce("text", F.lit("")).alias("text"))
    marks = repeated(texts, min_words, group_words).groupBy(*_ROW, "start").agg(F.max("n").alias("n"))
    along = Window.partitionBy(*_ROW).orderBy("start")
    ended = F.max(F.col("start") + F.col("n") + (min_words - 1)).over(along.rowsBetween(Window.unboundedPreceding, -1))
    opened = marks.withColumn("opens", F.when(ended >= F.col("start"), 0).otherwise(1))
    numbered = opened.withColumn("stretch", F.sum("opens").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    joined = numbered.groupBy(*_ROW, "stretch").agg(
        F.min("start").alias("start"), F.max(F.col("start") + F.col("n") + (min_words - 1)).alias("end"))
    return joined.select(F.col("doc_key").alias("doc_id"), "row_id", "start", (F.col("end") - F.col("start")).alias("n_words"))


def remove_repeats(docs: DataFrame, min_words: int = 50, group_words: int = GROUP_WORDS) -> DataFrame:
    """(doc_id, text, n_words, n_removed): each text without the words inside any passage of `min_words` words that also starts in a
    document with a smaller id; passages are judged on the input. Words left are joined by one space.

    `doc_id` must be a whole number. Null and empty texts have no words and come back empty; texts shorter than a passage lose nothing.
    Rows that share an id never cost each other words; a null id is smaller than none, and its row loses none. Repeated rows
    give repeated results. Other columns are not read.
    """
    if min_words <= PREFIX:
        raise ValueError(f"passages must be longer than {PREFIX} words")
    texts = docs.select(*_ids(), F.coalesce("text", F.lit("")).alias("text"))
    marks = _listed(repeated(texts, min_words, group_words), "start", "n")
    joined = texts.join(marks, _ROW, "left")
    whole = joined.select(F.when(F.col("doc_key") != int(NO_ID), F.col("doc_key")).alias("doc_id"), "text", "runs")
    return arrow_map(whole, _remover(min_words), "doc_id long, text string, n_words long, n_removed long")
