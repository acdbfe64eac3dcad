"""Line dedup by levelled sorted runs of line hashes.

The index of all lines seen is a set of runs in the shared folder: tables of (h1, h2, n_docs), each
sorted by hash. A new batch of documents is first merged against the keys the runs hold often enough (an anti-join on the
hash, which Spark carries out as a merge join on large runs); what is left of it adds its own counts as a run of level 0. When a level holds
`fanout` runs they are summed into one run of the next level, so a line is rewritten as often as
there are levels, and a look-up reads few runs however many batches came before.

A line's key is the line without blanks at both ends, A-Z in lower case. Keys are compared by two
64-bit hashes, taken once: they are stored per document, batch by batch, and both the index and the drop read them from there. Lines whose
keys do not count have none and meet no join. Everything here is DataFrame code.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructType

from tarnlake.llm.common import row_key, staged, work_path

BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SEED = "line"
RUN_SCHEMA = "h1 long, h2 long, n_docs long"


def line_keys(text: Column) -> Column:
    """Keys of a text's lines, under which lines count as equal. Each step has an array of its own, so that none is evaluated twice."""
    return F.transform(F.transform(split_lines(text), lambda line: F.btrim(line, F.lit(BLANKS))), _lowered)


def _lowered(bare: Column) -> Column:
    """A-Z in lower case."""
    ascii_only = F.octet_length(bare) == F.char_length(bare)       # then lower() changes A-Z alone, and faster
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def split_lines(text: Column) -> Column:
    """Lines of a text; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_hash(key: Column, min_chars: int = 1) -> Column:
    """(h1, h2) of a key, null where the key is too short to count."""
    pair = F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(key, F.lit(_SEED)).alias("h2"))
    return F.when(F.char_length(key) >= min_chars, pair)


def hashed(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """One row per document: (doc_id, text_key, lines), the hashes of its lines in order, null where a key does not count."""
    keyed = F.transform(line_keys(F.col("text")), lambda key: key_hash(key, min_chars))
    return docs.select(*row_key(), keyed.alias("lines"))


def document_counts(hashes: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(h1, h2, n_docs): documents (rows) that hold each key, counted once per document, without the keys in `known`.

    Distinct per document needs no shuffle, and counts are combined before theirs, so a line that
    is in every document costs one row per task.
    """
    lines = hashes.select(F.explode(F.array_distinct("lines")).alias("h")).filter("h IS NOT NULL").select("h.h1", "h.h2")
    if known is not None:
        lines = lines.join(known, ["h1", "h2"], "left_anti")
    return lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"))


class LineRuns:
    """Levelled runs of line counts below one folder. One writer at a time; readers see whole runs."""

    def __init__(self, spark: SparkSession, path: str | None = None, fanout: int = 4, min_chars: int = 1):
        if fanout < 2:
            raise ValueError("compaction needs a fanout of at least 2")
        self.spark, self.path = spark, path or work_path(spark, "line-runs")
        self.fanout, self.min_chars = fanout, min_chars
        self.levels: list[list[str]] = []
        self._written = 0

    def add(self, batch: DataFrame) -> None:
        """Add the counts of a batch as a run, and compact levels that are full."""
        self._push(0, document_counts(hashed(batch, self.min_chars)))

    def add_hashed(self, batch: DataFrame, enough: int) -> None:
        """Add a batch given by its hashes: keys that `enough` documents hold already are dropped from it, the others counted.

        Counts of such keys stand still from then on, so that a line of very many documents is looked up and not summed.
        """
        self._push(0, document_counts(batch, self.at_least(enough) if self.runs else None))

    def _push(self, level: int, counts: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self._written += 1
        run = f"{self.path}/level-{level}-run-{self._written}"
        counts.sortWithinPartitions("h1", "h2").write.parquet(run)      # sorted within the files of the run
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._push(level + 1, self._sum(full))

    def _sum(self, runs: Sequence[str]) -> DataFrame:
        merged = self.spark.read.schema(RUN_SCHEMA).parquet(*runs)
        return merged.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"))

    @property
    def runs(self) -> list[str]:
        return [run for level in self.levels for run in level]

    def counts(self) -> DataFrame:
        """(h1, h2, n_docs) over all batches so far."""
        if not self.runs:
            return self.spark.createDataFrame([], RUN_SCHEMA)
        return self._sum(self.runs)

    def at_least(self, n_docs: int) -> DataFrame:
        """(h1, h2) of keys found in that many documents so far."""
        found = self.counts().filter(F.col("n_docs") >= n_docs).select("h1", "h2")
        return staged(found, "line-common")       # as a table of its own it can be joined with skewed lines

    def drop_known(self, batch: DataFrame, min_docs: int = 1) -> DataFrame:
        """The batch without the lines that at least `min_docs` earlier documents hold; then the batch is added.

        This is the incremental form: text that came before is dropped from what comes later.
        """
        result = drop_lines(batch, self.at_least(min_docs), self.min_chars)
        path = work_path(self.spark, "line-batch")
        result.write.parquet(path)
        self.add(batch)
        return self.spark.read.schema(result.schema).parquet(path)


def drop_lines(docs: DataFrame, dropped: DataFrame, min_chars: int = 1, spare_whole: bool = False, hashes: DataFrame | None = None) -> DataFrame:
    """`docs` with all its columns, `text` without the lines whose key is in `dropped` (h1, h2; distinct), and two
    columns more: `n_lines` before and `n_dropped`.

    Only hashes are joined, never texts: the lines to drop come back as one bit per line, 64 lines to
    a word; `hashes` are those of the documents (see `hashed`) where they are stored already. Null texts stay null when they lose nothing (their one line is empty). Rows that
    repeat an id and a text are one key and treated alike; a null id is a key like any other. Extra columns pass
    through; one called `n_lines` or `n_dropped` is replaced. Joining on row keys leaves a row in one piece, so a
    document must fit in memory, as it does when it is read. With `spare_whole` a text that would be left without a word
    loses nothing.
    """
    hashes = hashed(docs, min_chars) if hashes is None else hashes
    lines = hashes.select("doc_id", "text_key", F.posexplode("lines").alias("pos", "h")).filter("h IS NOT NULL")
    hits = lines.select("doc_id", "text_key", "pos", "h.h1", "h.h2").join(dropped, ["h1", "h2"])
    words = hits.groupBy("doc_id", "text_key", F.expr("cast(pos div 64 AS int)").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits"))
    # words without a line to drop are missing: up to the last one they are put in
    filled = F.aggregate(
        "words", F.array().cast("array<bigint>"),
        lambda out, w: F.concat(out, F.array_repeat(F.lit(0).cast("long"), w["word"] - F.size(out)), F.array(w["bits"])))
    marks = (
        words.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))
        .select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), filled.alias("__bits"))
    )
    keyed = docs.drop("n_lines", "n_dropped").withColumn("__own", row_key()[1])
    joined = keyed.join(marks, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__key")), "left")
    left = """filter(split(coalesce(text, ''), '\\n', -1),
        (line, i) -> (shiftright(coalesce(try_element_at(__bits, cast(i div 64 + 1 as int)), 0L), i % 64) & 1L) = 0)"""
    kept = F.array_join(F.expr(left), "\n")
    if spare_whole:
        solid = F.exists(F.expr(left), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
        joined = joined.withColumn("__bits", F.when(solid, F.col("__bits")))
    n_dropped = F.expr("aggregate(__bits, 0L, (n, b) -> n + bit_count(b))")
    return joined.select(
        *[F.when(F.col("__bits").isNull(), F.col("text")).otherwise(kept).alias("text") if c == "text" else F.col(f"`{c}`")
          for c in docs.columns if c not in ("n_lines", "n_dropped")],
        F.size(split_lines(F.col("text"))).cast("long").alias("n_lines"),
        F.coalesce(n_dropped, F.lit(0)).cast("long").alias("n_dropped"),
    )


def drop_common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, n_batches: int = 8,
                      spare_whole: bool = False) -> DataFrame:
    """Index `docs` (a table) in `n_batches` batches, then drop the lines that at least `min_docs` of its documents hold.

    Lines are hashed once and stored, in batches by a hash of the row key. Each batch is anti-joined with the keys that the runs before
    it hold often enough, and adds its own. As the count is over all documents, the lines of earlier batches can be dropped only when all
    batches are in: one join with the keys that are common by then. `spare_whole`: as in `drop_lines`.
    """
    spark, path = docs.sparkSession, work_path(docs.sparkSession, "line-hashes")
    rows = hashed(docs.select("doc_id", "text"), min_chars)
    batch = F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(n_batches)).cast("int")
    rows.withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    schema = StructType([*rows.schema.fields]).add("batch", IntegerType())
    stored, runs = spark.read.schema(schema).parquet(path), LineRuns(spark, min_chars=min_chars)
    for i in range(n_batches):
        runs.add_hashed(stored.filter(F.col("batch") == i), min_docs)
    return drop_lines(docs, runs.at_least(min_docs), min_chars, spare_whole, stored.drop("batch"))
