"""Training-corpus pipeline: the operators of `tarnlake.llm` one after the other over documents.

Every stage takes the documents its predecessor kept, as a table, and returns documents with the same
columns; the last one adds its own. A stage's rows are written to the shared folder and read
again, so a lost executor costs no more than the stage at work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tarnlake.llm import lines, mixing, rules, simhash, tiling
from tarnlake.llm.common import table, work_path
from tarnlake.llm.queries import MIX, MIX_DOMAIN, MIX_WEIGHTS
from tarnlake.session import remove, staging, tune

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule of policy v1. A document is measured where it lies; rows are not moved."""
    entries = rules.ledger(rules.measure(docs, keep=COLUMNS))
    return entries.filter(rules.passes(rules.POLICIES["v1"])).select(COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines found in at least 10 of them; `n_chars` is that of what is left.

    A document of such lines only is a copy or put together from copies. It stays as it is: which copy is kept is for near-dedup to say.
    """
    kept = lines.drop_common_lines(docs, min_docs=10, min_chars=1, spare_whole=True)
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return simhash.keep_one(docs, words_per_shingle=3, max_bits=2).select(COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item: tiles of 5 words and more cover less than 0.8 of each."""
    found = tiling.hits(docs, table(spark, sf_dir, "benchmark"), min_match=5, coverage=0.8)
    return tiling.clean(docs, found).select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, with domain, tokens and the number of epochs each is in."""
    return mixing.mix(docs, F.expr(MIX_DOMAIN), MIX_WEIGHTS, **MIX)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
]
ORACLE_SQL = None      # fingerprints and tiles are beyond SQL; the tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; each stage's rows are written and read again, and go when those of the next are written."""
    docs, before = table(tune(spark), sf_dir, "documents"), None
    for name, stage in STAGES:
        path = work_path(spark, f"pipeline-{name}")
        with staging(spark):                     # what a stage stored for itself goes when its rows are written
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            remove(spark, before)
        before = path
    return docs
