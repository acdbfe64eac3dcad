"""Quality rules as a ledger of failure bits.

Every document is measured once and every rule is evaluated once: the ledger holds the measurements
and one bit per failed rule. Policies are named sets of rules, so trying another policy, or asking
what a rule costs, is bit arithmetic over the ledger and reads no text.

Null and empty texts have no words; all their measurements are zero. Repeated rows give repeated
ledger rows, an empty table gives an empty ledger. Columns of the input other than `doc_id` and
`text` are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tarnlake.llm import tokens
from tarnlake.llm.common import arrow_map

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
WINDOW = 5
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True

# Rules in bit order: new ones go to the end, so that stored ledgers stay readable.
RULES: dict[str, Column | str] = {
    "few_words": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "many_symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "100 * n_dup_lines > 30 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
}
BASE = ["few_words", "repeated_words"]
POLICIES: dict[str, Sequence[str]] = {
    "base": BASE,
    "v1": [*BASE, "many_symbols", "duplicate_lines", "short_words", "long_words"],
    "v1_no_lines": [*BASE, "many_symbols", "short_words", "long_words"],
}


def _dup_lines(text: str | None) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier line."""
    lines = [line for line in (text or "").split("\n") if line.strip(" \t\n\v\f\r")]
    return len(lines), len(lines) - len(set(lines))


def _measurer(keep_text: bool):
    return lambda batches: _measure(batches, keep_text)


def _measure(batches: Iterator[pa.RecordBatch], keep_text: bool = False) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in tokens.chunks(batch):
            text = part.column(part.schema.get_field_index("text"))
            w = tokens.words(text)
            solid = ~tokens.BLANK[w.data] & ((w.data & 0xC0) != 0x80)
            grams = tokens.gram_hashes(tokens.word_hashes(w), WINDOW) if len(w.starts) else np.zeros(0, np.uint64)
            doc = w.doc
            full = np.flatnonzero(w.positions_left() >= WINDOW)
            keys = tokens.mix(grams[full] ^ tokens.mix(doc[full].astype(np.uint64) + np.uint64(1)))
            order = np.argsort(keys)
            same = keys[order][1:] == keys[order][:-1]
            twice = np.zeros(len(full), dtype=bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            repeated = tokens.covered(full[twice], WINDOW, len(w.starts))
            lines = np.array([_dup_lines(t) for t in text.to_pylist()], dtype=np.int64).reshape(-1, 2)
            columns = [w.counts, w.per_doc(solid, w.bounds), w.per_doc(_SYMBOL[w.data], w.bounds), lines[:, 0],
                       lines[:, 1], w.per_doc(repeated)]
            kept = [(part.column(i), f) for i, f in enumerate(part.schema) if keep_text or f.name != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(c for c, _ in kept), *(pa.array(c.astype(np.int64)) for c in columns)],
                [*(f.name for _, f in kept), *MEASURES])


def measure(docs: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row per document, its `keep` columns and the measurements the rules need, from one pass over the whole text.

    A kept column named like a measurement is refused. Keeping `text` saves joining the verdict back.
    """
    if set(keep) & set(MEASURES):
        raise ValueError("kept columns are named like measurements")
    rows = docs.select(*(F.col(f"`{c}`") for c in keep)) if "text" in keep else docs.select(
        *(F.col(f"`{c}`") for c in keep), "text")
    return arrow_map(rows, _measurer("text" in keep), _schema(docs, keep))


def _schema(docs: DataFrame, keep: Sequence[str]) -> StructType:
    counts = [StructField(name, LongType()) for name in MEASURES]
    return StructType([StructField(c, docs.schema[c].dataType) for c in keep] + counts)


def ledger(measured: DataFrame, rules: Mapping[str, Column | str] = RULES) -> DataFrame:
    """Add `fail_bits`: bit i is set where rule i fails; a rule that gives NULL does not fail."""
    if len(rules) > 63:
        raise ValueError("a ledger holds at most 63 rules")
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(rules.values()):
        failed = F.expr(rule) if isinstance(rule, str) else rule
        bits = bits.bitwiseOR(F.when(failed, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    return measured.withColumn("fail_bits", bits)


def policy_mask(rules: Sequence[str], known: Mapping[str, Column | str] = RULES) -> int:
    """Bits of the named rules."""
    order = list(known)
    return sum(1 << order.index(name) for name in rules)


def passes(rules: Sequence[str], known: Mapping[str, Column | str] = RULES) -> Column:
    """Whether a ledger row passes every rule of a policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(policy_mask(rules, known)).cast("long")) == 0


def ablations(entries: DataFrame, rules: Sequence[str], known: Mapping[str, Column | str] = RULES) -> DataFrame:
    """What each rule of a policy costs: one row per rule with the documents that fail it, and those
    that fail it alone (and would come back without it). Counts per distinct bit pattern are combined first.
    """
    mask = policy_mask(rules, known)
    patterns = (
        entries.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = list(known)
    named = F.explode(F.array(*(
        F.struct(F.lit(r).alias("rule"), F.lit(1 << order.index(r)).cast("long").alias("bit")) for r in rules
    ))).alias("r")
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return (
        patterns.select("bits", "n", named)
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
             F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
             F.bit_or("bits").alias("seen_bits"))
    )
