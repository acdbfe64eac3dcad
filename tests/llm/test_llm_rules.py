import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tarnlake.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    repeated = {j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(repeated)]


def test_measures_are_those_of_brute_force(edge_docs, texts):
    got = sorted((tuple(r) for r in rules.measure(edge_docs).collect()), key=str)
    assert got == sorted(((i, *brute(t)) for i, t in texts), key=str)


def test_measures_of_real_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: list(r)[1:] for r in rules.measure(docs).collect()}
    assert got == {r["doc_id"]: brute(r["text"]) for r in docs.collect()}


def test_kept_columns_come_along_and_must_not_clash(edge_docs):
    kept = rules.measure(edge_docs, keep=["doc_id", "text", "source"])
    assert kept.columns == ["doc_id", "text", "source", *rules.MEASURES]
    with pytest.raises(ValueError):
        rules.measure(edge_docs, keep=["doc_id", "n_words"])


def test_policies_and_ablations_come_from_the_bits(edge_docs, no_docs):
    entries = rules.ledger(rules.measure(edge_docs))
    rows = entries.collect()
    bits = {name: 1 << i for i, name in enumerate(rules.RULES)}
    for r in rows:
        assert bool(r["fail_bits"] & bits["few_words"]) == (r["n_words"] < 10)
        assert bool(r["fail_bits"] & bits["repeated_words"]) == (100 * r["n_repeat_words"] > 20 * r["n_words"])
    mask = rules.policy_mask(rules.POLICIES["v1"])
    assert entries.filter(rules.passes(rules.POLICIES["v1"])).count() == sum(not r["fail_bits"] & mask for r in rows)
    costs = {r["rule"]: r for r in rules.ablations(entries, rules.POLICIES["v1"]).collect()}
    for name, bit in bits.items():
        assert costs[name]["n_failed"] == sum(bool(r["fail_bits"] & bit) for r in rows)
        assert costs[name]["n_failed_alone"] == sum(r["fail_bits"] & mask == bit for r in rows)
    assert rules.ledger(rules.measure(no_docs)).count() == 0


def test_a_rule_that_gives_null_does_not_fail(edge_docs):
    odd = rules.ledger(edge_docs.select("doc_id"), {"unknown": F.lit(None).cast("boolean"), "all": F.lit(True)})
    assert {r["fail_bits"] for r in odd.collect()} == {2}
