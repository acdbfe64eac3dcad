import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tarnlake.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def split(budget, children):
    """Water filling among (name, capacity, weight): whole tokens, each up to its capacity."""
    live = sorted(((c / w, n, c, w) for n, c, w in children if c > 0 and w > 0))
    out, left, weight = {}, budget, sum(x[3] for x in live)
    while live and live[0][3] * (left - live[0][2]) >= live[0][2] * (weight - live[0][3]):
        _, n, c, w = live.pop(0)
        out[n], left, weight = c, left - c, weight - w
    return out | {n: left * w // weight for _, n, _, w in live}


def brute(rows, weights, budget, seed, epochs):
    """Copies of each row, in order of (hash, id, text key, tokens)."""
    leaves = defaultdict(list)
    for k, (path, i, tokens, text_key) in enumerate(rows):
        leaves[path].append((i, tokens, text_key, k))
    weight = {path: [weights.get(path[:d], 1) for d in (1, 2, 3)] for path in leaves}
    cap = {path: (sum(t for _, t, _, _ in docs) * epochs if min(weight[path]) > 0 else 0) for path, docs in leaves.items()}
    alloc = {(): min(budget, sum(cap.values()))}
    for d in (1, 2, 3):
        for parent in [p for p in alloc if len(p) == d - 1]:
            children = defaultdict(lambda: [0, 0])
            for path, c in cap.items():
                if path[:d - 1] == parent:
                    children[path[:d]][0] += c
                    children[path[:d]][1] = max(children[path[:d]][1], weight[path][d - 1] if c else 0)
            alloc |= split(alloc[parent], [(n, c, w) for n, (c, w) in children.items()])
    copies = [0] * len(rows)
    for path, docs in leaves.items():
        total, b = sum(t for _, t, _, _ in docs), alloc.get(path, 0)
        if not total or not b:
            continue
        full, rest, at = b // total, b % total, 0
        def place(doc):
            name = "" if doc[0] is None else doc[0]
            return int(hashlib.md5(f"{seed}:{full + 1}:{name}".encode()).hexdigest()[:15], 16)

        ordered = sorted(docs, key=lambda x: (place(x), x[0] is not None, x[0] or 0, x[2], x[1]))
        cut = None
        for doc in ordered:
            if at >= rest and cut is None:
                cut = (place(doc), doc[0], doc[2])
            at += doc[1]
            copies[doc[3]] = full + (cut is None and rest > 0)
    return copies, alloc


def check(spark, docs, weights, budget, seed, epochs, per_slice):
    out = mixing.mix(docs, F.col("domain"), weights, budget_tokens=budget, seed=seed, max_epochs=epochs, rows_per_slice=per_slice)
    keyed = docs.select("*", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    rows = [((r["domain"] or "", r["lang"] or "", r["source"] or ""), r["doc_id"], len(WORD.findall(r["text"] or "")), r["h"]) for r in keyed]
    copies, alloc = brute(rows, weights, budget, seed, epochs)
    want = sorted((str(k["doc_id"]), k["text"] or "", c) for k, c in zip(keyed, copies) if c)
    assert sorted((str(r["doc_id"]), r["text"] or "", r["copies"]) for r in out.collect()) == want
    return alloc


@pytest.mark.parametrize("seed, budget, epochs, per_slice", [(1, 300, 1, 1000), (2, 5000, 3, 7), (3, 1, 1, 3), (4, 10**9, 2, 5), (5, 0, 1, 4), (6, 2500, 2, 1)])
def test_copies_are_those_of_brute_force(spark, seed, budget, epochs, per_slice):
    rng = random.Random(seed)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 30])) or rng.choice([None, "", " "]), rng.choice(["en", "de", None]),
             rng.choice(["s1", "s1", "s1", "s2", None]), rng.choice(["web", "web", "code", None]), -1, -1) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, domain string, n_tokens long, tokens long")
    weights = {("web",): 5, ("code",): rng.choice([0, 1]), ("web", "en"): 3, ("web", "en", "s1"): 2, ("web", "de", "s2"): 0, ("nowhere",): 9}
    check(spark, docs, weights, budget, seed, epochs, per_slice)


def test_a_shortage_goes_to_siblings_before_it_goes_up(spark):
    def docs(path, tokens):
        return [(hash((path, k)) % 10**9, "w", path[1], path[2], path[0]) for k in range(tokens)]

    rows = docs(("a", "x", "1"), 10) + docs(("a", "x", "2"), 500) + docs(("a", "y", "1"), 500) + docs(("b", "x", "1"), 500)
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, domain string")
    alloc = check(spark, frame, {}, 400, 0, 1, 50)
    assert alloc["a",] == alloc["b",] == 200                      # leaf 1 is short, yet its domain gets its share
    assert alloc["a", "x"] == 100 and alloc["a", "x", "1"] == 10 and alloc["a", "x", "2"] == 90


def test_edge_rows(spark, edge_docs, no_docs):
    docs = edge_docs.withColumn("domain", F.lit("d"))
    for share in ("0.3", "1", "1.7"):
        out = mixing.mix(docs, F.col("domain"), {}, budget_share=share, max_epochs=2)
        assert out.columns == [*[c for c in edge_docs.columns if c != "copies"], "domain", "n_tokens", "copies"]
        assert out.count() > 0
    assert mixing.mix(no_docs, F.lit("d"), {}, budget_tokens=5).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs, F.lit("d"), {})
    with pytest.raises(ValueError):
        mixing.mix(docs, F.lit("d"), {("d",): -1}, budget_tokens=5)
