import os
import random
import re

import pytest
from pyspark.sql import functions as F

from tarnlake import session
from tarnlake.llm import tiling


def brute_tiles(a, b, least):
    """Greedy string tiling by trying all places, longest first."""
    used_a, used_b, covered = [False] * len(a), [t is None for t in b], 0
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and not used_a[i + n] and not used_b[j + n] and a[i + n] == b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return covered
        used_a[i:i + n] = used_b[j:j + n] = [True] * n
        covered += n


def words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute_hits(docs, items, least, coverage):
    out = set()
    for d, t in docs:
        for i, x in items:
            a, b = words(x), words(t)
            n = brute_tiles(a, b, min(least, len(a))) if a else 0
            if a and n >= coverage * len(a):
                out.add((d, i, n, len(a)))
    return out


@pytest.mark.parametrize("seed", range(40))
def test_tiles_cover_what_greedy_tiling_covers(seed):
    rng = random.Random(seed)
    a = [rng.randrange(6) for _ in range(rng.randint(1, 40))]
    b = [rng.choice([None, *range(6), *range(6)]) for _ in range(rng.randint(0, 60))]
    for _ in range(rng.randint(0, 3)):
        i, j = rng.randrange(len(a)), rng.randrange(len(b) + 1)
        b[j:j] = a[i:i + 12]
    least = rng.choice([1, 2, 3, 5])
    tiles = tiling.tile(a, b, least)
    assert all(n >= least and a[i:i + n] == b[j:j + n] for i, j, n in tiles)
    assert len({i + k for i, _, n in tiles for k in range(n)}) == len({j + k for _, j, n in tiles for k in range(n)}) == sum(t[2] for t in tiles)
    assert sum(t[2] for t in tiles) == brute_tiles(a, b, least)


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(9)
    vocabulary = [f"w{k}" for k in range(400)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(12, 40)))) for k in range(12)]
    items += [(20, "Tiny item"), (21, ""), (22, None), (23, items[0][1]), (24, "one"), (25, "a a a a a a a a")]
    docs = [(0, None), (1, ""), (2, "nothing here"), (3, items[1][1].upper()), (4, "tiny, ITEM!"), (5, "a " * 500)]
    for k in range(10, 40):
        x = items[k % 12][1].split()
        fill = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        cut = rng.randint(5, len(x) - 1)
        moved = x[cut:] + fill[:7] + x[:cut]                         # a reordered passage
        if k % 3 == 0:
            moved = moved[:rng.randint(5, len(moved))]
        docs.append((k, " ".join(fill + moved + fill[::-1])))
    return docs + [(39, docs[-1][1]), (None, items[2][1])], items


@pytest.mark.parametrize("filter_bits, coverage", [(25, 0.8), (15, 0.8), (25, 0.4), (25, 1.0)])
def test_hits_are_those_of_brute_force(spark, cases, filter_bits, coverage, monkeypatch):
    monkeypatch.setattr(tiling, "FILTER_BITS", filter_bits)
    docs, items = cases
    left = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, item_id string")
    right = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id int")
    found = tiling.hits(left, right, 5, coverage)
    want = brute_hits(docs, items, 5, coverage)
    assert {(r["doc_id"], r["item_id"], r["matched"], r["item_words"]) for r in found.collect()} == want
    rows = tiling.verdicts(left, found).collect()
    assert len(rows) == len(docs)
    bad = {w[0] for w in want}
    assert all(r["contaminated"] == (r["doc_id"] in bad) == bool(r["n_items"]) for r in rows)
    kept = tiling.clean(left, found)
    assert kept.columns == left.columns
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(str(d) for d, _ in docs if d not in bad)


def test_planted_passages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in tiling.hits(docs, items).collect()}
    planted = {(d["doc_id"], x["item_id"]) for x in items.collect() for d in docs.collect() if x["text"] in d["text"]}
    assert planted <= got


def test_no_rows(spark, edge_docs, no_docs):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert tiling.hits(edge_docs, nothing).count() == 0
    assert tiling.verdicts(edge_docs, tiling.hits(edge_docs, nothing)).filter("contaminated").count() == 0
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert tiling.hits(no_docs, some).count() == 0


def test_frequent_seeds_are_not_joined(spark):
    """Every document and item begins alike; pairs come from the rare seeds, so there are as many as hits."""
    rng = random.Random(3)
    head = "this line stands in front of every text there is"
    items = [(i, f"{head} " + " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(30))) for i in range(30)]
    docs = [(d, f"{head} " + (items[d % 30][1] if d < 60 else " ".join(f"v{rng.randrange(10 ** 6)}" for _ in range(30)))) for d in range(600)]
    found = tiling.hits(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r["doc_id"], r["item_id"]) for r in found.collect()) == [(d, d % 30) for d in range(60)]
    made = [n for n in os.listdir(session.shared_root(spark)) if n.startswith("tiling-pairs")]
    newest = max(made, key=lambda n: os.path.getmtime(f"{session.shared_root(spark)}/{n}"))
    assert spark.read.parquet(f"{session.shared_root(spark)}/{newest}").count() == 60


def test_the_corpus_is_read_once_whatever_the_benchmark(spark, edge_docs):
    items = spark.range(3000).select("id", F.concat_ws(" ", *(F.xxhash64("id", F.lit(k)) for k in range(9)))).toDF("item_id", "text")
    reads, arrow_map = [], tiling.arrow_map

    def counted(df, f, schema):
        reads.append("text_key" in df.columns and "item_text" not in df.columns)
        return arrow_map(df, f, schema)

    tiling.arrow_map = counted
    try:
        assert tiling.hits(edge_docs, items).count() == 0
    finally:
        tiling.arrow_map = arrow_map
    assert sum(reads) == 1
