import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tarnlake.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def found(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    """Every item against every document, as the docstring of `rank` says."""
    lists = [(i, found(t)) for i, t in docs]
    lists = [(i, w, Counter(w)) for i, w in lists if w]
    n, length = len(lists), sum(len(w) for _, w, _ in lists)
    df = Counter(t for _, _, c in lists for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, w, c in lists:
            m = 50 + 50 * len(w) * n // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                        for t in set(found(text)) if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def ranked(df):
    return sorted([(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()], key=str)


ITEMS = [(0, "A Common Line here"), (1, None), (2, ""), (3, "the été 日本語 x MINE"), (3, "the été 日本語 x MINE"), (None, "one a b"),
         (4, "nowhere-to-be-found"), (5, " ".join(f"w{i}" for i in range(150)) + " line 0 1 2")]


@pytest.fixture
def items(spark):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in ITEMS], "item_id long, text string, rank int, score int").repartition(3)


@pytest.mark.parametrize("k", [1, 5, 50])
def test_brute_force_on_edge_rows(edge_docs, texts, items, k):
    assert ranked(search.rank(edge_docs, items, k)) == brute(texts, ITEMS, k)


def test_blocks_of_items_and_small_lots_change_nothing(edge_docs, texts, items, monkeypatch):
    assert ranked(search.rank(edge_docs, items, 7, block_terms=5)) == brute(texts, ITEMS, 7)


def test_empty_tables(spark, edge_docs, no_docs, items):
    assert search.rank(no_docs, items).collect() == []
    assert search.rank(edge_docs, items.limit(0)).collect() == []
    assert search.rank(edge_docs, spark.createDataFrame([(1, "...")], "item_id long, text string")).columns == ["item_id", "rank", "doc_id", "score"]


def test_many_copies(spark):
    docs = [(i, "same words in every copy") for i in range(3000)] + [(5000 + i, f"other {i}") for i in range(50)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
    items = [(0, "same copy"), (1, "other 7")]
    assert ranked(search.rank(df, spark.createDataFrame(items, "item_id long, text string"), 10)) == brute(docs, items, 10)


def _lot(n_docs, n_terms, seed=3):
    rng = np.random.default_rng(seed)
    lists = [np.unique((rng.random(rng.integers(1, 30)) ** 3 * n_terms).astype(int)) for _ in range(n_docs)]
    sizes = np.array([len(x) for x in lists])
    tf = rng.integers(1, 5, sizes.sum())
    n = np.add.reduceat(tf, np.concatenate(([0], np.cumsum(sizes)[:-1]))).astype(np.int64)
    return search.Lot(pa.array(np.arange(n_docs)), n, sizes, np.concatenate(lists), tf, n_docs, int(n.sum()))


@pytest.mark.parametrize("many", [20, 64, 65, 200])
@pytest.mark.parametrize("mask_bytes", [1 << 26, 1 << 10])
def test_finishing_early_is_safe(many, mask_bytes, monkeypatch):
    """Masks wider than a word, and lots cut for them: the same places as scoring every document, with fewer evaluated."""
    monkeypatch.setattr(search, "_MASK_BYTES", mask_bytes)
    lot, rng = _lot(4000, 400), np.random.default_rng(many)
    weights = rng.integers(1, 9000, 400)
    item = np.unique(rng.choice(400, many, replace=False))
    best = search.Best(10)
    done = search.search_lot(lot, item, weights, best)
    score = np.zeros(4000, np.int64)
    for t, a, b in zip(lot.terms, lot.first, lot.first[1:]):
        if t in item:
            score[lot.doc[a:b]] += weights[t] * lot.share[a:b]
    order = np.lexsort((np.arange(4000), -score))[:10]
    assert best.ids.tolist() == order.tolist() and best.score.tolist() == score[order].tolist()
    if many == 20 and mask_bytes > 1 << 20:
        assert done < (score > 0).sum() / 2


def test_a_second_lot_only_looks_above_the_last_place():
    lot, weights, item = _lot(4000, 400), np.arange(400) * 20 + 5, np.arange(0, 400, 20)
    best = search.Best(10)
    first = search.search_lot(lot, item, weights, best)
    assert search.search_lot(_lot(4000, 400, 4), item, weights, best) <= first


def test_terms_of_whole_texts(spark):
    docs = spark.createDataFrame([(1, "x " * 100_000 + "needle"), (2, "hay stack")], "doc_id long, text string")
    got = search.rank(docs, spark.createDataFrame([(9, "Needle")], "item_id long, text string")).collect()
    assert [(r["doc_id"], r["rank"]) for r in got] == [(1, 1)]
