import random
import time

import numpy as np
import pytest

from tarnlake.llm import repeats


def brute(rows, n):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - n + 1):
            passage = tuple(w[k:k + n])
            if i is not None:
                first[passage] = min(first.get(passage, i), i)
    out = []
    for i, w in split:
        gone = {k + j for k in range(len(w) - n + 1) if i is not None and first[tuple(w[k:k + n])] < i for j in range(n)}
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, b" ".join(kept).decode(), len(w), len(w) - len(kept)))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("group_words", [1 << 15, 400, 0])
def test_edge_rows(edge_docs, texts, group_words):
    assert result(repeats.remove_repeats(edge_docs, 50, group_words)) == brute(texts, 50)


@pytest.mark.parametrize("seed, min_words, group_words, buffer", [(1, 17, 300, 1), (2, 20, 1 << 15, 3000), (3, 33, 0, 1), (4, 48, 900, 1)])
def test_shuffled_passages(spark, monkeypatch, seed, min_words, group_words, buffer):
    monkeypatch.setattr(repeats, "BUFFER_BYTES", buffer)
    rng = random.Random(seed)
    passages = [[rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(10, 90))] for _ in range(8)]
    rows = []
    for i in range(60):
        parts = [rng.choice(passages) for _ in range(rng.randint(0, 4))]
        w = [x for p in parts for x in p[rng.randrange(4):] + [rng.choice("ijkl") for _ in range(rng.randrange(3))]]
        rows.append((rng.choice([i, i, i % 7]), rng.choice([" ", "\n", " \t"]).join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(repeats.remove_repeats(docs, min_words, group_words)) == brute(rows, min_words)


def test_short_passages_are_refused(edge_docs):
    with pytest.raises(ValueError):
        repeats.remove_repeats(edge_docs, repeats.PREFIX)


def test_no_rows(no_docs):
    assert repeats.remove_repeats(no_docs).count() == 0


def segments(rng, n):
    words = [[rng.choice("ab") for _ in range(rng.randint(1, 25))] for _ in range(n)]
    return words + [w[k:] for w in words[:3] for k in (0, 2)]


@pytest.mark.parametrize("seed", range(6))
def test_subtrees_have_leaves_in_order_and_the_depth_of_their_nodes(seed):
    rng = random.Random(seed)
    texts = segments(rng, 8)
    hashes = np.array([{"a": 77, "b": 5}[x] for t in texts for x in t], np.uint64)
    first = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    at = np.flatnonzero(np.concatenate([np.arange(len(t), 0, -1) for t in texts]) >= 3)
    tree = repeats.Subtree(hashes, first, at)
    suffix = [tuple(hashes[i:first[np.searchsorted(first, i, "right")]].tolist()) for i in at.tolist()]

    def shared(x, y):
        return next((k for k, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))

    order = tree.order.tolist()
    assert tree.depth.tolist() == [0] + [shared(suffix[a], suffix[b]) for a, b in zip(order, order[1:])]
    # no two leaves share more than the least depth between them, and neighbours in order share most
    for i in range(0, len(order), 5):
        for j in range(i + 1, len(order), 7):
            assert shared(suffix[order[i]], suffix[order[j]]) == tree.depth[i + 1:j + 1].min()


@pytest.mark.parametrize("seed", range(4))
def test_maximal_repeats_are_those_of_all_pairs(seed):
    rng = random.Random(10 + seed)
    texts = segments(rng, 6)
    flat = [(t, k) for t in range(len(texts)) for k in range(len(texts[t]))]
    hashes = np.array([{"a": 77, "b": 5}[x] for t in texts for x in t], np.uint64)
    first = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    tree = repeats.Subtree(hashes, first, np.arange(len(hashes)))
    got = {(depth, tuple(leaves.tolist())) for depth, leaves in tree.maximal_repeats(3)}
    want = set()
    for n in range(3, 26):
        places = {}
        for i, (t, k) in enumerate(flat):
            if k + n <= len(texts[t]):
                places.setdefault(tuple(texts[t][k:k + n]), []).append(i)
        for where in places.values():
            after = [texts[flat[i][0]][flat[i][1] + n] if flat[i][1] + n < len(texts[flat[i][0]]) else i for i in where]
            before = [texts[flat[i][0]][flat[i][1] - 1] if flat[i][1] else ("start", flat[i][0]) for i in where]
            if len(where) > 1 and len(set(map(str, after))) > 1 and len(set(map(str, before))) > 1:
                want.add((n, tuple(where)))
    assert got == want


def test_stretches_are_what_is_removed(edge_docs):
    lost = {}
    for r in repeats.stretches(edge_docs, 50).collect():
        assert r["n_words"] >= 50
        key = r["doc_id"], r["row_id"]
        lost[key] = lost.get(key, 0) + r["n_words"]
    removed = {(r["doc_id"], r["text"], r["n_words"]): r["n_removed"] for r in repeats.remove_repeats(edge_docs, 50).collect()}
    assert sorted(lost.values()) == sorted(n for n in removed.values() if n)


def test_many_equal_rows_cost_little_more_than_one(spark):
    rng = random.Random(8)
    text = " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(200))
    schema = "doc_id long, text string"

    def timed(copies):
        docs = spark.createDataFrame([(1, text)] + [(2, text)] * copies, schema).repartition(4)
        start = time.time()
        out = repeats.remove_repeats(docs, 50).groupBy("doc_id", "n_removed").count().collect()
        assert sorted(tuple(r) for r in out) == [(1, 0, 1), (2, 200, copies)]
        return time.time() - start

    timed(1)
    one, many = timed(1), timed(1000)
    assert many < 3 * one + 3


@pytest.mark.parametrize("group_words", [1 << 15, 3000, 1200, 0])
def test_prefixes_are_lengthened_until_groups_fit(spark, group_words):
    """A frequent 16-word beginning with many continuations, and one that goes on alike for 33 words."""
    rng = random.Random(4)
    head = [f"h{i}" for i in range(16)]
    longer = head + [f"l{i}" for i in range(20)]
    tails = [[f"t{rng.randrange(10 ** 6)}" for _ in range(60)] for _ in range(5)]
    rows = [(i, " ".join([f"x{i}", *(head if i % 2 else longer), *tails[i % 5]])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(repeats.remove_repeats(docs, 50, group_words)) == brute(rows, 50)
