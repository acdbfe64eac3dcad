import random

import numpy as np
import pytest

from tarnlake.llm import simhash
from tarnlake.llm.components import components


def spread(prints):
    """Smallest member of each print's component, two prints being linked at 2 or fewer differing bits."""
    prints, label = sorted(set(prints)), {}
    for p in prints:
        if p in label:
            continue
        label[p], todo = p, [p]
        while todo:
            a = todo.pop()
            for b in prints:
                if b not in label and bin(a ^ b).count("1") <= 2:
                    label[b] = p
                    todo.append(b)
    return label


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def expected(rows):
    prints = [(i, simhash.simhash(t)) for i, t in rows]
    label = spread(p for _, p in prints)
    least = {}
    for i, p in prints:
        if i is not None:
            least[label[p]] = min(least.get(label[p], i), i)
    return sorted(((i, f"{p:016x}", least.get(label[p])) for i, p in prints), key=str)


def test_every_word_is_within_three_bits_of_its_codeword():
    index = simhash.golay_index()
    assert index.min() == 0 and index.max() == 4095
    assert (np.bincount(index) == 2048).all()


def test_words_one_bit_apart_share_a_fuzzy_key():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 1 << 23, 2000)
    index = simhash.golay_index()
    for flip in (0, *(1 << np.arange(23))):
        row, near = simhash.fuzzy_keys(words ^ flip)
        keys = set(zip(row.tolist(), near.tolist()))
        assert all((k, v) in keys for k, v in enumerate(index[words].tolist()))
    assert set(np.bincount(simhash.fuzzy_keys(words)[0]).tolist()) <= {1, 6}


@pytest.mark.parametrize("busy", [0, 3, 32])
def test_links_connect_what_is_within_two_bits(spark, busy):
    rng = random.Random(busy)
    seeds = [rng.getrandbits(64) for _ in range(30)] + [0, (1 << 64) - 1]
    prints = set(seeds)
    for s in seeds:
        at = s
        for _ in range(12):                                   # chains and clusters
            at ^= 1 << rng.randrange(64)
            if rng.random() < 0.6:
                at ^= 1 << rng.randrange(64)
            prints.add(at)
            prints.add(s ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64))
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    links = simhash.links(frame, 2, busy)
    for r in links.collect():
        assert bin((r["x"] ^ r["y"]) & ((1 << 64) - 1)).count("1") <= 2
    found = {r["node"]: r["component"] for r in components(links.selectExpr("x AS a", "y AS b")).collect()}
    want = spread(prints)
    groups, got = {}, {}
    for p in prints:
        groups.setdefault(want[p], set()).add(p)
        got.setdefault(found.get(signed(p), signed(p)), set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))


def test_fewer_bits(spark):
    frame = spark.createDataFrame([(0,), (1,), (3,), (1 << 40,)], "fp long")
    for busy in (0, 32):
        assert {frozenset(r) for r in simhash.links(frame, 1, busy).collect()} == {
            frozenset(p) for p in [(0, 1), (1, 3), (0, 1 << 40)]}
        assert simhash.links(frame, 0, busy).count() == 0


def test_components_of_long_chains_and_stars(spark):
    rows = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1300)] + [(5000, 5000), (None, 7)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1300)}, 5000: 5000}


@pytest.mark.parametrize("busy", [0, 32])
def test_edge_rows(edge_docs, texts, busy):
    got = simhash.near_duplicates(edge_docs, busy=busy)
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(texts)


def test_real_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = simhash.near_duplicates(docs)
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_no_rows(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
