import hashlib
import math

import numpy as np
import pytest

from tarnlake.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int, id string, code string, vector int, entries int"


def plain(x, k, rounds, parts=4):
    """Lloyd rounds that compare every part with every entry."""
    cuts = codes.bounds(x.shape[1], parts)
    books = [x[:k, a:b].copy() for a, b in zip(cuts, cuts[1:])]
    for left in range(rounds, -1, -1):
        held, far = [], []
        for (a, b), book in zip(zip(cuts, cuts[1:]), books):
            d = ((x[:, None, a:b] - book[None]) ** 2).sum(axis=2)
            held.append(d.argmin(axis=1))
            far.append(d.min(axis=1))
        if left:
            for (a, b), book, h in zip(zip(cuts, cuts[1:]), books, held):
                for e in set(h.tolist()):
                    book[e] = np.floor_divide(x[h == e, a:b].sum(axis=0), (h == e).sum())
    return np.array(held).T, np.array(far).sum(axis=0), books


def rows(n, d, seed=0, grid=3.0):
    """Vectors on a coarse grid, so that ties between entries are common."""
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, d)) * grid) / 8
    return [(i, x[i].tolist(), [None, 0, 1, 2][i % 4], "a", "b", 0, 0) for i in range(n)]


def digest(books):
    return hashlib.sha256(",".join(str(v) for b in books for v in b.reshape(-1).tolist()).encode()).hexdigest()


@pytest.mark.parametrize("n, d, k", [(600, 16, 256), (300, 8, 16), (40, 12, 256), (500, 10, 20), (7, 4, 3)])
def test_same_as_plain_rounds(spark, n, d, k):
    data = rows(n, d, n)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    state, books = codes.encode(df, entries=k)
    x = np.floor(1024 * np.array([r[1] for r in data])).astype(np.int64)
    held, far, want = plain(x, k, 4)
    got = {r["id"]: r for r in codes.codes(state, books).collect()}
    assert len(got) == n and all((a == b).all() for a, b in zip(books, want))
    sums = {label: sum(int(far[i]) for i in range(n) if data[i][2] == label) for label in (None, 0, 1, 2)}
    for i in range(n):
        assert (got[i]["code"], got[i]["error"]) == ("".join(f"{e:02x}" for e in held[i]), far[i])
        assert got[i]["label_error"] == sums[data[i][2]] and got[i]["codebooks_sha256"] == digest(want)


def test_rows_that_cannot_be_coded_are_left_out(spark):
    bad = [None, [], [1.0, None, 0.0, 0.0], [math.nan, 0.0, 0.0, 0.0], [math.inf, 0.0, 0.0, 0.0], [-math.inf, 0.0, 0.0, 0.0],
           [1e30, 0.0, 0.0, 0.0], [1.0] * 8]
    good = [(i, [float(i % 3), 0.5, -0.25, i / 7], None) for i in range(10)] + [(None, [0.0, 0.0, 0.0, 0.0], 1), (3, [0.0, 0.5, -0.25, 3 / 7], None)]
    df = spark.createDataFrame([*good, *[(90 + i, v, 5) for i, v in enumerate(bad)]], "vec_id long, embedding array<float>, label int")
    out = codes.codes(*codes.encode(df, entries=4)).collect()
    assert sorted(str(r["id"]) for r in out) == sorted(str(g[0]) for g in good)
    assert {r["label"] for r in out} == {None, 1}


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0, 4.0], 0)] * 400 + [(2, [0.0, 0.0, 0.0, 0.0], None)], "vec_id long, embedding array<float>, label int")
    out = codes.codes(*codes.encode(df)).collect()
    # all entries start equal, so the first takes every row; its mean moves off the copies, which go to the second
    assert len(out) == 401 and {(r["id"], r["code"], r["error"]) for r in out} == {(1, "01010101", 0), (2, "00000000", 0)}
    none = codes.codes(*codes.encode(df.limit(0)))
    assert none.collect() == [] and none.columns[:4] == ["id", "label", "code", "error"]


def test_active_entries_are_enough():
    """A round that looks only at moved entries gives what a full search gives, ties included."""
    rng = np.random.default_rng(5)
    x, book = rng.integers(-4, 5, (2000, 4)), rng.integers(-4, 5, (40, 4))
    held, far = codes.nearest(x, book)
    for _ in range(6):
        after = book.copy()
        some = rng.choice(40, 7, replace=False)
        after[some] += rng.integers(-1, 2, (7, 4))
        held, far = codes.reassign(x, after, (after != book).any(axis=1), held, far)
        want = codes.nearest(x, after)
        assert (held == want[0]).all() and (far == want[1]).all()
        book = after


def test_large_components_stay_exact():
    x = np.array([[1 << 27, -(1 << 27)], [(1 << 27) - 1, 5]], np.int64)
    held, far = codes.nearest(x, x[::-1].copy())
    assert held.tolist() == [1, 0] and far.tolist() == [0, 0]
