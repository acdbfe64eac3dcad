import random

import pytest
from pyspark.sql import functions as F

from tarnlake.operators.merge import Delete, Insert, Update, all_columns, delete_where, merge_apply

SCHEMA = "k int, v int, w string"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, v if v is not None else 0) for v in r))


def test_first_clause_that_holds_wins(spark):
    target = table(spark, [(1, 10, "a"), (2, 20, "b"), (3, 30, "c"), (4, 40, "d")])
    source = table(spark, [(1, 11, "x"), (2, -1, "x"), (3, 5, "x"), (5, 50, "n"), (6, -6, "n")])
    merged = merge_apply(
        target, source, ["k"],
        matched=[
            Delete(when=F.col("source.v") < 0),
            Update(when=F.col("source.v") > F.col("target.v"), set={"v": F.col("source.v")}),
            Update(set={"w": F.lit("kept")}),
        ],
        not_matched=[Insert(when=F.col("source.v") > 0, values=all_columns(source))],
    )
    assert result(merged) == [(1, 11, "a"), (3, 30, "kept"), (4, 40, "d"), (5, 50, "n")]


def test_two_source_rows_for_one_target_row_raise(spark):
    merged = merge_apply(
        table(spark, [(1, 1, "a")]), table(spark, [(1, 2, "x"), (1, 3, "y")]), ["k"],
        matched=[Update({"v": F.col("source.v")})],
    )
    with pytest.raises(Exception, match="several source rows"):
        merged.collect()


def test_ambiguity_shows_even_when_only_the_key_is_read(spark):
    merged = merge_apply(
        table(spark, [(1, 1, "a")]), table(spark, [(1, 2, "x"), (1, 3, "y")]), ["k"],
        matched=[Update({"v": F.col("source.v")})],
    )
    with pytest.raises(Exception, match="several source rows"):
        merged.select("k").collect()


def test_unmatched_duplicates_and_null_keys_are_all_inserted(spark):
    source = table(spark, [(7, 1, "x"), (7, 2, "y"), (None, 3, "z"), (None, 4, "z")])
    merged = merge_apply(
        table(spark, [(1, 1, "a"), (None, 9, "t")]), source, ["k"],
        matched=[Delete()], not_matched=[Insert(all_columns(source))],
    )
    assert result(merged) == [(1, 1, "a"), (7, 1, "x"), (7, 2, "y"), (None, 3, "z"), (None, 4, "z"), (None, 9, "t")]


def test_unknown_condition_does_not_act(spark):
    merged = merge_apply(
        table(spark, [(1, None, "a")]), table(spark, [(1, 5, "x")]), ["k"],
        matched=[Update(when=F.col("source.v") > F.col("target.v"), set={"v": F.col("source.v")})],
    )
    assert result(merged) == [(1, None, "a")]


@pytest.mark.parametrize("seed", range(3))
def test_random_upserts_equal_a_dictionary(spark, seed):
    rnd = random.Random(seed)
    target = {k: (k, rnd.randint(0, 9), "t") for k in rnd.sample(range(60), 30)}
    source = {k: (k, rnd.randint(0, 9), "s") for k in rnd.sample(range(60), 30)}
    want = dict(target)
    for k, row in source.items():
        if k not in target or row[1] > target[k][1]:
            want[k] = row
    df = table(spark, list(source.values()))
    got = merge_apply(
        table(spark, list(target.values())), df, ["k"],
        matched=[Update(all_columns(df), when=F.col("source.v") > F.col("target.v"))],
        not_matched=[Insert(all_columns(df))], unique_source=bool(seed % 2),
    )
    assert result(got) == sorted(want.values())


def test_delete_where_keeps_unknown(spark):
    df = table(spark, [(1, 1, "a"), (2, None, "b"), (3, -1, "c")])
    assert result(delete_where(df, "v < 0")) == [(1, 1, "a"), (2, None, "b")]
