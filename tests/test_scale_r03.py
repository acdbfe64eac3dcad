"""Lines are moved once for their numbers and what follows from them."""

from itertools import product

import pytest
from pyspark.sql import functions as F

from tarnlake.operators import merge, scd2
from tarnlake.operators.quality import complete, write_audit_publish
from tarnlake.plans import erp, publish, sales, star
from tarnlake.plans.inputs import Tables, line_numbered
from tarnlake.session import staged


def _plan(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_line_versions_lie_where_the_lines_do(no_broadcast, sf_dir):
    t = Tables(no_broadcast, sf_dir)
    events = erp.line_events(line_numbered(t.lineitem), t.orders)
    assert "Union" not in _plan(events) and _plan(events).count("Exchange hashpartitioning") == 2      # lines and orders
    versions = scd2.history(events, ["order_id", "id"], "lsn", ["qty"], "event_ts", F.col("op") == "d", rows_per_task=None)
    assert _plan(versions).count("Exchange hashpartitioning") == 2


def test_line_events_have_a_row_per_step(spark):
    lines = spark.sql("""select 7L l_orderkey, n l_linenumber, 3L l_partkey, 5.0D l_quantity, 10.0D l_extendedprice, flag l_returnflag, off l_discount
                         from values (1, 'R', 0.10D), (2, 'N', 0.10D), (3, 'R', 0.01D), (4, null, null) as v(n, flag, off)""")
    orders = spark.sql("select 7L o_orderkey, 9L o_custkey, timestamp_ntz '1999-01-01 00:00:00' o_orderdate")
    got = sorted((r.id % 10, r.op, r.qty, r.event_ts.day, r.lsn % 4) for r in erp.line_events(lines, orders).collect())
    assert got == sorted([(1, "c", 5.0, 1, 1), (1, "u", 4.0, 3, 2), (1, "d", 5.0, 4, 3), (2, "c", 5.0, 1, 1), (2, "d", 5.0, 4, 3),
                          (3, "c", 5.0, 1, 1), (3, "u", 4.0, 3, 2), (4, "c", 5.0, 1, 1)])


def test_fact_derives_line_columns_after_the_joins(spark, sf_dir):
    plan = _plan(star.build_fact(Tables(spark, sf_dir)), "optimizedPlan")
    assert plan.index("REG AIR") < plan.index("Join")


def test_a_stored_stage_is_not_written_again(spark):
    table = staged(spark.range(3), "stage")
    assert write_audit_publish(table, [complete("id")], lambda df: df, stored=True) is table


def test_a_bridge_builds_the_dimensions_it_joins(spark, sf_dir, monkeypatch):
    built = []
    layer = Tables.layer
    monkeypatch.setattr(Tables, "layer", lambda t, name, build: built.append(name) or layer(t, name, build))
    publish._part_supp(Tables(spark, sf_dir))
    assert {"published_part", "published_supplier"} <= set(built)
    assert not {"dim_order", "dim_customer", "published_order", "published_customer"} & set(built)
    assert not {"stage_part", "stage_part_supp", "warehouse_part_supp"} & set(built)          # stored already


def _versions(spark, rows):
    return staged(spark.createDataFrame(rows, "sk long, v int, record_active_flag boolean, record_end_date string"), "versions")


def test_publish_moves_closed_keys_only(no_broadcast):
    held = _versions(no_broadcast, [(1, 1, True, "9"), (2, 2, True, "9"), (4, 4, False, "3"), (None, 5, True, "9")])
    stage = _versions(no_broadcast, [(1, 1, True, "9"), (2, 20, False, "8"), (3, 3, True, "9"), (4, 4, False, "7"), (5, 6, True, "9"), (None, 7, True, "9")])
    got = scd2.publish(stage, held, "sk")
    assert sorted(got.collect(), key=lambda r: r["v"]) == sorted(
        _versions(no_broadcast, [(1, 1, True, "9"), (2, 2, False, "8"), (4, 4, False, "3"), (None, 5, True, "9"),
                                 (3, 3, True, "9"), (5, 6, True, "9"), (None, 7, True, "9")]).collect(), key=lambda r: r["v"])
    assert "LeftAnti" not in _plan(got)                # rows of the stage met what they hit, whole, to be told new
    assert sorted(r["v"] for r in scd2.publish(stage, held.limit(0), "sk").collect()) == [1, 3, 4, 6, 7, 20]
    with pytest.raises(ValueError):
        scd2.publish(stage.unionByName(stage), held, "sk")


# --- many changes meet their target in one join ---------------------------------------

def _rows(spark, rows, ddl="k long, j long, v long, gone boolean"):
    return spark.createDataFrame(rows, ddl)


def test_one_join_merges_as_two_do(spark):
    """Keys that are null or repeat in the target among them, and conditions that are null."""
    matching = [
        [merge.Delete(when=F.col("source.gone")), merge.Update({"v": F.col("source.v")}, when=F.col("source.v") > F.col("target.v"))],
        [merge.Update({"v": F.col("source.v") + F.col("target.v")})], []]
    inserting = [
        [merge.Insert({"k": F.col("source.k"), "j": F.col("source.j"), "v": F.col("source.v")}, when=F.col("source.v") > 50),
         merge.Insert({"k": F.col("source.k"), "v": F.lit(-1)}, when=~F.col("source.gone"))],
        [merge.Insert({"k": F.col("source.k")})], []]
    target = _rows(spark, [(1, 1, 10, None), (1, 1, 99, True), (2, 1, 20, None), (None, 1, 30, None), (3, None, 40, None), (4, 4, None, False)])
    source = _rows(spark, [(1, 1, 50, False), (2, 1, 5, True), (None, 1, 60, False), (3, None, 61, None), (4, 4, 7, None), (5, 5, 70, True),
                           (6, 6, 8, False), (7, 7, None, None), (None, None, 9, False)])

    def run(matched, not_matched, together):
        got = merge.merge_apply(target, source, ["k", "j"], matched, not_matched, unique_source=True, together=together)
        return got.columns, sorted(map(str, got.collect()))

    for clauses in product(matching, inserting):
        assert run(*clauses, True) == run(*clauses, False)


def test_one_join_is_for_sources_with_a_row_per_key(spark):
    with pytest.raises(ValueError):
        merge.merge_apply(_rows(spark, []), _rows(spark, []), ["k"], together=True)


def test_batches_to_broadcast_are_not_sizeable(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    rows = spark.range(100_000).selectExpr("id % 10000 k", "id v")                # 10,000 keys, 24 bytes a row
    try:
        for limit, want in {"-1": True, "0": True, "40000": True, "40k": True, "80k": False, "80000b": False, "1MB": False}.items():
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            assert merge.sizeable(rows, ["k"]) == want, limit
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "40000")
        assert not merge.sizeable(rows.filter("k < 5000"), ["k"])                # rows of a key count once
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("module, name, moves", [(erp, "erp_raw_sale_order_line", 3), (sales, "incr_daily_agg_deltas", 3), (star, "fact_upsert_session", 2)])
def test_target_and_changes_are_moved_once(no_broadcast, sf_dir, module, name, moves):
    """Beside the changes without a key, which are looked for by themselves."""
    plan = _plan(module.QUERIES[name](Tables(no_broadcast, sf_dir)))
    assert "FullOuter" in plan and "LeftAnti" not in plan and plan.count("Exchange hashpartitioning") <= moves


def test_small_batches_leave_the_target_unshuffled(spark, sf_dir):
    assert "FullOuter" not in _plan(erp.QUERIES["erp_raw_sale_order_line"](Tables(spark, sf_dir)))
