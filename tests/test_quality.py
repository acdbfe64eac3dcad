from functools import reduce

import pytest
from pyspark.sql import DataFrame, functions as F

from tarnlake.operators import profile, quality as dq
from tarnlake.plans.quality import CONFIG


def metrics(df, *checks):
    return {r["constraint_name"]: (r["metric"], r["status"]) for r in dq.run_checks(df, checks).collect()}


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(
        [(1, "a", 5.0, 6.0), (2, "b", None, 1.0), (2, "c", -1.0, None), (None, None, 0.0, 2.0)],
        "k int, s string, x double, y double",
    )


def test_null_rules(df):
    got = metrics(
        df, dq.complete("k"), dq.unique("k"), dq.uniqueness(["k", "s"]), dq.non_negative("x"),
        dq.contained_in("s", ["a", "b", "c"]), dq.less_than("x", "y"), dq.minimum("x", -1), dq.maximum("y", 5),
        dq.data_type("s", "int"),
    )
    assert got == {
        "is_complete(k)": (0.75, "Failure"),
        "is_unique(k)": (0.5, "Failure"),                    # 1 and the NULL key occur once
        "has_uniqueness(k,s)": (1.0, "Success"),
        "non_negative(x)": (0.75, "Failure"),                # NULL passes
        "contains(s)": (1.0, "Success"),                     # NULL passes
        "is_less_than(x,y)": (0.5, "Failure"),               # NULL on either side fails
        "has_min(x)": (-1.0, "Success"),
        "has_max(y)": (6.0, "Failure"),
        "has_data_type(s, int)": (0.25, "Failure"),
    }


def test_empty_table_passes_ratios(spark, df):
    got = metrics(df.limit(0), dq.complete("k"), dq.unique("k"))
    assert {s for _, s in got.values()} == {"Success"}


def test_gate_names_what_failed(df):
    with pytest.raises(dq.QualityError, match=r"is_complete\(k\); non_negative\(x\)"):
        dq.gate(dq.run_checks(df, [dq.complete("k"), dq.non_negative("x"), dq.uniqueness(["k", "s"])]))
    dq.gate(dq.run_checks(df, [dq.uniqueness(["k", "s"])]))


def test_publish_happens_only_when_checks_pass(df):
    calls = []
    with pytest.raises(dq.QualityError):
        dq.write_audit_publish(df, [dq.complete("k")], calls.append)
    assert calls == []
    dq.write_audit_publish(df.withColumn("r", F.rand()), [dq.uniqueness(["k", "s"])], calls.append)
    assert len(calls) == 1
    assert calls[0].collect() == calls[0].collect() and calls[0].inputFiles()       # a written table: what was checked


def test_configuration(df):
    for table in CONFIG.values():
        assert dq.compile_checks(table)
    twice = {"checks": [{"column": "k", "type": "is_unique"}, {"column": "k", "type": "is_unique"}]}
    assert dq.compile_checks(twice) == [dq.unique("k")]
    with pytest.raises(ValueError, match="unknown check type"):
        dq.compile_checks({"checks": [{"column": "k", "type": "is_pretty"}]})


def test_row_wise_checks_share_one_scan(df):
    checks = [dq.complete("k"), dq.non_negative("x"), dq.less_than("x", "y"), dq.minimum("x", 0)]
    plan = dq.run_checks(df, checks)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_profile(df):
    rows = {r["column_name"]: r for r in dq.profile(df, exact=True).collect()}
    assert rows["k"]["nulls"] == 1 and rows["k"]["distinct_values"] == 2 and rows["k"]["max_value"] == "2"
    assert rows["s"]["mean"] is None and rows["x"]["mean"] == pytest.approx(4 / 3)
    assert dq.profile(df, ["k"]).first()["distinct_values"] == 2


def test_results_are_tagged_and_appended(spark, df, tmp_path):
    results = dq.run_checks(df, [dq.complete("k")], "t")
    for run in ("r1", "r2"):
        tagged = dq.tag_results(results, "dag", run, F.lit("2024-01-01").cast("timestamp_ntz"))
        tagged.write.mode("append").partitionBy("dag_id", "run_id").json(str(tmp_path / "audit"))
    assert spark.read.json(str(tmp_path / "audit")).select("run_id").distinct().count() == 2


def test_profiles_of_parts_add_up(spark):
    """Merged measures are the profile of all rows: exactly for counts, bounds and moments, within the stated error for distinct values."""
    df = spark.range(20_000).select(
        (F.col("id") % 7).cast("int").alias("part"), F.when(F.col("id") % 10 > 0, F.col("id") % 3000).alias("many"),
        F.concat(F.lit("v"), F.least(F.col("id") % 11, F.lit(3))).alias("few"), (F.col("id") * 0.5 - 9).alias("x"),
        F.lit(None).cast("string").alias("none"), F.struct("id").alias("nested"))
    parts = [profile.measure(df.filter(F.col("part") == p), by=["part"]) for p in range(7)]
    stored = reduce(DataFrame.unionByName, parts)
    assert stored.count() == 7
    got = {r["column_name"]: r for r in profile.merged(stored).collect()}
    want = {r["column_name"]: r for r in dq.profile(df.drop("part", "nested"), exact=True).collect()}
    assert set(got) == set(want) == {"many", "few", "x", "none"}
    for name, w in want.items():
        g = got[name]
        assert (g["rows"], g["nulls"], g["min_value"], g["max_value"]) == (w["rows"], w["nulls"], w["min_value"], w["max_value"])
        assert abs(g["distinct_values"] - w["distinct_values"]) <= 3 * 1.04 / 64 * w["distinct_values"] + 0.5
        for measure in ("mean", "std_dev"):
            assert g[measure] == pytest.approx(w[measure], rel=1e-9) if w[measure] is not None else g[measure] is None
    counts = {r["few"]: r["count"] for r in df.groupBy("few").count().collect()}
    top = got["few"]["top_values"]
    assert sorted(top) == sorted(f"{v}: {n}" for v, n in counts.items()) and top[0] == "v3: 14544" and top[-1] == "v2: 1818"
    assert profile.merged(profile.measure(df.limit(0))).first()["rows"] in (0, None)
