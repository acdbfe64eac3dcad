import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tarnlake.llm import lines

BLANKS = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def brute(rows, min_docs, min_chars=1):
    seen = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} if len(k) >= min_chars)
    out = []
    for i, t in rows:
        all_lines = (t or "").split("\n")
        kept = [x for x in all_lines if len(key(x)) < min_chars or seen[key(x)] < min_docs]
        out.append((i, "\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r["doc_id"], r["text"] or "", r["n_lines"], r["n_dropped"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("min_docs, min_chars, n_batches", [(10, 1, 1), (10, 1, 4), (2, 1, 3), (1, 1, 2), (2, 6, 4)])
def test_edge_rows(edge_docs, texts, min_docs, min_chars, n_batches):
    out = lines.drop_common_lines(edge_docs, min_docs, min_chars, n_batches)
    assert result(out) == brute(texts, min_docs, min_chars)
    assert "source" in out.columns and out.columns.count("n_dropped") == 1


@pytest.mark.parametrize("kind", ["json", "orc"])
def test_inputs_that_are_no_parquet(spark, edge_docs, texts, tmp_path, kind):
    path = str(tmp_path / "other")
    edge_docs.select("doc_id", "text").repartition(16).write.format(kind).save(path)
    docs = spark.read.format(kind).schema("doc_id long, text string").load(path)
    assert result(lines.drop_common_lines(docs, 10, 1, 3)) == brute(texts, 10)
    assert result(lines.drop_common_lines(docs.filter("doc_id < 105"), 4, 1, 3)) == brute([r for r in texts if r[0] is not None and r[0] < 105], 4)


def test_keys_that_are_common_already_are_dropped_from_later_batches(spark, monkeypatch):
    """What earlier batches hold often enough is anti-joined away: later runs have no row for it."""
    rows = [(i, f"every document has this\nonly {i}") for i in range(400)]
    docs, seen = spark.createDataFrame(rows, "doc_id long, text string"), []
    count = lines.document_counts

    def counted(batch, known=None):
        out = count(batch, known)
        seen.append((0 if known is None else known.count(), out.filter("n_docs > 1").count(), out.count()))
        return out

    monkeypatch.setattr(lines, "document_counts", counted)
    out = lines.drop_common_lines(docs, 10, 1, 4)
    assert result(out) == brute(rows, 10)
    assert [s[:2] for s in seen] == [(0, 1), (1, 0), (1, 0), (1, 0)] and sum(s[2] for s in seen) == 401


def test_many_lines_in_one_text(spark):
    rng = random.Random(5)
    rows = [(i, "\n".join(f"line {rng.randrange(300)}" for _ in range(n))) for i, n in enumerate([1000, 64, 65, 63, 128, 1])]
    out = lines.drop_common_lines(spark.createDataFrame(rows, "doc_id long, text string"), 3)
    assert result(out) == brute(rows, 3)


def test_runs_are_compacted_by_level(spark):
    runs = lines.LineRuns(spark, fanout=3)
    for b in range(7):
        runs.add(spark.createDataFrame([(b, f"same\nonly {b}")], "doc_id long, text string"))
    assert [len(level) for level in runs.levels] == [1, 2]
    assert sorted(r["n_docs"] for r in runs.counts().collect()) == [1] * 7 + [7]
    assert runs.at_least(7).count() == 1


@pytest.mark.parametrize("computed", [False, True])
def test_levels_do_not_depend_on_the_files(edge_docs, spark, texts, tmp_path, monkeypatch, computed):
    """One file, or rows that are not those of files, are cut into as many batches as asked for, and levels are compacted."""
    edge_docs.coalesce(1).write.parquet(str(tmp_path / "one"))
    docs, pushed, push = spark.read.parquet(str(tmp_path / "one")), [], lines.LineRuns._push
    docs = docs.withColumn("text", F.concat("text")) if computed else docs
    assert len(docs.inputFiles()) == 1
    monkeypatch.setattr(lines.LineRuns, "_push", lambda self, level, counts: (pushed.append(level), push(self, level, counts)) and None)
    assert result(lines.drop_common_lines(docs, 10)) == brute(texts, 10)
    assert pushed == [0, 0, 0, 0, 1, 0, 0, 0, 0, 1]


def test_a_batch_loses_the_lines_of_earlier_ones(spark):
    runs = lines.LineRuns(spark, fanout=2)
    texts = ["a\nb", "b\nc\nc", "C\nd\n\n", None]
    kept = [runs.drop_known(spark.createDataFrame([(i, t)], "doc_id long, text string")).first()["text"]
            for i, t in enumerate(texts)]
    assert kept == ["a\nb", "c\nc", "d\n\n", None]


def test_no_rows(no_docs, spark):
    assert lines.drop_common_lines(no_docs).count() == 0
    assert lines.LineRuns(spark).counts().count() == 0
