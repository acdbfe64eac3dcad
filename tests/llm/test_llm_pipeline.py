import pytest

import corpus_pipeline as pipeline
from test_llm_lines import brute as brute_lines
from test_llm_rules import brute as brute_measures
from test_llm_simhash import spread
from test_llm_tiling import brute_tiles, words
from tarnlake.llm import rules, simhash
from tarnlake.session import staged


def by_id(df):
    return sorted(map(tuple, df.select(pipeline.COLUMNS).collect()), key=str)


def good(text):
    m = dict(zip(rules.MEASURES, brute_measures(text)))
    return not (m["n_words"] < 10 or 100 * m["n_repeat_words"] > 20 * m["n_words"] or 10 * m["n_symbols"] > m["n_words"]
                or 100 * m["n_dup_lines"] > 30 * m["n_lines"] or m["word_chars"] < 2 * m["n_words"] or m["word_chars"] > 20 * m["n_words"])


def contaminated(text, items):
    b = words(text)
    grams = {tuple(b[i:i + 5]) for i in range(len(b) - 4)}
    for x in items:
        a = words(x)
        shared = [i for i in range(len(a) - 4) if tuple(a[i:i + 5]) in grams]       # tiles lie within shared grams
        if len({i + k for i in shared for k in range(5)}) >= 0.8 * len(a) and brute_tiles(a, b, 5) >= 0.8 * len(a):
            return True
    return False


@pytest.mark.parametrize("source", ["table", "edge"])
def test_stages_are_those_of_brute_force(spark, sf_dir, edge_docs, source):
    """Each stage on what its predecessor kept, held against the same step in plain Python."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet") if source == "table" else edge_docs
    items = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    stages = dict(pipeline.STAGES)
    rows = [tuple(r) for r in docs.select(pipeline.COLUMNS).collect()]

    out = staged(stages["quality_rules"](spark, docs, sf_dir), "test")
    rows = [r for r in rows if good(r[1])]
    assert by_id(out) == sorted(rows, key=str) and rows

    after = brute_lines([(k, r[1]) for k, r in enumerate(rows)], 10)
    # a document of common lines only stays as it is
    cut = {k: text if text.split() or not rows[k][1] else rows[k][1] for k, text, _, _ in after}
    out = staged(stages["line_dedup"](spark, out, sf_dir), "test")
    rows = [(r[0], cut[k], r[2], r[3], len(cut[k])) for k, r in enumerate(rows)]
    assert by_id(out) == sorted(rows, key=str)

    groups = {}
    label = spread(simhash.simhash(r[1]) for r in rows)
    for r in rows:
        groups.setdefault(label[simhash.simhash(r[1])], []).append(r)
    out = staged(stages["simhash_near_dedup"](spark, out, sf_dir), "test")
    rows = [tuple(r) for r in out.select(pipeline.COLUMNS).collect()]
    for group in groups.values():
        least = min((r[0] is None, r[0] or 0) for r in group)
        stays = {r for r in rows if r in group}
        assert len({r[:2] for r in stays}) == 1 and all((r[0] is None, r[0] or 0) == least for r in stays)
    assert len({r[:2] for r in rows}) == len(groups)

    out = staged(stages["decontaminate"](spark, out, sf_dir), "test")
    rows = [r for r in rows if not contaminated(r[1], items)]
    assert by_id(out) == sorted(rows, key=str)

    last = stages["mix_sources"](spark, out, sf_dir)
    assert set(pipeline.COLUMNS) < set(last.columns)
    assert set(by_id(last)) <= set(map(tuple, rows)) and last.count() > 0


def test_run_applies_all_stages(spark, sf_dir):
    out = pipeline.run(spark, sf_dir)
    assert [name for name, _ in pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "decontaminate", "mix_sources"]
    assert out.columns == [*pipeline.COLUMNS, "domain", "n_tokens", "copies"] and out.count() > 0


def test_no_rows(spark, sf_dir, no_docs):
    docs = no_docs.select(pipeline.COLUMNS)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0


def test_a_text_with_many_copies_reaches_the_output_once(spark, sf_dir):
    """Texts of common lines only keep them, so that near-dedup folds each group into one whole document."""
    texts = ["\n".join(" ".join(f"{name}{line}{word}" for word in range(12)) for line in range(4)) + "\n\n" for name in ("ash", "birch")]
    rows = [(10 * k + c, text, "en", "src0", len(text)) for k, text in enumerate(texts) for c in range(10)]
    own = " ".join(f"own{word}" for word in range(12))
    rows.append((99, texts[0] + own, "en", "src0", len(texts[0] + own)))
    docs = staged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), "test")
    out = staged(dict(pipeline.STAGES)["line_dedup"](spark, docs, sf_dir), "test")
    assert by_id(out) == sorted([*rows[:-1], (99, "\n" + own, "en", "src0", len(own) + 1)], key=str)
    out = dict(pipeline.STAGES)["simhash_near_dedup"](spark, out, sf_dir)
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {0: texts[0], 10: texts[1], 99: "\n" + own}
