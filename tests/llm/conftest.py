import random

import pytest

COLUMNS = ("doc_id long, text string, lang string, source string, n_chars long, n_words long, fp long, key string, "
           "start int, runs string, words string, copies long, n_dropped long, item_id long, full long, rest long, at string, bound long, "
           "hash long, prefix long, label int, term int, score double, rank int, block int, hit int, pos int, bits long")


def _passage(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 7))) for _ in range(n))


PASSAGE = _passage(0, 70)


def edge_rows():
    """Ids and texts that try an operator: nulls, blanks, ties, copies, near copies, repeated ids and rows, long texts."""
    common = "A Common Line here"
    texts = [
        (1, None), (2, ""), (3, " \t\n \x0b\x0c\r "), (4, "one"), (5, "a b c d e"), (6, "été Über ñandú ÀÉ"),
        (7, f"{_passage(1, 20)} {PASSAGE} {_passage(2, 20)}"), (8, f"{_passage(3, 5)} {PASSAGE}"), (9, PASSAGE),
        (10, f"{PASSAGE} {PASSAGE}"), (11, "the " * 400), (12, "the " * 300), (13, _passage(4, 3000)),
        (14, _passage(4, 3000)), (14, _passage(4, 3000)), (15, _passage(4, 2999) + " changed"),
        (16, f"{common}\nmine\n  {common.upper()}\t\n\n"), (None, PASSAGE), (None, None), (7, "another text of id seven"),
        (-5, f"x {PASSAGE} y"), (17, "nul \x00 and \x1c unit   hard blank 日本語 text"), (18, "z" * 50_000),
    ]
    texts += [(100 + i, f"{common}\nline {i % 3}\r\n{_passage(50 + i, 12)}") for i in range(12)]
    texts += [(200, f"{PASSAGE} once more")] * 300
    return [(i, t, ["en", "de", None][k % 3], ["src0", None, "src1"][k % 3], 0, -1, -1, "k", -1, "r", "w", -1, -1, -1,
             -1, -1, "a", -1, -1, -1, -1, -1, -1.0, -1, -1, -1, -1, -1)
            for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def edge_docs(spark, tmp_path_factory):
    """The edge rows as a table of several files, with columns named like those operators use themselves."""
    path = str(tmp_path_factory.mktemp("edge") / "documents")
    spark.createDataFrame(edge_rows(), COLUMNS).repartition(4).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text) of the edge rows."""
    return [r[:2] for r in edge_rows()]
