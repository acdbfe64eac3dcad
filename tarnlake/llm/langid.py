"""Language identification in two steps: the family first, then the language within it.

Both steps are linear support vector machines, one per pair of classes. A text's features are the shares of its hashed
letter n-grams (1 to 4 bytes of the lower-cased letters, words set off by blanks), so a text of any length is one vector
of fixed size and its whole length counts. A step's machines vote; the class with most votes wins, ties go to
the larger sum of margins.

Training uses at most `per_label` documents of each label, chosen by a hash of the id. The sample is drawn where the
documents lie, each pair's vectors meet in one task of bounded size, and what comes back is one weight vector per pair. Prediction is a
pass over the documents without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tarnlake.llm import tokens
from tarnlake.llm.common import arrow_map, ship, staged

BUCKETS = 1 << 12
ORDERS = (1, 2, 3, 4)
PER_LABEL = 1000
UNKNOWN = "und"
_PIECE = 1 << 16

# Families of the languages told apart here; a label not listed is a family of its own.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "pl": "slavic", "cs": "slavic", "sk": "slavic", "ru": "slavic", "uk": "slavic", "bg": "slavic",
}

# Bytes of letters as they are, A-Z in lower case, bytes above ASCII kept, everything else a blank.
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def _grams(data: np.ndarray) -> Iterator[np.ndarray]:
    """Bucket of the n-gram at each byte, for each order. Runs of blanks count as one."""
    folded = _FOLD[data]
    blank = folded == 0x20
    letters = folded[~(blank & np.concatenate(([True], blank[:-1])))].astype(np.uint64) if len(folded) else folded.astype(np.uint64)
    letters = np.concatenate(([np.uint64(0x20)], letters, [np.uint64(0x20)]))
    run = np.zeros(len(letters), np.uint64)
    for order in range(1, max(ORDERS) + 1):
        run = (run[:-1] if order > 1 else run) * np.uint64(256) + letters[order - 1:]
        if order in ORDERS and len(run):
            yield (tokens.mix(run * np.uint64(8) + np.uint64(order)) & np.uint64(BUCKETS - 1)).astype(np.int64)


def features(data: np.ndarray) -> np.ndarray:
    """Shares of the hashed n-grams of one text, each order adding up to one; long texts are read piece by piece."""
    counts = np.zeros((len(ORDERS), BUCKETS))
    for at in range(0, max(len(data), 1), _PIECE):
        for i, buckets in enumerate(_grams(data[at:at + _PIECE])):
            counts[i] += np.bincount(buckets, minlength=BUCKETS)
    return (counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)).sum(axis=0)


def fit(x: np.ndarray, y: np.ndarray, c: float = 1000.0, rounds: int = 300) -> np.ndarray:
    """Weights and bias of a linear SVM with squared hinge loss, by accelerated gradient descent; y is -1 or 1."""
    scale = np.sqrt((x * x).mean(axis=0)) + 1e-4
    z = np.hstack([x / scale / np.sqrt(x.shape[1]), np.ones((len(x), 1))])
    lead = np.ones(z.shape[1])
    for _ in range(20):                                        # largest eigenvalue of z'z, for the step size
        lead = z.T @ (z @ (lead / np.linalg.norm(lead)))
    step = 1.0 / (1.0 / c + 2.2 * np.linalg.norm(lead) / len(z))
    w = ahead = np.zeros(z.shape[1])
    for k in range(rounds):
        slack = np.maximum(0.0, 1.0 - y * (z @ ahead))
        after = ahead - step * (ahead / c - 2.0 * z.T @ (y * slack) / len(z))
        w, ahead = after, after + k / (k + 3.0) * (after - w)
    return np.concatenate([w[:-1] / scale / np.sqrt(x.shape[1]), w[-1:]])


def _vectorise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in tokens.chunks(batch):
            data, bounds = tokens.buffers(part.column(1))
            rows = np.array([features(data[lo:hi]) for lo, hi in zip(bounds, bounds[1:])], np.float32).reshape(-1)
            vectors = pa.FixedSizeListArray.from_arrays(pa.array(rows), BUCKETS).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([part.column(0), vectors, part.column(2)], ["label", "vector", "pick"])


def _fit_pair(rows: pd.DataFrame) -> pd.DataFrame:
    step, low, high = rows["step"].iloc[0], rows["low"].iloc[0], rows["high"].iloc[0]
    x = np.stack(rows["vector"].to_numpy()).astype(np.float64)
    y = np.where(rows["class"] == high, 1.0, -1.0)
    order = np.lexsort((*x.T[:2], y))                          # rows arrive in any order; the result must not hang on it
    return pd.DataFrame([{"step": step, "low": low, "high": high, "weights": fit(x[order], y[order])}])


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


class Model:
    """Pairs of classes with their weights: families under step "", and the languages of each family under its name."""

    def __init__(self, labels: list[str], pairs: Mapping[tuple[str, str, str], np.ndarray], families: Mapping[str, str]):
        self.labels = sorted(labels)
        self.family = {label: families.get(label, f"only {label}") for label in self.labels}
        self.steps = {"": sorted(set(self.family.values()))}
        for label, family in self.family.items():
            self.steps.setdefault(family, []).append(label)
        self.pairs = dict(pairs)

    def decide(self, step: str, x: np.ndarray) -> tuple[str, float]:
        """The winning class of a step and how sure it is, from 1/2 to 1 as its weakest vote goes."""
        classes = self.steps[step]
        if len(classes) == 1:
            return classes[0], 1.0
        votes, margins = dict.fromkeys(classes, 0), dict.fromkeys(classes, 0.0)
        sure: dict[tuple[str, str], float] = {}
        for low, high in combinations(classes, 2):
            w = self.pairs[step, low, high]
            margin = float(x @ w[:-1] + w[-1])
            votes[high if margin > 0 else low] += 1
            margins[high] += margin
            margins[low] -= margin
            sure[low, high] = margin
        best = max(classes, key=lambda c: (votes[c], margins[c], c))
        weakest = min(m if high == best else -m for (low, high), m in sure.items() if best in (low, high))
        return best, 1.0 / (1.0 + np.exp(-2.0 * weakest))

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        family, first = self.decide("", x)
        label, second = self.decide(family, x)
        return label, first * second


def train(labelled: DataFrame, families: Mapping[str, str] = FAMILIES, per_label: int = PER_LABEL) -> Model:
    """Fit the machines on `labelled` (doc_id, text, label); rows without label, text or letter are left out.

    The bound is `per_label` documents per label: about that many are chosen by a hash of doc_id, so the
    sample does not depend on how the table is cut, and a label that holds most rows gives no more than another. A family's
    share of them is thinned to about `per_label`, so that a pair never has more than about twice that many vectors.
    """
    spark = labelled.sparkSession
    usable = labelled.select("doc_id", "text", "label").filter(F.col("label").isNotNull() & has_letter(F.col("text")))
    counts = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}     # one row per language
    labels = sorted(counts)
    if not labels:
        return Model([], {}, families)
    # one entry per language, so the sample is drawn where the rows lie
    limits = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, round(min(1.0, per_label / n) * 1_000_000))))
    chosen = usable.filter(F.expr("pmod(xxhash64(doc_id, 'sample'), 1000000)") < F.element_at(limits, F.col("label")))
    pick = F.expr("pmod(xxhash64(doc_id, 'pair'), 1000000)").alias("pick")
    vectors = staged(arrow_map(chosen.select("label", "text", pick), _vectorise, "label string, vector array<float>, pick long"), "langid-sample")
    model = Model(labels, {}, families)
    member = [(label, "", model.family[label]) for label in labels] + [(label, model.family[label], label) for label in labels]
    size = {(at, own): sum(1 for m in member if m[1:] == (at, own)) for _, at, own in member}
    tasks = [(step, low, high, label, own, 1000000 // size[at, own]) for step, classes in model.steps.items() for low, high in combinations(classes, 2)
             for label, at, own in member if at == step and own in (low, high)]
    if tasks:
        ship(spark)
        wanted = spark.createDataFrame(tasks, "step string, low string, high string, label string, class string, limit long")
        fitted = vectors.join(wanted, "label").filter("pick < limit").groupBy("step", "low", "high").applyInPandas(
            _fit_pair, "step string, low string, high string, weights array<double>")
        model.pairs = {(r["step"], r["low"], r["high"]): np.array(r["weights"]) for r in fitted.collect()}
    return model


def _predictor(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in batches:
            for part in tokens.chunks(batch):
                data, bounds = tokens.buffers(part.column(part.schema.get_field_index("text")))
                readable = part.column(part.schema.get_field_index("__letter")).to_pylist()
                got = [model.predict(features(data[lo:hi])) if ok and model.labels else (UNKNOWN, 0.0)
                       for ok, lo, hi in zip(readable, bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([g[0] for g in got]), pa.array([g[1] for g in got], pa.float64())],
                    ["doc_id", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) for every document from its text alone; `und` with score 0 where the text is null, has
    no letter, or nothing was learnt. Repeated rows give repeated results."""
    shared = docs.sparkSession.sparkContext.broadcast(model)     # one vector of fixed size per pair of classes
    rows = docs.select("doc_id", "text", has_letter(F.col("text")).alias("__letter"))
    return arrow_map(rows, _predictor(shared), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")
