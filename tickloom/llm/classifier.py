"""Quality classifier: Naive Bayes support vectors over word n-grams.

Method. A text is the set of its single tokens and pairs of neighbours, hashed to ``BUCKETS`` places;
tokens are runs of letters and digits, runs of signs, and line ends. Each place is scaled by the log ratio of
its share in texts of either class, counted over all labelled rows that may be learned from. On these
scaled indicators, brought to unit length so that long texts weigh no more, a linear model with hinge loss is fitted
by dual coordinate descent, and drawn towards the plain log ratios as the method asks (``SHARE``). A
logistic curve, fitted on a fifth of the sample that the model has not seen, makes scores of margins.

Counting and scoring run on all rows, with numpy on one batch at a time. The descent is sequential and runs in the
driver, on a bounded sample: the ``SAMPLE_ROWS`` labelled rows with the smallest hash of their id, as long
as they have no more than ``SAMPLE_INDICATORS`` indicators together. Counts and weights have
``BUCKETS`` rows at most, however large the corpus.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.session import materialise

BUCKETS = 1 << 18
SAMPLE_ROWS = 20_000
SAMPLE_INDICATORS = 10_000_000
#: Added to every count.
SMOOTHING = 1.0
#: Bound of a dual variable, before the classes are balanced.
COST = 1.0
#: Share of the fitted weights; the rest is the log ratios alone.
SHARE = 0.25
EPOCHS = 20
TOLERANCE = 1e-3

_TOKEN = re.compile(r"[^\W_]+|\n|(?:[^\w\s]|_)+")
_CACHED_TOKENS = 500_000
_Batches = Iterator[pa.RecordBatch]


def is_held_out(id_: Column) -> Column:
    """Whether labels of the row must not be learned from; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit(""))) % 3 == 1


class _Codes(dict):
    """Code of each token, kept because tokens repeat."""

    def __missing__(self, token: str) -> int:
        if len(self) >= _CACHED_TOKENS:
            self.clear()
        code = self[token] = zlib.crc32(token.encode("utf-8", "replace"))
        return code


def _places(code: np.ndarray) -> np.ndarray:
    mixed = code * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(40)) % np.uint64(BUCKETS)


def indicators(text: str | None, codes: _Codes) -> np.ndarray:
    """The places of the n-grams of a text, in order and without repeats."""
    tokens = _TOKEN.findall((text or "").lower())
    code = np.fromiter(map(codes.__getitem__, tokens), np.uint64, len(tokens))
    pairs = code[:-1] * np.uint64(0x100000001B3) + code[1:] + np.uint64(1)
    return np.unique(np.concatenate([_places(code), _places(pairs)])).astype(np.int32)


def _features(batches: _Batches) -> _Batches:
    codes = _Codes()
    for batch in batches:
        found = [indicators(text.as_py(), codes) for text in batch.column("text")]
        offsets = np.cumsum([0, *map(len, found)])
        places = pa.ListArray.from_arrays(
            pa.array(offsets, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int32), *found]))
        )
        yield pa.RecordBatch.from_arrays(
            [batch.column("pick"), batch.column("label"), places], names=["pick", "label", "places"]
        )


def _counts(batches: _Batches) -> _Batches:
    """Of every place: the texts of either class that have it, one row per place and task."""
    counts = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        places = batch.column("places")
        lengths = np.diff(places.offsets.to_numpy())
        labels = np.repeat(batch.column("label").to_numpy(), lengths)
        flat = places.values.to_numpy()
        for label in (0, 1):
            counts[label] += np.bincount(flat[labels == label], minlength=BUCKETS)
    used = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), *[pa.array(counts[label][used]) for label in (0, 1)]],
        names=["place", "low", "high"],
    )


def _log_ratios(features: DataFrame) -> np.ndarray:
    """Log of the share of each place among texts of class 1, over that among texts of class 0."""
    by_place = features.select("label", "places").mapInArrow(_counts, "place int, low long, high long")
    rows = by_place.groupBy("place").agg(F.sum("low").alias("low"), F.sum("high").alias("high")).toArrow()
    counts = np.full((2, BUCKETS), SMOOTHING)
    for label, name in enumerate(("low", "high")):
        counts[label][rows.column("place").to_numpy()] += rows.column(name).to_numpy()
    low, high = counts / counts.sum(axis=1, keepdims=True)
    return np.log(high / low)


def _sample(features: DataFrame, rows: int, most: int) -> list[tuple[int, np.ndarray]]:
    """Label and places of the rows with the smallest picks, within both bounds."""
    sizes = features.select("pick", F.size("places").alias("n")).orderBy("pick").limit(rows).toArrow()
    total = np.cumsum(sizes.column("n").to_numpy())
    within = int(np.searchsorted(total, most, side="right"))
    if within == 0:
        return []
    last = sizes.column("pick")[within - 1].as_py()
    chosen = features.where(F.col("pick") <= last).orderBy("pick").limit(within).toArrow()
    places = chosen.column("places").combine_chunks()
    flat, offsets = places.values.to_numpy(), places.offsets.to_numpy()
    return [
        (label, flat[offsets[i] : offsets[i + 1]]) for i, label in enumerate(chosen.column("label").to_pylist())
    ]


def _unit(ratios: np.ndarray, places: np.ndarray) -> np.ndarray:
    values = ratios[places]
    return values / max(float(np.sqrt(values @ values)), 1e-12)


def fit_hinge(
    rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, bounds: np.ndarray, size: int
) -> tuple[np.ndarray, float]:
    """Weights and intercept of least hinge loss, by dual coordinate descent in random order.

    A row is (places, values) and has a sign; its dual variable stays between 0 and its bound. The
    intercept is the weight of a value of 1 that every row has.
    """
    weights, intercept = np.zeros(size), 0.0
    duals = np.zeros(len(rows))
    squares = np.array([float(values @ values) + 1.0 for _, values in rows])
    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        worst = 0.0
        for i in order.permutation(len(rows)):
            places, values = rows[i]
            slope = signs[i] * (float(weights[places] @ values) + intercept) - 1.0
            dual = min(max(duals[i] - slope / squares[i], 0.0), bounds[i])
            step = dual - duals[i]
            if step:
                duals[i] = dual
                weights[places] += step * signs[i] * values
                intercept += step * signs[i]
                worst = max(worst, abs(step) / bounds[i])
        if worst < TOLERANCE:
            break
    return weights, intercept


def _logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope, positive, and offset of the curve that turns margins into shares of class 1, by Newton's method."""
    # Targets a little off 0 and 1 keep the slope finite where margins part the classes.
    ones, zeros = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.stack([margins, np.ones(len(margins))])
    point = np.array([1.0, 0.0])
    for _ in range(50):
        share = 1 / (1 + np.exp(-np.clip(point @ x, -500, 500)))
        gradient = x @ (share - target) + 1e-6 * point
        curvature = (x * (share * (1 - share))) @ x.T + 1e-6 * np.eye(2)
        step = np.linalg.solve(curvature, gradient)
        point = point - step / max(1.0, float(np.abs(step).max()) / 4)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(point[0]), 1e-3), float(point[1])


class Model:
    """What scores a text: the log ratios, weights on them, an intercept and a logistic curve."""

    def __init__(self, sample: list[tuple[int, np.ndarray]], ratios: np.ndarray):
        labels = np.array([label for label, _ in sample], np.int64)
        self.ratios = ratios
        self.weights, self.intercept, self.curve = np.zeros(BUCKETS), 0.0, (0.0, 0.0)
        ones = int(labels.sum())
        if not 0 < ones < len(labels):
            # One class only: every text has the smoothed share of class 1.
            self.curve = (0.0, float(np.log((ones + 1) / (len(labels) - ones + 1))))
            return
        rows = [(places, _unit(ratios, places)) for _, places in sample]
        fitted = np.arange(len(rows)) % 5 > 0
        if not 0 < labels[fitted].sum() < fitted.sum() or not 0 < labels[~fitted].sum() < (~fitted).sum():
            fitted = np.ones(len(rows), bool)
        checked = ~fitted if not fitted.all() else fitted
        signs = 2.0 * labels[fitted] - 1
        shares = np.array([(signs < 0).mean(), (signs > 0).mean()])
        bounds = COST / (2 * shares[labels[fitted]])
        weights, self.intercept = fit_hinge(
            [r for r, used in zip(rows, fitted, strict=True) if used], signs, bounds, BUCKETS
        )
        self.weights = (1 - SHARE) * np.abs(weights).mean() + SHARE * weights
        self.intercept *= SHARE
        margins = np.array([self.margin(places) for (_, places), used in zip(sample, checked, strict=True) if used])
        self.curve = _logistic(margins, labels[checked])

    def margin(self, places: np.ndarray) -> float:
        return float(self.weights[places] @ _unit(self.ratios, places)) + self.intercept

    def score(self, places: np.ndarray) -> float:
        slope, offset = self.curve
        return float(1 / (1 + np.exp(-np.clip(slope * self.margin(places) + offset, -500, 500))))


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    sample_indicators: int = SAMPLE_INDICATORS,
) -> Model:
    """A model of ``label`` from the rows of ``docs`` that are labelled and not held out."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("of"), F.col(label).cast("int").alias("label"))
        .where(F.col("of").isNotNull() & F.col("label").isin(0, 1) & ~is_held_out(F.col("of")))
        .groupBy("of")
        .agg(F.min("label").alias("label"), F.max("label").alias("most"))
        .where(F.col("label") == F.col("most"))
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").where(~is_held_out(F.col("id")))
    # One plan at every size: labels grow with the corpus and are not broadcast.
    joined = texts.join(known.hint("merge"), F.col("id") == F.col("of"))
    features = materialise(
        joined.select(F.xxhash64("id").alias("pick"), "label", "text").mapInArrow(
            _features, "pick long, label int, places array<int>"
        )
    )
    return Model(_sample(features, sample_rows, sample_indicators), _log_ratios(features))


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """A row per document: ``held_out``, ``score`` from 0 to 1 (higher: label 1 is likelier), ``predicted``.

    Only texts enter a score. Labels are learned from documents whose id has a crc32 that leaves no 1 when
    divided by 3; the others are ``held_out``. A label that is null or neither 0 nor 1, and labels of
    one id that disagree, are not learned from; neither are rows without id. Equal ids are rows of their own. A null
    text is empty; an empty text has the score of the intercept. A text of any length counts
    whole. Without labels of both classes, all texts have the smoothed share of class 1 as score, one half if
    nothing is labelled. Other columns are not read. An empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, label))
    chosen = docs.select(F.col("doc_id").cast("long"), is_held_out(F.col("doc_id")).alias("held_out"), "text")
    scored = chosen.mapInArrow(_scorer(model), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _scorer(model) -> Callable[[_Batches], _Batches]:
    def run(batches: _Batches) -> _Batches:
        codes = _Codes()
        for batch in batches:
            scores = [model.value.score(indicators(text.as_py(), codes)) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "score"],
            )

    return run
