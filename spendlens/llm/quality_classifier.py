"""Quality classifier by positive-unlabelled learning.

Trusted positives are a bounded sample of rows labelled 1 outside the held-out fold;
every document outside that fold is unlabelled, whatever its label. Negative labels
are never used.

1. One pass turns each whole text into a dozen numbers about its bytes, words and
   lines. They are stored; nothing later reads texts.
2. Each number is cut at quantiles of all documents, so the model is a sum of one
   weight per bin.
3. The class prior is estimated from the two bin distributions: documents are ranked
   by a naive Bayes ratio of positives to unlabelled, and the share of positives is
   the smallest ratio of tail masses (unlabelled to positives), with a margin for
   the sampling error of either.
4. The non-negative risk  p R+(g) + max(0, Ru-(g) - p R+-(g))  with the logistic loss
   is minimised by full-batch steps. Each step is one aggregation over the stored
   bins; the driver holds only the weights.

Null texts are empty texts; an empty text has its own bins and a score like any
other. Repeated rows get a row each. Without positives every score is 1 (nothing
speaks against a text), and an empty table gives no rows. Other columns are not
looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.store import materialize
from .common import by_slices, held_out, table, text_of

POSITIVES = 20_000
BINS = 12
STEPS = 40
RATE = 0.3
PENALTY = 1e-3
THRESHOLD = 0.5

FEATURES = ["words", "word_size", "distinct", "short", "upper", "digits", "symbols", "bars", "marks",
            "sentences", "line_size", "same_lines"]
UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
SYMBOLS = b"#*$%&<>@~^=_\\{}[]+"
MARKS = b"!?"
STOPS = b".,;:"


def measure(text: str) -> tuple[float, ...]:
    """The numbers of ``FEATURES`` for one text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n, size = len(words) or 1, len(raw) or 1

    def of(chars: bytes) -> int:
        return len(raw) - len(raw.translate(None, chars))

    lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
    return (
        math.log1p(len(words)),
        sum(map(len, words)) / n,
        len(set(words)) / n ** 0.8,
        sum(1 for w in words if len(w) <= 3) / n,
        of(UPPER) / size,
        of(DIGITS) / size,
        of(SYMBOLS) / n,
        raw.count(b"|") / n,
        of(MARKS) / n,
        of(STOPS) / n,
        len(words) / (len(lines) or 1),
        1 - len(set(lines)) / (len(lines) or 1),
    )


def features(docs: DataFrame) -> DataFrame:
    """doc_id and the numbers of every text (columns doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def make(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = np.array([measure(text) for text in batch.column(1).to_pylist()], np.float32).reshape(-1, len(FEATURES))
            return pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(rows[:, i]) for i in range(len(FEATURES))]], ["doc_id", *FEATURES])
        return by_slices(batches, make)

    schema = ", ".join(["doc_id long", *[f"{name} float" for name in FEATURES]])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _bins(batch: pa.RecordBatch, cuts: list[np.ndarray]) -> np.ndarray:
    """Weight numbers of each row, one per feature."""
    columns = [np.searchsorted(cut, batch.column(name).to_numpy(zero_copy_only=False), side="left") + i * (BINS + 1)
               for i, (name, cut) in enumerate(zip(FEATURES, cuts))]
    return np.stack(columns, axis=1) if batch.num_rows else np.zeros((0, len(FEATURES)), np.int64)


SIZE = len(FEATURES) * (BINS + 1) + 1
_SUMS = "at int, kind int, value double"


def _sums(stored: DataFrame, cuts: list[np.ndarray], weigh) -> dict[int, np.ndarray]:
    """Vectors summed over all rows, by kind. ``weigh`` gives, for the weight numbers
    and the positive flags of some rows, kinds with the row weights to add to each
    weight number (the last one is the constant)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            bins = _bins(batch, cuts)
            positive = batch.column("positive").to_numpy(zero_copy_only=False).astype(bool)
            for kind, (rows, weights) in weigh(bins, positive).items():
                here = total.setdefault(kind, np.zeros(SIZE))
                at = bins[rows]
                here[:-1] += np.bincount(at.ravel(), np.repeat(weights, at.shape[1]), SIZE - 1)
                here[-1] += weights.sum()
        for kind, here in total.items():
            at = np.flatnonzero(here)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), pa.array([kind] * len(at), pa.int32()), pa.array(here[at])],
                ["at", "kind", "value"])

    out: dict[int, np.ndarray] = {}
    for row in stored.mapInArrow(run, _SUMS).groupBy("at", "kind").agg(F.sum("value").alias("value")).collect():
        out.setdefault(row["kind"], np.zeros(SIZE))[row["at"]] = row["value"]
    return out


def _prior(stored: DataFrame, cuts: list[np.ndarray]) -> float:
    """The share of positives among the unlabelled."""
    def count(bins, positive):
        return {0: (np.arange(len(bins)), np.ones(len(bins))), 1: (np.flatnonzero(positive), np.ones(positive.sum()))}

    counts = _sums(stored, cuts, count)
    if 1 not in counts:
        return 1.0
    unlabelled, positives = counts[0], counts[1]
    ratio = np.log((positives[:-1] + 1) / (positives[-1] + BINS)) - np.log((unlabelled[:-1] + 1) / (unlabelled[-1] + BINS))

    # Masses of a hundred steps of the summed ratio, over all rows.
    def place(bins, positive):
        step = np.clip(((ratio[bins].sum(axis=1) + 10) * 5).astype(int), 0, 99)
        return {k: (np.flatnonzero(step == k), 1.0 + 0 * positive[step == k]) for k in np.unique(step)} | {
            100 + k: (np.flatnonzero((step == k) & positive), np.ones(((step == k) & positive).sum()))
            for k in np.unique(step[positive])}

    masses = {kind: vector[-1] for kind, vector in _sums(stored, cuts, place).items()}
    u = np.cumsum([masses.get(k, 0.0) for k in range(99, -1, -1)])
    p = np.cumsum([masses.get(100 + k, 0.0) for k in range(99, -1, -1)])
    tail_u, tail_p = u / u[-1], p / p[-1]
    margin = np.sqrt(math.log(4 / 0.1) / 2) * (1 / math.sqrt(u[-1]) + 1 / math.sqrt(p[-1]))
    usable = tail_p > 0.2
    best = np.argmin(((tail_u + margin) / np.maximum(tail_p, 1e-9))[usable])
    return float(np.clip((tail_u[usable] / tail_p[usable])[best], 0.05, 0.99))


def fit(stored: DataFrame, steps: int = STEPS) -> tuple[list[np.ndarray], np.ndarray, float]:
    """Cuts, weights and prior from the stored numbers (with ``positive``)."""
    places = [i / BINS for i in range(1, BINS)]
    row = stored.agg(*[F.percentile_approx(name, places, 2000).alias(name) for name in FEATURES]).first()
    # Cuts must be distinct; the smallest and the most common value get a bin of their own.
    cuts = [np.unique(np.array(row[name] or [0.0], np.float32)) for name in FEATURES]
    prior = _prior(stored, cuts)
    weights = np.zeros(SIZE)
    weights[-1] = math.log(prior / (1 - prior))
    first, second = np.zeros(SIZE), np.zeros(SIZE)
    for step in range(1, steps + 1):
        now = weights.copy()

        def slopes(bins, positive):
            g = now[bins].sum(axis=1) + now[-1]
            down = 1 / (1 + np.exp(np.clip(g, -40, 40)))  # slope of log(1 + exp(-g)), negated
            loss = np.logaddexp(0, g)
            at = np.flatnonzero(positive)
            every = np.arange(len(g))
            return {0: (at, -down[at]), 1: (at, 1 - down[at]), 2: (every, 1 - down),
                    3: (at, loss[at]), 4: (every, loss), 5: (at, np.ones(len(at))), 6: (every, np.ones(len(every)))}

        sums = _sums(stored, cuts, slopes)
        if 5 not in sums:
            break
        positives, rows = sums[5][-1], sums[6][-1]
        risk = sums[4][-1] / rows - prior * sums[3][-1] / positives
        against = sums[2] / rows - prior * sums[1] / positives
        slope = prior * sums[0] / positives + against if risk >= 0 else -against
        slope[:-1] += PENALTY * weights[:-1]
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope * slope
        weights = weights - RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-4)
    return cuts, weights, prior


def score(stored: DataFrame, cuts: list[np.ndarray], weights: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g = weights[_bins(batch, cuts)].sum(axis=1) + weights[-1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(g, -40, 40))))], ["doc_id", "score"])

    return stored.mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, steps: int = STEPS) -> DataFrame:
    """doc_id, held_out, score, predicted for every document (columns doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    trusted = labels.where((F.col("quality") == 1) & ~held_out()).select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    trusted = trusted.orderBy(F.xxhash64("doc_id"), "doc_id").limit(positives).select("doc_id", F.lit(True).alias("positive"))
    stored = materialize(
        features(docs).join(F.broadcast(trusted), "doc_id", "left")  # at most ``positives`` rows
        .withColumn("positive", F.coalesce("positive", F.lit(False))), "quality-numbers")
    training = stored.where(~held_out())
    if training.where("positive").limit(1).count():
        cuts, weights, _ = fit(training, steps)
        scored = score(stored, cuts, weights)
    else:
        scored = stored.select("doc_id", F.lit(1.0).alias("score"))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of all documents."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
