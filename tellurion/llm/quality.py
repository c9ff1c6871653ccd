"""Quality scores from document statistics by kernel ridge regression (operator 5).

Every text is reduced to the statistics in ``STATISTICS``. Cosines of random
projections of the standardised statistics approximate a Gaussian kernel. Each
task adds the products of its labelled rows into one matrix, Spark sums the
matrices cell by cell, and the driver solves the normal equations, whose size
depends on ``features`` alone. Scores of the training rows are counted in bins
with their labels and made monotone by pooling adjacent violators: the calibrated
score is a share of good documents.

Only statistics meet the labels, so no text is shuffled; written once, they serve
training and scoring. ``scored`` works on texts, for filters.

Cases: a null text is an empty one, and both get a score. Null labels and labels
of absent documents are not used; several labels of one document count as their
mean. Without labels every score is 0.5, with labels of one kind it is that
label. Null and repeated ids are scored row by row. An empty table gives no row.
Columns other than the id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellurion.llm.common import chunks, released, staged
from tellurion.llm.textops import Spans, code_points, mix, runs, sums

STATISTICS = (
    "log_chars", "log_words", "word_length", "word_length_spread", "longest_word", "upper", "digit",
    "stop_marks", "loud_marks", "symbols", "white", "lines", "line_length", "distinct_words",
    "repeated_windows", "repeated_lines", "short_words", "capital_words", "non_ascii", "top_word",
)
FEATURES = 384
RIDGE = 1e-4
BINS = 1024
SEED = 7
BATCH_CHARS = 500_000
#: Bandwidth: projections have variance ``GAMMA`` per standardised statistic.
GAMMA = 0.1
_CLASSES: list[np.ndarray] = []
_KINDS = ("white", "upper", "lower", "digit", "stop", "loud", "symbol", "other")


def _classes() -> np.ndarray:
    """The kind of each code point, as an index into ``_KINDS``."""
    if not _CLASSES:
        kinds = np.full(0x110000, _KINDS.index("other"), np.uint8)
        for i in range(0x3000):
            c = chr(i)
            if c.isspace():
                kind = "white"
            elif c.isupper():
                kind = "upper"
            elif c.isalpha():
                kind = "lower"
            elif c.isdigit():
                kind = "digit"
            elif c in ".,;:'\"()-":
                kind = "stop"
            elif c in "!?":
                kind = "loud"
            elif i < 0x80:
                kind = "symbol"
            else:
                continue
            kinds[i] = _KINDS.index(kind)
        _CLASSES.append(kinds)
    return _CLASSES[0]


def _repeats(values: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per document: values equal to an earlier one, and the count of the commonest."""
    if not len(values):
        return np.zeros(n), np.zeros(n)
    # The high bits are the document of the batch, the rest the value.
    tagged = (doc.astype(np.uint64) << np.uint64(44)) | (values >> np.uint64(20))
    keys = np.sort(tagged)
    first = np.flatnonzero(np.diff(keys, prepend=keys[0] + np.uint64(1)))
    counts = np.diff(np.append(first, len(keys)))
    owner = (keys[first] >> np.uint64(44)).astype(np.int64)
    again = np.bincount(owner, counts - 1, n)
    top = np.zeros(n)
    np.maximum.at(top, owner, counts)
    return again, top


def statistics(texts: list[str | None]) -> np.ndarray:
    """One row of ``STATISTICS`` per text."""
    n = len(texts)
    points, bounds = code_points(texts)
    kinds = _classes()[points]
    # The line feed after each text belongs to no text.
    chars = np.diff(bounds) - 1
    counts = np.stack([sums(kinds == k, bounds) for k in range(len(_KINDS))]).astype(float)
    counts[0] -= 1
    white, upper, lower, digit, stop, loud, symbol, other = counts
    start, end = runs(kinds != 0)
    doc = np.searchsorted(bounds, start, "right") - 1
    length = end - start
    words = np.bincount(doc, minlength=n).astype(float)
    per_word = 1 / np.maximum(words, 1)
    per_char = 1 / np.maximum(chars, 1)
    mean = np.bincount(doc, length, n) * per_word
    square = np.bincount(doc, length.astype(float) ** 2, n) * per_word
    longest = np.zeros(n)
    np.maximum.at(longest, doc, length)
    spans = Spans(mix(points.astype(np.uint64) + np.uint64(1)))
    hashes = spans.of(start, end)
    again, top = _repeats(hashes, doc, n)
    third = np.flatnonzero(doc[2:] == doc[:-2]) if len(doc) > 2 else np.zeros(0, np.int64)
    windows = mix(hashes[third] + mix(hashes[third + 1] + mix(hashes[third + 2]))) if len(third) else hashes[:0]
    window_again, _ = _repeats(windows, doc[third] if len(third) else third, n)
    feeds = np.flatnonzero(points == 10)
    line_start = np.concatenate([[0], feeds[:-1] + 1])
    line_doc = np.searchsorted(bounds, line_start, "right") - 1
    filled = feeds > line_start
    lines = np.bincount(line_doc[filled], minlength=n).astype(float)
    line_again, _ = _repeats(spans.of(line_start[filled], feeds[filled]), line_doc[filled], n)
    letters = np.maximum(upper + lower, 1)
    return np.stack(
        [
            np.log1p(chars),
            np.log1p(words),
            np.minimum(mean, 50),
            np.sqrt(np.maximum(square - mean**2, 0)).clip(max=50),
            np.log1p(longest),
            upper / letters,
            digit * per_char,
            stop * per_word,
            np.log1p(loud) * per_word + loud * per_word,
            symbol * per_word,
            white * per_char,
            np.log1p(lines),
            np.log1p(chars / np.maximum(lines, 1)),
            1 - again * per_word,
            window_again * per_word,
            line_again / np.maximum(lines, 1),
            np.bincount(doc, length <= 3, n) * per_word,
            np.bincount(doc, kinds[start] == 1, n) * per_word,
            other * per_char + sums(points > 127, bounds) * per_char,
            top * per_word,
        ],
        1,
    )


def pooled(weights: np.ndarray, means: np.ndarray) -> np.ndarray:
    """Monotone fit to weighted means: adjacent values out of order are pooled."""
    blocks: list[list[float]] = []
    for weight, mean in zip(weights.tolist(), means.tolist()):
        blocks.append([weight, mean, 1])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            w, m, k = blocks.pop()
            v, l, j = blocks[-1]
            blocks[-1] = [v + w, (v * l + w * m) / (v + w), j + k]
    return np.repeat([b[1] for b in blocks], [b[2] for b in blocks]) if blocks else np.zeros(0)


@dataclass
class Model:
    """Standardisation, projections, weights and calibration."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    points: np.ndarray
    values: np.ndarray
    gamma: float = GAMMA
    seed: int = SEED

    def features(self, rows: np.ndarray, count: int) -> np.ndarray:
        rng = np.random.default_rng(self.seed)
        directions = rng.normal(0, np.sqrt(2 * self.gamma), (len(STATISTICS), count))
        phases = rng.uniform(0, 2 * np.pi, count)
        standard = ((rows - self.mean) / self.scale).clip(-5, 5)
        waves = np.cos(standard @ directions + phases) * np.sqrt(2 / count)
        return np.concatenate([waves, np.ones((len(rows), 1))], 1)

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return self.features(rows, len(self.weights) - 1) @ self.weights

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        if not len(self.points):
            return np.full(len(raw), 0.5)
        return np.interp(raw, self.points, self.values)

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Calibrated scores of texts, a bounded batch at a time."""
        sizes = np.fromiter((len(t or "") for t in texts), np.int64, len(texts))
        parts = [
            self.calibrated(self.raw(statistics(texts[a:b])))
            for a, b in chunks(sizes, BATCH_CHARS)
        ]
        return np.concatenate(parts) if parts else np.zeros(0)


def _normal_sums(labelled: DataFrame, model: Model, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Summed products of features, and of features with the labels."""
    size = count + 1
    upper = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, targets = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            rows = np.array(batch.column(0).to_pylist(), float).reshape(-1, len(STATISTICS))
            for at in range(0, len(rows), 2048):
                part = model.features(rows[at : at + 2048], count)
                products += part.T @ part
                targets += part.T @ batch.column(1).to_numpy(zero_copy_only=False)[at : at + 2048]
        values = np.concatenate([products[upper], targets])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(values))), pa.array(values)], ["cell", "value"]
        )

    summed = labelled.select("stats", "label").mapInArrow(run, "cell long, value double")
    cells = summed.groupBy("cell").agg(F.sum("value").alias("value")).toPandas()
    values = np.zeros(len(upper[0]) + size)
    values[cells["cell"].to_numpy()] = cells["value"].to_numpy()
    matrix = np.zeros((size, size))
    matrix[upper] = values[: len(upper[0])]
    return matrix + np.triu(matrix, 1).T, values[len(upper[0]) :]


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            sizes = np.fromiter((len(t or "") for t in texts), np.int64, len(texts))
            for a, b in chunks(sizes, BATCH_CHARS):
                stats = statistics(texts[a:b])
                flat = pa.FixedSizeListArray.from_arrays(pa.array(stats.reshape(-1)), len(STATISTICS))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), flat.cast(pa.list_(pa.float64()))],
                    ["doc_id", "stats"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(released(run), "doc_id long, stats array<double>")


def train(
    stats: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    label_col: str = "quality",
    count: int = FEATURES,
    ridge: float = RIDGE,
    gamma: float = GAMMA,
) -> Model:
    """Fit a model on the statistics of all documents that have a label."""
    targets = (
        labels.select(F.col(id_col).alias("labelled"), F.col(label_col).cast("double").alias("label"))
        .where("labelled is not null and label is not null")
        .groupBy("labelled")
        .agg(F.avg("label").alias("label"))
    )
    joined = stats.join(targets, F.col("doc_id") == F.col("labelled"))
    labelled = staged(joined.select("stats", "label"), "labelled")
    moments = labelled.select(
        F.count(F.lit(1)).alias("n"),
        *(
            f(F.col("stats")[k]).alias(f"{name}{k}")
            for k in range(len(STATISTICS))
            for name, f in (("m", F.avg), ("s", F.stddev_pop))
        ),
    ).first()
    n = moments["n"]
    nothing = np.zeros(0)
    if not n:
        zero = np.zeros(len(STATISTICS))
        return Model(zero, zero + 1, np.zeros(count + 1), nothing, nothing, gamma)
    mean = np.array([moments[f"m{k}"] for k in range(len(STATISTICS))])
    scale = np.array([moments[f"s{k}"] for k in range(len(STATISTICS))])
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), np.zeros(count + 1), nothing, nothing, gamma)
    products, sums_ = _normal_sums(labelled, model, count)
    model.weights = np.linalg.solve(products + ridge * n * np.eye(count + 1), sums_)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = model.raw(np.array(batch.column(0).to_pylist(), float).reshape(-1, len(STATISTICS)))
            place = np.clip((raw + 0.5) / 2 * BINS, 0, BINS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(place), batch.column(1)], ["bin", "label"])

    bins = (
        labelled.mapInArrow(binned, "bin long, label double")
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("mean"))
        .orderBy("bin")
        .toPandas()
    )
    model.points = (bins["bin"].to_numpy() + 0.5) / BINS * 2 - 0.5
    model.values = pooled(bins["n"].to_numpy(float), bins["mean"].to_numpy(float)).clip(0, 1)
    return model


def scored(text: Column, model: Model) -> Column:
    """Calibrated score of a text column."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score([None if t is None else str(t) for t in texts]))

    return score(text)


def classify(stats: DataFrame, model: Model) -> DataFrame:
    """Score and decision for every document, from its statistics."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy().reshape(-1, len(STATISTICS))
            score = model.calibrated(model.raw(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["doc_id", "score"])

    rows = stats.mapInArrow(run, "doc_id long, score double")
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
