"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration.

A text becomes sixteen statistics; random Fourier features of the standardised statistics approximate
a Gaussian kernel; each partition sums its normal equations, and the sums give the ridge weights; the
ridge scores of the training rows, counted in bins, are calibrated by pooling adjacent violators.

Null and empty texts have all statistics zero and get a score like any text. Rows without a label
only get a score. Rows that repeat a ``doc_id`` are scored each; a label that repeats counts as
often. Without any labelled row the score is 0.5. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import slices, stored, table

STATISTICS = 16
FEATURES, WIDTH, RIDGE, BINS = 256, 2.0, 1e-4, 2000


def text_statistics(text: str) -> list[float]:
    """Statistics of one whole text: sizes, shares of kinds of characters, repetition of words and lines."""
    words = text.split()
    if not words:
        return [0.0] * STATISTICS
    n, size = len(words), len(text)
    lines = [x for x in text.split("\n") if x.strip()]
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    letters = sum(map(len, words))
    plain = text.encode("utf-8", "replace")
    upper = len(plain.translate(None, bytes(set(range(256)) - set(range(65, 91)))))
    lower = len(plain.translate(None, bytes(set(range(256)) - set(range(97, 123)))))
    digits = len(plain.translate(None, bytes(set(range(256)) - set(range(48, 58)))))
    stops, marks = plain.count(b".") + plain.count(b",") + plain.count(b"?"), plain.count(b"!")
    signs = sum(plain.count(bytes([c])) for c in b"|<>{}[]#$%&*=_~^\\/@+;:")
    lengths = [len(x) for x in lines]
    return [math.log1p(n), letters / n, len(counts) / n, max(counts.values()) / n, repeats / n,
            upper / size, lower / size, digits / size, stops / n, marks / n, signs / n,
            sum(len(w) == 1 for w in words) / n, len(set(lines)) / len(lines),
            math.log1p(sum(lengths) / len(lines)), math.log1p(max(lengths)) - math.log1p(min(lengths)),
            sum(w[0].isupper() for w in words) / n]


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, length in slices(batch.column(1)):
            part = batch.slice(start, length)
            rows = np.array([text_statistics(t or "") for t in part.column(1).to_pylist()], dtype=np.float64)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * STATISTICS, pa.int32()),
                                                          pa.array(rows.reshape(-1)))], names=["doc_id", "x"])


def fourier(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Features whose products approximate exp(-distance² / 2 WIDTH²), and a constant."""
    draw = np.random.default_rng(5)
    frequency = draw.normal(0, 1 / WIDTH, (STATISTICS, FEATURES))
    phase = draw.uniform(0, 2 * np.pi, FEATURES)
    z = np.clip((x - mean) / scale, -6, 6)
    return np.c_[np.sqrt(2 / FEATURES) * np.cos(z @ frequency + phase), np.ones(len(z))]


def pooled(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to ``values`` in weighted squares."""
    blocks: list[list[float]] = []
    for v, w in zip(values, weights):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v1, w1, n1 = blocks.pop()
            v0, w0, n0 = blocks.pop()
            blocks.append([(v0 * w0 + v1 * w1) / (w0 + w1), w0 + w1, n0 + n1])
    return np.repeat([b[0] for b in blocks], [b[2] for b in blocks])


def _matrix(column) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.empty((0, STATISTICS))


def quality_scores(docs: DataFrame, labels: DataFrame, train: str = "true", threshold: float = 0.3) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. ``labels`` has doc_id and quality;
    ``train`` is a condition on doc_id that says which rows may be learned from."""
    facts = stored(docs.select("doc_id", "text").mapInArrow(_statistics, "doc_id long, x array<double>"), "statistics")
    known = stored(facts.join(labels.where(train).where("quality IS NOT NULL").select("doc_id", F.col("quality").cast("double").alias("y")),
                              "doc_id").select("x", "y"), "known")
    sums = known.agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(STATISTICS)],
                     *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(STATISTICS)]).first()
    held_out = F.coalesce(~F.expr(train), F.lit(False)).alias("held_out")
    if not sums["n"]:
        return facts.select("doc_id", held_out, F.lit(0.5).alias("score"), F.lit(int(0.5 >= threshold)).alias("predicted"))
    mean = np.array([sums[f"m{i}"] for i in range(STATISTICS)])
    scale = np.array([sums[f"s{i}"] or 1.0 for i in range(STATISTICS)])
    weights = _ridge(known, mean, scale)

    def raw(batches):
        for frame in batches:
            yield frame.drop(columns="x").assign(raw=fourier(_matrix(frame["x"]), mean, scale) @ weights)

    low, high = -0.5, 1.5
    place = F.least(F.greatest(F.floor((F.col("raw") - low) / (high - low) * BINS), F.lit(0)), F.lit(BINS - 1)).cast("int")
    bins = (known.mapInPandas(raw, "y double, raw double").groupBy(place.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("y")).orderBy("bin").collect())  # at most BINS rows
    steps = pooled(np.array([b["y"] for b in bins]), np.array([float(b["n"]) for b in bins]))
    edges = np.array([low + (b["bin"] + 0.5) * (high - low) / BINS for b in bins])

    def calibrated(batches):
        for frame in raw(batches):
            yield frame.assign(score=np.interp(frame["raw"], edges, steps)).drop(columns="raw")

    scored = facts.mapInPandas(calibrated, "doc_id long, score double")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def _ridge(known: DataFrame, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Weights from normal equations that each partition sums; groups of partitions are summed by tasks,
    so the driver adds up at most the square root of the number of partitions."""
    groups = math.isqrt(max(1, known.rdd.getNumPartitions() - 1)) + 1
    size = FEATURES + 1

    def gram(batches):
        import pandas as pd
        from pyspark import TaskContext
        total = np.zeros((size, size + 1))
        for frame in batches:
            z = fourier(_matrix(frame["x"]), mean, scale)
            total += z.T @ np.c_[z, frame["y"].to_numpy()]
        yield pd.DataFrame({"slot": [TaskContext.get().partitionId() % groups], "total": [total.tobytes()]})

    def add(frame):
        import pandas as pd
        total = sum(np.frombuffer(b) for b in frame["total"])
        return pd.DataFrame({"slot": frame["slot"][:1], "total": [total.tobytes()]})

    summed = known.mapInPandas(gram, "slot int, total binary").groupBy("slot").applyInPandas(add, "slot int, total binary")
    total = np.zeros((size, size + 1))
    for row in summed.toLocalIterator():
        total += np.frombuffer(row["total"]).reshape(size, size + 1)
    n = total[size - 1, size - 1]  # the constant times itself counts the rows
    penalty = np.eye(size) * RIDGE * n
    penalty[-1, -1] = 0
    return np.linalg.solve(total[:, :size] + penalty, total[:, size])


TRAIN = "crc32(cast(cast(doc_id AS string) AS binary)) % 5 != 0"


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), TRAIN, 0.3)
