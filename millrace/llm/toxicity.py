"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

The features of a text are the hashed n-grams that occur in its words, with marks for the ends of a
word, and once more those that occur in every ``DENSE``-th word or more often. Each is scaled by the
log ratio of its counts in toxic and other training texts; those whose ratio is significant enter a
logistic regression. It is fitted on a bounded sample of labelled rows
(``SAMPLE`` by a hash of doc_id); scores cover all whole texts.

Null and empty texts have no features and get the score of the constant. Rows without a label only get a
score; labels that contradict each other for a ``doc_id`` count as toxic. Without labelled rows of both kinds
the score is their share of toxic ones, 0 if there are none. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import slices, stored, table, word_codes

SAMPLE = 20_000  # labelled rows to learn from, expected
LENGTHS, GRAMS, DENSE = (3, 4, 5, 6), 1 << 20, 200  # n-grams, their hashes, words for each occurrence
BUCKETS = 2 * GRAMS  # a hash twice: there at all, dense
FEATURES, LEAST_TEXTS, SIGNIFICANCE, ROUNDS, PENALTY = 4096, 3, 4.0, 40, 1.0


def word_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all words in a row and how many each word has."""
    marked = [f"\x02{w.lower()}\x03" for w in words]  # a word may hold such characters itself: ends follow from lengths
    points = np.frombuffer("".join(marked).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    ends = np.cumsum(np.fromiter(map(len, marked), np.int64, len(marked))) - 1
    starts = np.r_[0, ends[:-1] + 1] if len(ends) else ends
    left = np.repeat(ends, ends - starts + 1) - np.arange(len(points)) + 1  # characters to the word's end
    word = np.repeat(np.arange(len(words)), ends - starts + 1)
    grams, owners = [], []
    for n in LENGTHS:
        total = np.full(max(len(points) - n + 1, 0), n, np.uint64)
        for k in range(n):
            total = (total + points[k:len(points) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            total ^= total >> np.uint64(29)
        keep = left[:len(total)] >= n
        grams.append((total[keep] >> np.uint64(40)).astype(np.int64) % GRAMS)
        owners.append(word[:len(total)][keep])
    gram, owner = np.concatenate(grams), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return gram[order], np.bincount(owner, minlength=len(words))


def text_features(texts: pa.Array, wanted: np.ndarray | None = None) -> list[np.ndarray]:
    """Distinct features of each text, or with ``wanted`` (position by feature, -1 for none) their positions."""
    distinct, codes, bounds = word_codes(texts)
    gram, each = word_grams(distinct.to_pylist())
    if wanted is not None:
        keep = (wanted[2 * gram] >= 0) | (wanted[2 * gram + 1] >= 0)
        each = np.bincount(np.repeat(np.arange(len(each)), each)[keep], minlength=len(each))
        gram = gram[keep]
    starts = np.r_[0, np.cumsum(each)]
    found = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        used, times = np.unique(codes[a:b], return_counts=True)
        used, times = used[each[used] > 0], times[each[used] > 0]
        size = each[used]
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[used] - (ends - size), size)
        there, inverse = np.unique(gram[at], return_inverse=True)
        dense = np.bincount(inverse, weights=np.repeat(times, size), minlength=len(there)) * DENSE >= b - a
        features = np.r_[2 * there, 2 * there[dense] + 1]
        if wanted is not None:
            features = wanted[features]
            features = features[features >= 0]
        found.append(features)
    return found


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        for start, length in slices(batch.column(0)):
            part = batch.slice(start, length)
            for y, grams in zip(part.column(1).to_pylist(), text_features(part.column(0))):
                counts[y][grams] += 1
    used = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[0][used]), pa.array(counts[1][used])], names=["gram", "clean", "toxic"])


def fit_linear(rows: list[np.ndarray], y: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and constant of a logistic regression on features of the size of their ratios, by Newton steps
    whose directions come from conjugate gradients."""
    size = np.array([len(r) for r in rows])
    row, col = np.repeat(np.arange(len(rows)), size), np.concatenate(rows).astype(np.int64) if len(rows) else np.empty(0, np.int64)
    value, n = ratios[col], len(ratios)

    def ahead(w):
        return np.bincount(row, weights=value * w[col], minlength=len(rows)) + w[n]

    def back(v):
        return np.r_[np.bincount(col, weights=value * v[row], minlength=n), v.sum()]

    w = np.zeros(n + 1)
    penalty = np.full(n + 1, PENALTY)
    penalty[n] = 0
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(ahead(w), -30, 30)))
        slope = back(p - y) + penalty * w
        if np.abs(slope).max() < 1e-4 * len(rows):
            break
        curve = np.maximum(p * (1 - p), 1e-6)
        step, residual = np.zeros(n + 1), -slope
        direction, power = residual.copy(), residual @ residual
        for _ in range(60):
            turned = back(curve * ahead(direction)) + penalty * direction + 1e-9 * direction
            size_of = power / (direction @ turned)
            step += size_of * direction
            residual -= size_of * turned
            new = residual @ residual
            if new < 1e-10 * max(1.0, slope @ slope):
                break
            direction, power = residual + new / power * direction, new
        w += step
    return w[:n], float(w[n])


def toxicity_scores(docs: DataFrame, labels: DataFrame, train: str = "true", threshold: float = 0.7) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. ``labels`` has doc_id and toxic; ``train``
    is a condition on doc_id that says which rows may be learned from."""
    spark = docs.sparkSession
    held_out = F.coalesce(~F.expr(train), F.lit(False)).alias("held_out")
    known = labels.where(train).where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    n = known.count()
    share = int(min(1.0, SAMPLE / max(n, 1)) * 1_000_000)
    sample = spark.createDataFrame(known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share).collect(), "doc_id long, y int")
    texts = stored(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "y"), "labelled")
    by_class = {r["y"]: r["n"] for r in texts.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean, toxic = by_class.get(0, 0), by_class.get(1, 0)
    if not clean or not toxic:
        score = toxic / max(clean + toxic, 1)
        return docs.select("doc_id", held_out, F.lit(float(score)).alias("score"), F.lit(int(score >= threshold)).alias("predicted"))
    counts = texts.mapInArrow(_counted, "gram long, clean long, toxic long").groupBy("gram").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    p, q = (F.col("toxic") + 1) / (toxic + 2), (F.col("clean") + 1) / (clean + 2)
    ratio = F.log(p / q)
    weight = F.abs(ratio) / F.sqrt(1 / (F.col("toxic") + 1) + 1 / (F.col("clean") + 1))
    chosen = (counts.where(F.col("toxic") + F.col("clean") >= LEAST_TEXTS).select("gram", ratio.alias("ratio"), weight.alias("weight"))
              .where(F.col("weight") >= SIGNIFICANCE)
              .orderBy(F.desc("weight"), "gram").limit(FEATURES).collect())
    wanted = np.full(BUCKETS, -1, np.int32)
    wanted[[r["gram"] for r in chosen]] = np.arange(len(chosen))
    ratios = np.array([r["ratio"] for r in chosen])
    holder = spark.sparkContext.broadcast(wanted)

    def featured(batches):
        for batch in batches:
            for start, length in slices(batch.column(0)):
                part = batch.slice(start, length)
                lists = pa.array(text_features(part.column(0), holder.value), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(1), lists], names=["y", "features"])

    rows = texts.mapInArrow(featured, "y int, features array<int>").toPandas()  # bounded by SAMPLE and FEATURES
    weights, constant = fit_linear(list(rows["features"]), rows["y"].to_numpy().astype(float), ratios)
    scaled = spark.sparkContext.broadcast(weights * ratios)

    def scored(batches):
        for batch in batches:
            for start, length in slices(batch.column(1)):
                part = batch.slice(start, length)
                sums = np.array([scaled.value[f].sum() for f in text_features(part.column(1), holder.value)]) + constant
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(1 / (1 + np.exp(-np.clip(sums, -500, 500))))], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(scored, "doc_id long, score double").select(
        "doc_id", held_out, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


TRAIN = "crc32(cast(cast(doc_id AS string) AS binary)) % 3 != 1"


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), TRAIN, 0.7)
