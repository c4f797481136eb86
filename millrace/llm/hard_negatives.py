"""Hard negatives for contrastive training, found by an inverted multi-index.

Two codebooks, one for each half of a vector, form cells: a row lies in the cell of its two nearest codewords.
For an anchor, a codeword's half score is its product with the anchor's half plus the half's length times the
codeword's radius, so the sum of two half scores bounds the score of every row in the cell. A heap visits the
cells in descending order of that sum (the multi-sequence walk) and stops on a certificate: no cell that is left
can hold a row that belongs into the answer, ties included. The answer is exact.

Rows are dealt into shards by a hash of ``vec_id``, so no label, cell or copy makes a shard larger than others,
and anchors into blocks; a task holds one shard with its inverted lists and one block of anchors. A first pass
finds each anchor's best rows of its label; a second one takes the score windows that follow from these and
finds the best rows of other labels in each. What the shards found is merged by rank. Anchors are a stated share
of all rows, so the work grows with the product of both; the index prunes it as far as the cells are tight.

Rows whose ``vec_id``, label or vector is null, or that hold a null or non-finite component, take no part, and
neither do rows whose squared length is 2^62 or more, since scores would leave the range of a long. Scores exist
only between vectors of one length. Of rows that repeat a ``vec_id`` the one with the least label and vector
takes part. Equal vectors are separate rows. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import stored, table

SAMPLE, CODEWORDS, ROUNDS = 20_000, 8, 8  # sampled rows that fit the codebooks, codewords of a half, k-means rounds
SHARD_VALUES, BLOCK_VALUES = 1 << 20, 1 << 21  # components of a shard and of a block of anchors


def codebook(half: np.ndarray, words: int) -> np.ndarray:
    """Codewords of one half of the sampled vectors, by k-means from rows in a fixed order."""
    words = min(words, len(half))
    centres = half[np.linspace(0, len(half) - 1, words).astype(int)].astype(float)
    for _ in range(ROUNDS):
        home = _nearest(centres, half)
        sums, sizes = np.zeros_like(centres), np.bincount(home, minlength=words)
        np.add.at(sums, home, half)
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def _nearest(centres: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1)[None, :] - 2 * rows @ centres.T).argmin(axis=1)


def descending_cells(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(sum, i, j) for all pairs of the two halves' scores, largest sum first, by a heap over both sorted lists."""
    p, q = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    heap = [(-(first[p[0]] + second[q[0]]), 0, 0)]
    while heap:
        total, i, j = heapq.heappop(heap)
        yield -total, int(p[i]), int(q[j])
        if j + 1 < len(q):
            heapq.heappush(heap, (-(first[p[i]] + second[q[j + 1]]), i, j + 1))
        if j == 0 and i + 1 < len(p):
            heapq.heappush(heap, (-(first[p[i + 1]] + second[q[0]]), i + 1, 0))


class MultiIndex:
    """The inverted lists of one shard. Components are whole numbers; products are exact."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, books: tuple[np.ndarray, np.ndarray] | None):
        self.cut = vectors.shape[1] // 2
        halves = [vectors[:, :self.cut].astype(float), vectors[:, self.cut:].astype(float)]
        self.books = books or tuple(np.zeros((1, h.shape[1])) for h in halves)  # without a codebook: one cell
        codes = [_nearest(b, h) for b, h in zip(self.books, halves)]
        apart = [np.sqrt(((h - b[c]) ** 2).sum(axis=1)) for b, h, c in zip(self.books, halves, codes)]
        self.radii = [np.zeros(len(b)) for b in self.books]
        for radius, code, far in zip(self.radii, codes, apart):
            np.maximum.at(radius, code, far)
        cell = codes[0] * len(self.books[1]) + codes[1]
        order = np.lexsort((ids, cell))
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        self.starts = np.searchsorted(cell[order], np.arange(len(self.books[0]) * len(self.books[1]) + 1))
        self.longest = float(np.sqrt((vectors.astype(float) ** 2).sum(axis=1).max(initial=0)))
        self.real = self.vectors.astype(float)

    def visited(self, anchor: np.ndarray, least: list[float]) -> Iterator[tuple[slice, np.ndarray]]:
        """(rows, exact scores) of non-empty cells in the order of their bounds, until the bound is below ``least[0]``,
        which the caller raises while it finds better rows."""
        real = anchor.astype(float)
        length = [float(np.sqrt((h * h).sum())) for h in (real[:self.cut], real[self.cut:])]
        halves = [b @ h + n * r for b, h, n, r in zip(self.books, (real[:self.cut], real[self.cut:]), length, self.radii)]
        slack = 1e-9 * (1 + self.longest * math.hypot(*length))  # rounding of the bounds
        exact = self.longest * math.hypot(*length) < 2 ** 53
        for bound, i, j in descending_cells(*halves):
            if bound + slack < least[0]:
                return
            cell = i * len(self.books[1]) + j
            rows = slice(int(self.starts[cell]), int(self.starts[cell + 1]))
            if rows.start < rows.stop:
                yield rows, (self.real[rows] @ real).astype(np.int64) if exact else self.vectors[rows] @ anchor

    def best_of_label(self, anchor: np.ndarray, label: int, own: int, count: int) -> list[tuple[int, int]]:
        """(score, id) of the ``count`` best other rows with the label, best first, ties by smaller id."""
        found: list[tuple[int, int]] = []
        least = [-math.inf]
        for rows, scores in self.visited(anchor, least):
            fit = (self.labels[rows] == label) & (self.ids[rows] != own)
            if len(found) == count:
                fit &= scores >= -found[-1][0]
            found = sorted(found + list(zip((-scores[fit]).tolist(), self.ids[rows][fit].tolist())))[:count]
            if len(found) == count:
                least[0] = -found[-1][0]
        return [(-s, i) for s, i in found]

    def best_in_windows(self, anchor: np.ndarray, label: int, windows: list[tuple[int, int]], count: int) -> list[list[tuple[int, int]]]:
        """For each window of scores, both ends included, the ``count`` best rows of other labels in it."""
        found: list[list[tuple[int, int]]] = [[] for _ in windows]
        needs = [low for low, _ in windows]
        least = [min(needs, default=math.inf)]
        top = max((high for _, high in windows), default=0)
        for rows, scores in self.visited(anchor, least):
            fit = (self.labels[rows] != label) & (scores >= least[0]) & (scores <= top)
            if not fit.any():
                continue
            here, ids = scores[fit], self.ids[rows][fit]
            for w, (low, high) in enumerate(windows):
                inside = (here >= max(low, needs[w])) & (here <= high)
                if inside.any():
                    found[w] = sorted(found[w] + list(zip((-here[inside]).tolist(), ids[inside].tolist())))[:count]
                    if len(found[w]) == count:
                        needs[w] = -found[w][-1][0]
            least[0] = min(needs)
        return [[(-s, i) for s, i in part] for part in found]


def _matrix(rows: pa.Table, name: str, dims: int) -> np.ndarray:
    return rows.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(rows), dims)


def _searching(books, search, names: list[str], types: list[pa.DataType]):
    """For cogroups of one shard's rows and one block of anchors: whatever ``search`` gives for each anchor."""
    def run(key, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if len(rows) and len(anchors):
            dims = key[0].as_py()
            fitting = books if books is not None and books[0].shape[1] + books[1].shape[1] == dims else None
            index = MultiIndex(rows.column("list_vec_id").to_numpy(), rows.column("list_label").to_numpy(),
                               _matrix(rows, "list_vector", dims), fitting)
            rest = [anchors.column(n).to_pylist() for n in ("vec_id", "label", "targets")]
            for vector, anchor, label, targets in zip(_matrix(anchors, "vector", dims), *rest):
                found += search(index, vector, anchor, label, targets)
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*found) if found else [[]] * len(types), types)], names=names)
    return run


def _best(found: DataFrame, keys: list[str], score: str, tie: str, count: int) -> DataFrame:
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(score), tie))
    return found.withColumn("rank", ranked).where(F.col("rank") <= count)


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3,
                   low: int = 50, high: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` have vec_id, label and a ``vector`` of whole numbers. An anchor's positives are its best other rows of its
    label; a positive's negatives are the best rows of other labels whose score lies between ``low`` and ``high``
    hundredths of the positive's.
    """
    spark = rows.sparkSession
    length = F.aggregate(F.col("vector"), F.lit(0.0), lambda a, e: a + e.cast("double") * e.cast("double"))
    taken = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
                       & F.forall("vector", lambda e: e.isNotNull()) & (length < float(2 ** 62)))
    whole = stored(taken.groupBy("vec_id").agg(F.min(F.struct("label", F.col("vector").cast("array<long>").alias("vector"))).alias("r"))
                   .select(F.col("vec_id").cast("long"), F.col("r.label").cast("long").alias("label"), "r.vector",
                           F.size("r.vector").alias("dims")), "negatives-rows")
    n, values, anchor_values = (v or 0 for v in whole.agg(
        F.count(F.lit(1)), F.sum("dims"), F.sum(F.when(is_anchor, F.col("dims")))).first())
    shards, blocks = max(1, math.ceil(values / SHARD_VALUES)), max(1, math.ceil(anchor_values / BLOCK_VALUES))
    usual = whole.groupBy("dims").count().orderBy(F.desc("count"), "dims").limit(1).collect()
    share = min(1.0, SAMPLE / max(n, 1))
    sample = (whole.where(F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000)) < int(share * 1_000_000) + 1)
              .where(F.col("dims") == (usual[0]["dims"] if usual else 0)).select("vec_id", "vector").toPandas().sort_values("vec_id"))
    books = None
    if len(sample):
        drawn = np.stack(sample["vector"].to_numpy()).astype(float)
        cut = drawn.shape[1] // 2
        books = codebook(drawn[:, :cut], CODEWORDS), codebook(drawn[:, cut:], CODEWORDS)

    lists = whole.select(
        F.col("dims").alias("list_dims"), F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("list_shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("list_block"),
        *[F.col(c).alias(f"list_{c}") for c in ("vec_id", "label", "vector")])
    anchors = whole.where(is_anchor).withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int"))
    key = ["dims", "shard", "block"]

    def over_shards(asked: DataFrame, search, schema: str) -> DataFrame:
        names = [c.split()[0] for c in schema.split(", ")]
        met = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        return lists.groupBy(*[f"list_{k}" for k in key]).cogroup(met.groupBy(*key)).applyInArrow(
            _searching(books, search, names, [pa.int64()] * len(names)), schema)

    def nearest(index, vector, anchor, label, targets):
        return [(anchor, i, s) for s, i in index.best_of_label(vector, label, anchor, positives)]

    def in_windows(index, vector, anchor, label, targets):
        ends = [(-(-low * t["score"] // 100), high * t["score"] // 100) for t in targets]
        wanted = [(t, e) for t, e in zip(targets, ends) if e[0] <= e[1]]
        found = index.best_in_windows(vector, label, [e for _, e in wanted], negatives)
        return [(anchor, t["positive_id"], t["score"], i, s) for (t, _), part in zip(wanted, found) for s, i in part]

    near = over_shards(anchors.withColumn("targets", F.lit(None).cast("long")), nearest, "anchor_id long, positive_id long, score long")
    close = stored(_best(near, ["anchor_id"], "score", "positive_id", positives), "negatives-positives")
    targets = close.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct("positive_id", "score")).alias("targets"))
    far = over_shards(anchors.join(targets, "vec_id"), in_windows,
                      "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    return _best(far, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows whose vec_id is divisible by 50; every seventh row has the next label, as noise."""
    sound = F.forall("embedding", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = table(spark, sf_dir, "embeddings").where(sound).select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        F.transform("embedding", lambda e: F.floor(e.cast("double") * 256)).alias("vector"))
    return hard_negatives(rows, F.col("vec_id") % 50 == 0)


OP11_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda e: floor(256 * e::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
  FROM rows AS a JOIN rows AS b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
