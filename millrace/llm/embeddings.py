"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, one representative per group.

Equal vectors form one class. Cells come from spherical k-means on a bounded sample. A class is at home
in its nearest cell and a guest in each cell whose boundary is within half the linking distance: of two
vectors that link across a boundary at least one is that near to it, so every link is met in the home
cell of one of them and none is lost. Cells are compared in blocks of bounded size; a block returns one
row per class with its number of links and its local component, never pairs.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of
different lengths never link. Such a row is its own component. A row without ``vec_id`` links with
nothing and is kept. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import components, lookup, stored, table, with_group_facts

SAMPLE, CELL, CELLS, ROUNDS = 20_000, 512, 4096, 8  # sampled vectors, vectors a cell, most cells, k-means rounds
BLOCK, SLICE = 1024, 256  # vectors of one side of a block, vectors compared with all centres at a time


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # no overflow in the squares
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def spherical_centres(sample: np.ndarray, cells: int) -> np.ndarray:
    """Unit centres of ``cells`` cells, from sampled unit vectors in a fixed order."""
    centres = sample[np.linspace(0, len(sample) - 1, cells).astype(int)].copy()
    for _ in range(ROUNDS):
        home = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, sample)
        size = np.sqrt((sums * sums).sum(axis=1))
        centres[size > 1e-9] = sums[size > 1e-9] / size[size > 1e-9, None]
    return centres


def _assigned(centres: np.ndarray, reach: float):
    """Adds home cell and guest cells; vectors of another length share one cell of their own."""
    apart = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 1e-12)) if len(centres) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2)
            size = np.diff(np.asarray(vectors.offsets))
            home, guests = -1 - size.astype(np.int64), [[] for _ in range(len(size))]
            usual = np.flatnonzero(size == centres.shape[1])
            for first in range(0, len(usual), SLICE):  # products with all centres for some hundred vectors at a time
                part = usual[first:first + SLICE]
                near = _unit(np.stack([vectors[i].values.to_numpy() for i in part.tolist()]).astype(np.float64)) @ centres.T
                best = near.argmax(axis=1)
                home[part] = best
                gap = near[np.arange(len(best)), best][:, None] - near
                gap /= apart[best]
                gap[np.arange(len(best)), best] = np.inf
                for i, row in zip(part.tolist(), gap <= reach):
                    guests[i] = np.flatnonzero(row).tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), vectors, pa.array(home, pa.int32()),
                                              pa.array(guests, pa.list_(pa.int32()))],
                                             names=["rep", "copies", "vector", "home", "guests"])
    return run


def _blocks(placed: DataFrame) -> DataFrame:
    """A row for each block pair that a vector takes part in: cell, kind, i, j, side. There is a cell for each centre
    and one for each other length of vectors."""
    cells = placed.select("rep", "copies", "vector", "home", "guests", F.posexplode(F.concat(F.array("home"), "guests")).alias("p", "cell"))
    many = [F.ceil(F.count_if(c) / BLOCK).cast("int") for c in (F.col("p") == 0, F.col("p") > 0)]
    sizes = stored(cells.groupBy("cell").agg(many[0].alias("own"), many[1].alias("other")), "sizes")
    own, other = F.col("own"), F.col("other")
    few = sizes.count() <= 2 * CELLS  # unless vectors have very many lengths
    sized = cells.join(F.broadcast(sizes), "cell") if few else lookup(cells, ["cell"], sizes, ["rep"])
    rows = sized.withColumn(
        "b", F.pmod(F.xxhash64("rep"), F.greatest(F.when(F.col("p") == 0, own).otherwise(other), F.lit(1))).cast("int"))
    at_home = """concat(
        transform(sequence(b, own - 1), x -> named_struct('kind', 'own', 'i', b, 'j', x, 'left', true)),
        IF(b > 0, transform(sequence(0, b - 1), x -> named_struct('kind', 'own', 'i', x, 'j', b, 'left', false)), array()),
        IF(other > 0, transform(sequence(0, other - 1), x -> named_struct('kind', 'guest', 'i', b, 'j', x, 'left', true)), array()))"""
    visiting = """IF(own > 0, transform(sequence(0, own - 1), x -> named_struct('kind', 'guest', 'i', x, 'j', b, 'left', false)), array())"""
    return rows.select("cell", "rep", "copies", "vector", "home", "guests",
                       F.explode(F.expr(f"IF(p = 0, {at_home}, {visiting})")).alias("e")).select(
        "cell", "e.*", "rep", "copies", "vector", "home", "guests")


def _compared(least: float):
    def run(frame):
        import pandas as pd
        kind, i, j = frame["kind"].iloc[0], frame["i"].iloc[0], frame["j"].iloc[0]
        left = frame[frame["left"]]
        right = left if kind == "own" and i == j else frame[~frame["left"]]
        if not len(left) or not len(right):
            return pd.DataFrame({"rep": [], "links": [], "least": []}).astype("int64")
        a, b = (_unit(np.stack(side["vector"].to_numpy()).astype(np.float64)) for side in (left, right))
        linked = a @ b.T >= least
        if right is left:
            np.fill_diagonal(linked, False)
        x, y = np.nonzero(linked)
        if kind == "guest":  # a pair met in two cells counts in the smaller one
            visits = np.zeros(len(left), dtype=object)
            visits[:] = [frozenset(g.tolist()) for g in left["guests"]]
            home, cell = right["home"].to_numpy(), frame["cell"].iloc[0]
            keep = np.array([home[q] not in visits[p] or cell < home[q] for p, q in zip(x.tolist(), y.tolist())], dtype=bool)
            x, y = (x[keep], y[keep]) if len(x) else (x, y)
        ids_l, ids_r = left["rep"].to_numpy(), right["rep"].to_numpy()
        links_l = np.bincount(x, weights=right["copies"].to_numpy()[y], minlength=len(left))
        links_r = np.bincount(y, weights=left["copies"].to_numpy()[x], minlength=len(right))
        low_l, low_r = ids_l.copy(), ids_r.copy()
        while len(x):  # smallest id reachable inside the block
            before = low_l.sum() + low_r.sum() if right is not left else low_l.sum()
            np.minimum.at(low_l, x, low_r[y] if right is not left else low_l[y])
            np.minimum.at(low_l if right is left else low_r, y, low_l[x])
            if before == (low_l.sum() + low_r.sum() if right is not left else low_l.sum()):
                break
        found = pd.DataFrame({"rep": ids_l, "links": links_l.astype(np.int64), "least": low_l})
        if right is not left:
            found = pd.concat([found, pd.DataFrame({"rep": ids_r, "links": links_r.astype(np.int64), "least": low_r})])
        return found[found["links"] > 0]
    return run


def near_vectors(vectors: DataFrame, least: float = 0.95) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    sound = (F.size("vector") > 0) & F.forall("vector", lambda e: e.isNotNull() & (F.abs(e) < float("inf"))) & F.exists(
        "vector", lambda e: e != 0) & F.col("vec_id").isNotNull()
    checked = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    valid = stored(checked.where("sound").select("vec_id", "vector"), "vectors")
    tagged = with_group_facts(valid, ["vector"], {"rep": F.min("vec_id"), "copies": F.count(F.lit(1))}, ["vec_id"])
    tagged = stored(tagged.select("vec_id", "rep", "copies"), "tagged")
    classes = stored(valid.groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
                     .select("rep", "copies", "vector"), "classes")
    n = classes.count()
    usual = classes.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    share = min(1.0, SAMPLE / max(n, 1))
    sample = (classes.where(F.pmod(F.xxhash64("rep"), F.lit(1_000_000)) < int(share * 1_000_000) + 1)
              .where(F.size("vector") == (usual[0]["size"] if usual else 0)).select("rep", "vector").toPandas().sort_values("rep"))
    cells = min(CELLS, math.ceil(n / CELL), len(sample))
    centres = (spherical_centres(_unit(np.stack(sample["vector"].to_numpy()).astype(np.float64)), cells) if cells
               else np.empty((0, 0)))
    placed = stored(classes.mapInArrow(_assigned(centres, math.sqrt(max(2 - 2 * least, 0)) / 2 + 1e-9),
                                       "rep long, copies long, vector array<double>, home int, guests array<int>"), "placed")
    met = stored(_blocks(placed).groupBy("cell", "kind", "i", "j").applyInPandas(
        _compared(least), "rep long, links long, least long"), "met")
    links = met.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(met.where("rep != least").select("rep", "least"), "rep", "least", "vectors").withColumnRenamed("node", "rep")
    facts = stored(links.join(joined, "rep", "left"), "facts")
    named = lookup(tagged, ["rep"], facts, ["vec_id"], "left").select(
        "vec_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"))
    alone = checked.where("NOT sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return named.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
