"""Near duplicates by circulant MinHash, banding and exact Jaccard verification.

The first permutation places a shingle on a circle, the second is a table around it; coordinate
k of the signature is the least table value seen from the shingles' places shifted by k. Texts with
equal shingle sets form one class, found by a 128-bit digest of the set. Classes that share a band
are candidates: first each is compared with the most central class of its bucket, the one that meets
most others in its 24 buckets. A bucket of three or more members that are not one component yet is open, and
open buckets that overlap form a bundle; those of its members that are outside its main component are compared with
all of its members in blocks, as counts of common shingles by matrix products, so that no pairs are written out and nothing that
banding found is lost. Links are confirmed on the full sets of 64-bit shingle hashes.

Null or empty text has an empty set, links with nothing and keeps itself. A row without ``doc_id``
links with nothing and is kept. Rows that repeat a ``doc_id`` are one node. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import components, lookup, process_cache, slices, stored, table, with_group_facts, word_codes

BANDS, ROWS = 24, 5  # finds a pair of similarity 0.8 with probability 0.99993
CIRCLE = 1 << 21
BLOCK_TEXTS, BLOCK_SHINGLES, COLUMNS = 1024, 500_000, 8192  # bounds of one side of a block
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * ODD[0]
    x = (x ^ (x >> np.uint64(29))) * ODD[1]
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the word shingles of each text; fewer words are one shingle."""
    import xxhash
    distinct, codes, bounds = word_codes(texts)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))
    stream = np.r_[hashes[codes] if len(codes) else np.empty(0, np.uint64), np.zeros(words, np.uint64)]
    total = np.zeros(len(codes), np.uint64)
    for i in range(words):
        total = _mixed(total + stream[i:i + len(codes)] * ODD[i % 4])
    sets = []
    for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if end - start >= words:
            sets.append(np.unique(total[start:end - words + 1]))
        elif end > start:
            whole = np.array([end - start], np.uint64)
            for h in stream[start:end]:
                whole = _mixed(whole + h)
            sets.append(whole)
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """Least table value around the circle for each shift."""
    def second_permutation():
        around = np.random.default_rng(20240601).permutation(CIRCLE).astype(np.uint32)
        return np.r_[around, around[:1024]]

    views = np.lib.stride_tricks.sliding_window_view(process_cache("circle", second_permutation), coordinates)
    places = (_mixed(shingles) >> np.uint64(64 - CIRCLE.bit_length() + 1)).astype(np.int64)
    best = views[places[:2048]].min(axis=0)
    for at in range(2048, len(places), 2048):
        np.minimum(best, views[places[at:at + 2048]].min(axis=0), out=best)
    return best


def _long(x: np.ndarray) -> np.ndarray:
    return np.asarray(x, dtype=np.uint64).view(np.int64)


SIGNATURE = ("doc_id long, n_shingles long, digest_a long, digest_b long, "
             "bands array<long>")


def _signatures(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, length in slices(batch.column(1)):
                part = batch.slice(start, length)
                sets = shingle_sets(part.column(1), words)
                full = [i for i, s in enumerate(sets) if len(s)]
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                digest = np.zeros((2, len(sets)), np.uint64)
                bands, counts = np.empty((0, BANDS), np.uint64), np.zeros(len(sets), np.int64)
                if full:
                    signed = np.stack([signature(sets[i], BANDS * ROWS) for i in full]).astype(np.uint64)
                    bands = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(full), BANDS)).copy()
                    for r in range(ROWS):
                        bands = _mixed(bands + signed[:, r::ROWS])
                    counts[full] = BANDS
                    for i in full:
                        digest[0, i] = _mixed(sets[i]).sum(dtype=np.uint64)
                        digest[1, i] = _mixed(sets[i] * ODD[3] + ODD[2]).sum(dtype=np.uint64) ^ np.uint64(len(sets[i]))
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()),
                                                 pa.array(_long(bands.reshape(-1))))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes), pa.array(_long(digest[0])), pa.array(_long(digest[1])), lists],
                    names=["doc_id", "n_shingles", "digest_a", "digest_b", "bands"])
    return run


def _full_sets(sets_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, length in slices(batch.column(1)):
                part = batch.slice(start, length)
                sets = sets_of(part.column(1))
                bounds = np.r_[0, np.cumsum([len(s) for s in sets])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(_long(np.concatenate(sets))))],
                    names=["id", "shingles"])
    return run


def _sets_of(ids: DataFrame, docs: DataFrame, sets_of) -> DataFrame:
    return stored(docs.select("doc_id", "text").join(ids.hint("shuffle_hash"), "doc_id", "left_semi")
                  .mapInArrow(_full_sets(sets_of), "id long, shingles array<long>"), "sets")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b), those whose full sets are similar enough. ``b`` may be one text for very many pairs."""
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a")), "a")
    both = lookup(left, ["b"], sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b")), ["a"])
    common = F.size(F.array_intersect("set_a", "set_b"))
    return both.where(common * 100 >= (F.size("set_a") + F.size("set_b") - common) * percent).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable), kept."""
    docs = docs.select("doc_id", "text")
    signed = stored(docs.mapInArrow(_signatures(words), SIGNATURE), "signatures")
    return linked_by_bands(docs, signed, lambda texts: shingle_sets(texts, words), percent)


def linked_by_bands(docs: DataFrame, signed: DataFrame, sets_of: Callable[[pa.Array], list[np.ndarray]], percent: int) -> DataFrame:
    """Groups of near duplicates from stored signatures; ``sets_of`` gives the sorted shingle sets of texts."""
    linkable = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stored(with_group_facts(linkable, ["digest_a", "digest_b"], {"rep": F.min("doc_id")}, ["doc_id"]), "classes")
    reps = classes.where("doc_id = rep").select("rep", "n_shingles", "bands")
    shared = stored(with_group_facts(reps.select("rep", "n_shingles", F.explode("bands").alias("bucket")), ["bucket"],
                                     {"members": F.count(F.lit(1))}, ["rep"], having="members > 1"), "buckets")
    pairs = _stars(shared)
    near_size = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    sets = _sets_of(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), docs, sets_of)
    links = stored(confirmed(pairs.where(near_size), sets, percent), "links")
    found = stored(components(links, "a", "b", "near"), "components")
    rest = _open_members(_bundles(shared, found), found, sets, percent)
    if not rest.isEmpty():
        found = stored(components(links.unionByName(_block_links(rest, sets, percent)), "a", "b", "near"), "components")
    named = lookup(classes.select("doc_id", "digest_a", "digest_b", "rep", "n_shingles"), ["rep"],
                   found.withColumnRenamed("node", "rep"), ["doc_id"], "left")
    linked = named.select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    alone = signed.where("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _stars(shared: DataFrame) -> DataFrame:
    """Each member of a bucket with the bucket's most central one: (a, b, na, nb)."""
    central = shared.groupBy("rep").agg(F.sum("members").alias("met"))
    ranked = stored(shared.join(central, "rep"), "ranked")
    around = with_group_facts(ranked, ["bucket"], {"pivot": F.max(F.struct("met", (-F.col("rep")).alias("minus"), "n_shingles"))},
                              ["rep"])
    return stored(around.where("rep != -pivot.minus").select(
        F.col("rep").alias("a"), (-F.col("pivot.minus")).alias("b"), F.col("n_shingles").alias("na"),
        F.col("pivot.n_shingles").alias("nb")).distinct(), "pairs")


def _bundles(shared: DataFrame, found: DataFrame) -> DataFrame:
    """(rep, bundle) of the members of open buckets; buckets that overlap form a bundle.

    A bucket of two has been compared, and one whose members are one component hides no link. So texts that
    happen to share a band with one other text join nothing, however many they are.
    """
    labelled = stored(shared.select("rep", "bucket").join(found.withColumnRenamed("node", "rep"), "rep", "left")
                      .withColumn("component", F.coalesce("component", "rep")), "bucket-components")
    still_open = with_group_facts(labelled, ["bucket"], {
        "low": F.min("component"), "high": F.max("component"), "first": F.min("rep"), "members": F.count(F.lit(1))},
        ["rep"], having="low != high AND members > 2")
    edges = stored(still_open.select(F.col("rep").alias("a"), F.col("first").alias("b")).distinct(), "bucket-edges")
    return components(edges, "a", "b", "bundle").select(F.col("node").alias("rep"), F.col("component").alias("bundle"))


def _open_members(bundles: DataFrame, found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Members of bundles of three or more that are not one component: their component, the bundle's
    main one and the number of blocks that its members fill."""
    sizes = sets.groupBy("id").agg(F.max(F.size("shingles")).alias("n"))
    labelled = stored(bundles.join(found.withColumnRenamed("node", "rep"), "rep", "left")
                      .withColumn("component", F.coalesce("component", "rep"))
                      .join(sizes.withColumnRenamed("id", "rep"), "rep"), "labelled")
    mixed = stored(with_group_facts(labelled, ["bundle"], {
        "low": F.min("component"), "high": F.max("component"), "members": F.count(F.lit(1)), "total": F.sum("n")},
        ["rep"], having="low != high AND members > 2").drop("low", "high"), "mixed")
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK_TEXTS), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    return stored(with_group_facts(mixed, ["bundle"], {"main": F.min_by("component", F.xxhash64("rep"))}, ["rep"])
                  .select("bundle", "rep", "component", "main", blocks.alias("blocks")), "open")


def _block_links(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join different components, enough of them to connect what is connected."""
    rows = rest.join(sets.withColumnRenamed("id", "rep"), "rep")
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    outside = rows.where("component != main").select("bundle", own.alias("i"), other.alias("j"), F.lit(True).alias("outside"),
                                                     "rep", "component", "shingles")
    members = rows.select("bundle", other.alias("i"), own.alias("j"), F.lit(False).alias("outside"),
                          "rep", "component", "shingles")

    def compare(frame):
        import pandas as pd
        left, right = frame[frame["outside"]], frame[~frame["outside"]]
        links = _spanning_links(left, right, percent) if len(left) and len(right) else []
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    return stored(outside.unionByName(members).groupBy("bundle", "i", "j").applyInPandas(compare, "a long, b long")
                  .distinct(), "links")


def _spanning_links(left, right, percent: int) -> list[tuple[int, int]]:
    """Pairs over the threshold whose components differ, each joining two sets of components for the first time."""
    size_l, size_r = (np.array([len(s) for s in side["shingles"]]) for side in (left, right))
    flat_l, flat_r = (np.concatenate(list(side["shingles"])) for side in (left, right))
    row_l, row_r = np.repeat(np.arange(len(size_l)), size_l), np.repeat(np.arange(len(size_r)), size_r)
    both = np.intersect1d(flat_l, flat_r)
    common = np.zeros((len(size_l), len(size_r)), np.float32)
    places = []
    for flat, row in ((flat_l, row_l), (flat_r, row_r)):
        at = np.minimum(np.searchsorted(both, flat), max(len(both) - 1, 0))
        hit = both[at] == flat if len(both) else np.zeros(len(flat), bool)
        places.append((at[hit], row[hit]))
    for first in range(0, len(both), COLUMNS):
        sides = []
        for (at, row), size in zip(places, (size_l, size_r)):
            here = (at >= first) & (at < first + COLUMNS)
            matrix = np.zeros((len(size), min(COLUMNS, len(both) - first)), np.float32)
            matrix[row[here], at[here] - first] = 1
            sides.append(matrix)
        common += sides[0] @ sides[1].T
    common = common.astype(np.int64)
    label_l, label_r = left["component"].to_numpy(), right["component"].to_numpy()
    similar = (common * 100 >= (size_l[:, None] + size_r[None, :] - common) * percent) & (label_l[:, None] != label_r[None, :])
    rows, columns = np.nonzero(similar)
    _, first = np.unique(np.stack([label_l[rows], label_r[columns]]), axis=1, return_index=True)
    root: dict[int, int] = {}

    def top(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links, id_l, id_r = [], left["rep"].to_numpy(), right["rep"].to_numpy()
    for k in first.tolist():
        a, b = top(int(label_l[rows[k]])), top(int(label_r[columns[k]]))
        if a != b:
            root[a] = b
            links.append((int(id_l[rows[k]]), int(id_r[columns[k]])))
    return links


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)
