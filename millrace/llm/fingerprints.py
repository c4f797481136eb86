"""Document fingerprints by MinHash: many universal hash permutations over word shingles, vectorised in numpy.

Permutation k maps a shingle x to (a_k * x + b_k) mod 2^64 with odd a_k, the multiply-shift family; the least
value over a text's shingles is coordinate k of its signature. A shingle is five words, the text preceded by
four empty ones, so a text has as many shingles as words and a short one has some too. The fingerprint shows 16
bits of every coordinate in hexadecimal; likeness is the share of coordinates that agree, which estimates the
Jaccard similarity of the shingle sets with a standard error of 0.045 at most. Groups of coordinates form
bands; documents that share a band are joined in Spark and confirmed on their full shingle sets.

To fingerprint a document edited with the start of the next one, documents are dealt into ranges of doc_id, and
the first document of each range is sent to the range before it as well. Inside a range they pass in descending
order, so that the next document has always been seen: whole texts are moved once and none is held but the last.

Words are those between ASCII white space, A-Z in lower case. Null text counts as empty; the empty set's
signature is all ones, equal to itself and to no other. Of rows that repeat a ``doc_id`` the one with the least
text is the next document of those before; all of them are edited with the same next document. Rows without
``doc_id`` have no next document (their edited text ends at the cut, ``near_next`` is 0) and are nobody's next.
Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import partitions, process_cache, slices, stored, table, word_codes
from millrace.llm.minhash import SIGNATURE, linked_by_bands

WORDS = 5
BANDS, ROWS = 25, 5  # finds a pair of similarity 0.8 with probability 0.99995
PERMUTATIONS = BANDS * ROWS
BLOCK = 1 << 15  # shingles whose values under one permutation are held at a time
MIX = [np.uint64(m) for m in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * MIX[0]
    x = (x ^ (x >> np.uint64(33))) * MIX[1]
    return x ^ (x >> np.uint64(33))


def shingles(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts in a row and their bounds, one entry more than texts."""
    import xxhash
    distinct, codes, bounds = word_codes(texts)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) | 1 for w in distinct.to_pylist()), np.uint64, len(distinct))
    text = np.repeat(np.arange(1, len(bounds)), np.diff(bounds))
    at = np.arange(len(codes)) + text * (words - 1)  # every text is preceded by empty words, whose hash is 0
    stream = np.zeros(len(codes) + len(bounds) * (words - 1), np.uint64)
    stream[at] = hashes[codes]
    total = np.zeros(len(codes), np.uint64)
    for back in range(words - 1, -1, -1):
        total = _mixed(total * MIX[1] + stream[at - back])
    return total, bounds


def signatures(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The least value of each text's shingles under every permutation, one row a text."""
    def factors():
        drawn = np.random.default_rng(20250711).integers(0, 1 << 63, (2, PERMUTATIONS), dtype=np.uint64)
        return drawn[0] * np.uint64(2) + np.uint64(1), drawn[1]

    scale, shift = process_cache("fingerprint factors", factors)
    found = np.full((len(bounds) - 1, PERMUTATIONS), NONE)
    values = np.empty(min(BLOCK, len(hashes)), np.uint64)
    for at in range(0, len(hashes), BLOCK):
        block = hashes[at:at + BLOCK]
        first, last = np.searchsorted(bounds, [at, at + len(block) - 1], side="right") - 1
        begins = np.maximum(bounds[first:last + 1] - at, 0)
        full = np.flatnonzero(np.diff(np.r_[begins, len(block)]) > 0)  # texts with shingles in this block
        begins, here = begins[full], values[:len(block)]
        for k in range(PERMUTATIONS):
            np.multiply(block, scale[k], out=here)
            np.add(here, shift[k], out=here)
            found[first + full, k] = np.minimum(found[first + full, k], np.minimum.reduceat(here, begins))
    return found


def short_form(signed: np.ndarray) -> np.ndarray:
    """16 bits of every coordinate."""
    return (_mixed(signed) >> np.uint64(48)).astype(">u2")


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of coordinates that agree, row by row."""
    return (a == b).mean(axis=1)


def _hex(short: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in np.ascontiguousarray(short)]


def _by_id(docs: DataFrame) -> DataFrame:
    """Documents with an id, dealt into ranges of it and sorted: range, tail, doc_id, text.

    A ``tail`` row repeats the first document of the range after, and of the first range for the last one.
    """
    n = min(4 * partitions(docs.sparkSession), 8192)
    named = docs.where("doc_id IS NOT NULL").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    cuts = named.agg(F.min("doc_id").alias("least"),
                     F.percentile_approx("doc_id", [k / n for k in range(1, n)] or [0.5], 10 * n).alias("cuts")).first()
    lows = sorted({cuts["least"], *(cuts["cuts"] or [])}) if cuts["least"] is not None else [0]
    starts = F.array(*[F.lit(v).cast("long") for v in lows])
    steps = F.array(*[F.lit(1 << k) for k in range(len(lows).bit_length() - 1, -1, -1)])

    def further(at: Column, step: Column) -> Column:  # a binary search for the last range that starts at doc_id or before
        return F.when((at + step <= len(lows)) & (F.element_at(starts, F.least(at + step, F.lit(len(lows)))) <= F.col("doc_id")),
                      at + step).otherwise(at)

    own = F.aggregate(steps, F.lit(0), further)
    placed = named.withColumn("_own", own)
    home = F.struct(F.col("_own").alias("range"), F.lit(False).alias("tail"))
    before = F.struct(F.when(F.col("_own") > 1, F.col("_own") - 1).otherwise(len(lows)).alias("range"), F.lit(True).alias("tail"))
    first = F.col("doc_id") == F.element_at(starts, F.col("_own"))
    return (placed.select("doc_id", "text", F.explode(F.when(first, F.array(home, before)).otherwise(F.array(home))).alias("p"))
            .select("p.range", "p.tail", "doc_id", "text").repartition(partitions(docs.sparkSession), "range")
            .sortWithinPartitions("range", F.desc("tail"), F.desc("doc_id"), "text"))


EDITED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _edited(words: int):
    def signed(texts: list[str]) -> np.ndarray:
        return short_form(signatures(*shingles(pa.array(texts, pa.string()), words)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        place, group, tail = None, None, False  # range and id of the last document
        rep = following = None  # (text, short signature) of this id's and of the next id's document
        for batch in batches:
            for first, length in slices(batch.column(3)):
                part = batch.slice(first, length)
                texts = part.column(3).to_pylist()
                own = signed(texts)
                kept, edited, after = [], [], []
                for i, (where, is_tail, doc, text) in enumerate(zip(*(part.column(k).to_pylist() for k in range(3)), texts)):
                    if doc is None or where != place:
                        rep = following = None
                    if doc is None or where != place or doc != group or tail != is_tail:
                        following, rep = rep, (text, own[i])
                    place, group, tail = where, doc, is_tail
                    if not is_tail:
                        half = len(text) // 2
                        kept.append(i)
                        edited.append(text[:len(text) - half] + (following[0][:half] if following else ""))
                        after.append(following[1] if following else None)
                if not kept:
                    continue
                changed, mine = signed(edited), own[kept]
                near_next = [float((a == b).mean()) if b is not None else 0.0 for a, b in zip(mine, after)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(2).take(pa.array(kept)), pa.array([len(texts[i]) for i in kept], pa.int64()),
                     pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]), pa.array(_hex(mine)),
                     pa.array(_hex(changed)), pa.array(likeness(mine, changed)), pa.array(near_next)],
                    names=[c.split()[0] for c in EDITED.split(", ")])
    return run


def edited_fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """One row per document: its fingerprint, that of the text whose second half is the next document's start,
    and the likeness of its own to the edited text's and to the next document's."""
    alone = docs.where("doc_id IS NULL").select(F.lit(0).alias("range"), F.lit(False).alias("tail"), F.col("doc_id").cast("long"),
                                                F.coalesce("text", F.lit("")).alias("text"))
    return (_by_id(docs).mapInArrow(_edited(words), EDITED)
            .unionByName(alone.mapInArrow(_edited(words), EDITED)))


FINGERPRINT = SIGNATURE + ", fingerprint string"


def _fingerprinted(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, length in slices(batch.column(1)):
                part = batch.slice(first, length)
                hashes, bounds = shingles(part.column(1), words)
                found = signatures(hashes, bounds)
                sets = [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                sizes = np.array([len(s) for s in sets], np.int64)
                digests = [np.array([_mixed(s + salt).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64) for salt in MIX]
                keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sets), BANDS)).copy()
                for r in range(ROWS):
                    keys = _mixed(keys * MIX[0] + found[:, r::ROWS])
                full = sizes > 0
                bands = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(full * BANDS)], pa.int32()),
                                                 pa.array(keys[full].reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes), *map(pa.array, digests), bands, pa.array(_hex(short_form(found)))],
                    names=[c.split()[0] for c in FINGERPRINT.split(", ")])
    return run


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """One row per document: doc_id, n_shingles, two digests of the shingle set, bands and fingerprint."""
    return docs.select("doc_id", "text").mapInArrow(_fingerprinted(words), FINGERPRINT)


def near_by_fingerprint(docs: DataFrame, words: int = WORDS, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable), kept.

    Bands of the signatures are joined; links are confirmed by the Jaccard similarity of whole shingle sets.
    """
    def full_sets(texts: pa.Array) -> list[np.ndarray]:
        hashes, bounds = shingles(texts, words)
        return [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]

    docs = docs.select("doc_id", "text")
    signed = stored(fingerprints(docs, words).drop("fingerprint"), "fingerprints")
    return linked_by_bands(docs, signed, full_sets, percent)


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))
