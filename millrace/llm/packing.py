"""Packing token sequences as a cutting-stock problem solved by column generation.

A document's ids, with the closing id, are cut into full sequences and a rest. Short rests of one length are put
together until their sum is all but a whole number of units, so that a unit of 16 tokens costs them nothing: a
thousand texts of 17 tokens are items of 15 pieces and 255 tokens. Items are counted by units; a linear program over
patterns of lengths that fill a sequence is solved by column generation, with a knapsack by dynamic programming
that prices new patterns; its solution is rounded down and the few lengths left over are packed greedily. Should
column generation not end within ``rounds`` columns, the plan is whole as ever but may need some more sequences.
Documents are ranked within their length, without any length meeting in one task, and a piece's rank
says which copy of which pattern it belongs to.

With an order of the documents, ``SEGMENT`` positions after each other are packed by a plan of their own, the
copies of its patterns are spread evenly, and pieces of one length are dealt to them by position. So
sequences follow the order: all of a segment come before those of the next one.

Null and empty texts are a piece of one id. Rows that repeat a ``doc_id`` are packed each. Other
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import partitions, slices, stored, table, with_rank
from millrace.llm.tokens import encoder, tokenizer_path

UNIT = 16  # tokens; an item's length is rounded up to whole units in patterns
SHORT, LOSS = 256, 0.005  # pieces up to so many tokens are put together until rounding costs at most this share
SEGMENT = 4096  # positions that one plan packs where documents have an order

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, doc_row long"


def token_pieces(docs: DataFrame, capacity: int, closing: int, path: str | None, source: bool = False) -> DataFrame:
    """Each document's ids cut into full sequences and a rest, with a number of its row, the same in every retry
    of a task; with ``source``, that column too."""
    more = ["source"] * source
    path = tokenizer_path(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        from pyspark import TaskContext
        encode, row = encoder(path), TaskContext.get().partitionId() << 33
        for batch in batches:
            for first, length in slices(batch.column(1)):
                part = batch.slice(first, length)
                ids, bounds = encode.ids(part.column(1))
                ids = np.insert(ids, bounds[1:], closing).astype("<u4")
                bounds = bounds + np.arange(len(bounds))
                rows: list[tuple] = []
                for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    for at in range(a, b, capacity):
                        end = min(at + capacity, b)
                        rows.append((i, at - a, end - at, zlib.crc32(ids[at:end].tobytes()), b - a))
                found = np.array(rows, dtype=np.int64).reshape(-1, 5)
                numbers = pa.array(row + found[:, 0])
                row += length
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(found[:, 0])), *[pa.array(found[:, k]) for k in range(1, 5)], numbers,
                     *[part.column(2).take(pa.array(found[:, 0])) for _ in more]],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "doc_row", *more])

    return docs.select("doc_id", "text", *more).mapInArrow(run, PIECES + ", source string" * source)


def _best_pattern(values: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable pattern and how often it holds each size."""
    best, pick = np.zeros(room + 1), np.full(room + 1, -1)
    for w in range(1, room + 1):
        best[w] = best[w - 1]
        fitting = int(np.searchsorted(sizes, w, side="right"))
        if fitting:
            gain = best[w - sizes[:fitting]] + values[:fitting]
            k = int(gain.argmax())
            if gain[k] > best[w] + 1e-12:
                best[w], pick[w] = gain[k], k
    pattern, w = np.zeros(len(sizes)), room
    while w > 0:
        if pick[w] < 0:
            w -= 1
        else:
            pattern[pick[w]] += 1
            w -= int(sizes[pick[w]])
    return float(best[room]), pattern


def cutting_plan(counts: dict[int, int], room: int, rounds: int = 4000) -> list[tuple[dict[int, int], int]]:
    """(pattern, copies) that hold exactly ``counts`` pieces of each size; a pattern's sizes sum up to ``room`` at most."""
    sizes = np.array(sorted(s for s, n in counts.items() if n > 0))
    if not len(sizes):
        return []
    need = np.array([counts[int(s)] for s in sizes], dtype=np.int64)
    columns = np.diag((room // sizes).astype(float))
    inverse, x = np.diag(1 / np.diag(columns)), need / np.diag(columns)
    for _ in range(rounds):
        value, pattern = _best_pattern(inverse.sum(axis=0), sizes, room)
        if value <= 1 + 1e-9:
            break
        step = inverse @ pattern
        ratio = np.full(len(x), np.inf)
        np.divide(x, step, out=ratio, where=step > 1e-9)
        leave = int(ratio.argmin())
        columns[:, leave] = pattern
        pivot = inverse[leave] / step[leave]
        inverse -= np.outer(step, pivot)
        inverse[leave] = pivot
        x = np.maximum(inverse @ need, 0)
    plan, left = [], need.copy()
    for k in np.argsort(-x, kind="stable"):
        pattern = np.rint(columns[:, k]).astype(np.int64)
        used = pattern > 0
        copies = int(min(np.floor(x[k] + 1e-6), (left[used] // pattern[used]).min()))
        if copies > 0:
            plan.append(({int(s): int(a) for s, a in zip(sizes[used], pattern[used])}, copies))
            left -= copies * pattern
    while left.any():
        pattern, space = np.zeros(len(sizes), dtype=np.int64), room
        for k in range(len(sizes) - 1, -1, -1):
            pattern[k] = min(left[k], space // sizes[k])
            space -= int(pattern[k] * sizes[k])
        used = pattern > 0
        copies = int((left[used] // pattern[used]).min())
        plan.append(({int(s): int(a) for s, a in zip(sizes[used], pattern[used])}, copies))
        left -= copies * pattern
    return plan


def together(length: int) -> int:
    """How many pieces of this length make an item: the fewest for which rounding to units costs next to nothing."""
    if length > SHORT:
        return 1
    return next(k for k in range(1, UNIT + 1) if -k * length % UNIT <= LOSS * k * length)


def items(counts: dict[int, int]) -> list[tuple[int, int, int, int, int]]:
    """(length, pieces of an item, first piece, items, units of an item) for pieces counted by length."""
    found = []
    for length, n in sorted(counts.items()):
        k = together(length)
        whole, rest = divmod(n, k)
        found += [(length, k, 0, whole, -(-k * length // UNIT))] * (whole > 0)
        found += [(length, 1, whole * k, rest, -(-length // UNIT))] * (rest > 0)
    return found


def by_units(found: list[tuple[int, int, int, int, int]]) -> dict[int, int]:
    counts: dict[int, int] = {}
    for _, _, _, n, units in found:
        counts[units] = counts.get(units, 0) + n
    return counts


def spread_plan(counts: dict[int, int], room: int) -> dict[int, np.ndarray]:
    """For each size, the sequence of its first, second, ... item; copies of every pattern are spread evenly over the sequences."""
    plan = cutting_plan(counts, room)
    if not plan:
        return {}
    pattern = np.repeat(np.arange(len(plan)), [c for _, c in plan])
    due = np.concatenate([(np.arange(c) + 0.5) / c for _, c in plan])
    pattern = pattern[np.argsort(due, kind="stable")]
    sequence = np.arange(len(pattern))
    return {s: np.repeat(sequence, np.array([p.get(s, 0) for p, _ in plan])[pattern]) for s, n in counts.items() if n > 0}


def _placed_by_rank(pieces: DataFrame, capacity: int) -> DataFrame:
    """Pieces with sequence_id and place by one plan for all, in no order. Both broadcast tables are bounded by the capacity."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    found = items(counts)
    taken, dealt = {}, []  # items of one size are numbered over all lengths
    for length, k, first, n, units in found:
        dealt.append((length, k, first, first + k * n, units, taken.get(units, 0)))
        taken[units] = taken.get(units, 0) + n
    rows, ranks, sequence = [], dict.fromkeys(taken, 0), 0
    for pattern, copies in cutting_plan(by_units(found), capacity // UNIT):
        for units, times in pattern.items():
            rows.append((units, ranks[units], ranks[units] + times * copies, times, sequence))
            ranks[units] += times * copies
        sequence += copies
    spark = pieces.sparkSession
    made = spark.createDataFrame(dealt, "length long, k int, first_piece long, last_piece long, units int, first_item long")
    plan = spark.createDataFrame(rows, "units int, first long, last long, times int, first_sequence long")
    ranked = with_rank(pieces, "length", ["doc_row", "start"], "rank")
    inside = (F.col("rank") >= F.col("first_piece")) & (F.col("rank") < F.col("last_piece"))
    item = ranked.join(F.broadcast(made), "length").where(inside).withColumn("item", F.expr("first_item + (rank - first_piece) DIV k"))
    inside = (F.col("item") >= F.col("first")) & (F.col("item") < F.col("last"))
    return (item.join(F.broadcast(plan), "units").where(inside)
            .withColumn("sequence_id", F.expr("first_sequence + (item - first) DIV times"))
            .withColumn("place", F.struct((-F.col("units")).alias("units"), "item", "rank")))


def _planned(capacity: int):
    def planned(found: pd.DataFrame) -> pd.DataFrame:
        made = items(dict(zip(found["length"].tolist(), found["n"].tolist())))
        dealt, taken, parts = spread_plan(by_units(made), capacity // UNIT), {}, []
        for length, k, first, n, units in made:
            at = taken.get(units, 0)
            taken[units] = at + n
            item = np.repeat(np.arange(at, at + n), k)
            parts.append(pd.DataFrame({"segment": found["segment"].iloc[0], "length": length, "rank": first + np.arange(n * k),
                                       "units": units, "item": item, "sequence": dealt[units][item]}))
        return pd.concat(parts)
    return planned


def _placed_in_order(pieces: DataFrame, places: DataFrame, capacity: int) -> DataFrame:
    """Pieces with sequence_id and place by a plan for each segment of positions; segments come one after the other."""
    spark = pieces.sparkSession
    # rows of one key take its positions in turn; their numbers spread a key that very many rows share
    docs = stored(pieces.where("start = 0").select(F.struct("doc_id", "source").alias("_key"), "doc_row"), "packed-docs")
    places = stored(places, "places")
    dealt = (with_rank(docs, "_key", ["doc_row"], "_nth").join(with_rank(places, "_key", ["_position"], "_nth"), ["_key", "_nth"])
             .select("doc_row", "_position"))
    located = stored(pieces.drop("source").join(dealt, "doc_row").withColumn("segment", F.expr(f"_position DIV {SEGMENT}")), "located")
    counts = located.groupBy("segment", "length").agg(F.count(F.lit(1)).alias("n"))
    segments = (located.agg(F.max("segment")).first()[0] or 0) + 1
    # so few rows that adaptive execution would plan all segments in one task: their number is given
    plan = stored(counts.repartition(min(segments, 2 * partitions(spark)), "segment").groupBy("segment").applyInPandas(
        _planned(capacity), "segment long, length long, rank long, units int, item long, sequence long"), "plan")
    sizes = plan.groupBy("segment").agg((F.max("sequence") + 1).alias("n")).withColumn("_bin", F.expr("segment DIV 1024"))

    def before(*by):  # sequences of earlier segments, first by 1,024 of them and then inside
        return Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)

    bins = sizes.groupBy("_bin").agg(F.sum("n").alias("all")).select(
        "_bin", F.coalesce(F.sum("all").over(before().orderBy("_bin")), F.lit(0)).alias("earlier"))
    firsts = sizes.withColumn("inside", F.coalesce(F.sum("n").over(before("_bin").orderBy("segment")), F.lit(0))).join(bins, "_bin").select(
        "segment", (F.col("earlier") + F.col("inside")).alias("first_sequence"))
    inside = Window.partitionBy("segment", "length").orderBy("_position", "doc_row", "start")
    ranked = located.withColumn("rank", F.row_number().over(inside).cast("long") - 1)
    return (ranked.join(plan, ["segment", "length", "rank"]).join(firsts, "segment")
            .withColumn("sequence_id", F.expr("first_sequence + sequence"))
            .withColumn("place", F.struct((-F.col("units")).alias("units"), "item", "rank")))


def packed(docs: DataFrame, capacity: int = 4096, closing: int = 2, path: str | None = None,
           places: DataFrame | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``places`` has a position for every row, by its doc_id and source, as ``mixed_places`` gives it.
    """
    pieces = stored(token_pieces(docs, capacity, closing, path, places is not None), "pieces")
    placed = _placed_by_rank(pieces, capacity) if places is None else _placed_in_order(pieces, places, capacity)
    before = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
