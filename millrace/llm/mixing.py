"""Mixing sources to target weights by Pfair scheduling.

Documents of a source form blocks. Block k of a source with weight w may not come before slot
floor(k / w) and is due by slot ceil((k + 1) / w); in each slot the released block with the earliest
deadline is taken. After every slot each source is then less than one block away from its target.
With whole-number parts as targets the schedule repeats after as many slots as there are parts, so
one period is computed on the driver and every block's slot follows from its number. A source that
runs out leaves, and a new phase goes on with the parts of the others: no document is dropped
or repeated.

Any number of sources is mixed. The ``SOURCES`` largest (and those that targets name) are scheduled one by one;
all others are one more source with their weights together, whose documents come in rounds: every round takes a
block of each of them that has some left.

A null source is a source of its own. Rows that repeat a ``doc_id`` are placed each. Other columns
are ignored by ``mixed_order``. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import partitions, stored, table, with_rank

BLOCK_DOCUMENTS, PARTS = 8, 1000
SOURCES = 256  # sources scheduled one by one; the schedule has at most their square of rows
OTHERS = "others"  # the rest, as one source; names of sources begin with "s:" and the null source's is empty


def period(parts: list[int]) -> list[int]:
    """Which source each slot of one period goes to; source i gets parts[i] slots."""
    slots, taken = sum(parts), [0] * len(parts)
    order = []
    for slot in range(slots):
        released = [i for i, p in enumerate(parts) if taken[i] < p and taken[i] * slots // p <= slot]
        best = min(released, key=lambda i: (-(-(taken[i] + 1) * slots // parts[i]), -parts[i], i))
        taken[best] += 1
        order.append(best)
    return order


def phases(parts: list[int], blocks: list[int]) -> list[tuple]:
    """(source, first block, blocks, first slot, period, places): while none of its sources runs out,
    block first + j of a source comes in slot first slot + (j div its parts) * period + places[j mod its parts]."""
    done, first_slot, found = [0] * len(parts), 0, []
    while any(d < b for d, b in zip(done, blocks)):
        active = [i for i in range(len(parts)) if done[i] < blocks[i]]
        order = period([parts[i] for i in active])
        places: list[list[int]] = [[] for _ in active]
        for slot, k in enumerate(order):
            places[k].append(slot)

        def slot_of(k, j):
            return j // len(places[k]) * len(order) + places[k][j % len(places[k])]

        end = min(slot_of(k, blocks[i] - done[i] - 1) for k, i in enumerate(active)) + 1
        for k, i in enumerate(active):
            whole, rest = divmod(end, len(order))
            count = whole * len(places[k]) + sum(p < rest for p in places[k])
            found.append((i, done[i], count, first_slot, len(order), places[k]))
            done[i] += count
        first_slot += end
    return found


def target_parts(weights: dict[str, float], parts: int = PARTS) -> dict[str, int]:
    """Whole-number parts in proportion to weights."""
    total = sum(weights.values())
    return {s: max(1, round(parts * w / total)) for s, w in weights.items()}


def _ranked(rows: DataFrame, large: list[str], spark: SparkSession, block_documents: int) -> DataFrame:
    """Rows with their ``group``, a large source or OTHERS, and their rank in it."""
    named = F.when(F.col("mixed").isin(large), F.col("mixed")).otherwise(OTHERS)
    alone = with_rank(rows.where(F.col("mixed").isin(large)), "mixed", ["doc_id", "_row"], "rank").withColumn("group", named)
    inside = with_rank(rows.where(~F.col("mixed").isin(large)), "mixed", ["doc_id", "_row"], "_in_source")
    rounds = stored(inside.withColumn("_round", F.expr(f"_in_source DIV {block_documents}")), "rounds")
    sizes = rounds.groupBy("_round").agg(F.count(F.lit(1)).alias("n")).withColumn("_thousand", F.expr("_round DIV 1024"))

    def before(*by):  # documents of earlier rounds, first by 1,024 of them and then inside
        return Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)

    bins = sizes.groupBy("_thousand").agg(F.sum("n").alias("all")).select(
        "_thousand", F.coalesce(F.sum("all").over(before().orderBy("_thousand")), F.lit(0)).alias("_bins"))
    starts = sizes.withColumn("_rounds", F.coalesce(F.sum("n").over(before("_thousand").orderBy("_round")), F.lit(0))).join(bins, "_thousand")
    dealt = with_rank(rounds, "_round", ["mixed", "_in_source"], "_in_round").join(
        starts.select("_round", (F.col("_bins") + F.col("_rounds")).alias("_start")), "_round")
    others = dealt.withColumn("rank", F.col("_start") + F.col("_in_round")).withColumn("group", named)
    return alone.unionByName(others.select(alone.columns))


def mixed_order(docs: DataFrame, targets: dict[str, int] | None = None,
                block_documents: int = BLOCK_DOCUMENTS) -> DataFrame:
    """One row per document: doc_id, source, block, slot, place (in the block), position and parts.

    ``targets`` gives whole-number parts by source (a null source is named ""); sources that it
    does not name get one part. Without targets they are in proportion to the square root of a source's
    size, so that a hot source doesn't rule. Within a source documents follow a hash of doc_id.
    ``position`` orders all documents.
    """
    spark = docs.sparkSession
    rows = stored(docs.select("doc_id", "source", F.concat(F.when(F.col("source").isNull(), "").otherwise("s:"),
                                                           F.coalesce("source", F.lit(""))).alias("mixed"),
                              F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).alias("_row")), "sources")
    counted = rows.groupBy("mixed").agg(F.count(F.lit(1)).alias("n"))
    named = [f"s:{s}" if s else "" for s in targets or {}][:SOURCES]
    first = [F.col("mixed").isin(named).desc()] if named else []
    top = counted.orderBy(*first, F.desc("n"), "mixed").limit(SOURCES).collect()
    counts = {r["mixed"]: r["n"] for r in sorted(top, key=lambda r: r["mixed"])}
    small = counted.where(~F.col("mixed").isin(list(counts))).agg(F.count(F.lit(1)), F.sum("n"), F.sum(F.sqrt("n"))).first()
    weights = {s: math.sqrt(n) for s, n in counts.items()} | ({OTHERS: small[2]} if small[0] else {})
    if targets is None:
        parts = target_parts(weights)
    else:
        parts = {s: targets.get(s[2:], 1) for s in counts}
        if small[0]:  # one part each, at most as much as all others together
            parts[OTHERS] = min(small[0], max(sum(parts.values()), 1))
    if small[0]:
        counts[OTHERS] = small[1]
        ranked = _ranked(rows, [s for s in counts if s != OTHERS], spark, block_documents)
    else:
        ranked = with_rank(rows, "mixed", ["doc_id", "_row"], "rank").withColumn("group", F.col("mixed"))
    names = list(counts)
    plan = phases([parts[s] for s in names], [-(-counts[s] // block_documents) for s in names])
    schedule = spark.createDataFrame(
        [(names[i], parts[names[i]], first, count, slot, period_slots, places) for i, first, count, slot, period_slots, places in plan],
        "group string, parts int, first_block long, blocks long, first_slot long, period int, places array<int>")
    ranked = ranked.withColumn("block", F.expr(f"rank DIV {block_documents}"))
    inside = (F.col("block") >= F.col("first_block")) & (F.col("block") < F.col("first_block") + F.col("blocks"))
    return (ranked.join(F.broadcast(schedule), "group").where(inside)
            .withColumn("slot", F.expr("first_slot + ((block - first_block) DIV size(places)) * period"
                                       " + element_at(places, cast((block - first_block) % size(places) AS INT) + 1)"))
            .withColumn("place", F.expr(f"cast(rank % {block_documents} AS INT)"))
            .select("doc_id", "source", "block", "slot", "place",
                    (F.col("slot") * block_documents + F.col("place")).alias("position"), "parts"))


def mixed_places(docs: DataFrame, targets: dict[str, int] | None = None) -> DataFrame:
    """(_key, _position): a row for each document, by its pair of doc_id and source, which rows may share."""
    return mixed_order(docs, targets).select(F.struct("doc_id", "source").alias("_key"), F.col("position").alias("_position"))


def in_mixed_order(docs: DataFrame, targets: dict[str, int] | None = None) -> DataFrame:
    """The documents themselves, with their own columns, sorted over all partitions by their position.

    Rows that repeat a doc_id and source lie at the first of their positions, and all rows without doc_id too:
    nothing but a copy of them tells them apart. ``mixed_places`` gives each a position.
    """
    first = mixed_places(docs, targets).groupBy("_key").agg(F.min("_position").alias("_position"))
    return (docs.withColumn("_key", F.struct("doc_id", "source")).join(first, "_key").drop("_key")
            .repartitionByRange(partitions(docs.sparkSession), "_position").sortWithinPartitions("_position")
            .drop("_position"))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_order(table(spark, sf_dir, "documents"))
