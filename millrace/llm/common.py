"""Helpers that several operators share: scratch tables, spread joins, ranks, components, word streams."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.session import scratch_path

# ASCII white space: space and \t \n \v \f \r
ASCII_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back: lineage ends here and a lost
    executor costs only the tasks it held."""
    path = scratch_path(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


PIECES = 248  # most parts that one key's rows are cut into


def _cut(df: DataFrame, by: list[str]) -> tuple[DataFrame, int]:
    """``_salt`` from a hash of the row, the same in every retry, and the number of salts."""
    pieces = min(partitions(df.sparkSession), PIECES)
    return df.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(pieces)).cast("int")), pieces


def with_group_facts(df: DataFrame, keys: list[str], facts: dict[str, Column], spread_by: list[str],
                     having: str = "true") -> DataFrame:
    """Adds aggregates of each row's group to the row, for groups that meet ``having``.

    Keys must not be null. The aggregates are combined before the shuffle. To bring them back,
    a group is cut into the salts that occur in it (kept as bits), so one that holds a third of
    all rows is spread over the partitions and a group of one row costs one row. ``df`` is read
    twice: pass a stored table.
    """
    cut, pieces = _cut(df, spread_by)
    words = range(-(-pieces // 62))
    bits = [F.bit_or(F.expr(f"IF(_salt DIV 62 = {i}, shiftleft(1L, _salt % 62), 0L)")).alias(f"_bits{i}")
            for i in words]
    present = (f"filter(sequence(0, {pieces - 1}), i -> getbit(element_at(array("
               + ", ".join(f"_bits{i}" for i in words) + "), cast(i DIV 62 AS INT) + 1), i % 62) = 1)")
    whole = cut.groupBy(*keys).agg(*[c.alias(n) for n, c in facts.items()], *bits).where(having)
    copies = whole.withColumn("_salt", F.explode(F.expr(present))).drop(*[f"_bits{i}" for i in words])
    return cut.join(copies, [*keys, "_salt"]).drop("_salt")


def lookup(df: DataFrame, keys: list[str], facts: DataFrame, spread_by: list[str],
           how: str = "inner") -> DataFrame:
    """Joins rows of ``facts``, one for each key, to ``df``, where one key may hold a third of all rows."""
    cut, _ = _cut(df, spread_by)
    copies = cut.select(*keys, "_salt").distinct().join(facts, keys)
    return cut.join(copies, [*keys, "_salt"], how).drop("_salt")


def with_rank(df: DataFrame, group: str, order: list[str], rank: str) -> DataFrame:
    """Adds the row's number within its group, from 0 and without gaps.

    Rows are dealt into bins by a hash of ``order`` so that no task holds a whole group; the
    bins' sizes, one row for each group and bin, are summed up to offsets. ``df`` is read
    three times: pass a stored table. Rows equal in ``order`` are numbered in any order.
    """
    bins = max(partitions(df.sparkSession), math.ceil(df.count() / 1000))
    binned = df.withColumn("_bin", F.pmod(F.xxhash64(*order), F.lit(bins)))
    before = Window.partitionBy(group).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (binned.groupBy(group, "_bin").agg(F.count(F.lit(1)).alias("_n"))
               .select(group, "_bin", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    inside = Window.partitionBy(group, "_bin").orderBy(*order)
    return (binned.withColumn("_inside", F.row_number().over(inside) - 1)
            .join(offsets, [group, "_bin"])
            .withColumn(rank, F.col("_offset") + F.col("_inside")).drop("_bin", "_inside", "_offset"))


def components(edges: DataFrame, a: str, b: str, label: str) -> DataFrame:
    """Connected components of the links: (node, component) for every node that has a link.

    Large-star and small-star steps in turn until nothing changes; every step's edges are
    written to the shared folder, and hubs are spread by ``with_group_facts``.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    now = stored(edges.where(F.col(a) != F.col(b)).select(high.alias("u"), low.alias("v")).distinct(), label)
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen or state[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component"))).groupBy("node").agg(
                F.min("component").alias("component"))
        seen = tuple(state)
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (with_group_facts(both, ["u"], {"m": F.min("v")}, ["u", "v"]).where("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        large = stored(large, label)
        met = with_group_facts(large, ["u"], {"m": F.min("v")}, ["u", "v"])
        now = stored(met.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                                  F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                     .select("e.*").where("u != v").distinct(), label)


def process_cache(name: str, make):
    """An object made once for each Python worker and kept between its tasks."""
    import sys
    import types
    holder = sys.modules.setdefault("_millrace_worker", types.ModuleType("_millrace_worker"))
    if not hasattr(holder, name):
        setattr(holder, name, make())
    return getattr(holder, name)


def slices(column: pa.Array, most: int = 4 << 20):
    """(start, length) of runs of rows of about ``most`` bytes of text, one row at least."""
    size = np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
    group = (np.cumsum(size) - size) // most
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.empty(0, int)
    return zip(starts.tolist(), np.diff(np.r_[starts, len(group)]).tolist())


def word_codes(texts: pa.Array, lower: bool = True):
    """Words between ASCII white space of each text: (distinct words, code of every word, bounds).

    ``bounds`` has one entry more than texts; null counts as empty. ``lower`` lower-cases A-Z only.
    """
    texts = pc.fill_null(texts, "")
    if texts.type != pa.string():  # a cast would keep offsets that the splitting kernel misreads
        texts = pa.array(texts.to_pylist(), pa.string())
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    words = parts.flatten()
    bounds = np.asarray(parts.offsets, dtype=np.int64)
    bounds = bounds - bounds[0]
    full = np.asarray(pc.binary_length(words), dtype=np.int64) > 0
    if not full.all():  # white space at an end of the text gives an empty word
        bounds = np.r_[0, np.cumsum(full)][bounds]
        words = words.filter(pa.array(full))
    coded = words.dictionary_encode()
    return coded.dictionary, np.asarray(coded.indices, dtype=np.int64), bounds
