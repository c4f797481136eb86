"""One equi-join, four ways to run it, and the joins that need care at scale."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from millrace.operators.scan_cost import scanned_bytes

BROADCAST_LIMIT = 64 << 20


def _keys(on: str | list[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _with_keys(df: DataFrame, on: list[str]) -> DataFrame:
    """Rows that can match an inner join at all."""
    return df.where(reduce(Column.__and__, [F.col(k).isNotNull() for k in on]))


def sort_merge_join(fact: DataFrame, dim: DataFrame, on: str | list[str]) -> DataFrame:
    """Both sides shuffled on the key. Adaptive execution splits an oversized partition."""
    return fact.hint("merge").join(dim.hint("merge"), _keys(on))


def adaptive_join(fact: DataFrame, dim: DataFrame, on: str | list[str]) -> DataFrame:
    """Both sides shuffled, never broadcast: adaptive execution joins small partitions and splits skewed ones.

    The session must have it on; a setting changed here would hold for all later queries.
    """
    conf = fact.sparkSession.conf
    for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"):
        if conf.get(key, "true").lower() != "true":
            raise ValueError(f"{key} is off in this session")
    return fact.join(dim.hint("merge"), _keys(on))


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    """Measure a side (one aggregation over it) and compare with the limit."""
    measured = scanned_bytes(df, df.columns).first()
    return measured["scan_bytes"] + 16 * measured["row_count"] <= limit


def bounded_broadcast_join(fact: DataFrame, dim: DataFrame, on: str | list[str],
                           limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Broadcast the dimension if its measured size allows; otherwise shuffle, hot keys salted."""
    if fits_broadcast(dim, limit):
        return fact.join(F.broadcast(dim), _keys(on))
    return hot_salted_join(fact, dim, on)


def salts_needed(fact: DataFrame, on: str | list[str]) -> int:
    """Parts into which the most frequent key must be cut to fit an average shuffle partition; one job."""
    parts = _partitions(fact)
    top = hot_keys(fact, on, 1 / parts).agg(F.max("_share")).first()[0]
    return max(1, math.ceil((top or 0) * parts))


def salted_join(fact: DataFrame, dim: DataFrame, on: str | list[str], salts: int | None = None) -> DataFrame:
    """Inner join with every key spread over ``salts`` buckets, by default as many as its hottest key needs.

    The whole dimension is copied for each; ``hot_salted_join`` copies hot keys only.
    The salt is a hash of the whole fact row, not a random number: a task that is
    redone after a lost executor puts each row where it was before.
    """
    on = _keys(on)
    salts = salts or salts_needed(fact, on)
    spread = _with_keys(fact, on).withColumn("_salt", F.pmod(F.xxhash64(*fact.columns), F.lit(salts)))
    copies = _with_keys(dim, on).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return spread.hint("merge").join(copies.hint("merge"), on + ["_salt"]).drop("_salt")


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, on: str | list[str], share: float) -> DataFrame:
    """Keys that hold at least a share of the rows, with ``_share``.

    One job: the total is observed while the keys are counted. At most 1/share keys can
    be hot, so no more than that reach the driver and the list is a constant afterwards.
    """
    on, total = _keys(on), Observation()
    counts = (_with_keys(df, on).groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
              .observe(total, F.sum("_rows").alias("rows")))
    largest = counts.orderBy(F.desc("_rows"), *on).limit(math.ceil(1 / share)).collect()
    rows = total.get["rows"] or 0
    found = [(*[r[k] for k in on], r["_rows"] / rows) for r in largest if r["_rows"] >= share * rows]
    schema = T.StructType([*[df.schema[k] for k in on], T.StructField("_share", T.DoubleType())])
    return df.sparkSession.createDataFrame(found, schema)


def hot_salted_join(fact: DataFrame, dim: DataFrame, on: str | list[str],
                    pieces: int | None = None, share: float | None = None) -> DataFrame:
    """Like ``salted_join``, but only hot keys are spread and copied, as far as each needs it.

    A key is hot when its rows would fill a shuffle partition of average size (or hold one
    in a hundred rows). It is cut by its share of ``pieces``, by default twice the number of
    shuffle partitions, so every piece stays below an average partition, however large the
    cluster. The list of hot keys has at most 1/share rows, so broadcasting it is safe. Where
    the dimension has one row a key, the copies together are at most ``pieces`` and one for each
    hot key; a key that repeats there is copied with all its rows.
    """
    on = _keys(on)
    pieces = pieces or 2 * _partitions(fact)
    share = share or min(0.01, 1 / _partitions(fact))
    hot = hot_keys(fact, on, share).select(
        *on, F.greatest(F.lit(2), F.ceil(F.col("_share") * pieces)).cast("long").alias("_pieces"))
    zero = F.lit(0).cast("long")
    spread = (_with_keys(fact, on).join(F.broadcast(hot), on, "left")
              .withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(*fact.columns), F.col("_pieces")), zero))
              .drop("_pieces"))
    copies = (_with_keys(dim, on).join(F.broadcast(hot), on, "left")
              .withColumn("_salt", F.explode(F.sequence(zero, F.coalesce(F.col("_pieces") - 1, zero))))
              .drop("_pieces"))
    return spread.join(copies, on + ["_salt"]).drop("_salt")


def either_key_join(left: DataFrame, right: DataFrame, left_key: str, right_keys: list[str]) -> DataFrame:
    """left.key = right.a OR left.key = right.b, as one equi-join.

    Each right row is offered once per distinct key, so no pair comes out twice
    and no nested loop or de-duplication is needed. A key that very many right rows
    name (a parent with many children) is salted.
    """
    offered = right.withColumn("_key", F.explode(
        F.array_distinct(F.array_compact(F.array(*[F.col(k) for k in right_keys])))))
    return hot_salted_join(offered, left.withColumn("_key", F.col(left_key)), "_key").drop("_key")


def side_by_side(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two one-row results as one row, each attached as a scalar subquery."""
    def packed(df):
        return df.select(F.struct(*df.columns).alias("_row"))

    spark = left.sparkSession
    row = spark.range(1).select(packed(left).scalar().alias("_l"), packed(right).scalar().alias("_r"))
    return row.select(*[F.col(f"_l.{c}").alias(c) for c in left.columns],
                      *[F.col(f"_r.{c}").alias(c) for c in right.columns])


def unnest(df: DataFrame, array_col: str, prefix: str) -> DataFrame:
    """One row for each struct in an array; a row with an empty array disappears."""
    fields = df.schema[array_col].dataType.elementType.fieldNames()
    return (df.withColumn("_e", F.explode(array_col)).drop(array_col)
            .select("*", *[F.col(f"_e.{f}").alias(f"{prefix}_{f}") for f in fields]).drop("_e"))
