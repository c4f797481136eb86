"""Rides and accounts for the bench: one account holds a chosen share of the rides."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

HOT_ACCOUNT = 0


def skewed_facts(spark: SparkSession, rows: int, accounts: int, hot_share: float = 0.6) -> DataFrame:
    """(trip_id, account_id, pickup_date, fare), all from hashes of the number, so that a redone task repeats its rows."""
    def drawn(what: str, values: int):
        return F.pmod(F.xxhash64("id", F.lit(what)), F.lit(values))

    hot = drawn("hot", 10_000) < round(hot_share * 10_000)
    return spark.range(rows).select(
        F.col("id").alias("trip_id"), F.when(hot, HOT_ACCOUNT).otherwise(1 + drawn("account", accounts)).alias("account_id"),
        F.date_add(F.to_date(F.lit("2023-07-01")), drawn("day", 400).cast("int")).alias("pickup_date"),
        (F.lit(4.5) + drawn("cents", 5_000) / 100).alias("fare"))


def account_dimension(spark: SparkSession, accounts: int) -> DataFrame:
    """(account_id, tier): the hot account and ``accounts`` others, tiers by size of a made-up fleet."""
    fleet = F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(100))
    tier = F.when(F.col("id") == HOT_ACCOUNT, "cash").when(fleet < 70, "small").when(fleet < 95, "medium").otherwise("large")
    return spark.range(accounts + 1).select(F.col("id").alias("account_id"), tier.alias("tier"))
