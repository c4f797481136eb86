"""What the plans must look like."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions.scalars import last_n_days
from millrace.operators import aggregates, checks, joins, writes
from millrace.plans.derived import accounts, baskets, trips
from millrace.plans.ingestion import AS_OF, CONTRACT, ZONE, loaded_nights
from millrace.session import scratch_path
from __spark_entry__ import queries
from tests.conftest import SF_DIR


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def sides(spark):
    return trips(spark, SF_DIR), accounts(spark, SF_DIR)


def test_sort_merge(sides):
    text = plan(joins.sort_merge_join(*sides, "account_id"))
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


def test_broadcast_does_not_shuffle_the_fact(sides):
    text = plan(joins.bounded_broadcast_join(*sides, "account_id"))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_salted_join_copies_the_dimension(sides):
    text = plan(joins.salted_join(*sides, "account_id"))
    assert "Generate explode" in text and "_salt" in text and "rand(" not in text


def test_salt_spreads_the_hot_key(spark, sides):
    fact = sides[0]
    salt = F.pmod(F.xxhash64(*fact.columns), F.lit(32))
    largest = fact.groupBy("account_id", salt).count().agg(F.max("count")).first()[0]
    hot = fact.groupBy("account_id").count().agg(F.max("count")).first()[0]
    assert largest < hot / 16


def test_hot_keys_are_few_and_cut_by_their_share(spark, sides):
    hot = joins.hot_keys(sides[0], "account_id", 0.01).collect()
    top = max(hot, key=lambda r: r["_share"])
    assert top["account_id"] == -1 and 0.55 < top["_share"] < 0.65 and len(hot) <= 100
    none = joins.hot_keys(spark.range(1000).withColumnRenamed("id", "account_id"), "account_id", 0.01)
    assert none.count() == 0


def test_salts_follow_the_hottest_key(spark, sides):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert parts * 0.55 < joins.salts_needed(sides[0], "account_id") < parts * 0.65 + 1
    assert joins.salts_needed(spark.range(0).withColumnRenamed("id", "account_id"), "account_id") == 1


def test_every_variant_gives_one_answer(sides):
    fact, dim = sides
    want = sorted(map(tuple, joins.sort_merge_join(fact, dim, "account_id").collect()))
    for variant in (joins.bounded_broadcast_join, joins.salted_join, joins.hot_salted_join, joins.adaptive_join):
        got = variant(fact, dim, "account_id").select("account_id", "pickup_date", "fare", "l_orderkey",
                                                      "l_linenumber", "tier")
        assert sorted(map(tuple, got.collect())) == want


def test_flagship_reads_only_its_columns(spark):
    text = queries()["e2_revenue_by_segment_month"](spark, SF_DIR)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in text
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in text
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in text


def test_partition_and_row_group_pruning(spark):
    path = scratch_path(spark, "pruning")
    frame = spark.range(1000).select("id", F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 20).cast("int")).alias("day"))
    writes.write_partitioned(frame, path, "day", ["id"])
    stored = spark.read.parquet(path)
    text = plan(stored.where(last_n_days("day", 7, dt.date(2024, 1, 15)) & (F.col("id") < 10)))
    assert "PartitionFilters: [isnotnull(day" in text and "PushedFilters: [IsNotNull(id), LessThan(id,10)]" in text
    pruned = plan(writes.read_day_range(spark, path, "day", dt.date(2024, 1, 3), dt.date(2024, 1, 4)))
    assert "PartitionFilters: [isnotnull(day" in pruned


def test_nightly_report_reads_eight_days(spark):
    stored, partitions = loaded_nights(baskets(spark, SF_DIR), "nights")
    report = checks.nightly_checks(stored.select(*[c for c, _ in CONTRACT]), partitions, CONTRACT,
                                   "sale_date", "basket_value", AS_OF, ZONE)
    report.collect()
    text = report._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert all("PartitionFilters: [isnotnull(sale_date" in line or "total_rows" in line for line in scans)
    assert any("sale_date" in line and ">= 2024-01-23" in line for line in scans)


def test_key_shares_need_no_single_partition_window(spark, sides):
    text = plan(aggregates.key_shares(sides[0], "account_id"))
    assert "Window" not in text and "Subquery" in text


def test_hot_group_is_ranked_in_many_ranges(spark):
    rows = spark.range(20000).select(F.when(F.col("id") < 0, "cold").otherwise("hot").alias("g"), F.col("id").cast("double").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = aggregates.ranked_values(rows, ["g"], "v")
        got = ranked.select(F.col("v") == F.col("before")).distinct().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [r[0] for r in got] == [True]
    text = plan(ranked)
    assert "hashpartitioning(_group" in text and "_range" in text
