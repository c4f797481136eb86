"""Inputs that the queries need, derived from the given tables.

Each input exists twice: as a DataFrame and as a SQL subquery for the check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.scalars import money
from millrace.plans.registry import table

# ---------------------------------------------------------------- store baskets
BASKETS_SQL = """(
  SELECT CAST(ts AS DATE) AS sale_date, event_type AS store_id,
         CASE user_id % 4 WHEN 0 THEN 'North' WHEN 1 THEN 'South' WHEN 2 THEN 'East' ELSE 'West' END AS region,
         'R' || lpad(CAST(user_id % 12 AS VARCHAR), 2, '0') AS register_id,
         CAST(event_id AS VARCHAR) AS basket_id,
         CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS items,
         CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END AS basket_value,
         ts AS loaded_at
  FROM events)"""


def baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id")
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("date").alias("sale_date"),
        F.col("event_type").alias("store_id"),
        F.when(user % 4 == 0, "North").when(user % 4 == 1, "South")
         .when(user % 4 == 2, "East").otherwise("West").alias("region"),
        F.format_string("R%02d", user % 12).alias("register_id"),
        F.col("event_id").cast("string").alias("basket_id"),
        F.regexp_extract("props", "[0-9]+", 0).cast("long").alias("items"),
        F.when(F.col("event_id") % 13 != 0, F.col("value")).alias("basket_value"),
        F.col("ts").alias("loaded_at"))


# ---------------------------------------------------------------- skewed trips and accounts
# Sixty per cent of the trips carry the sentinel account -1.
TRIPS_SQL = """(
  SELECT CASE WHEN l_orderkey % 10 < 6 THEN -1 ELSE l_suppkey END AS account_id,
         CAST(l_shipdate AS DATE) AS pickup_date, l_extendedprice AS fare,
         l_orderkey, l_linenumber
  FROM lineitem)"""
ACCOUNTS_SQL = """(
  SELECT -1 AS account_id, 'walk-in' AS tier
  UNION ALL
  SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 'overdrawn' WHEN s_acctbal < 5000 THEN 'regular' ELSE 'key' END
  FROM supplier)"""


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_orderkey") % 10 < 6, F.lit(-1)).otherwise(F.col("l_suppkey")).alias("account_id"),
        F.col("l_shipdate").cast("date").alias("pickup_date"),
        F.col("l_extendedprice").alias("fare"), "l_orderkey", "l_linenumber")


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tier = F.when(F.col("s_acctbal") < 0, "overdrawn").when(F.col("s_acctbal") < 5000, "regular").otherwise("key")
    known = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("account_id"), tier.alias("tier"))
    return known.unionByName(spark.createDataFrame([(-1, "walk-in")], "account_id long, tier string"))


# ---------------------------------------------------------------- point-of-sale text lines
# Planted faults: a date that is none, an amount that is none, a negative quantity, five or seven fields.
POS_SQL = """(
  SELECT event_id,
         'T-' || lpad(CAST(event_id AS VARCHAR), 9, '0') AS txn_id, event_type AS store_id,
         CASE WHEN event_id % 101 = 7 THEN '2024-01-05 25:00:00' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS txn_ts,
         'SKU-' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS sku,
         CASE WHEN event_id % 107 = 3 THEN '-17' ELSE regexp_extract(props, '[0-9]+') END AS qty,
         CASE WHEN event_id % 109 = 11 THEN NULL WHEN event_id % 103 = 5 THEN 'twelve'
              ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS amount,
         CASE WHEN event_id % 113 = 13 AND event_id % 109 <> 11 THEN 'void' END AS surplus
  FROM events)"""
POS_HEADER = "txn_id,store_id,txn_ts,sku,qty,amount"


def pos_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        event,
        F.format_string("T-%09d", event).alias("txn_id"),
        F.col("event_type").alias("store_id"),
        F.when(event % 101 == 7, "2024-01-05 25:00:00")
         .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("txn_ts"),
        F.format_string("SKU-%09d", F.col("user_id")).alias("sku"),
        F.when(event % 107 == 3, "-17").otherwise(F.regexp_extract("props", "[0-9]+", 0)).alias("qty"),
        F.when(event % 109 == 11, F.lit(None)).when(event % 103 == 5, "twelve")
         .otherwise(money("value").cast("string")).alias("amount"),
        F.when((event % 113 == 13) & (event % 109 != 11), "void").alias("surplus"))


def pos_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line_id, body): the extract as text, one CSV line a row."""
    return pos_fields(spark, sf_dir).select(
        F.col("event_id").alias("line_id"),
        F.concat_ws(",", "txn_id", "store_id", "txn_ts", "sku", "qty", "amount", "surplus").alias("body"))


# ---------------------------------------------------------------- job history
JOBS_SQL = """(
  SELECT 'job-' || CAST(o_orderkey AS VARCHAR) AS job_id,
         CASE WHEN o_orderkey % 5 IN (1, 2) THEN 'job-' || CAST(o_orderkey - o_orderkey % 5 AS VARCHAR) END AS parent_job_id,
         lower(substr(o_orderpriority, 3)) AS pipeline_label, 'r' || CAST(o_custkey % 7 AS VARCHAR) AS run_label,
         o_orderkey % 11 <> 0 AS labelled,
         CASE o_orderstatus WHEN 'F' THEN 'DELETE' WHEN 'O' THEN 'INSERT' ELSE 'SELECT' END AS statement_type,
         CASE WHEN o_orderstatus = 'F' THEN o_orderkey % 1000 ELSE 0 END AS deleted_row_count,
         CASE WHEN o_orderstatus = 'O' THEN o_custkey % 1000 ELSE 0 END AS inserted_row_count,
         CAST(round(o_totalprice) AS BIGINT) * 100 AS total_bytes_processed,
         CASE WHEN o_orderkey % 4 <> 0 THEN CAST(round(o_totalprice) AS BIGINT) * 128 END AS total_bytes_billed,
         o_orderdate + to_seconds(CAST(o_custkey % 86400 AS BIGINT)) AS start_time,
         o_orderdate + to_seconds(CAST(o_custkey % 86400 + o_orderkey % 3600 AS BIGINT)) AS end_time
  FROM orders)"""


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job history: nested labels, struct of row counts, parents and children."""
    key, cust, status = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")

    def job(c):
        return F.concat(F.lit("job-"), c.cast("string"))

    def label(name, value):
        return F.struct(F.lit(name).alias("key"), value.alias("value"))

    def at(seconds):
        return F.col("o_orderdate") + F.make_dt_interval(secs=seconds)

    labels = F.array(label("pipeline", F.lower(F.substring("o_orderpriority", 3, 99))),
                     label("run", F.concat(F.lit("r"), (cust % 7).cast("string"))))
    price = F.round("o_totalprice").cast("long")
    return table(spark, sf_dir, "orders").select(
        job(key).alias("job_id"),
        F.when((key % 5).isin(1, 2), job(key - key % 5)).alias("parent_job_id"),
        F.when(key % 11 != 0, labels).otherwise(F.array().cast("array<struct<key:string,value:string>>"))
         .alias("labels"),
        F.when(status == "F", "DELETE").when(status == "O", "INSERT").otherwise("SELECT").alias("statement_type"),
        F.struct(F.when(status == "F", key % 1000).otherwise(F.lit(0)).alias("deleted_row_count"),
                 F.when(status == "O", cust % 1000).otherwise(F.lit(0)).alias("inserted_row_count"))
         .alias("dml_statistics"),
        (price * 100).alias("total_bytes_processed"),
        F.when(key % 4 != 0, price * 128).alias("total_bytes_billed"),
        at(cust % 86400).alias("start_time"),
        at(cust % 86400 + key % 3600).alias("end_time"))


# ---------------------------------------------------------------- nightly load runs
RUNS_SQL = """(
  SELECT sale_date, 'DONE' AS state, rows_loaded,
         CAST(sale_date AS TIMESTAMP) + INTERVAL 1 DAY + INTERVAL 5 HOUR
           + to_seconds(CAST(seed % 5400 AS BIGINT)) AS finished_at,
         CASE WHEN seed % 7 = 0 THEN CAST(sale_date AS TIMESTAMP) + INTERVAL 1 DAY + INTERVAL 13 HOUR
           + INTERVAL 20 MINUTE END AS corrected_at
  FROM (SELECT CAST(o_orderdate AS DATE) AS sale_date, count(*) AS rows_loaded,
               CAST(sum(o_custkey + o_orderkey) AS BIGINT) AS seed FROM orders GROUP BY 1))"""


def load_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load a night: when it finished, and when a wrong night was put right."""
    nightly = (table(spark, sf_dir, "orders")
               .groupBy(F.col("o_orderdate").cast("date").alias("sale_date"))
               .agg(F.count(F.lit(1)).alias("rows_loaded"),
                    F.sum(F.col("o_custkey") + F.col("o_orderkey")).alias("seed")))

    def next_day(hours, mins=0, secs=F.lit(0)):
        return F.col("sale_date").cast("timestamp_ntz") + F.make_dt_interval(
            days=F.lit(1), hours=F.lit(hours), mins=F.lit(mins), secs=secs)

    return nightly.select(
        "sale_date", F.lit("DONE").alias("state"), "rows_loaded",
        next_day(5, secs=F.col("seed") % 5400).alias("finished_at"),
        F.when(F.col("seed") % 7 == 0, next_day(13, 20)).alias("corrected_at"))


def spend_sql(also: str = "TRUE") -> str:
    """Jobs and mebibytes by the pipeline label of labelled jobs that no other job started."""
    return f"""SELECT pipeline, jobs, round(processed / 1048576.0::DOUBLE, 1) AS processed_mb, round(billed / 1048576.0::DOUBLE, 1) AS billed_mb
        FROM (SELECT pipeline_label AS pipeline, count(*) AS jobs, coalesce(sum(total_bytes_billed), 0) AS billed,
                     sum(total_bytes_processed) AS processed
              FROM {JOBS_SQL} WHERE parent_job_id IS NULL AND labelled AND {also} GROUP BY pipeline_label)"""
