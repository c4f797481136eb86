"""E: aggregations; F: windows; G: orders and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.scalars import money_mean, money_sum, month_start
from millrace.operators import aggregates as A, writes
from millrace.operators.job_history import spend_by_label
from millrace.plans.derived import BASKETS_SQL, JOBS_SQL, TRIPS_SQL, baskets, jobs, spend_sql, trips
from millrace.plans.registry import query, table
from millrace.session import scratch_path


@query("""SELECT o_orderpriority, count(*) AS n, CAST(round(sum(CAST(o_totalprice AS DECIMAL(28,6))), 2) AS DOUBLE) AS total
          FROM orders GROUP BY 1""")
def e1_count_and_sum(spark, sf_dir):
    return A.count_and_sum(table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice")


@query("""SELECT c_mktsegment AS segment, CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month,
          count(*) AS items, CAST(round(sum(CAST(l_extendedprice AS DECIMAL(28,6))), 2) AS DOUBLE) AS revenue
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
          GROUP BY 1, 2""")
def e2_revenue_by_segment_month(spark, sf_dir):
    """The flagship. Each side is added up to its join key before it is shuffled to the join.

    Items are summed by order and then by customer and month, so neither a hot order
    nor a hot customer sends more than a few rows into one task.
    """
    cents = F.sum(F.col("l_extendedprice").cast("decimal(18,2)"))
    items = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("items"), cents.alias("revenue"))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", month_start("o_orderdate").alias("month"))
    by_customer = (orders.join(items, orders.o_orderkey == items.l_orderkey)
                   .groupBy("o_custkey", "month")
                   .agg(F.sum("items").alias("items"), F.sum("revenue").alias("revenue")))
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    return (by_customer.join(customers, by_customer.o_custkey == customers.c_custkey)
            .groupBy("segment", F.col("month").cast("string").alias("month"))
            .agg(F.sum("items").alias("items"), F.sum("revenue").cast("double").alias("revenue")))


@query("""SELECT l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(28,6))) AS DOUBLE) / count(*) AS mean_price
          FROM lineitem GROUP BY 1""")
def e3_average(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        money_mean("l_extendedprice").alias("mean_price"))


@query("""SELECT o_orderpriority, count(*) FILTER (WHERE o_totalprice > 250000) AS large FROM orders GROUP BY 1""")
def e4_conditional_count(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(
        F.count_if(F.col("o_totalprice") > 250000).alias("large"))


@query(f"""SELECT region, count(*) FILTER (WHERE basket_value IS NULL)::DOUBLE / count(*) AS null_rate
           FROM {BASKETS_SQL} GROUP BY 1""")
def e5_rate(spark, sf_dir):
    return baskets(spark, sf_dir).groupBy("region").agg(
        (F.count_if(F.col("basket_value").isNull()) / F.count(F.lit(1))).alias("null_rate"))


@query(f"""SELECT run_label AS run, CAST(sum(CASE WHEN statement_type = 'DELETE' THEN deleted_row_count ELSE 0 END) AS BIGINT) AS deleted,
           CAST(sum(CASE WHEN statement_type = 'INSERT' THEN inserted_row_count ELSE 0 END) AS BIGINT) AS inserted
           FROM {JOBS_SQL} WHERE labelled GROUP BY 1""")
def e6_conditional_sum(spark, sf_dir):
    from millrace.operators.job_history import label_value
    kind, stats = F.col("statement_type"), F.col("dml_statistics")
    return (jobs(spark, sf_dir).withColumn("run", label_value("run")).where("run IS NOT NULL")
            .groupBy("run").agg(
                F.sum(F.when(kind == "DELETE", stats["deleted_row_count"]).otherwise(0)).alias("deleted"),
                F.sum(F.when(kind == "INSERT", stats["inserted_row_count"]).otherwise(0)).alias("inserted")))


@query("""SELECT l_returnflag, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1""")
def e7_distinct_count(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"))


@query("""SELECT o_orderstatus, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities
          FROM orders GROUP BY 1""")
def e8_ordered_distinct_text(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(
        A.ordered_distinct_text("o_orderpriority").alias("priorities"))


@query("""SELECT o_orderstatus, string_agg(DISTINCT CASE WHEN o_totalprice > 480000 AND o_orderstatus = 'F'
            THEN 'large ' || o_orderpriority END, ', ' ORDER BY CASE WHEN o_totalprice > 480000 AND o_orderstatus = 'F'
            THEN 'large ' || o_orderpriority END) AS remarks FROM orders GROUP BY 1""")
def e9_text_of_case(spark, sf_dir):
    """Remarks in order; a status without any shows NULL."""
    remark = F.when((F.col("o_totalprice") > 480000) & (F.col("o_orderstatus") == "F"),
                    F.concat(F.lit("large "), F.col("o_orderpriority")))
    return (table(spark, sf_dir, "orders").withColumn("remark", remark).groupBy("o_orderstatus")
            .agg(A.ordered_distinct_text("remark", ", ").alias("remarks")))


@query(f"""SELECT store_id, count(DISTINCT (sale_date, region)) AS store_days,
           count(DISTINCT (sale_date, region, basket_id)) AS baskets,
           CAST(round(sum(CAST(basket_value AS DECIMAL(28,6))), 2) AS DOUBLE) AS sales FROM {BASKETS_SQL} GROUP BY store_id""")
def e10_two_level_aggregate(spark, sf_dir):
    daily = baskets(spark, sf_dir).groupBy("sale_date", "store_id", "region").agg(
        F.count_distinct("basket_id").alias("baskets"),
        F.sum(F.col("basket_value").cast("decimal(18,2)")).alias("sales"))
    return daily.groupBy("store_id").agg(F.count(F.lit(1)).alias("store_days"), F.sum("baskets").alias("baskets"),
                                         F.sum("sales").cast("double").alias("sales"))


@query("""SELECT event_type, min(value) AS low, max(value) AS high, max(ts) AS last FROM events GROUP BY 1""")
def e11_min_max(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.max("ts").alias("last"))


@query("""SELECT 'global' AS kind, count(*) AS n FROM orders WHERE o_totalprice < 0
          UNION ALL SELECT 'grouped', count(*) FROM orders WHERE o_totalprice < 0 GROUP BY o_orderstatus""")
def e12_aggregate_over_nothing(spark, sf_dir):
    """Without rows a global aggregate gives one row and a grouped one none."""
    none, one = table(spark, sf_dir, "orders").where("o_totalprice < 0"), F.count(F.lit(1)).alias("n")
    return (none.agg(one).select(F.lit("global").alias("kind"), "n")
            .unionByName(none.groupBy("o_orderstatus").agg(one).select(F.lit("grouped").alias("kind"), "n")))


@query("""SELECT l_orderkey, count(*) AS times FROM lineitem GROUP BY 1 HAVING count(*) > 1
          ORDER BY times DESC, l_orderkey LIMIT 5""")
def e13_duplicate_keys(spark, sf_dir):
    return A.duplicate_keys(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query(f"""SELECT region, count(*) FILTER (WHERE basket_value IS NULL) AS nulls,
           CAST(sum(CAST(basket_value AS DECIMAL(28,6))) AS DOUBLE) / count(basket_value) AS mean_value
           FROM (SELECT region, CASE WHEN region = 'North' THEN NULL ELSE basket_value END AS basket_value
                 FROM {BASKETS_SQL}) GROUP BY 1""")
def e14_null_profile(spark, sf_dir):
    """One region has no value at all: its mean is NULL."""
    rows = baskets(spark, sf_dir).withColumn("basket_value", F.when(F.col("region") != "North", F.col("basket_value")))
    return rows.groupBy("region").agg(F.count_if(F.col("basket_value").isNull()).alias("nulls"),
                                      money_mean("basket_value").alias("mean_value"))


@query(f"""SELECT account_id, count(*) AS n, count(*) / CAST((SELECT count(*) FROM {TRIPS_SQL}) AS DOUBLE) AS share
           FROM {TRIPS_SQL} GROUP BY 1 ORDER BY n DESC, account_id LIMIT 5""")
def e15_key_skew(spark, sf_dir):
    return A.key_shares(trips(spark, sf_dir), "account_id", top=5)


@query(spend_sql())
def e16_totals_by_label(spark, sf_dir):
    return spend_by_label(jobs(spark, sf_dir), "pipeline")


QUARTILE_SQL = """
  SELECT {g}, n, v[1] AS "min", (v[j1] * (4 - (m - j1 * 4)) + v[j1 + 1] * (m - j1 * 4)) / 4 AS p25,
         (v[j2] * (4 - (2 * m - j2 * 4)) + v[j2 + 1] * (2 * m - j2 * 4)) / 4 AS median,
         (v[j3] * (4 - (3 * m - j3 * 4)) + v[j3 + 1] * (3 * m - j3 * 4)) / 4 AS p75, v[n] AS "max"
  FROM (SELECT *, greatest(1, least(m // 4, n - 1)) AS j1, greatest(1, least(2 * m // 4, n - 1)) AS j2,
               greatest(1, least(3 * m // 4, n - 1)) AS j3
        FROM (SELECT {g}, list({v} ORDER BY {v}) AS v, count(*) AS n, count(*) + 1 AS m FROM {t} GROUP BY {g}))"""


@query(QUARTILE_SQL.format(g="l_returnflag", v="l_extendedprice", t="lineitem"))
def e17_exclusive_quartiles(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    return A.exclusive_quartiles(rows, ["l_returnflag"], "l_extendedprice")


@query("""SELECT o_custkey, o_totalprice, o_orderkey, o_orderstatus FROM (
            SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders)
          WHERE r = 1""")
def e18_row_of_largest(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderkey", "o_orderstatus")
    return A.row_of_largest(rows, ["o_custkey"], "o_totalprice", ["o_orderkey"])


# ---------------------------------------------------------------- windows
@query(f"""SELECT account_id, count(*) AS n, count(*) / CAST((SELECT count(*) FROM {TRIPS_SQL}) AS DOUBLE) AS share
           FROM {TRIPS_SQL} GROUP BY 1""")
def f1_share_of_total(spark, sf_dir):
    return A.key_shares(trips(spark, sf_dir), "account_id")


@query("""SELECT event_id, CAST(date_sub('second', (SELECT min(ts) FROM events), ts) AS BIGINT) AS seconds FROM events""")
def f2_offset_from_first(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    first = events.agg(F.min("ts"))
    return events.select("event_id", F.timestamp_diff("SECOND", first.scalar(), F.col("ts")).alias("seconds"))


@query(f"""WITH d AS (SELECT store_id, sale_date, count(*) AS n FROM {BASKETS_SQL} GROUP BY 1, 2)
           SELECT store_id, CAST(sale_date AS VARCHAR) AS sale_date, n,
                  avg(n) OVER (PARTITION BY store_id ORDER BY sale_date
                    RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS trailing_mean FROM d""")
def f3_trailing_week_mean(spark, sf_dir):
    daily = baskets(spark, sf_dir).groupBy("store_id", "sale_date").agg(F.count(F.lit(1)).alias("n"))
    return (A.trailing_mean(daily, ["store_id"], "sale_date", "n")
            .withColumn("sale_date", F.col("sale_date").cast("string")))


# ---------------------------------------------------------------- orders and limits
@query("""SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey""")
def g1_total_order(spark, sf_dir):
    return (table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
            .orderBy("o_orderdate", "o_orderkey"))


@query("""SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 5""")
def g2_top_with_tie_break(spark, sf_dir):
    return (table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
            .orderBy(F.desc("c_acctbal"), "c_custkey").limit(5))


@query("SELECT * FROM orders ORDER BY o_orderkey LIMIT 10")
def g3_plain_limit(spark, sf_dir):
    return table(spark, sf_dir, "orders").orderBy("o_orderkey").limit(10)


@query("""SELECT o_orderpriority, count(*) AS n, CAST(round(sum(CAST(o_totalprice AS DECIMAL(28,6))), 2) AS DOUBLE) AS total
          FROM orders GROUP BY 1""")
def g4_sorted_files(spark, sf_dir):
    """Rows stored in key order inside their files, read back by key."""
    path = scratch_path(spark, "g4")
    writes.write_partitioned(table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice"),
                             path, "o_orderpriority", ["o_orderkey"])
    return spark.read.parquet(path).groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), money_sum("o_totalprice").alias("total"))
