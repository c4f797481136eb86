"""C: projections and filters; I: scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.operators import writes
from millrace.operators.ingest import POS_RECIPE, parse_lines, without_header
from millrace.operators.job_history import has_label
from millrace.plans.derived import BASKETS_SQL, JOBS_SQL, POS_SQL, RUNS_SQL, baskets, jobs, load_runs, pos_fields
from millrace.plans.registry import query, table
from millrace.plans.scans import baskets_by_day
from millrace.session import scratch_path
from millrace.sources.files import read_partitioned

TODAY = dt.date(2024, 1, 31)


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def c1_projection(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("SELECT * EXCLUDE (c_name, c_acctbal) FROM customer")
def c2_all_except(spark, sf_dir):
    return table(spark, sf_dir, "customer").drop("c_name", "c_acctbal")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem
          WHERE l_shipdate >= TIMESTAMP '1997-03-03' AND l_shipdate < TIMESTAMP '1997-06-10' AND l_returnflag = 'R'""")
def c3_half_open_range(spark, sf_dir):
    ship = F.col("l_shipdate")
    return (table(spark, sf_dir, "lineitem")
            .where((ship >= F.lit(dt.datetime(1997, 3, 3)).cast("timestamp_ntz"))
                   & (ship < F.lit(dt.datetime(1997, 6, 10)).cast("timestamp_ntz")) & (F.col("l_returnflag") == "R"))
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"))


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")
def c4_in_list(spark, sf_dir):
    return (table(spark, sf_dir, "orders").where(F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))
            .select("o_orderkey", "o_orderpriority"))


@query("""SELECT o_orderkey, o_totalprice FROM orders
          WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31'""")
def c5_between_dates(spark, sf_dir):
    low, high = (F.lit(dt.datetime(1997, m, d)).cast("timestamp_ntz") for m, d in ((1, 1), (12, 31)))
    return (table(spark, sf_dir, "orders").where(F.col("o_orderdate").between(low, high))
            .select("o_orderkey", "o_totalprice"))


@query(f"""SELECT store_id, count(*) FILTER (WHERE basket_value IS NULL) AS without_value,
           count(*) FILTER (WHERE basket_value IS NOT NULL) AS with_value FROM {BASKETS_SQL} GROUP BY 1""")
def c6_null_tests(spark, sf_dir):
    return baskets(spark, sf_dir).groupBy("store_id").agg(
        F.count_if(F.col("basket_value").isNull()).alias("without_value"),
        F.count_if(F.col("basket_value").isNotNull()).alias("with_value"))


@query("""SELECT event_id, event_type FROM events
          WHERE strftime(ts, '%H:%M:%S') > '18:00:00' OR event_type = 'error'""")
def c7_time_of_day(spark, sf_dir):
    return (table(spark, sf_dir, "events")
            .where((S.clock("ts") > "18:00:00") | (F.col("event_type") == "error"))
            .select("event_id", "event_type"))


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) = 1998")
def c8_year_of_date(spark, sf_dir):
    return (table(spark, sf_dir, "orders").where(F.year("o_orderdate") == 1998)
            .select("o_orderkey", "o_orderdate"))


WEEK_SQL = f"""SELECT store_id, count(*) AS n, CAST(sum(items) AS BIGINT) AS items FROM {BASKETS_SQL}
               WHERE date_diff('day', sale_date, DATE '2024-01-31') BETWEEN 1 AND 7 GROUP BY 1"""


def _by_store(df):
    return df.groupBy("store_id").agg(F.count(F.lit(1)).alias("n"), F.sum("items").alias("items"))


@query(WEEK_SQL)
def c9_last_week_by_difference(spark, sf_dir):
    """The predicate as the dashboard had it: a function of the partition column."""
    days = read_partitioned(spark, baskets_by_day(spark, sf_dir, "c9a"))
    return _by_store(days.where(F.datediff(F.lit(TODAY), "sale_date").between(1, 7)))


@query(WEEK_SQL)
def c9_last_week_by_range(spark, sf_dir):
    """The same week as a plain range of the partition column."""
    days = read_partitioned(spark, baskets_by_day(spark, sf_dir, "c9b"))
    return _by_store(days.where(S.last_n_days("sale_date", 7, TODAY)))


@query(f"""SELECT store_id, count(*) AS n, CAST(sum(items) AS BIGINT) AS items FROM {BASKETS_SQL}
           WHERE sale_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-19' GROUP BY 1""")
def c10_required_partition_range(spark, sf_dir):
    path = baskets_by_day(spark, sf_dir, "c10")
    return _by_store(writes.read_day_range(spark, path, "sale_date", dt.date(2024, 1, 10), dt.date(2024, 1, 19)))


@query("SELECT p_partkey, p_name FROM part WHERE starts_with(p_name, 'small')")
def c11_prefix(spark, sf_dir):
    return table(spark, sf_dir, "part").where(F.col("p_name").startswith("small")).select("p_partkey", "p_name")


@query(f"""SELECT job_id, statement_type FROM {JOBS_SQL} WHERE labelled AND run_label = 'r3'""")
def c12_any_label(spark, sf_dir):
    return jobs(spark, sf_dir).where(has_label("run", "r3")).select("job_id", "statement_type")


POS_TYPED_SQL = f"""SELECT txn_id, store_id, try_strptime(txn_ts, '%Y-%m-%d %H:%M:%S') AS txn_ts, sku,
                    CAST(qty AS INTEGER) AS qty, TRY_CAST(amount AS DOUBLE) AS amount FROM {POS_SQL}"""


@query(POS_TYPED_SQL)
def c13_c14_wrangling_recipe(spark, sf_dir):
    """CSV files with a header each, read as text: header dropped, fields split, named and typed."""
    path = scratch_path(spark, "c13")
    pos_fields(spark, sf_dir).drop("event_id", "surplus").write.option("header", True).csv(path)
    lines = spark.read.text(path).withColumnRenamed("value", "body")
    return parse_lines(without_header(lines, POS_RECIPE), POS_RECIPE).select(*POS_RECIPE.names)


@query(f"SELECT basket_id, basket_value FROM {BASKETS_SQL} WHERE basket_value IS NOT NULL")
def c15_drop_incomplete(spark, sf_dir):
    return baskets(spark, sf_dir).select("basket_id", "basket_value").dropna()


@query("""SELECT o_orderkey, CASE WHEN o_totalprice >= 300000 THEN 'large' WHEN o_totalprice >= 100000 THEN 'middle'
          ELSE 'small' END AS size, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS closed FROM orders""")
def c16_case(spark, sf_dir):
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(price >= 300000, "large").when(price >= 100000, "middle").otherwise("small").alias("size"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("closed"))


# ---------------------------------------------------------------- scalar functions
@query("""SELECT l_orderkey, l_linenumber, round(l_extendedprice, 1) AS rounded, abs(l_discount - l_tax) AS distance,
          pow(2, l_linenumber) AS power, CAST(l_quantity AS DOUBLE) / nullif(l_tax, 0) AS ratio FROM lineitem""")
def i_numbers(spark, sf_dir):
    """round, abs, pow, safe division."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round("l_extendedprice", 1).alias("rounded"),
        F.abs(F.col("l_discount") - F.col("l_tax")).alias("distance"),
        F.pow(F.lit(2), F.col("l_linenumber")).alias("power"),
        F.try_divide("l_quantity", "l_tax").alias("ratio"))


@query("""SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - 8 AS VARCHAR) AS week_before,
          CAST(CAST(o_orderdate AS DATE) + 30 AS VARCHAR) AS month_after,
          CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS age,
          CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month,
          CAST(year(o_orderdate) AS BIGINT) AS year,
          CAST(CAST(strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d') AS DATE) AS VARCHAR) AS parsed FROM orders""")
def i_dates(spark, sf_dir):
    """Date arithmetic, truncation to a DATE, date parts, parsing by pattern."""
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_sub(day, 8).cast("string").alias("week_before"),
        F.date_add(day, 30).cast("string").alias("month_after"),
        F.datediff(day, F.lit(dt.date(1995, 1, 1))).cast("long").alias("age"),
        S.month_start("o_orderdate").cast("string").alias("month"),
        F.year("o_orderdate").cast("long").alias("year"),
        F.to_date(F.date_format("o_orderdate", "yyyyMMdd"), "yyyyMMdd").cast("string").alias("parsed"))


@query("""SELECT event_id, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS minute,
          strftime(ts, '%H:%M:%S') AS clock, strftime(ts - INTERVAL 31 MINUTE, '%Y-%m-%d %H:%M:%S') AS before,
          strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS later,
          CAST(date_diff('minute', TIMESTAMP '2024-01-01 00:00:59', ts) AS BIGINT) AS minute_marks,
          CAST(date_sub('hour', TIMESTAMP '2024-01-01 00:00:00', ts) AS BIGINT) AS whole_hours,
          CAST(CAST(ts - INTERVAL 5 HOUR AS DATE) AS VARCHAR) AS local_day,
          strftime(CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S') AS six_oclock FROM events""")
def i_times(spark, sf_dir):
    """Truncation, clock text, intervals, minute marks against whole hours, local day, day at a time."""
    ts = F.col("ts")
    zero = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")
    near = F.lit(dt.datetime(2024, 1, 1, 0, 0, 59)).cast("timestamp_ntz")

    def text(c):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss")

    return table(spark, sf_dir, "events").select(
        "event_id", text(F.date_trunc("minute", ts)).alias("minute"), S.clock(ts).alias("clock"),
        text(ts - F.make_dt_interval(mins=F.lit(31))).alias("before"),
        text(ts + F.make_dt_interval(hours=F.lit(2))).alias("later"),
        S.boundary_minutes(ts, near).alias("minute_marks"),
        F.timestamp_diff("HOUR", zero, ts).alias("whole_hours"),
        S.local_date(ts.cast("timestamp"), "America/New_York").cast("string").alias("local_day"),
        text(S.on_day_at(ts.cast("date"), 6)).alias("six_oclock"))


@query(f"""SELECT CAST(sale_date AS VARCHAR) AS sale_date,
           CASE WHEN corrected_at IS NULL THEN NULL
                ELSE strftime(greatest(finished_at, corrected_at), '%Y-%m-%d %H:%M:%S') END AS latest,
           coalesce(strftime(corrected_at, '%H:%M:%S'), 'never') AS corrected,
           printf('%d rows, %.1f%%', rows_loaded, 100.0 * rows_loaded / 7) AS shown,
           'night ' || CAST(sale_date AS VARCHAR) LIKE '%-01-0_' AS early FROM {RUNS_SQL}""")
def i_nulls_and_text(spark, sf_dir):
    """NULL-propagating greatest, defaults, formatted text, concatenation and LIKE."""
    text = F.date_format(S.greatest_strict("finished_at", "corrected_at"), "yyyy-MM-dd HH:mm:ss")
    return load_runs(spark, sf_dir).select(
        F.col("sale_date").cast("string").alias("sale_date"), text.alias("latest"),
        F.coalesce(S.clock("corrected_at"), F.lit("never")).alias("corrected"),
        S.text_or_null("%d rows, %.1f%%", F.col("rows_loaded"), F.lit(100.0) * F.col("rows_loaded") / 7)
         .alias("shown"),
        F.concat(F.lit("night "), F.col("sale_date").cast("string")).like("%-01-0_").alias("early"))


@query(f"""SELECT event_id, TRY_CAST(amount AS DOUBLE) AS amount, CAST(qty AS INTEGER) AS qty,
           strftime(try_strptime(txn_ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS at FROM {POS_SQL}""")
def i_guarded_casts(spark, sf_dir):
    """Text to number and to time, NULL on failure."""
    return pos_fields(spark, sf_dir).select(
        "event_id", S.safe_double("amount").alias("amount"), S.safe_int("qty").alias("qty"),
        F.date_format(S.safe_timestamp("txn_ts"), "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("""SELECT event_id, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k,
          CAST(NULL AS VARCHAR) AS missing, 'A' || lpad(CAST(user_id % 100000 AS VARCHAR), 5, '0') AS account,
          CASE event_id % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'middle' ELSE 'high' END AS tier FROM events""")
def i_json_and_arrays(spark, sf_dir):
    """A JSON body with a missing key, padded numbers, an element of an array."""
    body = F.from_json("props", "k long, missing string")
    tiers = F.array(F.lit("low"), F.lit("middle"), F.lit("high"))
    return (table(spark, sf_dir, "events").withColumn("body", body)
            .select("event_id", "body.k", "body.missing",
                    F.format_string("A%05d", F.col("user_id") % 100000).alias("account"),
                    F.element_at(tiers, (F.col("event_id") % 3 + 1).cast("int")).alias("tier")))
