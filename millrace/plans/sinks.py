"""B: sinks and table changes; N: recovery by table version."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.functions.scalars import money_sum
from millrace.operators import writes
from millrace.operators.aggregates import count_and_sum
from millrace.operators.versions import VersionedTable, read_snapshot
from millrace.plans.derived import BASKETS_SQL, JOBS_SQL, TRIPS_SQL, baskets, jobs, trips
from millrace.plans.registry import query, table
from millrace.session import scratch_path
from millrace.sources.files import read_csv, read_partitioned

DAY = dt.date(2024, 1, 12)
T0, T1, T2, T3 = (dt.datetime(2024, 2, d, 12, 0) for d in (1, 2, 3, 4))
STATUS_SQL = """SELECT o_orderstatus, {n} AS n, CAST(round(sum(CAST(o_totalprice AS DECIMAL(28,6))), 2) * {f} AS DOUBLE) AS total
                FROM orders {w} GROUP BY 1"""


def _by_status(df):
    return df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), money_sum("o_totalprice").alias("total"))


@query(STATUS_SQL.format(n="2 * count(*)", f=2, w=""))
def b1_append_twice(spark, sf_dir):
    path = scratch_path(spark, "b1")
    for _ in range(2):
        writes.append(table(spark, sf_dir, "orders"), path)
    return _by_status(spark.read.parquet(path))


@query(STATUS_SQL.format(n="count(*)", f=1, w=""))
def b2_overwrite_twice(spark, sf_dir):
    path = scratch_path(spark, "b2")
    for _ in range(2):
        writes.overwrite(table(spark, sf_dir, "orders"), path)
    return _by_status(spark.read.parquet(path))


@query(f"""SELECT CAST(sale_date AS VARCHAR) AS sale_date, count(*) AS n FROM {BASKETS_SQL}
           WHERE (sale_date <> DATE '2024-01-12' OR store_id = 'view') AND sale_date <> DATE '2024-01-13' GROUP BY 1""")
def b3_replace_partition(spark, sf_dir):
    """One day is replaced by part of it, another by nothing."""
    path = scratch_path(spark, "b3")
    rows = baskets(spark, sf_dir)
    rows.repartitionByRange("sale_date", "basket_id").write.partitionBy("sale_date").parquet(path)
    kept = rows.where((F.col("sale_date") == F.lit(DAY)) & (F.col("store_id") == "view"))
    writes.replace_partition(kept, path, "sale_date", DAY)
    writes.replace_partition(rows.limit(0), path, "sale_date", DAY + dt.timedelta(days=1))
    return (read_partitioned(spark, path).groupBy(F.col("sale_date").cast("string").alias("sale_date"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("""SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1""")
def b5_create_table_as(spark, sf_dir):
    path = scratch_path(spark, "b5")
    table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").write.parquet(path)
    return spark.read.parquet(path).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT strftime(l_shipdate, '%Y-%m') AS ship_month, l_partkey, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS quantity,
          min(l_shipdate) AS first_shipped FROM lineitem GROUP BY 1, 2""")
def b6_partitioned_and_clustered(spark, sf_dir):
    path = scratch_path(spark, "b6")
    rows = (table(spark, sf_dir, "lineitem").select("l_shipdate", "l_partkey", "l_quantity")
            .withColumn("ship_month", F.trunc("l_shipdate", "month")))
    writes.write_partitioned(rows, path, "ship_month", ["l_partkey"])
    months = spark.read.parquet(path).agg(F.min("ship_month"), F.max("ship_month")).first()
    return (writes.read_day_range(spark, path, "ship_month", *(months if months[0] else (dt.date.min, dt.date.max)))
            .groupBy(F.date_format("ship_month", "yyyy-MM").alias("ship_month"), "l_partkey")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"), F.min("l_shipdate").alias("first_shipped")))


@query("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def b7_ordered_export(spark, sf_dir):
    path = scratch_path(spark, "b7")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    writes.export_ordered(rows, path, ["o_orderdate", "o_orderkey"])
    return spark.read.parquet(path)


@query("""SELECT o_orderpriority, count(*) AS n, CAST(round(sum(CAST(o_totalprice AS DECIMAL(28,6))), 2) AS DOUBLE) AS total
          FROM orders GROUP BY 1""")
def b8_rollup_csv(spark, sf_dir):
    path = scratch_path(spark, "b8")
    writes.export_rollup_csv(count_and_sum(table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice"), path)
    return read_csv(spark, path, "o_orderpriority string, n long, total double")


# ---------------------------------------------------------------- versioned tables
def _versioned(spark, sf_dir, label):
    """Baskets by day at T0."""
    held = VersionedTable(spark, scratch_path(spark, label), "sale_date")
    held.create(baskets(spark, sf_dir), T0)
    return held


def _per_day(df):
    return df.groupBy(F.col("sale_date").cast("string").alias("sale_date")).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("items"), F.lit(0)).alias("items"))


PER_DAY_SQL = f"""SELECT CAST(sale_date AS VARCHAR) AS sale_date, count(*) AS n,
                  CAST(coalesce(sum(items), 0) AS BIGINT) AS items FROM {BASKETS_SQL} {{w}} GROUP BY 1"""


@query(f"SELECT sale_date, store_id, region, register_id, basket_id, basket_value FROM {BASKETS_SQL}")
def b13_drop_column(spark, sf_dir):
    held = _versioned(spark, sf_dir, "b13")
    held.drop_column("items", T1)
    held.drop_column("loaded_at", T2)
    return held.latest()


@query(PER_DAY_SQL.format(w="WHERE NOT coalesce(basket_value > 100, FALSE)"))
def b14_delete_where(spark, sf_dir):
    """Rows without a value stay, as in SQL."""
    held = _versioned(spark, sf_dir, "b14")
    held.delete_where(F.col("basket_value") > 100, T1)
    return _per_day(held.latest())


@query(f"""SELECT CAST(sale_date AS VARCHAR) AS sale_date, sum(n)::BIGINT AS n, sum(items)::BIGINT AS items FROM (
           {PER_DAY_SQL.format(w="")} UNION ALL {PER_DAY_SQL.format(w="WHERE store_id = 'view'")}) GROUP BY 1""")
def b15_insert_select(spark, sf_dir):
    held = _versioned(spark, sf_dir, "b15")
    held.insert(baskets(spark, sf_dir).where("store_id = 'view'"), T1)
    return _per_day(held.latest())


@query(PER_DAY_SQL.format(w=""))
def a13_n1_read_as_of(spark, sf_dir):
    """The state before a mistaken delete."""
    held = _versioned(spark, sf_dir, "n1")
    held.delete_where(F.col("sale_date") == F.lit(DAY), T2)
    return _per_day(held.as_of(T1))


@query(PER_DAY_SQL.format(w=""))
def n2_restore_partition(spark, sf_dir):
    held = _versioned(spark, sf_dir, "n2")
    held.delete_where(F.col("sale_date") == F.lit(DAY), T1)
    held.restore_partition(DAY, T0, T2)
    return _per_day(held.latest())


@query(f"""WITH work AS (
       SELECT coalesce(parent_job_id, job_id) AS step_job,
              max(pipeline_label) FILTER (WHERE parent_job_id IS NULL AND labelled AND run_label = 'r3') AS step,
              max(end_time) FILTER (WHERE parent_job_id IS NULL AND labelled AND run_label = 'r3') AS step_end,
              coalesce(sum(deleted_row_count) FILTER (WHERE statement_type = 'DELETE'), 0)::BIGINT AS deleted,
              coalesce(sum(inserted_row_count) FILTER (WHERE statement_type = 'INSERT'), 0)::BIGINT AS inserted
       FROM {JOBS_SQL} GROUP BY 1)
     SELECT step_job, step, strftime(step_end, '%H:%M:%S') AS finished_utc, deleted, inserted,
            date_diff('second', min(step_end) OVER (), step_end) AS s_after_first FROM work WHERE step_end IS NOT NULL""")
def n3_recovery_report(spark, sf_dir):
    from millrace.operators.job_history import recovery_report
    return recovery_report(jobs(spark, sf_dir), run="r3")


@query(PER_DAY_SQL.format(w=""))
def n4_snapshot_with_expiry(spark, sf_dir):
    held = _versioned(spark, sf_dir, "n4")
    target = scratch_path(spark, "n4-copy")
    held.snapshot(target, dt.date(2024, 3, 1))
    held.delete_where(F.col("store_id") == "view", T1)
    return _per_day(read_snapshot(spark, target, dt.date(2024, 2, 29)))


@query(f"""SELECT account_id, count(*) AS n FROM {TRIPS_SQL} GROUP BY 1""")
def n5_restore_overwritten(spark, sf_dir):
    """A whole table overwritten by nothing comes back from the earlier version."""
    held = VersionedTable(spark, scratch_path(spark, "n5"))
    rows = trips(spark, sf_dir)
    held.create(rows, T0)
    held.overwrite(rows.limit(0), T1)
    held.restore_version(1, T2)
    return held.latest().groupBy("account_id").agg(F.count(F.lit(1)).alias("n"))
