"""D: joins; H: set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.scalars import money_sum, month_start
from millrace.operators import joins, sets
from millrace.operators.checks import contract_diff
from millrace.plans.derived import (ACCOUNTS_SQL, BASKETS_SQL, JOBS_SQL, TRIPS_SQL, accounts, baskets, jobs, trips)
from millrace.plans.registry import query, table

BILLING_SQL = f"""SELECT tier, CAST(CAST(date_trunc('month', pickup_date) AS DATE) AS VARCHAR) AS month,
                  count(*) AS trips, CAST(round(sum(CAST(fare AS DECIMAL(28,6))), 2) AS DOUBLE) AS revenue
                  FROM {TRIPS_SQL} JOIN {ACCOUNTS_SQL} USING (account_id) GROUP BY 1, 2"""


def _billed(joined):
    return joined.groupBy("tier", month_start("pickup_date").cast("string").alias("month")).agg(
        F.count(F.lit(1)).alias("trips"), money_sum("fare").alias("revenue"))


def _sides(spark, sf_dir):
    return trips(spark, sf_dir).select("account_id", "pickup_date", "fare"), accounts(spark, sf_dir)


def _whole_rows(spark, sf_dir):
    """Trips with their unique row key: the salt is a hash of the row."""
    return trips(spark, sf_dir), accounts(spark, sf_dir)


@query(BILLING_SQL)
def d1_sort_merge_join(spark, sf_dir):
    return _billed(joins.sort_merge_join(*_sides(spark, sf_dir), "account_id"))


@query(BILLING_SQL)
def d2_broadcast_join(spark, sf_dir):
    return _billed(joins.bounded_broadcast_join(*_sides(spark, sf_dir), "account_id"))


@query(BILLING_SQL)
def d3_salted_join(spark, sf_dir):
    return _billed(joins.salted_join(*_whole_rows(spark, sf_dir), "account_id"))


@query(BILLING_SQL)
def d3_hot_salted_join(spark, sf_dir):
    return _billed(joins.hot_salted_join(*_whole_rows(spark, sf_dir), "account_id"))


@query(BILLING_SQL)
def d4_adaptive_join(spark, sf_dir):
    return _billed(joins.adaptive_join(*_sides(spark, sf_dir), "account_id"))


@query(BILLING_SQL)
def d5_join_using_in_sql(spark, sf_dir):
    fact, dim = _sides(spark, sf_dir)
    return spark.sql("""
        SELECT tier, CAST(trunc(pickup_date, 'MONTH') AS STRING) AS month, count(*) AS trips,
               CAST(round(sum(CAST(fare AS DECIMAL(28,6))), 2) AS DOUBLE) AS revenue
        FROM {fact} JOIN {dim} USING (account_id) GROUP BY ALL""", fact=fact, dim=dim)


@query("""WITH b AS (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'view' GROUP BY 1),
               p AS (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY 1)
          SELECT user_id, b.n AS views, p.n AS purchases FROM b FULL JOIN p USING (user_id)
          WHERE b.n IS DISTINCT FROM p.n""")
def d6_full_outer_difference(spark, sf_dir):
    """Users whose numbers of views and purchases differ, whichever side lacks them."""
    events = table(spark, sf_dir, "events")

    def counted(kind, name):
        return events.where(F.col("event_type") == kind).groupBy("user_id").agg(F.count(F.lit(1)).alias(name))

    return (counted("view", "views").join(counted("purchase", "purchases"), "user_id", "full")
            .where(~F.col("views").eqNullSafe(F.col("purchases"))))


@query("""SELECT 'extra c_acctbal, extra c_mktsegment, type c_nationkey, missing c_phone' AS diff, count(*) AS customers
          FROM customer""")
def d6_contract_difference(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    contract = [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "bigint"), ("c_phone", "string")]
    diff = contract_diff(customers, contract)
    return joins.side_by_side(diff, customers.agg(F.count(F.lit(1)).alias("customers")))


@query(f"""SELECT a.n AS last_n, b.n AS earlier_n FROM
           (SELECT count(*) AS n FROM {BASKETS_SQL} WHERE sale_date = DATE '2024-01-30') a,
           (SELECT count(*) AS n FROM {BASKETS_SQL} WHERE sale_date < DATE '2024-01-30') b""")
def d7_two_aggregates_side_by_side(spark, sf_dir):
    rows, day = baskets(spark, sf_dir), F.lit("2024-01-30").cast("date")
    return joins.side_by_side(
        rows.where(F.col("sale_date") == day).agg(F.count(F.lit(1)).alias("last_n")),
        rows.where(F.col("sale_date") < day).agg(F.count(F.lit(1)).alias("earlier_n")))


@query(f"""WITH j AS (SELECT * FROM {JOBS_SQL})
           SELECT o.job_id AS step_job, j.job_id, j.statement_type FROM j AS o
           JOIN j ON j.job_id = o.job_id OR j.parent_job_id = o.job_id WHERE o.parent_job_id IS NULL""")
def d8_join_on_either_key(spark, sf_dir):
    history = jobs(spark, sf_dir)
    steps = history.where("parent_job_id IS NULL").select(F.col("job_id").alias("step_job"))
    right = history.select("job_id", "parent_job_id", "statement_type")
    return (joins.either_key_join(steps, right, "step_job", ["job_id", "parent_job_id"])
            .select("step_job", "job_id", "statement_type"))


@query(f"""SELECT job_id, 'pipeline' AS label_key, pipeline_label AS label_value FROM {JOBS_SQL} WHERE labelled
           UNION ALL SELECT job_id, 'run', run_label FROM {JOBS_SQL} WHERE labelled""")
def d9_unnest_labels(spark, sf_dir):
    return joins.unnest(jobs(spark, sf_dir).select("job_id", "labels"), "labels", "label")


# ---------------------------------------------------------------- set operations
@query("""SELECT 'urgent' AS branch, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT'
          UNION ALL SELECT 'closed', count(*) FROM orders WHERE o_orderstatus = 'F'""")
def h1_labelled_union(spark, sf_dir):
    orders, one = table(spark, sf_dir, "orders"), F.count(F.lit(1)).alias("n")
    return sets.labelled_union({"urgent": orders.where("o_orderpriority = '1-URGENT'").agg(one),
                                "closed": orders.where("o_orderstatus = 'F'").agg(one)}, "branch")


@query("""SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance FROM customer
          UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier""")
def h2_union_by_name(spark, sf_dir):
    first = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    return first.unionByName(table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")))


@query(f"""SELECT r.tier, r.month, r.trips, r.revenue, 1 AS surplus FROM ({BILLING_SQL}) r WHERE tier = 'walk-in'""")
def h3_result_agreement(spark, sf_dir):
    """Two join variants agree but for the rows that were taken from one of them on purpose."""
    merged = d1_sort_merge_join(spark, sf_dir)
    salted = d3_salted_join(spark, sf_dir).where("tier <> 'walk-in'")
    return sets.disagreement(merged, salted)
