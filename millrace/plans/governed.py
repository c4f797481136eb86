"""L: governed reads; M: scan-cost reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.scalars import money_sum
from millrace.operators import scan_cost as C
from millrace.operators.governance import AccessDenied, ColumnTag, RowPolicy, governed_read
from millrace.operators.job_history import spend_by_label
from millrace.operators.sets import labelled_union
from millrace.plans.derived import BASKETS_SQL, baskets, jobs, spend_sql
from millrace.plans.registry import query, table
from millrace.plans.scans import baskets_by_day
from millrace.session import scratch_path
from millrace.sources.files import read_partitioned

POLICIES = (RowPolicy("l_returnflag = 'R'", ("analyst",)),
            RowPolicy("l_returnflag = 'A' AND l_linestatus = 'F'", ("analyst", "auditor")),
            RowPolicy("TRUE", ("controller",)))
PERSONAL = (ColumnTag(("c_name", "c_acctbal"), readers=("controller",)),)


@query("""SELECT 'analyst' AS principal, l_returnflag, count(*) AS n FROM lineitem
            WHERE l_returnflag = 'R' OR (l_returnflag = 'A' AND l_linestatus = 'F') GROUP BY 2
          UNION ALL SELECT 'auditor', l_returnflag, count(*) FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'F' GROUP BY 2
          UNION ALL SELECT 'controller', l_returnflag, count(*) FROM lineitem GROUP BY 2""")
def l1_row_policies(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    return labelled_union({p: governed_read(rows, p, POLICIES).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
                           for p in ("analyst", "auditor", "controller", "owner")}, "principal")


@query("""SELECT 'owner' AS principal, 0 AS n UNION ALL SELECT 'anyone, without policies', count(*) FROM lineitem""")
def l1_default_deny(spark, sf_dir):
    rows, one = table(spark, sf_dir, "lineitem"), F.count(F.lit(1)).alias("n")
    return labelled_union({"owner": governed_read(rows, "owner", POLICIES).agg(one),
                           "anyone, without policies": governed_read(rows, "owner").agg(one)}, "principal")


@query("SELECT c_custkey, sha256(c_name) AS c_name, sha256(CAST(c_acctbal AS VARCHAR)) AS c_acctbal, c_nationkey, c_mktsegment FROM customer")
def l2_masked_columns(spark, sf_dir):
    return governed_read(table(spark, sf_dir, "customer"), "analyst", tags=PERSONAL, denied="hash")


@query("SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def l2_denied_columns_dropped(spark, sf_dir):
    return governed_read(table(spark, sf_dir, "customer"), "analyst", tags=PERSONAL, denied="drop")


@query("""SELECT 'analyst' AS principal, c_mktsegment, count(*) AS n, NULL::BIGINT AS balances,
            'analyst may not read c_acctbal; select the table without them' AS refused FROM customer GROUP BY 2
          UNION ALL SELECT 'controller', c_mktsegment, count(*), count(c_acctbal), NULL FROM customer GROUP BY 2""")
def l2_denied_columns_refused(spark, sf_dir):
    """A read of a denied column is refused with its name; the table without it can be read."""
    rows, seen = table(spark, sf_dir, "customer"), {}
    for principal in ("analyst", "controller"):
        refused = None
        try:
            read = governed_read(rows, principal, tags=PERSONAL, columns=["c_mktsegment", "c_acctbal"])
        except AccessDenied as denied:
            refused = str(denied)
            read = governed_read(rows, principal, tags=PERSONAL, columns=["c_mktsegment"])
        balances = F.count("c_acctbal") if refused is None else F.lit(None).cast("long")
        seen[principal] = read.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), balances.alias("balances")).withColumn(
            "refused", F.lit(refused).cast("string"))
    return labelled_union(seen, "principal")


@query("""SELECT c_nationkey, count(*) AS n, CAST(round(sum(CAST(c_acctbal AS DECIMAL(28,6))), 2) AS DOUBLE) AS balance FROM customer
          GROUP BY 1 ORDER BY balance DESC, c_nationkey LIMIT 5""")
def l3_curated_projection(spark, sf_dir):
    """An aggregate without personal data, next to the raw table."""
    curated = table(spark, sf_dir, "customer").select("c_nationkey", "c_acctbal")
    return (curated.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), money_sum("c_acctbal").alias("balance"))
            .orderBy(F.desc("balance"), "c_nationkey").limit(5))


# ---------------------------------------------------------------- scan cost
@query("""SELECT 'o_orderkey' AS column_name, 8 * count(o_orderkey) AS scan_bytes FROM orders
          UNION ALL SELECT 'o_custkey', 8 * count(o_custkey) FROM orders
          UNION ALL SELECT 'o_orderstatus', CAST(sum(2 + strlen(o_orderstatus)) AS BIGINT) FROM orders
          UNION ALL SELECT 'o_totalprice', 8 * count(o_totalprice) FROM orders
          UNION ALL SELECT 'o_orderdate', 8 * count(o_orderdate) FROM orders
          UNION ALL SELECT 'o_orderpriority', CAST(sum(2 + strlen(o_orderpriority)) AS BIGINT) FROM orders""")
def m1_bytes_by_column(spark, sf_dir):
    return C.bytes_by_column(table(spark, sf_dir, "orders"))


@query(f"""SELECT CAST(sale_date AS VARCHAR) AS sale_date, count(*) AS row_count,
           CAST(sum(2 + strlen(store_id) + CASE WHEN basket_value IS NULL THEN 0 ELSE 8 END) AS BIGINT) AS scan_bytes
           FROM {BASKETS_SQL} WHERE sale_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14' GROUP BY 1""")
def m2_bytes_of_kept_days(spark, sf_dir):
    days = read_partitioned(spark, baskets_by_day(spark, sf_dir, "m2"))
    kept = days.where(F.col("sale_date").between(F.lit("2024-01-08").cast("date"), F.lit("2024-01-14").cast("date")))
    return C.scanned_bytes(kept, ["store_id", "basket_value"],
                           by=[F.col("sale_date").cast("string").alias("sale_date")])


BILLED_SQL = """SELECT 'lineitem' AS source, 40 * count(*) AS scan_bytes FROM lineitem
                UNION ALL SELECT 'orders', 24 * count(*) FROM orders
                UNION ALL SELECT 'part', CAST(sum(2 + strlen(p_name)) AS BIGINT) FROM part"""
READ = {"lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"],
        "orders": ["o_orderkey", "o_custkey", "o_totalprice"], "part": ["p_name"]}


def _scans(spark, sf_dir):
    return labelled_union({t: C.scanned_bytes(table(spark, sf_dir, t), c).drop("row_count")
                           for t, c in READ.items()}, "source")


@query("SELECT 8 * count(*) AS column_bytes, TRUE AS csv_reads_more, TRUE AS parquet_is_smaller FROM lineitem")
def m6_csv_against_parquet(spark, sf_dir):
    """A one-column mean reads the whole CSV file, but only one column of the Parquet."""
    rows = table(spark, sf_dir, "lineitem")
    csv, parquet = scratch_path(spark, "m6-csv"), scratch_path(spark, "m6-parquet")
    rows.write.option("header", True).csv(csv)
    rows.write.parquet(parquet)
    sizes = labelled_union({
        "csv": C.stored_file_bytes(spark, csv).agg(F.sum("file_bytes").alias("bytes")),
        "parquet": C.stored_file_bytes(spark, parquet).agg(F.sum("file_bytes").alias("bytes")),
        "column": C.scanned_bytes(spark.read.parquet(parquet), ["l_extendedprice"])
                   .select(F.col("scan_bytes").alias("bytes"))}, "read")

    def of(read):
        return F.sum(F.when(F.col("read") == read, F.col("bytes")))

    return sizes.agg(of("column").alias("column_bytes"), (of("csv") > of("column")).alias("csv_reads_more"),
                     (of("parquet") < of("csv")).alias("parquet_is_smaller"))


@query(spend_sql("run_label = 'r3'"))
def m7_spend_by_label(spark, sf_dir):
    return spend_by_label(jobs(spark, sf_dir), "pipeline", run="r3")
