"""A: sources and scans."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from millrace.functions.scalars import money, money_sum
from millrace.plans.derived import BASKETS_SQL, baskets
from millrace.operators.scan_cost import stored_file_bytes
from millrace.plans.registry import query, table
from millrace.session import scratch_path
from millrace.sources import files, metadata

ORDER_SCHEMA = ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                "o_orderdate timestamp_ntz, o_orderpriority string")
ORDERS_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"""


def _orders_csv(spark, sf_dir, label):
    path = scratch_path(spark, label)
    table(spark, sf_dir, "orders").write.option("header", True).csv(path)
    return path


@query(ORDERS_SQL)
def a1_csv_declared_schema(spark, sf_dir):
    return files.read_csv(spark, _orders_csv(spark, sf_dir, "a1"), ORDER_SCHEMA)


@query("""SELECT o_orderstatus, count(*) AS n, CAST(round(sum(CAST(o_totalprice AS DECIMAL(28,6))), 2) AS DOUBLE) AS total,
          CAST(max(year(o_orderdate)) AS BIGINT) AS last_year FROM orders GROUP BY 1""")
def a2_csv_inferred_schema(spark, sf_dir):
    df = files.read_csv(spark, _orders_csv(spark, sf_dir, "a2"))
    return df.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), money_sum("o_totalprice").alias("total"),
        F.max(F.year("o_orderdate")).cast("long").alias("last_year"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 2 THEN o_custkey END AS o_custkey, o_orderstatus,
          CASE WHEN o_orderkey % 3 = 1 THEN o_totalprice END AS o_totalprice,
          CASE WHEN o_orderkey % 3 = 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS order_total FROM orders""")
def a3_csv_by_column_name(spark, sf_dir):
    """One folder whose files have three layouts: a renamed column, another order, a column less."""
    path = scratch_path(spark, "a3")
    orders = table(spark, sf_dir, "orders")
    total = money("o_totalprice").cast("string").alias("order_total")
    for rest, columns in enumerate((["o_custkey", "o_orderkey", "o_orderstatus", total],
                                    ["o_totalprice", "o_orderstatus", "o_orderkey", "o_custkey"], ["o_orderstatus", "o_orderkey"])):
        (orders.where(F.col("o_orderkey") % 3 == rest).select(*columns)
         .write.mode("append").option("header", True).csv(path))
    target = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                           T.StructField("o_orderstatus", T.StringType()),
                           T.StructField("o_totalprice", T.DoubleType())])
    return files.read_csv_by_name(spark, [path], target)


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def a4_parquet_scan(spark, sf_dir):
    return table(spark, sf_dir, "customer")


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n,
          CAST(round(sum(CAST(l_extendedprice AS DECIMAL(28,6))), 2) AS DOUBLE) AS total FROM lineitem GROUP BY 1, 2""")
def a5_parquet_glob(spark, sf_dir):
    path = scratch_path(spark, "a5")
    (table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_extendedprice")
     .repartition(8).write.parquet(path))
    return (spark.read.parquet(f"{path}/*.parquet").groupBy("l_returnflag", "l_linestatus")
            .agg(F.count(F.lit(1)).alias("n"), money_sum("l_extendedprice").alias("total")))


def baskets_by_day(spark, sf_dir, label):
    """Baskets stored in one folder a day; the day itself is only in the path."""
    path = scratch_path(spark, label)
    (baskets(spark, sf_dir).repartitionByRange("sale_date", "basket_id")
     .write.partitionBy("sale_date").parquet(path))
    return path


@query(f"""SELECT CAST(sale_date AS VARCHAR) AS sale_date, store_id, count(*) AS n, CAST(sum(items) AS BIGINT) AS items
           FROM {BASKETS_SQL} GROUP BY 1, 2""")
def a6_partition_folders(spark, sf_dir):
    days = files.read_partitioned(spark, baskets_by_day(spark, sf_dir, "a6"))
    return (days.groupBy(F.col("sale_date").cast("string").alias("sale_date"), "store_id")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("items").alias("items")))


@query("""SELECT CAST(year(o_orderdate) AS BIGINT) AS suffix, count(*) AS n,
          CAST(round(sum(CAST(o_totalprice AS DECIMAL(28,6))), 2) AS DOUBLE) AS total
          FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1""")
def a7_shards_by_suffix(spark, sf_dir):
    root = scratch_path(spark, "a7")
    (table(spark, sf_dir, "orders").withColumn("suffix", F.year("o_orderdate"))
     .repartitionByRange("suffix", "o_orderkey").write.partitionBy("suffix").parquet(root))
    return (files.read_shards(spark, root, "suffix=").where("suffix = 1997")
            .groupBy(F.col("suffix").cast("long").alias("suffix"))
            .agg(F.count(F.lit(1)).alias("n"), money_sum("o_totalprice").alias("total")))


@query("""SELECT store_id, count(*) AS lines, CAST(sum(len) AS BIGINT) AS bytes, TRUE AS offsets_fit FROM (
            SELECT event_type AS store_id,
                   strlen(CAST(event_id AS VARCHAR) || ',' || event_type || ',' || CAST(user_id AS VARCHAR)) + 1 AS len
            FROM events) GROUP BY 1""")
def a8_text_with_offset(spark, sf_dir):
    """Per store: lines, bytes, and whether every line but a file's first starts where another ends."""
    path = scratch_path(spark, "a8")
    (table(spark, sf_dir, "events")
     .select("event_type", F.concat_ws(",", "event_id", "event_type", "user_id").alias("value"))
     .repartitionByRange("event_type", "value").write.partitionBy("event_type").text(path))
    lines = files.read_text_with_offset(spark, f"{path}/*").select(
        F.split("body", ",")[1].alias("store_id"), "offset", (F.octet_length("body") + 1).alias("len"))
    file_ends = stored_file_bytes(spark, path).select(
        F.regexp_extract("file_path", "event_type=([^/]+)", 1).alias("store_id"), F.col("file_bytes").alias("at"))

    def marks(df, at, sign):
        return df.select("store_id", at.alias("at"), F.lit(sign).alias("sign"))

    gaps = (marks(lines.where("offset > 0"), F.col("offset"), 1)
            .unionByName(marks(lines, F.col("offset") + F.col("len"), -1))
            .unionByName(marks(file_ends, F.col("at"), 1))
            .groupBy("store_id", "at").agg(F.sum("sign").alias("surplus"))
            .groupBy("store_id").agg((F.max(F.abs("surplus")) == 0).alias("offsets_fit")))
    return (lines.groupBy("store_id").agg(F.count(F.lit(1)).alias("lines"), F.sum("len").alias("bytes"))
            .join(gaps, "store_id"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_size END AS p_size,
          p_retailprice, p_name FROM part""")
def a9_whitespace_text(spark, sf_dir):
    path = scratch_path(spark, "a9")
    size = F.when(F.col("p_partkey") % 17 == 0, "?").otherwise(F.col("p_size").cast("string"))
    (table(spark, sf_dir, "part")
     .select(F.format_string('%-8d  %s   %s\t"%s"', "p_partkey", size, F.col("p_retailprice").cast("string"),
                             "p_name").alias("value")).write.text(path))
    return files.read_whitespace(spark, path, [("p_partkey", "long"), ("p_size", "int"),
                                               ("p_retailprice", "double"), ("p_name", "string")])


@query("SELECT l_quantity AS quantity, l_discount AS discount, l_tax AS tax FROM lineitem")
def a10_number_arrays(spark, sf_dir):
    path = scratch_path(spark, "a10")
    (table(spark, sf_dir, "lineitem")
     .select(F.to_json(F.array("l_quantity", "l_discount", "l_tax")).alias("value")).write.text(path))
    instance = F.col("instance")
    return files.read_number_arrays(spark, path).select(
        instance[0].alias("quantity"), instance[1].alias("discount"), instance[2].alias("tax"))


@query(f"""SELECT strftime(sale_date, '%Y%m%d') AS partition_id, count(*) AS total_rows, TRUE AS has_time
           FROM {BASKETS_SQL} GROUP BY 1""")
def a15_partition_metadata(spark, sf_dir):
    days = files.read_partitioned(spark, baskets_by_day(spark, sf_dir, "a15"))
    return (metadata.partitions_of(days, "sale_date")
            .select("partition_id", "total_rows", F.col("last_modified_time").isNotNull().alias("has_time")))


@query("""SELECT t.weight, count(*) AS n FROM orders
          JOIN (VALUES ('1-URGENT', 3), ('2-HIGH', 2), ('3-MEDIUM', 1)) AS t(priority, weight)
            ON o_orderpriority = t.priority GROUP BY 1""")
def a16_inline_table(spark, sf_dir):
    weights = metadata.inline_table(spark, ["o_orderpriority", "weight"],
                                    [("1-URGENT", 3), ("2-HIGH", 2), ("3-MEDIUM", 1)])
    return (table(spark, sf_dir, "orders").join(F.broadcast(weights), "o_orderpriority")
            .groupBy("weight").agg(F.count(F.lit(1)).alias("n")))
