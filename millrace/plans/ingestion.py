"""K: validated ingest and data checks; the sinks that belong to them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F, types as T

from millrace.functions.scalars import money_sum
from millrace.operators import checks, ingest, sets
from millrace.operators.ingest import POS_RECIPE
from millrace.operators.writes import write_run_errors
from millrace.plans.derived import BASKETS_SQL, POS_SQL, RUNS_SQL, baskets, load_runs, pos_fields, pos_lines
from millrace.plans.projections import POS_TYPED_SQL
from millrace.plans.registry import query, table
from millrace.session import scratch_path
from millrace.sources.files import read_partitioned, read_text_with_offset

AS_OF = dt.datetime(2024, 1, 31, 11, 0)
ZONE = "America/New_York"
MISCOUNTED = "(amount IS NULL OR surplus IS NOT NULL)"
BAD = f"(txn_ts = '2024-01-05 25:00:00' OR coalesce(amount, 'twelve') = 'twelve' OR {MISCOUNTED})"
CODE = f"CASE WHEN {MISCOUNTED} THEN 1 WHEN amount = 'twelve' THEN 0 ELSE 2 END"
BODY = "concat_ws(',', txn_id, store_id, txn_ts, sku, qty, amount, surplus)"


def _parsed(spark, sf_dir):
    return ingest.parse_lines(pos_lines(spark, sf_dir), POS_RECIPE)


@query(POS_TYPED_SQL + f" WHERE NOT {BAD}")
def k1_skip_bad_rows(spark, sf_dir):
    return ingest.good_rows(_parsed(spark, sf_dir), POS_RECIPE)


@query(f"""SELECT event_id AS line_id, {BODY} AS body,
             {CODE} AS "errCode",
             CASE WHEN {MISCOUNTED} THEN 'The record does not have 6 fields.'
                  WHEN amount = 'twelve' THEN 'Error encountered while executing ''set-type'' : Column ''amount'' cannot be converted to a ''double''.'
                  ELSE 'Value 2024-01-05 25:00:00 for column txn_ts is not in expected format yyyy-MM-dd HH:mm:ss (ecode: 2, directive: parse-as-datetime)' END AS "errMsg",
             'Wrangler' AS "errStage" FROM {POS_SQL} WHERE {BAD}""")
def k2_quarantine(spark, sf_dir):
    """The error side of a run that wrote both sides in one pass."""
    root = scratch_path(spark, "k2")
    ingest.ingest_run(_parsed(spark, sf_dir), root, "20240131")
    return ingest.quarantined(spark, root, POS_RECIPE)


@query(f"""SELECT {CODE} AS "errCode", store_id, count(*) AS n, count(*) AS places, TRUE AS own_file FROM {POS_SQL} WHERE {BAD} GROUP BY 1, 2""")
def k2_quarantine_from_files(spark, sf_dir):
    """From files of lines to a quarantine that still knows each record's file and byte."""
    inbox, root = scratch_path(spark, "k2-inbox"), scratch_path(spark, "k2-files")
    records = pos_lines(spark, sf_dir).select(F.split("body", ",")[1].alias("store"), F.col("body").alias("value"), "line_id")
    headers = records.select("store").distinct().select("store", F.lit(POS_RECIPE.header).alias("value"), F.lit(-1).cast("long").alias("line_id"))
    (records.unionByName(headers).repartitionByRange("store", "line_id").sortWithinPartitions("store", "line_id").drop("line_id")
     .write.partitionBy("store").text(inbox))
    lines = ingest.without_header(read_text_with_offset(spark, f"{inbox}/*"), POS_RECIPE)
    ingest.ingest_run(ingest.parse_lines(lines, POS_RECIPE), root, "20240131")
    store = F.split("body", ",")[1]
    return (ingest.quarantined(spark, root, POS_RECIPE).groupBy("errCode", store.alias("store_id"))
            .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("file", "offset").alias("places"),
                 F.every(F.contains("file", F.concat(F.lit("store="), store))).alias("own_file")))


STAGES_SQL = f"""SELECT CASE WHEN {BAD} THEN 'quarantined' ELSE 'loaded' END AS stage, count(*) AS records
                 FROM {POS_SQL} GROUP BY 1
                 UNION ALL SELECT 'recipe_in', count(*) FROM events"""


@query(STAGES_SQL)
def k3_records_by_stage(spark, sf_dir):
    """Counts observed while the records pass through the run."""
    seen = ingest.ingest_with_counts(pos_lines(spark, sf_dir), POS_RECIPE, scratch_path(spark, "k3"), "20240131")
    rows = [(s, n) for s, n in seen.items() if s in ("recipe_in", "loaded", "quarantined")]
    return spark.createDataFrame(rows, "stage string, records long")


@query(f"""SELECT n + 1 AS source_lines, 1 AS header_lines, n - bad AS loaded, bad AS quarantined, TRUE AS reconciled
           FROM (SELECT count(*) AS n, count(*) FILTER (WHERE {BAD}) AS bad FROM {POS_SQL})""")
def k4_reconciliation(spark, sf_dir):
    lines = pos_lines(spark, sf_dir).select("body").unionByName(
        spark.range(1).select(F.lit(POS_RECIPE.header).alias("body")))
    root = scratch_path(spark, "k4")
    ingest.ingest_run(ingest.parse_lines(ingest.without_header(lines, POS_RECIPE), POS_RECIPE), root, "20240131")
    return ingest.reconcile(lines, ingest.loaded(spark, root, POS_RECIPE),
                            ingest.quarantined(spark, root, POS_RECIPE), POS_RECIPE.header)


@query(f"""SELECT store_id, count(*) AS n, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total
           FROM {POS_SQL} WHERE NOT {BAD} GROUP BY 1""")
def k5_idempotent_load(spark, sf_dir):
    """The same run three times leaves every row once."""
    root = scratch_path(spark, "k5")
    for _ in range(3):
        ingest.ingest_run(_parsed(spark, sf_dir), root, "20240131")
    return ingest.loaded(spark, root, POS_RECIPE).groupBy("store_id").agg(
        F.count(F.lit(1)).alias("n"), money_sum("amount").alias("total"))


@query(f"""SELECT count(*) AS n, CAST(sum(CAST(TRY_CAST(amount AS DOUBLE) AS DECIMAL(18,2))) AS DOUBLE) AS total,
           count(*) FILTER (WHERE txn_ts = '2024-01-05 25:00:00') AS without_time,
           count(*) FILTER (WHERE CAST(qty AS INTEGER) < 0) AS negative FROM {POS_SQL}""")
def k6_control_totals(spark, sf_dir):
    return _parsed(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n"), money_sum("amount").alias("total"),
        F.count_if(F.col("txn_ts").isNull()).alias("without_time"), F.count_if(F.col("qty") < 0).alias("negative"))


@query("""SELECT 'extra o_channel' AS refused, o_orderstatus, count(*) AS n FROM orders GROUP BY 2""")
def k7_schema_gate(spark, sf_dir):
    """A drifted load is refused before the write; the table is what it was."""
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "k7")
    ingest.schema_gate(orders, orders.schema).write.parquet(path)
    refused = None
    try:
        drifted = orders.withColumn("o_channel", F.lit("web"))
        ingest.schema_gate(drifted, orders.schema).write.mode("append").parquet(path)
    except ingest.SchemaDrift as drift:
        refused = str(drift)
    return (spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("refused", F.lit(refused)))


@query(f"""SELECT 'negative_quantity' AS rule, count(*) FILTER (WHERE CAST(qty AS INTEGER) < 0) AS violations
             FROM {POS_SQL} WHERE NOT {BAD}
           UNION ALL SELECT 'no_amount', count(*) FILTER (WHERE CAST(amount AS DOUBLE) <= 0) FROM {POS_SQL} WHERE NOT {BAD}""")
def k8_business_rules(spark, sf_dir):
    """Faults that types cannot catch, on rows that loaded."""
    rows = ingest.good_rows(_parsed(spark, sf_dir), POS_RECIPE)
    return ingest.rule_violations(rows, {"negative_quantity": F.col("qty") < 0, "no_amount": F.col("amount") <= 0})


@query(f"SELECT \"errCode\", count(*) AS n FROM (SELECT {CODE} AS \"errCode\" FROM {POS_SQL} WHERE {BAD}) GROUP BY 1")
def b4_run_scoped_errors(spark, sf_dir):
    """Errors as JSON in the folder of their run, which a second write cannot touch."""
    root, run = scratch_path(spark, "b4"), "20240131T060000"
    errors = ingest.error_rows(_parsed(spark, sf_dir), POS_RECIPE)
    write_run_errors(errors, root, run)
    stored = spark.read.schema("errCode int, errMsg string").json(f"{root}/dt={run}")
    return stored.groupBy("errCode").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- data checks
CONTRACT = [("sale_date", "date"), ("store_id", "string"), ("region", "string"), ("register_id", "string"),
            ("basket_id", "string"), ("items", "bigint"), ("basket_value", "double")]


def _partitions(rows):
    """Partition metadata, one row a day, as the load computes it from the rows it has."""
    return rows.groupBy(F.date_format("sale_date", "yyyyMMdd").alias("partition_id")).agg(
        F.count(F.lit(1)).alias("total_rows"), F.max("loaded_at").cast("timestamp").alias("last_modified_time"))


def checks_sql(rows: str, observed_schema: str, schema_status: str) -> str:
    return f"""WITH nightly AS (
        SELECT sale_date = DATE '2024-01-30' AS last, count(*) AS n, 1 - count(basket_value) / count(*)::DOUBLE AS missing,
               (sum(CAST(basket_value AS DECIMAL(18,2))) / nullif(count(basket_value), 0))::DOUBLE AS mean
        FROM {rows} GROUP BY sale_date HAVING sale_date >= DATE '2024-01-23' AND sale_date <= DATE '2024-01-30'),
      compared AS (
        SELECT coalesce(max(n) FILTER (last), 0) AS n1, avg(n) FILTER (NOT last) AS n7, max(missing) FILTER (last) AS missing1,
               avg(missing) FILTER (NOT last) AS missing7, max(mean) FILTER (last) AS mean1, avg(mean) FILTER (NOT last) AS mean7
        FROM nightly),
      loaded AS (SELECT max(sale_date) AS newest, date_sub('hour', max(loaded_at), TIMESTAMP '2024-01-31 11:00:00') AS age FROM {rows}),
      signals AS (SELECT unnest([
        {{'signal': 'freshness', 'observed': printf('newest %s, %d h old', newest::VARCHAR, age), 'expected': 'yesterday, < 26 h',
          'ok': age < 26 AND newest >= DATE '2024-01-30'}},
        {{'signal': 'volume', 'observed': printf('%d rows, %.0f%% of 7-day mean', n1, 100 * n1 / n7), 'expected': '80 to 120%',
          'ok': n1 / n7 >= 0.8 AND n1 / n7 <= 1.2}},
        {{'signal': 'schema', 'observed': '{observed_schema}', 'expected': '7 columns, typed', 'ok': '{schema_status}' = 'GREEN'}},
        {{'signal': 'distribution', 'observed': printf('null %.1f%%, mean $%.2f', 100 * coalesce(missing1, 0), coalesce(mean1, 0)),
          'expected': printf('null < %.1f%%, $%.2f ± 10%%', 1 + 100 * missing7, mean7),
          'ok': coalesce(missing1, 1) < 0.01 + missing7 AND abs(mean1 / mean7 - 1) <= 0.1}}]) AS s FROM compared, loaded)
      SELECT s.signal, s.observed, s.expected, CASE WHEN s.ok THEN 'GREEN' ELSE 'RED' END AS status FROM signals"""


def _report(rows, visible=None):
    columns = visible or [c for c, _ in CONTRACT]
    return checks.nightly_checks(rows.select(*columns), _partitions(rows), CONTRACT,
                                 "sale_date", "basket_value", AS_OF, ZONE)


def loaded_nights(rows, label):
    """What a load leaves behind: the rows in one folder a day, and their partitions in a table of its own.

    Checks afterwards prune the rows to the days they compare and read one metadata row a day.
    """
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, label)
    rows.repartitionByRange("sale_date", "basket_id").write.partitionBy("sale_date").parquet(f"{path}/rows")
    stored = read_partitioned(spark, f"{path}/rows")
    _partitions(stored).write.parquet(f"{path}/partitions")
    return stored, spark.read.parquet(f"{path}/partitions")


@query(checks_sql(BASKETS_SQL, "matches contract", "GREEN"))
def k13_nightly_report(spark, sf_dir):
    stored, partitions = loaded_nights(baskets(spark, sf_dir), "k13")
    return checks.nightly_checks(stored.select(*[c for c, _ in CONTRACT]), partitions, CONTRACT,
                                 "sale_date", "basket_value", AS_OF, ZONE)


LOST_NIGHT_SQL = f"(SELECT * FROM {BASKETS_SQL} WHERE sale_date < DATE '2024-01-30')"


@query(f"""SELECT * FROM ({checks_sql(LOST_NIGHT_SQL, "matches contract", "GREEN")}) WHERE signal = 'freshness'""")
def k9_freshness_of_lost_night(spark, sf_dir):
    rows = baskets(spark, sf_dir).where(F.col("sale_date") < F.lit("2024-01-30").cast("date"))
    return checks.freshness_check(loaded_nights(rows, "k9")[1], AS_OF, ZONE).drop("ord")


@query(f"""WITH d AS (SELECT store_id, sale_date, count(*) AS n FROM {BASKETS_SQL} GROUP BY 1, 2),
           m AS (SELECT *, avg(n) OVER (PARTITION BY store_id ORDER BY sale_date
                   RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS trailing_mean FROM d)
           SELECT store_id, CAST(sale_date AS VARCHAR) AS sale_date, n,
                  CASE WHEN n / trailing_mean BETWEEN 0.8 AND 1.2 THEN 'GREEN' ELSE 'RED' END AS status FROM m""")
def k10_volume_by_store(spark, sf_dir):
    return checks.volume_by_series(baskets(spark, sf_dir), "store_id", "sale_date").select(
        "store_id", F.col("sale_date").cast("string").alias("sale_date"), "n", "status")


@query(f"""SELECT * FROM ({checks_sql(BASKETS_SQL, "extra basket_total, missing basket_value", "RED")})
           WHERE signal IN ('schema', 'volume')""")
def k11_schema_contract(spark, sf_dir):
    """A renamed column: one is missing, one is extra."""
    rows = baskets(spark, sf_dir)
    renamed = rows.select(*[c for c, _ in CONTRACT]).withColumnRenamed("basket_value", "basket_total")
    volume = checks.volume_and_distribution_checks(rows, "sale_date", "basket_value", AS_OF, ZONE)
    return (volume.where("signal = 'volume'").unionByName(checks.schema_check(renamed, CONTRACT)).drop("ord"))


NORTH_NULLS_SQL = f"""(SELECT * REPLACE (CASE WHEN sale_date = DATE '2024-01-30' AND region = 'North' THEN NULL
                       ELSE basket_value END AS basket_value) FROM {BASKETS_SQL})"""


@query(f"""SELECT * FROM ({checks_sql(NORTH_NULLS_SQL, "matches contract", "GREEN")})
           WHERE signal IN ('distribution', 'volume')""")
def k12_distribution(spark, sf_dir):
    """Last night one region came without values."""
    lost = (F.col("sale_date") == F.lit("2024-01-30").cast("date")) & (F.col("region") == "North")
    rows = baskets(spark, sf_dir).withColumn("basket_value", F.when(~lost, F.col("basket_value")))
    return checks.volume_and_distribution_checks(rows, "sale_date", "basket_value", AS_OF, ZONE).drop("ord")


@query(f"""SELECT signal, status, CASE WHEN status = 'RED' THEN 'ERROR' ELSE 'INFO' END AS severity, observed
           FROM ({checks_sql(NORTH_NULLS_SQL, "matches contract", "GREEN")})""")
def b12_check_log(spark, sf_dir):
    """The report of a faulty night as JSON log entries with a severity."""
    path = scratch_path(spark, "b12")
    lost = (F.col("sale_date") == F.lit("2024-01-30").cast("date")) & (F.col("region") == "North")
    rows = baskets(spark, sf_dir).withColumn("basket_value", F.when(~lost, F.col("basket_value")))
    checks.check_log(_report(rows), checks.moment(AS_OF)).write.mode("append").json(path)
    return spark.read.schema("signal string, status string, severity string, observed string").json(path)


@query("""SELECT strftime(time_bucket(INTERVAL 5 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
          event_type AS signal, count(*) AS reds FROM events WHERE value > 150 GROUP BY 1, 2""")
def k14_red_alerts(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(
        "ts", F.col("event_type").alias("signal"), F.when(F.col("value") > 150, "RED").otherwise("GREEN").alias("status"))
    return checks.red_alerts(log).withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


def budget_sql(period: str, days: str) -> str:
    return f"""WITH nights AS (
        SELECT state, epoch(finished_at)::BIGINT // 60 AS finished, epoch(corrected_at)::BIGINT // 60 AS corrected,
               epoch(CAST(sale_date AS TIMESTAMP))::BIGINT // 60 + 30 * 60 AS due FROM {RUNS_SQL} WHERE {period}),
      period AS (
        SELECT count(*) FILTER (state = 'DONE') AS done, 1440::DOUBLE * {days} AS minutes,
               sum(greatest(finished - due, 0)) AS late, sum(coalesce(corrected - greatest(finished, due), 0)) AS wrong FROM nights),
      levels AS (SELECT unnest([{{'sli': 'job DONE by 06:00', 'bad': late}}, {{'sli': 'data fresh and complete', 'bad': late + wrong}}]) AS level,
                        done, minutes FROM period)
      SELECT level.sli AS sli, done AS nights_done, level.bad::BIGINT AS bad_min, minutes * 0.01::DOUBLE AS budget_min,
             round(100 - 100 * level.bad / minutes, 2) AS sli_pct, round(100 * level.bad / (minutes * 0.01::DOUBLE), 1) AS budget_used_pct
      FROM levels"""


@query(budget_sql("TRUE", "count(*)"))
def k15_error_budget(spark, sf_dir):
    return checks.error_budget(load_runs(spark, sf_dir), days=None)


@query(budget_sql(f"sale_date > (SELECT max(sale_date) - 30 FROM {RUNS_SQL})", "30"))
def k15_error_budget_of_thirty_days(spark, sf_dir):
    """The budget of the last thirty days, whatever was late before."""
    return checks.error_budget(load_runs(spark, sf_dir))


@query(f"""SELECT CAST(sale_date AS VARCHAR) AS sale_date, state, finished_at, rows_loaded FROM {RUNS_SQL}
           WHERE strftime(finished_at, '%H:%M:%S') > '06:00:00' OR corrected_at IS NOT NULL""")
def k16_bad_nights(spark, sf_dir):
    return (checks.bad_nights(load_runs(spark, sf_dir))
            .select(F.col("sale_date").cast("string").alias("sale_date"), "state", "finished_at", "rows_loaded"))
