"""O: the regression model; P: event-log diagnostics; Q: request log and quotes."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.scalars import fare_quote, fuel_cost
from millrace.operators import diagnostics as D, model, request_log
from millrace.operators.sets import labelled_union
from millrace.plans.aggregates import QUARTILE_SQL
from millrace.plans.registry import query, table
from millrace.session import scratch_path, shared_root
from millrace.sources.eventlog import read_event_logs

NUMERIC, CATEGORY, LABEL = ["l_quantity", "l_discount", "l_tax"], "l_returnflag", "l_extendedprice"
KEY = ["l_orderkey", "l_linenumber", "l_partkey"]


def _items(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(*KEY, *NUMERIC, CATEGORY, LABEL).dropna()


# ---------------------------------------------------------------- model
@query("SELECT count(*) AS n, TRUE AS near_eight_tenths, 0 AS in_both FROM lineitem")
def o1_hash_split(spark, sf_dir):
    """Sizes of the split, and rows that would be in both parts."""
    train, test = model.hash_split(_items(spark, sf_dir), KEY)
    parts = labelled_union({"train": train.select(*KEY), "test": test.select(*KEY)}, "part")
    both = parts.groupBy(*KEY).agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("part") == "train").alias("train"))
    return both.agg(F.sum("rows").alias("n"), (F.sum("train") / F.sum("rows")).between(0.75, 0.85).alias("near_eight_tenths"),
                    F.count_if((F.col("train") > 0) & (F.col("train") < F.col("rows"))).alias("in_both"))


@query("""WITH f AS (SELECT l_returnflag, count(*) AS n, sum(count(*)) OVER () AS total FROM lineitem GROUP BY 1)
          SELECT feature, 0.0::DOUBLE AS mean, 1.0::DOUBLE AS deviation FROM (VALUES (0), (1), (2)) AS v(feature)
          UNION ALL SELECT 2 + row_number() OVER (ORDER BY l_returnflag), round(n / total, 6),
                           round(sqrt(n / total * (1 - n / total)), 6) FROM f""")
def o2_scaled_and_encoded(spark, sf_dir):
    """Mean and population deviation of every scaled number, and how often each indicator is set."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    items = _items(spark, sf_dir)
    facts = model.training_facts(items, NUMERIC, CATEGORY, LABEL)
    fitted = Pipeline(stages=model.feature_stages(facts, CATEGORY)).fit(items)
    values = fitted.transform(items).select(F.posexplode(vector_to_array("features")).alias("feature", "v"))
    return values.groupBy(F.col("feature").cast("long").alias("feature")).agg(
        (F.round(F.avg("v"), 6) + 0.0).alias("mean"), F.round(F.stddev_pop("v"), 6).alias("deviation"))


@query("""WITH s AS (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS sd, avg(l_extendedprice) AS my, count(*) AS n FROM lineitem)
          SELECT round(sum((l_quantity - m) / sd * (l_extendedprice - my)) / (max(n) + 1), 3) AS slope,
                 round(max(my), 3) AS intercept FROM lineitem, s""")
def o3_ridge_one_feature(spark, sf_dir):
    """With one number the fit can be checked in SQL: slope = Sxy / (Sxx + 1) on the scaled number."""
    fitted = model.fit_ridge(_items(spark, sf_dir), ["l_quantity"], None, LABEL).stages[-1]
    return spark.createDataFrame([(round(float(fitted.coefficients[0]), 3), round(float(fitted.intercept), 3))],
                                 "slope double, intercept double")


SPLIT_SQL = """(SELECT l_quantity AS x, l_discount AS z, l_extendedprice AS y,
    ('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey)), 1, 8))::BIGINT % 10 < 8 AS train FROM lineitem)"""


def _split(spark, sf_dir, label):
    """Train and test rows; the split is computed once and stored, however many passes read it."""
    path = scratch_path(spark, label)
    train, test = model.hash_split(_items(spark, sf_dir), KEY)
    train.write.parquet(f"{path}/train")
    test.write.parquet(f"{path}/test")
    return spark.read.schema(train.schema).parquet(f"{path}/train"), spark.read.schema(test.schema).parquet(f"{path}/test")


def _error(train, test, fit, numeric, category):
    return model.mean_absolute_error(fit(train, numeric, category, LABEL).transform(test), LABEL).first()


# Two numbers scaled by their deviations; the normal equations of the penalised fit are solved by hand.
@query(f"""WITH s AS (SELECT avg(x) AS m, stddev_pop(x) AS sd, avg(z) AS mz, stddev_pop(z) AS sz, avg(y) AS my FROM {SPLIT_SQL} WHERE train),
                b AS (SELECT sum((x - m) / sd * (x - m) / sd) + 1 AS a11, sum((x - m) / sd * (z - mz) / sz) AS a12, sum((z - mz) / sz * (z - mz) / sz) + 1 AS a22,
                             sum((x - m) / sd * (y - my)) AS c1, sum((z - mz) / sz * (y - my)) AS c2 FROM {SPLIT_SQL}, s WHERE train)
           SELECT count(*) AS n, round(avg(abs(y - my - c1 / a11 * (x - m) / sd)), 3) AS mae,
                  round(avg(abs(y - my - (c1 * a22 - c2 * a12) / (a11 * a22 - a12 * a12) * (x - m) / sd
                                - (c2 * a11 - c1 * a12) / (a11 * a22 - a12 * a12) * (z - mz) / sz)), 3) AS mae_of_two
           FROM {SPLIT_SQL}, s, b WHERE NOT train""")
def o3_o5_ridge_error(spark, sf_dir):
    """Error on the test rows of the fits on one number and on two. Both read the split that the first stored."""
    train, test = _split(spark, sf_dir, "o3")
    one = _error(train, test, model.fit_ridge, ["l_quantity"], None)
    two = _error(train, test, model.fit_ridge, ["l_quantity", "l_discount"], None)
    return spark.createDataFrame([(one["n"], round(one["mae"], 3), round(two["mae"], 3))], "n long, mae double, mae_of_two double")


# One round of boosting with one cut, over all cuts between neighbouring values: the one whose sides' sums explain most.
ROUND_SQL = f"""v AS (SELECT x, count(*) AS n, sum(y) AS total FROM {SPLIT_SQL} WHERE train GROUP BY x),
    w AS (SELECT x, lead(x) OVER o AS above, sum(n) OVER o AS n, sum(total) OVER o AS total, sum(n) OVER () AS all_n, sum(total) OVER () AS all_total
          FROM v WINDOW o AS (ORDER BY x)),
    cut AS (SELECT x AS low_side_to, above AS high_side_from, total / n AS low_value, (all_total - total) / (all_n - n) AS high_value
            FROM w WHERE above IS NOT NULL
            ORDER BY total * total / n + (all_total - total) * (all_total - total) / (all_n - n) DESC, x LIMIT 1)"""


# The hundred trees of depth three on all columns. ``cuts``: by the shares of 32 bins, ``share`` of which end before the middle of a value's
# rows; no more than one cut between two values, so ``made`` is the number so far. ``cells``: rows of the same bins, their train rows ``n`` and
# those rows' mean. ``grown``: four steps a round, three that send the cells of every node left or right of its best cut and one that adds the
# means of what is left in the leaves; the first round takes the prices, later ones twice what is missing.
TREES_SQL = """items AS MATERIALIZED (SELECT l_quantity AS x, l_discount AS z, l_tax AS t, l_returnflag AS flag, l_extendedprice AS y,
        ('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey)), 1, 8))::BIGINT % 10 < 8 AS train FROM lineitem),
    counted AS MATERIALIZED (SELECT f, v, count(*) FILTER (train) AS copies
                             FROM (SELECT 0 AS f, x AS v, train FROM items UNION ALL SELECT 1, z, train FROM items UNION ALL SELECT 2, t, train FROM items) GROUP BY f, v),
    placed AS (SELECT f, v, row_number() OVER o - 1 AS i, lag(v) OVER o AS low, count(*) OVER (PARTITION BY f) AS every,
                      least(31, ceil((sum(copies) OVER o - copies / 2.0) * 32 / sum(copies) OVER (PARTITION BY f)) - 1) AS share
               FROM counted WHERE copies > 0 WINDOW o AS (PARTITION BY f ORDER BY v)),
    spread AS (SELECT *, i + least(0, coalesce(min(CASE WHEN i > 0 THEN share - i END) OVER (PARTITION BY f ORDER BY i), 0)) AS made FROM placed),
    cuts AS MATERIALIZED (SELECT f, (low + v) / 2 AS place FROM (SELECT *, lag(made) OVER (PARTITION BY f ORDER BY i) AS made_before FROM spread)
                          WHERE i > 0 AND (every <= 32 OR made > made_before)),
    bins AS MATERIALIZED (SELECT f, v, (SELECT count(*) FROM cuts WHERE cuts.f = counted.f AND cuts.place < counted.v) AS b FROM counted),
    binned AS MATERIALIZED (SELECT bx.b AS x, bz.b AS z, bt.b AS t, flag, y, train FROM items
                            JOIN bins bx ON bx.f = 0 AND bx.v = items.x JOIN bins bz ON bz.f = 1 AND bz.v = items.z JOIN bins bt ON bt.f = 2 AND bt.v = items.t),
    cells AS MATERIALIZED (SELECT row_number() OVER () AS cell, * FROM (SELECT x, z, t, flag, count(*) FILTER (train) AS n, coalesce(avg(y) FILTER (train), 0) AS y
                                                                       FROM binned GROUP BY x, z, t, flag)),
    features AS MATERIALIZED (SELECT cell, 0 AS f, x AS b FROM cells UNION ALL SELECT cell, 1, z FROM cells UNION ALL SELECT cell, 2, t FROM cells
                              UNION ALL SELECT cell, 2 + k, (cells.flag = flags.flag)::BIGINT
                              FROM cells, (SELECT flag, row_number() OVER (ORDER BY flag) AS k FROM (SELECT DISTINCT flag FROM items WHERE train)) AS flags),
    grown AS (SELECT 0 AS step, cell, 0::DOUBLE AS prediction, 1 AS node FROM cells
              UNION ALL
              (WITH missing AS (SELECT step, cell, prediction, node, n, CASE WHEN step < 4 THEN y ELSE 2 * (y - prediction) END AS r
                                FROM grown JOIN cells USING (cell) WHERE step < 400),
                    sums AS (SELECT node, f, b, sum(n) AS n, sum(n * r) AS total FROM missing JOIN features USING (cell)
                             WHERE n > 0 AND step % 4 < 3 GROUP BY node, f, b),
                    sides AS (SELECT node, f, b, sum(n) OVER o AS n, sum(total) OVER o AS total,
                                     sum(n) OVER (PARTITION BY node, f) AS all_n, sum(total) OVER (PARTITION BY node, f) AS all_total
                              FROM sums WINDOW o AS (PARTITION BY node, f ORDER BY b)),
                    gains AS (SELECT *, total * total / n + (all_total - total) * (all_total - total) / (all_n - n) - all_total * all_total / all_n AS gain
                              FROM sides WHERE n < all_n),
                    best AS (SELECT node, f, b AS low_side_to FROM gains WHERE gain > 0
                             QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, b) = 1),
                    leaves AS (SELECT node, sum(n * r) / sum(n) AS leaf FROM missing WHERE step % 4 = 3 AND n > 0 GROUP BY node)
               SELECT step + 1, cell, prediction + CASE WHEN step % 4 < 3 THEN 0 WHEN step < 4 THEN leaf ELSE 0.1::DOUBLE * leaf END,
                      CASE WHEN step % 4 = 3 THEN 1 WHEN best.f IS NULL THEN node ELSE 2 * node + (features.b > low_side_to)::INT END
               FROM missing LEFT JOIN best USING (node) LEFT JOIN leaves USING (node) LEFT JOIN features USING (cell, f))),
    trees AS (SELECT round(avg(abs(binned.y - prediction)) FILTER (NOT train), 3) AS mae_of_trees,
                     round(sqrt(avg((binned.y - prediction) * (binned.y - prediction)) FILTER (train)), 3) AS left_by_trees,
                     round(stddev_pop(binned.y) FILTER (train), 3) AS left_by_mean
              FROM binned JOIN cells USING (x, z, t, flag) JOIN grown USING (cell) WHERE step = 400)"""


@query(f"""WITH RECURSIVE {ROUND_SQL}, {TREES_SQL}
           SELECT count(*) AS n, round(avg(abs(y - (SELECT avg(y) FROM {SPLIT_SQL} WHERE train))), 3) AS error_of_mean, low_side_to, high_side_from,
                  round(low_value, 3) AS low_value, round(high_value, 3) AS high_value,
                  round(avg(abs(y - CASE WHEN x <= low_side_to THEN low_value ELSE high_value END)), 3) AS mae,
                  mae_of_trees, left_by_trees, left_by_mean
           FROM {SPLIT_SQL}, cut, trees WHERE NOT train
           GROUP BY low_side_to, high_side_from, low_value, high_value, mae_of_trees, left_by_trees, left_by_mean""")
def o4_o5_boosted_error(spark, sf_dir):
    """A hundred trees on all columns: their error on the test rows, and what they and the mean leave of the train rows (root of the mean square).

    Beside it one round with one cut on one number: where it cuts, the values of both sides and its error on the test rows.
    """
    shared_root(spark)  # tree checkpoints
    train, test = _split(spark, sf_dir, "o4")
    trees = model.fit_boosted(train, NUMERIC, CATEGORY, LABEL)
    error_of_trees = model.mean_absolute_error(trees.transform(test), LABEL).first()
    miss = F.col(LABEL) - F.col("prediction")
    by_trees, by_mean = trees.transform(train).agg(F.sqrt(F.avg(miss * miss)), F.stddev_pop(LABEL)).first()
    fitted = model.fit_boosted(train, ["l_quantity"], None, LABEL, rounds=1, depth=1, bins=128)
    sides = (fitted.transform(train).groupBy("prediction").agg(F.min("l_quantity").alias("low"), F.max("l_quantity").alias("high"))
             .orderBy("low").collect())
    mean = train.agg(F.avg(LABEL)).first()[0]
    flat = test.agg(F.avg(F.abs(F.col(LABEL) - F.lit(mean)))).first()[0]
    error = model.mean_absolute_error(fitted.transform(test), LABEL).first()
    return spark.createDataFrame(
        [(error["n"], round(flat, 3), sides[0]["high"], sides[-1]["low"], round(sides[0]["prediction"], 3), round(sides[-1]["prediction"], 3), round(error["mae"], 3),
          round(error_of_trees["mae"], 3), round(by_trees, 3), round(by_mean, 3))],
        "n long, error_of_mean double, low_side_to double, high_side_from double, low_value double, high_value double, mae double, "
        "mae_of_trees double, left_by_trees double, left_by_mean double")


@query()
def o4_boosted_trees(spark, sf_dir):
    """A hundred trees on all columns: squared error on the train rows of their mean and of the trees, and the error on the test rows.

    The same trees have their SQL above, with rounded errors; tests compare these.
    """
    shared_root(spark)
    train, test = _split(spark, sf_dir, "o4-trees")
    fitted = model.fit_boosted(train, NUMERIC, CATEGORY, LABEL)
    miss = F.col(LABEL) - F.col("prediction")
    trees = model.mean_absolute_error(fitted.transform(test), LABEL).first()
    spread, left = fitted.transform(train).agg(F.var_pop(LABEL), F.avg(miss * miss)).first()
    return spark.createDataFrame([(trees["n"], spread, left, trees["mae"])], "n long, spread_of_train double, left_of_train double, mae double")


# The fit on one number, in SQL, and what it predicts for every row.
ONE_FEATURE_SQL = """(WITH s AS (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS sd, avg(l_extendedprice) AS my, count(*) AS n FROM lineitem),
    b AS (SELECT sum((l_quantity - m) / sd * (l_extendedprice - my)) / (max(n) + 1) AS slope FROM lineitem, s)
  SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_quantity, l_extendedprice,
         my + slope * (l_quantity - m) / sd AS prediction FROM lineitem, s, b)"""


@query(f"""SELECT l_returnflag, count(*) AS n, round(avg(abs(l_extendedprice - prediction)), 3) AS mae
           FROM {ONE_FEATURE_SQL} GROUP BY 1""")
def o6_save_load_score(spark, sf_dir):
    """A saved and loaded pipeline scores the table; its error by group."""
    path = scratch_path(spark, "o6")
    items = _items(spark, sf_dir)
    model.save(model.fit_ridge(items, ["l_quantity"], None, LABEL), path)
    scored = model.load(path).transform(items)
    return scored.groupBy(CATEGORY).agg(F.count(F.lit(1)).alias("n"),
                                        F.round(F.avg(F.abs(F.col(LABEL) - F.col("prediction"))), 3).alias("mae"))


@query(f"SELECT l_orderkey, l_partkey, l_quantity, round(prediction, 2) AS prediction FROM {ONE_FEATURE_SQL}")
def b16_prediction_records(spark, sf_dir):
    """Predictions as JSON records of instance and prediction, read back."""
    path = scratch_path(spark, "b16")
    items = _items(spark, sf_dir)
    scored = model.fit_ridge(items, ["l_quantity"], None, LABEL).transform(items)
    model.prediction_records(scored, ["l_orderkey", "l_partkey", "l_quantity"]).write.json(path)
    stored = spark.read.schema("instance struct<l_orderkey: long, l_partkey: long, l_quantity: double>, "
                               "prediction double").json(path)
    return stored.select("instance.l_orderkey", "instance.l_partkey", "instance.l_quantity",
                         F.round("prediction", 2).alias("prediction"))


@query("""SELECT p_partkey, CASE WHEN p_size % 10 = 0 THEN NULL ELSE 20.0::DOUBLE / (p_size % 10) * 3.2::DOUBLE END AS cost FROM part""")
def o7_fuel_cost(spark, sf_dir):
    """Sizes stand for miles per gallon; nothing is asked of a zero."""
    return table(spark, sf_dir, "part").select("p_partkey", fuel_cost(F.col("p_size") % 10).alias("cost"))


# ---------------------------------------------------------------- event logs
# Every event becomes a finished task of one of twenty stages; its type names the application.
TASKS_SQL = """(SELECT event_type AS app, user_id % 20 AS stage, event_id AS task, epoch_us(ts) // 1000 AS launch,
                  CAST(round(value * 100) AS BIGINT) / 1000 AS seconds,
                  CAST(regexp_extract(props, '[0-9]+') AS BIGINT) * 100000 + event_id AS read_bytes,
                  user_id AS read_records FROM events)"""


def event_log(spark, sf_dir, label):
    """The log as JSON lines below one folder an application."""
    path = scratch_path(spark, label)
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("app"), (F.col("user_id") % 20).alias("stage"), "event_id",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("launch"),
        F.round(F.col("value") * 100).cast("long").alias("took"), "user_id",
        F.regexp_extract("props", "[0-9]+", 0).cast("long").alias("k"))

    def lit(value, name):
        return F.lit(value).alias(name)

    task = events.select("app", F.to_json(F.struct(
        lit("SparkListenerTaskEnd", "Event"), F.col("stage").alias("Stage ID"),
        F.struct(F.col("event_id").alias("Task ID"), F.col("launch").alias("Launch Time"),
                 (F.col("launch") + F.col("took")).alias("Finish Time")).alias("Task Info"),
        F.struct(F.struct((F.col("k") * 100000).alias("Remote Bytes Read"), F.col("event_id").alias("Local Bytes Read"),
                          F.col("user_id").alias("Total Records Read")).alias("Shuffle Read Metrics"))
         .alias("Task Metrics"))).alias("value"))
    stage = events.select("app", "stage").distinct().select("app", F.to_json(F.struct(
        lit("SparkListenerStageSubmitted", "Event"),
        F.struct(F.col("stage").alias("Stage ID"), F.lit("parquet at job.py:1").alias("Stage Name"))
         .alias("Stage Info"))).alias("value"))
    span = events.groupBy("app").agg(F.min("launch").alias("low"), F.max("launch").alias("high"),
                                     F.count(F.lit(1)).alias("n"))
    plan = F.format_string("== Physical Plan ==\nAdaptiveSparkPlan isFinalPlan=%s\n+- Scan %s %d rows, [plan_id=1]\n"
                           "+- == Initial Plan ==\n   Scan\n\nrest", F.col("final"), F.col("app"), F.col("n"))
    ends = span.select("app", F.explode(F.array(
        F.to_json(F.struct(lit("SparkListenerApplicationStart", "Event"), F.col("low").alias("Timestamp"))),
        F.to_json(F.struct(lit("SparkListenerApplicationEnd", "Event"), F.col("high").alias("Timestamp"))))).alias("value"))
    plans = (span.withColumn("final", F.explode(F.array(F.lit("false"), F.lit("true"))))
             .select("app", F.to_json(F.struct(
                 F.lit("org.apache.spark.sql.execution.ui.SparkListenerSQLAdaptiveExecutionUpdate").alias("Event"),
                 lit(3, "executionId"), plan.alias("physicalPlanDescription"))).alias("value")))
    (task.unionByName(stage).unionByName(ends).unionByName(plans)
     .write.partitionBy("app").text(path))
    return read_event_logs(spark, path)


@query(f"""SELECT 'SparkListenerTaskEnd' AS event, app, count(*) AS n FROM {TASKS_SQL} GROUP BY 2
           UNION ALL SELECT 'SparkListenerStageSubmitted', app, count(DISTINCT stage) FROM {TASKS_SQL} GROUP BY 2""")
def a11_event_log_scan(spark, sf_dir):
    log = event_log(spark, sf_dir, "a11")
    return (log.where(F.col("Event").isin("SparkListenerTaskEnd", "SparkListenerStageSubmitted"))
            .groupBy(F.col("Event").alias("event"), "app").agg(F.count(F.lit(1)).alias("n")))


SUMMARY_SQL = f"""SELECT app, stage, s.n AS tasks, s."min", p25, median, p75, s."max", shuffle_mb,
                  coalesce("max" / nullif(median, 0), 0) AS max_to_median
                  FROM ({QUARTILE_SQL.format(g="app, stage", v="seconds", t=TASKS_SQL)}) s
                  JOIN (SELECT app, stage, sum(read_bytes)::BIGINT / 1e6::DOUBLE AS shuffle_mb FROM {TASKS_SQL} GROUP BY 1, 2) r
                  USING (app, stage)"""


@query(SUMMARY_SQL)
def p1_task_times_by_stage(spark, sf_dir):
    return D.stage_summary(event_log(spark, sf_dir, "p1"))


@query(f"""SELECT app, stage, read_bytes, read_records, seconds FROM (
             SELECT *, row_number() OVER (PARTITION BY app, stage ORDER BY read_bytes DESC, launch, task) AS r FROM {TASKS_SQL})
           WHERE r = 1 AND read_bytes > 1000000""")
def p2_largest_reads(spark, sf_dir):
    return D.largest_reads(event_log(spark, sf_dir, "p2"))


@query(f"SELECT app, (max(launch) - min(launch)) / 1000 AS seconds FROM {TASKS_SQL} GROUP BY 1")
def p3_run_times(spark, sf_dir):
    return D.run_times(event_log(spark, sf_dir, "p3"))


@query(f"""SELECT app, 'AdaptiveSparkPlan isFinalPlan=true' || chr(10) || '+- Scan ' || app || ' ' || count(*) || ' rows' AS plan
           FROM {TASKS_SQL} GROUP BY 1""")
def p4_final_plans(spark, sf_dir):
    return D.final_plans(event_log(spark, sf_dir, "p4"))


@query(f"""SELECT app, stage, tasks, max_to_median FROM ({SUMMARY_SQL}) WHERE tasks >= 8 AND max_to_median > 5""")
def p5_skewed_stages(spark, sf_dir):
    return (D.skewed_stages(D.stage_summary(event_log(spark, sf_dir, "p5")))
            .select("app", "stage", "tasks", "max_to_median"))


# ---------------------------------------------------------------- request log and quotes
# Some lines are cut off, some are none at all.
LOG_SQL = """(SELECT *, CASE WHEN event_id % 103 = 11 THEN 'rejected' WHEN event_id % 107 = 13 THEN 'rejected'
              WHEN event_type = 'error' THEN 'failed' ELSE 'answered' END AS ending FROM events)"""


@query(f"""SELECT CASE WHEN ending = 'answered' THEN CASE user_id % 2 WHEN 0 THEN 'v1' ELSE 'v2' END END AS version,
                 CASE WHEN ending = 'answered' THEN 'pod-' || CAST(user_id % 5 AS VARCHAR) END AS pod,
                 count(*) FILTER (WHERE ending = 'answered') AS answered, count(*) FILTER (WHERE ending = 'failed') AS failed,
                 count(*) FILTER (WHERE ending = 'rejected') AS rejected,
                 avg(CASE WHEN ending = 'answered' THEN CAST(regexp_extract(props, '[0-9]+') AS BIGINT) END) AS mean_ms,
                 coalesce(max(CASE WHEN ending = 'answered' THEN CAST(regexp_extract(props, '[0-9]+') AS BIGINT) END), 0) AS max_ms
          FROM {LOG_SQL} GROUP BY 1, 2""")
def q1_request_log(spark, sf_dir):
    """Answers by pod; failures and lines that are no requests are counted too, so no line is lost."""
    return (request_log.by_pod(request_log.parse_requests(_request_lines(spark, sf_dir, "q1")))
            .withColumn("max_ms", F.coalesce("max_ms", F.lit(0).cast("long"))))


@query(f"""SELECT CASE WHEN event_id % 103 = 11 THEN strftime(ts, '%H:%M:%S') || '  200  v' ELSE '-- rotated ' || event_type END AS rejected,
                  count(*) AS times FROM {LOG_SQL} WHERE ending = 'rejected' GROUP BY 1""")
def q1_request_dead_letters(spark, sf_dir):
    return request_log.dead_letters(request_log.parse_requests(_request_lines(spark, sf_dir, "q1-dead")))


def _request_lines(spark, sf_dir, label):
    path = scratch_path(spark, label)
    clock, user, event = F.date_format("ts", "HH:mm:ss"), F.col("user_id"), F.col("event_id")
    version = F.when(user % 2 == 0, "v1").otherwise("v2")
    answer = F.concat(clock, F.lit("  200  "), version, F.lit(" pod-"), (user % 5).cast("string"), F.lit(" "),
                      F.regexp_extract("props", "[0-9]+", 0), F.lit("ms"))
    line = (F.when(event % 103 == 11, F.concat(clock, F.lit("  200  v")))
            .when(event % 107 == 13, F.concat(F.lit("-- rotated "), F.col("event_type")))
            .when(F.col("event_type") == "error", F.concat(clock, F.lit("  ERR  503"))).otherwise(answer))
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    return spark.read.text(path)


@query("""SELECT l_orderkey, l_linenumber, l_partkey,
          CAST(3.00 + 0.85 * (abs(l_partkey - l_suppkey) % 40 + 1) AS DOUBLE) AS quote_v1,
          CAST(3.25 + 0.85 * (abs(l_partkey - l_suppkey) % 40 + 1) AS DOUBLE) AS quote_v2 FROM lineitem""")
def q2_fare_quotes(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        fare_quote("l_partkey", "l_suppkey", 3.00).cast("double").alias("quote_v1"),
        fare_quote("l_partkey", "l_suppkey", 3.25).cast("double").alias("quote_v2"))
