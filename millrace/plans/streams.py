"""J: the register stream, replayed from the events table; A12, B10 and B11 with it."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.plans.registry import query, table
from millrace.session import scratch_path
from millrace.streaming import messages as M, panes as P, runs, windows as W

# Deliveries come in portions of ten days. Some messages are three or twelve days late,
# some come twice, some cannot be parsed, some have no usable time, some have no sale id.
LATENESS_DAYS = 4
FEED_SQL = """(
  SELECT event_id, CASE WHEN event_id % 223 <> 5 AND event_id % 229 <> 7 THEN e.ts END AS ts, event_type AS store_id,
         CASE WHEN event_id % 227 <> 9 THEN 'S-' || CAST(event_id AS VARCHAR) END AS sale_id, copy,
         CASE WHEN event_id % 211 = 0 THEN '"12,50"' ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS total,
         CASE WHEN event_id % 211 <> 0 AND event_id % 223 <> 5 AND event_id % 229 <> 7 THEN value END AS amount,
         CAST(floor((epoch_us(e.ts) // 1000 + CASE event_id % 97 WHEN 0 THEN 259200000 WHEN 1 THEN 1036800000 ELSE 0 END
              - 1704067200000) / 864000000) AS BIGINT) AS portion
  FROM events e, (VALUES (0), (1)) AS c(copy) WHERE copy = 0 OR event_id % 50 = 0)"""
HOUR = "date_trunc('hour', ts)"
SHOWN = "strftime(w, '%Y-%m-%d %H:%M:%S')"
SUM = "CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE)"
BODY_SQL = """'{"store_id": "' || store_id || '", "lane": ' || CAST(event_id % 9 AS VARCHAR) || ', "total": ' || total || '}'"""


def feed(spark, sf_dir, copy_days=0):
    """Messages with the portion in which they are delivered; repeats come ``copy_days`` later."""
    event = F.col("event_id")
    copies = F.when(event % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    late = F.when(event % 97 == 0, 259200000).when(event % 97 == 1, 1036800000).otherwise(0)
    at = F.unix_millis(F.col("ts").cast("timestamp")) + late + F.col("copy") * (copy_days * 86400000)
    time = F.when(event % 223 == 5, "soon").when(event % 229 != 7, F.col("ts").cast("string"))
    total = F.when(event % 211 == 0, '"12,50"').otherwise(F.col("value").cast("decimal(18,2)").cast("string"))
    return (table(spark, sf_dir, "events").withColumn("copy", F.explode(copies)).select(
        F.concat(F.lit('{"store_id": "'), F.col("event_type"), F.lit('", "lane": '), (event % 9).cast("string"),
                 F.lit(', "total": '), total, F.lit("}")).alias("body"),
        F.create_map(F.lit("event_ts"), time,
                     F.lit("sale_id"), F.when(event % 227 != 9, F.concat(F.lit("S-"), event.cast("string")))).alias("attributes"),
        F.concat(F.lit("M-"), event.cast("string"), F.lit("-"), F.col("copy").cast("string")).alias("message_id"),
        F.floor((at - 1704067200000) / 864000000).alias("portion")))


def replay(spark, sf_dir, label, build, by_portion=False, save=None, flush=True, watch=None, copy_days=0):
    """Deliver the feed portion by portion, running the stream over each; the stored rows.

    Without ``by_portion`` everything is delivered at once. ``build`` turns usable sales
    into the streaming result. The flush comes sixty days after the newest sale.
    """
    inbox, out, checkpoint = (scratch_path(spark, f"{label}-{n}") for n in ("in", "out", "state"))
    everything = feed(spark, sf_dir, copy_days)
    newest = F.col("attributes")["event_ts"].try_cast("timestamp")
    first, last, end = everything.agg(
        F.coalesce(F.min("portion"), F.lit(0)), F.coalesce(F.max("portion"), F.lit(-1)),
        F.coalesce((F.max(newest) + F.make_dt_interval(days=F.lit(60))).cast("string"), F.lit("2024-06-01"))).first()
    deliveries = ([everything.where(F.col("portion") == p).drop("portion") for p in range(first, last + 1)]
                  if by_portion else [everything.drop("portion")])
    if flush and by_portion:
        deliveries.append(runs.flush_record(spark, end))
    elif flush:
        deliveries = [deliveries[0].unionByName(runs.flush_record(spark, end))]
    with runs.progress(spark) as progress:
        for delivery in deliveries:
            runs.deliver(delivery, inbox)
            parsed = M.parse_sales(M.with_event_time(M.read_feed(spark, inbox)))
            done = runs.start(build(parsed), (save or runs.save_batch)(out), checkpoint)
            done.awaitTermination()
            if watch is not None:
                watch.extend(progress.rows(done))
    return out


def _shown(df):
    return df.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


def _hourly(parsed):
    return W.window_totals(M.sales(parsed), "1 hour")


def _hourly_once(parsed):
    return W.window_totals(W.once_per_sale(M.sales(parsed), "0 seconds"), "1 hour", delay=None)


HOURLY_SQL = f"""SELECT {SHOWN} AS window_start, store_id, count(*) AS sales, {SUM} AS revenue, '1' AS pane
                 FROM (SELECT *, {HOUR} AS w FROM {FEED_SQL}) WHERE amount IS NOT NULL {{where}} GROUP BY w, store_id"""


@query(f"SELECT sale_id, count(*) AS deliveries, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS at FROM {FEED_SQL} GROUP BY 1")
def a12_message_stream(spark, sf_dir):
    """Messages landed with event time and producer id taken from their attributes."""
    out = replay(spark, sf_dir, "a12", lambda parsed: parsed.select("sale_id", "ts"), flush=False)
    return runs.read_batches(spark, out).groupBy("sale_id").agg(
        F.count(F.lit(1)).alias("deliveries"), F.date_format(F.min("ts"), "yyyy-MM-dd HH:mm:ss").alias("at"))


@query(HOURLY_SQL.format(where=""))
def j1_window_totals(spark, sf_dir):
    return _shown(runs.read_batches(spark, replay(spark, sf_dir, "j1", _hourly)))


# Without allowed lateness a message is dropped when its window closed before its portion came.
WATERMARK_SQL = f"""(SELECT f.*, {HOUR} AS w, {HOUR} + INTERVAL 1 HOUR AS w_end, m.seen
   FROM {FEED_SQL} f LEFT JOIN (
     SELECT p.portion, (SELECT max(ts) FROM {FEED_SQL} b WHERE b.portion < p.portion AND b.amount IS NOT NULL) AS seen
     FROM (SELECT DISTINCT portion FROM {FEED_SQL}) p) m USING (portion) WHERE amount IS NOT NULL)"""


@query(f"""SELECT {SHOWN} AS window_start, store_id, count(*) AS sales, {SUM} AS revenue, '1' AS pane
           FROM {WATERMARK_SQL} WHERE seen IS NULL OR w_end > date_trunc('millisecond', seen) GROUP BY w, store_id""")
def j2_late_records_dropped(spark, sf_dir):
    return _shown(runs.read_batches(spark, replay(spark, sf_dir, "j2", _hourly, by_portion=True)))


PANES_SQL = f"""WITH k AS (SELECT *, seen IS NULL OR w_end > date_trunc('millisecond', seen) AS in_time FROM {WATERMARK_SQL}
                  WHERE seen IS NULL OR date_trunc('millisecond', seen) - INTERVAL {LATENESS_DAYS} DAY < w_end),
       a AS (SELECT w, store_id, count(*) AS sales, sum(CAST(amount AS DECIMAL(18,2))) AS revenue FROM k WHERE in_time GROUP BY 1, 2),
       b AS (SELECT w, store_id,
               count(*) OVER o AS late_sales, sum(CAST(amount AS DECIMAL(18,2))) OVER o AS late_revenue
             FROM k WHERE NOT in_time WINDOW o AS (PARTITION BY w, store_id ORDER BY portion, ts, copy
                                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
       p AS (SELECT w, store_id, sales, revenue, '1' AS pane FROM a
             UNION ALL SELECT b.w, b.store_id, coalesce(sales, 0) + late_sales, coalesce(revenue, 0) + late_revenue, '2'
             FROM b LEFT JOIN a ON a.w = b.w AND a.store_id = b.store_id)"""


def _panes(spark, sf_dir, label):
    def save(out):
        return P.save_late_panes(out, f"{out}-open", 3600, LATENESS_DAYS * 86400)

    return runs.read_batches(spark, replay(spark, sf_dir, label, M.sales, by_portion=True, save=save))


@query(f"""{PANES_SQL} SELECT {SHOWN} AS window_start, store_id, sales, CAST(revenue AS DOUBLE) AS revenue, pane FROM p""")
def j3_j4_late_panes(spark, sf_dir):
    """On-time panes, and an accumulating late pane for each record within the allowed lateness."""
    return _shown(_panes(spark, sf_dir, "j3")).drop("pane_index")


@query(f"""{PANES_SQL} SELECT {SHOWN} AS window_start, store_id, max(sales) AS sales,
             CAST(max_by(revenue, sales) AS DOUBLE) AS revenue, max(pane) AS pane FROM p GROUP BY w, store_id""")
def j5_last_pane(spark, sf_dir):
    return _shown(P.last_pane(_panes(spark, sf_dir, "j5")))


@query(HOURLY_SQL.format(where="AND (copy = 0 OR sale_id IS NULL)"))
def j6_once_per_sale(spark, sf_dir):
    """Repeats come twelve days later, in another batch; the state remembers ids for thirty days."""
    def build(parsed):
        return W.window_totals(W.once_per_sale(M.sales(parsed), "30 days"), "1 hour", delay=None)

    return _shown(runs.read_batches(spark, replay(spark, sf_dir, "j6", build, by_portion=True, copy_days=12)))


def _both_sinks(out):
    return runs.save_with_dead_letters(out, lambda batch: (M.sales(batch), M.dead_letters(batch)))


@query(f"""SELECT {BODY_SQL} AS body, 'M-' || CAST(event_id AS VARCHAR) || '-' || CAST(copy AS VARCHAR) AS message_id,
           CASE WHEN event_id % 211 = 0 THEN 'ValueError: could not convert string to float: ''12,50'''
                ELSE 'ValueError: the event time is missing or no time' END AS error, sale_id FROM {FEED_SQL} WHERE amount IS NULL""")
def j7_b11_dead_letters(spark, sf_dir):
    """What cannot be parsed is kept as it came, with the error among its attributes."""
    out = replay(spark, sf_dir, "j7", lambda parsed: parsed, flush=False, save=_both_sinks)
    return runs.read_batches(spark, f"{out}/dead").select(
        "body", "message_id", F.col("attributes")["error"].alias("error"), F.col("attributes")["sale_id"].alias("sale_id"))


@query(f"""SELECT 'baseline' AS job, count(*) AS sales, {SUM} AS revenue, count(DISTINCT {HOUR}) AS windows
             FROM {FEED_SQL} WHERE amount IS NOT NULL AND ts >= TIMESTAMP '2024-01-10'
           UNION ALL SELECT 'dedup', count(*), {SUM}, count(DISTINCT {HOUR})
             FROM {FEED_SQL} WHERE amount IS NOT NULL AND ts >= TIMESTAMP '2024-01-10' AND (copy = 0 OR sale_id IS NULL)""")
def j8_totals_by_job(spark, sf_dir):
    """The tables of two streams over the same feed, added up from one moment on."""
    from millrace.operators.sets import labelled_union
    return labelled_union({
        name: W.totals_since(runs.read_batches(spark, replay(spark, sf_dir, f"j8-{name}", build)), "2024-01-10 00:00:00")
        for name, build in (("baseline", _hourly), ("dedup", _hourly_once))}, "job")


@query(f"""SELECT * FROM ({HOURLY_SQL.format(where="")}) WHERE store_id = 'view'
           AND window_start BETWEEN '2024-01-15 11:00:00' AND '2024-01-15 13:00:00'""")
def j9_windows_around_a_moment(spark, sf_dir):
    stored = runs.read_batches(spark, replay(spark, sf_dir, "j9", _hourly))
    return _shown(W.around(stored, "view", "2024-01-15 12:00:00", minutes=60))


@query(f"""WITH b AS (SELECT portion, count(*) AS n, max(ts) FILTER (amount IS NOT NULL) AS newest FROM {FEED_SQL} GROUP BY 1),
                l AS (SELECT portion, count(*) AS late FROM {WATERMARK_SQL} WHERE w_end <= date_trunc('millisecond', seen) GROUP BY 1)
           SELECT n AS input_rows, strftime(date_trunc('millisecond', newest), '%Y-%m-%d %H:%M:%S.%g') AS newest,
                  (epoch_us(newest) // 1000 - coalesce(epoch_us(max(newest) OVER (
                     ORDER BY portion ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) // 1000, 0)) / 1000 AS behind_seconds,
                  coalesce(late, 0) AS dropped_rows,
                  coalesce(sum(n) OVER (ORDER BY portion ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0)::BIGINT AS backlog_rows,
                  count(*) OVER (ORDER BY portion ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS backlog_files
           FROM b LEFT JOIN l USING (portion)""")
def j10_lag_report(spark, sf_dir):
    """Progress of all batches of a stream that is started after each of its deliveries, a file for each portion.

    Before the first batch the watermark is at zero. Dropped rows are counted exactly, and the backlog of a batch is
    what it had not read of all that has arrived by the end.
    """
    inbox, out, checkpoint = (scratch_path(spark, f"j10-{n}") for n in ("in", "out", "state"))
    everything = feed(spark, sf_dir).withColumn("portion", F.col("portion").cast("long"))
    seen = []
    with runs.progress(spark) as progress:
        for portion in sorted(r["portion"] for r in everything.select("portion").distinct().collect()):
            runs.deliver(everything.where(F.col("portion") == portion).drop("portion").coalesce(1), inbox)
            parsed = M.parse_sales(M.with_event_time(runs.watched_feed(spark, inbox)))
            done = runs.start(W.window_totals(runs.watched_rows(M.sales(parsed)), "1 hour"), runs.save_batch(out), checkpoint)
            done.awaitTermination()
            seen.extend(progress.rows(done))
    report = runs.lag_report(spark, seen, inbox, out, checkpoint, "sales")
    return report.where("input_rows > 0").select(
        "input_rows", F.date_format("max_event_time", "yyyy-MM-dd HH:mm:ss.SSS").alias("newest"), "behind_seconds",
        "dropped_rows", "backlog_rows", "backlog_files")


@query(f"""WITH h AS (SELECT w, store_id FROM (SELECT *, {HOUR} AS w FROM {FEED_SQL}) WHERE amount IS NOT NULL GROUP BY 1, 2),
                m AS (SELECT max(ts) AS newest FROM {FEED_SQL} WHERE amount IS NOT NULL)
           SELECT 'cancelled' AS ending, count(*) AS windows FROM h, m WHERE w + INTERVAL 1 HOUR <= newest
           UNION ALL SELECT 'drained', count(*) FROM h""")
def j11_drain_and_cancel(spark, sf_dir):
    """A cancelled stream leaves its open windows out; a drained one has emitted them all."""
    from millrace.operators.sets import labelled_union
    one = F.count(F.lit(1)).alias("windows")
    return labelled_union({
        name: runs.read_batches(spark, replay(spark, sf_dir, f"j11-{name}", _hourly, flush=flush)).agg(one)
        for name, flush in (("cancelled", False), ("drained", True))}, "ending")


def _twice(out):
    save = runs.save_batch(out)

    def both(batch, batch_id):
        save(batch, batch_id)
        save(batch, batch_id)

    return both


@query(f"SELECT store_id, count(*) AS n, {SUM} AS revenue FROM {FEED_SQL} WHERE amount IS NOT NULL GROUP BY 1")
def b10_stream_table_sink(spark, sf_dir):
    """Every batch is written twice, as after a failure; every row is stored once."""
    from millrace.functions.scalars import money_sum
    out = replay(spark, sf_dir, "b10", lambda parsed: M.sales(parsed).select("store_id", "total"), flush=False, save=_twice)
    return runs.read_batches(spark, out).groupBy("store_id").agg(
        F.count(F.lit(1)).alias("n"), money_sum("total").alias("revenue"))


# ---------------------------------------------------------------- alerts over a running check log
ALERT_SQL = f"""(SELECT e.ts, event_type AS signal, value > 150 AS red,
    CAST(floor((epoch_us(e.ts) // 1000 + CASE event_id % 97 WHEN 0 THEN 259200000 WHEN 1 THEN 1036800000 ELSE 0 END
         - 1704067200000) / 864000000) AS BIGINT) AS portion, time_bucket(INTERVAL 5 MINUTE, e.ts) AS w FROM events e)"""


@query(f"""WITH seen AS (SELECT p.portion, (SELECT max(ts) FROM {ALERT_SQL} b WHERE b.portion < p.portion) AS seen
                         FROM (SELECT DISTINCT portion FROM {ALERT_SQL}) p)
           SELECT {SHOWN} AS window_start, signal, count(*) AS reds FROM {ALERT_SQL} JOIN seen USING (portion)
           WHERE red AND (seen IS NULL OR w + INTERVAL 5 MINUTE > date_trunc('millisecond', seen) - INTERVAL {LATENESS_DAYS} DAY)
           GROUP BY w, signal""")
def k14_red_alerts_of_a_stream(spark, sf_dir):
    """Check results arrive in portions, some three and some twelve days late; windows wait four days for them."""
    from millrace.operators import checks
    inbox, out, checkpoint = (scratch_path(spark, f"k14-{n}") for n in ("in", "out", "state"))
    event, at = F.col("event_id"), F.col("ts").cast("timestamp")
    late = F.when(event % 97 == 0, 259200000).when(event % 97 == 1, 1036800000).otherwise(0)
    log = table(spark, sf_dir, "events").select(
        at.alias("ts"), F.col("event_type").alias("signal"), F.when(F.col("value") > 150, "RED").otherwise("GREEN").alias("status"),
        F.floor((F.unix_millis(at) + late - 1704067200000) / 864000000).alias("portion"))
    first, last, newest = log.agg(F.coalesce(F.min("portion"), F.lit(0)), F.coalesce(F.max("portion"), F.lit(-1)), F.max("ts")).first()
    portions = [log.where(F.col("portion") == p).drop("portion") for p in range(first, last + 1)]
    if newest is not None:  # an entry long after all others closes their windows
        portions.append(spark.range(1).select((F.lit(newest) + F.make_dt_interval(days=F.lit(60))).alias("ts"),
                                              F.lit("end").alias("signal"), F.lit("GREEN").alias("status")))
    for portion in portions:
        portion.write.mode("append").parquet(inbox)
        arriving = spark.readStream.schema("ts timestamp, signal string, status string").parquet(inbox)
        alerts = checks.red_alerts(arriving, delay=f"{LATENESS_DAYS} days")
        runs.start(alerts, runs.save_batch(out), checkpoint).awaitTermination()
    return _shown(runs.read_batches(spark, out) if portions else spark.createDataFrame([], "window_start timestamp, signal string, reds long"))
