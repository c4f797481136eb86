"""Known answers and refusals: checks, budget, quarantine, policies, scan cost, expressions."""

from __future__ import annotations

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F, types as T

from millrace.functions import scalars as S
from millrace.operators import aggregates, checks, ingest, joins, scan_cost, sets, writes
from millrace.operators.governance import AccessDenied, ColumnTag, RowPolicy, governed_read
from millrace.operators.ingest import POS_RECIPE
from millrace.session import scratch_path
from millrace.sources.metadata import partitions_of


# ---------------------------------------------------------------- error budget
def _runs(spark):
    """Thirty nights: two finish 102 and 195 minutes late, one is wrong until 13:20."""
    rows = []
    for n in range(30):
        night = dt.date(2026, 8, 28) + dt.timedelta(days=n)
        start = dt.datetime.combine(night + dt.timedelta(days=1), dt.time(2, 0))
        late = {6: 102, 19: 195}.get(n)
        finished = start + (dt.timedelta(hours=4, minutes=late) if late else dt.timedelta(minutes=40 + n))
        fixed = dt.datetime.combine(night + dt.timedelta(days=1), dt.time(13, 20)) if n == 24 else None
        rows.append((night, "DONE", finished, 12000, fixed))
    return spark.createDataFrame(rows, "sale_date date, state string, finished_at timestamp_ntz, "
                                       "rows_loaded long, corrected_at timestamp_ntz")


def test_error_budget_golden(spark):
    got = [tuple(r) for r in checks.error_budget(_runs(spark)).collect()]
    assert got == [("job DONE by 06:00", 30, 297, 432.0, 99.31, 68.8),
                   ("data fresh and complete", 30, 737, 432.0, 98.29, 170.6)]


def test_bad_nights(spark):
    assert checks.bad_nights(_runs(spark)).count() == 3


# ---------------------------------------------------------------- nightly checks with planted defects
CONTRACT = [("sale_date", "date"), ("store_id", "string"), ("basket_value", "double")]
AS_OF = dt.datetime(2026, 9, 27, 12, 0)


def _nights(spark, last_rows=100, last_value=40.0, last_nulls=0, drop_last=False):
    rows = []
    for back in range(1, 9):
        day = dt.date(2026, 9, 27) - dt.timedelta(days=back)
        last = back == 1
        if last and drop_last:
            continue
        for i in range(last_rows if last else 100):
            value = last_value if last else 40.0
            rows.append((day, f"S{i % 5}", None if last and i < last_nulls else value))
    return spark.createDataFrame(rows, "sale_date date, store_id string, basket_value double")


def _statuses(spark, rows, contract_rows=None):
    parts = rows.groupBy(F.date_format("sale_date", "yyyyMMdd").alias("partition_id")).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.max(F.date_add("sale_date", 1)).cast("timestamp").alias("last_modified_time"))
    report = checks.nightly_checks(rows, parts, CONTRACT, "sale_date", "basket_value", AS_OF)
    got = [tuple(r) for r in report.collect()]
    assert [r[0] for r in got] == ["freshness", "volume", "schema", "distribution"]
    return {r[0]: r for r in got}


def test_checks_green(spark):
    got = _statuses(spark, _nights(spark))
    assert {r[3] for r in got.values()} == {"GREEN"}
    assert got["volume"][1] == "100 rows, 100% of 7-day mean"
    assert got["distribution"][1:3] == ("null 0.0%, mean $40.00", "null < 1.0%, $40.00 ± 10%")
    assert got["freshness"][1] == "newest 2026-09-26, 12 h old"


@pytest.mark.parametrize("defect,red", [
    (dict(last_rows=3), {"volume"}), (dict(last_nulls=19), {"distribution"}), (dict(last_value=50.0), {"distribution"}),
    (dict(drop_last=True), {"freshness", "volume", "distribution"})])
def test_each_defect_turns_its_check_red(spark, defect, red):
    got = _statuses(spark, _nights(spark, **defect))
    assert {s for s, r in got.items() if r[3] == "RED"} == red


def test_no_earlier_nights_is_red(spark):
    only = _nights(spark).where(F.col("sale_date") == F.lit(dt.date(2026, 9, 26)))
    got = _statuses(spark, only)
    assert got["volume"][1] is None and got["volume"][3] == "RED"


def test_renamed_column_is_missing_and_extra(spark):
    renamed = _nights(spark).withColumnRenamed("basket_value", "basket_total")
    row = checks.schema_check(renamed, CONTRACT).first()
    assert (row["observed"], row["status"]) == ("extra basket_total, missing basket_value", "RED")


def test_trailing_mean_leaves_the_day_out(spark):
    daily = spark.createDataFrame([("a", dt.date(2024, 1, d), float(d)) for d in (1, 2, 3, 12)],
                                  "s string, d date, v double")
    got = {r["d"].day: r["trailing_mean"] for r in aggregates.trailing_mean(daily, ["s"], "d", "v").collect()}
    assert got == {1: None, 2: 1.0, 3: 1.5, 12: None}


# ---------------------------------------------------------------- ingest
# An amount in words, a quantity below zero, which types do not catch, and an hour that no day has.
BAD_LINES = ["b-41,elm,2024-02-11 09:10:00,rice,2,ten", "b-42,oak,2024-02-11 09:12:00,salt,-9,4.05", "b-43,ash,2024-02-11 25:14:00,tea,1,1.10"]


def _parsed(spark, lines):
    frame = spark.createDataFrame([(47 * i, b) for i, b in enumerate(lines)], "offset long, body string")
    return ingest.parse_lines(ingest.without_header(frame, POS_RECIPE), POS_RECIPE)


def test_quarantine_golden(spark):
    parsed = _parsed(spark, [POS_RECIPE.header, *BAD_LINES])
    got = [r.asDict() for r in ingest.error_rows(parsed, POS_RECIPE).orderBy("offset").collect()]
    assert got == [
        {"offset": 47, "body": BAD_LINES[0], "errCode": 0, "errStage": "Wrangler",
         "errMsg": "Error encountered while executing 'set-type' : Column 'amount' cannot be converted to a 'double'."},
        {"offset": 141, "body": BAD_LINES[2], "errCode": 2, "errStage": "Wrangler",
         "errMsg": "Value 2024-02-11 25:14:00 for column txn_ts is not in expected format yyyy-MM-dd HH:mm:ss "
                   "(ecode: 2, directive: parse-as-datetime)"}]
    loaded = ingest.good_rows(parsed, POS_RECIPE).collect()
    assert [r["qty"] for r in loaded] == [-9]


def test_first_failing_step_is_reported(spark):
    parsed = _parsed(spark, ["b-44,fir,2024-02-30 08:00:00,oil,2,free"])
    assert ingest.error_rows(parsed, POS_RECIPE).first()["errCode"] == 0


def test_empty_field_is_null_and_no_error(spark):
    row = _parsed(spark, ["T,S,2026-09-24 11:04:22,K,,1.5"]).first()
    assert row["error"] is None and row["qty"] is None and row["amount"] == 1.5


def test_a_line_is_parsed_once(spark):
    parsed = _parsed(spark, BAD_LINES)
    for kept in (ingest.good_rows(parsed, POS_RECIPE), ingest.error_rows(parsed, POS_RECIPE)):
        assert kept._jdf.queryExecution().executedPlan().toString().count("from_csv(") == 1


def test_empty_and_missing_lines(spark):
    frame = spark.createDataFrame([(1, ""), (2, None), (3, "only,two")], "offset long, body string")
    parsed = ingest.parse_lines(frame, POS_RECIPE)
    assert [tuple(r["error"]) for r in parsed.collect()] == [(1, "The record does not have 6 fields.")] * 3


def test_field_counts(spark):
    good = "T-1,A,2024-01-01 10:00:00,S,1,2.50"
    bodies = [good, good + ",void", good + ",", good.rsplit(",", 1)[0], 'T-2,"A,B",2024-01-01 10:00:00,S,1,', "x"]
    frame = spark.createDataFrame(list(enumerate(bodies)), "offset long, body string")
    parsed = ingest.parse_lines(frame, POS_RECIPE)
    assert {r["offset"] for r in parsed.where("error.errCode = 1").collect()} == {1, 2, 3, 5}
    assert {r["offset"] for r in parsed.where("error IS NULL").collect()} == {0, 4}
    assert parsed.where("offset = 4").first()["store_id"] == "A,B"


def test_parts_of_a_cent_add_up(spark):
    thousand = spark.range(1000).select(F.lit(0.004).alias("v"))
    assert tuple(thousand.agg(S.money_sum("v"), S.money_mean("v")).first()) == (4.0, 0.004)


@pytest.mark.parametrize("text", ["10d", "NaN", "1_000", "", "0x1F", "1 2"])
def test_not_a_number(spark, text):
    assert spark.range(1).select(S.safe_double(F.lit(text))).first()[0] is None


@pytest.mark.parametrize("text,value", [("1", 1.0), ("-2.50", -2.5), (".5", 0.5), ("1e3", 1000.0), (" 7 ", 7.0)])
def test_a_number(spark, text, value):
    assert spark.range(1).select(S.safe_double(F.lit(text))).first()[0] == value


def test_schema_gate_names_every_fault(spark):
    target = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    frame = spark.createDataFrame([("1", 2.0)], "a string, c double")
    with pytest.raises(ingest.SchemaDrift, match="missing b, extra c, type a: string instead of bigint"):
        ingest.schema_gate(frame, target)


def test_run_errors_refuse_a_second_write(spark):
    root = scratch_path(spark, "errors")
    frame = spark.range(2)
    writes.write_run_errors(frame, root, "r1")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        writes.write_run_errors(frame, root, "r1")


def test_ingest_twice_is_the_same(spark):
    root = scratch_path(spark, "twice")
    parsed = _parsed(spark, [*BAD_LINES, "T-1,S,2026-09-24 11:04:22,K,1,1.50"])
    ingest.ingest_run(parsed, root, "20260924")
    once = ingest.loaded(spark, root, POS_RECIPE).collect()
    ingest.ingest_run(parsed, root, "20260924")
    twice = ingest.loaded(spark, root, POS_RECIPE).collect()
    assert sorted(map(repr, once)) == sorted(map(repr, twice)) and len(once) == 2


# ---------------------------------------------------------------- governed reads
def _table(spark):
    return spark.createDataFrame([(1, "2", "x"), (2, "1", "y"), (3, None, "z")], "id long, vendor string, place string")


def test_row_policies(spark):
    policies = (RowPolicy("vendor = '2'", ("analyst",)), RowPolicy("TRUE", ("all",)))
    assert governed_read(_table(spark), "analyst", policies).count() == 1
    assert governed_read(_table(spark), "all", policies).count() == 3
    assert governed_read(_table(spark), "owner", policies).count() == 0
    assert governed_read(_table(spark), "owner").count() == 3


def test_tagged_columns(spark):
    tags = (ColumnTag(("place",), readers=("all",)),)
    with pytest.raises(AccessDenied, match="place"):
        governed_read(_table(spark), "analyst", tags=tags)
    assert governed_read(_table(spark), "analyst", tags=tags, columns=["id", "vendor"]).columns == ["id", "vendor"]
    assert governed_read(_table(spark), "analyst", tags=tags, denied="drop").columns == ["id", "vendor"]
    assert governed_read(_table(spark), "analyst", tags=tags, denied="null").first()["place"] is None
    assert len(governed_read(_table(spark), "analyst", tags=tags, denied="hash").first()["place"]) == 64
    assert governed_read(_table(spark), "all", tags=tags).columns == ["id", "vendor", "place"]


def test_range_is_required(spark):
    with pytest.raises(ValueError, match="without a range"):
        writes.read_day_range(spark, "/nowhere", "dt", None, None)


# ---------------------------------------------------------------- scan cost
def test_widths(spark):
    rows = spark.createDataFrame([(1, "é", 1.0), (None, None, None)], "a long, b string, c double")
    got = {r["column_name"]: r["scan_bytes"] for r in scan_cost.bytes_by_column(rows).collect()}
    assert got == {"a": 8, "b": 4, "c": 8}
    assert scan_cost.scanned_bytes(rows, []).first()["scan_bytes"] == 0
    assert scan_cost.scanned_bytes(rows.limit(0), ["a"]).first()["scan_bytes"] == 0


def test_broadcast_only_within_the_limit(spark):
    dim = spark.createDataFrame([(i, "x" * 100) for i in range(1000)], "k long, v string")
    assert joins.fits_broadcast(dim) and not joins.fits_broadcast(dim, limit=10_000)
    fact = spark.range(5000).select((F.col("id") % 1000).alias("k"), "id")
    small = joins.bounded_broadcast_join(fact, dim, "k")
    large = joins.bounded_broadcast_join(fact, dim, "k", limit=10_000)
    assert sets.disagreement(small, large.select(*small.columns)).count() == 0


# ---------------------------------------------------------------- expressions
def test_scalar_rules(spark):
    one = spark.range(1)
    at = lambda s: F.lit(s).cast("timestamp_ntz")
    row = one.select(
        S.boundary_minutes(at("2024-01-01 00:01:01"), at("2024-01-01 00:00:59")).alias("marks"),
        S.greatest_strict(F.lit(0), F.lit(None).cast("int")).alias("strict"),
        S.month_start(F.lit(dt.date(2024, 2, 17))).alias("month"),
        S.local_date(F.lit("2024-01-31 03:00:00").cast("timestamp"), "America/New_York").alias("local"),
        S.text_or_null("%d", F.lit(None).cast("int")).alias("text"),
        S.fare_quote(F.lit(132), F.lit(236), 3.00).alias("quote"),
        F.round(S.fuel_cost(F.lit(25.0)), 2).alias("fuel")).first()
    assert row["marks"] == 1 and row["strict"] is None and row["text"] is None
    assert row["month"] == dt.date(2024, 2, 1) and row["local"] == dt.date(2024, 1, 30)
    assert float(row["quote"]) == 3.00 + 0.85 * (104 % 40 + 1) and row["fuel"] == 2.56


def test_exclusive_quartiles_follow_the_standard_library(spark):
    chance = random.Random(5)
    groups = {f"g{n}": [chance.choice([chance.random() * 50, 7.0]) for _ in range(n)]
              for n in (1, 2, 3, 4, 5, 6, 7, 40, 200)}
    rows = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double")
    got = {r["g"]: r for r in aggregates.exclusive_quartiles(rows, ["g"], "v").collect()}
    for g, values in groups.items():
        want = statistics.quantiles(values, n=4) if len(values) > 1 else values * 3
        assert [got[g]["p25"], got[g]["median"], got[g]["p75"]] == pytest.approx(want)
        assert (got[g]["n"], got[g]["min"], got[g]["max"]) == (len(values), min(values), max(values))


def test_ranks_of_null_groups(spark):
    rows = spark.createDataFrame([(None, 1.0), (None, 1.0), (None, 3.0), ("a", 2.0)], "g string, v double")
    got = {(r["g"], r["v"]): (r["copies"], r["before"], r["group_rows"])
           for r in aggregates.ranked_values(rows, ["g"], "v").collect()}
    assert got == {(None, 1.0): (2, 0, 3), (None, 3.0): (1, 2, 3), ("a", 2.0): (1, 0, 1)}


def test_largest_row_takes_the_first_of_equals(spark):
    rows = spark.createDataFrame([("a", 5, 2), ("a", 5, 1), ("a", 3, 0), ("b", None, 9)], "g string, v int, o int")
    got = [tuple(r) for r in aggregates.row_of_largest(rows, ["g"], "v", ["o"]).collect()]
    assert got == [("a", 5, 1)]


def test_partition_metadata(spark):
    path = scratch_path(spark, "parts")
    frame = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))], "v int, d date")
    frame.write.partitionBy("d").parquet(path)
    got = partitions_of(spark.read.parquet(path), "d").orderBy("partition_id").collect()
    assert [(r["partition_id"], r["total_rows"]) for r in got] == [("20240101", 1), ("20240102", 1)]


def test_planted_difference_is_found(spark):
    a, b = spark.range(5), spark.range(1, 6).union(spark.range(1, 2))
    got = sorted((r["id"], r["surplus"]) for r in sets.disagreement(a, b).collect())
    assert got == [(0, 1), (1, -1), (5, -1)]


def test_error_budget_counts_its_period_only(spark):
    runs = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), "DONE", dt.datetime(2024, 1, 2, 7) + dt.timedelta(days=i), None) for i in range(60)]
    frame = spark.createDataFrame(runs, "sale_date date, state string, finished_at timestamp, corrected_at timestamp")
    assert {r["bad_min"] for r in checks.error_budget(frame).collect()} == {30 * 60}
    assert {r["bad_min"] for r in checks.error_budget(frame, days=None).collect()} == {60 * 60}


def test_adaptive_join_leaves_the_session_alone(spark):
    from millrace.operators import joins
    frame = spark.createDataFrame([(1, 2)], "k int, v int")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        with pytest.raises(ValueError, match="skewJoin"):
            joins.adaptive_join(frame, frame.withColumnRenamed("v", "w"), "k")
        assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "false"
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


@pytest.mark.parametrize("kind,low,high", [("date", "2024-01-01", "2024-01-02"), ("string", "a", "b"),
                                           ("long", "-9223372036854775808", "-9223372036854775807"), ("double", "-1.5", "2")])
def test_row_of_largest_of_any_type(spark, kind, low, high):
    from millrace.operators.aggregates import row_of_largest
    frame = spark.createDataFrame([("g", low, 1), ("g", high, 3), ("g", high, 2), ("g", None, 0), ("h", low, 4)], "k string, v string, n int")
    got = row_of_largest(frame.withColumn("v", F.col("v").cast(kind)), ["k"], "v", ["n"])
    assert sorted((r["k"], r["n"]) for r in got.collect()) == [("g", 2), ("h", 4)]


def test_widths_of_nested_values(spark):
    from millrace.operators.scan_cost import bytes_by_column
    frame = spark.sql("SELECT array('a', NULL, 'bcd') AS a, map('k', 1) AS m, named_struct('x', 1, 'y', array(true)) AS s, "
                      "CAST(NULL AS array<int>) AS n")
    assert dict(map(tuple, bytes_by_column(frame).collect())) == {"a": 8, "m": 11, "s": 9, "n": 0}
