"""Partition replacement, exports, and tables with versions."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.operators import writes
from millrace.operators.aggregates import ordered_distinct_text
from millrace.operators.versions import VersionedTable, read_snapshot
from millrace.session import scratch_path
from millrace.sources import files

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
T0, T1, T2 = (dt.datetime(2024, 2, d, 12) for d in (1, 2, 3))


def _rows(spark):
    return spark.createDataFrame([(1, D1, 5.0), (2, D1, None), (3, D2, 7.0), (4, None, 1.0)], "id long, day date, v double")


def _ids(df):
    return sorted(r["id"] for r in df.collect())


def _held(spark, partition="day"):
    held = VersionedTable(spark, scratch_path(spark, "held"), partition)
    held.create(_rows(spark), T0)
    return held


@pytest.mark.parametrize("partition", ["day", None])
def test_delete_keeps_rows_without_an_answer(spark, partition):
    held = _held(spark, partition)
    held.delete_where(F.col("v") > 4, T1)
    assert _ids(held.latest()) == [2, 4]
    assert _ids(held.as_of(T0)) == [1, 2, 3, 4]


def test_delete_in_the_partition_without_a_day(spark):
    held = _held(spark)
    held.delete_where(F.col("v") == 1.0, T1)
    assert _ids(held.latest()) == [1, 2, 3]


def test_one_day_deleted_and_restored_without_a_copy(spark):
    held = _held(spark)
    held.delete_where(F.col("day") == F.lit(D1), T1)
    assert _ids(held.latest()) == [3, 4]
    number = held.restore_partition(D1, T0, T2)
    assert _ids(held.latest()) == [1, 2, 3, 4]
    restored = held.log().where(F.col("version") == number).first()
    assert "/_version=1/" in restored["path"]
    assert [r["version"] for r in held.versions().orderBy("version").collect()] == [1, 2, 3]


def test_replacing_a_day_by_nothing_clears_it(spark):
    held = _held(spark)
    held.replace_partition(D1, _rows(spark).limit(0), T1)
    assert _ids(held.latest()) == [3, 4]


def test_insert_touches_only_its_partitions(spark):
    held = _held(spark)
    number = held.insert(spark.createDataFrame([(9, D2, 2.0), (8, None, 2.0)], "id long, day date, v double"), T1)
    assert _ids(held.latest()) == [1, 2, 3, 4, 8, 9]
    assert held.log().where(F.col("version") == number).count() == 2


def test_insert_reads_no_old_file(spark, tmp_path):
    held = VersionedTable(spark, str(tmp_path / "t"), "day")
    held.create(_rows(spark), T0)
    kept = {p: p.read_bytes() for p in (tmp_path / "t" / "_version=1").rglob("*.parquet")}
    for p in kept:
        p.write_bytes(b"not a Parquet file")
    held.insert(spark.createDataFrame([(9, D2, 2.0), (10, D1, 2.0)], "id long, day date, v double"), T1)
    held.insert(spark.createDataFrame([(2.5, D2, 11)], "v double, day date, id long"), T2)
    for p, data in kept.items():
        p.write_bytes(data)
        (p.parent / f".{p.name}.crc").unlink(missing_ok=True)
    assert _ids(held.latest()) == [1, 2, 3, 4, 9, 10, 11] and _ids(held.as_of(T1)) == [1, 2, 3, 4, 9, 10]
    held.delete_where(F.col("v") == 2.0, T2)
    assert _ids(held.latest()) == [1, 2, 3, 4, 11]
    with pytest.raises(ValueError, match="columns"):
        held.insert(spark.createDataFrame([(1,)], "id long"), T2)


def test_restoring_a_day_of_several_folders_and_compacting_it(spark):
    held = _held(spark)
    held.insert(spark.createDataFrame([(9, D1, 2.0)], "id long, day date, v double"), T1)
    held.replace_partition(D1, _rows(spark).limit(0), T2)
    number = held.restore_partition(D1, T1, T2)
    assert _ids(held.latest()) == [1, 2, 3, 4, 9]
    assert held.log().where(F.col("version") == number).count() == 2
    number = held.compact_partition(D1, T2)
    assert _ids(held.latest()) == [1, 2, 3, 4, 9] and held.log().where(F.col("version") == number).count() == 1
    held.restore_version(2, T2)
    assert _ids(held.latest()) == [1, 2, 3, 4, 9]


TYPED = [("timestamp", dt.datetime(2024, 1, 1, 0, 0, 0, 500000), dt.datetime(2024, 1, 1)), ("timestamp_ntz", dt.datetime(2024, 1, 1, 1, 2, 3, 120000), dt.datetime(2024, 1, 2)),
         ("double", 1e16, 0.1), ("float", 0.5, 3e-7), ("decimal(20,3)", Decimal("12.500"), Decimal("-7.000")), ("date", D1, D2), ("long", 2 ** 60, -1),
         ("string", "1e16", "x y/z"), ("boolean", True, False)]


@pytest.mark.parametrize("kind,value,other", TYPED, ids=[k for k, _, _ in TYPED])
def test_partitions_by_any_type(spark, tmp_path, kind, value, other):
    schema = f"k {kind}, v int"
    rows = spark.createDataFrame([(value, 1), (value, 2), (other, 3), (None, 4)], schema)
    fresh, path = spark.createDataFrame([(value, 9)], schema), str(tmp_path / "plain")
    rows.write.partitionBy("k").parquet(path)

    def plain():
        return sorted(r["v"] for r in spark.read.schema(schema).option("basePath", path).parquet(path).collect())

    writes.replace_partition(fresh, path, "k", value)
    assert plain() == [3, 4, 9]
    writes.replace_partition(rows.limit(0), path, "k", other)
    assert plain() == [4, 9]

    held = VersionedTable(spark, str(tmp_path / "held"), "k")

    def values():
        return sorted(r["v"] for r in held.latest().collect())

    held.create(rows, T0)
    held.replace_partition(value, fresh, T1)
    assert values() == [3, 4, 9]
    held.insert(spark.createDataFrame([(other, 5)], schema), T1)
    held.delete_where(F.col("k") == F.lit(value).cast(kind), T1)
    assert values() == [3, 4, 5]
    held.restore_partition(value, T0, T2)
    held.replace_partition(other, rows.limit(0), T2)
    assert values() == [1, 2, 4]
    assert sorted(r["v"] for r in held.latest().where(F.col("k") == F.lit(value).cast(kind)).collect()) == [1, 2]


def test_dropped_column_stays_in_earlier_versions(spark):
    held = _held(spark)
    held.drop_column("v", T1)
    assert held.latest().columns == ["id", "day"] and held.as_of(T0).columns == ["id", "day", "v"]


def test_empty_table_comes_back(spark):
    held = _held(spark)
    held.overwrite(_rows(spark).limit(0), T1)
    assert _ids(held.latest()) == []
    held.restore_version(1, T2)
    assert _ids(held.latest()) == [1, 2, 3, 4] and _ids(held.version(2)) == []


def test_no_version_that_old_and_no_second_create(spark):
    held = _held(spark)
    with pytest.raises(ValueError, match="no version"):
        held.as_of(dt.datetime(2020, 1, 1))
    with pytest.raises(ValueError, match="exists"):
        held.create(_rows(spark), T1)


def test_failed_write_is_invisible(spark):
    held = _held(spark)
    broken = _rows(spark).withColumn("v", F.when(F.col("id") == 3, F.raise_error(F.lit("no"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="no"):
        held.overwrite(broken, T1)
    assert _ids(held.latest()) == [1, 2, 3, 4]


def test_snapshot_expires(spark):
    held, target = _held(spark), scratch_path(spark, "copy")
    held.snapshot(target, dt.date(2024, 3, 1))
    held.delete_where(F.lit(True), T1)
    assert _ids(read_snapshot(spark, target, dt.date(2024, 2, 1))) == [1, 2, 3, 4]
    assert _ids(read_snapshot(spark, target, dt.date(2024, 3, 1))) == []


def test_replace_partition_refuses_other_rows(spark):
    path = scratch_path(spark, "replace")
    with pytest.raises(Exception, match="does not belong"):
        writes.replace_partition(_rows(spark).where("day IS NOT NULL"), path, "day", D1)


def test_ordered_export_has_no_empty_and_no_mixed_files(spark):
    path = scratch_path(spark, "export")
    writes.export_ordered(spark.range(5000).select(F.reverse(F.col("id").cast("string")).alias("k")), path, ["k"])
    spans = sorted(tuple(r) for r in spark.read.parquet(path).groupBy(F.col("_metadata.file_name")).agg(
        F.min("k").alias("low"), F.max("k").alias("high")).select("low", "high").collect())
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert len(spark.read.parquet(path).inputFiles()) == len(spans) < 8


def test_csv_by_name_with_files_of_different_columns(spark):
    a, b = scratch_path(spark, "csv"), scratch_path(spark, "csv")
    spark.createDataFrame([("x", 1)], "name string, n int").write.option("header", True).csv(a)
    spark.createDataFrame([(2, "new")], "n int, extra string").write.option("header", True).csv(b)
    target = spark.createDataFrame([], "n long, name string").schema
    got = files.read_csv_by_name(spark, [a, b], target)
    assert got.columns == ["n", "name", "extra"]
    assert sorted(map(tuple, got.collect())) == [(1, "x", None), (2, None, "new")]


def test_csv_by_name_with_several_layouts_in_one_folder(spark, tmp_path):
    folder = tmp_path / "mixed [1] é"
    folder.mkdir()
    for name, text in (("a b.csv", "a,b\n1,2\n"), ("c%20d.csv", "b,a\n20,10\n"), ("e.csv", ""), ("f.csv", "\na,b\n3,4"), ("g.csv", "b\n")):
        (folder / name).write_text(text)
    target = spark.createDataFrame([], "a int, b int").schema
    path = str(folder).replace("[", "\\[").replace("]", "\\]")
    assert sorted(map(tuple, files.read_csv_by_name(spark, [path], target).collect())) == [(1, 2), (3, 4), (10, 20)]
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "e.csv").write_text("")
    assert files.read_csv_by_name(spark, [str(tmp_path / "none")], target).collect() == []


def test_many_csv_files_of_three_layouts_are_one_scan(spark, tmp_path):
    """Quoted cells, repeated and empty names; the plan has one scan of rows and no union, however many files there are."""
    for i in range(300):
        head, row = (("a,b,x", f"{i},2,q"), ("b,a", f"20,{i}"), ('"a",,A', f'{i},"u,v",w'))[i % 3]
        (tmp_path / f"f{i}.csv").write_text(f"{head}\n{row}\n")
    target = spark.createDataFrame([], "a int, b int").schema
    got = files.read_csv_by_name(spark, [str(tmp_path)], target)
    assert got.columns == ["a", "b", "a0", "_c1", "A2", "x"]
    rows = {(r["a"], r["b"], r["x"], r["a0"], r["_c1"], r["A2"]) for r in got.collect()}
    assert len(rows) == 300 and {(0, 2, "q", None, None, None), (1, 20, None, None, None, None), (None, None, None, "2", "u,v", "w")} <= rows
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("csv") == 1


def test_offsets_are_bytes(spark, tmp_path):
    (tmp_path / "lines.txt").write_bytes("é,1\nab\r\nlast".encode())
    lines = files.read_text_with_offset(spark, str(tmp_path / "lines.txt"))
    assert sorted(map(tuple, lines.select("offset", "body").collect())) == [(0, "é,1"), (5, "ab"), (9, "last")]


def test_offsets_over_splits_and_files(spark, tmp_path):
    want = set()
    for name, count in (("a.txt", 3000), ("b.txt", 40), ("empty.txt", 0)):
        data = "".join("ü" * (i % 23) + f" {i}\n" for i in range(count)).encode()
        (tmp_path / name).write_bytes(data)
        at = 0
        for line in data.split(b"\n")[:-1]:
            want.add((name, at, line.decode()))
            at += len(line) + 1
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = files.read_text_with_offset(spark, str(tmp_path))
        got = [(r["file"].rsplit("/", 1)[1], r["offset"], r["body"]) for r in lines.collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == len(want) and set(got) == want


def test_one_file_and_one_text_are_bounded(spark, tmp_path):
    rows = spark.range(20).select("id", F.lit("g").alias("g"))
    writes.export_rollup_csv(rows, str(tmp_path / "fits"), most=20)
    assert spark.read.option("header", True).csv(str(tmp_path / "fits")).count() == 20
    with pytest.raises(Exception, match="more than 19 rows"):
        writes.export_rollup_csv(rows, str(tmp_path / "too-long"), most=19)
    text = rows.groupBy("g").agg(ordered_distinct_text(F.col("id").cast("string"), most=20).alias("t")).first()["t"]
    assert len(text.split(",")) == 20
    with pytest.raises(Exception, match="more than 19 distinct"):
        rows.groupBy("g").agg(ordered_distinct_text(F.col("id").cast("string"), most=19).alias("t")).collect()


HARD_KEYS = ["a:b", "a/b", "c d", "50%", "x=y", "", None]


def test_partition_names_that_folders_escape(spark, tmp_path):
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(HARD_KEYS)], "k string, v int")
    held = VersionedTable(spark, str(tmp_path / "t"), "k")
    held.create(rows, T0)
    held.replace_partition("a:b", spark.createDataFrame([("a:b", 9)], "k string, v int"), T1)
    held.delete_where(F.col("k") == "a/b", T1)
    assert {r["v"] for r in held.latest().collect()} == {9, 2, 3, 4, 5, 6}
    held.restore_partition("a/b", T0, T2)
    held.insert(spark.createDataFrame([("c d", 10), (None, 11)], "k string, v int"), T2)
    assert {r["v"] for r in held.latest().collect()} == {9, 1, 2, 3, 4, 5, 6, 10, 11}
    held.delete_where(F.lit(True), T2)
    assert held.latest().count() == 0


def test_boolean_partition_and_foreign_rows(spark, tmp_path):
    rows = spark.createDataFrame([(True, 1), (False, 2)], "k boolean, v int")
    held = VersionedTable(spark, str(tmp_path / "t"), "k")
    held.create(rows, T0)
    with pytest.raises(Exception, match="does not belong"):
        held.replace_partition(True, rows, T1)
    held.delete_where(F.col("k"), T1)
    assert [r["v"] for r in held.latest().collect()] == [2]
    with pytest.raises(ValueError, match="no partition"):
        VersionedTable(spark, str(tmp_path / "t"), "k").restore_partition("maybe", T0, T2)


def test_replacing_a_folder_with_an_escaped_name(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("c/d", 1), ("e", 2)], "k string, v int").write.partitionBy("k").parquet(path)
    writes.replace_partition(spark.createDataFrame([("c/d", 3)], "k string, v int"), path, "k", "c/d")
    assert {tuple(r) for r in spark.read.parquet(path).select("k", "v").collect()} == {("c/d", 3), ("e", 2)}
