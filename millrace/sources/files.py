"""Reading files: CSV by declared, inferred or named columns, partitions, shards, plain text."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from millrace.operators.joins import bounded_broadcast_join
from millrace.session import scratch_path

LAYOUTS = 10_000  # most different headers of one read; more is an error, never a cut


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header line; without a schema the types are inferred from the data."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def column_names(header: str) -> list[str]:
    """The names a CSV reader takes from a header line: an empty one becomes its place, a repeated one gets it."""
    names = next(csv.reader([header], escapechar="\\"))
    lowered = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if lowered.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def read_csv_by_name(spark: SparkSession, paths: list[str], target: T.StructType) -> DataFrame:
    """Match CSV columns to the target by header name, whatever the order of columns in each file.

    A target column a file lacks becomes NULL, a column the target lacks is added as text. A pass over the raw lines
    finds the header of every file and leaves (file, places of the columns) in the shared folder; then all files
    are one scan by position, joined with that table. The driver sees the different headers, at most ``LAYOUTS``,
    and never the names of files. Without any line the result is an empty target.
    """
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value",
        F.monotonically_increasing_id().alias("at")).where((F.col("block") == 0) & (F.trim("value") != ""))
    path = scratch_path(spark, "headers")
    lines.groupBy("file").agg(F.min_by("value", "at").alias("header")).write.parquet(path)
    headers = spark.read.schema("file string, header string").parquet(path)
    layouts = sorted(r["header"] for r in headers.select("header").distinct().limit(LAYOUTS + 1).collect())
    if len(layouts) > LAYOUTS:
        raise ValueError(f"more than {LAYOUTS} different headers")
    if not layouts:
        return spark.createDataFrame([], target)
    names = [column_names(h) for h in layouts]
    wanted = list(dict.fromkeys([*target.fieldNames(), *(n for found in names for n in found)]))
    places = F.create_map(*[c for header, found in zip(layouts, names) for c in (
        F.lit(header), F.array(*[F.lit(found.index(n) if n in found else None).cast("int") for n in wanted]))])
    mapped = headers.select("file", F.element_at(places, F.col("header")).alias("_places"))

    width = max(map(len, names))
    by_position = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])
    rows = spark.read.option("header", True).schema(by_position).csv(paths).select(
        F.array(*by_position.fieldNames()).alias("_cells"), F.col("_metadata.file_path").alias("file"))
    cells = bounded_broadcast_join(rows, mapped, "file")
    types = {f.name: f.dataType for f in target.fields}
    return cells.select(*[F.get("_cells", F.get("_places", i)).cast(types.get(n, T.StringType())).alias(n) for i, n in enumerate(wanted)])


def read_partitioned(spark: SparkSession, root: str) -> DataFrame:
    """key=value folders; the key comes from the path."""
    return spark.read.option("basePath", root).parquet(root)


def read_shards(spark: SparkSession, root: str, prefix: str) -> DataFrame:
    """Date-sharded folders ``<prefix>suffix=<s>`` as one table with a ``suffix`` column.

    A filter on the suffix prunes whole folders before any file is opened.
    """
    return spark.read.option("basePath", root).parquet(f"{root}/{prefix}*")


def read_text_with_offset(spark: SparkSession, path: str) -> DataFrame:
    """(offset, body, file): each line with the byte at which it starts in its file.

    A line belongs to one split of its file, so the lines of a split start where those of the splits
    before it end: bytes are summed by split and inside each, never over a whole file in one task.
    Lines end in a line feed, before which a carriage return is not part of the body; files have no
    byte order mark. Where the offset is not needed, ``spark.read.text`` does without the shuffle.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"), (F.octet_length("value") + 1).cast("long").alias("_bytes"),
        F.when(F.col("value").endswith("\r"), F.expr("left(value, length(value) - 1)")).otherwise(F.col("value")).alias("body"))

    def before(by, order, size):
        earlier = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(size).over(earlier), F.lit(0))

    splits = lines.groupBy("file", "_block").agg(F.sum("_bytes").alias("_size"))
    starts = splits.select("file", "_block", before(["file"], "_block", "_size").alias("_start"))
    inside = lines.withColumn("_inside", before(["file", "_block"], "_at", "_bytes"))
    return (inside.join(starts, ["file", "_block"])
            .select((F.col("_start") + F.col("_inside")).alias("offset"), "body", "file"))


def read_whitespace(spark: SparkSession, path: str, columns: list[tuple[str, str]],
                    missing: str = "?") -> DataFrame:
    """Whitespace-delimited text; the last column may be quoted and hold spaces."""
    fields = F.split(F.trim("value"), r"\s+", len(columns))
    last = len(columns) - 1
    parts = [F.nullif(F.regexp_replace(F.get(fields, i), '^"|"$', "") if i == last else F.get(fields, i),
                      F.lit(missing)).cast(t).alias(c) for i, (c, t) in enumerate(columns)]
    return spark.read.text(path).where(F.length(F.trim("value")) > 0).select(*parts)


def read_number_arrays(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines that are arrays of numbers."""
    return spark.read.text(path).select(F.from_json("value", "array<double>").alias("instance"))
