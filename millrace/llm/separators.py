"""Token counts by a separator scan of flat token files.

A flat file is nothing but token ids of two bytes each, documents one after the other, each closed by the
end-of-document id; it has no index. Files are cut into blocks; a task searches a block for the id with one
vector comparison; a prefix scan over the blocks of a file carries the end of the last document and the
number of documents into the next block, so a document may reach over any number of blocks.

Null and empty texts are documents of no tokens. Tokens after the last separator are one more document.
An empty file has no documents. ``write_flat`` starts a new file after some megabytes, at the end of a document, so
that a file is larger only where one document is; a file is one Spark binary value, 2 GB at most. Columns other than
the text are ignored, and an empty table gives no files with tokens and an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import slices, stored, table
from millrace.llm.tokens import encoder, tokenizer_path
from millrace.session import scratch_path

SEPARATOR, TOKEN_BYTES, BLOCK_BYTES = 49407, 2, 1 << 20
RECORD_BYTES, RECORDS = 1 << 19, 8  # bytes of documents written as one record, records of a file


def write_flat(docs: DataFrame, target: str, separator: int = SEPARATOR, path: str | None = None,
               record_bytes: int = RECORD_BYTES, records: int = RECORDS) -> None:
    """Writes the ids of each text and the separator with Spark's text writer: a row's bytes are the ids of some
    documents with separators between them, and the line separator is the separator's bytes."""
    path = tokenizer_path(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, plain=True)
        for batch in batches:
            for first, length in slices(batch.column(0)):
                ids, bounds = encode.ids(batch.column(0).slice(first, length))
                flat = np.insert(ids, bounds[1:], separator).astype("<u2")
                ends = (bounds[1:] + np.arange(1, len(bounds))) * TOKEN_BYTES  # of each document with its separator
                last = np.flatnonzero(np.diff(ends // record_bytes, append=-1))  # documents that end a record
                begins = np.r_[0, ends[last[:-1]]]
                raw = flat.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([raw[a:b - TOKEN_BYTES] for a, b in zip(begins.tolist(), ends[last].tolist())], pa.binary())], names=["ids"])

    (docs.select("text").mapInArrow(run, "ids binary").select(F.col("ids").cast("string").alias("value"))
     .write.option("encoding", "ISO-8859-1").option("maxRecordsPerFile", records)
     .option("lineSep", separator.to_bytes(TOKEN_BYTES, "little").decode("latin-1")).text(target))


def token_counts(spark: SparkSession, source: str, separator: int = SEPARATOR,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document of the files: file, doc_no, start (tokens before it), n_tokens."""
    files = spark.read.format("binaryFile").load(source).where("length > 0")
    blocks = files.select(
        F.regexp_extract("path", "[^/]+$", 0).alias("file"), "content",
        F.posexplode(F.sequence(F.lit(0), F.ceil(F.col("length") / block_bytes).cast("int") - 1)).alias("block", "_b")).select(
        "file", "block", F.substring("content", F.col("block") * block_bytes + 1, F.lit(block_bytes)).alias("bytes"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.flatnonzero(np.frombuffer(b.as_buffer(), "<u2") == separator) for b in batch.column(2)]
            bounds = np.r_[0, np.cumsum([len(f) for f in found])]
            size = np.array([len(b.as_buffer()) // TOKEN_BYTES for b in batch.column(2)], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size),
                 pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(found).astype(np.int64)))],
                names=["file", "block", "tokens", "ends"])

    per_block = block_bytes // TOKEN_BYTES
    scanned = stored(blocks.mapInArrow(scan, "file string, block int, tokens long, ends array<long>"), "ends")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = scanned.select(
        "file", "block", "tokens", F.transform("ends", lambda e: e + F.col("block").cast("long") * per_block).alias("ends")).withColumn(
        "last", F.element_at(F.when(F.size("ends") > 0, F.col("ends")), -1)).withColumn(
        "begin", F.coalesce(F.max("last").over(earlier) + 1, F.lit(0).cast("long"))).withColumn(
        "documents", F.coalesce(F.sum(F.size("ends")).over(earlier), F.lit(0).cast("long")))
    starts = F.concat(F.array("begin"), F.transform("ends", lambda e: e + 1))
    closed = carried.select("file", "documents", starts.alias("starts"), F.posexplode("ends").alias("i", "end")).select(
        "file", (F.col("documents") + F.col("i")).alias("doc_no"), F.element_at("starts", F.col("i") + 1).alias("start"), "end")
    whole = carried.groupBy("file").agg(
        F.sum(F.size("ends")).cast("long").alias("doc_no"), F.coalesce(F.max("last") + 1, F.lit(0).cast("long")).alias("start"),
        F.sum("tokens").alias("end")).where("start < end")
    return closed.unionByName(whole).select("file", "doc_no", "start", (F.col("end") - F.col("start")).alias("n_tokens"))


def op8_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts over flat files that Spark writes from all documents; ``file`` is the number of the task and of its file."""
    target = scratch_path(spark, "llm-flat")
    write_flat(table(spark, sf_dir, "documents"), target)
    return token_counts(spark, target).withColumn("file", F.regexp_replace("file", r"^part-(\d+)-.*-c(\d+).*$", "$1-$2"))
