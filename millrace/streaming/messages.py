"""The register feed: messages with a JSON body and string attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.scalars import safe_double

# A message as it is delivered. From Kafka: value, headers and offset take these places.
MESSAGE_SCHEMA = "body string, attributes map<string,string>, message_id string"
ERROR_WIDTH = 500


def read_feed(spark: SparkSession, inbox: str, files_per_batch: int = 10_000) -> DataFrame:
    """A stream over a folder into which message files arrive; a backlog is read in several batches."""
    return spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", files_per_batch).json(inbox)


def from_kafka(records: DataFrame) -> DataFrame:
    """Kafka records (read with ``includeHeaders``) as messages; the headers are the attributes."""
    headers = F.map_from_entries(F.transform(F.coalesce("headers", F.array().cast("array<struct<key:string,value:binary>>")),
                                             lambda h: F.struct(h["key"].alias("key"), h["value"].cast("string").alias("value"))))
    place = F.concat_ws("-", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    return records.select(F.col("value").cast("string").alias("body"), headers.alias("attributes"),
                          place.alias("message_id"))


def to_kafka(messages: DataFrame) -> DataFrame:
    """Messages as Kafka records, attributes as headers."""
    headers = F.transform(F.map_entries("attributes"), lambda e: F.struct(
        e["key"].alias("key"), e["value"].cast("binary").alias("value")))
    return messages.select(F.col("body").cast("binary").alias("value"), headers.alias("headers"))


def with_event_time(messages: DataFrame) -> DataFrame:
    """``ts`` and ``sale_id`` from the attributes the producer set."""
    return messages.select("*", F.col("attributes")["event_ts"].try_cast("timestamp").alias("ts"),
                           F.col("attributes")["sale_id"].alias("sale_id"))


def parse_sales(messages: DataFrame) -> DataFrame:
    """``store_id``, ``total`` and, where a message cannot be used, ``error``.

    An event time that is missing or no time is an error too, where ``with_event_time`` was applied.
    Nothing is retried: an unusable message is data for the dead letters. The error
    names follow those of the usual Python exceptions.
    """
    body = F.from_json("body", "store_id string, total string, _corrupt string",
                       {"columnNameOfCorruptRecord": "_corrupt"})
    # Generated rows: a filter on the result cannot be pushed into the parser and run it again.
    read = messages.select("*", F.explode(F.array(body)).alias("_sale"))
    total = safe_double("_sale.total")
    error = (F.when(F.col("_sale").isNull() | F.col("_sale._corrupt").isNotNull(),
                    F.lit("JSONDecodeError: the body is not a JSON object"))
             .when(F.col("_sale.store_id").isNull(), F.lit("KeyError: 'store_id'"))
             .when(F.col("_sale.total").isNull(), F.lit("KeyError: 'total'"))
             .when(total.isNull(), F.concat(F.lit("ValueError: could not convert string to float: '"),
                                            F.col("_sale.total"), F.lit("'"))))
    if "ts" in messages.columns:
        error = error.when(F.col("ts").isNull(), F.lit("ValueError: the event time is missing or no time"))
    return read.select(*messages.columns, F.col("_sale.store_id").alias("store_id"), total.alias("total"),
                       F.substring(error, 1, ERROR_WIDTH).alias("error"))


def sales(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("error").isNull())


def dead_letters(parsed: DataFrame) -> DataFrame:
    """The body as it came, with the error among the attributes the message had."""
    attributes = F.map_concat(F.map_filter(F.coalesce("attributes", F.create_map().cast("map<string,string>")),
                                           lambda k, v: k != "error"),
                              F.create_map(F.lit("error"), F.col("error")))
    return parsed.where(F.col("error").isNotNull()).select("body", attributes.alias("attributes"), "message_id")
