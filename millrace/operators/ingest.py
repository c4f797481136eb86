"""Validated batch ingest: parse text lines, quarantine what fails, reconcile counts."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from millrace.functions.scalars import safe_double, safe_int, safe_timestamp

# Codes, messages and stage name of a quarantined record.
CODE_TYPE, CODE_DATETIME = 0, 2
CODE_FIELDS = 1  # own code: the line has more or fewer fields than the recipe
MESSAGE_FIELDS = "The record does not have %d fields."
MESSAGE_TYPE = "Error encountered while executing 'set-type' : Column '%s' cannot be converted to a '%s'."
MESSAGE_DATETIME = ("Value %s for column %s is not in expected format yyyy-MM-dd HH:mm:ss "
                    "(ecode: 2, directive: parse-as-datetime)")
STAGE = "Wrangler"


@dataclass(frozen=True)
class Recipe:
    """Column names in file order, and the typed ones in the order in which they are tried."""
    names: tuple[str, ...]
    integers: tuple[str, ...] = ()
    doubles: tuple[str, ...] = ()
    datetimes: tuple[str, ...] = ()

    @property
    def header(self) -> str:
        return ",".join(self.names)


POS_RECIPE = Recipe(("txn_id", "store_id", "txn_ts", "sku", "qty", "amount"),
                    integers=("qty",), doubles=("amount",), datetimes=("txn_ts",))


def without_header(lines: DataFrame, recipe: Recipe) -> DataFrame:
    """Every file starts with the same header line; it is no record."""
    return lines.where(~F.col("body").eqNullSafe(recipe.header))


def parse_lines(lines: DataFrame, recipe: Recipe) -> DataFrame:
    """Typed columns next to ``body``, and ``error`` for the first conversion that failed.

    A failed value is NULL; an empty field is NULL without being an error. A line whose number
    of fields isn't the recipe's, an empty or missing one included, is an error before any other.
    """
    fields = ", ".join(f"_raw_{n} string" for n in recipe.names) + ", _miscounted string"
    # Generated rows: a filter on the result cannot be pushed into the parser and run it again.
    raw = lines.select("*", F.inline(F.array(F.from_csv("body", fields, {"columnNameOfCorruptRecord": "_miscounted"}))))

    def raw_of(name):
        return F.col(f"_raw_{name}")

    def failure(name, typed, code, message):
        return F.when(raw_of(name).isNotNull() & typed.isNull(),
                      F.struct(F.lit(code).alias("errCode"), message.alias("errMsg")))

    typed = {n: raw_of(n) for n in recipe.names}
    blank = F.coalesce(F.trim("body"), F.lit("")) == ""
    failures = [F.when(F.col("_miscounted").isNotNull() | (blank & F.lit(len(recipe.names) > 1)), F.struct(
        F.lit(CODE_FIELDS).alias("errCode"), F.lit(MESSAGE_FIELDS % len(recipe.names)).alias("errMsg")))]
    for names, convert, label in ((recipe.integers, safe_int, "integer"), (recipe.doubles, safe_double, "double")):
        for n in names:
            typed[n] = convert(raw_of(n))
            failures.append(failure(n, typed[n], CODE_TYPE, F.lit(MESSAGE_TYPE % (n, label))))
    for n in recipe.datetimes:
        typed[n] = safe_timestamp(raw_of(n))
        failures.append(failure(n, typed[n], CODE_DATETIME,
                                F.format_string(MESSAGE_DATETIME, raw_of(n), F.lit(n))))
    return raw.select(*lines.columns, *[c.alias(n) for n, c in typed.items()],
                      F.coalesce(*failures).alias("error"))


def good_rows(parsed: DataFrame, recipe: Recipe) -> DataFrame:
    return parsed.where(F.col("error").isNull()).select(*recipe.names)


def error_rows(parsed: DataFrame, recipe: Recipe) -> DataFrame:
    """Records for the quarantine: what came with the line, then code, message and stage."""
    carried = [c for c in parsed.columns if c not in recipe.names and c != "error"]
    return parsed.where(F.col("error").isNotNull()).select(
        *carried, F.col("error.errCode").alias("errCode"), F.col("error.errMsg").alias("errMsg"),
        F.lit(STAGE).alias("errStage"))


def ingest_run(parsed: DataFrame, root: str, run: str) -> None:
    """Write good and bad rows in one pass over the source.

    Both kinds go below the folder of the run, split by an ``_outcome`` partition, and a
    second write of the same run replaces the first: a retry never doubles a row.
    """
    outcome = F.when(F.col("error").isNull(), "loaded").otherwise("quarantined")
    parsed.withColumn("_outcome", outcome).write.mode("overwrite").partitionBy("_outcome").parquet(f"{root}/_run={run}")


def _outcome(spark: SparkSession, root: str, outcome: str) -> DataFrame:
    runs = spark.read.option("basePath", root).parquet(f"{root}/_run=*")
    return runs.where(F.col("_outcome") == outcome).drop("_outcome", "_run")


def loaded(spark: SparkSession, root: str, recipe: Recipe) -> DataFrame:
    return _outcome(spark, root, "loaded").select(*recipe.names)


def quarantined(spark: SparkSession, root: str, recipe: Recipe) -> DataFrame:
    return error_rows(_outcome(spark, root, "quarantined"), recipe)


def ingest_with_counts(lines: DataFrame, recipe: Recipe, root: str, run: str) -> dict[str, int]:
    """Run the ingest and return records seen at each stage, counted while they pass by."""
    source, parsed_stage = Observation("source"), Observation("parsed")
    one = F.count(F.lit(1))
    parsed = parse_lines(without_header(lines.observe(source, one.alias("n")), recipe), recipe)
    failed = F.count_if(F.col("error").isNotNull())
    ingest_run(parsed.observe(parsed_stage, one.alias("n"), failed.alias("failed")), root, run)
    seen, parsed_counts = source.get, parsed_stage.get
    return {"source": seen["n"], "header": seen["n"] - parsed_counts["n"], "recipe_in": parsed_counts["n"],
            "quarantined": parsed_counts["failed"], "loaded": parsed_counts["n"] - parsed_counts["failed"]}


def reconcile(source: DataFrame, loaded_rows: DataFrame, quarantine: DataFrame, header: str) -> DataFrame:
    """One row: loaded + quarantined must equal source lines less headers."""
    def tagged(df, header_rows):
        return df.agg(F.count(F.lit(1)).alias("n"), header_rows.alias("headers"))

    parts = reduce(DataFrame.unionByName, [
        tagged(source, F.count_if(F.col("body") == header)).withColumn("part", F.lit("source")),
        tagged(loaded_rows, F.lit(0).cast("long")).withColumn("part", F.lit("loaded")),
        tagged(quarantine, F.lit(0).cast("long")).withColumn("part", F.lit("quarantined"))])

    def of(part):
        return F.sum(F.when(F.col("part") == part, F.col("n")).otherwise(0))

    return (parts.agg(of("source").alias("source_lines"), F.sum("headers").alias("header_lines"),
                      of("loaded").alias("loaded"), of("quarantined").alias("quarantined"))
            .withColumn("reconciled", F.col("loaded") + F.col("quarantined")
                        == F.col("source_lines") - F.col("header_lines")))


class SchemaDrift(ValueError):
    """The incoming columns are not those of the target table."""


def schema_gate(df: DataFrame, target: T.StructType) -> DataFrame:
    """The frame itself if its columns and types are the target's; nothing is written otherwise."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in target.fields}
    if have != want:
        faults = [f"missing {n}" for n in want if n not in have]
        faults += [f"extra {n}" for n in have if n not in want]
        faults += [f"type {n}: {have[n]} instead of {want[n]}" for n in want if n in have and have[n] != want[n]]
        raise SchemaDrift(", ".join(faults))
    return df.select(*target.fieldNames())


def rule_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, violations): business rules on well-typed rows, all counted in one pass."""
    counts = df.agg(*[F.count_if(c).alias(n) for n, c in rules.items()])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules])))
