"""Tables that keep their earlier versions, on plain Parquet folders.

A commit writes new folders first and then appends a few rows to the table's log, for
each partition it changed: either the folders that the partition consists of from now
on, or one more folder. A reader takes, for each partition, the newest such list by the
moment it asks for and what was added since. Deleting or restoring one day therefore
touches one day, an insert writes its own rows and nothing else, and a failed write stays
invisible. The log carries the schema, so no reader has to open files to infer it. One
writer at a time.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from millrace.operators.writes import only_partition, partition_folder

LOG_SCHEMA = "version long, committed_at timestamp, part string, path string, schema string, kind string"
SET, ADD = "set", "add"  # the partition consists of this folder and others of this commit, or has it besides; no kind is SET
WHOLE = "all"


@dataclass(frozen=True)
class State:
    """What a table consists of at some moment: folders by partition, schema, newest version."""
    paths: dict[str, list[str]]
    schema: T.StructType
    version: int


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, partition: str | None = None):
        self.spark, self.root, self.partition = spark, root.rstrip("/"), partition

    # -- reading
    def log(self) -> DataFrame:
        return self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.root}/_log")

    def versions(self) -> DataFrame:
        return self.log().groupBy("version").agg(F.max("committed_at").alias("committed_at"),
                                                 F.count_distinct("part").alias("parts_changed"))

    def as_of(self, moment: dt.datetime) -> DataFrame:
        return self._read(self._state(F.col("committed_at") <= F.lit(moment)))

    def version(self, number: int) -> DataFrame:
        return self._read(self._state(F.col("version") <= F.lit(number)))

    def latest(self) -> DataFrame:
        return self._read(self._state())

    def _state(self, wanted: Column | None = None) -> State:
        """Two aggregations over the log; one row for each folder in use reaches the driver."""
        log = self.log() if wanted is None else self.log().where(wanted)
        last = log.agg(F.max("version").alias("version"), F.max_by("schema", "version").alias("schema")).first()
        if last["version"] is None:
            raise ValueError(f"{self.root} has no version that old")
        is_set = F.coalesce("kind", F.lit(SET)) == SET
        newest = F.max(F.when(is_set, F.col("version"))).over(Window.partitionBy("part"))
        used = (log.select("part", "path", "version", newest.alias("since"))
                .where("part IS NOT NULL AND path IS NOT NULL AND version >= coalesce(since, 0)").collect())
        paths: dict[str, list[str]] = {}
        for r in sorted(used, key=lambda r: (r["version"], r["path"])):
            paths.setdefault(r["part"], []).append(r["path"])
        return State(paths, T.StructType.fromJson(json.loads(last["schema"])), last["version"])

    def _read(self, state: State, parts: list[str] | None = None) -> DataFrame:
        """The table's rows, or those of some of its partitions."""
        folders = sorted(f for part, some in state.paths.items() if parts is None or part in parts for f in some)
        if not folders:
            return self.spark.createDataFrame([], state.schema)
        return (self.spark.read.schema(state.schema).option("basePath", self.root)
                .parquet(*folders).select(*state.schema.fieldNames()))

    def _folder(self, state: State, value) -> str:
        return partition_folder(self.spark, self.partition, state.schema[self.partition].dataType, value)

    @staticmethod
    def _names(rows: DataFrame) -> set[str]:
        """The partition folders in which these stored rows lie; a path is given in URL form."""
        names = rows.select(F.element_at(F.split("_metadata.file_path", "/"), -2).alias("name")).distinct()
        return {unquote(r["name"]) for r in names.collect()}

    # -- changing
    def _commit(self, number: int, when: dt.datetime | None, schema: T.StructType,
                parts: list[tuple[str | None, str | None]], kind: str = SET) -> int:
        moment, text = when or dt.datetime.now(), schema.json()
        rows = [(number, moment, part, path, text, kind) for part, path in parts or [(None, None)]]
        (self.spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1)
         .write.mode("append").parquet(f"{self.root}/_log"))
        return number

    def _store(self, df: DataFrame, number: int) -> dict[str, str]:
        """Write the folders of a version; folder by partition."""
        target = f"{self.root}/_version={number}"
        if self.partition is None:
            df.write.mode("overwrite").parquet(target)
            return {WHOLE: target}
        # ranges of (partition, row hash) give a partition as many tasks as its size asks for
        (df.repartitionByRange(F.col(self.partition), F.xxhash64(*df.columns))
         .write.mode("overwrite").partitionBy(self.partition).parquet(target))
        # which folders there are now, from the names of the files
        written = self.spark.read.schema(df.schema).option("basePath", target).parquet(target)
        return {name: f"{target}/{name}" for name in self._names(written)}

    def create(self, df: DataFrame, when: dt.datetime | None = None) -> int:
        """The first version. A table that exists is refused."""
        try:
            self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.root}/_log")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
        else:
            raise ValueError(f"{self.root} exists already")
        return self._commit(1, when, df.schema, list(self._store(df, 1).items()))

    def overwrite(self, df: DataFrame, when: dt.datetime | None = None) -> int:
        """A version that holds exactly these rows."""
        now = self._state()
        stored = self._store(df, now.version + 1)
        gone = [(p, None) for p in now.paths if p not in stored]
        return self._commit(now.version + 1, when, df.schema, [*stored.items(), *gone])

    def replace_partition(self, value, df: DataFrame, when: dt.datetime | None = None) -> int:
        """One partition holds exactly these rows afterwards, even if there are none. Rows of others are refused."""
        now = self._state()
        part, rows = self._folder(now, value), self._as_stored(df, now.schema)
        stored = self._store(only_partition(rows, self.partition, value), now.version + 1)
        if set(stored) - {part}:
            raise RuntimeError(f"rows of {part} were written to {sorted(stored)}")
        return self._commit(now.version + 1, when, now.schema, [(part, stored.get(part))])

    def delete_where(self, condition: Column, when: dt.datetime | None = None) -> int:
        """SQL DELETE: rows for which the condition is NULL stay. Only touched partitions are rewritten;
        which these are is seen from the files that hold the rows."""
        now = self._state()
        rows, hit = self._read(now), F.coalesce(condition, F.lit(False))
        if self.partition is None:
            return self._commit(now.version + 1, when, now.schema,
                                list(self._store(rows.where(~hit), now.version + 1).items()))
        touched = sorted(self._names(rows.where(hit))) if now.paths else []
        if not touched:
            return self._commit(now.version + 1, when, now.schema, [])
        stored = self._store(self._read(now, touched).where(~hit), now.version + 1)
        return self._commit(now.version + 1, when, now.schema, [(n, stored.get(n)) for n in touched])

    def _as_stored(self, df: DataFrame, schema: T.StructType) -> DataFrame:
        if set(df.columns) != set(schema.fieldNames()):
            raise ValueError(f"columns {sorted(df.columns)} are not those of {self.root}: {sorted(schema.fieldNames())}")
        return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])

    def insert(self, df: DataFrame, when: dt.datetime | None = None) -> int:
        """INSERT INTO ... SELECT: the rows are written to folders of their own, one more for each partition that
        receives some. What is there is neither read nor written again; ``compact_partition`` joins the folders."""
        now = self._state()
        stored = self._store(self._as_stored(df, now.schema), now.version + 1)
        return self._commit(now.version + 1, when, now.schema, list(stored.items()), ADD)

    def compact_partition(self, value, when: dt.datetime | None = None) -> int:
        """The same rows of one partition in a single folder."""
        now = self._state()
        part = self._folder(now, value)
        if part not in now.paths:
            raise ValueError(f"{self.root} has no partition {part}")
        stored = self._store(self._read(now, [part]), now.version + 1)
        return self._commit(now.version + 1, when, now.schema, [(part, stored.get(part))])

    def drop_column(self, name: str, when: dt.datetime | None = None) -> int:
        """A version without the column. No data file is rewritten."""
        now = self._state()
        kept = T.StructType([f for f in now.schema.fields if f.name != name])
        return self._commit(now.version + 1, when, kept, [])

    def restore_partition(self, value, moment: dt.datetime, when: dt.datetime | None = None) -> int:
        """Bring one partition back as it was: the log points at the old folder again."""
        now = self._state()
        part, old = self._folder(now, value), self._state(F.col("committed_at") <= F.lit(moment))
        if part not in old.paths and part not in now.paths:
            raise ValueError(f"{self.root} has no partition {part}, now or then")
        return self._commit(now.version + 1, when, now.schema, [(part, p) for p in old.paths.get(part, [None])])

    def restore_version(self, earlier: int, when: dt.datetime | None = None) -> int:
        """Make an earlier version the newest one, again without copying data."""
        now, old = self._state(), self._state(F.col("version") <= F.lit(earlier))
        gone = [(p, None) for p in now.paths if p not in old.paths]
        return self._commit(now.version + 1, when, old.schema, [*((p, f) for p, some in old.paths.items() for f in some), *gone])

    def snapshot(self, target: str, expires_on: dt.date) -> None:
        """A copy elsewhere; the day on which it expires is part of its folder's name."""
        self.latest().write.mode("errorifexists").parquet(f"{target}/expires_on={expires_on}")


def read_snapshot(spark: SparkSession, target: str, today: dt.date) -> DataFrame:
    """The rows of snapshots that have not expired; expired folders are pruned."""
    return (spark.read.option("basePath", target).parquet(f"{target}/expires_on=*")
            .where(F.col("expires_on") > F.lit(today)).drop("expires_on"))
