"""Versioned tables with one commit for several of them, and the merge rules of their rows."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new whose keys old lacks, one a key."""
    return new.dropDuplicates(keys).join(old.select(*keys), keys, "left_anti")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows of both, one a key: of new the one greatest in order, else old's."""
    names = [c for c in old.columns if c not in keys]
    newest = new.groupBy(*keys).agg(F.max_by(F.struct(*names), order).alias("row")).select(*keys, "row.*")
    return old.join(newest.select(*keys), keys, "left_anti").select(*keys, *names).unionByName(newest)


def keep_non_empty(new: Column, old: Column) -> Column:
    return F.coalesce(F.nullif(new, F.lit("")), old)


def merge_non_empty(old: DataFrame, new: DataFrame, keys: list[str], texts: list[str], greatest: list[str] = ()) -> DataFrame:
    """Full merge: a text is replaced only by one that isn't empty, a number only by a greater one."""
    o, n = old.alias("o"), new.alias("n")
    joined = o.join(n, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys], "full")
    return joined.select(*[F.coalesce(f"o.{k}", f"n.{k}").alias(k) for k in keys], *[keep_non_empty(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c) for c in texts], *[F.greatest(f"o.{c}", f"n.{c}").alias(c) for c in greatest])


def merged_keys(seen: Column, new: Column, most: int = 5000) -> Column:
    """Ordered union of two key lists, the last `most` of it."""
    both = F.array_distinct(F.concat(seen, new))
    return F.when(F.size(both) > most, F.slice(both, -most, most)).otherwise(both)


def mark(rows: DataFrame, delta: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """rows with the delta's values of columns where it has any; other rows and columns stay as they are."""
    given = delta.select(*keys, *[F.col(c).alias(f"__{c}") for c in columns]).dropDuplicates(keys)
    joined = rows.join(given, keys, "left")
    return joined.select(*[F.coalesce(f"__{c}", c).alias(c) if c in columns else F.col(c) for c in rows.columns])


def conformed(rows: DataFrame, schema: StructType, defaults: Mapping[str, object] = {}) -> DataFrame:  # noqa: B006
    """rows of an older table under a newer schema: columns that it lacks have their default or null, others stay behind the schema's."""
    have = set(rows.columns)
    wanted = [(F.col(f.name) if f.name in have else F.lit(defaults.get(f.name))).cast(f.dataType).alias(f.name) for f in schema]
    return rows.select(*wanted, *[c for c in rows.columns if c not in schema.names])


#: Statuses of an enrollment, in the order in which it moves through them.
ENROLLMENT = ("candidate", "enrolled", "confirmed")


def enrollments(events: DataFrame) -> DataFrame:
    """State of each index_number after its events (index_number, at, kind: candidate, enroll, alert or drop).

    A candidate can be enrolled, an alert confirms at its first time and is counted; the status never
    goes back, and a drop is final. Enrolling what was never a candidate does nothing.
    """
    at = lambda kind, pick: pick(F.when(F.col("kind") == kind, F.col("at")))
    seen = events.groupBy("index_number").agg(
        at("candidate", F.min).alias("added_at"), at("enroll", F.min).alias("first_enroll"), at("alert", F.min).alias("first_alert"), at("alert", F.max).alias("last_alert_at"),
        F.count_if(F.col("kind") == "alert").alias("alert_count"), at("drop", F.min).alias("dropped_at"),
    )
    enrolled = F.when(F.col("first_enroll") >= F.col("added_at"), F.col("first_enroll"))
    status = F.when(F.col("dropped_at").isNotNull(), "dropped").when(F.col("confirmed_at").isNotNull(), "confirmed").when(F.col("enrolled_at").isNotNull(), "enrolled").otherwise("candidate")
    known = seen.where("added_at is not null or first_alert is not null").withColumns({"enrolled_at": enrolled, "confirmed_at": F.col("first_alert")})
    return known.select("index_number", status.alias("status"), "added_at", "enrolled_at", "confirmed_at", "last_alert_at", "alert_count")


class VersionedStore:
    """Tables as sets of Parquet folders; a commit file names those that count and appears at once.

    A commit's number is taken by creating its file exclusively. A file that isn't whole, as a writer
    died in it, names nothing and its number stays unused. Data is written below names of their own, so
    writers never overwrite each other's.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _commits(self) -> list[int]:
        folder = self._path(f"{self.root}/_commits")
        return sorted(int(s.getPath().getName()[:-5]) for s in self._fs.listStatus(folder) if s.getPath().getName().endswith(".json")) if self._fs.exists(folder) else []

    def _named(self, number: int) -> dict[str, list[str]] | None:
        text = "\n".join(r[0] for r in self.spark.read.text(f"{self.root}/_commits/{number:09d}.json").collect())
        try:
            return json.loads(text)
        except ValueError:
            return None

    def manifest(self) -> dict[str, list[str]]:
        """Folders of each table, as the latest whole commit names them."""
        return next((found for n in reversed(self._commits()) if (found := self._named(n)) is not None), {})

    def read(self, table: str) -> DataFrame | None:
        paths = self.manifest().get(table)
        return self.spark.read.parquet(*[f"{self.root}/{p}" for p in paths]) if paths else None

    def commit(self, tables: Mapping[str, DataFrame] = {}, append: Mapping[str, DataFrame] = {}) -> int:  # noqa: B006
        """Replace tables and add rows to others, then publish all of it by one file; readers see all or none."""
        number, named = (self._commits() or [0])[-1] + 1, self.manifest()
        for name, df in (*tables.items(), *append.items()):
            path = f"{name}/v={number:09d}-{uuid.uuid4().hex}"
            df.write.parquet(f"{self.root}/{path}")
            named[name] = [*named.get(name, []), path] if name in append else [path]
        final = self._path(f"{self.root}/_commits/{number:09d}.json")
        try:
            out = self._fs.create(final, False)
        except Py4JJavaError as e:
            raise RuntimeError(f"version {number} was committed by another writer") from e
        out.write(bytearray(json.dumps(named, sort_keys=True).encode()))
        out.close()
        return number

    def compact(self, table: str) -> int:
        """Rewrite a table's folders as one."""
        return self.commit({table: self.read(table)})

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete folders that none of the last commits names: old versions and what failed commits left. No writer may be at work."""
        used = {p for n in self._commits()[-keep:] for paths in (self._named(n) or {}).values() for p in paths}
        gone = []
        for table in self._fs.listStatus(self._path(self.root)):
            name = table.getPath().getName()
            if name.startswith("_") or not table.isDirectory():
                continue
            for version in self._fs.listStatus(table.getPath()):
                path = f"{name}/{version.getPath().getName()}"
                if path not in used:
                    self._fs.delete(version.getPath(), True)
                    gone.append(path)
        return sorted(gone)
