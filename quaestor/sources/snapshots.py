"""Versions of a table: data files that never change, and numbered manifests that name the live ones.

A commit writes its data beside what is there and then puts the next manifest in place under a name that must not exist yet. So readers see
whole versions only, a version can be read again later, and of two writers that began at the same version one is refused.
"""

from __future__ import annotations

import functools
import json
import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Conflict(Exception):
    """Another writer committed first; read again and repeat."""


class Manifests:
    """Numbered JSON files in a folder; the highest number is the state."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._hadoop = jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._hadoop.Path(self.path).getFileSystem(self._conf)

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}")

    def versions(self) -> list[int]:
        if not self._fs.exists(self._at("manifests")):
            return []
        names = [x.getPath().getName() for x in self._fs.listStatus(self._at("manifests"))]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self, version: int | None = None) -> tuple[int, dict]:
        """(version, manifest); (0, {}) before the first commit."""
        held = self.versions()
        if not held and not version:
            return 0, {}
        version = held[-1] if version is None else version
        if version not in held:
            raise ValueError(f"{self.path} has no version {version}")
        stream = self._fs.open(self._at(f"manifests/{version:012d}.json"))
        try:
            raw = bytes(stream.readAllBytes())
        finally:
            stream.close()
        return version, json.loads(raw)

    def commit(self, base: int, manifest: dict) -> int:
        """Put version ``base`` + 1 in place; Conflict if another writer has."""
        self._fs.mkdirs(self._at("manifests"))
        draft = self._at(f"manifests/.{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        files = self._hadoop.FileContext.getFileContext(self._at("").toUri(), self._conf)
        none = self.spark.sparkContext._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 0)
        try:
            files.rename(draft, self._at(f"manifests/{base + 1:012d}.json"), none)  # fails where the name exists
        except Exception as e:
            self._fs.delete(draft, False)
            if "FileAlreadyExists" in str(e):
                raise Conflict(f"version {base + 1} of {self.path} was written meanwhile") from e
            raise
        return base + 1

    def drop(self, *folders: str) -> None:
        for folder in folders:
            self._fs.delete(self._at(folder), True)


class Store:
    """Rows in states (a folder of cases): a versioned table parted by one column, whose parts move and go without a rewrite.

    ``key`` tells rows apart within all states.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, state: str, key: str):
        self.files, self.spark, self.schema, self.state, self.key = Manifests(spark, path), spark, schema, state, key

    def read(self, version: int | None = None, archived: bool = False) -> DataFrame:
        """Rows of a version; those that were archived have their archive's name, too."""
        held = self.files.read(version)[1]
        return self._rows(held.get("archived" if archived else "parts", []), archived)

    def _rows(self, parts: list[dict], archived: bool = False) -> DataFrame:
        def of(part: dict) -> DataFrame:
            rows = self.spark.read.schema(self.schema).parquet(f"{self.files.path}/{part['folder']}").withColumn(self.state, F.lit(part["state"]).cast("string"))
            return rows.withColumn("archive", F.lit(part["archive"])) if archived else rows

        none = self.spark.createDataFrame([], self.schema).withColumn(self.state, F.lit(None).cast("string"))
        every = [of(p) for p in parts] or [none.withColumn("archive", F.lit(None).cast("string")) if archived else none]
        return functools.reduce(DataFrame.unionByName, every)

    def _written(self, rows: DataFrame) -> list[dict]:
        """A part for each state of rows; one pass."""
        top, names = f"data/{uuid.uuid4().hex}", self.spark.createDataFrame([], self.schema).columns
        rows.select(*names, F.col(self.state)).write.partitionBy(self.state).parquet(f"{self.files.path}/{top}")
        told = self.spark.read.parquet(f"{self.files.path}/{top}").groupBy(F.col(self.state).cast("string").alias("s"), F.col("_metadata.file_path").alias("f")).agg(F.count(F.lit(1)).alias("n"))
        found: dict[str, dict] = {}
        for r in told.collect():  # a row for each file of this commit
            part = found.setdefault(r.s, {"folder": f"{top}/{unquote(r.f.rsplit('/', 2)[1])}", "state": r.s, "rows": 0})
            part["rows"] += r.n
        return list(found.values())

    def _change(self, make: Callable[[dict], dict | None]) -> int:
        base, held = self.files.read()
        new = make({"parts": held.get("parts", []), "archived": held.get("archived", [])})
        return base if new is None else self.files.commit(base, new)

    def append(self, rows: DataFrame) -> int:
        return self._change(lambda held: held | {"parts": held["parts"] + self._written(rows)})

    def purge(self, state: str) -> int:
        """Rows of a state go: its parts leave the manifest."""
        return self._change(lambda held: held | {"parts": [p for p in held["parts"] if p["state"] != state]} if any(p["state"] == state for p in held["parts"]) else None)

    def archive(self, name: str) -> int:
        """All rows move to an archive; with none to move there is no archive and no new version."""
        return self._change(lambda held: {"parts": [], "archived": held["archived"] + [p | {"archive": name} for p in held["parts"]]} if held["parts"] else None)

    def move(self, keys: DataFrame, to: str) -> int:
        """Rows of the keys get another state; parts without one of them stay as they are."""
        return self._rewrite(keys.select(self.key).distinct(), lambda rows: rows.withColumn(self.state, F.when(F.col("_met"), F.lit(to)).otherwise(F.col(self.state))))

    def patch(self, new: DataFrame) -> int:
        """Columns of ``new`` replace those of the rows of its keys, where they aren't null or empty. Keys without a row raise ValueError."""
        columns = [c for c in new.columns if c != self.key]
        named = new.select(self.key, *[F.col(c).alias(f"_new_{c}") for c in columns])
        if not named.join(self.read().select(self.key), self.key, "left_anti").isEmpty():
            raise ValueError("an update names a row that isn't there")

        def put(rows: DataFrame) -> DataFrame:
            return rows.withColumns({c: F.coalesce(F.nullif(f"_new_{c}", F.lit("")) if dict(new.dtypes)[c] == "string" else F.col(f"_new_{c}"), F.col(c)) for c in columns})

        return self._rewrite(named, put)

    def _rewrite(self, keys: DataFrame, change: Callable[[DataFrame], DataFrame]) -> int:
        def make(held: dict) -> dict | None:
            named = keys.withColumn("_met", F.lit(True))
            kept, touched = [], []
            for part in held["parts"]:
                rows = self._rows([part])
                (kept if rows.join(named, self.key, "left_semi").isEmpty() else touched).append(part)
            if not touched:
                return None
            rows = self._rows(touched).join(named, self.key, "left").withColumn("_met", F.coalesce("_met", F.lit(False)))
            return held | {"parts": kept + self._written(change(rows))}

        return self._change(make)


