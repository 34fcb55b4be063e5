"""Tables of immutable parts whose versions are switched by one small file.

    <table>/data/<id>/...            the parts (Parquet), never changed once written
    <table>/_commits/<number>.json   a version: its schema and the parts that it has

A writer puts new parts beside the old ones and then creates the next commit file,
which fails if another writer was first. Readers take the highest commit file that is
whole, so they see the old version until then, also when a writer dies at any point. A
version may keep parts of the one before: a changed range is replaced alone, and the files of
the others stay as they are. Commit files are the only thing the driver reads or writes
itself; their size is the number of parts.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.session import (create_text, delete_path, folder_entries, path_exists, read_text)

COMMITS, DATA = "_commits", "data"


class ConcurrentCommit(RuntimeError):
    """Another writer committed a version since the table was read."""


@dataclass(frozen=True)
class Part:
    """``folder`` is relative to the table; ``key`` names the range that it holds, if any."""

    folder: str
    rows: int
    key: str | None = None


@dataclass(frozen=True)
class Version:
    number: int
    schema: T.StructType
    parts: tuple[Part, ...]

    @property
    def rows(self) -> int:
        return sum(p.rows for p in self.parts)

    def keys(self) -> set[str | None]:
        return {p.key for p in self.parts}


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ------------------------------------------------------------------ reading

    def numbers(self) -> list[int]:
        """Numbers of the commit files, ascending; the last may not be whole."""
        names = (e.name for e in folder_entries(self.spark, f"{self.path}/{COMMITS}"))
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def at(self, number: int) -> Version | None:
        """A version; None if its writer died while committing."""
        try:
            made = json.loads(read_text(self.spark, self._commit_file(number)))
        except json.JSONDecodeError:
            return None
        return Version(number, T.StructType.fromJson(made["schema"]), tuple(Part(**p) for p in made["parts"]))

    def current(self) -> Version | None:
        """The newest whole version (None before the first)."""
        return self._newest(self.numbers())

    def _newest(self, numbers: list[int]) -> Version | None:
        return next((v for n in reversed(numbers) if (v := self.at(n)) is not None), None)

    def read(self, version: Version | None = None, keys: set[str | None] | None = None) -> DataFrame:
        """Rows of a version (the current one by default), all or those of the parts of ``keys``."""
        version = version or self.current()
        if version is None:
            raise FileNotFoundError(f"{self.path} has no committed version")
        folders = [f"{self.path}/{p.folder}" for p in version.parts if p.rows and (keys is None or p.key in keys)]
        if not folders:
            return self.spark.createDataFrame([], version.schema)
        return self.spark.read.schema(version.schema).parquet(*folders)

    # ------------------------------------------------------------------ writing

    def write(self, df: DataFrame, key: str | None = None, *, sort_by: list[str] | None = None,
              metrics: dict | None = None, seen: dict | None = None) -> Part:
        """Write a part. No reader sees it before ``commit``. ``metrics``: further aggregates
        (name -> Column) observed while writing, put into ``seen``."""
        folder, obs = f"{DATA}/{uuid.uuid4().hex}", Observation()
        out = df.observe(obs, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in (metrics or {}).items()])
        if sort_by:
            out = out.sortWithinPartitions(*sort_by)
        out.write.mode("errorifexists").parquet(f"{self.path}/{folder}")
        found = obs.get
        if metrics:
            seen.update({k: int(found.get(k) or 0) for k in metrics})
        return Part(folder, int(found["rows"]), key)

    def write_ranges(self, df: DataFrame, column: str, *, sort_by: list[str] | None = None) -> list[Part]:
        """Write a part for each value of the string ``column`` (never null), in one job."""
        folder = f"{DATA}/{uuid.uuid4().hex}"
        out = df.sortWithinPartitions(column, *sort_by) if sort_by else df
        out.write.mode("errorifexists").partitionBy(column).parquet(f"{self.path}/{folder}")
        names = [e.name for e in folder_entries(self.spark, f"{self.path}/{folder}") if e.name.startswith(f"{column}=")]
        if not names:
            return []
        # Counts come from the files' footers: no column is read.
        written = self.spark.read.option("basePath", f"{self.path}/{folder}").schema(
            T.StructType([*[f for f in df.schema if f.name != column], T.StructField(column, T.StringType())]))
        counts = {r[column]: r["count"] for r in written.parquet(f"{self.path}/{folder}").groupBy(column).count().collect()}
        return [Part(f"{folder}/{n}", counts[n.split("=", 1)[1]], n.split("=", 1)[1]) for n in sorted(names)]

    def commit(self, schema: T.StructType, parts: list[Part] | tuple[Part, ...], after: Version | None) -> Version:
        """Make ``parts`` the next version, if ``after`` (what the writer has read; None: nothing) is still the current one."""
        numbers = self.numbers()  # once: a commit from here on takes the number that is tried below
        now = self._newest(numbers)
        if (now and now.number) != (after and after.number):
            raise ConcurrentCommit(f"{self.path}: version {now and now.number} is newer than {after and after.number}")
        number = (numbers or [0])[-1] + 1
        made = {"schema": schema.jsonValue(), "parts": [asdict(p) for p in parts], "at": time.time()}
        if not create_text(self.spark, self._commit_file(number), json.dumps(made)):
            raise ConcurrentCommit(f"{self.path}: version {number} was committed meanwhile")
        return Version(number, schema, tuple(parts))

    def change(self, schema: T.StructType | None, make) -> Version:
        """Commit ``make(version)`` (its parts), again on the newest version if another writer was first."""
        while True:
            now = self.current()
            try:
                return self.commit(schema or now.schema, make(now), now)
            except ConcurrentCommit:
                continue

    def discard(self, part: Part) -> None:
        """Delete a part that was never committed."""
        delete_path(self.spark, f"{self.path}/{part.folder}")

    def vacuum(self, keep: int = 2, min_age_s: float = 86_400) -> list[str]:
        """Delete the folders that none of the newest ``keep`` versions has and the commits before
        these. Folders younger than ``min_age_s`` stay: their writer may be about to commit."""
        whole = [v for n in self.numbers() if (v := self.at(n)) is not None]
        kept = whole[-max(1, keep):]
        used = {p.folder.split("/")[1] for v in kept for p in v.parts}
        gone = []
        for e in folder_entries(self.spark, f"{self.path}/{DATA}"):
            if e.name not in used and time.time() - e.modified / 1000 >= min_age_s:
                delete_path(self.spark, f"{self.path}/{DATA}/{e.name}")
                gone.append(e.name)
        for v in whole[:-len(kept)] if kept else []:
            delete_path(self.spark, self._commit_file(v.number))
        return gone

    def _commit_file(self, number: int) -> str:
        return f"{self.path}/{COMMITS}/{number:012d}.json"


def is_versioned(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path.rstrip('/')}/{COMMITS}")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table: its current version, or the Parquet files of a plain folder."""
    return VersionedTable(spark, path).read() if is_versioned(spark, path) else spark.read.parquet(path)
