"""A table as a chain of immutable snapshots; a set of changes is one commit.

A snapshot is a manifest that names the folders its rows lie in, and folders of deleted
rows, each by the folder of the row and its number there. So a commit writes what it
changes: an insert its rows, a delete the numbers of the rows that go, an update both.
Manifests are numbered, and each is one file that only one writer can create. Data is
written before, so a failed batch leaves the table as it was, and readers keep the
snapshot they opened.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conduit.operators.dml import update_rows
from conduit.session import hadoop_path

# Where a row lies: the folder's name and the row's number in it.
FOLDER, ROW = "_folder", "_row"
_GONE = T.StructType([T.StructField(FOLDER, T.StringType()), T.StructField(ROW, T.LongType())])


class CommitConflict(RuntimeError):
    """Another writer changed the same rows' folders first."""


class SnapshotTable:
    """Snapshots below a folder; the manifest with the highest number is the current one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._fs, self._log = hadoop_path(spark, f"{self.path}/_commits")

    def version(self) -> int:
        """Number of the current snapshot, 0 when there is none."""
        if not self._fs.exists(self._log):
            return 0
        names = [s.getPath().getName() for s in self._fs.listStatus(self._log)]
        return max((int(n) for n in names if n.isdigit()), default=0)

    def manifest(self, version: int) -> dict:
        """``rows`` (folders), ``gone`` (folder of deleted rows: the folders these lie in) and ``schema``."""
        if version == 0:
            raise FileNotFoundError(f"no snapshot at {self.path}")
        _, commit = hadoop_path(self.spark, f"{self.path}/_commits/{version:012d}")
        stream = self._fs.open(commit)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def read(self, version: int | None = None) -> DataFrame:
        """The current snapshot, or an earlier one."""
        return self.placed(self.manifest(self.version() if version is None else version)).drop(FOLDER, ROW)

    def placed(self, manifest: dict) -> DataFrame:
        """A manifest's rows with the folder and the number of each."""
        schema = T.StructType.fromJson(manifest["schema"])
        stored = T.StructType([*schema.fields, T.StructField(ROW, T.LongType())])
        names = [*schema.names, FOLDER, ROW]
        if not manifest["rows"]:
            return self.spark.createDataFrame([], T.StructType([*stored.fields, T.StructField(FOLDER, T.StringType())])).select(*names)
        reader = self.spark.read.schema(stored).option("basePath", f"{self.path}/rows")
        rows = reader.parquet(*[f"{self.path}/rows/{FOLDER}={name}" for name in manifest["rows"]])
        rows = rows.withColumn(FOLDER, F.col(FOLDER).cast("string")).select(*names)
        if not manifest["gone"]:
            return rows
        gone = self.spark.read.schema(_GONE).parquet(*[f"{self.path}/gone/{name}" for name in manifest["gone"]])
        return rows.join(gone, [FOLDER, ROW], "left_anti").select(*names)

    def begin(self) -> Changes:
        """A set of changes to the current snapshot."""
        return Changes(self, self.version())

    def commit(self, df: DataFrame, base: int | None = None) -> int:
        """Store a frame as the whole next snapshot after ``base``."""
        base = self.version() if base is None else base
        folder = self._store(df)
        self._publish(base + 1, {"rows": [folder], "gone": {}, "schema": df.schema.jsonValue()})
        return base + 1

    def transaction(self, *steps: Callable[[DataFrame], DataFrame]) -> int:
        """Apply several changes of the whole table as one commit: all of them or none."""
        base = self.version()
        df = self.read(base)
        for step in steps:
            df = step(df)
        return self.commit(df, base)

    def compact(self) -> int:
        """Write the current rows together, without those that are gone."""
        base = self.version()
        return self.commit(self.read(base), base)

    def _store(self, df: DataFrame) -> str:
        """Write rows with their numbers to a new folder."""
        if {FOLDER, ROW} & set(df.columns):
            raise ValueError(f"{FOLDER} and {ROW} are names of the table's own")
        name = f"part-{uuid.uuid4().hex}"
        df.withColumn(ROW, F.monotonically_increasing_id()).write.parquet(f"{self.path}/rows/{FOLDER}={name}")
        return name

    def _publish(self, version: int, manifest: dict) -> None:
        _, commit = hadoop_path(self.spark, f"{self.path}/_commits/{version:012d}")
        try:  # creating without overwriting fails for all but one
            stream = self._fs.create(commit, False)
        except Py4JJavaError as taken:
            if self._fs.exists(commit):
                raise CommitConflict(f"version {version} exists at {self.path}") from taken
            raise
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()


class Changes:
    """Inserts, updates and deletes that become one commit; each step sees those before it.

    Two sets of changes conflict when both delete or update rows of one folder, or when
    one replaces the whole table; inserts conflict with nothing.
    """

    def __init__(self, table: SnapshotTable, base: int):
        self.table, self.base = table, base
        self.before = table.manifest(base)
        self.schema = T.StructType.fromJson(self.before["schema"])
        self.rows: list[str] = []
        self.gone: dict[str, list[str]] = {}

    def read(self) -> DataFrame:
        """The table as it is after the steps so far."""
        return self._placed().drop(FOLDER, ROW)

    def _placed(self) -> DataFrame:
        now = {"rows": self.before["rows"] + self.rows, "gone": self.before["gone"] | self.gone}
        return self.table.placed(now | {"schema": self.before["schema"]})

    def insert(self, rows: DataFrame) -> Changes:
        """Add rows; columns that they lack are NULL, and others are not the table's."""
        strange = set(rows.columns) - set(self.schema.names)
        if strange:
            raise ValueError(f"no such columns: {sorted(strange)}")
        whole = [
            (F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in self.schema
        ]
        self.rows.append(self.table._store(rows.select(*whole)))
        return self

    def delete(self, where: Column) -> Changes:
        """Delete the rows a condition is true for; where it is unknown they stay."""
        self._remove(self._placed().where(where))
        return self

    def update(self, changes: dict[str, Column], where: Column) -> Changes:
        """Give the rows a condition is true for new values."""
        before = self._placed()
        gone = self._remove(before.where(where))
        if gone is not None:
            found = before.join(gone, [FOLDER, ROW], "left_semi").drop(FOLDER, ROW)
            self.rows.append(self.table._store(update_rows(found, changes, F.lit(True))))
        return self

    def _remove(self, found: DataFrame) -> DataFrame | None:
        """Store which rows go; None if there are none."""
        name = f"gone-{uuid.uuid4().hex}"
        path = f"{self.table.path}/gone/{name}"
        found.select(FOLDER, ROW).write.parquet(path)
        gone = self.table.spark.read.schema(_GONE).parquet(path)
        touched = sorted(r[0] for r in gone.select(FOLDER).distinct().collect())  # <= the manifest's folders
        if not touched:
            return None
        self.gone[name] = touched
        return gone

    def commit(self) -> int:
        """Publish all steps; raises :class:`CommitConflict` and changes nothing if rows were changed meanwhile."""
        touched = {folder for folders in self.gone.values() for folder in folders} - set(self.rows)
        while True:
            version = self.table.version()
            latest = self.table.manifest(version)
            new = {f for name, folders in latest["gone"].items() if name not in self.before["gone"] for f in folders}
            if touched & new or not set(self.before["rows"]) <= set(latest["rows"]) or latest["schema"] != self.before["schema"]:
                raise CommitConflict(f"version {version} changed the same rows at {self.table.path}")
            joined = {
                "rows": latest["rows"] + self.rows,
                "gone": latest["gone"] | self.gone,
                "schema": latest["schema"],
            }
            try:
                self.table._publish(version + 1, joined)
            except CommitConflict:  # another writer took the number: look at what it changed
                continue
            return version + 1
