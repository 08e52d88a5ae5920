"""Tables published together: written aside first, then made current at once.

Under ``root`` every written table has a folder of its own. ``commits`` holds one
small file per published version, named by its number, that names the folder of
each layer; the newest one is current. A commit is written in full beside the others, with
a token of its writer and that of the version before it, and then moved to the name of its version, which
succeeds for one writer only and only while that version is not there. So a writer that dies
leaves nothing that others could see or wait for, and a writer that started from an older version gets
``PublishConflict`` and nothing it wrote becomes current, however late it comes: after the move it
looks whether the version that follows, if any, was made from its own.

``root`` is a folder on storage that all machines share and whose renames are atomic and never replace a
file, such as HDFS, or a local folder for one machine.

A large layer is kept in parts, such as months, named ``layer/part``. A change
then rewrites the parts it touches and the other parts stay where they are. Parts may be cut into buckets of a key:
joins on that key then leave the layer where it is.
"""

from __future__ import annotations

import atexit
import json
import os
from collections.abc import Collection, Sequence
from dataclasses import dataclass, field
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources.parquet import write_and_read

# File systems whose rename is atomic and fails where the target is there.
SAFE_RENAME = ("file", "hdfs", "viewfs", "abfs", "abfss")


class PublishConflict(RuntimeError):
    """Another writer has published since the version this one started from."""


@dataclass(frozen=True)
class Commit:
    """A published version: its writer's token, that of the version it follows, and the folders by layer or part."""

    version: int = 0
    token: str = ""
    parent: str = ""
    tables: dict[str, str] = field(default_factory=dict)


class Snapshots:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._commits = self._path(f"{self.root}/commits")
        self._fs = self._commits.getFileSystem(spark._jsc.hadoopConfiguration())
        scheme = self._fs.getScheme()
        if scheme not in SAFE_RENAME:
            raise ValueError(f"{root}: {scheme} cannot keep two writers apart; use one of {', '.join(SAFE_RENAME)}")
        self._local = scheme == "file"

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def _commit_file(self, version: int):
        return self._path(f"{self.root}/commits/{version:012d}.json")

    def _claimed(self) -> list[int]:
        """Numbers of all commit files, newest first."""
        if not self._fs.exists(self._commits):
            return []
        names = [status.getPath().getName() for status in self._fs.listStatus(self._commits)]
        return sorted((int(n[:12]) for n in names if n.endswith(".json") and n[0] not in "._"), reverse=True)

    def _read_commit(self, version: int) -> Commit | None:
        """A published version; None if there is none, or its file is no commit."""
        try:
            stream = self._fs.open(self._commit_file(version))
        except Py4JJavaError as error:
            if "FileNotFound" not in error.java_exception.getClass().getName():
                raise
            return None
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return Commit(version, **json.loads(text))
        except (ValueError, TypeError):
            return None

    def _latest(self) -> Commit:
        for version in self._claimed():
            commit = self._read_commit(version)
            if commit is not None:
                return commit
        return Commit()

    @property
    def version(self) -> int:
        return self._latest().version

    def write(self, layer: str, df: DataFrame) -> tuple[str, DataFrame]:
        """Write a candidate table; returns its folder name and the table."""
        folder = f"{layer}/{uuid4()}"
        return folder, write_and_read(df, f"{self.root}/{folder}")

    def write_parts(
        self, layer: str, df: DataFrame, part: Column, key: Sequence[str] = (), buckets: int = 0, clustered: bool = False
    ) -> dict[str, str]:
        """Write candidate parts of a layer, in one job; their folders by name.

        The rows of a part meet in one task, or in a few where it is large, so a
        part has few files however many tasks made its rows. With ``buckets`` every part has a file per
        bucket of the key instead; ``clustered`` says that the rows come in tasks by bucket already.
        """
        folder = f"{layer}/{uuid4()}"
        parted = df.withColumn("part", part)
        if buckets:
            rows = parted if clustered else parted.repartition(buckets, *key)
            # Spark writes buckets for tables only; this one is forgotten again, its files stay.
            name = f"ledgerloom_write_{uuid4().hex}"
            bucketed = rows.write.format("parquet").partitionBy("part").bucketBy(buckets, *key).sortBy(*key)
            try:
                bucketed.option("path", f"{self.root}/{folder}").saveAsTable(name)
            finally:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        else:
            parted.hint("rebalance", F.col("part")).write.partitionBy("part").parquet(f"{self.root}/{folder}")
        written = self._fs.listStatus(self._path(f"{self.root}/{folder}"))
        names = [status.getPath().getName() for status in written if status.isDirectory()]
        return {f"{layer}/{n.removeprefix('part=')}": f"{folder}/{n}" for n in names if n.startswith("part=")}

    def publish(self, tables: dict[str, str | None], base: int | None = None) -> int:
        """Make candidate folders current, all at once; other layers stay.

        None takes a layer or part away. ``base`` is the version that the
        candidates were made from; if another one is current by now, or becomes so
        first, ``PublishConflict`` is raised and nothing changes.
        """
        current = self._latest()
        if base is not None and base != current.version:
            raise PublishConflict(f"made from version {base}, but {current.version} is current")
        named = {name: f for name, f in {**current.tables, **tables}.items() if f is not None}
        made = Commit(current.version + 1, str(uuid4()), current.token, named)
        pending = self._path(f"{self.root}/commits/_{made.token}.pending")
        stream = self._fs.create(pending, False)
        try:
            stream.write(bytearray(json.dumps({"token": made.token, "parent": made.parent, "tables": named}).encode()))
        finally:
            stream.close()
        try:
            self._move(pending, self._commit_file(made.version))
        finally:
            self._fs.delete(pending, False)
        if not self._stands(made):
            raise PublishConflict(f"version {made.version} was published by another writer")
        return made.version

    def _move(self, pending, target) -> None:
        """Give the commit its name unless that is taken; who has got it is seen from the token in the file."""
        if not self._local:
            self._fs.rename(pending, target)
            return
        try:  # a local rename would replace the file
            os.link(pending.toUri().getPath(), target.toUri().getPath())
        except FileExistsError:
            pass

    def _stands(self, made: Commit) -> bool:
        """Whether the version is this writer's, and what follows was made from it.

        A writer that sleeps while others publish and remove old commits finds its number free
        again; the version after it then has another parent, or is missing.
        """
        found = self._read_commit(made.version)
        if found is None or found.token != made.token:
            return False
        if max(self._claimed()) == made.version:
            return True
        following = self._read_commit(made.version + 1)
        if following is not None and following.parent == made.token:
            return True
        self._fs.delete(self._commit_file(made.version), False)
        return False

    def abandon(self) -> list[int]:
        """Remove files newer than the current version that are no commits; this class leaves none."""
        current = self.version
        left = [v for v in self._claimed() if v > current]
        for version in left:
            self._fs.delete(self._commit_file(version), False)
        return left

    def compact(self) -> None:
        """Remove older commit files, and table folders that the current version does not name.

        For a quiet time: readers of older versions and writers lose their files.
        """
        commit = self._latest()
        current, tables = commit.version, commit.tables
        for version in reversed(self._claimed()):  # oldest first, see _stands
            if version < current:
                self._fs.delete(self._commit_file(version), False)
        kept = set(tables.values()) | {f.rpartition("/")[0] for f in tables.values()}
        for layer in {f.split("/")[0] for f in tables.values()}:
            for status in self._fs.listStatus(self._path(f"{self.root}/{layer}")):
                folder = f"{layer}/{status.getPath().getName()}"
                if folder not in kept:
                    self._fs.delete(status.getPath(), True)
                elif folder not in tables.values():
                    for part in self._fs.listStatus(status.getPath()):
                        if f"{folder}/{part.getPath().getName()}" not in kept:
                            self._fs.delete(part.getPath(), True)

    def parts(self, layer: str) -> dict[str, str]:
        """The current folders of a layer, by the name of the layer or part."""
        tables = self._latest().tables
        return {n: f for n, f in tables.items() if n == layer or n.startswith(f"{layer}/")}

    def read(
        self, layer: str, schema: T.StructType, parts: Collection[str] | None = None
    ) -> DataFrame:
        """The current table of a layer, or some of its parts; empty if there is none."""
        folders = [
            f"{self.root}/{folder}"
            for name, folder in self.parts(layer).items()
            if parts is None or name.removeprefix(f"{layer}/") in parts
        ]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def read_bucketed(
        self, layer: str, schema: T.StructType, key: Sequence[str], buckets: int, parts: Collection[str] | None = None
    ) -> DataFrame:
        """Like ``read`` for a layer in buckets: joins and groupings on the key need not move its rows.

        Spark knows buckets of tables only, so the parts are declared as one, which is
        forgotten when the driver's Python ends.
        """
        chosen = {n.removeprefix(f"{layer}/"): f for n, f in self.parts(layer).items()}
        chosen = {n: f for n, f in chosen.items() if parts is None or n in parts}
        if not chosen:
            return self.spark.createDataFrame([], schema)
        name = f"ledgerloom_read_{uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        by = ", ".join(f"`{k}`" for k in key)
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}, part STRING) USING parquet PARTITIONED BY (part) "
            f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{self.root}/{layer}'"
        )
        atexit.register(_forget, self.spark, name)
        places = " ".join(f"PARTITION (part = '{n}') LOCATION '{self.root}/{f}'" for n, f in chosen.items())
        self.spark.sql(f"ALTER TABLE {name} ADD {places}")
        return self.spark.table(name).select(*schema.fieldNames())


def _forget(spark: SparkSession, name: str) -> None:
    if spark.sparkContext._jsc is not None:  # else the session has ended before
        spark.sql(f"DROP TABLE IF EXISTS {name}")
