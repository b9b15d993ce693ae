"""A versioned Parquet store for snapshots: new versions beside the old, one small manifest swapped at the end."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

ATTEMPTS = 3


class Conflict(Exception):
    """Another writer has moved the store on since it was read."""


class SnapshotStore:
    """Tables under one folder. `commit` takes effect wholly or not at all, and only over the version that was read."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _manifest(self, version: int) -> str:
        return f"{self.folder}/manifest-{version:012d}.json"

    def version(self) -> int:
        """The newest committed version, 0 for an empty store."""
        if not self._fs.exists(self._path(self.folder)):
            return 0
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.folder))]
        return max([int(n[9:-5]) for n in names if n.startswith("manifest-") and n.endswith(".json")], default=0)

    def tables(self, version: int | None = None) -> dict[str, str]:
        v = self.version() if version is None else version
        return json.loads(self.spark.sparkContext.wholeTextFiles(self._manifest(v)).first()[1]) if v else {}

    def read(self, name: str, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(self.tables(version)[name])

    def commit(self, tables: dict[str, DataFrame], read_version: int) -> int:
        """Writes the tables and then the manifest of version read_version + 1, whose creation fails if it is there already."""
        found = self.tables(read_version)
        for name, df in tables.items():
            path = f"{self.folder}/{name}-{uuid.uuid4().hex}"
            df.write.parquet(path)
            found[name] = path
        target = self._path(self._manifest(read_version + 1))
        if self.version() != read_version or self._fs.exists(target):
            raise Conflict(f"version {read_version} is no longer the newest")
        try:
            out = self._fs.create(target, False)
        except Exception as error:
            raise Conflict(f"version {read_version + 1} was written meanwhile") from error
        out.write(bytearray(json.dumps(found).encode()))
        out.close()
        return read_version + 1


class Scratch:
    """Written intermediate tables beside a store: each ends the lineage of what goes on from it; all go at the end."""

    def __init__(self, store: SnapshotStore):
        self.store, self.folder = store, f"{store.folder}/scratch-{uuid.uuid4().hex}"

    def __enter__(self) -> Scratch:
        return self

    def __call__(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.store.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *_) -> None:
        self.store._fs.delete(self.store._path(self.folder), True)


def with_retries(store: SnapshotStore, attempt) -> int:
    """Runs attempt(version) -> tables, or None for nothing to do, and commits; reads again when another writer was first."""
    for k in range(ATTEMPTS):
        version = store.version()
        tables = attempt(version)
        if not tables:
            return version
        try:
            return store.commit(tables, version)
        except Conflict:
            if k == ATTEMPTS - 1:
                raise
    raise AssertionError
