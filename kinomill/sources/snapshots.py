"""Zone tables as committed snapshots: immutable files and numbered manifests, so that a job that dies leaves the old table or the new.

A table is a folder. ``data/<name>`` holds what one write made and is never changed; ``manifests/<number>`` lists, for each
bucket of keys, the folders that make up the table in that version. A version exists once its manifest has its name, which
one rename gives it: readers see the manifest whole or not at all, and of two writers that started from the same version
the second finds the name taken and reports it. Readers pin a number, so files they read stay while others write.
A merge by key rewrites only the buckets that hold keys of the new rows; all other buckets are listed as they were.
Folders that no manifest names, left by jobs that died, are removed by ``expire``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKET = "__bucket"


class Conflict(RuntimeError):
    """Another writer committed the version this one was going to."""


@dataclass(frozen=True)
class SnapshotTable:
    """A table below ``path``, in ``buckets`` by the hash of its ``keys``; open it with the same ones again."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    buckets: int = 64

    def _fs(self, where: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(where)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder

    def versions(self) -> list[int]:
        system, folder = self._fs(f"{self.path}/manifests")
        if not system.exists(folder):
            return []
        names = [s.getPath().getName() for s in system.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def _manifest(self, version: int) -> dict:
        text = self.spark.read.text(f"{self.path}/manifests/{version:012d}", wholetext=True).first()["value"]
        return json.loads(text)

    def _commit(self, version: int, manifest: dict) -> int:
        system, made = self._fs(f"{self.path}/manifests/_{uuid.uuid4().hex}")
        stream = system.create(made)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        final = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifests/{version:012d}")
        # A rename that never replaces: of two writers one gets the name.
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(made.toUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(system.makeQualified(made), system.makeQualified(final), options)
        except Exception as error:
            system.delete(made, False)
            if system.exists(final):
                raise Conflict(f"version {version} of {self.path} was committed by another writer") from error
            raise
        return version

    def _written(self, df: DataFrame, name: str) -> set[int]:
        """Write rows by bucket; the numbers of the buckets that got some."""
        where = f"{self.path}/data/{name}"
        df.repartition(BUCKET).write.partitionBy(BUCKET).parquet(where)
        system, folder = self._fs(where)
        found = (s.getPath().getName() for s in system.listStatus(folder))
        return {int(n.partition("=")[2]) for n in found if n.startswith(f"{BUCKET}=")}

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def write(self, df: DataFrame) -> int:
        """The rows of ``df`` as the next version; what was there stays readable under its number."""
        version, name = max(self.versions(), default=-1) + 1, uuid.uuid4().hex
        filled = self._written(self._bucketed(df), name)
        return self._commit(version, {"schema": df.schema.jsonValue(), "buckets": {str(b): name for b in sorted(filled)}})

    def merge(self, df: DataFrame) -> int:
        """Rows of ``df`` in place of those with the same keys, and beside the others. Null keys match each other.

        Keys that ``df`` repeats all come in. Buckets without a key of ``df`` are not read or written.
        """
        version = max(self.versions(), default=-1)
        if version < 0:
            return self.write(df)
        manifest, name = self._manifest(version), uuid.uuid4().hex
        new = self._bucketed(df)
        touched = sorted(r[BUCKET] for r in new.select(BUCKET).distinct().collect())  # as many as buckets, at most
        if not touched:
            return version
        old = self._read(manifest, {str(b) for b in touched}).select(*df.columns)
        keys = new.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(self.keys)]).distinct()
        same = F.lit(True)
        for i, k in enumerate(self.keys):
            same = same & old[k].eqNullSafe(keys[f"__k{i}"])
        filled = self._written(self._bucketed(old.join(keys, same, "left_anti").unionByName(df)), name)
        kept = {b: n for b, n in manifest["buckets"].items() if int(b) not in touched}
        return self._commit(version + 1, manifest | {"buckets": kept | {str(b): name for b in sorted(filled)}})

    def _read(self, manifest: dict, buckets: set[str] | None = None) -> DataFrame:
        schema = StructType.fromJson(manifest["schema"])
        chosen = {b: n for b, n in manifest["buckets"].items() if buckets is None or b in buckets}
        if not chosen:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/data/{n}/{BUCKET}={b}" for b, n in chosen.items()])

    def read(self, version: int | None = None) -> DataFrame:
        """The table in a version, the last one if none is named."""
        known = self.versions()
        if not known or (version is not None and version not in known):
            raise FileNotFoundError(f"no version {'' if version is None else version} of {self.path}")
        return self._read(self._manifest(known[-1] if version is None else version))

    def expire(self, keep: int = 1) -> None:
        """Delete all but the last ``keep`` versions, and data that no version names. No writer may be at work."""
        known = self.versions()
        for version in known[:-keep]:
            system, folder = self._fs(f"{self.path}/manifests/{version:012d}")
            system.delete(folder, False)
        named = {n for v in known[-keep:] for n in self._manifest(v)["buckets"].values()}
        system, folder = self._fs(f"{self.path}/data")
        for status in system.listStatus(folder) if system.exists(folder) else []:
            if status.getPath().getName() not in named:
                system.delete(status.getPath(), True)
