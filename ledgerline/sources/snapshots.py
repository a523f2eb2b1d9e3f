"""Versioned ledger snapshots, published all or nothing.

Layout: ``<root>/data/<version>/<table>/`` holds immutable parquet, ``<root>/manifests/<version>`` names
the version that each table was last written in, and ``<root>/commits/<version>`` is an empty marker
created only after every table and the manifest are written. Creating the marker is atomic, so a reader
sees all tables of a version or none, and a job that dies half-way leaves only an unmarked folder, which
the next attempt at that version overwrites. A version holds every table of the one before it; those that
it does not publish stay where they are.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from ledgerline.sources.schemas import SCHEMAS


class SnapshotStore:
    """Ledger snapshots under one root folder that every executor can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _marker(self, version: int):
        return self._path(f"{self.root}/commits/{version:020d}")

    def _versions(self) -> list[int]:
        folder = self._path(f"{self.root}/commits")
        if not self._fs.exists(folder):
            return []
        names = (entry.getPath().getName() for entry in self._fs.listStatus(folder))
        return sorted(int(name) for name in names if name.isdigit())

    def current(self) -> int | None:
        """Newest published version, or None."""
        return max(self._versions(), default=None)

    def _manifest(self, version: int):
        return self._path(f"{self.root}/manifests/{version:020d}")

    def tables(self, version: int | None = None) -> dict[str, int]:
        """Tables of a published version (default: the newest), each with the version it was written in."""
        if version is None:
            version = self.current()
        if version is None or not self.is_published(version):
            raise ValueError(f"no published version {version} under {self.root}")
        stream = self._fs.open(self._manifest(version))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def is_published(self, version: int) -> bool:
        return self._fs.exists(self._marker(version))

    def publish(
        self,
        tables: Mapping[str, DataFrame],
        version: int | None = None,
        cluster_by: Mapping[str, Iterable[str]] | None = None,
    ) -> int:
        """Write ``tables`` as one version, which keeps all other tables of the newest version below it.

        Publishing an already published version does nothing.

        ``cluster_by`` names columns to sort files by, so that later filters on them skip row groups.
        """
        if version is None:
            newest = self.current()
            version = 0 if newest is None else newest + 1
        if self.is_published(version):
            return version
        below = max((old for old in self._versions() if old < version), default=None)
        manifest = ({} if below is None else self.tables(below)) | dict.fromkeys(tables, version)
        for name, df in tables.items():
            if cluster_by and name in cluster_by:
                df = df.sortWithinPartitions(*cluster_by[name])
            df.write.mode("overwrite").parquet(f"{self.root}/data/{version}/{name}")
        out = self._fs.create(self._manifest(version), True)
        try:
            out.write(bytearray(json.dumps(manifest), "utf-8"))
        finally:
            out.close()
        try:
            self._fs.create(self._marker(version), False).close()
        except Py4JJavaError as error:
            raise RuntimeError(f"version {version} was published by another writer") from error
        return version

    def drop_before(self, version: int) -> None:
        """Remove published versions below ``version``, but never the newest; their markers go first, so no reader
        finds a gap. Data goes when no version that stays names it."""
        versions = self._versions()
        old = [v for v in versions if v < min(version, versions[-1])]
        kept = [self.tables(v) for v in versions if v not in old]
        held = {(name, at) for tables in kept for name, at in tables.items()}
        written = {(name, at) for v in old for name, at in self.tables(v).items()}
        for v in old:
            self._fs.delete(self._marker(v), False)
        for name, at in sorted(written - held):
            self._fs.delete(self._path(f"{self.root}/data/{at}/{name}"), True)
        for v in old:
            self._fs.delete(self._manifest(v), False)

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """One table of a published version (default: the newest)."""
        tables = self.tables(version)
        if name not in tables:
            raise ValueError(f"no table {name} in the published version")
        reader = self.spark.read
        if name in SCHEMAS:
            reader = reader.schema(SCHEMAS[name])
        return reader.parquet(f"{self.root}/data/{tables[name]}/{name}")
