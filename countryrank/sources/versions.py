"""Tables whose versions become visible by a manifest, written last.

    version=7/country=US/…    files of one version; a version that no manifest names is not there for readers
    _manifests/00000000000000000007.json    for each part (country=US) the versions that make it up

A version is written whole, then named by its manifest, which appears by a rename. A writer that dies before that leaves the
table as it was, and writing the version again, with the same number, gives the same table; writing one that is named
already does nothing. Readers open the folders that the newest manifest names and list no others. vacuum() removes what the
last manifests don't name; with the last one alone kept, readers of plain Parquet find the table's rows too. One writer at a
time: streams have one by their checkpoint.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class Versions:
    """A table at path with a schema (DDL or type), in parts by the column key, or in one part without key."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType | str, key: str | None = None) -> None:
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        self._jvm_path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._jvm_path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # -- files

    def _names(self, folder: str) -> list[str]:
        where = self._jvm_path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(where)) if self._fs.exists(where) else []

    def _remove(self, path: str) -> None:
        self._fs.delete(self._jvm_path(path), True)

    def _publish(self, version: int, live: dict[str, list[int]]) -> None:
        """Writes a manifest under another name and renames it, so it is there whole or not at all."""
        end, hidden = f"{self.path}/_manifests/{version:020d}.json", f"{self.path}/_manifests/.{uuid.uuid4().hex}"
        out = self._fs.create(self._jvm_path(hidden), True)
        out.write(bytearray(json.dumps(live, sort_keys=True).encode()))
        out.close()
        if not self._fs.rename(self._jvm_path(hidden), self._jvm_path(end)):
            raise OSError(f"{end} is there already")

    # -- manifests

    def versions(self) -> list[int]:
        """Numbers of the manifests that are kept."""
        return [int(n[:-5]) for n in self._names(f"{self.path}/_manifests") if n.endswith(".json") and not n.startswith(".")]

    def committed(self, version: int) -> bool:
        return version in self.versions()

    def live(self, before: int | None = None) -> dict[str, list[int]]:
        """The versions of each part in the newest manifest, or the newest one before a version."""
        known = [v for v in self.versions() if before is None or v < before]
        if not known:
            return {}
        stream = self._fs.open(self._jvm_path(f"{self.path}/_manifests/{known[-1]:020d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    # -- rows

    def read(self, before: int | None = None) -> DataFrame:
        """The rows of the newest manifest, or of the newest one before a version. Filters on the key leave parts unread."""
        return self._rows(self.live(before))

    def _rows(self, live: dict[str, list[int]]) -> DataFrame:
        paths = [f"{self.path}/version={v}/{part}".rstrip("/") for part, vs in live.items() for v in vs]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*paths).select(*self.schema.names)

    def _write(self, df: DataFrame, version: int) -> list[str]:
        folder = f"{self.path}/version={version}"
        out = df.select(*self.schema.names)
        if self.key is None:
            out.write.mode("overwrite").parquet(folder)
            return [""]
        out.write.mode("overwrite").partitionBy(self.key).parquet(folder)
        return [n for n in self._names(folder) if n.startswith(f"{self.key}=")]

    def replace(self, df: DataFrame, version: int, gone: list[str] | None = None) -> None:
        """The parts that df holds are its rows from this version on; those of the keys in `gone` that it doesn't hold are empty,
        and other parts stay as they are."""
        if not self.committed(version):
            part = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
            left = {part(self.key, k) for k in gone or []}
            kept = {p: vs for p, vs in self.live(version).items() if p not in left}
            self._publish(version, {**kept, **{p: [version] for p in self._write(df, version)}})

    def append(self, df: DataFrame, version: int, most: int = 16, fold: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """Adds rows; a part of `most` versions is written anew as one, folded if asked."""
        if self.committed(version):
            return
        live = self.live(version)
        full = {part: vs for part, vs in live.items() if len(vs) >= most}
        if full:
            df = df.select(*self.schema.names).unionByName(self._rows(full))
            df = fold(df) if fold else df
        new = self._write(df, version)
        self._publish(version, {**live, **{part: [version] if part in full else [*live.get(part, []), version] for part in new}})

    def vacuum(self, keep: int = 2) -> None:
        """Keeps the last manifests and what they name. Versions above the newest manifest are being written and stay."""
        known = self.versions()
        named = {(v, part) for m in known[-keep:] for part, vs in self.live(m + 1).items() for v in vs}
        for m in known[:-keep]:
            self._remove(f"{self.path}/_manifests/{m:020d}.json")
        for folder in [n for n in self._names(self.path) if n.startswith("version=")]:
            v = int(folder.partition("=")[2])
            parts = {part for n, part in named if n == v}
            if known and v <= known[-1]:
                if not parts:
                    self._remove(f"{self.path}/{folder}")
                elif self.key is not None:
                    for n in self._names(f"{self.path}/{folder}"):
                        if n.startswith(f"{self.key}=") and n not in parts:
                            self._remove(f"{self.path}/{folder}/{n}")

    def of_keys(self, keys: list[str], before: int | None = None) -> DataFrame:
        """The rows of some keys."""
        return self.read(before).filter(F.col(self.key).isin(keys))
