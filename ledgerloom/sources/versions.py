"""Stored tables that change in one step, slice by slice, and keep their earlier versions.

A table is a folder of parquet parts and a folder of manifests. A manifest lists the parts
of one version, by slice; the one with the highest number is the table. A writer puts new
rows into a part folder of its own, which no manifest names yet, and then publishes a
manifest by one rename. A crash before the rename leaves the old version as it was, two
writers of the same version cannot both succeed, and rows may be read from the very table
they replace. Parts of untouched slices are listed again, never rewritten.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerloom.operators.merge import upsert
from ledgerloom.session import scratch, written_table

_SLICE = "__slice"
_MANIFEST = re.compile(r"(\d{12})\.json")


class Conflict(RuntimeError):
    """Another writer published the version this one was about to publish."""


@dataclass(frozen=True)
class Manifest:
    """One version: part folders by slice, relative to the table, and how rows are sliced.

    ``slice_by`` names the column whose values are the slices. With ``key`` the slices are
    ``buckets`` hash buckets of the key columns. With neither there is a single slice.
    """

    version: int
    schema: str
    parts: dict[str, str] = field(default_factory=dict)
    label: str | None = None
    slice_by: str | None = None
    key: tuple[str, ...] = ()
    buckets: int = 0

    def cut(self) -> Column:
        """Slice of a row. A letter keeps NULL, blank and text apart in folder names."""
        if self.key:
            return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("string")
        if self.slice_by:
            return slice_name(F.col(self.slice_by))
        return F.lit("all")


def slice_name(value: Column) -> Column:
    return F.when(value.isNull(), "null").otherwise(F.concat(F.lit("v"), value.cast("string")))


class VersionedTable:
    """A stored table at ``path``, any folder that the executors and the driver reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()

    # Reading

    def versions(self) -> list[int]:
        """Numbers of the published versions that are still kept, oldest first."""
        fs, folder = self._folder("manifests")
        if not fs.exists(folder):
            return []
        names = (f.getPath().getName() for f in fs.listStatus(folder))
        return sorted(int(m[1]) for m in map(_MANIFEST.fullmatch, names) if m)

    def manifest(self, version: int | None = None) -> Manifest | None:
        """Manifest of a version, by default the newest; None for a table never published."""
        if version is None:
            known = self.versions()
            if not known:
                return None
            version = known[-1]
        fs, file = self._folder("manifests", f"{version:012d}.json")
        stream = fs.open(file)
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        found = json.loads(text)
        return Manifest(**{**found, "key": tuple(found["key"])})

    def read(self, version: int | None = None, slices: Sequence[str] | None = None) -> DataFrame:
        """Rows of a version, by default the newest, or only those of some slices."""
        found = self.manifest(version)
        if found is None:
            raise FileNotFoundError(f"{self.path} has no published version")
        return self._rows(found, slices)

    def before(self, label: str) -> DataFrame | None:
        """Rows of the version with the largest label under ``label``; None if there is none.

        Of the versions that repeated runs published under one label the last one counts.
        """
        labelled = [m for m in map(self.manifest, self.versions()) if m.label is not None and m.label < label]
        last = max(labelled, key=lambda m: (m.label, m.version), default=None)
        return None if last is None else self._rows(last)

    def _rows(self, found: Manifest, slices: Sequence[str] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(found.schema))
        wanted = set(found.parts if slices is None else slices)
        folders = [f"{self.path}/{part}" for name, part in found.parts.items() if name in wanted]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    # Writing

    def publish(
        self, df: DataFrame, label: str | None = None, slice_by: str | None = None, key: Sequence[str] = (), buckets: int = 0
    ) -> int:
        """Replace the whole table by ``df``, which may read the table; returns the version.

        Without ``slice_by`` and ``key`` the table keeps the slicing it has.
        """
        if bool(key) != bool(buckets) or (key and slice_by):
            raise ValueError("slice by a column, or by a key and a number of buckets")
        old = self.manifest()
        base = Manifest(0, "") if old is None or slice_by or key else old
        new = replace(
            base,
            version=old.version + 1 if old else 1,
            schema=df.schema.json(),
            label=label,
            slice_by=slice_by or base.slice_by,
            key=tuple(key) or base.key,
            buckets=buckets or base.buckets,
        )
        return self._commit(replace(new, parts=self._write(df, new.cut())))

    def replace_slices(self, df: DataFrame, replaced: Sequence[object], label: str | None = None) -> int:
        """Replace the slices of the listed values by ``df``; a listed slice without new rows is
        empty afterwards. Rows of ``df`` outside the listed slices are refused.

        A None in the list is the slice of rows without a value.
        """
        old = self._known()
        if old.slice_by is None:
            raise ValueError(f"{self.path} is not sliced by a column")
        kind = T.StructType.fromJson(json.loads(old.schema))[old.slice_by].dataType
        listed = self.spark.range(1).select(F.array(*[slice_name(F.lit(v).cast(kind)) for v in replaced]).alias("s")).first()["s"]
        same = df.select(*T.StructType.fromJson(json.loads(old.schema)).fieldNames())
        parts = self._write(same, old.cut())
        if set(parts) - set(listed):
            raise ValueError(f"rows of slices that are not replaced: {sorted(set(parts) - set(listed))[:5]}")
        kept = {name: part for name, part in old.parts.items() if name not in listed}
        return self._commit(replace(old, version=old.version + 1, parts={**kept, **parts}, label=label))

    def upsert(self, delta: DataFrame, insert_new: bool = True, label: str | None = None) -> list[str]:
        """Apply a delta (one row per key, no NULL keys) and return the buckets rewritten.

        Only buckets that hold a key of the delta are read and written. What reaches the
        driver is at most one number per bucket.
        """
        old = self._known()
        if not old.key:
            raise ValueError(f"{self.path} is not stored by key")
        with scratch(self.spark):
            fixed = written_table(delta.select(*T.StructType.fromJson(json.loads(old.schema)).fieldNames()), "delta")
            touched = sorted(r[0] for r in fixed.select(old.cut().alias(_SLICE)).distinct().collect())
            if not insert_new:
                touched = [name for name in touched if name in old.parts]
            if not touched:
                return []
            merged = upsert(self._rows(old, touched), fixed, old.key, insert_new)
            parts = self._write(merged, old.cut())
        kept = {name: part for name, part in old.parts.items() if name not in set(touched)}
        self._commit(replace(old, version=old.version + 1, parts={**kept, **parts}, label=label))
        return touched

    def clean(self, keep: int = 1) -> None:
        """Forget all but the newest ``keep`` versions and delete parts no kept version lists.

        Not while another writer is at work: its parts are listed nowhere yet.
        """
        known = self.versions()
        kept = known[-max(1, keep) :] if known else []
        listed = {part.split("/")[1] for v in kept for part in self.manifest(v).parts.values()}
        for version in known[: len(known) - len(kept)]:
            fs, file = self._folder("manifests", f"{version:012d}.json")
            fs.delete(file, False)
        listed_slices = {part for v in kept for part in self.manifest(v).parts.values()}
        fs, folder = self._folder("data")
        for found in fs.listStatus(folder) if fs.exists(folder) else ():
            name = found.getPath().getName()
            if name not in listed:
                fs.delete(found.getPath(), True)
                continue
            for part in fs.listStatus(found.getPath()):
                if part.isDirectory() and f"data/{name}/{part.getPath().getName()}" not in listed_slices:
                    fs.delete(part.getPath(), True)

    def _known(self) -> Manifest:
        found = self.manifest()
        if found is None:
            raise FileNotFoundError(f"{self.path} has no published version")
        return found

    def _write(self, df: DataFrame, cut: Column) -> dict[str, str]:
        """Rows of ``df`` in a new part folder each slice; nothing lists them yet."""
        name = uuid.uuid4().hex
        # Rows of a slice are brought together, and a large slice is split again.
        sliced = df.withColumn(_SLICE, cut).hint("rebalance", F.col(_SLICE))
        sliced.write.partitionBy(_SLICE).parquet(f"{self.path}/data/{name}")
        fs, folder = self._folder("data", name)
        decode = self._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        folders = [f.getPath().getName() for f in fs.listStatus(folder) if f.isDirectory()]
        return {decode(f.removeprefix(f"{_SLICE}=")): f"data/{name}/{f}" for f in folders if f.startswith(f"{_SLICE}=")}

    def _commit(self, new: Manifest) -> int:
        """Make ``new`` the table: the manifest appears whole, under its number, or not at all."""
        fs, target = self._folder("manifests", f"{new.version:012d}.json")
        draft = self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifests/.{uuid.uuid4().hex}")
        stream = fs.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(asdict(new)).encode()))
        finally:
            stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf)
        never = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(fs.makeQualified(draft), fs.makeQualified(target), never)
        except Py4JJavaError as error:
            fs.delete(draft, False)
            if "FileAlreadyExists" in str(error.java_exception):
                raise Conflict(f"{self.path}: version {new.version} was published by another writer") from None
            raise
        return new.version

    def _folder(self, *names: str):
        path = self._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *names)))
        return path.getFileSystem(self._conf), path
