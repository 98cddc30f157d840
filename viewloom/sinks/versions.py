"""Published lists in versions.

Lists live in ranges of keys, one folder of Parquet files per range. A version is a manifest that names the folder of
every range. Publishing writes the ranges that have new lists, merged with what they held, and ends with one rename
that puts the new manifest in place; a run that ends before it has changed nothing that readers see, and a range without new
lists keeps its files. So the lists of a key are replaced as a whole, and all lists of a run appear together.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from viewloom.session import cut_lineage
from viewloom.sinks.lists import longer_than, replace_unless_shorter

_RANGE = "_range"


class Folder:
    """The few file operations that need no Spark job, on any file system that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm = spark._jvm
        conf = spark._jsc.hadoopConfiguration()
        root = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = root.getFileSystem(conf)
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.makeQualified(root).toUri(), conf)
        self._no_options = spark._sc._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)

    def _at(self, name: str):
        return self._fs.makeQualified(self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}"))

    def names(self, name: str) -> list[str]:
        at = self._at(name)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self._fs.create(self._at(name), False)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()

    def rename(self, old: str, new: str) -> None:
        """Fails if ``new`` is there."""
        self._context.rename(self._at(old), self._at(new), self._no_options)

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


class Versions:
    """Numbered manifests in a folder; a new one appears by one rename, and only if nobody was faster."""

    def __init__(self, spark: SparkSession, path: str):
        self.folder = Folder(spark, path)

    def numbers(self) -> list[int]:
        return [int(n[1:-5]) for n in self.folder.names("manifests") if n.startswith("v") and n.endswith(".json")]

    def read(self, version: int | None = None) -> dict | None:
        """A manifest, the newest unless a version is given; None before the first."""
        there = self.numbers()
        if version is not None and version not in there:
            raise ValueError(f"there is no version {version}")
        if not there:
            return None
        return json.loads(self.folder.read(f"manifests/{_name(max(there) if version is None else version)}"))

    def switch(self, version: int, manifest: dict) -> None:
        temporary = f"manifests/.{uuid.uuid4().hex}"
        self.folder.write(temporary, json.dumps(manifest))
        try:
            self.folder.rename(temporary, f"manifests/{_name(version)}")
        except Exception:
            self.folder.delete(temporary)
            raise

    def keep(self, newest: int, named) -> None:
        """Forget all but the newest versions, and the folders of ``data`` that ``named(manifest)`` doesn't name for any of them."""
        kept = sorted(self.numbers())[-max(1, newest) :]
        folders = {path.split("/")[1] for v in kept for path in named(self.read(v))}
        for version in set(self.numbers()) - set(kept):
            self.folder.delete(f"manifests/{_name(version)}")
        for name in self.folder.names("data"):
            if name not in folders:
                self.folder.delete(f"data/{name}")
        for name in self.folder.names("manifests"):
            if name.startswith(".") and not name.endswith(".crc"):
                self.folder.delete(f"manifests/{name}")


@dataclass
class Manifest:
    """A version: the folder of every range that has lists, and the runs that made it, the newest last."""

    version: int = 0
    ranges: int = 0
    schema: str = ""
    folders: dict[str, str] = field(default_factory=dict)
    runs: list[str] = field(default_factory=list)


class ListStore:
    """Lists by key in a folder; ``ranges`` is fixed by the first publication.

    A range is written by one task, so choose as many as give a range some hundred thousand rows.
    """

    def __init__(self, spark: SparkSession, path: str, ranges: int = 64, key: str = "list_key"):
        self.spark, self.ranges, self.key = spark, ranges, key
        self.store = Versions(spark, path)
        self.folder = self.store.folder

    def versions(self) -> list[int]:
        return self.store.numbers()

    def manifest(self, version: int | None = None) -> Manifest:
        """A version, the newest unless one is given; an empty one before the first publication."""
        found = self.store.read(version)
        return Manifest(**found) if found else Manifest(ranges=self.ranges)

    def read(self, version: int | None = None) -> DataFrame:
        """All lists of a version."""
        found = self.manifest(version)
        if not found.schema:
            raise ValueError("nothing was published yet")
        return self._rows(found, list(found.folders))

    def _rows(self, found: Manifest, ranges: list[str]) -> DataFrame:
        schema = StructType.fromJson(json.loads(found.schema))
        paths = [f"{self.folder.path}/{found.folders[r]}" for r in ranges if r in found.folders]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def publish(self, lists: DataFrame, run: str | None = None, more_than: int = 0, keep_longer: bool = False) -> int:
        """Replace the lists of the keys in ``lists`` and return the version that holds them.

        Lists of at most ``more_than`` rows are not published; with ``keep_longer`` a stored list isn't replaced by a shorter one.
        Keys without a new list keep theirs. A run that is published already is not published again. Of two publications
        at the same time one fails, at the rename, and changes nothing.
        """
        run = run or uuid.uuid4().hex
        now = self.manifest()
        if run in now.runs:
            return now.version
        gated = longer_than(lists, more_than, self.key) if more_than else lists
        part = F.pmod(F.xxhash64(self.key), F.lit(now.ranges)).cast("int")
        new = cut_lineage(gated.withColumn(_RANGE, part))
        touched = [str(r[0]) for r in new.select(_RANGE).distinct().collect()]
        plain = new.drop(_RANGE)
        if now.schema and json.loads(now.schema) != plain.schema.jsonValue():
            raise ValueError("the lists have other columns than the stored ones")
        merged = plain
        if now.schema:
            old = self._rows(now, touched)
            if keep_longer:
                merged = replace_unless_shorter(old, plain, self.key)
            else:
                merged = plain.unionByName(old.join(plain.select(self.key).distinct(), self.key, "left_anti").select(plain.columns))
        data = f"data/{run}-{uuid.uuid4().hex[:8]}"
        ranged = merged.withColumn(_RANGE, part).repartition(max(1, len(touched)), _RANGE).sortWithinPartitions(_RANGE, self.key)
        ranged.write.partitionBy(_RANGE).parquet(f"{self.folder.path}/{data}")
        written = {n.split("=", 1)[1]: f"{data}/{n}" for n in self.folder.names(data) if n.startswith(f"{_RANGE}=")}
        kept = {r: f for r, f in now.folders.items() if r not in touched}
        # All columns can be null once they were files.
        schema = json.dumps(plain.schema.jsonValue())
        self._switch(Manifest(now.version + 1, now.ranges, schema, {**kept, **written}, [*now.runs, run]))
        return now.version + 1

    def _switch(self, manifest: Manifest) -> None:
        self.store.switch(manifest.version, manifest.__dict__)

    def clean(self, keep: int = 2) -> None:
        """Forget all but the newest ``keep`` versions, and files that none of those names. Not during a publication."""
        self.store.keep(keep, lambda manifest: manifest["folders"].values())


def _name(version: int) -> str:
    return f"v{version:010d}.json"
