"""Lists written to several outside stores, to all or to none.

Tasks stage whole lists in every store and report what they staged. Only when all tasks are through does the driver
put the staged parts in place, note the run in a journal and switch the stores one after the other. The note is the moment of
commitment: a run that fails before it leaves every store as it was, and one that ends between two switches is finished
by ``recover``, which readers and writers call first.
"""

from __future__ import annotations

import json
import os
import shutil
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "viewloom_stores"


class FolderStore:
    """A store in a folder that the driver and all executors mount; other stores offer the same methods.

    A run's parts hold one line per key with its whole list. RUNS names the published runs in order; the last run that has a key
    has its list.
    """

    def __init__(self, root: str):
        self.root = root

    def _path(self, *names: str) -> str:
        return os.path.join(self.root, *names)

    def stage(self, run: str, lines: Sequence[str]) -> str:
        """Keep lines aside; the name that is returned is put in place by ``place`` or dropped."""
        os.makedirs(self._path("staged", run), exist_ok=True)
        name = f"{uuid.uuid4().hex}.json"
        with open(self._path("staged", run, name), "w", encoding="utf-8") as file:
            file.writelines(line + "\n" for line in lines)
            file.flush()
            os.fsync(file.fileno())
        return name

    def place(self, run: str, names: Sequence[str]) -> None:
        """Move the staged parts to the run's folder; parts of lost attempts go."""
        os.makedirs(self._path("runs", run), exist_ok=True)
        for name in names:
            os.replace(self._path("staged", run, name), self._path("runs", run, name))
        self.drop(run)

    def drop(self, run: str) -> None:
        shutil.rmtree(self._path("staged", run), ignore_errors=True)

    def remove(self, run: str) -> None:
        """Take back a run that was placed and not switched to."""
        if run not in self.runs():
            shutil.rmtree(self._path("runs", run), ignore_errors=True)

    def runs(self) -> list[str]:
        if not os.path.exists(self._path("RUNS")):
            return []
        with open(self._path("RUNS"), encoding="utf-8") as file:
            return file.read().split()

    def switch(self, run: str) -> None:
        """Publish the run by one rename; again does nothing."""
        if run not in self.runs():
            _put(self._path("RUNS"), "\n".join([*self.runs(), run]))

    def note(self, run: str, stores: Sequence[str]) -> None:
        os.makedirs(self._path("journal"), exist_ok=True)
        _put(self._path("journal", f"{run}.json"), json.dumps(list(stores)))

    def notes(self) -> dict[str, list[str]]:
        there = sorted(os.listdir(self._path("journal"))) if os.path.isdir(self._path("journal")) else []
        found = {}
        for name in there:
            if name.endswith(".json"):
                with open(self._path("journal", name), encoding="utf-8") as file:
                    found[name[:-5]] = json.load(file)
        return found

    def forget(self, run: str) -> None:
        os.remove(self._path("journal", f"{run}.json"))


def _put(path: str, text: str) -> None:
    temporary = f"{path}.{uuid.uuid4().hex}"
    with open(temporary, "w", encoding="utf-8") as file:
        file.write(text)
        file.flush()
        os.fsync(file.fileno())
    os.replace(temporary, path)


def recover(roots: Sequence[str]) -> None:
    """Finish the runs that were committed and not yet switched to everywhere. The first store keeps the journal."""
    first = FolderStore(roots[0])
    for run, stores in first.notes().items():
        for root in stores:
            FolderStore(root).switch(run)
        first.forget(run)


def clean(roots: Sequence[str]) -> None:
    """Remove what failed runs have staged, also after they were given up. Not while a run is written."""
    for root in roots:
        shutil.rmtree(os.path.join(root, "staged"), ignore_errors=True)


@dataclass
class Staged(WriterCommitMessage):
    names: list[str]


class _StoresWriter(DataSourceWriter):
    def __init__(self, roots: list[str], run: str):
        self.roots, self.run = roots, run

    def write(self, iterator: Iterator) -> Staged:
        lines = [json.dumps({"list_key": r["list_key"], "rows": [x.asDict() for x in r["rows"]]}, ensure_ascii=False) for r in iterator]
        return Staged([FolderStore(root).stage(self.run, lines) for root in self.roots])

    def commit(self, messages: list[Staged | None]) -> None:
        recover(self.roots)
        stores = [FolderStore(root) for root in self.roots]
        if all(self.run in store.runs() for store in stores):
            for store in stores:
                store.drop(self.run)
            return
        try:
            for i, store in enumerate(stores):
                store.place(self.run, [m.names[i] for m in messages if m])
            stores[0].note(self.run, self.roots)
        except BaseException:
            for store in stores:
                store.drop(self.run)
                store.remove(self.run)
            raise
        recover(self.roots)

    def abort(self, messages: list[Staged | None]) -> None:
        # Tasks that are still running may stage more; nobody reads it, and ``clean`` removes it.
        for root in self.roots:
            FolderStore(root).drop(self.run)


class StoresSource(DataSource):
    """The writer's format; options: roots, a JSON list of folders, and run."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _StoresWriter(json.loads(self.options["roots"]), self.options["run"])


def publish_to(lists: DataFrame, roots: Sequence[str], run: str, key: str = "list_key", rank: str = "rank") -> None:
    """Replace the lists of the keys in ``lists`` in every store, or in none if anything fails.

    A list is at most as long as the k it was ranked with, so a row holds a whole list. The same run again changes nothing.
    A task holds its share of the lists, which the partitions of ``lists`` bound.
    """
    spark = lists.sparkSession
    spark.dataSource.register(StoresSource)
    recover(roots)
    fields = [c for c in lists.columns if c not in (key, rank)]
    row = F.struct(rank, *fields)
    whole = lists.groupBy(F.col(key).cast("string").alias("list_key")).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    whole.write.format(FORMAT).mode("append").option("roots", json.dumps(list(roots))).option("run", run).save()


def read_store(spark: SparkSession, root: str, rows: str, roots: Sequence[str] = ()) -> DataFrame:
    """(list_key, rank, fields...) of the lists that are published in a store; ``rows`` is the type of a list's rows.

    ``roots`` are the stores that are written together, so that an unfinished run is finished first.
    """
    recover(roots or [root])
    schema = f"list_key string, rows array<struct<{rows}>>"
    found = spark.createDataFrame([], f"{schema}, nth int")
    for nth, run in enumerate(FolderStore(root).runs()):
        part = spark.read.schema(schema).json(os.path.join(root, "runs", run))
        found = found.unionByName(part.withColumn("nth", F.lit(nth)))
    last = found.groupBy("list_key").agg(F.max_by("rows", "nth").alias("rows"))
    return last.select("list_key", F.explode("rows").alias("_r")).select("list_key", "_r.*")
