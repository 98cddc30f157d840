"""Counts over the last days, kept by adding and taking off whole days.

Every day of a log is counted once. A window's counts change by the days that enter or leave it and by days that came late or
came again; nothing else is read. Days and windows are versions of one folder, so a run that fails changes nothing.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from viewloom.session import cut_lineage
from viewloom.sinks.versions import Versions
from viewloom.sources.logs import as_date


@dataclass
class State:
    """The day after the windows' last one, the folder of every counted day and of every window, and their columns."""

    version: int = 0
    as_of: str = ""
    days: dict[str, str] = field(default_factory=dict)
    windows: dict[str, str] = field(default_factory=dict)
    schema: dict = field(default_factory=dict)


class RollingCounts:
    """Plays per ``keys`` in windows of ``spans`` days, each up to the day before ``as_of``."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], spans: Sequence[int] = (30, 60, 90, 365)):
        self.spark, self.path, self.keys, self.spans = spark, path.rstrip("/"), list(keys), sorted(spans)
        self.store = Versions(spark, path)

    def state(self) -> State:
        found = self.store.read()
        return State(**found) if found else State()

    def counts(self, span: int) -> DataFrame:
        """(keys..., plays) of the window; days that were never loaded have none."""
        state = self.state()
        return self._read(state, [state.windows[str(span)]])

    def missing(self, span: int) -> list[str]:
        """Days of the window that were never loaded."""
        state = self.state()
        return [d for d in _window(state.as_of, span) if d not in state.days]

    def _read(self, state: State, folders: Sequence[str]) -> DataFrame:
        schema = StructType.fromJson(state.schema)
        paths = [f"{self.path}/{f}" for f in folders]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def load(self, plays: DataFrame, as_of: dt.date | str | None = None, day: str = "dt") -> int:
        """Count the days in ``plays`` (column ``day``), each whole, and move the windows to ``as_of``; returns the version.

        A day that was loaded before is replaced. Without ``as_of`` the windows stay where they are, or end with the newest
        day of the first load. Days outside of all windows are kept for later.
        """
        old = self.state()
        counted = plays.where(F.col(day).isNotNull()).groupBy(F.col(day).cast("date").alias("_day"), *self.keys)
        counted = cut_lineage(counted.agg(F.count(F.lit(1)).alias("plays")))
        loaded = sorted(r[0].isoformat() for r in counted.select("_day").distinct().collect())
        if not old.schema:
            old.schema = counted.drop("_day").schema.jsonValue()
        if as_of is not None:
            until = as_date(as_of).isoformat()
        else:
            until = old.as_of or ((as_date(loaded[-1]) + dt.timedelta(days=1)).isoformat() if loaded else "")
        if not until:
            return old.version
        run = f"data/{uuid.uuid4().hex}"
        counted.repartition("_day").write.partitionBy("_day").parquet(f"{self.path}/{run}/days")
        days = {**old.days, **{d: f"{run}/days/_day={d}" for d in loaded}}
        new = State(old.version + 1, until, days, {}, old.schema)
        for span in self.spans:
            new.windows[str(span)] = self._moved(old, new, span, loaded, f"{run}/window={span}")
        self.store.switch(new.version, asdict(new))
        return new.version

    def _moved(self, old: State, new: State, span: int, loaded: Sequence[str], folder: str) -> str:
        before = set(_window(old.as_of, span)) if str(span) in old.windows else set()
        after = set(_window(new.as_of, span))
        changed = (before ^ after) | set(loaded)
        add = [new.days[d] for d in sorted(changed & after) if d in new.days]
        take = [old.days[d] for d in sorted(changed & before) if d in old.days]
        if not add and not take and before:
            return old.windows[str(span)]
        parts = [self._read(old, [old.windows[str(span)]])] if before else []
        parts += [self._read(new, add), self._read(old, take).withColumn("plays", -F.col("plays"))]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        summed = rows.groupBy(*self.keys).agg(F.sum("plays").alias("plays")).where("plays <> 0")
        summed.write.parquet(f"{self.path}/{folder}")
        return folder

    def clean(self, keep: int = 2) -> None:
        """Forget all but the newest ``keep`` versions and what only they name. Not during a load."""
        self.store.keep(keep, lambda state: [*state["days"].values(), *state["windows"].values()])


def _window(as_of: str, span: int) -> list[str]:
    if not as_of:
        return []
    end = as_date(as_of)
    return [(end - dt.timedelta(days=i)).isoformat() for i in range(span, 0, -1)]
