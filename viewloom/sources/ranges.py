"""A scan of Parquet files that another system wrote, by ranges of an id.

The ranges hold about equally many rows, whatever the ids look like: their borders are quantiles, taken from the row counts and the
least and largest ids that the files keep of their row groups. Every range is a partition that reads the row groups it
meets and the columns asked for. Conditions on the id cut the ranges before anything is read.

Files are opened by the tasks themselves, so the folder must be one that the driver and all executors mount.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.types import StructType

FORMAT = "viewloom_ranges"
LOWEST, HIGHEST = -(2**63), 2**63 - 1


@dataclass
class IdRange(InputPartition):
    """Ids from ``low`` to ``high``, both included; null ids go with the range that says so."""

    low: int
    high: int
    nulls: bool = False


def equal_ranges(groups: list[tuple[int, int, int]], parts: int, low: int = LOWEST, high: int = HIGHEST) -> list[tuple[int, int]]:
    """Up to ``parts`` ranges that cover [low, high] and hold about equally many of the rows of (least, largest, rows) groups.

    Within a group ids are taken to be spread evenly; a range is uneven by a few row groups at most.
    """
    inside = [(a, b, n * (min(b, high) - max(a, low) + 1) / (b - a + 1)) for a, b, n in groups if b >= low and a <= high]
    if not inside or parts < 2:
        return [(low, high)]
    edges = np.unique([v for a, b, _ in inside for v in (float(max(a, low)), float(min(b, high)) + 1)])
    rows = np.zeros(len(edges) - 1)
    for a, b, n in inside:
        x, y = np.searchsorted(edges, (float(max(a, low)), float(min(b, high)) + 1))
        widths = np.diff(edges[x : y + 1])
        rows[x:y] += n * widths / widths.sum()
    reached = np.concatenate(([0.0], np.cumsum(rows)))
    wanted = reached[-1] * np.arange(1, parts) / parts
    borders = sorted({int(np.floor(v)) for v in np.interp(wanted, reached, edges)} - {low})
    starts = [low, *[b for b in borders if low < b <= high]]
    return list(zip(starts, [*[s - 1 for s in starts[1:]], high], strict=True))


class _RangeReader(DataSourceReader):
    def __init__(self, path: str, column: str, parts: int, low: int, high: int, columns: list[str]):
        self.path, self.column, self.parts, self.low, self.high, self.columns = path, column, parts, low, high, columns
        self.nulls = low == LOWEST and high == HIGHEST

    def _fragments(self):
        import pyarrow.dataset as ds

        return list(ds.dataset(self.path, format="parquet").get_fragments())

    def partitions(self) -> list[IdRange]:
        groups = []
        for fragment in self._fragments():
            at = fragment.physical_schema.get_field_index(self.column)
            for i in range(fragment.metadata.num_row_groups):
                group = fragment.metadata.row_group(i)
                told = group.column(at).statistics
                if told is not None and told.has_min_max and group.num_rows:
                    groups.append((int(told.min), int(told.max), group.num_rows))
        if self.low > self.high:
            return [IdRange(self.low, self.high)]  # holds nothing; without any partition Spark reads the whole
        ranges = equal_ranges(groups, self.parts, self.low, self.high)
        return [IdRange(a, b, self.nulls and i == 0) for i, (a, b) in enumerate(ranges)]

    def read(self, partition: IdRange) -> Iterator[pa.RecordBatch]:
        import pyarrow.dataset as ds

        wanted = (pc.field(self.column) >= partition.low) & (pc.field(self.column) <= partition.high)
        if partition.nulls:
            wanted = wanted | pc.field(self.column).is_null()
        for batch in ds.dataset(self.path, format="parquet").to_batches(columns=self.columns, filter=wanted, batch_size=8192):
            if batch.num_rows:
                yield batch


class _PushingReader(_RangeReader):
    """Takes conditions on the id off Spark's hands; all others are Spark's."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            value = getattr(f, "value", None)
            known = isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual))
            if not known or f.attribute != (self.column,) or not isinstance(value, int) or isinstance(value, bool):
                yield f
                continue
            self.nulls = False
            if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                self.low = max(self.low, value + isinstance(f, GreaterThan))
            if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                self.high = min(self.high, value - isinstance(f, LessThan))


class RangeSource(DataSource):
    """The scan's format; options: path, column, partitions, and optionally low, high, columns (JSON) and pushed."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        import pyarrow.dataset as ds
        from pyspark.sql.pandas.types import from_arrow_schema

        whole = ds.dataset(self.options["path"], format="parquet").schema
        names = json.loads(self.options["columns"]) if "columns" in self.options else whole.names
        return from_arrow_schema(pa.schema([whole.field(c) for c in names]))

    def reader(self, schema: StructType) -> DataSourceReader:
        kind = _PushingReader if self.options.get("pushed") == "true" else _RangeReader
        return kind(
            self.options["path"],
            self.options["column"],
            int(self.options.get("partitions", "10")),
            int(self.options.get("low", LOWEST)),
            int(self.options.get("high", HIGHEST)),
            schema.names,
        )


def range_scan(
    spark: SparkSession,
    path: str,
    column: str,
    partitions: int = 10,
    columns: list[str] | None = None,
    low: int | None = None,
    high: int | None = None,
) -> DataFrame:
    """The rows of a folder of Parquet files with low <= column <= high, in ranges of about equally many rows.

    Without bounds rows with a null id are read as well. ``columns`` are read, all without it. Where the session allows Python sources to
    take conditions (spark.sql.python.filterPushdown.enabled), conditions on ``column`` cut the ranges too.
    """
    spark.dataSource.register(RangeSource)
    reader = spark.read.format(FORMAT).option("path", path).option("column", column).option("partitions", str(partitions))
    options = {"low": low, "high": high, "columns": json.dumps(columns) if columns else None}
    for name, value in options.items():
        if value is not None:
            reader = reader.option(name, str(value))
    if spark.conf.get("spark.sql.python.filterPushdown.enabled", "false") == "true":
        reader = reader.option("pushed", "true")
    return reader.load()
