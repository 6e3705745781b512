"""A stream over segment files of a change log, with an offset of its own for each partition of each topic.

A log is a folder of Parquet files below ``topic=<topic>/partition=<n>`` with the columns ``offset``, ``timestamp`` and
``value``; :func:`write_segments` adds to it. Within a partition offsets rise from file to file, and may have gaps.

``topics`` (comma separated, all by default) selects topics. ``maxOffsetsPerTrigger`` bounds a micro-batch: each
partition advances in proportion to what it has waiting, by at least one offset. ``offsetsPerTask`` (100,000) cuts the
range of a partition into tasks, so a hot partition is read by many. With ``availableNow`` a start takes one such
micro-batch; a running trigger takes all.

After a restart the reader learns where its stream stands from the first range that Spark asks it to plan. Should the
stream ever go back, as when a part of the log is lost while the checkpoint is kept, it fails instead of reading
records twice.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from tellerscore.schemas import BROKER_RECORD

NAME = "segments"
_ARROW = {
    "value": pa.string(),
    "partition": pa.int32(),
    "offset": pa.int64(),
    "topic": pa.string(),
    "timestamp": pa.timestamp("us", tz="UTC"),
}


@dataclass
class OffsetRange(InputPartition):
    """Records of one file with offsets from ``first`` to before ``end``."""

    topic: str
    number: int
    file: str
    first: int
    end: int


def advance(position: dict[str, int], newest: dict[str, int], limit: int | None) -> dict[str, int]:
    """Where a micro-batch ends that starts at ``position`` and takes about ``limit`` of the offsets waiting."""
    waiting = {key: end - position.get(key, 0) for key, end in newest.items()}
    total = sum(n for n in waiting.values() if n > 0)
    ends = dict(position)
    for key, n in waiting.items():
        if n > 0:
            ends[key] = newest[key] - n + (n if limit is None else min(n, max(1, limit * n // total)))
    return ends


class _Log:
    def __init__(self, path: str):
        self.path = re.sub(r"^file:/(?=[^/])", "file:///", path).rstrip("/")

    def open(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path)


class _Reader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.names = schema.names
        self.log = _Log(options["path"])
        self.topics = {t.strip() for t in options.get("topics", "").split(",")} - {""}
        limit = options.get("maxOffsetsPerTrigger")
        self.limit = None if limit is None else int(limit)
        self.per_task = int(options.get("offsetsPerTask", 100_000))
        self.bounds: dict[str, tuple[str, int, int, int]] = {}
        self.position: dict[str, int] = {}

    def _list(self) -> list[tuple[str, str, int, int, int]]:
        """File, topic, partition, first and last offset of each segment; footers of new files are read."""
        system, root = self.log.open()
        for info in system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            inner = info.path[len(root) + 1 :]
            named = re.fullmatch(r"topic=([^/]+)/partition=(\d+)/([^/_.][^/]*\.parquet)", inner)
            if not named or inner in self.bounds or self.topics and named[1] not in self.topics:
                continue
            footer = pq.read_metadata(info.path, filesystem=system)
            place = footer.schema.to_arrow_schema().get_field_index("offset")
            stats = [footer.row_group(i).column(place).statistics for i in range(footer.num_row_groups)]
            if stats:
                self.bounds[inner] = named[1], int(named[2]), min(s.min for s in stats), max(s.max for s in stats)
        return [(file, *bounds) for file, bounds in self.bounds.items()]

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        newest: dict[str, int] = {}
        for _, topic, number, _, last in self._list():
            key = f"{topic}/{number}"
            newest[key] = max(newest.get(key, 0), last + 1)
        return advance(self.position, newest, self.limit)

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        behind = [key for key, at in start.items() if end.get(key, 0) < at]
        if behind:
            raise ValueError(f"the log is behind the checkpoint in {behind}")
        self.position = dict(end)
        found = []
        for file, topic, number, first, last in sorted(self._list()):
            key = f"{topic}/{number}"
            low, high = max(first, start.get(key, 0)), min(last + 1, end.get(key, 0))
            for at in range(low, high, self.per_task):
                found.append(OffsetRange(topic, number, file, at, min(at + self.per_task, high)))
        return found

    def read(self, partition: OffsetRange) -> Iterator[pa.RecordBatch]:
        system, root = self.log.open()
        with pq.ParquetFile(f"{root}/{partition.file}", filesystem=system) as file:
            place = file.schema_arrow.get_field_index("offset")
            stats = [file.metadata.row_group(i).column(place).statistics for i in range(file.num_row_groups)]
            groups = [i for i, s in enumerate(stats) if s.max >= partition.first and s.min < partition.end]
            kept = [n for n in self.names if n in file.schema_arrow.names]
            for batch in file.iter_batches(row_groups=groups, columns=[*{*kept, "offset"}]) if groups else ():
                offset = batch.column("offset")
                batch = batch.filter(pc.and_(pc.greater_equal(offset, partition.first), pc.less(offset, partition.end)))
                own = {"topic": partition.topic, "partition": partition.number}
                columns = [
                    pa.repeat(pa.scalar(own[n], _ARROW[n]), batch.num_rows) if n in own else batch.column(n).cast(_ARROW[n])
                    for n in self.names
                ]
                yield pa.RecordBatch.from_arrays(columns, self.names)


class Segments(DataSource):
    @classmethod
    def name(cls):
        return NAME

    def schema(self):
        return BROKER_RECORD

    def streamReader(self, schema):
        return _Reader(schema, self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Segments)


def write_segments(records: DataFrame, path: str) -> None:
    """Add records with ``topic, partition, offset, timestamp, value`` to a log; they must follow what is there.

    A hot partition is cut into files by offset, so no task writes it whole.
    """
    ordered = records.select("topic", "partition", "offset", "timestamp", "value")
    ordered = ordered.repartitionByRange("topic", "partition", "offset").sortWithinPartitions("topic", "partition", "offset")
    ordered.write.partitionBy("topic", "partition").mode("append").parquet(path)
