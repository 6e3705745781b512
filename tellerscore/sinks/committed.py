"""A sink whose micro-batches appear as a whole and once, however often they are tried.

A target is a folder with two parts. Tasks put rows into files of ``data``, which count for nothing yet. When all
tasks are done the driver writes one manifest that names the files of the micro-batch; it is moved into ``manifests``
in one step. A micro-batch that has a manifest is not written again: the files of a repeated attempt are deleted.
So are those of an attempt that fails; files of lost executors stay, unnamed and unread.

As a stream::

    register(spark)
    df.writeStream.format(NAME).option("path", folder).option("checkpointLocation", ...).start()

A batch write names its micro-batch with option ``batch``. Micro-batches are numbered within option ``stream``
(``0``): a stream that starts anew with an empty checkpoint must take a name that sorts behind the earlier ones, since
its numbers start again. The folder must be one that all executors share, on a file system that pyarrow opens.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceStreamArrowWriter,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

NAME = "committed"
_MANIFEST = "stream string, batch long, file string, rows long"


@dataclass
class Written(WriterCommitMessage):
    """What a task wrote; a task without rows writes no file."""

    file: str | None
    rows: int


class _Target:
    def __init__(self, options: dict[str, str]):
        self.path = re.sub(r"^file:/(?=[^/])", "file:///", options["path"]).rstrip("/")
        self.stream = options.get("stream", "0")
        if not re.fullmatch(r"[A-Za-z0-9_.]+", self.stream):
            raise ValueError(f"a stream's name has letters, digits, dots and underscores only: {self.stream!r}")

    def open(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path)

    def create(self) -> None:
        system, root = self.open()
        for folder in ("data", "manifests"):
            system.create_dir(f"{root}/{folder}")

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        system, root = self.open()
        name, rows, writer = f"{uuid.uuid4().hex}.parquet", 0, None
        try:
            for batch in batches:
                if batch.num_rows:
                    writer = writer or pq.ParquetWriter(f"{root}/data/{name}", batch.schema, filesystem=system)
                    writer.write_batch(batch)
                    rows += batch.num_rows
            if writer:
                writer.close()
        except BaseException:
            if writer:
                writer.close()
                self.delete([Written(name, rows)])
            raise
        return Written(name if writer else None, rows)

    def commit(self, messages: list[Written | None], batch: int) -> None:
        system, root = self.open()
        target = f"{root}/manifests/{self.stream}-{batch}.json"
        if system.get_file_info(target).type != fs.FileType.NotFound:
            self.delete(messages)
            return
        named = [m for m in messages if m and m.file]
        lines = [json.dumps({"stream": self.stream, "batch": batch, "file": m.file, "rows": m.rows}) for m in named]
        unfinished = f"{root}/manifests/_{uuid.uuid4().hex}"
        with system.open_output_stream(unfinished) as out:
            out.write("".join(f"{line}\n" for line in lines).encode())
        system.move(unfinished, target)

    def delete(self, messages: list[Written | None]) -> None:
        system, root = self.open()
        for message in messages:
            if message and message.file:
                system.delete_file(f"{root}/data/{message.file}")


class _StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, target: _Target):
        self.target = target

    def write(self, iterator):
        return self.target.write(iterator)

    def commit(self, messages, batchId):
        self.target.commit(messages, batchId)

    def abort(self, messages, batchId):
        self.target.delete(messages)


class _BatchWriter(DataSourceArrowWriter):
    def __init__(self, target: _Target, batch: int):
        self.target, self.batch = target, batch

    def write(self, iterator):
        return self.target.write(iterator)

    def commit(self, messages):
        self.target.commit(messages, self.batch)

    def abort(self, messages):
        self.target.delete(messages)


class Committed(DataSource):
    @classmethod
    def name(cls):
        return NAME

    def _target(self) -> _Target:
        target = _Target(self.options)
        target.create()
        return target

    def streamWriter(self, schema, overwrite):
        return _StreamWriter(self._target())

    def writer(self, schema, overwrite):
        if overwrite or "batch" not in self.options:
            raise ValueError("a batch write is appended and names its micro-batch with option batch")
        return _BatchWriter(self._target(), int(self.options["batch"]))


def register(spark: SparkSession) -> None:
    """Make the sink known, also to a thread that has no session of its own: formats are looked up in the active one."""
    spark.dataSource.register(Committed)
    spark._jvm.org.apache.spark.sql.classic.SparkSession.setActiveSession(spark._jsparkSession)


def committed(spark: SparkSession, path: str, schema: StructType, id_column: str | None = None) -> DataFrame:
    """The rows of finished micro-batches; with ``id_column`` the last micro-batch's row of each id.

    Of several rows of one id in one micro-batch the greatest by its columns counts; rows without an id are one row.
    """
    manifests = spark.read.schema(_MANIFEST).json(f"{path}/manifests").select("stream", "batch", F.col("file").alias("_file"))
    data = spark.read.schema(schema).parquet(f"{path}/data")
    rows = data.withColumn("_row", F.struct(*[f"`{c}`" for c in schema.names])).select(
        "_row", F.col("_metadata.file_name").alias("_file")
    )
    found = rows.join(manifests, "_file")
    if id_column:
        last = F.max(F.struct("stream", "batch", "_row"))
        found = found.groupBy(F.col("_row").getField(id_column).alias("_id")).agg(last.alias("_last")).select("_last._row")
    return found.select("_row.*")
