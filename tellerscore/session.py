"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Row, SparkSession

T = TypeVar("T")

#: More rows than this go through a merge join.
BROADCAST_ROWS = 200_000

_scope: ContextVar[list[str] | None] = ContextVar("tables of the running scope", default=None)
_local_folder: tempfile.TemporaryDirectory | None = None


def build_session(app: str = "tellerscore", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and UTC clock semantics."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir`` where the cluster names one.

    Only a local session without that setting gets a temporary folder of its own, since a
    machine-local folder is lost with its executor.
    """
    global _local_folder
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_folder is None:
        _local_folder = tempfile.TemporaryDirectory(prefix="tellerscore-")
    return _local_folder.name


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    run = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/tellerscore/{run}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    Cuts lineage so that a lost executor cannot make a nondeterministic column change, and lets
    several later scans each read only the columns they need.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    scope = _scope.get()
    if scope is not None:
        scope.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_measured(df: DataFrame, name: str, *measures: Column) -> tuple[DataFrame, Row]:
    """:func:`materialize`, and one row of aggregates read back from the written columns."""
    written = materialize(df, name)
    return written, written.agg(*measures).first()


def joinable(df: DataFrame, rows: int) -> DataFrame:
    """``df`` as the side of a join, never broadcast if it has many ``rows``.

    Broadcasts are planned by the size of files, where sorted or repeated values take a small part of their
    size in the driver's memory.
    """
    return df.hint("merge") if rows > BROADCAST_ROWS else df


def concurrently(spark: SparkSession, *jobs: Callable[[], T]) -> list[T]:
    """Run independent Spark jobs side by side, so that a small one does not wait for a large one."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [future.result() for future in futures]


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that ``materialize`` writes inside, for jobs that repeat without end."""
    written: list[str] = []
    token = _scope.set(written)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in written:
            _delete(spark, path)


def release(spark: SparkSession) -> None:
    """Delete every intermediate table this application wrote to the shared folder."""
    _delete(spark, f"{shared_folder(spark)}/tellerscore/{spark.sparkContext.applicationId}")


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
