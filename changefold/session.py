"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Pin what results depend on: payload dates are read in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may go without it; it then gets a new temporary folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="changefold-")
    return _own_dirs[app]


def new_run_dir(spark: SparkSession, purpose: str) -> str:
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


_interim: ContextVar[list[str] | None] = ContextVar("interim", default=None)


@contextmanager
def interim(spark: SparkSession) -> Iterator[None]:
    """The tables that ``materialize`` writes inside are removed at the end, also after an
    error. What is made of them has to be written or collected before.

    Blocks may be nested: each removes its own tables. Outside of any block, tables stay
    until the shared folder is cleared.
    """
    written: list[str] = []
    token = _interim.set(written)
    try:
        yield
    finally:
        _interim.reset(token)
        files = spark._jvm.org.apache.hadoop.fs
        for path in map(files.Path, written):
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


@contextmanager
def tasks_at_least(spark: SparkSession, tasks: int) -> Iterator[None]:
    """Shuffles that are planned inside have so many partitions or more, so that what a task
    sorts does not grow with the rows. Adaptive execution merges those that are small."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(int(before), tasks)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder once and go on from the written table.

    Used where several consumers would otherwise repeat a fold. Unlike a cache,
    the written table survives the loss of executors.
    """
    path = new_run_dir(df.sparkSession, purpose)
    if (written := _interim.get()) is not None:
        written.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
