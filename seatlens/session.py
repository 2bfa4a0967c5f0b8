"""Session settings and the shared folder that intermediate tables live in."""

from __future__ import annotations

import contextlib
import functools
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app_name: str = "seatlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tested under.

    Nothing here is required for correct results: the plans guard their own
    casts, so they also run in a session somebody else configured.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _own_folder() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="seatlens-")


def _on_one_machine(spark: SparkSession, folder: str) -> bool:
    """Whether a path lies in the temporary folders that every machine has of its own."""
    scheme = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", folder)
    default = spark.conf.get("spark.hadoop.fs.defaultFS", None) or "file:"
    of_machine = scheme[1] == "file" if scheme else default.startswith("file:")
    return of_machine and re.match(r"(file:)?/*(tmp|var/tmp)(/|$)", folder) is not None


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read, named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting. A cluster without it is an
    error, and so is one whose setting names a machine's own temporary folder,
    because the others don't see that. A file path that all machines have mounted
    is fine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not spark.sparkContext.master.startswith("local") and _on_one_machine(spark, named):
            raise ValueError(f"spark.checkpoint.dir must be shared by the whole cluster, not {named}")
        return f"{named.rstrip('/')}/seatlens/{spark.sparkContext.applicationId}"
    if spark.sparkContext.master.startswith("local"):
        return _own_folder().name
    raise ValueError("set spark.checkpoint.dir to a folder shared by the whole cluster")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


_scopes: list[list[str]] = []


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the files.

    Used where several consumers hang off one expensive result. The files
    survive the loss of any executor, end the lineage, and give the optimizer
    true sizes for its join choices.
    """
    path = new_folder(df.sparkSession, label)
    if _scopes:
        _scopes[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def temporary_stages(spark: SparkSession) -> Iterator[None]:
    """Delete what was staged inside the block when it ends; nothing may read it afterwards."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


# Frames of up to this many short rows are broadcast; larger ones are joined
# however the optimizer sees fit.
BROADCAST_ROWS = 100_000


def broadcast_if_small(staged: DataFrame, rows: int | None = None) -> DataFrame:
    """Mark a staged frame for broadcast if its counted rows allow it."""
    count = staged.count() if rows is None else rows
    return F.broadcast(staged) if count <= BROADCAST_ROWS else staged


def task_slots(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism
