"""Names of input files, through the file system that Spark itself uses."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

REJECTED = "source_file string, error string"
_HIDDEN = "name begins with _ or . and is not listed"


def literal(folder: str) -> str:
    """A folder's path as a glob pattern that matches only itself."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", folder.rstrip("/"))


def _statuses(spark: SparkSession, pattern: str) -> list:
    """What a glob pattern matches, hidden names included. A call per match: for patterns that match little."""
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return list(place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or [])


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a glob pattern matches."""
    return [status.getPath().toString() for status in _statuses(spark, pattern)]


def matching_folders(spark: SparkSession, pattern: str) -> list[str]:
    """The paths of the folders that a glob pattern matches."""
    return [status.getPath().toString() for status in _statuses(spark, pattern) if status.isDirectory()]


def path_depth(spark: SparkSession, folder: str) -> int:
    """How many names a folder's whole path has."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    whole = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place)
    return whole.depth()


def hidden_files(spark: SparkSession, patterns: list[str]) -> DataFrame:
    """Files that match a pattern but that Spark's scans leave out because of their names.

    Only such names come to the driver; there are few, mostly none.
    """
    names = [path for pattern in patterns for path in matching(spark, pattern)]
    return spark.createDataFrame([(re.sub("^file:/+", "/", n), _HIDDEN) for n in names], REJECTED)
