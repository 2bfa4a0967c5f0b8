"""One switch for a set of tables: versioned folders and a manifest that is written last.

A build writes all its tables into a version's own folder. Then one small file, the
manifest, names that version and what it holds; it is numbered, and the one with the
highest number is in force. Until it is there, readers see the earlier version
complete, whatever of the new one was written; a failed build leaves them nothing new.
Two builds that end at once get two numbers: a manifest never replaces another.

A version may keep partitions of earlier ones: then its manifest says, for each
partition of a table, which version's folder holds it.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from seatlens.schemas import TABLES, conform
from seatlens.sources import files

_MANIFESTS = "_manifests"
_TRIES = 100


@dataclass(frozen=True)
class Version:
    """A committed version: its number, its folder's name and the rows of its tables."""

    number: int
    name: str
    rows: dict[str, int]
    #: per partitioned table, each partition's folder name and the version that holds it; without an entry all is here
    parts: dict[str, dict[str, str]] = field(default_factory=dict)


def new_version(root: str) -> str:
    """The folder of a version to be written; nobody reads it before it is committed."""
    return f"{root.rstrip('/')}/versions/{uuid.uuid4().hex}"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    found = files.names(spark, f"{root}/{_MANIFESTS}")
    return sorted(int(n.removesuffix(".json")) for n in found if n.removesuffix(".json").isdigit() and n.endswith(".json"))


def _manifest(root: str, number: int) -> str:
    return f"{root}/{_MANIFESTS}/{number:08d}.json"


def commit(
    spark: SparkSession, folder: str, rows: dict[str, int], parts: dict[str, dict[str, str]] | None = None
) -> Version:
    """Put a written version in force: from now on it is what readers get.

    ``rows`` names the tables it holds, with their counts, ``parts`` those of them whose
    partitions lie in several versions. All that is named must be there.
    """
    root, _, name = folder.rstrip("/").rpartition("/versions/")
    parts = parts or {}
    places = [f"{folder}/{t}" for t in rows if t not in parts]
    places += [f"{root}/versions/{v}/{t}/{p}" for t, own in parts.items() for p, v in own.items()]
    missing = [place for place in places if not files.exists(spark, place)]
    if missing:
        raise FileNotFoundError(f"{folder} lacks {', '.join(missing)}")
    for _ in range(_TRIES):
        number = max(_numbers(spark, root), default=0) + 1
        if files.create_text(spark, _manifest(root, number), json.dumps({"version": name, "rows": rows, "parts": parts})):
            return Version(number, name, rows, parts)
    raise OSError(f"no manifest could be written in {root}")


def current(spark: SparkSession, root: str) -> Version | None:
    """The version in force, or None before the first commit."""
    numbers = _numbers(spark, root)
    if not numbers:
        return None
    held = json.loads(files.read_text(spark, _manifest(root, numbers[-1])))
    return Version(numbers[-1], held["version"], held["rows"], held["parts"])


def partitions(spark: SparkSession, root: str, version: Version, table: str) -> dict[str, str]:
    """The partitions of a table by year and month, and the version that holds each."""
    if table in version.parts:
        return version.parts[table]
    folder = f"{root}/versions/{version.name}/{table}"
    own = {f.rpartition("/")[0] for f in files.files_below(spark, folder) if f.startswith("year=")}
    return dict.fromkeys(sorted(own), version.name)


def read(spark: SparkSession, root: str, table: str, version: Version | None = None) -> DataFrame:
    """A table of the version in force, or of another one, typed by its contract where it has one.

    Partitions of several versions are one scan for each of these.
    """
    version = version or current(spark, root)
    if version is None or table not in version.rows:
        raise FileNotFoundError(f"no version of {root} holds {table}")
    by_version: dict[str, list[str]] = {version.name: []}
    if table in version.parts:
        by_version = {}
        for part, name in version.parts[table].items():
            by_version.setdefault(name, []).append(part)
    if not by_version:
        return spark.createDataFrame([], TABLES[table])
    scans = []
    for name, own in sorted(by_version.items()):
        folder = f"{root}/versions/{name}/{table}"
        scans.append(spark.read.option("basePath", folder).parquet(*[f"{folder}/{p}" for p in own] or [folder]))
    found = reduce(DataFrame.unionByName, scans)
    return conform(found, TABLES[table]) if table in TABLES else found


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete manifests but the last ``keep``, and all folders that none of those names; return the folders' names.

    Not to be run beside a build, whose folder no manifest names yet.
    """
    numbers = _numbers(spark, root)
    held = numbers[-max(1, keep) :]
    used = set()
    for number in held:
        manifest = json.loads(files.read_text(spark, _manifest(root, number)))
        used |= {manifest["version"], *(v for own in manifest["parts"].values() for v in own.values())}
    for number in numbers[: -len(held)] if held else []:
        files.remove(spark, _manifest(root, number))
    gone = [n for n in files.names(spark, f"{root}/versions") if n not in used] if held else []
    for name in gone:
        files.remove(spark, f"{root}/versions/{name}")
    return gone
