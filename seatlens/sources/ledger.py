"""Batches that are added to a table's folder once, whatever is run again.

A batch is known by a digest of its rows. Its files are first written complete below
the table's ``_pending`` folder, then moved into the partitions under names that
begin with the digest, and at last entered in the ledger, the table's ``_batches``
folder. Spark's scans see neither folder. A run that breaks off before the files are
complete leaves nothing; one that breaks off later is finished by the next, which
moves what is left of the very same files. So no batch is in the table twice, and none
in part for good.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatlens.sources import files


def digest(batch: DataFrame) -> str:
    """A digest of a batch's rows that doesn't depend on their order: their number and two sums of their hashes."""
    values = [v for c in batch.columns for v in (F.col(c), F.col(c).isNull())]  # a null alone leaves a hash as it was
    sums = [F.sum(F.xxhash64(*values, F.lit(seed)).cast("decimal(38,0)")).alias(f"h{seed}") for seed in (1, 2)]
    found = batch.agg(F.count(F.lit(1)).alias("n"), *sums).first()
    return "-".join(f"{int(v or 0) % 2**64:016x}" for v in found)


def _entry(location: str, name: str) -> str:
    return f"{location}/_batches/{name}.json"


def holds(spark: SparkSession, location: str, name: str) -> bool:
    return files.exists(spark, _entry(location, name))


def enter(spark: SparkSession, location: str, name: str, rows: int) -> None:
    files.create_text(spark, _entry(location, name), json.dumps({"rows": rows}))


def entries(spark: SparkSession, location: str) -> dict[str, int]:
    """The rows of each batch the table holds."""
    found = [n.removesuffix(".json") for n in files.names(spark, f"{location}/_batches") if n.endswith(".json")]
    return {n: json.loads(files.read_text(spark, _entry(location, n)))["rows"] for n in found}


def add(batch: DataFrame, location: str, name: str, partition_by: Sequence[str]) -> int:
    """Write a batch's files, move them into the table's folder and enter it; return its rows."""
    spark = batch.sparkSession
    pending = f"{location}/_pending/{name}"
    if not files.exists(spark, f"{pending}/_SUCCESS"):
        batch.write.mode("overwrite").partitionBy(*partition_by).parquet(pending)
    rows = int(name.partition("-")[0], 16)
    # As many names as the batch has files: a few per partition.
    for file in files.files_below(spark, pending):
        folder, _, own = file.rpartition("/")
        if not own.startswith(("_", ".")):
            files.rename(spark, f"{pending}/{file}", "/".join(p for p in (location, folder, f"{name}-{own}") if p))
    enter(spark, location, name, rows)
    files.remove(spark, pending)
    return rows
