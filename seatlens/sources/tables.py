"""Typed reads, publishing to tables, CSV and text exports."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seatlens.plans.quality import worst_first
from seatlens.schemas import PUBLISHED_AGGREGATED, conform
from seatlens.session import stage
from seatlens.sources import files, ledger


_VERSION = re.compile("[0-9a-f]{32}")


def require_table(spark: SparkSession, name: str) -> DataFrame:
    """The named table, or a plain error before any job runs."""
    if not spark.catalog.tableExists(name):
        raise FileNotFoundError(f"missing input table {name}: build the marts first")
    return spark.table(name)


def require_inputs(tables: dict[str, DataFrame | None], names: Sequence[str], job: str) -> None:
    missing = [n for n in names if tables.get(n) is None]
    if missing:
        raise FileNotFoundError(f"{job} needs {', '.join(missing)}")


def write_csv(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """Replace ``path`` by CSV with a header, globally sorted if asked to."""
    (df.orderBy(*order) if order else df).write.mode("overwrite").option("header", True).option(
        "escape", '"'
    ).csv(path)


def read_csv(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    """Read a CSV this library wrote, typed by its contract instead of guessed."""
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in contract])
    raw = spark.read.schema(texts).option("header", True).option("escape", '"').csv(path)
    return conform(raw, contract)


def publish(
    df: DataFrame,
    table: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    path: str | None = None,
    contract: T.StructType = PUBLISHED_AGGREGATED,
    partition_by: Sequence[str] = ("year", "month"),
) -> int:
    """Write ``df`` as a table and return the number of rows written.

    ``overwrite`` writes the new table beside the old one and then puts it in its
    place, so its schema may change, a failed run changes nothing, and the name
    has no table only between two calls to the catalog. The table's files lie in a
    folder of their own below ``path``, or below the database's; the version that
    was replaced stays for those who still read it until the next one comes.

    ``append`` adds a batch of rows once: a batch with the same rows, in whatever
    order, that the table's ledger already holds is left out, and 0 is returned.
    A run that broke off is finished by the next run with the same batch.
    ``replace`` puts the batch in the place of all rows of its partitions.

    A database is created only for a dotted name. Rows are rebalanced by partition
    column: a large month is split over several tasks and small ones share one, so
    neither skew nor a swarm of small files forms.
    """
    if mode not in ("overwrite", "append", "replace"):
        raise ValueError(f"mode must be overwrite, append or replace, not {mode}")
    spark = df.sparkSession
    database, dot, _ = table.rpartition(".")
    if dot:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    typed = conform(df, contract)
    if fmt == "parquet":
        if mode == "overwrite":
            return _switch(typed, table, _base(spark, table, path), partition_by)
        if not spark.catalog.tableExists(table):  # an empty table, which the batch is then added to like any other
            _create(typed, table, f"{_base(spark, table, path)}/{uuid.uuid4().hex}", partition_by)
        add = _append_once if mode == "append" else _replace_partitions
        return add(typed, table, partition_by)
    if mode == "replace":
        raise ValueError(f"replace is for parquet tables, not {fmt}")
    written = Observation()
    rows = typed.observe(written, F.count(F.lit(1)).alias("rows"))
    writer = (rows.hint("rebalance", *partition_by) if partition_by else rows).write.format(fmt)
    writer = writer.mode("overwrite" if mode == "overwrite" else "append").partitionBy(*partition_by)
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    spark.sql(f"REFRESH TABLE {table}")
    return written.get["rows"]


def _base(spark: SparkSession, table: str, path: str | None) -> str:
    """The folder that a table's versions lie in: the given one, or one of its database's."""
    database, _, name = table.rpartition(".")
    if path:
        return path.rstrip("/")
    home = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{home.rstrip('/')}/{name}.versions"


def _create(typed: DataFrame, table: str, folder: str, partition_by: Sequence[str]) -> None:
    """Put a table on a folder, in the place of the one of that name if there is one."""
    spark = typed.sparkSession
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in typed.schema)
    parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    files.make_folder(spark, folder)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {parts} LOCATION '{folder}'")
    if partition_by:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    spark.sql(f"REFRESH TABLE {table}")


def _switch(typed: DataFrame, table: str, base: str, partition_by: Sequence[str]) -> int:
    """Write a new version of a table, then put the table on it; the version before the last is deleted."""
    spark, written, own = typed.sparkSession, Observation(), uuid.uuid4().hex
    before = _location(spark, table).rpartition("/")[2] if spark.catalog.tableExists(table) else ""
    rows = typed.observe(written, F.count(F.lit(1)).alias("rows"))
    (rows.hint("rebalance", *partition_by) if partition_by else rows).write.partitionBy(*partition_by).parquet(f"{base}/{own}")
    _create(typed, table, f"{base}/{own}", partition_by)
    for name in files.names(spark, base):
        if name not in (own, before) and _VERSION.fullmatch(name):
            files.remove(spark, f"{base}/{name}")
    return written.get["rows"]


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0].data_type.rstrip("/")


def _append_once(typed: DataFrame, table: str, partition_by: Sequence[str]) -> int:
    """Add a batch that the table's ledger doesn't hold yet."""
    spark = typed.sparkSession
    location = _location(spark, table)
    batch = stage(typed, "batch")  # digest and rows come from the same run of the query
    name = ledger.digest(batch)
    if ledger.holds(spark, location, name):
        return 0
    rows = ledger.add(batch.hint("rebalance", *partition_by) if partition_by else batch, location, name, partition_by)
    if partition_by:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    spark.sql(f"REFRESH TABLE {table}")
    return rows


def _replace_partitions(typed: DataFrame, table: str, partition_by: Sequence[str]) -> int:
    """The batch in the place of what its partitions held; without partitions, of the whole table."""
    spark, written = typed.sparkSession, Observation()
    batch = stage(typed, "batch")  # it may come from the partitions that it replaces
    rows = batch.observe(written, F.count(F.lit(1)).alias("rows"))
    if partition_by:
        rows = rows.hint("rebalance", *partition_by)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(_location(spark, table))
    if partition_by:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    spark.sql(f"REFRESH TABLE {table}")
    return written.get["rows"]


def write_reports(reports: dict[str, DataFrame], folder: str) -> list[str]:
    """Write the quality reports; issue lists only when they have rows."""
    written = []
    for name, report in reports.items():
        target = f"{folder}/{name}"
        if name == "validation_summary":
            # A dozen lines, in one file and in order.
            lines = report.coalesce(1).sortWithinPartitions("ord").select("line")
            lines.write.mode("overwrite").text(target)
        elif name == "by_location_summary":
            write_csv(worst_first(report), target)
        elif report.isEmpty():
            files.remove(report.sparkSession, target)  # an earlier run's list would be taken for this one's
            continue
        else:
            write_csv(report, target, ["office_location", "date"])
        written.append(name)
    return written
