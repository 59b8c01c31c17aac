"""Where a load is read from and written to, and where its files go afterwards."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.functions.paths import (
    CHANGES_SUFFIX,
    DATA_SUFFIX,
    SIDECAR_SUFFIX,
    base_name,
    dir_name,
    root_name,
    starts_below,
)
from lakeload.functions.times import format_snapshot


@dataclass(frozen=True)
class Layout:
    """Storage roots (with their trailing slash) and the key prefixes of the two feeds."""

    incoming: str = "incoming/"
    lake: str = "lake/"
    archive: str = "archive/"
    errors: str = "errors/"
    replication_prefix: str = "ods/"
    dataset_prefix: str = "datasets/"


def is_replicated(key: Column, layout: Layout = Layout()) -> Column:
    """Loads of the replication feed have snapshots and sidecars."""
    return starts_below(key, layout.replication_prefix)


def route_loads(loads: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """Source and destination of each load (``id, s3_key, is_raw, table_name, …``).

    Change files go to a table of their own; raw loads below ``raw/`` and to a
    table named ``raw_…``. A NULL ``is_raw`` means not raw.
    """
    key, raw = F.col("s3_key"), F.coalesce(F.col("is_raw"), F.lit(False))
    folder = dir_name(key)
    source_table = F.when(folder.endswith(CHANGES_SUFFIX), F.concat("table_name", F.lit(CHANGES_SUFFIX))).otherwise(
        F.col("table_name")
    )
    return loads.withColumns(
        {
            "source_table_name": source_table,
            "destination_table_name": F.when(raw, F.concat(F.lit("raw_"), source_table)).otherwise(source_table),
            "source_path": F.concat(F.lit(layout.incoming), key),
            "destination_path": F.concat(F.lit(layout.lake), F.when(raw, F.lit("raw/")).otherwise(F.lit("")), folder),
            "identifier": base_name(key),
        }
    )


def required_snapshot(snapshot: Column, load_id: Column) -> Column:
    """A replicated load without snapshot must not be routed or archived."""
    complaint = F.concat(F.lit("no snapshot for load "), load_id.cast("string"))
    return F.coalesce(format_snapshot(snapshot), F.raise_error(complaint).cast("string"))


def lacking_snapshot(routed: DataFrame, latest_snapshots: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """Replicated loads that :func:`routed_partitions` would fail for."""
    known = latest_snapshots.where(F.col("snapshot").isNotNull()).select(F.col("load_id").alias("id"))
    return routed.where(is_replicated(F.col("s3_key"), layout)).join(known, "id", "left_anti")


def routed_partitions(routed: DataFrame, latest_snapshots: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """Add ``partition_columns``: the snapshot (replicated loads only), then the identifier.

    ``latest_snapshots`` holds ``load_id, snapshot``, one row per load.
    """
    pair = lambda name, value: F.struct(F.lit(name).alias("name"), value.alias("value"))
    identifier = pair("identifier", F.col("identifier"))
    snapshot = pair("snapshot", required_snapshot(F.col("snapshot"), F.col("id")))
    partitions = F.when(is_replicated(F.col("s3_key"), layout), F.array(snapshot, identifier)).otherwise(F.array(identifier))
    return with_latest_snapshot(routed, latest_snapshots).withColumn("partition_columns", partitions)


def with_latest_snapshot(loads: DataFrame, latest_snapshots: DataFrame) -> DataFrame:
    """Both sides have one row per load."""
    return loads.join(latest_snapshots.select(F.col("load_id").alias("id"), "snapshot"), "id", "left")


def archive_root(layout: Layout = Layout()) -> Column:
    """Archive key without extension; needs ``id, s3_key, snapshot``."""
    key = F.col("s3_key")
    stamped = F.concat(
        dir_name(key), F.lit("/snapshot="), required_snapshot(F.col("snapshot"), F.col("id")), F.lit("/"), base_name(key, DATA_SUFFIX)
    )
    return F.when(is_replicated(key, layout), stamped).otherwise(_plain_root(key))


def error_root(layout: Layout = Layout()) -> Column:
    """Quarantine key without extension; needs ``s3_key, s3_modified``."""
    key = F.col("s3_key")
    stamped = F.concat(
        dir_name(key), F.lit("/timestamp="), format_snapshot(F.col("s3_modified")), F.lit("/"), base_name(key, DATA_SUFFIX)
    )
    return F.when(is_replicated(key, layout), stamped).otherwise(_plain_root(key))


def _plain_root(key: Column) -> Column:
    return F.concat(dir_name(key), F.lit("/"), base_name(key, DATA_SUFFIX))


def move_pairs(loads: DataFrame, destination_root: Column, layout: Layout = Layout()) -> DataFrame:
    """One row per file to move: the data file, and the sidecar of replicated loads."""
    suffixes = F.when(
        is_replicated(F.col("s3_key"), layout), F.array(F.lit(DATA_SUFFIX), F.lit(SIDECAR_SUFFIX))
    ).otherwise(F.array(F.lit(DATA_SUFFIX)))
    placed = loads.select("id", root_name(F.col("s3_key")).alias("source"), destination_root.alias("destination"), suffixes.alias("suffixes"))
    return placed.select("id", "source", "destination", F.explode("suffixes").alias("suffix")).select(
        "id",
        F.concat("source", "suffix").alias("source_key"),
        F.concat("destination", "suffix").alias("destination_key"),
    )
