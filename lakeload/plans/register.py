"""Registering tables, their snapshot rows and feeds in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.operators import discover, registration, routing
from lakeload.plans.store import LedgerStore


def run_registration(
    store: LedgerStore, tables: DataFrame, feeds: DataFrame | None = None, layout: routing.Layout = routing.Layout()
) -> DataFrame:
    """Record the candidate tables (``name, s3_prefix, is_raw``) and feeds (``relative_url``) that are new.

    Returns the candidates that were refused, with their ``reason``. Ids go on
    without gaps behind the last, in the order of names or addresses. Snapshot rows
    are written before the tables they belong to: no pass sees a table without its row.
    """
    pass_id = store.next_pass()
    before = (pass_id, 0)
    known = store.read("tables", before)
    judged_path = f"{store.root}/staged/registration/pass={pass_id}"
    registration.judged_tables(known, tables).write.mode("overwrite").parquet(judged_path)
    judged = store.spark.read.parquet(judged_path)

    added = _numbered(store, registration.accepted_tables(judged), known, "name", f"{judged_path}-tables")
    rows = registration.first_snapshots(added, layout.replication_prefix)
    snapshots = store.read("table_snapshots", before)
    started = _numbered(store, rows, snapshots, "snapshot_s3_key", f"{judged_path}-snapshots")
    _append(store, "table_snapshots", snapshots, started, pass_id)
    if feeds is not None:
        others = store.read("feeds", before)
        fresh = _numbered(store, registration.new_feeds(others, feeds), others, "relative_url", f"{judged_path}-feeds")
        _append(store, "feeds", others, fresh, pass_id)
    _append(store, "tables", known, added, pass_id)
    return judged.where("reason is not null")


def _numbered(store: LedgerStore, rows: DataFrame, known: DataFrame, order: str, path: str) -> DataFrame:
    ranged = rows.repartitionByRange(order).sortWithinPartitions(order)
    ranged.withColumn("__place", F.monotonically_increasing_id()).write.mode("overwrite").parquet(path)
    last = known.agg(F.max("id").alias("id")).first()["id"] or 0
    return discover.dense_load_ids(store.spark.read.parquet(path), last)


def _append(store: LedgerStore, kind: str, known: DataFrame, added: DataFrame, pass_id: int) -> None:
    now = F.current_timestamp()
    store.write(kind, known.unionByName(added.withColumns({"inserted_at": now, "updated_at": now}), allowMissingColumns=True), pass_id)
