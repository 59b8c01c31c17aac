"""From a listing to new ledger rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeload.functions.checks import is_data_object
from lakeload.functions.paths import CHANGES_SUFFIX, first_folder_below, prefix_of, swap_suffix
from lakeload.functions.times import truncate_second
from lakeload.operators.ledger import active_tables, first_per_group, live
from lakeload.runtime import lookup_join, row_count_within


def list_prefixes(objects: DataFrame, roots: Sequence[str], key: str = "key") -> DataFrame:
    """Folders directly below each root, each root's listing appended to the others."""
    found = F.explode(
        F.array_compact(
            F.array(
                *[
                    F.when(F.col(key).startswith(r), F.struct(F.lit(r).alias("root"), first_folder_below(F.col(key), r).alias("prefix")))
                    for r in roots
                ]
            )
        )
    )
    rows = objects.select(found.alias("f")).where("f.prefix is not null").select("f.root", "f.prefix").distinct()
    return rows.select("prefix")


def match_prefixes(prefixes: DataFrame, tables: DataFrame) -> DataFrame:
    """Prefixes of active tables (``prefix, table_id, table_name``); a change folder belongs to its base table."""
    based = prefixes.withColumn("s3_prefix", swap_suffix(F.col("prefix"), f"{CHANGES_SUFFIX}/", "/"))
    known = active_tables(tables).select("s3_prefix", F.col("id").alias("table_id"), F.col("name").alias("table_name"))
    return lookup_join(based, known, "s3_prefix", "inner", bounded_by=tables).drop("s3_prefix")


def valid_objects(objects: DataFrame, key: str = "key", size: str = "size") -> DataFrame:
    return objects.where(is_data_object(F.col(key), F.col(size)))


def table_watermark(loads: DataFrame) -> DataFrame:
    """Per table, when its last loaded object was modified."""
    return live(loads).groupBy("table_id").agg(F.max("s3_modified").alias("watermark"))


def new_objects(
    objects: DataFrame, loads: DataFrame, per_prefix: int | None = None, tables: DataFrame | None = None
) -> DataFrame:
    """Objects (``table_id, key, last_modified, …``) modified after their table's last load.

    The comparison is strict and in whole seconds; a table without loads takes
    everything. With ``per_prefix``, at most so many objects of each folder are
    kept, in key order. ``tables`` bounds the number of watermarks.
    """
    seen = lookup_join(objects, table_watermark(loads), "table_id", "left", bounded_by=tables)
    later = seen.where(F.col("watermark").isNull() | (truncate_second(F.col("last_modified")) > F.col("watermark"))).drop("watermark")
    if per_prefix is None:
        return later
    foldered = later.withColumn("__prefix", prefix_of(F.col("key")))
    return first_per_group(foldered, ["table_id", "__prefix"], ["key", "last_modified"], per_prefix).drop("__prefix")


def unseen_objects(objects: DataFrame, loads: DataFrame) -> DataFrame:
    """Objects that no load of the ledger stands for, by key and whole second.

    Unlike the watermark rule this loses no late or same-second object; a
    rewritten file counts as unseen.
    """
    done = live(loads).select(F.col("s3_key").alias("key"), truncate_second(F.col("s3_modified")).alias("__second"))
    return (
        objects.withColumn("__second", truncate_second(F.col("last_modified")))
        .join(done, ["key", "__second"], "left_anti")
        .drop("__second")
    )


def snapshot_events(objects: DataFrame, table_snapshots: DataFrame, few: bool) -> DataFrame:
    """Per snapshot table: its stored snapshot and the newest arrival of its snapshot file.

    ``few`` tells whether the snapshot tables are known to be few enough to broadcast.
    """
    snapshots = table_snapshots.select("table_id", "snapshot_s3_key", "snapshot")
    arrivals = lookup_join(
        objects.select("table_id", "key", truncate_second(F.col("last_modified")).alias("modified")),
        snapshots,
        "table_id",
        "inner",
        bounded_by=few,
    ).where(F.col("key") == F.col("snapshot_s3_key"))
    newest = arrivals.groupBy("table_id").agg(F.max("modified").alias("arrived"))
    return lookup_join(snapshots, newest, "table_id", "left", bounded_by=few, one_each=True)


def snapshot_fold(objects: DataFrame, table_snapshots: DataFrame) -> DataFrame:
    """Add ``snapshot`` and ``is_snapshot_table``: the table's snapshot when the object is reached in key order.

    Walking a table's objects by key (then time), the snapshot file replaces the
    stored snapshot by its own time. All arrivals of that file share one key, so
    they are neighbours in the walk: an object before them has the stored value,
    an object behind them the newest arrival, an arrival its own time. This needs
    one grouped maximum and no ordered window over a table's objects.
    """
    few = row_count_within(table_snapshots)
    folded = lookup_join(objects, snapshot_events(objects, table_snapshots, few), "table_id", "left", bounded_by=few)
    key, restart = F.col("key"), F.col("snapshot_s3_key")
    value = (
        F.when(key == restart, truncate_second(F.col("last_modified")))
        .when(key > restart, F.coalesce(F.col("arrived"), F.col("snapshot")))
        .otherwise(F.col("snapshot"))
    )
    return (
        folded.withColumns({"is_snapshot_table": restart.isNotNull(), "snapshot": value})
        .drop("snapshot_s3_key", "arrived")
    )


def table_snapshot_update(objects: DataFrame, table_snapshots: DataFrame) -> DataFrame:
    """The table snapshots after the objects were taken in."""
    after = snapshot_events(objects, table_snapshots, row_count_within(table_snapshots))
    return after.select("table_id", "snapshot_s3_key", F.coalesce("arrived", "snapshot").alias("snapshot"))


def new_load_rows(objects: DataFrame, tables: DataFrame, table_snapshots: DataFrame) -> DataFrame:
    """Ledger rows for new objects (``table_id, key, last_modified, size``).

    A load is ready when its object is not empty and, for a snapshot table, a
    snapshot is known; otherwise it goes to the error path. ``snapshot`` and
    ``is_snapshot_table`` come along for :func:`load_snapshot_rows`.
    """
    raw = tables.select(F.col("id").alias("table_id"), "is_raw")
    rows = lookup_join(snapshot_fold(objects, table_snapshots), raw, "table_id", "inner", bounded_by=tables)
    size = F.col("size").cast("long")
    usable = (size > 0) & (~F.col("is_snapshot_table") | F.col("snapshot").isNotNull())
    carried = [c for c in ("id",) if c in objects.columns]
    return rows.select(
        *carried,
        "table_id",
        F.when(usable, "ready").otherwise("ready_for_erroring").alias("status"),
        F.col("key").alias("s3_key"),
        truncate_second(F.col("last_modified")).alias("s3_modified"),
        size.alias("s3_size"),
        "is_raw",
        "snapshot",
        "is_snapshot_table",
    )


def load_snapshot_rows(load_rows: DataFrame) -> DataFrame:
    """The load-snapshot rows that belong to new loads of snapshot tables."""
    return load_rows.where("is_snapshot_table").select(F.col("id").alias("load_id"), "snapshot")


def with_row_places(load_rows: DataFrame, in_order: bool = False) -> DataFrame:
    """Rows with ``__place``: the task that writes them, and their place in it, rising in key order.

    A second evaluation may place rows differently: write the result once, and give
    :func:`dense_load_ids` what was written. The default adds no shuffle; with
    ``in_order`` the tasks hold ranges of keys, so the ids rise with the keys of all.
    """
    order = ["table_id", "s3_key", "s3_modified"]
    rows = load_rows.repartitionByRange(*order) if in_order else load_rows
    return rows.sortWithinPartitions(*order).withColumn("__place", F.monotonically_increasing_id())


def dense_load_ids(placed: DataFrame, after: int) -> DataFrame:
    """Number written rows ``after + 1, after + 2, …`` without gaps, in the order of ``__place``.

    The rows of each writing task are counted, the counts summed up in their order,
    and every row adds its place to the sum before its task. Only the counts, a row
    for each task, pass one window.
    """
    task, place = F.shiftright("__place", 33), F.col("__place").bitwiseAND((1 << 33) - 1)
    counts = placed.groupBy(task.alias("__task")).agg(F.count("*").alias("__rows"))
    ahead = F.coalesce(F.sum("__rows").over(Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("__task", ahead.alias("__ahead"))
    numbered = placed.withColumn("__task", task).join(F.broadcast(offsets), "__task")
    return numbered.withColumn("id", F.lit(after + 1).cast("long") + F.col("__ahead") + place).drop("__task", "__ahead", "__place")
