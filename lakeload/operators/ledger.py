"""Reading and updating the ledger tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeload.runtime import lookup_join, row_count_within, row_salt

# Default of spark.sql.optimizer.windowGroupLimitThreshold.
PUSHED_LIMIT = 1000

# The statuses of a load.
STATUSES = (
    "archived",
    "archived_unknown",
    "archiving",
    "errored",
    "errored_unknown",
    "erroring",
    "ingesting",
    "ready",
    "ready_for_archiving",
    "ready_for_erroring",
    "ready_for_ingesting",
)

# Fixed values: (status, event) -> next status.
TRANSITIONS = {
    ("ready", "select"): "ready_for_ingesting",
    ("ready_for_ingesting", "batch"): "ingesting",
    ("ingesting", "finish"): "ready_for_archiving",
    ("ingesting", "fail"): "ready_for_erroring",
    ("ready_for_archiving", "dispatch"): "archiving",
    ("ready_for_erroring", "dispatch"): "erroring",
    ("archiving", "moved"): "archived",
    ("archived_unknown", "moved"): "archived",
    ("erroring", "moved"): "errored",
    ("errored_unknown", "moved"): "errored",
    ("archiving", "fail"): "archived_unknown",
    ("archived_unknown", "fail"): "archived_unknown",
    ("erroring", "fail"): "errored_unknown",
    ("errored_unknown", "fail"): "errored_unknown",
}

PUBLIC_FIELDS = {
    "tables": ("id", "name", "s3_prefix", "is_raw", "is_active", "deleted_at", "inserted_at", "updated_at"),
    "loads": (
        "id", "table_id", "status", "s3_key", "s3_modified", "s3_size", "is_raw",
        "deleted_at", "inserted_at", "updated_at",
    ),
    "table_snapshots": ("id", "table_id", "snapshot", "snapshot_s3_key", "deleted_at", "inserted_at", "updated_at"),
    "load_snapshots": ("id", "load_id", "snapshot", "deleted_at", "inserted_at", "updated_at"),
    "feeds": ("id", "relative_url", "last_updated_at", "deleted_at", "inserted_at", "updated_at"),
    "datasets": (
        "id", "feed_id", "type", "identifier", "start_date", "end_date", "last_updated_at",
        "deleted_at", "inserted_at", "updated_at",
    ),
}


# ---- reads ------------------------------------------------------------------
def live(ledger: DataFrame) -> DataFrame:
    """Rows that are not soft-deleted."""
    return ledger.where(F.col("deleted_at").isNull()) if "deleted_at" in ledger.columns else ledger


def find(ledger: DataFrame, **clauses: object) -> DataFrame:
    """Live rows equal to every clause; a clause of ``None`` asks for NULL."""
    rows = live(ledger)
    for name, value in clauses.items():
        rows = rows.where(F.col(name).isNull() if value is None else F.col(name) == F.lit(value))
    return rows


def find_one(ledger: DataFrame, **clauses: object) -> DataFrame:
    """Like :func:`find`, but running it is an error when there is no row or more than one.

    The plan counts the rows beside finding them; nothing runs before the result does.
    """
    rows = find(ledger, **clauses)
    found = rows.agg(F.count("*").alias("__found"))
    said = F.concat(F.lit(f"expected one row for {clauses}, found "), F.col("__found").cast("string"))
    checked = found.select(F.when(F.col("__found") == 1, True).otherwise(F.raise_error(said).cast("boolean")).alias("__one"))
    # The count leads the join, which keeps its one row also where nothing was found.
    first = rows.limit(2).withColumn("__hit", F.lit(True))
    return checked.join(F.broadcast(first), F.col("__hit"), "left").where("__one").select(*ledger.columns)


def active_tables(tables: DataFrame) -> DataFrame:
    """Tables that take part in discovery; NULL for ``is_active`` means no."""
    return live(tables).where(F.col("is_active"))


def loads_by_status(loads: DataFrame, statuses: Sequence[str], limit: int | None = None) -> DataFrame:
    """Live loads in one of ``statuses``, the oldest ids first when limited."""
    rows = live(loads).where(F.col("status").isin(*statuses)) if statuses else loads.where(F.lit(False))
    return rows if limit is None else rows.orderBy("id").limit(limit)


def loads_with_table(loads: DataFrame, tables: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Live loads (of the given ids) with ``table_name``; deleted tables are not left out."""
    rows = live(loads)
    if ids is not None:
        rows = rows.join(ids.select("id").distinct(), "id", "left_semi")
    names = tables.select(F.col("id").alias("table_id"), F.col("name").alias("table_name"))
    return lookup_join(rows, names, "table_id", "inner", bounded_by=tables)


def tables_with_snapshot(tables: DataFrame, table_snapshots: DataFrame) -> DataFrame:
    """Live tables with their snapshot row, if they have one; snapshot rows are not filtered."""
    snapshots = table_snapshots.select("table_id", "snapshot_s3_key", "snapshot")
    joined = lookup_join(
        live(tables).withColumn("table_id", F.col("id")), snapshots, "table_id", "left", bounded_by=table_snapshots, one_each=True
    )
    return joined.drop("table_id").orderBy("id")


def latest_load_snapshot(load_snapshots: DataFrame) -> DataFrame:
    """Per load, the snapshot of its youngest row (by ``inserted_at``, then ``id``)."""
    youngest = F.max_by("snapshot", F.struct("inserted_at", "id"))
    return live(load_snapshots).groupBy("load_id").agg(youngest.alias("snapshot"))


def latest_snapshot_load(loads: DataFrame, table_snapshots: DataFrame, few: bool | None = None) -> DataFrame:
    """Per snapshot key, when it was last loaded: any status, any table, matched by key only."""
    keys = table_snapshots.select(F.col("snapshot_s3_key").alias("s3_key")).distinct()
    snapshot_loads = lookup_join(live(loads).select("s3_key", "s3_modified"), keys, "s3_key", "inner", bounded_by=table_snapshots if few is None else few)
    return snapshot_loads.groupBy("s3_key").agg(F.max("s3_modified").alias("last_snapshot_at"))


def ready_loads(
    loads: DataFrame, tables: DataFrame, table_snapshots: DataFrame, per_table: int | None = None
) -> DataFrame:
    """Ready loads of live tables; with ``per_table``, so many of each at most, oldest first.

    A table with a snapshot row contributes loads at or after the last load of
    its snapshot file, and nothing while that file was never loaded. The limit
    is applied on the map side first, so a hot table sends no more than
    ``per_table`` rows per task through the shuffle.
    """
    few = row_count_within(table_snapshots)
    restarts = lookup_join(
        table_snapshots.select("table_id", F.col("snapshot_s3_key").alias("s3_key")),
        latest_snapshot_load(loads, table_snapshots, few),
        "s3_key",
        "left",
        bounded_by=few,
        one_each=True,
    ).select("table_id", "last_snapshot_at", F.lit(True).alias("has_snapshots"))
    sources = lookup_join(
        live(tables).select(F.col("id").alias("table_id"), F.col("name").alias("table_name")),
        restarts,
        "table_id",
        "left",
        bounded_by=few,
        one_each=True,
    )
    candidates = lookup_join(
        live(loads).where(F.col("status") == "ready"), sources, "table_id", "inner", bounded_by=tables
    ).where(F.col("has_snapshots").isNull() | (F.col("s3_modified") >= F.col("last_snapshot_at")))
    kept = candidates.drop("has_snapshots", "last_snapshot_at")
    return kept if per_table is None else first_per_group(kept, ["table_id"], ["s3_modified", "s3_key", "id"], per_table)


def first_per_group(df: DataFrame, by: Sequence[str], order: Sequence[str], count: int) -> DataFrame:
    """The first ``count`` rows of each group, whatever the group's size.

    Up to ``PUSHED_LIMIT`` Spark cuts every group on the map side by itself.
    Above it the groups are cut in salted parts first, so that the final ranking
    sees at most ``SALTS * count`` rows of a group.
    """
    if count > PUSHED_LIMIT:
        parts = _ranked(df.withColumn("__part", row_salt(df)), [*by, "__part"], order, count)
        return _ranked(parts.drop("__part"), by, order, count)
    return _ranked(df, by, order, count)


def _ranked(df: DataFrame, by: Sequence[str], order: Sequence[str], count: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") <= count).drop("__rank")


# ---- updates ----------------------------------------------------------------
def update_many(loads: DataFrame, ids: DataFrame, **changes: object) -> DataFrame:
    """The ledger with ``changes`` set on the live loads of the given ids."""
    marks = ids.select("id").distinct().withColumn("__hit", F.lit(True))
    hit = F.col("__hit") & F.col("deleted_at").isNull()
    updated = {name: F.when(hit, F.lit(value)).otherwise(F.col(name)) for name, value in changes.items()}
    return loads.join(marks, "id", "left").withColumns(updated).drop("__hit")


def changed_rows(loads: DataFrame, ids: DataFrame, **changes: object) -> DataFrame:
    """Only the rows that :func:`update_many` changes, as they are afterwards."""
    hit = live(loads).join(ids.select("id").distinct(), "id", "left_semi")
    return hit.withColumns({name: F.lit(value) for name, value in changes.items()})


def next_status(status: Column, event: Column) -> Column:
    """Status after an event, NULL where the event does not apply."""
    rules = F.create_map(*[x for (s, e), to in TRANSITIONS.items() for x in (F.lit(f"{s}|{e}"), F.lit(to))])
    return F.try_element_at(rules, F.concat_ws("|", status, event))


def transition(current: DataFrame, events: DataFrame) -> DataFrame:
    """Apply at most one event per load: ``load_id, status, event, next_status``.

    Events that do not apply have NULL for ``next_status``; split them off with
    :func:`accepted` and :func:`rejected`.
    """
    joined = current.select("load_id", "status").join(events.select("load_id", "event"), "load_id")
    return joined.withColumn("next_status", next_status(F.col("status"), F.col("event")))


def accepted(transitions: DataFrame) -> DataFrame:
    return transitions.where(F.col("next_status").isNotNull())


def rejected(transitions: DataFrame) -> DataFrame:
    return transitions.where(F.col("next_status").isNull())


def current_status(status_log: DataFrame) -> DataFrame:
    """Last status of each load in an append-only log ``load_id, status, at, seq``."""
    return status_log.groupBy("load_id").agg(F.max_by("status", F.struct("at", "seq")).alias("status"))


DISPATCHED = ("ready_for_archiving", "ready_for_erroring", "ready_for_ingesting")


def dispatch_actions(loads: DataFrame, limit: int | None = None, statuses: Sequence[str] = DISPATCHED) -> DataFrame:
    """What to do next with each load that waits for dispatch."""
    waiting = loads_by_status(loads, statuses, limit)
    action = (
        F.when(F.col("status") == "ready_for_ingesting", "ingest")
        .when(F.col("status") == "ready_for_archiving", "archive")
        .otherwise("error")
    )
    return waiting.withColumn("action", action)


def stuck_loads(loads: DataFrame, limit: int | None = None) -> DataFrame:
    """Loads whose move did not finish, with the move to run again."""
    stuck = loads_by_status(loads, ["archiving", "archived_unknown", "erroring", "errored_unknown"], limit)
    action = F.when(F.col("status").isin("archiving", "archived_unknown"), "archive").otherwise("error")
    return stuck.withColumn("action", action)


# ---- registration -----------------------------------------------------------
def register_tables(tables: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates (``name, s3_prefix``) whose name is new, with the key of their snapshot file."""
    first_file = F.concat("s3_prefix", F.lit("LOAD00000001.csv.gz"))
    return candidates.join(tables.select("name"), "name", "left_anti").withColumn("snapshot_s3_key", first_file)


def ledger_json(ledger: DataFrame, kind: str, alias: str = "json") -> DataFrame:
    """Each row as JSON text of the ledger's public fields; NULL fields are written too."""
    fields: Mapping[str, None] = dict.fromkeys(f for f in PUBLIC_FIELDS[kind] if f in ledger.columns)
    return ledger.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias(alias))
