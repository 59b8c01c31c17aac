"""Moving the files of finished loads to the archive or the quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.operators import ledger, relocate, routing
from lakeload.plans.store import LedgerStore

#: Waiting loads whose files are moved; a limit counts these alone.
MOVED_STATUSES = ("ready_for_archiving", "ready_for_erroring")

DISPATCHED_ARCHIVE, DISPATCHED_ERROR, MOVED, NOT_MOVED = range(11, 15)


def run_relocation_pass(
    spark: SparkSession, store: LedgerStore, layout: routing.Layout, retry: bool = False, limit: int | None = None
) -> int:
    """Dispatch waiting loads (or, with ``retry``, those whose move got stuck) and move their files."""
    pass_id = store.next_pass()
    loads = store.loads()
    chosen = ledger.stuck_loads(loads, limit) if retry else ledger.dispatch_actions(loads, limit, MOVED_STATUSES)
    chosen_path = f"{store.root}/moves/pass={pass_id}"
    chosen.write.mode("overwrite").parquet(chosen_path)
    work = spark.read.parquet(chosen_path)
    store.log(work.where("action = 'archive'"), "archiving", pass_id, DISPATCHED_ARCHIVE, "id")
    store.log(work.where("action = 'error'"), "erroring", pass_id, DISPATCHED_ERROR, "id")

    latest = ledger.latest_load_snapshot(store.read("load_snapshots"))
    archived = routing.with_latest_snapshot(work.where("action = 'archive'"), latest)
    outcome_path = f"{store.root}/outcomes/pass={pass_id}"
    _move(archived, routing.archive_root(layout), layout, layout.archive, f"{outcome_path}/kind=archive")
    _move(work.where("action = 'error'"), routing.error_root(layout), layout, layout.errors, f"{outcome_path}/kind=error")

    outcomes = spark.read.parquet(outcome_path)
    events = relocate.move_events(outcomes)
    dispatched = store.loads().select(F.col("id").alias("load_id"), "status")
    changes = ledger.accepted(ledger.transition(dispatched, events))
    for step, event in ((MOVED, "moved"), (NOT_MOVED, "fail")):
        rows = changes.where(F.col("event") == event).select(
            "load_id",
            F.col("next_status").alias("status"),
            F.current_timestamp().alias("at"),
            F.lit(pass_id * 1000 + step).cast("long").alias("seq"),
        )
        store.write("status_log", rows, pass_id, step)
    return pass_id


def _move(loads: DataFrame, root, layout: routing.Layout, target: str, path: str) -> None:
    pairs = routing.move_pairs(loads, root, layout)
    relocate.relocate(pairs, layout.incoming, target).write.mode("overwrite").parquet(path)
