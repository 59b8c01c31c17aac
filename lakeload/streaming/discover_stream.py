"""Continuous discovery: the listing source feeding the discovery step."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lakeload.operators.routing import Layout
from lakeload.plans.load_pass import Limits, take_in
from lakeload.plans.store import LedgerStore
from lakeload.sources.listing import stream_objects


def start_discovery(
    spark: SparkSession,
    store: LedgerStore,
    layout: Layout,
    checkpoint: str,
    trigger: dict[str, object] | None = None,
    settle_seconds: float = 2,
    limits: Limits = Limits(per_prefix=None),
    after_batch: Callable[[int], object] | None = None,
) -> StreamingQuery:
    """Record new and rewritten objects as loads, batch by batch.

    Every batch lists all objects and keeps those that the ledger does not know, so
    none is missed, whatever its time. Each batch of a stream has a pass of its own in
    the ledger, which also other streams and batch passes may use before and after it;
    a batch that is run again after a failure replaces its own rows. ``after_batch``
    gets the pass number and may run the later steps (``plans.load_pass.advance``).
    """

    def take_batch(batch: DataFrame, batch_id: int) -> None:
        # Spark gives each checkpoint an id, also when it is made anew at an old place.
        stream = spark.read.json(f"{checkpoint}/metadata").first()["id"]
        pass_id = store.pass_of_batch(stream, batch_id)
        take_in(batch, store, layout, pass_id, limits)
        if after_batch:
            after_batch(pass_id)

    return (
        stream_objects(spark, layout.incoming, settle_seconds=settle_seconds, everything=True)
        .writeStream.foreachBatch(take_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )
