"""Taking in the landed responses of dataset feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.operators import feeds, ledger, routing
from lakeload.plans.store import LedgerStore
from lakeload.sources.feed_bodies import feed_results


def run_feed_sync(store: LedgerStore, bodies: DataFrame, layout: routing.Layout = routing.Layout()) -> DataFrame:
    """Record the datasets announced in ``bodies`` (``feed_id, arrival, body``).

    Returns what is to be fetched: ``url, landing_key`` of every valid dataset.
    The feeds' watermarks move once the datasets are recorded.
    """
    pass_id = store.next_pass()
    # Bodies are parsed once, and by all tasks: however small its file, a body can hold much.
    dealt = bodies.repartition(2 * store.spark.sparkContext.defaultParallelism, "feed_id", "arrival")
    announced = feeds.dataset_rows(feeds.valid_datasets(feed_results(dealt)))
    staged = f"{store.root}/staged/announced/pass={pass_id}"
    announced.withColumn("last_updated_at", F.col("last_updated_at").cast("timestamp")).write.mode("overwrite").parquet(staged)
    incoming = store.spark.read.parquet(staged)
    store.write("datasets", feeds.upsert_datasets(store.read("datasets", (pass_id, 0)), incoming), pass_id)
    known = store.read("feeds", (pass_id, 0))
    moved = feeds.feed_watermark(ledger.live(known), incoming)
    store.write("feeds", moved.unionByName(known.where(F.col("deleted_at").isNotNull())), pass_id)
    return incoming.select(
        "feed_id", "url", feeds.dataset_landing_key(F.col("type"), F.col("identifier"), layout).alias("landing_key")
    )
