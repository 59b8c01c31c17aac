"""Dataset feeds: announced datasets, watermarks and requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.functions.checks import has_keys, parse_iso_extended, valid_iso_date, valid_iso_datetime, valid_url
from lakeload.functions.times import next_microsecond
from lakeload.operators.routing import Layout
from lakeload.runtime import lookup_join

# What an announced dataset must carry.
DATASET_KEYS = ("id", "dataset_id", "start_date", "end_date", "last_updated", "url")

# How a feed's relative url starts, by access class.
ACCESS_PREFIXES = {"controlled": "/datasetcontrolleduserapi", "public": "/datasetpublicusersapi"}


def is_valid_dataset(dataset: Column) -> Column:
    return (
        has_keys(dataset, DATASET_KEYS)
        & valid_iso_date(_entry(dataset, "start_date"))
        & valid_iso_date(_entry(dataset, "end_date"))
        & valid_iso_datetime(_entry(dataset, "last_updated"))
        & valid_url(_entry(dataset, "url"))
    )


def _entry(dataset: Column, key: str) -> Column:
    return F.try_element_at(dataset, F.lit(key))


def valid_datasets(results: DataFrame) -> DataFrame:
    """Announced datasets (``dataset`` map) that are complete and well-formed."""
    return results.where(is_valid_dataset(F.col("dataset")))


def dataset_rows(datasets: DataFrame) -> DataFrame:
    """The ledger columns of valid datasets, and the ``url`` to fetch each from."""
    entry = lambda key: _entry(F.col("dataset"), key)
    return datasets.select(
        *[c for c in datasets.columns if c != "dataset"],
        entry("id").alias("type"),
        entry("dataset_id").alias("identifier"),
        entry("start_date").try_cast("date").alias("start_date"),
        entry("end_date").try_cast("date").alias("end_date"),
        parse_iso_extended(entry("last_updated")).alias("last_updated_at"),
        entry("url").alias("url"),
    )


def upsert_datasets(stored: DataFrame, incoming: DataFrame, arrival: str = "arrival") -> DataFrame:
    """The dataset table after a batch: new identifiers are added, known ones get only a new ``last_updated_at``.

    An identifier that occurs several times in the batch keeps the first
    occurrence's other columns and the last one's ``last_updated_at``. Occurrences
    are ordered by arrival, then by their ``position`` inside a body if there is such
    a column. The batch is reduced to one row per identifier before the join.
    """
    others = ["feed_id", "type", "start_date", "end_date"]
    order = F.struct(arrival, *[c for c in ("position",) if c in incoming.columns])
    batch = incoming.groupBy("identifier").agg(
        F.min_by(F.struct(*others), order).alias("__first"),
        F.max_by("last_updated_at", order).alias("__last"),
    )
    # Columns that only the ledger knows (ids, deletion, times of its rows) stay as they are.
    merged = stored.withColumn("__stored", F.lit(True)).join(batch, "identifier", "full_outer")
    known = F.col("__stored").isNotNull()
    chosen = {c: F.when(known, F.col(c)).otherwise(F.col(f"__first.{c}")) for c in others}
    chosen["last_updated_at"] = F.coalesce("__last", "last_updated_at")
    return merged.select(*[chosen.get(c, F.col(c)).alias(c) for c in stored.columns])


def feed_watermark(feeds: DataFrame, datasets: DataFrame, may_go_back: bool = False) -> DataFrame:
    """Feeds with ``last_updated_at`` moved to their newest dataset.

    Feeds without datasets are unchanged. A watermark only moves forward unless
    ``may_go_back`` is set (a repeated fetch from an older moment).
    """
    newest = datasets.groupBy(F.col("feed_id").alias("id")).agg(F.max("last_updated_at").alias("__newest"))
    # greatest skips NULLs
    moved = F.coalesce("__newest", "last_updated_at") if may_go_back else F.greatest("last_updated_at", "__newest")
    joined = lookup_join(feeds, newest, "id", "left", bounded_by=feeds, one_each=True)
    return joined.withColumn("last_updated_at", moved).drop("__newest")


def access_class(relative_url: Column) -> Column:
    """Which credential a feed needs; an unknown kind of feed fails the job."""
    chosen = F.lit(None).cast("string")
    for name, start in ACCESS_PREFIXES.items():
        chosen = F.when(relative_url.startswith(start), name).otherwise(chosen)
    return F.coalesce(chosen, F.raise_error(F.concat(F.lit("no credential for feed "), relative_url)).cast("string"))


def feed_requests(feeds: DataFrame, base_url: str = "", override: Column | None = None) -> DataFrame:
    """What to ask each feed for: ``access_class, request_url, last_updated``.

    ``last_updated`` is the override (extended ISO text) if there is one, else
    the microsecond behind the watermark, else NULL. The credential is added by
    the client that sends the request.
    """
    after = next_microsecond(F.col("last_updated_at").cast("timestamp_ntz"))
    since = after if override is None else F.coalesce(parse_iso_extended(override), after)
    return feeds.withColumns(
        {
            "access_class": access_class(F.col("relative_url")),
            "request_url": F.concat(F.lit(base_url), F.col("relative_url")),
            "last_updated": F.date_format(since, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        }
    )


def dataset_landing_key(kind: Column, identifier: Column, layout: Layout = Layout()) -> Column:
    """Key under which a dataset's file lands."""
    return F.concat(F.lit(layout.dataset_prefix), kind, F.lit("/"), identifier, F.lit(".csv.gz"))


def remap_feed_urls(feeds: DataFrame, mapping: DataFrame) -> DataFrame:
    """Feeds renamed by ``old_relative_url -> new_relative_url``; others are unchanged."""
    names = mapping.select(F.col("old_relative_url").alias("relative_url"), "new_relative_url")
    joined = lookup_join(feeds, names, "relative_url", "left", bounded_by=mapping, one_each=True)
    return joined.withColumn("relative_url", F.coalesce("new_relative_url", "relative_url")).drop("new_relative_url")
