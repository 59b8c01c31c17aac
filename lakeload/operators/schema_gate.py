"""Which replicated loads may be read at all: their sidecar must name the columns of the catalog, in order."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.operators import routing
from lakeload.sources import catalog, manifest
from lakeload.sources.listing import open_root


def fetch_sidecars(loads: DataFrame, root: str, tasks: int | None = None) -> DataFrame:
    """``sidecar_key, body`` of the sidecars that lie beside the loads' objects below ``root``.

    The files are read in ``tasks`` tasks (twice the cores, unless given), one row at a
    time: neither paths nor bodies pass the driver. A sidecar that is not there has no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = open_root(root)
        for batch in batches:
            for key in batch.column(0).to_pylist():
                try:
                    with filesystem.open_input_stream(f"{base}/{key}") as file:
                        body = file.read().decode(errors="replace")
                except FileNotFoundError:
                    continue
                yield pa.RecordBatch.from_arrays([pa.array([key], pa.string()), pa.array([body], pa.string())], names=["sidecar_key", "body"])

    keys = loads.select(manifest.sidecar_key(F.col("s3_key")).alias("sidecar_key")).where("sidecar_key is not null").distinct()
    dealt = keys.repartition(tasks or 2 * keys.sparkSession.sparkContext.defaultParallelism, "sidecar_key")
    return dealt.mapInArrow(run, "sidecar_key string, body string")


def checked_loads(named: DataFrame, registry: DataFrame, layout: routing.Layout = routing.Layout()) -> DataFrame:
    """Replicated loads with ``columns_match``, and what either side lacks.

    ``named`` holds ``id, s3_key, table_name``. A sidecar that is missing, or is no
    JSON document, has no columns. No data object is opened.
    """
    replicated = named.where(routing.is_replicated(F.col("s3_key"), layout)).select("id", "s3_key", "table_name")
    sidecars = fetch_sidecars(replicated, layout.incoming)
    with_manifest = manifest.load_manifest_columns(replicated, sidecars, mode="PERMISSIVE")
    return manifest.schema_check(catalog.load_catalog_columns(with_manifest, registry))


def mismatched(named: DataFrame, registry: DataFrame, layout: routing.Layout = routing.Layout()) -> DataFrame:
    """Ids of the replicated loads that the gate holds back."""
    return checked_loads(named, registry, layout).where(~F.col("columns_match")).select("id")
