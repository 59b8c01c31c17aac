"""Sidecar schema files: JSON documents beside the data objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.functions.paths import DATA_SUFFIX, SIDECAR_SUFFIX, swap_suffix
from lakeload.schemas import SIDECAR

# What the column list needs of a sidecar; the parser skips everything else.
COLUMN_NAMES = "dataInfo struct<columns: array<struct<name: string>>>"


def read_sidecars(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``path, body`` of sidecar files; each file is one document."""
    return spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))


def parsed_sidecars(sidecars: DataFrame, body: str = "body") -> DataFrame:
    """Add ``sidecar``: the whole document as a struct."""
    return sidecars.withColumn("sidecar", F.from_json(F.col(body), SIDECAR, {"mode": "FAILFAST"}))


def sidecar_columns(sidecars: DataFrame, body: str = "body", mode: str = "FAILFAST") -> DataFrame:
    """Add ``columns``: the lower-cased column names of each sidecar, in document order.

    A body that is no JSON document fails the job, or has NULL with ``mode`` ``PERMISSIVE``.
    """
    parsed = F.from_json(F.col(body), COLUMN_NAMES, {"mode": mode})
    names = F.transform(parsed["dataInfo"]["columns"], lambda c: F.lower(c["name"]))
    return sidecars.withColumn("columns", names)


def sidecar_key(key):
    """Key of the sidecar that belongs to a data object."""
    return F.concat(swap_suffix(key, DATA_SUFFIX, ""), F.lit(SIDECAR_SUFFIX))


def load_manifest_columns(loads: DataFrame, sidecars: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """Each load with its sidecar's column names; an empty list where no sidecar landed.

    ``sidecars`` holds ``sidecar_key, body``, one row per key. Should one object
    have been loaded very often, adaptive execution splits its partition: no
    step after the join needs the rows of a key together. The sidecars are never
    broadcast: there is about one for each load, however small their files are.
    """
    found = sidecar_columns(sidecars, mode=mode).select("sidecar_key", F.col("columns").alias("found_columns"))
    return (
        loads.withColumn("sidecar_key", sidecar_key(F.col("s3_key")))
        .join(found.hint("merge"), "sidecar_key", "left")
        .withColumn("manifest_columns", F.coalesce("found_columns", F.array().cast("array<string>")))
        .drop("found_columns", "sidecar_key")
    )


def schema_check(loads: DataFrame, manifest: str = "manifest_columns", catalog: str = "catalog_columns") -> DataFrame:
    """Compare the two column lists of each load: missing on either side, and equal in order."""
    known = F.coalesce(F.col(catalog), F.array().cast("array<string>"))
    return loads.withColumns(
        {
            "not_in_catalog": F.array_except(F.col(manifest), known),
            "not_in_manifest": F.array_except(known, F.col(manifest)),
            "columns_match": F.col(manifest) == known,
        }
    )
