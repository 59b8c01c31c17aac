"""New tables and feeds for the registry: each name, prefix and address once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The file that starts a table's snapshot.
FIRST_FILE = "LOAD00000001.csv.gz"


def judged_tables(tables: DataFrame, candidates: DataFrame) -> DataFrame:
    """Distinct candidates (``name, s3_prefix, is_raw``) with the ``reason`` against them, NULL for those that can be registered.

    ``known``: the name is in the registry, deleted tables included; ``taken``: another
    table has the prefix; ``ambiguous``: the batch itself gives the name or the prefix
    to several tables, none of which is taken. Candidates that repeat whole are one.
    A candidate without name or prefix is ``incomplete``.
    """
    batch = candidates.select("name", "s3_prefix", F.coalesce("is_raw", F.lit(False)).alias("is_raw")).distinct()
    names = tables.select("name").distinct().withColumn("__known", F.lit(True))
    prefixes = tables.select("s3_prefix").distinct().withColumn("__taken", F.lit(True))
    twins = [F.count("*").over(Window.partitionBy(c)) for c in ("name", "s3_prefix")]
    reason = (
        F.when(F.col("name").isNull() | F.col("s3_prefix").isNull(), "incomplete")
        .when(F.col("__known"), "known")
        .when(F.col("__taken"), "taken")
        .when((F.col("__names") > 1) | (F.col("__prefixes") > 1), "ambiguous")
    )
    counted = batch.withColumns(dict(zip(("__names", "__prefixes"), twins, strict=True)))
    found = counted.join(names, "name", "left").join(prefixes, "s3_prefix", "left")
    return found.select("name", "s3_prefix", "is_raw", reason.alias("reason"))


def accepted_tables(judged: DataFrame) -> DataFrame:
    """Ledger rows (without ids) of the candidates that nothing speaks against; new tables are active."""
    return judged.where("reason is null").select("name", "s3_prefix", "is_raw", F.lit(True).alias("is_active"))


def first_snapshots(registered: DataFrame, layout_prefix: str = "ods/") -> DataFrame:
    """Snapshot rows of registered replicated tables (``id, s3_prefix``): the snapshot itself is not known yet."""
    replicated = registered.where(F.col("s3_prefix").startswith(layout_prefix))
    return replicated.select(F.col("id").alias("table_id"), F.concat("s3_prefix", F.lit(FIRST_FILE)).alias("snapshot_s3_key"))


def new_feeds(feeds: DataFrame, candidates: DataFrame) -> DataFrame:
    """Addresses (``relative_url``) that no feed has yet, each once."""
    fresh = candidates.select("relative_url").where("relative_url is not null").distinct()
    return fresh.join(feeds.select("relative_url"), "relative_url", "left_anti")
