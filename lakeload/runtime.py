"""Session settings, scratch space and size-checked joins."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup side is broadcast only when it (or the registry that bounds it) was
# counted and holds at most this many rows; a few hundred bytes per row keeps
# the hash relation near 10 MB.
BROADCAST_ROWS = 50_000

# Copies of the lookup side when it is too large to broadcast. A key holding a
# third of the big side is then spread over this many reducers.
SALTS = 32

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # A generated method above this size is never compiled by the JVM. Casting a
    # wide table would be interpreted; below the limit Spark splits it instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the operators are written for."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    # Spark lists many paths by a task each, up to 10,000: a task takes longer than a listing.
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(4 * spark.sparkContext.defaultParallelism))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named in ``spark.checkpoint.dir``.

    Only where the session names none (tests on one machine) a temporary folder
    is made and remembered in the session.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("lakeload.shared.dir", None)
    if not named:
        master = spark.conf.get("spark.master", "local")
        if not re.match(r"local($|\[)", master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="lakeload-")
        spark.conf.set("lakeload.shared.dir", named)
    return named.rstrip("/")


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below :func:`shared_dir`."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def row_count_within(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """True when ``df`` holds at most ``limit`` rows; reads no more than it must."""
    return df.limit(limit + 1).count() <= limit


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    on: str | list[str],
    how: str = "left",
    bounded_by: DataFrame | bool | None = None,
    one_each: bool = False,
) -> DataFrame:
    """Join ``big`` to ``lookup``, which holds at most one row per key.

    ``bounded_by`` is a cheap relation with at least as many rows as ``lookup``
    (the registry its keys come from), or the outcome of an earlier
    :func:`row_count_within` on it. If counting it shows that the lookup is
    small, the lookup is broadcast and ``big`` is not shuffled. Otherwise the
    lookup is copied ``SALTS`` times and ``big`` is spread over the copies, so
    that no key of ``big`` ends up whole in one reducer. With ``one_each``, ``big``
    holds about one row per key as well, and nothing is copied.

    A lookup that was not found to be small is never broadcast: the planner takes its
    size from compressed files, and knows nothing of the copies.
    """
    keys = [on] if isinstance(on, str) else list(on)
    small = bounded_by if isinstance(bounded_by, bool) else bounded_by is not None and row_count_within(bounded_by)
    if small:
        return big.join(F.broadcast(lookup), keys, how)
    if one_each:
        return big.join(lookup.hint("merge"), keys, how)
    salt = "__salt"
    spread = big.withColumn(salt, row_salt(big))
    copies = lookup.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return spread.join(copies.hint("merge"), [*keys, salt], how).drop(salt)


def row_salt(df: DataFrame) -> Column:
    """A number below ``SALTS`` from a hash of the row.

    Not a random number: a recomputed task must send each row to the reducer it
    was sent to before.
    """
    hashable = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    return F.pmod(F.xxhash64(*[F.col(f"`{name}`") for name in hashable]), F.lit(SALTS)).cast("int")
