"""Session settings and written intermediate tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.runtime import new_run_dir, tune

#: Ids that are sent to every task to pick their texts (24 MB there); more are joined by a shuffle.
SENT_IDS = 1_000_000

#: Rows of one Arrow batch. Texts can be very long, so batches are kept short.
ARROW_ROWS = 256

#: What operators hold in a Python worker between its tasks.
WORKER_CACHES: list = []


def worker_cache(make: Callable) -> Callable:
    """``make``, whose last value stays in the Python worker until :func:`free_worker` drops it."""
    cached = lru_cache(maxsize=1)(make)
    WORKER_CACHES.append(cached)
    return cached


def free_worker(*used: Callable) -> None:
    """At the start of a task: give back what earlier tasks hold in this Python worker, but for the caches ``used``.

    Spark keeps its Python workers for all stages of a session, so a vocabulary and
    its words would stay beside every later stage's memory.
    """
    for cached in WORKER_CACHES:
        if cached not in used:
            cached.cache_clear()
    pa.default_memory_pool().release_unused()


def prepare(spark: SparkSession) -> SparkSession:
    """The library's settings, and Arrow batches short enough for long texts."""
    tune(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: its lineage ends there and it is computed once.

    Such tables outlive a lost executor and are read back by every later step
    in the same form, whatever order its rows were computed in.
    """
    spark = df.sparkSession
    path = new_run_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_ids(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """``docs`` semi- or anti-joined with the distinct ``ids``; they are broadcast only if counted and few."""
    few = ids.limit(SENT_IDS + 1).count() <= SENT_IDS
    keys = ids.toDF("only_id")
    return docs.join(F.broadcast(keys) if few else keys, docs["doc_id"].cast("long") == keys["only_id"], how)


def few(df: DataFrame) -> DataFrame:
    """``df`` (cheap to count), marked for broadcast if it was counted and has at most a quarter of SENT_IDS rows."""
    return F.broadcast(df) if df.limit(SENT_IDS // 4 + 1).count() <= SENT_IDS // 4 else df
