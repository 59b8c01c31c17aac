"""A watermark per table, kept in Spark's state store.

A table's objects may be most of a batch, so they are spread over ``salts`` groups,
each with a copy of the table's watermark in its state. Before the shuffle every task
reduces its objects to one newest second per table and sends this to all copies:
whatever a group holds, its watermark becomes that of the whole table.

There may be very many tables with few objects each, and a group costs milliseconds
whatever it holds. So a group holds a bucket of tables, and its state their watermarks;
with the default a bucket of a million tables' stream has about four thousand.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SALTS = 8

#: Groups of tables with a common row of state. A checkpoint keeps the number it was made with.
BUCKETS = 256

#: Columns of an object are carried as text, which keeps every value as it is.
PACKED = "table_id string, bucket int, salt int, second long, packed array<string>"
STATE = "tables array<string>, seconds array<long>"


def with_news(salts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's objects, then its newest second of each table, once for every salt."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        newest: dict[str, int] = {}
        buckets: dict[str, int] = {}
        schema = None
        for batch in batches:
            schema = batch.schema
            found = pa.Table.from_batches([batch]).group_by("table_id").aggregate([("second", "max"), ("bucket", "max")])
            for table_id, second, bucket in zip(*(found[c].to_pylist() for c in ("table_id", "second_max", "bucket_max")), strict=True):
                if table_id is not None and second is not None:
                    newest[table_id], buckets[table_id] = max(newest.get(table_id, second), second), bucket
            yield batch
        if newest:
            n = len(newest)
            for salt in range(salts):
                columns = [list(newest), [buckets[t] for t in newest], [salt] * n, list(newest.values()), [None] * n]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def newer_objects(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Objects after the watermark that their table had before this batch; then the watermarks move."""
    before = pd.Series(state.get[1], index=state.get[0], dtype="float64") if state.exists else pd.Series(dtype="float64")
    newest = [before]
    for part in parts:
        objects = part[part["packed"].notna()]
        known = objects["table_id"].map(before)
        # a null table is none of the index; a null time is never newer than a watermark
        passed = objects[known.isna() | (objects["second"] > known)]
        if len(passed):
            yield passed[["packed"]]
        newest.append(part[part["table_id"].notna() & part["second"].notna()].groupby("table_id")["second"].max().astype("float64"))
    moved = pd.concat([s for s in newest if len(s)] or [before])
    if len(moved):
        moved = moved.groupby(level=0).max()
        state.update((moved.index.tolist(), [int(s) for s in moved]))


def newer_than_watermark(objects: DataFrame, salts: int = SALTS) -> DataFrame:
    """The objects (``table_id, key, last_modified, …``) of a stream newer than their table's watermark.

    The comparison is strict, in whole seconds, with the watermark before the batch.
    What is not newer is dropped for good. A table not met before takes everything;
    objects of no table (null) have no watermark and always pass, objects without a
    time pass while their table has none.
    """
    plain = {f.name: f.dataType for f in objects.schema.fields}
    odd = [name for name, kind in plain.items() if kind.typeName() in ("array", "map", "struct", "variant")]
    if odd:
        raise ValueError(f"columns of the listing must be plain: {odd}")
    packed = objects.select(
        F.col("table_id").cast("string").alias("table_id"),
        F.coalesce(F.pmod(F.xxhash64(F.col("table_id").cast("string")), F.lit(BUCKETS)), F.lit(0)).cast("int").alias("bucket"),
        F.pmod(F.xxhash64("key", "last_modified"), F.lit(salts)).cast("int").alias("salt"),
        F.unix_seconds(F.col("last_modified").cast("timestamp")).alias("second"),
        F.array(*[F.col(f"`{name}`").cast("string") for name in plain]).alias("packed"),
    )
    told = packed.mapInArrow(with_news(salts), PACKED)
    passed = told.groupBy("bucket", "salt").applyInPandasWithState(newer_objects, "packed array<string>", STATE, "append", GroupStateTimeout.NoTimeout)
    return passed.select(*[F.col("packed")[i].cast(kind).alias(name) for i, (name, kind) in enumerate(plain.items())])


def start_watermark_filter(
    objects: DataFrame, output: str, checkpoint: str, trigger: dict[str, object] | None = None, salts: int = SALTS
) -> StreamingQuery:
    """Write the objects that are newer than their table's watermark to ``output``.

    The watermarks live in the state store of the checkpoint and survive restarts;
    the file sink writes each batch once, also if it is run again.
    """
    return (
        newer_than_watermark(objects, salts)
        .writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )
