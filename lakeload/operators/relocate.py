"""Moving the files of finished loads."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.sources.listing import open_root


def move_action(in_source: Column, in_destination: Column) -> Column:
    """What is left to do for a file, from where it is now."""
    return (
        F.when(~in_source & in_destination, "already_copied")
        .when(~in_source, "error")
        .when(in_destination, "delete_source")
        .otherwise("copy_then_delete")
    )


def move_plan(pairs: DataFrame, source_listing: DataFrame, destination_listing: DataFrame) -> DataFrame:
    """Add ``action`` to each pair. The listings hold ``key``."""

    def marked(listing: DataFrame, name: str, mark: str) -> DataFrame:
        return listing.select(F.col("key").alias(name)).distinct().withColumn(mark, F.lit(True))

    found = pairs.join(marked(source_listing, "source_key", "__s"), "source_key", "left").join(
        marked(destination_listing, "destination_key", "__d"), "destination_key", "left"
    )
    here, there = (F.coalesce(F.col(c), F.lit(False)) for c in ("__s", "__d"))
    return found.withColumn("action", move_action(here, there)).drop("__s", "__d")


def relocate(pairs: DataFrame, source_root: str, destination_root: str, tasks: int | None = None) -> DataFrame:
    """Move every pair's file: ``id, source_key, destination_key, outcome, ok``.

    The moves are dealt over ``tasks`` (twice the cores, unless given), whatever
    partitions the pairs are in.

    Runs in the tasks. Each file is looked up again right before it is moved, so
    a task that is run twice finds its own work done. Write the result once and
    derive the statuses from what was written.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, source_base = open_root(source_root)
        target, target_base = open_root(destination_root)
        for batch in batches:
            outcomes = [
                move_one(source, f"{source_base}/{s}", target, f"{target_base}/{d}")
                for s, d in zip(batch.column("source_key").to_pylist(), batch.column("destination_key").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([o for o, _ in outcomes], pa.string()), pa.array([k for _, k in outcomes], pa.bool_())],
                names=["id", "source_key", "destination_key", "outcome", "ok"],
            )

    # an explicit number, which adaptive execution keeps
    dealt = pairs.select("id", "source_key", "destination_key").repartition(tasks or 2 * pairs.sparkSession.sparkContext.defaultParallelism, "id", "source_key")
    return dealt.mapInArrow(
        run, "id bigint, source_key string, destination_key string, outcome string, ok boolean"
    )


def move_one(source: fs.FileSystem, source_path: str, target: fs.FileSystem, target_path: str) -> tuple[str, bool]:
    def present(filesystem: fs.FileSystem, path: str) -> bool:
        return filesystem.get_file_info(path).type == fs.FileType.File

    here, there = present(source, source_path), present(target, target_path)
    if not here:
        return ("already_copied", True) if there else ("source not found", False)
    try:
        if not there:
            copy_whole(source, source_path, target, target_path)
        source.delete_file(source_path)
    except FileNotFoundError:
        return ("already_copied", True) if present(target, target_path) else ("source not found", False)
    except OSError as failure:
        return f"{type(failure).__name__}: {failure}", False
    return "delete_source" if there else "copy_then_delete", True


def copy_whole(source: fs.FileSystem, source_path: str, target: fs.FileSystem, target_path: str) -> None:
    """Copy so that the target path never shows part of a file."""
    if not isinstance(target, fs.LocalFileSystem):
        # Object stores publish an object only when it is complete.
        fs.copy_files(source_path, target_path, source_filesystem=source, destination_filesystem=target)
        return
    target.create_dir(target_path.rsplit("/", 1)[0], recursive=True)
    unfinished = f"{target_path}.unfinished"
    fs.copy_files(source_path, unfinished, source_filesystem=source, destination_filesystem=target)
    target.move(unfinished, target_path)


def move_events(outcomes: DataFrame) -> DataFrame:
    """One status event per load: ``moved`` when all its files are, else ``fail``."""
    return outcomes.groupBy(F.col("id").alias("load_id")).agg(
        F.when(F.bool_and("ok"), "moved").otherwise("fail").alias("event")
    )
