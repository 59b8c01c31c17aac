"""Writing cast rows to the lake as partitioned Parquet."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.sources.listing import open_root


def with_partition_literals(df: DataFrame, partition_columns: Sequence[tuple[str, str]]) -> DataFrame:
    """Append constant partition columns in the given order."""
    return df.select("*", *[F.lit(value).alias(name) for name, value in partition_columns])


def land(
    df: DataFrame,
    destination: str,
    partition_by: Sequence[str] = (),
    rebalance: bool = False,
    max_records_per_file: int | None = None,
    expected: Sequence[Sequence[str | None]] | None = None,
) -> None:
    """Write Parquet, replacing exactly the partitions that occur in ``df``.

    ``expected`` names the partitions that ``df`` is the whole content of, as values
    in the order of ``partition_by``: those that have no rows any more are emptied
    afterwards. It is as long as the list of loads of one write.

    Without partition columns the whole destination is replaced. The default
    adds no shuffle: a gzipped file is read by one task and belongs to one
    partition, so the scan tasks write the final files. ``rebalance`` evens out
    many small inputs instead; it spreads a hot partition over several tasks
    rather than gathering it in one.
    """
    out = df.hint("rebalance", *partition_by) if rebalance and partition_by else df
    writer = (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
    )
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(destination)
    if expected:
        empty_partitions(df.sparkSession, destination, partition_by, without_rows(df, partition_by, expected))


def stage_loads(df: DataFrame, staging: str, load_column: str, bad_column: str) -> dict[int, tuple[bool, list[str]]]:
    """Write the rows of many loads in one job, each load to folders of its own below ``staging``.

    Returns, for each load with rows, whether one of them has ``bad_column`` true, and its
    folders; what was written of a load with a bad row is of no use. The other columns are
    written. No shuffle and no sort: rows of a load that are neighbours share a file. A
    task that is run again writes to another folder, and only what it returned counts.
    """
    kept = df.drop(load_column, bad_column)
    spark_keys = {"org.apache.spark.version": df.sparkSession.version, "org.apache.spark.sql.parquet.row.metadata": kept.schema.json()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = open_root(staging)
        attempt = uuid.uuid4().hex
        found: dict[int, bool] = {}
        piece = None
        for batch in batches:
            loads, bads = (batch.column(c).to_numpy(zero_copy_only=False) for c in (load_column, bad_column))
            rows = pa.Table.from_batches([batch]).drop_columns([load_column, bad_column]).replace_schema_metadata(spark_keys)
            starts = np.flatnonzero(np.concatenate([[True], loads[1:] != loads[:-1]])) if len(loads) else np.zeros(0, np.int64)
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(loads)]):
                load = int(loads[start])
                if piece is not None and piece.load != load:
                    piece.close()
                    piece = None
                found[load] = found.get(load, False) or bool(bads[start:end].any())
                if not found[load]:
                    piece = piece or StagedFile(filesystem, f"{base}/{attempt}/load={load}", load)
                    piece.add(rows.slice(start, end - start))
        if piece is not None:
            piece.close()
        folders = [f"{staging}/{attempt}/load={load}" for load in found]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(found.values(), pa.bool_()), pa.array(folders, pa.string())], names=["load", "bad", "folder"])

    staged: dict[int, tuple[bool, list[str]]] = {}
    for row in df.mapInArrow(run, "load bigint, bad boolean, folder string").collect():
        bad, folders = staged.get(row["load"], (False, []))
        staged[row["load"]] = (bad or row["bad"], [*folders, row["folder"]])
    return staged


class StagedFile:
    """Rows of one load on their way to a new file in ``folder``, ``ROW_GROUP_BYTES`` in memory at most."""

    ROW_GROUP_BYTES = 64_000_000

    def __init__(self, filesystem: fs.FileSystem, folder: str, load: int) -> None:
        self.filesystem, self.folder, self.load = filesystem, folder, load
        self.waiting: list[pa.Table] = []
        self.held, self.out, self.writer = 0, None, None

    def add(self, rows: pa.Table) -> None:
        self.waiting.append(rows)
        self.held += rows.nbytes
        if self.held > self.ROW_GROUP_BYTES:
            self.write()

    def write(self) -> None:
        rows = pa.concat_tables(self.waiting)
        if self.writer is None:
            if isinstance(self.filesystem, fs.LocalFileSystem):
                self.filesystem.create_dir(self.folder, recursive=True)
            self.out = self.filesystem.open_output_stream(f"{self.folder}/part-{uuid.uuid4().hex}.zstd.parquet", compression=None)
            self.writer = pq.ParquetWriter(self.out, rows.schema, compression="zstd", store_schema=False)
        self.writer.write_table(rows, row_group_size=max(rows.num_rows, 1))
        self.waiting, self.held = [], 0

    def close(self) -> None:
        if self.waiting:
            self.write()
        if self.writer is not None:
            self.writer.close()
            self.out.close()


def place_loads(spark: SparkSession, partitions: Sequence[tuple[str, Sequence[str]]], tasks: int | None = None) -> None:
    """Replace partition folders by staged ones: ``(folder, its staged folders)``; one without any is emptied.

    The moves are dealt over ``tasks`` tasks (twice the cores, unless given).
    """
    known = spark.createDataFrame([(at, list(staged)) for at, staged in partitions], "at string, staged array<string>")
    dealt = known.repartition(min(len(partitions), tasks or 2 * spark.sparkContext.defaultParallelism) or 1, "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, staged in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                place(staged, at)
            yield batch

    dealt.mapInArrow(run, dealt.schema).write.format("noop").mode("overwrite").save()


def place(staged: Sequence[str], at: str) -> None:
    """Move staged folders of files to the folder ``at``, for what is there; without any, the folder is deleted.

    Can be run again after it failed half-way: a folder is renamed at once, and where
    that is not possible its files are copied and the staged ones stay.
    """
    target, path = open_root(at)
    there = lambda folder: target.get_file_info(folder).type == fs.FileType.Directory

    def emptied() -> None:
        if there(path):
            target.delete_dir(path)

    if not staged:
        emptied()
    elif isinstance(target, fs.LocalFileSystem):
        first, *others = (open_root(folder)[1] for folder in staged)
        for other in others:
            for info in target.get_file_info(fs.FileSelector(other, allow_not_found=True)):
                target.move(info.path, f"{first}/{info.base_name}")
        if there(first):
            target.create_dir(path.rsplit("/", 1)[0], recursive=True)
            emptied()
            target.move(first, path)
    else:
        emptied()
        for folder in staged:
            filesystem, base = open_root(folder)
            fs.copy_files(base, path, source_filesystem=filesystem, destination_filesystem=target)


#: The characters that Spark writes as ``%`` and two digits in the names of partition folders.
ESCAPED = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")


def partition_folder(destination: str, names: Sequence[str], values: Sequence[str | None]) -> str:
    """The folder of a partition below ``destination``, named as Spark names it."""
    escaped = lambda text: ESCAPED.sub(lambda c: f"%{ord(c[0]):02X}", text)
    named = [f"{escaped(name)}={'__HIVE_DEFAULT_PARTITION__' if value in (None, '') else escaped(value)}" for name, value in zip(names, values, strict=True)]
    return "/".join([destination.rstrip("/"), *named])


def without_rows(df: DataFrame, partition_by: Sequence[str], expected: Sequence[Sequence[str | None]]) -> list[tuple]:
    """Those of the expected partitions that no row of ``df`` belongs to; only the partition columns are read."""
    spark = df.sparkSession
    wanted = spark.createDataFrame([tuple(values) for values in expected], ", ".join(f"`__{name}` string" for name in partition_by)).distinct()
    held = df.select(*[F.col(f"`{name}`").cast("string").alias(name) for name in partition_by]).distinct()
    same = [F.col(f"`__{name}`").eqNullSafe(F.col(f"`{name}`")) for name in partition_by]
    return [tuple(row) for row in wanted.join(held, same, "left_anti").collect()]


def empty_partitions(spark: SparkSession, destination: str, partition_by: Sequence[str], partitions: Sequence[Sequence[str | None]]) -> None:
    """Delete the folders of the given partitions; one that is not there is passed over."""
    for values in partitions:
        remove_folder(spark, partition_folder(destination, partition_by, values))


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_landed(df_or_spark, destination: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Read a destination back with its partition values as text (``0012`` stays ``0012``)."""
    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    landed = spark.read.parquet(destination)
    kinds = dict(landed.dtypes)
    recast = {name: F.col(name).cast("string") for name in partition_by if kinds.get(name) != "string"}
    return landed.withColumns(recast) if recast else landed
