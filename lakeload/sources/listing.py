"""Object listings as a Spark data source, for batch and streaming.

``spark.read.format("object_listing").option("path", root).load()`` gives
``key, last_modified, size`` of every object below ``root``, zero-byte ones
included, which Spark's own file sources leave out. Every table folder is one
task, so the listing runs on the executors and never passes the driver.

The streaming reader's offset is a moment in time: a batch holds the objects
modified after its start and up to its end. A path that is written again has a
newer time and is delivered again, which the built-in file stream does not do.
With ``everything`` each batch holds all objects up to its end, for readers that
know what they have seen: an object that shows up late, with an older time, is
then not missed.
"""

from __future__ import annotations

import json
import os
import re
import time
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

FORMAT = "object_listing"
DDL = "key string, last_modified timestamp, size bigint"
BATCH_ROWS = 10_000
FOREVER = 2**62


class Folder(InputPartition):
    """One folder to list; ``deep`` includes the folders below it."""

    def __init__(self, prefix: str, deep: bool, after: int = -1, upto: int = FOREVER) -> None:
        super().__init__((prefix, deep, after, upto))
        self.prefix, self.deep, self.after, self.upto = prefix, deep, after, upto


def open_root(root: str) -> tuple[fs.FileSystem, str]:
    if "://" not in root and not root.startswith("file:"):
        return fs.LocalFileSystem(), os.path.abspath(root)
    if root.startswith("file:"):
        return fs.LocalFileSystem(), unquote(urlparse(root).path).rstrip("/")
    # Spark's names for S3 are not known to Arrow.
    filesystem, path = fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", root))
    return filesystem, path.rstrip("/")


def children(filesystem: fs.FileSystem, path: str) -> Iterator[tuple[str, bool, int, int]]:
    """``name, is_folder, modified (microseconds), size`` of a folder's entries."""
    if isinstance(filesystem, fs.LocalFileSystem):
        if not os.path.isdir(path):
            return
        with os.scandir(path) as entries:
            for entry in entries:
                found = entry.stat()
                yield entry.name, entry.is_dir(), found.st_mtime_ns // 1000, found.st_size
        return
    for info in filesystem.get_file_info(fs.FileSelector(path, allow_not_found=True)):
        folder = info.type == fs.FileType.Directory
        yield info.base_name, folder, 0 if folder else info.mtime_ns // 1000, info.size or 0


def walk(root: str, part: Folder) -> Iterator[tuple[str, int, int]]:
    filesystem, base = open_root(root)
    pending = [part.prefix]
    while pending:
        prefix = pending.pop()
        for name, is_folder, modified, size in children(filesystem, f"{base}/{prefix}".rstrip("/")):
            if is_folder:
                if part.deep:
                    pending.append(f"{prefix}{name}/")
            elif part.after < modified <= part.upto:
                yield prefix + name, modified, size


def batches(rows: Iterator[tuple[str, int, int]]) -> Iterator[pa.RecordBatch]:
    keys, times, sizes = [], [], []

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array(times, pa.timestamp("us", tz="UTC")), pa.array(sizes, pa.int64())],
            names=["key", "last_modified", "size"],
        )

    for key, modified, size in rows:
        keys.append(key)
        times.append(modified)
        sizes.append(size)
        if len(keys) == BATCH_ROWS:
            yield flush()
            keys, times, sizes = [], [], []
    if keys:
        yield flush()


class ListingOptions:
    def __init__(self, options) -> None:
        self.root = options["path"]
        self.prefixes = json.loads(options["prefixes"]) if options.get("prefixes") else None
        self.depth = int(options.get("depth", 2))
        self.settle = float(options.get("settleSeconds", 2))
        self.everything = options.get("everything", "false") == "true"

    def folders(self, after: int = -1, upto: int = FOREVER) -> list[Folder]:
        """The given prefixes, or the folders ``depth`` levels below the root (the table folders)."""
        if self.prefixes is not None:
            return [Folder(p, True, after, upto) for p in self.prefixes] or [Folder("", False, FOREVER, FOREVER)]
        filesystem, base = open_root(self.root)
        parts, level = [], [""]
        for step in range(self.depth + 1):
            last = step == self.depth
            parts += [Folder(p, last, after, upto) for p in level]
            if not last:
                level = [
                    f"{p}{name}/"
                    for p in level
                    for name, is_folder, _, _ in children(filesystem, f"{base}/{p}".rstrip("/"))
                    if is_folder
                ]
        return parts


class ListingReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.listing = ListingOptions(options)

    def partitions(self):
        return self.listing.folders()

    def read(self, partition):
        return batches(walk(self.listing.root, partition))


class ListingStreamReader(DataSourceStreamReader):
    def __init__(self, options) -> None:
        self.listing = ListingOptions(options)

    def initialOffset(self):
        return {"upto": -1}

    def latestOffset(self):
        # Objects younger than the settle time wait for the next batch.
        return {"upto": int((time.time() - self.listing.settle) * 1_000_000)}

    def partitions(self, start, end):
        return self.listing.folders(-1 if self.listing.everything else start["upto"], end["upto"])

    def read(self, partition):
        return batches(walk(self.listing.root, partition))

    def commit(self, end):
        pass


class ObjectListing(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return DDL

    def reader(self, schema: StructType) -> DataSourceReader:
        return ListingReader(self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return ListingStreamReader(self.options)


def _options(root: str, prefixes, depth: int, settle: float) -> dict[str, str]:
    options = {"path": root, "depth": str(depth), "settleSeconds": str(settle)}
    if prefixes is not None:
        options["prefixes"] = json.dumps(list(prefixes))
    return options


def list_objects(spark: SparkSession, root: str, prefixes: list[str] | None = None, depth: int = 2) -> DataFrame:
    """Every object below ``root`` (or below the given prefixes), keys relative to ``root``."""
    spark.dataSource.register(ObjectListing)
    return spark.read.format(FORMAT).options(**_options(root, prefixes, depth, 0)).load()


def stream_objects(
    spark: SparkSession, root: str, prefixes: list[str] | None = None, depth: int = 2, settle_seconds: float = 2, everything: bool = False
) -> DataFrame:
    spark.dataSource.register(ObjectListing)
    options = _options(root, prefixes, depth, settle_seconds) | {"everything": str(everything).lower()}
    return spark.readStream.format(FORMAT).options(**options).load()


