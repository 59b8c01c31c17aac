"""Objects for the queries that move or land real files."""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.sources.listing import open_root
from lakeload.sources.manifest import sidecar_key


def deliver(files: DataFrame, root: str) -> None:
    """Write ``s3_key, body`` as objects below ``root``, compressed where the key says so; the tasks write them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = open_root(root)
        for batch in batches:
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                path = f"{base}/{key}"
                if isinstance(filesystem, fs.LocalFileSystem):
                    filesystem.create_dir(path.rsplit("/", 1)[0], recursive=True)
                content = body.encode()
                with filesystem.open_output_stream(path, compression=None) as out:
                    out.write(gzip.compress(content) if key.endswith(".gz") else content)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["written"])

    # an explicit number, which adaptive execution keeps: by their bytes, very many small objects are one task's
    dealt = files.select("s3_key", "body").repartition(2 * files.sparkSession.sparkContext.defaultParallelism, "s3_key")
    dealt.mapInArrow(run, "written bigint").write.format("noop").mode("overwrite").save()


def _columns(names: list[str]) -> str:
    listed = ",".join(f'{{"ordinal":{i},"name":"{n}","type":"STRING"}}' for i, n in enumerate(names))
    return f'{{"dfmVersion":"1.1","dataInfo":{{"columns":[{listed}]}}}}'


def sidecar(deliveries: DataFrame) -> DataFrame:
    """A sidecar with the right columns beside each replicated object."""
    return deliveries.where("s3_key like 'ods/%'").select(sidecar_key(F.col("s3_key")).alias("s3_key"), F.lit(_columns(["N", "Day", "TEXT"])).alias("body"))


def gate_sidecar(deliveries: DataFrame) -> DataFrame:
    """Sidecars of which some have another order (owners of a multiple of 7), some are damaged (5), some are missing (11)."""
    owner = F.col("owner")
    body = (
        F.when((owner >= 0) & (owner % 7 == 0), _columns(["DAY", "N", "TEXT"]))
        .when((owner >= 0) & (owner % 5 == 0), '{"dataInfo":{"columns":[')
        .otherwise(_columns(["N", "DAY", "TEXT"]))
    )
    there = deliveries.where("s3_key like 'ods/%' and (owner < 0 or owner % 11 <> 0)")
    return there.select(sidecar_key(F.col("s3_key")).alias("s3_key"), body.alias("body"))
