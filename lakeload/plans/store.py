"""The ledger on shared storage: append-only Parquet, one folder per pass.

Nothing is ever rewritten in place. A step writes its rows to a folder named by
its pass and overwrites only that folder, so a pass that failed half-way can be
run again under its number. Current statuses are read from the status log.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload import schemas
from lakeload.operators.ledger import current_status
from lakeload.sources.listing import children, open_root

STATUS_LOG = "load_id bigint, status string, at timestamp, seq bigint"
KINDS = {
    "tables": schemas.TABLES,
    "table_snapshots": schemas.TABLE_SNAPSHOTS,
    "loads": schemas.LOADS,
    "load_snapshots": schemas.LOAD_SNAPSHOTS,
    "feeds": schemas.FEEDS,
    "datasets": schemas.DATASETS,
    "status_log": STATUS_LOG,
}
# Small tables are written whole by each pass that changes them.
VERSIONED = ("tables", "table_snapshots", "feeds", "datasets")


class LedgerStore:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, kind: str) -> str:
        return f"{self.root}/{kind}"

    def write(self, kind: str, rows: DataFrame, pass_id: int, step: int = 0) -> None:
        """Write one step's rows of a pass; missing ledger columns become NULL."""
        target = self.spark.createDataFrame([], KINDS[kind]).schema
        columns = [
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.fields
        ]
        rows.select(*columns).write.mode("overwrite").parquet(f"{self._path(kind)}/pass={pass_id}/step={step}")

    def read(self, kind: str, before: tuple[int, int] | None = None) -> DataFrame:
        """All rows of a ledger table (or its newest version), optionally as of before a pass and step."""
        if not folder_numbers(self._path(kind), "pass"):
            return self.spark.createDataFrame([], KINDS[kind])
        rows = self.spark.read.schema(f"{KINDS[kind]}, pass bigint, step int").parquet(self._path(kind))
        if before is not None:
            rows = rows.where((F.col("pass") < before[0]) | ((F.col("pass") == before[0]) & (F.col("step") < before[1])))
        if kind in VERSIONED:
            newest = self._newest_version(kind, before)
            rows = rows.where((F.col("pass") == newest[0]) & (F.col("step") == newest[1]))
        return rows.drop("pass", "step")

    def _newest_version(self, kind: str, before: tuple[int, int] | None) -> tuple[int, int]:
        base = self._path(kind)
        versions = [(p, s) for p in folder_numbers(base, "pass") for s in folder_numbers(f"{base}/pass={p}", "step")]
        return max([v for v in versions if before is None or v < before], default=(-1, -1))

    def log(self, loads: DataFrame, status: str, pass_id: int, step: int, id_column: str = "load_id") -> None:
        """Append a status for each of the given loads."""
        rows = loads.select(
            F.col(id_column).alias("load_id"),
            F.lit(status).alias("status"),
            F.current_timestamp().alias("at"),
            F.lit(pass_id * 1000 + step).cast("long").alias("seq"),
        )
        self.write("status_log", rows, pass_id, step)

    def loads(self, before: tuple[int, int] | None = None, statuses: Sequence[str] | None = None) -> DataFrame:
        """Loads with their current status. The log is ordered by pass and step, not by the clock."""
        log = self.read("status_log", before).select("load_id", "status", F.col("seq").alias("at"), "seq")
        now = current_status(log).withColumnsRenamed({"load_id": "id", "status": "__now"})
        known = self.read("loads", before).join(now, "id", "left")
        rows = known.withColumn("status", F.coalesce("__now", "status")).drop("__now")
        return rows if statuses is None else rows.where(F.col("status").isin(*statuses))

    def last_load_id(self, before: tuple[int, int] | None = None) -> int:
        return self.read("loads", before).agg(F.max("id").alias("id")).first()["id"] or 0

    def next_pass(self) -> int:
        """One above the highest pass that wrote anything."""
        return max([0, *(p for kind in KINDS for p in folder_numbers(self._path(kind), "pass"))]) + 1

    def pass_of_batch(self, stream: str, batch_id: int) -> int:
        """The pass of a stream's batch: given once, and the same whenever the batch is run again."""
        path = f"{self.root}/stream_passes/{stream}/batch={batch_id}"
        given = folder_numbers(path, "pass")
        if given:
            return max(given)
        pass_id = self.next_pass()
        nothing = self.spark.createDataFrame([], STATUS_LOG)
        self.write("status_log", nothing, pass_id)  # the number is taken from here on
        nothing.write.mode("overwrite").parquet(f"{path}/pass={pass_id}")
        return pass_id


def folder_numbers(path: str, label: str) -> list[int]:
    """The numbers of folders named ``label=number``: only names are read, no data."""
    filesystem, base = open_root(path)
    return [int(name[len(label) + 1 :]) for name, folder, _, _ in children(filesystem, base) if folder and name.startswith(f"{label}=")]
