"""One pass over the landing zone: discover, select, batch, cast and land."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from itertools import groupby
from operator import or_
from threading import Semaphore

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lakeload.functions.parsers import is_bad
from lakeload.functions.paths import first_folder_below
from lakeload.operators import batching, casting, discover, landing, ledger, routing, schema_gate
from lakeload.plans.store import LedgerStore
from lakeload.runtime import lookup_join
from lakeload.sources import catalog, csv_text
from lakeload.sources.listing import list_objects

JOB_FAILURES = (PySparkException, Py4JJavaError)

#: Ids of loads at fault, and of loads that wait for the next attempt.
Outcome = tuple[list[int], list[int]]

# Steps of a pass, in the order in which they are written.
FOUND, SELECTED, BATCHED, FINISHED, FAILED = range(1, 6)


@dataclass(frozen=True)
class Limits:
    """How much one pass takes on; all that is there unless a cap is given. ``read_files`` are read and written at once.

    A load that could not be landed ``attempts`` times, through no fault of its own that was found, goes to the error path.
    """

    per_prefix: int | None = None
    per_table: int | None = None
    batch_loads: int = 10
    batch_bytes: int = 100_000_000
    concurrent_tables: int = 5
    read_files: int = 2000
    attempts: int = 3


def discovered(objects: DataFrame, store: LedgerStore, layout: routing.Layout, pass_id: int, limits: Limits) -> DataFrame:
    """New ledger rows (without ids) for the objects of a listing."""
    before = (pass_id, 0)
    tables, snapshots = store.read("tables", before), store.read("table_snapshots", before)
    roots = (layout.replication_prefix, layout.dataset_prefix)
    folder = F.coalesce(*[F.when(F.col("key").startswith(r), first_folder_below(F.col("key"), r)) for r in roots])
    foldered = discover.valid_objects(objects).withColumn("prefix", folder)
    matched = discover.match_prefixes(foldered, tables).drop("table_name")
    unseen = discover.unseen_objects(matched, store.read("loads", before))
    if limits.per_prefix is not None:
        unseen = ledger.first_per_group(unseen, ["prefix"], ["key", "last_modified"], limits.per_prefix)
    return discover.new_load_rows(unseen.drop("prefix"), tables, snapshots)


def take_in(objects: DataFrame, store: LedgerStore, layout: routing.Layout, pass_id: int, limits: Limits = Limits()) -> DataFrame:
    """Discover and record: new loads, their snapshots, and the tables' snapshots. Returns the new loads."""
    before = (pass_id, 0)
    rows = discovered(objects, store, layout, pass_id, limits)
    # Rows get their places while they are written: write once, then number what was written.
    staged = f"{store.root}/staged/pass={pass_id}"
    discover.with_row_places(rows).write.mode("overwrite").parquet(staged)
    found = discover.dense_load_ids(store.spark.read.parquet(staged), store.last_load_id(before))
    if found.isEmpty():
        return found
    now = F.current_timestamp()
    store.write("load_snapshots", discover.load_snapshot_rows(found).withColumns({"id": F.col("load_id"), "inserted_at": now}), pass_id)
    snapshots = store.read("table_snapshots", before)
    arrivals = found.select("table_id", F.col("s3_key").alias("key"), F.col("s3_modified").alias("last_modified"))
    updated = discover.table_snapshot_update(arrivals, snapshots).select("table_id", "snapshot")
    store.write("table_snapshots", lookup_join(snapshots.drop("snapshot"), updated, "table_id", "left", bounded_by=snapshots, one_each=True), pass_id)
    # Last: once the loads are there, the pass is known to have taken them in.
    store.write("loads", found.withColumns({"inserted_at": now, "updated_at": now}), pass_id)
    return found


def run_load_pass(
    spark: SparkSession,
    store: LedgerStore,
    registry: DataFrame,
    layout: routing.Layout,
    header: bool = False,
    limits: Limits = Limits(),
    objects: DataFrame | None = None,
    pass_id: int | None = None,
    check_schema: bool = False,
) -> int:
    """Take in new objects and land everything that is ready. Returns the pass number."""
    pass_id = store.next_pass() if pass_id is None else pass_id
    take_in(list_objects(spark, layout.incoming) if objects is None else objects, store, layout, pass_id, limits)
    advance(spark, store, registry, layout, pass_id, header, limits, check_schema)
    return pass_id


def advance(
    spark: SparkSession,
    store: LedgerStore,
    registry: DataFrame,
    layout: routing.Layout,
    pass_id: int,
    header: bool = False,
    limits: Limits = Limits(),
    check_schema: bool = False,
) -> None:
    """The steps behind discovery: select ready loads, batch, route, cast and land them, record the outcome.

    With ``check_schema`` a replicated load whose sidecar is missing, or names other
    columns than the catalog, goes to the error path before its object is opened.
    """
    ready = ledger.ready_loads(
        store.loads((pass_id, SELECTED)), store.read("tables"), store.read("table_snapshots"), limits.per_table
    )
    store.log(ready, "ready_for_ingesting", pass_id, SELECTED, "id")
    # Loads that a pass left half-way are taken up again, until their attempts are used up.
    chosen = store.loads((pass_id, BATCHED), ["ready_for_ingesting", "ingesting"])
    tries = store.read("status_log", (pass_id, BATCHED)).where("status = 'ingesting'").groupBy(F.col("load_id").alias("id")).count()
    tired = tries.where(F.col("count") >= limits.attempts).select("id")
    worn_path = f"{store.root}/batches-worn/pass={pass_id}"
    chosen.where("status = 'ingesting'").join(tired, "id", "left_semi").select("id").write.mode("overwrite").parquet(worn_path)
    worn = spark.read.parquet(worn_path)
    batches = batching.chunk_loads(chosen.join(worn, "id", "left_anti"), limits.batch_loads, limits.batch_bytes)
    plan_path = f"{store.root}/batches/pass={pass_id}"
    latest = ledger.latest_load_snapshot(store.read("load_snapshots"))
    named = routing.route_loads(ledger.loads_with_table(batches, store.read("tables")), layout)
    # A replicated load that no snapshot is known for, or that the gate holds back, fails alone.
    lost = routing.lacking_snapshot(named, latest, layout).select("id")
    if check_schema:
        lost = lost.unionByName(schema_gate.mismatched(named, registry, layout)).distinct()
    lost.write.mode("overwrite").parquet(f"{store.root}/batches-lost/pass={pass_id}")
    lost = spark.read.parquet(f"{store.root}/batches-lost/pass={pass_id}")
    routable = named.join(lost, "id", "left_anti")
    routing.routed_partitions(routable, latest, layout).write.mode("overwrite").parquet(plan_path)
    plan = spark.read.parquet(plan_path)
    store.log(plan.select("id").unionByName(lost), "ingesting", pass_id, BATCHED, "id")

    failed, waiting = land_routed(spark, plan, registry, header, limits, f"{layout.lake}_landing")
    done = plan.join(failed.unionByName(waiting), "id", "left_anti")
    store.log(done, "ready_for_archiving", pass_id, FINISHED, "id")
    store.log(failed.select("id").unionByName(lost).unionByName(worn.select("id")), "ready_for_erroring", pass_id, FAILED, "id")


def land_routed(spark: SparkSession, plan: DataFrame, registry: DataFrame, header: bool, limits: Limits, staging: str) -> tuple[DataFrame, DataFrame]:
    """Land every table's loads, ``read_files`` at a time; returns the ids of loads at fault, and of loads that could not be landed now.

    The folders of a table share their reads and writes: jobs follow from the tables and
    the number of files, not from the folders. ``concurrent_tables`` reads run at a time,
    also of one table. The driver holds the tables with their
    schemas, and the routes of the reads that run at the moment, never rows or all files
    of a pass.
    """
    kinds = ["source_table_name", "destination_table_name", "names"]
    path = F.regexp_replace("source_path", "/+", "/").alias("path")
    needed = plan.select(
        F.array_join("partition_columns.name", "/").alias("names"), *kinds[:2], path, "id", "source_path", "destination_path", "partition_columns"
    )
    tables = needed.select(*kinds[:2]).distinct().collect()
    schemas = catalog.fields_of_tables(registry, sorted({name for row in tables for name in row if name is not None}))

    def reads() -> Iterator[tuple[tuple, list[Row]]]:
        """The plan is sorted once and streamed; loads of one path, which may replace the same partition, share a read."""
        rows = needed.orderBy(*kinds, "path", "id").toLocalIterator(prefetchPartitions=True)
        for kind, loads in groupby(rows, lambda row: tuple(row[c] for c in kinds)):
            some: list[Row] = []
            for load in loads:
                if len(some) >= limits.read_files and load["path"] != some[-1]["path"]:
                    yield kind, some
                    some = []
                some.append(load)
            yield kind, some

    def one(kind: tuple, some: list[Row]) -> Outcome:
        columns = [f["name"] for f in schemas.get(kind[0], [])]
        return land_table(spark, some, columns, schemas.get(kind[1], []), header, f"{staging}/{uuid.uuid4().hex}")

    free, running = Semaphore(limits.concurrent_tables), []
    with ThreadPoolExecutor(limits.concurrent_tables) as pool:
        for kind, some in reads():
            free.acquire()
            running.append(pool.submit(one, kind, some))
            running[-1].add_done_callback(lambda _: free.release())
    outcomes = [done.result() for done in running]
    failed, waiting = ([(i,) for outcome in outcomes for i in outcome[kind]] for kind in (0, 1))
    return spark.createDataFrame(failed, "id bigint"), spark.createDataFrame(waiting, "id bigint")


def land_table(spark: SparkSession, loads: list, columns: list[str], fields: list[dict], header: bool, staging: str) -> Outcome:
    """Land loads of one table. Returns the ids of those at fault, which are left out, and of those that wait.

    A load is at fault if its file cannot be read, has a row with too few or too many
    fields, or a value that does not parse. Any other failure is none of the load's.

    The files are read once: their rows are cast and staged, and by the same job the bad
    files and the empty ones are found. Only when all is staged, the good ones are moved to
    the lake. Should the job fail, the files that cannot be read are looked for.
    """
    if not columns or not fields:
        return [load["id"] for load in loads], []

    def newest(chosen: list) -> list:
        # A rewritten object can have several loads: its file is read once, for the newest of them.
        return list({_path_key(c["source_path"]): c for c in sorted(chosen, key=lambda c: c["id"])}.values())

    def routed(rows: DataFrame, chosen: list) -> DataFrame:
        # One row per file of this read; the broadcast is as long as the path list.
        routes = spark.createDataFrame([(_path_key(c["source_path"]), c["id"]) for c in chosen], "__key string, __id bigint")
        # The scan gives paths URI-encoded, where a plus sign stands for itself.
        decoded = F.url_decode(F.replace("__file", F.lit("+"), F.lit("%2B")))
        key = F.ltrim(F.regexp_replace(F.regexp_replace(decoded, SCHEME, ""), "/+", "/"), F.lit("/"))
        bad = reduce(or_, [is_bad(f"`{f['name']}`", f["type"]) for f in fields if f["type"] != "string"], F.col("__corrupt").isNotNull())
        unknown = F.raise_error(F.concat(F.lit("no load for the file "), "__file")).cast("long")
        known = rows.withColumn("__key", key).join(F.broadcast(routes), "__key", "left")
        return known.withColumns({"__id": F.coalesce("__id", unknown), "__bad": F.coalesce(bad, F.lit(False))})

    def scan(chosen: list) -> DataFrame:
        paths = [c["source_path"] for c in chosen]
        return csv_text.scan_csv_strings(spark, paths, columns, header, file_column="__file", corrupt_column="__corrupt")

    def readable(chosen: list) -> bool:
        try:
            scan(chosen).write.format("noop").mode("overwrite").save()
        except JOB_FAILURES:
            return False
        return True

    def unreadable(chosen: list) -> list:
        """By halves: a file that cannot be read is found in a few reads, whatever the number of files."""
        if readable(chosen):
            return []
        if len(chosen) == 1:
            return chosen
        half = len(chosen) // 2
        return unreadable(chosen[:half]) + unreadable(chosen[half:])

    def staged(chosen: list) -> dict[int, tuple[bool, list[str]]]:
        """Whether a file with rows has a bad one, and where they are, by load; a row per file comes to the driver, of one read."""
        cast = casting.cast_to_schema(routed(scan(chosen), chosen), fields, mode="lenient", keep=["__id", "__bad"])
        return landing.stage_loads(cast, staging, "__id", "__bad")

    def judged(chosen: list) -> dict[int, tuple[bool, list[str]]]:
        """Which files have a bad row, where nothing can be written."""
        # the texts are read as well: Spark refuses a scan of the corrupt column alone
        summed = routed(scan(chosen), chosen).groupBy("__id").agg(F.bool_or("__bad").alias("bad"), F.max(F.length(f"`{columns[0]}`"))).collect()
        return {row["__id"]: (row["bad"], []) for row in summed}

    def write(good: list, found: dict[int, tuple[bool, list[str]]]) -> None:
        # A file without rows leaves its partition empty, whatever an earlier delivery put there.
        at = lambda c: landing.partition_folder(c["destination_path"], *zip(*((p["name"], p["value"]) for p in c["partition_columns"])))
        landing.place_loads(spark, [(at(c), found.get(c["id"], (False, []))[1]) for c in good])

    chosen, keys, found, works = newest(loads), set(), None, True
    try:
        try:
            found = staged(chosen)
        except JOB_FAILURES:
            keys = {_path_key(c["source_path"]) for c in unreadable(chosen)}
            chosen = [c for c in chosen if _path_key(c["source_path"]) not in keys]
        if found is None and chosen:
            try:
                found = staged(chosen)
            except JOB_FAILURES:
                works = False  # the next attempt looks again
                found = judged(chosen)
        bad = {c["id"] for c in chosen if found.get(c["id"], (False,))[0]}
        keys |= {_path_key(c["source_path"]) for c in chosen if c["id"] in bad}
        if works and (good := [c for c in chosen if c["id"] not in bad]):
            write(good, found)
    except JOB_FAILURES:
        works = False
    finally:
        landing.remove_folder(spark, staging)
    at_fault = sorted(load["id"] for load in loads if _path_key(load["source_path"]) in keys)
    rest = sorted(load["id"] for load in loads if _path_key(load["source_path"]) not in keys)
    return at_fault, [] if works else rest


# Filesystems give paths back with another number of slashes, or with an authority that was left out.
SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?"


def _path_key(path: str) -> str:
    """A path without scheme, authority and repeated slashes, as it also comes back from the scan."""
    full = path if re.match(SCHEME, path) else os.path.abspath(path)
    return re.sub("/+", "/", re.sub(SCHEME, "", full)).lstrip("/")
