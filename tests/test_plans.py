"""Listing, the passes and the streams on real files."""

import gzip
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from lakeload.operators.landing import read_landed
from lakeload.operators.relocate import relocate
from lakeload.operators.routing import Layout
from lakeload.plans import load_pass
from lakeload.plans.feed_sync import run_feed_sync
from lakeload.plans.load_pass import Limits, advance, land_routed, run_load_pass
from conformance.files import deliver
from lakeload.plans.relocation_pass import run_relocation_pass
from lakeload.plans.store import LedgerStore
from lakeload.sources.listing import list_objects, stream_objects
from lakeload.streaming.discover_stream import start_discovery


class Zone:
    """A landing zone with one replicated table and one dataset table, and an empty ledger."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        self.layout = Layout(*(f"{self.root}/{n}/" for n in ("incoming", "lake", "archive", "errors")))
        self.store = LedgerStore(spark, f"{self.root}/ledger")
        tables = [(1, "ods__s", "ods/S/", True, True), (2, "set", "datasets/set/", False, True), (3, "off", "ods/OFF/", True, None)]
        self.store.write(
            "tables", spark.createDataFrame(tables, "id bigint, name string, s3_prefix string, is_raw boolean, is_active boolean"), 0
        )
        snapshots = [(1, 1, "ods/S/LOAD1.csv.gz")]
        self.store.write("table_snapshots", spark.createDataFrame(snapshots, "id bigint, table_id bigint, snapshot_s3_key string"), 0)
        rows = []
        for table in ("ods__s", "raw_ods__s", "ods__s__ct", "raw_ods__s__ct", "set"):
            rows += [(table, 1, "n", "bigint"), (table, 2, "day", "date"), (table, 3, "text", "string")]
        self.registry = spark.createDataFrame(rows, "table_name string, ordinal int, column_name string, column_type string")

    def put(self, key, lines, modified):
        path = f"{self.root}/incoming/{key}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        if lines is None:
            open(path, "wb").close()
        elif key.endswith(".gz"):
            with gzip.open(path, "wt") as out:
                out.write("".join(f"{line}\n" for line in lines))
        else:
            with open(path, "w") as out:
                out.write("{}")
        os.utime(path, (modified, modified))

    def run(self):
        return run_load_pass(self.spark, self.store, self.registry, self.layout)

    def statuses(self):
        return {(r["s3_key"], r["second"]): r["status"] for r in self.store.loads().selectExpr("s3_key", "unix_seconds(s3_modified) as second", "status").collect()}

    def lake(self, path):
        names = ["snapshot", "identifier"]
        return sorted(map(tuple, read_landed(self.spark, f"{self.layout.lake}{path}", names).select("n", "text", *names).collect()), key=str)


START = 1_640_000_000  # 2021-12-20T11:33:20Z


@pytest.fixture
def zone(spark, tmp_path):
    return Zone(spark, tmp_path)


def test_listing_sees_every_object(spark, zone):
    zone.put("ods/S/LOAD1.csv.gz", ["1,2022-01-01,a"], START)
    zone.put("ods/S/deep/er/x.csv.gz", ["1"], START)
    zone.put("ods/S/empty.csv.gz", None, START + 1)
    zone.put("datasets/set/1.csv.gz", ["1"], START)
    zone.put("top.txt", ["1"], START)
    every = list_objects(spark, zone.layout.incoming)
    found = {r["key"]: (r["size"], r["at"]) for r in every.selectExpr("key", "size", "unix_seconds(last_modified) as at").collect()}
    assert set(found) == {"ods/S/LOAD1.csv.gz", "ods/S/deep/er/x.csv.gz", "ods/S/empty.csv.gz", "datasets/set/1.csv.gz", "top.txt"}
    assert found["ods/S/empty.csv.gz"] == (0, START + 1)
    some = list_objects(spark, f"file://{zone.layout.incoming}", prefixes=["ods/S/", "ods/none/"])
    assert {r["key"] for r in some.collect()} == {k for k in found if k.startswith("ods/S/")}


def test_load_pass_end_to_end(zone):
    zone.put("ods/S/LOAD1.csv.gz", ["1,2022-01-01,a", '2,20220102,"b, c"', ",,"], START)
    zone.put("ods/S/LOAD1.dfm", [], START)
    zone.put("ods/S/LOAD2.csv.gz", ["3,2022-01-03,d"], START + 1)
    zone.put("ods/S/LOAD3.csv.gz", None, START + 2)
    zone.put("ods/S__ct/1.csv.gz", ["4,2022-01-04,e"], START + 3)
    zone.put("datasets/set/1.csv.gz", ["5,2022-01-05,f"], START)
    zone.put("datasets/set/2.csv.gz", ["6,2022-01-06,g", "x7,2022-01-07,h"], START)
    zone.put("ods/OFF/LOAD1.csv.gz", ["1,2022-01-01,a"], START)
    zone.run()
    stamp = "20211220T113320Z"
    assert zone.lake("raw/ods/S") == [
        (1, "a", stamp, "LOAD1.csv.gz"),
        (2, "b, c", stamp, "LOAD1.csv.gz"),
        (3, "d", stamp, "LOAD2.csv.gz"),
        (None, None, stamp, "LOAD1.csv.gz"),
    ]
    assert zone.lake("raw/ods/S__ct") == [(4, "e", stamp, "1.csv.gz")]
    sets = read_landed(zone.spark, f"{zone.layout.lake}datasets/set", ["identifier"])
    assert [(r["n"], r["identifier"]) for r in sets.collect()] == [(5, "1.csv.gz")]
    expected = {
        ("ods/S/LOAD1.csv.gz", START): "ready_for_archiving",
        ("ods/S/LOAD2.csv.gz", START + 1): "ready_for_archiving",
        ("ods/S/LOAD3.csv.gz", START + 2): "ready_for_erroring",
        ("ods/S__ct/1.csv.gz", START + 3): "ready_for_archiving",
        ("datasets/set/1.csv.gz", START): "ready_for_archiving",
        ("datasets/set/2.csv.gz", START): "ready_for_erroring",
    }
    assert zone.statuses() == expected

    zone.run()  # nothing new
    assert zone.statuses() == expected

    run_relocation_pass(zone.spark, zone.store, zone.layout)
    moved = zone.statuses()
    assert moved == {
        ("ods/S/LOAD1.csv.gz", START): "archived",
        ("ods/S/LOAD2.csv.gz", START + 1): "archived_unknown",  # no sidecar was there to move
        ("ods/S/LOAD3.csv.gz", START + 2): "errored_unknown",
        ("ods/S__ct/1.csv.gz", START + 3): "archived_unknown",
        ("datasets/set/1.csv.gz", START): "archived",
        ("datasets/set/2.csv.gz", START): "errored",
    }
    assert os.path.exists(f"{zone.layout.archive}datasets/set/1.csv.gz")
    assert os.path.exists(f"{zone.layout.errors}datasets/set/2.csv.gz")
    assert os.path.exists(f"{zone.layout.archive}ods/S/snapshot={stamp}/LOAD1.dfm")

    # the source restarted: the snapshot file is written again
    zone.put("ods/S/LOAD1.csv.gz", ["9,2022-01-09,z"], START + 60)
    zone.run()
    assert (9, "z", "20211220T113420Z", "LOAD1.csv.gz") in zone.lake("raw/ods/S")
    assert len(zone.lake("raw/ods/S")) == 5

    for name in ("S/LOAD2", "S/LOAD3", "S__ct/1"):
        zone.put(f"ods/{name}.dfm", [], START)
    run_relocation_pass(zone.spark, zone.store, zone.layout, retry=True)
    moved = zone.statuses()
    assert moved[("ods/S/LOAD2.csv.gz", START + 1)] == moved[("ods/S__ct/1.csv.gz", START + 3)] == "archived"
    assert moved[("ods/S/LOAD3.csv.gz", START + 2)] == "errored"
    assert moved[("ods/S/LOAD1.csv.gz", START + 60)] == "ready_for_archiving"


def test_an_unreadable_file_fails_alone(zone):
    zone.put("datasets/set/1.csv.gz", ["5,2022-01-05,f"], START)
    path = f"{zone.layout.incoming}datasets/set/2.csv.gz"
    with open(path, "wb") as out:
        out.write(gzip.compress(b"6,2022-01-06,g\n" * 5000)[:-40])
    zone.run()
    by_key = {key: status for (key, _), status in zone.statuses().items()}
    assert by_key == {"datasets/set/1.csv.gz": "ready_for_archiving", "datasets/set/2.csv.gz": "ready_for_erroring"}


def test_odd_file_names_are_landed(zone):
    names = ["a[1].csv.gz", "a+b c.csv.gz", "50%25{x}*.csv.gz", "ä.csv.gz"]
    for n, name in enumerate(names):
        zone.put(f"datasets/set/{name}", [f"{n},2022-01-05,f"], START + n)
    zone.run()
    landed = read_landed(zone.spark, f"{zone.layout.lake}datasets/set", ["identifier"]).orderBy("n")
    assert [r["identifier"] for r in landed.collect()] == names
    assert set(zone.statuses().values()) == {"ready_for_archiving"}


def test_discovery_stream_delivers_once_and_sees_rewrites(zone, tmp_path):
    def drain():
        query = start_discovery(zone.spark, zone.store, zone.layout, f"{tmp_path}/cp", {"availableNow": True}, settle_seconds=0)
        query.awaitTermination()
        return sorted(r["s3_key"] for r in zone.store.read("loads").collect())

    zone.put("ods/S/LOAD1.csv.gz", ["1,2022-01-01,a"], START)
    zone.put("ods/S/empty.csv.gz", None, START)
    zone.put("ods/S/LOAD1.dfm", [], START)
    first = ["ods/S/LOAD1.csv.gz", "ods/S/empty.csv.gz"]
    assert drain() == first
    assert drain() == first
    now = time.time()
    zone.put("ods/S/LOAD1.csv.gz", ["2,2022-01-01,b"], now)
    zone.put("ods/S/LOAD2.csv.gz", ["2,2022-01-01,b"], now)
    assert drain() == ["ods/S/LOAD1.csv.gz", *first[:1], "ods/S/LOAD2.csv.gz", *first[1:]]
    snapshot = zone.store.read("table_snapshots").select(F.unix_seconds("snapshot")).first()[0]
    assert snapshot == int(now)
    assert zone.store.read("loads").select("id").distinct().count() == 4


def test_stream_runs_the_later_steps(zone, tmp_path):
    zone.put("datasets/set/1.csv.gz", ["5,2022-01-05,f"], START)
    land = lambda pass_id: advance(zone.spark, zone.store, zone.registry, zone.layout, pass_id)
    start_discovery(
        zone.spark, zone.store, zone.layout, f"{tmp_path}/cp", {"availableNow": True}, settle_seconds=0, after_batch=land
    ).awaitTermination()
    assert zone.statuses() == {("datasets/set/1.csv.gz", START): "ready_for_archiving"}
    assert zone.spark.read.parquet(f"{zone.layout.lake}datasets/set").count() == 1


def test_stream_source_is_a_stream(zone):
    os.makedirs(zone.layout.incoming, exist_ok=True)
    assert stream_objects(zone.spark, zone.layout.incoming).isStreaming


def test_feed_sync(spark, zone):
    feeds = spark.createDataFrame([(1, "/datasetpublicusersapi/s"), (2, "/datasetpublicusersapi/t")], "id bigint, relative_url string")
    zone.store.write("feeds", feeds, 0)
    one = '{"id":"sample","dataset_id":"sample_1","url":"https://h/1","start_date":"2022-05-17","end_date":"2022-05-17","last_updated":"%s"}'
    bodies = [(1, 0, '{"success":true,"results":[%s,%s]}' % (one % "2022-05-18T12:12:24.897363", one.replace("https", "ftp") % "2023-01-01T00:00:00"))]
    wanted = run_feed_sync(zone.store, spark.createDataFrame(bodies, "feed_id bigint, arrival int, body string"))
    assert [tuple(r) for r in wanted.collect()] == [(1, "https://h/1", "datasets/sample/sample_1.csv.gz")]
    marks = {r["id"]: r["at"] for r in zone.store.read("feeds").select("id", F.col("last_updated_at").cast("string").alias("at")).collect()}
    assert marks == {1: "2022-05-18 12:12:24.897363", 2: None}
    later = [(1, 0, '{"results":[%s]}' % (one.replace("2022-05-17", "2022-06-01") % "2022-06-18T00:00:00"))]
    run_feed_sync(zone.store, spark.createDataFrame(later, "feed_id bigint, arrival int, body string"))
    stored = zone.store.read("datasets").selectExpr("identifier", "cast(start_date as string)", "cast(last_updated_at as string)").collect()
    assert [tuple(r) for r in stored] == [("sample_1", "2022-05-17", "2022-06-18 00:00:00")]


def test_rewritten_object_is_landed_once(zone):
    zone.put("datasets/set/1.csv.gz", ["5,2022-01-05,f"], START)
    zone.store.write("loads", zone.spark.sql(f"select 1L id, 2L table_id, 'ready_for_ingesting' status, 'datasets/set/1.csv.gz' s3_key, timestamp_seconds({START - 5}) s3_modified, 9L s3_size, false is_raw"), 0)
    zone.run()
    rows = read_landed(zone.spark, f"{zone.layout.lake}datasets/set", ["identifier"]).collect()
    assert [r["n"] for r in rows] == [5]
    assert set(zone.statuses().values()) == {"ready_for_archiving"}


def test_a_file_delivered_again_without_rows_empties_its_partition(zone):
    zone.put("datasets/set/a.csv.gz", ["1,2021-01-01,x"], START)
    zone.put("datasets/set/b.csv.gz", ["2,2021-01-01,y"], START)
    zone.run()
    zone.put("datasets/set/a.csv.gz", [], START + 60)
    zone.run()
    landed = read_landed(zone.spark, f"{zone.layout.lake}datasets/set", ["identifier"])
    assert [(r["n"], r["identifier"]) for r in landed.collect()] == [(2, "b.csv.gz")]
    assert zone.statuses()[("datasets/set/a.csv.gz", START + 60)] == "ready_for_archiving"


def test_the_newest_load_of_a_rewritten_snapshot_file_is_landed(zone):
    zone.put("ods/S/LOAD1.csv.gz", ["1,2021-01-01,old"], START)
    zone.run()
    # the load falls back, and its file is rewritten before the next pass
    load = zone.store.loads().where("status = 'ready_for_archiving'")
    zone.store.log(load, "ready_for_ingesting", zone.store.next_pass(), 9, "id")
    zone.put("ods/S/LOAD1.csv.gz", ["2,2021-01-01,new"], START + 60)
    zone.run()
    snapshots = {row[2] for row in zone.lake("raw/ods/S/")} if os.path.exists(f"{zone.layout.lake}raw/ods/S") else {row[2] for row in zone.lake("ods/S/")}
    assert "20211220T113420Z" in snapshots


def test_double_slashes_in_the_root(zone):
    zone.put("datasets/set/1.csv.gz", ["5,2022-01-05,f"], START)
    zone.layout = Layout(f"file:{zone.root}//incoming/", *(f"{zone.root}/{n}/" for n in ("lake", "archive", "errors")))
    zone.run()
    assert read_landed(zone.spark, f"{zone.layout.lake}datasets/set", ["identifier"]).count() == 1


def test_one_pass_takes_every_file(zone, monkeypatch):
    for i in range(130):
        zone.put(f"datasets/set/{i}.csv.gz", [f"{i},2022-01-05,f"], START + i)
    run_load_pass(zone.spark, zone.store, zone.registry, zone.layout, limits=Limits(read_files=50))
    assert read_landed(zone.spark, f"{zone.layout.lake}datasets/set", ["identifier"]).count() == 130
    assert set(zone.statuses().values()) == {"ready_for_archiving"}


def test_load_without_snapshot_fails_alone(zone):
    zone.put("datasets/set/1.csv.gz", ["5,2022-01-05,f"], START)
    zone.put("ods/S/LOAD7.csv.gz", ["1,2022-01-01,a"], START)
    zone.store.write("loads", zone.spark.sql(f"select 1L id, 1L table_id, 'ready_for_ingesting' status, 'ods/S/LOAD7.csv.gz' s3_key, timestamp_seconds({START}) s3_modified, 9L s3_size, true is_raw"), 0)
    zone.run()
    assert zone.statuses() == {("datasets/set/1.csv.gz", START): "ready_for_archiving", ("ods/S/LOAD7.csv.gz", START): "ready_for_erroring"}


def test_feed_sync_keeps_what_only_the_ledger_knows(zone):
    spark, store = zone.spark, zone.store
    stored = "select 7L id, 1L feed_id, 'sample' type, 'sample_1' identifier, timestamp'2022-01-01' last_updated_at, timestamp'2022-02-02' deleted_at"
    store.write("datasets", spark.sql(stored), 0)
    store.write("feeds", spark.sql("select 1L id, '/a' relative_url, null deleted_at union all select 2L, '/b', timestamp'2022-01-01'"), 0)
    body = '{"success":true,"results":[{"id":"sample","dataset_id":"sample_1","url":"https://x/y","start_date":"2022-05-17","end_date":"2022-05-17","last_updated":"2022-05-18T12:12:24.000001"}]}'
    run_feed_sync(store, spark.createDataFrame([(1, START, body)], "feed_id bigint, arrival bigint, body string"))
    row = store.read("datasets").first()
    assert row["id"] == 7 and row["deleted_at"] is not None and row["last_updated_at"].month == 5
    assert sorted(r["id"] for r in store.read("feeds").collect()) == [1, 2]


def test_rows_with_too_few_or_too_many_fields_are_rejected(zone):
    zone.put("datasets/set/1.csv.gz", ["5,2022-01-05,f"], START)
    zone.put("datasets/set/2.csv.gz", ["5,2022-01-05,f,EXTRA"], START)
    zone.put("datasets/set/3.csv.gz", ["1,2022-01-05,f", "6"], START)
    zone.run()
    landed = read_landed(zone.spark, f"{zone.layout.lake}datasets/set", ["identifier"]).collect()
    assert [(r["n"], r["identifier"]) for r in landed] == [(5, "1.csv.gz")]
    by_key = {key[-8]: status for (key, _), status in zone.statuses().items()}
    assert by_key == {"1": "ready_for_archiving", "2": "ready_for_erroring", "3": "ready_for_erroring"}


def test_a_lake_that_cannot_be_written_condemns_no_load(zone):
    zone.put("datasets/set/1.csv.gz", ["5,2022-01-05,f"], START)
    zone.put("datasets/set/2.csv.gz", ["x,2022-01-05,f"], START)
    os.makedirs(zone.layout.lake)
    in_the_way = f"{zone.layout.lake}datasets"
    open(in_the_way, "w").close()
    zone.run()
    assert {key[-8]: status for (key, _), status in zone.statuses().items()} == {"1": "ingesting", "2": "ready_for_erroring"}
    os.remove(in_the_way)
    zone.run()
    assert {key[-8]: status for (key, _), status in zone.statuses().items()} == {"1": "ready_for_archiving", "2": "ready_for_erroring"}
    assert read_landed(zone.spark, f"{zone.layout.lake}datasets/set", ["identifier"]).count() == 1


def test_attempts_are_used_up(zone):
    zone.put("datasets/set/1.csv.gz", ["5,2022-01-05,f"], START)
    os.makedirs(zone.layout.lake)
    open(f"{zone.layout.lake}datasets", "w").close()
    for status in ("ingesting", "ingesting", "ingesting", "ready_for_erroring"):
        zone.run()
        assert set(zone.statuses().values()) == {status}


def discover_now(zone, checkpoint):
    start_discovery(zone.spark, zone.store, zone.layout, str(checkpoint), {"availableNow": True}, settle_seconds=0).awaitTermination()
    return sorted(r["s3_key"][-8] for r in zone.store.read("loads").collect())


def test_stream_on_a_used_store_and_with_a_new_checkpoint(zone, tmp_path):
    zone.put("datasets/set/1.csv.gz", ["5,2022-01-05,f"], START)
    zone.run()
    zone.put("datasets/set/2.csv.gz", ["6,2022-01-05,f"], START)
    assert discover_now(zone, tmp_path / "one") == ["1", "2"]
    zone.put("datasets/set/3.csv.gz", ["7,2022-01-05,f"], START)
    assert discover_now(zone, tmp_path / "two") == ["1", "2", "3"]
    assert zone.statuses()[("datasets/set/1.csv.gz", START)] == "ready_for_archiving"


def test_stream_takes_late_objects_with_an_older_time(zone, tmp_path):
    zone.put("datasets/set/2.csv.gz", ["6,2022-01-05,f"], START)
    assert discover_now(zone, tmp_path / "cp") == ["2"]
    zone.put("datasets/set/1.csv.gz", ["5,2022-01-05,f"], START - 1000)
    assert discover_now(zone, tmp_path / "cp") == ["1", "2"]
    assert discover_now(zone, tmp_path / "cp") == ["1", "2"]


def test_moves_are_dealt_over_tasks(spark, tmp_path):
    pairs = spark.range(40).selectExpr("id", "concat('a', id) source_key", "concat('b', id) destination_key").coalesce(1)
    assert relocate(pairs, str(tmp_path), str(tmp_path)).rdd.getNumPartitions() > 1


def test_the_folders_of_a_table_share_their_jobs(zone):
    """A table's objects in many folders: as many jobs as for one folder, and each folder's partitions stay apart."""

    def jobs(group, first, folders):
        for i in range(40):
            zone.put(f"datasets/set/{i % folders}/{first + i}.csv.gz", ["x,2022-01-05,f" if i == 7 else f"{i},2022-01-05,f"] if i != 9 else [], START + first + i)
        zone.spark.sparkContext.setJobGroup(group, group)
        loads = [(first + i, f"{zone.layout.incoming}datasets/set/{i % folders}/{first + i}.csv.gz", f"{zone.layout.lake}datasets/set/{i % folders}", [("identifier", f"{first + i}.csv.gz")]) for i in range(40)]
        kinds = "id long, source_path string, destination_path string, partition_columns array<struct<name: string, value: string>>"
        plan = zone.spark.createDataFrame(loads, kinds).coalesce(1).withColumns({c: F.lit("set") for c in ("source_table_name", "destination_table_name")})
        failed, waiting = land_routed(zone.spark, plan, zone.registry, False, Limits(concurrent_tables=1), f"{zone.layout.lake}_landing")
        assert [r["id"] for r in failed.collect()] == [first + 7] and waiting.count() == 0

    tracker = zone.spark.sparkContext._jsc.sc().dagScheduler()
    counts = []
    for first, folders in ((0, 1), (100, 1), (200, 20)):  # the first warms up
        before = tracker.nextJobId()
        jobs(f"folders-{first}", first, folders)
        counts.append(tracker.nextJobId() - before)
    assert counts[2] <= counts[1] + 2
    landed = zone.spark.read.option("recursiveFileLookup", True).parquet(f"{zone.layout.lake}datasets/set")
    paths = {r[0] for r in landed.select(F.regexp_extract("_metadata.file_path", "/set/(.*)/[^/]*$", 1)).collect()}
    assert {f"{i % 20}/identifier={200 + i}.csv.gz" for i in range(40) if i not in (7, 9)} <= paths
    assert landed.count() == 3 * 38 and os.listdir(f"{zone.layout.lake}_landing") == []


def test_bodies_of_a_feed_are_parsed_once_and_by_many_tasks(zone):
    one = '{"id":"first","dataset_id":"d1","url":"https://h.example.com/a","start_date":"2022-05-17","end_date":"2022-05-17","last_updated":"2022-05-18T12:12:24.000001"}'
    bodies = zone.spark.range(200).selectExpr("id % 3 as feed_id", "id as arrival", f"""'{{"success":true,"results":[{one}]}}' as body""").coalesce(1)
    fetched = run_feed_sync(zone.store, bodies)
    assert fetched.count() == 200 and zone.store.read("datasets").count() == 1
    assert "from_json" not in fetched._jdf.queryExecution().optimizedPlan().toString()
    assert len({r[0] for r in fetched.select(F.col("_metadata.file_path")).collect()}) > 1


def test_objects_are_written_by_all_tasks(spark, tmp_path):
    files = spark.createDataFrame([(f"ods/T1/{i}.csv.gz", "a,b") for i in range(40)], "s3_key string, body string").coalesce(1)
    context = spark.sparkContext
    context.setJobGroup("deliver-test", "deliver")
    try:
        deliver(files, str(tmp_path))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [tracker.getStageInfo(s) for job in tracker.getJobIdsForGroup("deliver-test") for s in tracker.getJobInfo(job).stageIds]
    assert max(stage.numTasks for stage in stages if stage) == 2 * context.defaultParallelism
    assert len(list(tmp_path.glob("ods/T1/*.csv.gz"))) == 40


def test_paths_are_listed_by_few_tasks(spark, tmp_path):
    """However many files a read has, listing them takes a few tasks for each core, not one for each file."""
    paths = [f"{tmp_path}/{i}.csv" for i in range(100)]
    for path in paths:
        with open(path, "w") as out:
            out.write("a\n")
    context = spark.sparkContext
    context.setJobGroup("listing-test", "listing")
    try:
        assert spark.read.schema("t string").csv(paths).count() == 100
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [tracker.getStageInfo(s) for job in tracker.getJobIdsForGroup("listing-test") for s in tracker.getJobInfo(job).stageIds]
    assert max(stage.numTasks for stage in stages if stage) <= 4 * context.defaultParallelism


def test_reads_of_one_table_run_side_by_side_and_loads_of_a_path_share_one(zone, monkeypatch):
    kinds = "id long, source_path string, destination_path string, partition_columns array<struct<name: string, value: string>>"
    loads = [(i, f"{zone.layout.incoming}datasets/set/{i % 8}.csv.gz", f"{zone.layout.lake}datasets/set", [("identifier", f"{i % 8}.csv.gz")]) for i in range(11)]
    plan = zone.spark.createDataFrame(loads, kinds).withColumns({c: F.lit("set") for c in ("source_table_name", "destination_table_name")})
    together, seen = threading.Barrier(2), []

    def landed(spark, some, columns, fields, header, staging):
        together.wait(60)
        seen.append([c["source_path"] for c in some])
        return [], [c["id"] for c in some]

    monkeypatch.setattr(load_pass, "land_table", landed)
    failed, waiting = land_routed(zone.spark, plan, zone.registry, False, Limits(read_files=5, concurrent_tables=2), f"{zone.layout.lake}_landing")
    assert failed.count() == 0 and sorted(r["id"] for r in waiting.collect()) == list(range(11))
    assert len(seen) == 2 and not set(seen[0]) & set(seen[1])


def test_a_staging_folder_that_cannot_be_written_condemns_no_load(zone):
    zone.put("datasets/set/1.csv.gz", ["5,2022-01-05,f"], START)
    zone.put("datasets/set/2.csv.gz", ["x,2022-01-05,f"], START)
    os.makedirs(zone.layout.lake)
    open(f"{zone.layout.lake}_landing", "w").close()
    zone.run()
    assert {key[-8]: status for (key, _), status in zone.statuses().items()} == {"1": "ingesting", "2": "ready_for_erroring"}
