"""Operators on small tables with known answers."""

import datetime as dt
import glob
import json
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from lakeload import functions as fn
from lakeload.operators import batching, casting, discover, feeds, landing, ledger, relocate, routing, status_fold
from lakeload.runtime import lookup_join
from lakeload.sources import catalog, feed_bodies, manifest, payload

NOON = dt.datetime(2022, 1, 1, 12)


def at(hours):
    return NOON + dt.timedelta(hours=hours)


def values(df, *columns):
    return [tuple(r) if len(columns) != 1 else r[0] for r in df.select(*columns).collect()]


# ---- casting and landing ----------------------------------------------------
FIELDS = [
    {"name": "string_col", "type": "string"},
    {"name": "bigint_col", "type": "long"},
    {"name": "double_col", "type": "double"},
    {"name": "date_col", "type": "date"},
    {"name": "timestamp_col", "type": "timestamp"},
]


def test_cast_to_schema_selects_by_name_and_types(spark):
    df = spark.createDataFrame(
        [("x", "2022-01-01 12:34:56", "2022-01-01", "123.45", "123", " ")],
        "extra string, timestamp_col string, date_col string, double_col string, bigint_col string, string_col string",
    )
    out = casting.cast_to_schema(df, FIELDS)
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in out.schema.fields] == [
        ("string_col", "string", True),
        ("bigint_col", "bigint", True),
        ("double_col", "double", True),
        ("date_col", "date", True),
        ("timestamp_col", "timestamp", True),
    ]
    row = out.withColumn("timestamp_col", F.col("timestamp_col").cast("string")).first()
    assert tuple(row) == (" ", 123, 123.45, dt.date(2022, 1, 1), "2022-01-01 12:34:56")


def test_a_missing_column_fails(spark):
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        casting.cast_to_schema(spark.createDataFrame([("1",)], "a string"), [{"name": "b", "type": "long"}]).collect()


def test_rejects_list_every_bad_value(spark):
    df = spark.createDataFrame([(1, "1", "x"), (2, "a", "2022-01-01"), (3, " ", None), (4, "b", "y")], "k int, n string, d string")
    fields = [{"name": "n", "type": "long"}, {"name": "d", "type": "date"}]
    found = casting.cast_rejects(df, fields, keep=["k"]).collect()
    assert sorted(map(tuple, found)) == [
        (1, "d", "date", "x"),
        (2, "n", "long", "a"),
        (4, "d", "date", "y"),
        (4, "n", "long", "b"),
    ]
    assert values(casting.cast_to_schema(df, fields, mode="lenient"), "n") == [1, None, None, None]


def test_landing_replaces_only_the_partitions_written(spark, tmp_path):
    path, names = f"{tmp_path}/t", ["snapshot", "identifier"]

    def write(rows, snapshot, identifier):
        df = spark.createDataFrame(rows, "name string, date string")
        landing.land(landing.with_partition_literals(df, [("snapshot", snapshot), ("identifier", identifier)]), path, names)
        return sorted(map(tuple, landing.read_landed(spark, path, names).collect()))

    assert write([("a", "1")], "s1", "0012") == [("a", "1", "s1", "0012")]
    assert write([("b", "2")], "s2", "0013") == [("a", "1", "s1", "0012"), ("b", "2", "s2", "0013")]
    assert write([("c", "3")], "s1", "0012") == [("b", "2", "s2", "0013"), ("c", "3", "s1", "0012")]


def test_landing_empties_expected_partitions_without_rows(spark, tmp_path):
    lake, names = str(tmp_path / "lake"), ["day", "part"]
    rows = [(1, "a b", "x=1"), (2, "c/d", "y"), (3, "kept", "z"), (4, None, "n")]
    df = spark.createDataFrame(rows, "v int, day string, part string")
    landing.land(df, lake, names)
    again = df.where("v = 1").withColumn("v", F.lit(9))
    landing.land(again, lake, names, expected=[("a b", "x=1"), ("c/d", "y"), (None, "n"), ("never", "there")])
    assert sorted(map(tuple, landing.read_landed(spark, lake, names).collect())) == [(3, "kept", "z"), (9, "a b", "x=1")]


def test_rebalanced_landing_writes_the_same_rows(spark, tmp_path):
    df = spark.range(0, 1000, 1, 8).select("id", F.when(F.col("id") % 10 < 7, "hot").otherwise("cold").alias("identifier"))
    landing.land(df, f"{tmp_path}/t", ["identifier"], rebalance=True, max_records_per_file=300)
    assert sorted(map(tuple, landing.read_landed(spark, f"{tmp_path}/t", ["identifier"]).collect())) == sorted(map(tuple, df.collect()))


def test_landing_without_partitions_replaces_everything(spark, tmp_path):
    path = f"{tmp_path}/t"
    for name in ("a", "b"):
        landing.land(spark.createDataFrame([(name,)], "name string"), path)
    assert values(spark.read.parquet(path), "name") == ["b"]


def test_staged_loads_replace_their_partitions(spark, tmp_path):
    staging, lake = f"{tmp_path}/staging", f"{tmp_path}/lake"
    at = lambda load: landing.partition_folder(lake, ["part"], [load])
    os.makedirs(at("4"))
    os.makedirs(at("1"))
    open(f"{at('1')}/old.parquet", "w").close()
    # loads 1 and 2 come mixed and in several tasks, 3 has a bad row, 4 has none
    rows = spark.range(0, 900, 1, 3).selectExpr(
        "if(id % 10 = 0, 3, 1 + id % 2) __id", "id = 450 __bad", "id n", "if(id % 7 = 0, null, concat('t', id)) `a text`", "date'0999-01-01' day", "timestamp_micros(id * 1000001) at"
    )
    staged = landing.stage_loads(rows, staging, "__id", "__bad")
    assert {load: bad for load, (bad, _) in staged.items()} == {1: False, 2: False, 3: True}
    assert len(staged[1][1]) == 3
    # what a lost attempt of a task left behind does not count
    os.makedirs(f"{staging}/lost/load=1")
    shutil.copy(glob.glob(f"{staged[1][1][0]}/*.parquet")[0], f"{staging}/lost/load=1")
    for _ in range(2):  # the second time nothing is left to move
        landing.place_loads(spark, [(at("1"), staged[1][1]), (at("2"), staged[2][1]), (at("4"), [])])
        back = landing.read_landed(spark, lake, ["part"])
        assert back.drop("part").dtypes == rows.drop("__id", "__bad").dtypes
        expected = rows.where("__id < 3").selectExpr("n", "`a text`", "day", "at", "string(__id) part")
        assert sorted(map(str, back.collect())) == sorted(map(str, expected.collect()))
        assert sorted(os.listdir(lake)) == ["part=1", "part=2"]


def test_partition_folders_are_named_as_spark_names_them(spark):
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    text = "".join(map(chr, range(1, 128))) + "äé€"
    assert landing.partition_folder("lake/", [text], [text]) == f"lake/{escape(text)}={escape(text)}"
    assert landing.partition_folder("lake", ["a", "b"], [None, ""]) == "lake/a=__HIVE_DEFAULT_PARTITION__/b=__HIVE_DEFAULT_PARTITION__"


# ---- keys, checks -----------------------------------------------------------
def test_path_functions(spark):
    df = spark.createDataFrame([("a/b/c.csv.gz",), ("c.csv.gz",), ("a/b__ct/",), ("a/c.csv",)], "k string")
    k = F.col("k")
    out = df.select(fn.dir_name(k), fn.base_name(k, ".csv.gz"), fn.root_name(k), fn.swap_suffix(k, "__ct/", "/"), fn.drop_prefix(k, "a/"))
    assert [tuple(r) for r in out.collect()] == [
        ("a/b", "c", "a/b/c", "a/b/c.csv.gz", "b/c.csv.gz"),
        (".", "c", "c", "c.csv.gz", "c.csv.gz"),
        ("a/b__ct", "", "a/b__ct/", "a/b/", "b__ct/"),
        ("a", "c.csv", "a/c.csv", "a/c.csv", "c.csv"),
    ]


def test_checks(spark):
    def check(make, texts):
        rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
        return [r[0] for r in rows.orderBy("i").select(make(F.col("s"))).collect()]

    assert check(fn.valid_iso_date, ["2022-01-01", "20220101", "2022-02-30", "2022-1-1", "2022-01-01 ", None]) == [
        True, False, False, False, False, False,
    ]
    texts = ["2022-01-01T00:00:00.000000", "20220101 00:00:00", "2022-05-01 10:49:50.123456Z", "2022-01-01", "2022-13-01T00:00:00"]
    assert check(fn.valid_iso_datetime, texts) == [True, False, True, False, False]
    urls = ["https://feeds/sample", "http://feeds/sample", "https://feeds", "https://feeds/", "HTTPS://h/a?b", "https://h?x=/a", ""]
    assert check(fn.valid_url, urls) == [True, False, False, False, True, False, False]


def test_data_objects(spark):
    rows = [("a/L.csv.gz", 1), ("a/L.csv.gz", 0), ("a/L.csv.gz", None), ("a/", 1), (None, 1), ("a/L.dfm", 5)]
    df = spark.createDataFrame(rows, "k string, n bigint")
    assert [r[0] for r in df.select(fn.is_data_object(F.col("k"), F.col("n"))).collect()] == [True, True, False, False, False, False]


# ---- batches ----------------------------------------------------------------
def batches(spark, sizes, max_num, max_bytes, ids=None):
    ids = ids or list(range(1, len(sizes) + 1))
    df = spark.createDataFrame(list(zip(ids, sizes)), "id bigint, s3_size bigint")
    out = {}
    for row in batching.chunk_loads(df, max_num, max_bytes, by=None).collect():
        out.setdefault(row["batch_no"], []).append(row["id"])
    return [sorted(out[n]) for n in sorted(out)]


def brute_force(sizes, ids, max_num, max_bytes):
    out, held = [], 0
    for load, size in sorted(zip(ids, sizes)):
        if not out or len(out[-1]) == max_num or held + size > max_bytes:
            out.append([])
            held = 0
        out[-1].append(load)
        held += size
    return out


def test_batches_by_count_and_by_bytes(spark):
    assert batches(spark, [12, 34, 56, 78, 90], 2, 1000) == [[1, 2], [3, 4], [5]]
    assert batches(spark, [123, 456, 789, 1000, 1112], 3, 1000) == [[1, 2], [3], [4], [5]]
    assert batches(spark, [5000, 1], 3, 1000) == [[1], [2]]


@pytest.mark.parametrize("block", [1, 3, 7, 64])
def test_batches_over_many_blocks_equal_one_walk(spark, monkeypatch, block):
    monkeypatch.setattr(batching, "BLOCK_IDS", block)
    rng = random.Random(block)
    ids = sorted(rng.sample(range(1, 500), 150))
    sizes = [rng.choice([0, 1, 5, 40, 90, 120]) for _ in ids]
    for max_num, max_bytes in ((4, 100), (1, 50), (10, 1000), (200, 100), (5, 0)):
        assert batches(spark, sizes, max_num, max_bytes, ids) == brute_force(sizes, ids, max_num, max_bytes)


def test_a_group_of_many_blocks_is_joined_in_a_tree(spark):
    rng = random.Random(5)
    ids = sorted(rng.sample(range(1, 40_000), 3000))
    sizes = [rng.choice([0, 1, 5, 40, 90, 120]) for _ in ids]
    df = spark.createDataFrame(list(zip(ids, sizes)), "id bigint, s3_size bigint")
    found = {}
    for row in batching.chunk_loads(df, 7, 300, by=None, block_ids=5).collect():
        found.setdefault(row["batch_no"], []).append(row["id"])
    assert [sorted(found[n]) for n in sorted(found)] == brute_force(sizes, ids, 7, 300)
    assert batching.tree_levels(0, 63) == 1 and batching.tree_levels(0, 64) == 2 and batching.tree_levels(-1, 64**3) == 4
    assert batching.chunk_loads(df.limit(0), 7, 300, by=None).count() == 0


def test_blocks_compose_like_functions():
    rng = random.Random(6)

    def block(sizes):
        starts = []
        for first in range(min(4, len(sizes))):
            cut = brute_force(sizes[first:], range(len(sizes) - first), 4, 100)
            starts.append((len(cut), len(cut[-1]), sum(sizes[first:][i] for i in cut[-1])))
        batches, counts, held = (list(x) for x in zip(*starts))
        return {"rows": len(sizes), "total": sum(sizes), "head": sizes[:4], "batches": batches, "open_count": counts, "open_bytes": held}

    for _ in range(200):
        a, b, c = ([rng.choice([0, 10, 40, 90, 120]) for _ in range(rng.randint(1, 6))] for _ in range(3))
        left = batching.joined_blocks(batching.joined_blocks(block(a), block(b), 4, 100), block(c), 4, 100)
        right = batching.joined_blocks(block(a), batching.joined_blocks(block(b), block(c), 4, 100), 4, 100)
        assert left == right == block(a + b + c)


# ---- ledger -----------------------------------------------------------------
def loads_df(spark, rows):
    return spark.createDataFrame(
        [(i, t, s, k, at(h), n, False, None) for i, t, s, k, h, n in rows],
        "id bigint, table_id bigint, status string, s3_key string, s3_modified timestamp, s3_size bigint, is_raw boolean, deleted_at timestamp",
    )


def tables_df(spark, rows):
    return spark.createDataFrame(
        [(i, n, p, raw, active, None) for i, n, p, raw, active in rows],
        "id bigint, name string, s3_prefix string, is_raw boolean, is_active boolean, deleted_at timestamp",
    )


def test_ready_loads_restart_at_the_last_snapshot_load(spark):
    tables = tables_df(spark, [(1, "d", "datasets/d/", False, True), (2, "o", "ods/O/", True, True)])
    snapshots = spark.createDataFrame([(2, None, "ods/O/LOAD1.csv.gz")], "table_id bigint, snapshot timestamp, snapshot_s3_key string")

    def ready(*rows):
        found = ledger.ready_loads(loads_df(spark, rows), tables, snapshots)
        return sorted(values(found, "id"))

    first = (1, 2, "ready", "ods/O/LOAD1.csv.gz", 0, 1)
    second = (2, 2, "ready", "ods/O/LOAD2.csv.gz", 1, 1)
    again = (3, 2, "ready", "ods/O/LOAD1.csv.gz", 2, 1)
    assert ready(first, second) == [1, 2]
    assert ready(first, second, again) == [3]
    assert ready(second) == []
    assert ready((4, 1, "ready", "datasets/d/1.csv.gz", 0, 1), (5, 1, "archived", "datasets/d/2.csv.gz", 0, 1)) == [4]


def test_ready_loads_limit_is_per_table_and_oldest_first(spark):
    tables = tables_df(spark, [(1, "a", "datasets/a/", False, True), (2, "b", "datasets/b/", False, None)])
    none = spark.createDataFrame([], "table_id bigint, snapshot timestamp, snapshot_s3_key string")
    loads = loads_df(spark, [(i, 1 + i % 2, "ready", f"k{i}", 10 - i, 1) for i in range(8)])
    assert sorted(values(ledger.ready_loads(loads, tables, none, per_table=2), "id")) == [4, 5, 6, 7]


def test_first_per_group_beyond_the_pushed_limit(spark, monkeypatch):
    df = spark.range(4000).select((F.col("id") % 3 == 0).cast("int").alias("g"), F.col("id").alias("v"))
    want = sorted(map(tuple, ledger.first_per_group(df, ["g"], ["v"], 900).collect()))
    monkeypatch.setattr(ledger, "PUSHED_LIMIT", 10)
    assert sorted(map(tuple, ledger.first_per_group(df, ["g"], ["v"], 900).collect())) == want
    assert len(want) == 1800


def test_find_one_wants_exactly_one(spark):
    tables = tables_df(spark, [(1, "a", "p/", False, True), (2, "b", "q/", None, None)])
    assert values(ledger.find_one(tables, name="a"), "id") == [1]
    assert values(ledger.find(tables, is_raw=None), "id") == [2]
    assert ledger.find_one(tables, name="a").columns == tables.columns
    for clauses in ({"name": "c"}, {"deleted_at": None}):  # none, and two; the plan alone is no error
        found = ledger.find_one(tables, **clauses)
        with pytest.raises(Exception, match="expected one row"):
            found.collect()


def test_status_walk(spark):
    log = spark.createDataFrame(
        [(1, "ready", at(0), 1), (1, "ingesting", at(1), 2), (2, "erroring", at(0), 1), (2, "errored", at(0), 2)],
        "load_id bigint, status string, at timestamp, seq bigint",
    )
    current = ledger.current_status(log)
    events = spark.createDataFrame([(1, "finish"), (2, "moved")], "load_id bigint, event string")
    moved = ledger.transition(current, events)
    assert values(ledger.accepted(moved), "load_id", "next_status") == [(1, "ready_for_archiving")]
    assert values(ledger.rejected(moved), "load_id") == [2]


def walked(status, events):
    out = []
    for at_, seq, event in sorted(events):
        following = ledger.TRANSITIONS.get((status, event))
        out.append((seq, event, status, following))
        status = following or status
    return out, status


def test_many_events_fold_like_a_walk(spark):
    rng = random.Random(3)
    names = [*sorted(status_fold.EVENT_MAPS), "unheard of", None]
    # one load has most of the events, one no status, one no events
    events = [(rng.choice([1, 1, 1, 2, 3, 4]), rng.choice(names[:-1]), i // 3, i) for i in range(6000)]
    df = spark.createDataFrame(events, "load_id bigint, event string, at bigint, seq bigint").repartition(5)
    current = spark.createDataFrame([(1, "ready"), (2, "archiving"), (3, "errored_unknown"), (5, "ready")], "load_id bigint, status string")
    folded = status_fold.fold_events(current, df.withColumn("at", F.timestamp_seconds("at")))
    got = {}
    for row in folded.collect():
        got.setdefault(row["load_id"], []).append((row["seq"], row["event"], row["status"], row["next_status"]))
    ends = {}
    for load, status in ((1, "ready"), (2, "archiving"), (3, "errored_unknown"), (4, None)):
        want, ends[load] = walked(status, [(a, s, e) for i, e, a, s in events if i == load])
        assert sorted(got[load]) == want
    final = {r["load_id"]: r for r in status_fold.folded_status(current, folded).collect()}
    assert {i: final[i]["status"] for i in (1, 2, 3)} == {i: ends[i] for i in (1, 2, 3)}
    assert (final[5]["status"], final[5]["applied"], final[5]["rejected"]) == ("ready", 0, 0)
    assert status_fold.fold_events(current, df.limit(0).withColumn("at", F.timestamp_seconds("at"))).count() == 0


def test_stuck_loads(spark):
    rows = [(i, 1, s, "k", 0, 1) for i, s in enumerate(["archiving", "archived_unknown", "erroring", "errored_unknown", "ready"])]
    found = ledger.stuck_loads(loads_df(spark, rows))
    assert sorted(values(found, "id", "action")) == [(0, "archive"), (1, "archive"), (2, "error"), (3, "error")]


def test_lookup_join_gives_the_same_rows_either_way(spark):
    big = spark.createDataFrame([(i % 3, i) for i in range(60)], "k bigint, v bigint")
    small = spark.createDataFrame([(0, "a"), (1, "b")], "k bigint, name string")
    few, many = (lookup_join(big, small, "k", "left", bounded_by=b) for b in (True, False))
    assert sorted(map(repr, few.collect())) == sorted(map(repr, many.collect()))
    few, many = (lookup_join(big, small, "k", "inner", bounded_by=b) for b in (small, None))
    assert sorted(map(repr, few.collect())) == sorted(map(repr, many.collect()))


# ---- discovery --------------------------------------------------------------
def objects_df(spark, rows):
    return spark.createDataFrame([(t, k, at(h), n) for t, k, h, n in rows], "table_id bigint, key string, last_modified timestamp, size bigint")


def test_prefixes_match_active_tables(spark):
    tables = tables_df(
        spark, [(1, "a", "ods/A/", True, True), (2, "b", "datasets/b/", False, True), (3, "c", "ods/C/", True, False), (4, "d", "ods/D/", True, None)]
    )
    keys = ["ods/A/1", "ods/A/2", "ods/A__ct/1", "ods/C/1", "ods/D__ct/1", "datasets/b/1", "datasets/x/1", "other/A/1", "ods/loose"]
    objects = spark.createDataFrame([(k,) for k in keys], "key string")
    prefixes = discover.list_prefixes(objects, ["ods/", "datasets/"])
    assert sorted(values(prefixes, "prefix")) == ["datasets/b/", "datasets/x/", "ods/A/", "ods/A__ct/", "ods/C/", "ods/D__ct/"]
    assert sorted(values(discover.match_prefixes(prefixes, tables), "prefix", "table_id")) == [
        ("datasets/b/", 2), ("ods/A/", 1), ("ods/A__ct/", 1),
    ]


def test_new_objects_are_strictly_newer_and_limited(spark):
    objects = objects_df(spark, [(1, "a/1", 0, 1), (1, "a/2", 1, 1), (1, "a/3", 2, 1), (2, "b/1", -9, 1), (1, "a__ct/1", 3, 1)])
    done = spark.createDataFrame([(1, "a/1", at(0), None)], "table_id bigint, s3_key string, s3_modified timestamp, deleted_at timestamp")
    assert sorted(values(discover.new_objects(objects, done), "key")) == ["a/2", "a/3", "a__ct/1", "b/1"]
    assert sorted(values(discover.new_objects(objects, done, per_prefix=1), "key")) == ["a/2", "a__ct/1", "b/1"]
    late = objects_df(spark, [(1, "a/1", 0, 1), (1, "a/0", -5, 1)])
    assert values(discover.unseen_objects(late, done), "key") == ["a/0"]


def test_status_of_new_loads(spark):
    tables = tables_df(spark, [(1, "d", "datasets/d/", False, True), (2, "o", "ods/O/", True, True)])

    def statuses(stored, *rows):
        snapshots = spark.createDataFrame([(2, stored, "ods/O/LOAD1.csv.gz")], "table_id bigint, snapshot timestamp, snapshot_s3_key string")
        found = discover.new_load_rows(objects_df(spark, rows), tables, snapshots)
        return sorted(values(found, "s3_key", "status", "is_raw"))

    assert statuses(None, (1, "datasets/d/1", 0, 5), (1, "datasets/d/2", 0, 0)) == [
        ("datasets/d/1", "ready", False), ("datasets/d/2", "ready_for_erroring", False),
    ]
    assert statuses(None, (2, "ods/O/LOAD2.csv.gz", 0, 5)) == [("ods/O/LOAD2.csv.gz", "ready_for_erroring", True)]
    assert statuses(None, (2, "ods/O/LOAD1.csv.gz", 0, 5), (2, "ods/O/LOAD2.csv.gz", 0, 5), (2, "ods/O/LOAD3.csv.gz", 0, 0)) == [
        ("ods/O/LOAD1.csv.gz", "ready", True), ("ods/O/LOAD2.csv.gz", "ready", True), ("ods/O/LOAD3.csv.gz", "ready_for_erroring", True),
    ]


def test_load_ids_are_dense_and_rise(spark, tmp_path):
    rows = spark.range(1000).select((F.col("id") % 3).alias("table_id"), F.concat(F.lit("k"), "id").alias("s3_key"), F.timestamp_seconds(F.col("id") % 7).alias("s3_modified"))
    for in_order in (False, True):
        path = str(tmp_path / str(in_order))
        discover.with_row_places(rows.repartition(6), in_order).write.parquet(path)
        numbered = discover.dense_load_ids(spark.read.parquet(path), 41)
        found = numbered.orderBy("id").collect()
        assert [r["id"] for r in found] == list(range(42, 1042)) and numbered.columns == ["table_id", "s3_key", "s3_modified", "id"]
        keys = [(r["table_id"], r["s3_key"]) for r in found]
        assert len(set(keys)) == 1000 and (not in_order or keys == sorted(keys))
    empty = str(tmp_path / "empty")
    discover.with_row_places(rows.limit(0)).write.parquet(empty)
    assert discover.dense_load_ids(spark.read.parquet(empty), 41).count() == 0


def test_snapshot_fold_equals_the_ordered_walk(spark):
    rng = random.Random(3)
    stored = {1: at(-50), 2: None}
    rows = []
    for n in range(200):
        table = rng.choice([1, 2, 3])
        key = rng.choice([f"ods/{table}/A{n}", f"ods/{table}/LOAD1", f"ods/{table}/Z{n}", f"ods/{table}__ct/{n}"])
        rows.append((n, table, key, rng.randint(0, 90), 1))
    objects = spark.createDataFrame([(i, t, k, at(h), s) for i, t, k, h, s in rows], "id bigint, table_id bigint, key string, last_modified timestamp, size bigint")
    snapshots = spark.createDataFrame([(t, s, f"ods/{t}/LOAD1") for t, s in stored.items()], "table_id bigint, snapshot timestamp, snapshot_s3_key string")
    expected, running = {}, dict(stored)
    for i, t, k, h, _ in sorted(rows, key=lambda r: (r[2], r[3])):
        if t in running and k == f"ods/{t}/LOAD1":
            running[t] = at(h)
        expected[i] = running.get(t)
    got = discover.snapshot_fold(objects, snapshots).select("id", F.col("snapshot").cast("timestamp_ntz").alias("s")).collect()
    assert {r["id"]: r["s"] for r in got} == expected


# ---- routes and moves -------------------------------------------------------
def route(spark, key, raw):
    df = spark.createDataFrame([(7, key, raw, "ods__sample")], "id bigint, s3_key string, is_raw boolean, table_name string")
    latest = spark.createDataFrame([(7, at(0))], "load_id bigint, snapshot timestamp")
    out = routing.routed_partitions(routing.route_loads(df, routing.Layout("s3://in/p/", "s3a://lake/p/")), latest).first()
    pairs = [tuple(p) for p in out["partition_columns"]]
    return out["source_table_name"], out["destination_table_name"], out["source_path"], out["destination_path"], pairs


def test_routes(spark):
    assert route(spark, "ods/SAMPLE/LOAD1.csv.gz", True) == (
        "ods__sample", "raw_ods__sample", "s3://in/p/ods/SAMPLE/LOAD1.csv.gz", "s3a://lake/p/raw/ods/SAMPLE",
        [("snapshot", "20220101T120000Z"), ("identifier", "LOAD1.csv.gz")],
    )
    assert route(spark, "ods/SAMPLE__ct/2.csv.gz", True)[:2] == ("ods__sample__ct", "raw_ods__sample__ct")
    assert route(spark, "datasets/s/1.csv.gz", None) == (
        "ods__sample", "ods__sample", "s3://in/p/datasets/s/1.csv.gz", "s3a://lake/p/datasets/s", [("identifier", "1.csv.gz")],
    )


def test_a_replicated_load_without_snapshot_is_an_error(spark):
    df = spark.createDataFrame([(7, "ods/S/1.csv.gz", None)], "id bigint, s3_key string, snapshot timestamp")
    with pytest.raises(Exception, match="no snapshot for load 7"):
        df.select(routing.archive_root()).collect()


def test_archive_and_error_keys(spark):
    df = spark.createDataFrame(
        [(1, "ods/S/LOAD1.csv.gz", at(0), at(1)), (2, "datasets/s/1.csv.gz", at(0), None)],
        "id bigint, s3_key string, s3_modified timestamp, snapshot timestamp",
    )
    assert values(df, routing.archive_root()) == ["ods/S/snapshot=20220101T130000Z/LOAD1", "datasets/s/1"]
    assert values(df, routing.error_root()) == ["ods/S/timestamp=20220101T120000Z/LOAD1", "datasets/s/1"]
    pairs = routing.move_pairs(df, routing.error_root())
    assert sorted(values(pairs, "source_key")) == ["datasets/s/1.csv.gz", "ods/S/LOAD1.csv.gz", "ods/S/LOAD1.dfm"]


def test_relocate_moves_and_can_be_repeated(spark, tmp_path):
    here, there = tmp_path / "in", tmp_path / "out"
    for name in ("move", "copied", "gone_copied", "missing"):
        (here / "a").mkdir(parents=True, exist_ok=True)
        (there / "b").mkdir(parents=True, exist_ok=True)
    (here / "a" / "move").write_text("1")
    (here / "a" / "copied").write_text("2")
    (there / "b" / "copied").write_text("2")
    (there / "b" / "gone_copied").write_text("3")
    names = ["move", "copied", "gone_copied", "missing"]
    pairs = spark.createDataFrame([(i, f"a/{n}", f"b/{n}") for i, n in enumerate(names)], "id bigint, source_key string, destination_key string")

    def run():
        rows = relocate.relocate(pairs, str(here), str(there)).collect()
        return {r["id"]: (r["outcome"], r["ok"]) for r in rows}

    assert run() == {0: ("copy_then_delete", True), 1: ("delete_source", True), 2: ("already_copied", True), 3: ("source not found", False)}
    assert not list((here / "a").iterdir())
    assert (there / "b" / "move").read_text() == "1"
    assert [run()[i][1] for i in range(4)] == [True, True, True, False]


# ---- sidecars, catalogs, payloads, feeds ------------------------------------
def test_sidecar_columns_from_files(spark, tmp_path):
    text = '{"dfmVersion": "1.1",\n "dataInfo": {"columns": [\n {"ordinal": 1, "name": "SAMPLE_ID", "type": "INT4"}, {"ordinal": 2, "name": "Name"}]}}'
    (tmp_path / "LOAD1.dfm").write_text(text)
    sidecars = manifest.read_sidecars(spark, f"{tmp_path}/*.dfm").withColumn("sidecar_key", F.lit("ods/S/LOAD1.dfm"))
    whole = manifest.parsed_sidecars(sidecars).select("sidecar.dfmVersion", "sidecar.dataInfo.columns.type").first()
    assert tuple(whole) == ("1.1", ["INT4", None])
    loads = spark.createDataFrame([(1, "ods/S/LOAD1.csv.gz"), (2, "ods/S/LOAD2.csv.gz")], "id bigint, s3_key string")
    found = manifest.load_manifest_columns(loads, sidecars)
    assert sorted(values(found, "id", "manifest_columns")) == [(1, ["sample_id", "name"]), (2, [])]


def test_catalog_types_and_columns(spark):
    kinds = ["string", "bigint", "double", "date", "timestamp", "array<int>"]
    rows = [("t", i, f"c{i}", k) for i, k in enumerate(kinds)] + [("t__ct", 0, "z", "string")]
    registry = spark.createDataFrame(rows, "table_name string, ordinal int, column_name string, column_type string")
    assert [f["type"] for f in catalog.fields_of(registry, "t")] == ["string", "long", "double", "date", "timestamp", "string"]
    loads = spark.createDataFrame([(1, "ods/T/1", "t"), (2, "ods/T__ct/1", "t"), (3, "x/1", "u")], "id bigint, s3_key string, table_name string")
    found = catalog.load_catalog_columns(loads, registry)
    assert sorted(values(found, "id", "catalog_columns"), key=str) == [(1, [f"c{i}" for i in range(6)]), (2, ["z"]), (3, None)]


def test_payload_that_is_not_json_fails(spark):
    good = '{"loads": [{"id": 1, "partition_columns": [{"name": "identifier", "value": "x"}]}]}'
    rows = payload.payload_loads(spark.createDataFrame([(good,), ("{}",)], "payload string"))
    assert values(rows, "id") == [1]
    with pytest.raises(Exception, match="MALFORMED"):
        payload.payload_loads(spark.createDataFrame([("{bad",)], "payload string")).collect()


VALID = {"id": "s", "dataset_id": "s_1", "url": "https://h/p", "start_date": "2022-05-17", "end_date": "2022-05-17", "last_updated": "2022-05-18T12:12:24.897363"}


def test_dataset_validity(spark):
    cases = [VALID, {k: v for k, v in VALID.items() if k != "url"}]
    cases += [{**VALID, k: v} for k, v in [("start_date", "2022:05:04"), ("end_date", "2022-45-04"), ("last_updated", "2022-05-18"), ("url", "http://h/p"), ("url", "https://h"), ("url", "https://h/")]]
    df = spark.createDataFrame([(i, c) for i, c in enumerate([*cases, {}])], "i int, dataset map<string,string>")
    assert values(feeds.valid_datasets(df), "i") == [0]


def test_feed_without_results(spark):
    df = spark.createDataFrame([(1, '{"success": false}'), (2, '{"success": true, "results": []}')], "feed_id bigint, body string")
    assert feed_bodies.feed_results(df).count() == 0


def test_upsert_keeps_the_stored_dates(spark):
    schema = "feed_id bigint, type string, identifier string, start_date date, end_date date, last_updated_at timestamp"
    day = dt.date(2022, 5, 17)
    stored = spark.createDataFrame([(1, "s", "s_1", day, day, at(0))], schema)
    other = dt.date(2022, 6, 1)
    incoming = spark.createDataFrame(
        [(1, "s", "s_1", other, other, at(1), 0), (1, "s", "s_2", day, day, at(5), 1), (2, "t", "s_2", other, other, at(3), 2)], schema + ", arrival int"
    )
    out = feeds.upsert_datasets(stored, incoming).withColumn("last_updated_at", F.col("last_updated_at").cast("timestamp_ntz"))
    assert sorted(map(tuple, out.collect())) == [(1, "s", "s_1", day, day, at(1)), (1, "s", "s_2", day, day, at(3))]


def test_upsert_orders_the_announcements_of_a_body(spark):
    def announced(identifier, kind, second):
        return {"id": kind, "dataset_id": identifier, "url": "https://h/x", "start_date": "2022-05-17", "end_date": "2022-05-17", "last_updated": f"2022-05-18T12:12:{second}Z"}

    bodies = [(1, 0, [announced("a", "first", "30"), announced("b", "other", "31"), announced("a", "last", "10")]), (1, 1, [announced("b", "late", "09")])]
    df = spark.createDataFrame([(f, n, json.dumps({"success": True, "results": r})) for f, n, r in bodies], "feed_id bigint, arrival int, body string")
    incoming = feeds.dataset_rows(feeds.valid_datasets(feed_bodies.feed_results(df.repartition(3))))
    stored = spark.createDataFrame([], "feed_id bigint, type string, identifier string, start_date date, end_date date, last_updated_at timestamp_ntz")
    found = {r["identifier"]: (r["type"], r["last_updated_at"].second) for r in feeds.upsert_datasets(stored, incoming).collect()}
    assert found == {"a": ("first", 10), "b": ("other", 9)}


def test_feed_watermark_and_requests(spark):
    feed = spark.createDataFrame(
        [(1, "/datasetpublicusersapi/a", dt.datetime(2022, 5, 22, 20, 49, 50, 123456)), (2, "/datasetcontrolleduserapi/b", None)],
        "id bigint, relative_url string, last_updated_at timestamp",
    )
    asked = feeds.feed_requests(feed, "https://b").select("access_class", "request_url", "last_updated").collect()
    assert sorted(map(tuple, asked)) == [
        ("controlled", "https://b/datasetcontrolleduserapi/b", None),
        ("public", "https://b/datasetpublicusersapi/a", "2022-05-22T20:49:50.123457"),
    ]
    forced = feeds.feed_requests(feed, "", F.lit("2022-05-01 10:49:50.123456Z"))
    assert set(values(forced, "last_updated")) == {"2022-05-01T10:49:50.123456"}
    datasets = spark.createDataFrame([(1, at(0)), (2, at(0)), (2, at(9))], "feed_id bigint, last_updated_at timestamp")

    def moved(back):
        out = feeds.feed_watermark(feed, datasets, back).select("id", F.col("last_updated_at").cast("timestamp_ntz"))
        return sorted(map(tuple, out.collect()))

    assert moved(False) == [(1, dt.datetime(2022, 5, 22, 20, 49, 50, 123456)), (2, at(9))]
    assert moved(True) == [(1, at(0)), (2, at(9))]
    with pytest.raises(Exception, match="no credential for feed"):
        feeds.feed_requests(spark.createDataFrame([(1, "/unknown", None)], feed.schema)).collect()


def test_a_lookup_that_is_not_small_is_never_broadcast(spark):
    big = spark.range(100).withColumn("k", F.col("id") % 10)
    lookup = spark.range(10).select(F.col("id").alias("k"), F.col("id").alias("v"))
    for one_each in (False, True):
        for how in ("left", "inner"):
            joined = lookup_join(big, lookup, "k", how, bounded_by=False, one_each=one_each)
            assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
            assert joined.where("k = v").count() == 100
    sidecars = spark.createDataFrame([("ods/a.dfm", '{"dataInfo":{"columns":[{"name":"A"}]}}')], "sidecar_key string, body string")
    found = manifest.load_manifest_columns(spark.createDataFrame([(1, "ods/a.csv.gz")], "id long, s3_key string"), sidecars)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.first()["manifest_columns"] == ["a"]


@pytest.mark.parametrize("rows", [7, 250_000])
def test_events_of_one_load_cross_ranges(spark, monkeypatch, rows):
    monkeypatch.setattr(status_fold, "RANGE_ROWS", rows)  # 7: far more ranges than tasks, of a few rows
    rng = random.Random(9)
    names = sorted(status_fold.EVENT_MAPS)
    events = [(rng.choice([1, 1, 1, 2, 3, 4, None]), rng.choice(names), i // 3, i) for i in range(900)]
    df = spark.createDataFrame(events, "load_id bigint, event string, at bigint, seq bigint").repartition(3).withColumn("at", F.timestamp_seconds("at"))
    current = spark.createDataFrame([(1, "ready"), (2, "no status of ours"), (3, None), (6, "ready")], "load_id bigint, status string")
    folded = status_fold.fold_events(current, df)
    got = {}
    for row in folded.collect():
        got.setdefault(row["load_id"], []).append((row["seq"], row["event"], row["status"], row["next_status"]))
    for load, status in ((1, "ready"), (2, "no status of ours"), (3, None), (4, None), (None, None)):
        assert sorted(got[load]) == walked(status, [(a, s, e) for i, e, a, s in events if i == load])[0]
    if rows == 7:  # the hot load alone is spread over many ranges
        assert max(r["count"] for r in folded.groupBy(F.shiftright("place", 40)).count().collect()) < 50
