"""The schema gate on real sidecars, and what registration takes and refuses."""

import pytest

from lakeload.operators import registration, schema_gate
from lakeload.operators.routing import Layout
from lakeload.plans.register import run_registration
from lakeload.plans.store import LedgerStore

CANDIDATE = "name string, s3_prefix string, is_raw boolean"


@pytest.fixture
def store(spark, tmp_path):
    return LedgerStore(spark, f"{tmp_path}/ledger")


def gate(spark, tmp_path, bodies, loads, columns=("n", "day")):
    for key, body in bodies.items():
        path = tmp_path / "incoming" / key
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(body)
    registry = spark.createDataFrame([("t", i, c, "bigint") for i, c in enumerate(columns)], "table_name string, ordinal int, column_name string, column_type string")
    named = spark.createDataFrame([(i, key, "t") for i, key in enumerate(loads)], "id bigint, s3_key string, table_name string")
    checked = schema_gate.checked_loads(named, registry, Layout(incoming=f"{tmp_path}/incoming/"))
    return {r["id"]: (r["columns_match"], r["not_in_catalog"], r["not_in_manifest"]) for r in checked.collect()}


def sidecar(*names):
    return ('{"dataInfo":{"columns":[' + ",".join(f'{{"name":"{n}"}}' for n in names) + "]}}").encode()


def test_gate_compares_names_in_order_and_ignores_case(spark, tmp_path):
    bodies = {"ods/T/1.dfm": sidecar("N", "Day"), "ods/T/2.dfm": sidecar("day", "n"), "ods/T/3.dfm": sidecar("n", "day", "more"), "ods/T/4.dfm": sidecar("n")}
    found = gate(spark, tmp_path, bodies, [f"ods/T/{i}.csv.gz" for i in (1, 2, 3, 4)])
    assert found == {0: (True, [], []), 1: (False, [], []), 2: (False, ["more"], []), 3: (False, [], ["day"])}


def test_gate_holds_back_missing_and_damaged_sidecars(spark, tmp_path):
    bodies = {"ods/T/1.dfm": b"", "ods/T/2.dfm": b"{", "ods/T/3.dfm": b"\xff\xfe", "ods/T/4.dfm": b'{"dataInfo":{}}', "ods/T/5.dfm": b'{"dataInfo":{"columns":[{}]}}'}
    found = gate(spark, tmp_path, bodies, [f"ods/T/{i}.csv.gz" for i in (1, 2, 3, 4, 5, 6)])
    assert set(found) == set(range(6)) and not any(match for match, *_ in found.values())


def test_gate_leaves_datasets_and_repeated_loads_alone(spark, tmp_path):
    found = gate(spark, tmp_path, {"ods/T/1.dfm": sidecar("n", "day")}, ["ods/T/1.csv.gz", "ods/T/1.csv.gz", "datasets/x/1.csv.gz", None])
    assert {i: match for i, (match, *_) in found.items()} == {0: True, 1: True}


def test_gate_knows_no_table(spark, tmp_path):
    found = gate(spark, tmp_path, {"ods/T/1.dfm": sidecar("n")}, ["ods/T/1.csv.gz"], columns=())
    assert found == {0: (False, ["n"], [])}


def test_candidates_are_judged(spark):
    tables = spark.createDataFrame([("old", "ods/OLD/"), ("gone", "ods/GONE/")], "name string, s3_prefix string")
    rows = [
        ("old", "ods/NEW/", True), ("new", "ods/OLD/", True), ("twin", "ods/T/", True), ("twin", "ods/T/", True), ("raw?", "ods/R/", True),
        ("raw?", "ods/R/", None), ("two", "ods/A/", True), ("two", "ods/B/", True), ("one", "ods/C/", False), ("other", "ods/C/", False), (None, "ods/D/", True), ("none", None, None),
    ]
    found = {(r["name"], r["s3_prefix"]): r["reason"] for r in registration.judged_tables(tables, spark.createDataFrame(rows, CANDIDATE)).collect()}
    assert found.pop(("twin", "ods/T/")) is None
    assert found == {
        ("old", "ods/NEW/"): "known", ("new", "ods/OLD/"): "taken", ("raw?", "ods/R/"): "ambiguous", ("two", "ods/A/"): "ambiguous", ("two", "ods/B/"): "ambiguous",
        ("one", "ods/C/"): "ambiguous", ("other", "ods/C/"): "ambiguous", (None, "ods/D/"): "incomplete", ("none", None): "incomplete",
    }


def test_registration_on_an_empty_ledger_and_again(spark, store):
    rows = spark.createDataFrame([("b", "ods/B/", True), ("a", "ods/A/", True), ("s", "datasets/s/", None)], CANDIDATE)
    feeds = spark.createDataFrame([("/y",), ("/x",), ("/x",), (None,)], "relative_url string")
    assert run_registration(store, rows, feeds).count() == 0
    tables = lambda: [tuple(r) for r in store.read("tables").select("id", "name", "is_raw", "is_active").orderBy("id").collect()]
    first = tables()
    assert first == [(1, "a", True, True), (2, "b", True, True), (3, "s", False, True)]
    snapshots = store.read("table_snapshots").orderBy("id").collect()
    assert [(r["id"], r["table_id"], r["snapshot_s3_key"], r["snapshot"]) for r in snapshots] == [(1, 1, "ods/A/LOAD00000001.csv.gz", None), (2, 2, "ods/B/LOAD00000001.csv.gz", None)]
    assert [(r["id"], r["relative_url"]) for r in store.read("feeds").orderBy("id").collect()] == [(1, "/x"), (2, "/y")]
    refused = run_registration(store, rows, feeds)
    assert {r["reason"] for r in refused.collect()} == {"known"} and tables() == first and store.read("feeds").count() == 2


def test_registration_of_nothing(spark, store):
    assert run_registration(store, spark.createDataFrame([], CANDIDATE)).count() == 0
    assert store.read("tables").count() == 0
