"""The queries: each runs one operator over whole tables of a scale folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conformance.files import deliver, gate_sidecar, sidecar
from conformance.views import Inputs
from lakeload import functions as fn
from lakeload.operators import batching, casting, discover, feeds, landing, ledger, relocate, routing, status_fold
from lakeload.plans.feed_sync import run_feed_sync
from lakeload.plans.load_pass import advance, run_load_pass
from lakeload.plans.register import run_registration
from lakeload.plans.relocation_pass import run_relocation_pass
from lakeload.plans.store import LedgerStore
from lakeload.runtime import new_run_dir, tune
from lakeload.sources import catalog, csv_text, feed_bodies, manifest, payload
from lakeload.sources import listing as source_listing
from lakeload.streaming.discover_stream import start_discovery
from lakeload.streaming.watermark import start_watermark_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

LINE = ("l_orderkey", "l_linenumber")
CAST_FIELDS = [
    {"name": "long_s", "type": "long"},
    {"name": "double_s", "type": "double"},
    {"name": "iso_s", "type": "date"},
    {"name": "dirty_s", "type": "string"},
]


def query(build: Callable[[Inputs], DataFrame] | None = None, name: str | None = None) -> Callable:
    """Register ``build`` under its name, or another; instants leave as zoneless UTC timestamps."""
    if build is None:
        return lambda later: query(later, name)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = build(Inputs(tune(spark), sf_dir))
        zoned = [f.name for f in out.schema.fields if f.dataType.typeName() == "timestamp"]
        return out.withColumns({column: F.col(column).cast("timestamp_ntz") for column in zoned}) if zoned else out

    QUERIES[name or build.__name__] = run
    return build


def joined(array: str) -> F.Column:
    return F.concat_ws(",", F.col(array))


# ---- functions --------------------------------------------------------------
@query
def blank_to_null(t: Inputs) -> DataFrame:
    return t.v_strings.select(*LINE, fn.blank_to_null("long_s").alias("long_s"), fn.blank_to_null("double_s").alias("double_s"))


@query
def cast_long(t: Inputs) -> DataFrame:
    return t.v_strings.select(*LINE, fn.parse_long("long_s").alias("value"), fn.parse_long("dirty_s", strict=False).alias("lenient"))


@query
def cast_double(t: Inputs) -> DataFrame:
    return t.v_strings.select(*LINE, fn.parse_double("double_s").alias("value"))


@query
def cast_date(t: Inputs) -> DataFrame:
    return t.v_strings.select(*LINE, fn.parse_date("iso_s").alias("value"))


@query
def cast_timestamp(t: Inputs) -> DataFrame:
    return t.v_strings.select(*LINE, fn.parse_timestamp("iso_s").alias("value"))


@query
def cast_to_schema(t: Inputs) -> DataFrame:
    return casting.cast_to_schema(t.v_strings, CAST_FIELDS, keep=LINE)


@query
def cast_rejects(t: Inputs) -> DataFrame:
    fields = [*CAST_FIELDS[:3], {"name": "dirty_s", "type": "long"}]
    return casting.cast_rejects(t.v_strings, fields, keep=LINE)


@query
def truncate_second(t: Inputs) -> DataFrame:
    return t.events.select("event_id", fn.truncate_second(F.col("ts")).alias("second"))


@query
def format_snapshot(t: Inputs) -> DataFrame:
    return t.events.select("event_id", fn.format_snapshot(F.col("ts")).alias("snapshot"))


def announced(t: Inputs) -> DataFrame:
    return feed_bodies.feed_results(t.v_feed)


@query
def parse_iso_extended(t: Inputs) -> DataFrame:
    return announced(t).select("page_id", fn.parse_iso_extended(F.col("dataset")["last_updated"]).alias("last_updated_at"))


@query
def valid_iso_date(t: Inputs) -> DataFrame:
    return announced(t).select(
        "page_id",
        fn.valid_iso_date(F.col("dataset")["start_date"]).alias("start_ok"),
        fn.valid_iso_date(F.col("dataset")["end_date"]).alias("end_ok"),
        fn.valid_iso_date(F.col("dataset")["last_updated"]).alias("updated_ok"),
    )


@query
def valid_iso_datetime(t: Inputs) -> DataFrame:
    return announced(t).select(
        "page_id",
        fn.valid_iso_datetime(F.col("dataset")["last_updated"]).alias("updated_ok"),
        fn.valid_iso_datetime(F.col("dataset")["end_date"]).alias("end_ok"),
    )


@query
def valid_url(t: Inputs) -> DataFrame:
    return t.pages.select("page_id", fn.valid_url(F.col("url")).alias("ok"))


@query
def has_keys(t: Inputs) -> DataFrame:
    entries = F.from_json("props", "map<string,string>")
    return t.events.select("event_id", fn.has_keys(entries, ["k"]).alias("has_k"), fn.has_keys(entries, ["k", "z"]).alias("has_k_and_z"))


@query
def is_ods(t: Inputs) -> DataFrame:
    return t.v_mixed_loads.select("id", routing.is_replicated(F.col("s3_key")).alias("is_ods"))


@query
def path_parts(t: Inputs) -> DataFrame:
    key = F.col("s3_key")
    return t.v_loads.select(
        "id",
        fn.dir_name(key).alias("dir"),
        fn.base_name(key).alias("base"),
        fn.base_name(key, ".csv.gz").alias("stem"),
        fn.root_name(key).alias("root"),
        fn.drop_prefix(key, "ods/").alias("below"),
        fn.swap_suffix(F.concat(fn.dir_name(key), F.lit("/")), "__ct/", "/").alias("table_prefix"),
    )


# ---- sources ----------------------------------------------------------------
@query
def scan_csv_strings(t: Inputs) -> DataFrame:
    landing_zone = new_run_dir(t.spark, "csv")
    columns = t.v_strings.columns
    files = t.v_strings.repartition(t.spark.sparkContext.defaultParallelism)
    writer = files.write.options(escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    writer.option("compression", "gzip").csv(landing_zone)
    return csv_text.scan_csv_strings(t.spark, landing_zone, columns)


def landing_zone(t: Inputs) -> str:
    """Orders as small gzipped CSV objects below a folder per table; returns the root."""
    root = new_run_dir(t.spark, "incoming")
    rows = t.v_loads.select(
        "id", "s3_key", "s3_size", F.concat(F.lit("T"), "table_id").alias("folder"), F.floor(F.col("id") / 50_000).alias("block")
    )
    spread = rows.repartition("folder", "block")
    spread.write.partitionBy("folder", "block").option("compression", "gzip").csv(f"{root}/ods")
    return f"{root}/"


@query
def list_objects(t: Inputs) -> DataFrame:
    objects = discover.valid_objects(source_listing.list_objects(t.spark, landing_zone(t)))
    table = F.regexp_extract("key", "^ods/folder=([^/]*)/block=[0-9]+/[^/]*$", 1)
    return objects.groupBy(table.alias("folder")).agg(F.count("*").alias("objects"), (F.min("size") > 0).alias("all_filled"))


@query
def stream_discover(t: Inputs) -> DataFrame:
    layout = routing.Layout(incoming=landing_zone(t))
    store = LedgerStore(t.spark, new_run_dir(t.spark, "ledger"))
    prefix = F.regexp_replace("s3_prefix", "^ods/", "ods/folder=")
    store.write("tables", t.v_tables.withColumn("s3_prefix", prefix), 0)
    store.write("table_snapshots", t.v_table_snapshots, 0)
    checkpoint = new_run_dir(t.spark, "stream")
    for _ in range(2):  # the second run finds nothing new
        start_discovery(t.spark, store, layout, checkpoint, {"availableNow": True}, settle_seconds=0).awaitTermination()
    return store.read("loads").groupBy("table_id", "status").agg(F.count("*").alias("loads"))


@query
def load_pass(t: Inputs) -> DataFrame:
    """Line items as CSV objects of 25 tables, half of them raw: discovered, batched, cast, landed, read back."""
    root, columns = new_run_dir(t.spark, "pass"), t.v_strings.columns
    layout = routing.Layout(*(f"{root}/{part}/" for part in ("incoming", "lake", "archive", "errors")))
    texts = t.v_strings.select(
        F.concat(F.lit("T"), F.col("l_orderkey") % 25).alias("folder"), F.floor(F.col("l_orderkey") / 50_000).alias("block"), *columns
    )
    writer = texts.repartition("folder", "block").write.partitionBy("folder", "block")
    writer.options(compression="gzip", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{layout.incoming}datasets")

    store = LedgerStore(t.spark, f"{root}/ledger")
    prefix = F.concat(F.lit("datasets/folder=T"), "id", F.lit("/"))
    tables = t.v_tables.withColumns({"s3_prefix": prefix, "is_active": F.lit(True), "deleted_at": F.lit(None)})
    store.write("tables", tables, 0)
    kinds = {"l_orderkey": "bigint", "l_linenumber": "bigint", "long_s": "bigint", "double_s": "double", "iso_s": "date"}
    fields = F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column_name"), F.lit(kinds.get(c, "string")).alias("column_type")) for i, c in enumerate(columns)])
    names = tables.select(F.explode(F.array("name", F.concat(F.lit("raw_"), "name"))).alias("table_name"))
    run_load_pass(t.spark, store, names.select("table_name", F.inline(fields)), layout)
    landed = t.spark.read.option("recursiveFileLookup", True).parquet(f"{layout.lake}datasets", f"{layout.lake}raw/datasets")
    return landed.withColumn("l_linenumber", F.col("l_linenumber").cast("int"))


class Deliveries:
    """The objects of ``v_deliveries`` as files, five replicated tables and five of the dataset feed, and their registry."""

    def __init__(self, t: Inputs) -> None:
        self.t, self.root = t, new_run_dir(t.spark, "deliveries")
        self.layout = routing.Layout(*(f"{self.root}/{part}/" for part in ("incoming", "lake", "archive", "errors")))
        self.store = LedgerStore(t.spark, f"{self.root}/ledger")
        replicated = t.region.select(
            F.col("r_regionkey").cast("long").alias("id"), F.concat(F.lit("ods__t"), "r_regionkey").alias("name"),
            F.concat(F.lit("ods/T"), "r_regionkey", F.lit("/")).alias("s3_prefix"), (F.col("r_regionkey") % 2 == 0).alias("is_raw"),
        )
        sets = t.region.select(
            (F.col("r_regionkey") + 100).cast("long").alias("id"), F.concat(F.lit("set"), "r_regionkey").alias("name"),
            F.concat(F.lit("datasets/set"), "r_regionkey", F.lit("/")).alias("s3_prefix"), F.lit(False).alias("is_raw"),
        )
        self.tables = replicated.unionByName(sets).withColumn("is_active", F.lit(True))
        self.store.write("tables", self.tables, 0)
        first = replicated.select("id", F.col("id").alias("table_id"), F.concat("s3_prefix", F.lit("LOAD00000001.csv.gz")).alias("snapshot_s3_key"))
        self.store.write("table_snapshots", first, 0)
        kinds = [("n", "bigint"), ("day", "date"), ("text", "string")]
        fields = F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column_name"), F.lit(k).alias("column_type")) for i, (c, k) in enumerate(kinds)])
        names = self.tables.select(F.explode(F.array(*[F.concat(F.lit(a), "name", F.lit(b)) for a in ("", "raw_") for b in ("", "__ct")])).alias("table_name"))
        self.registry = names.select("table_name", F.inline(fields))

    def put(self, chosen: DataFrame) -> None:
        """Write the chosen deliveries; in the objects of every 13th owner the numbers do not parse."""
        number = F.concat(F.when(F.col("owner") % 13 == 0, "x").otherwise(""), F.col("n").cast("string"))
        line = F.concat_ws(",", number, F.col("day").cast("string"), "text")
        bodies = self.t.v_delivered_lines.groupBy("owner").agg(F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("body"))
        deliver(chosen.join(bodies, "owner", "left").select("s3_key", F.coalesce("body", F.lit("")).alias("body")), self.layout.incoming)

    def objects(self, chosen: DataFrame) -> DataFrame:
        return chosen.select(F.col("s3_key").alias("key"), F.col("s3_modified").cast("timestamp").alias("last_modified"), F.lit(1).cast("long").alias("size"))

    def listed(self) -> DataFrame:
        """``area, key`` of every file there is outside the lake."""
        areas = [("incoming", self.layout.incoming), ("archive", self.layout.archive), ("errors", self.layout.errors)]
        lists = [source_listing.list_objects(self.t.spark, root).select(F.lit(area).alias("area"), "key") for area, root in areas]
        return lists[0].unionByName(lists[1]).unionByName(lists[2])

    def statuses(self) -> DataFrame:
        return self.store.loads().select("s3_key", "s3_modified", "status")


@query
def load_pass_replicated(t: Inputs) -> DataFrame:
    """Two deliveries of replicated and dataset objects, the second with the snapshot files written again: landed, read back."""
    d = Deliveries(t)
    for delivery in (1, 2):
        chosen = t.v_deliveries.where(F.col("delivery") == delivery)
        d.put(chosen)
        run_load_pass(t.spark, d.store, d.registry, d.layout, objects=d.objects(chosen))
    # the destinations have partitions of two kinds, so their names are taken from the paths
    landed = t.spark.read.option("recursiveFileLookup", True).parquet(d.layout.lake)
    below = F.regexp_extract("_metadata.file_path", "/lake/(.*)/[^/]*$", 1)
    rows = landed.select(below.alias("path"), "n", "day", "text")
    return rows.select(
        F.regexp_replace("path", "/(snapshot|identifier)=.*", "").alias("destination"),
        F.regexp_extract("path", "/snapshot=([^/]*)", 1).alias("snapshot"),
        F.regexp_extract("path", "/identifier=([^/]*)", 1).alias("identifier"),
        "n",
        "day",
        "text",
    )


@query
def load_pass_schema_gate(t: Inputs) -> DataFrame:
    """How the loads of one delivery end when the pass compares sidecars with the catalog."""
    d = Deliveries(t)
    chosen = t.v_deliveries.where("delivery = 1")
    d.put(chosen)
    deliver(gate_sidecar(chosen), d.layout.incoming)
    run_load_pass(t.spark, d.store, d.registry, d.layout, objects=d.objects(chosen), check_schema=True)
    return d.statuses()


@query
def relocation_pass(t: Inputs) -> DataFrame:
    """Files and statuses after moves: fresh ones, ones done or half done by an earlier run, lost files, and a repeated pass."""
    d = Deliveries(t)
    chosen = t.v_deliveries.where("owner >= 0").withColumns({"id": F.col("owner") + 1, "fate": F.col("owner") % 8})
    status = F.when(F.col("fate") == 2, "ready_for_erroring").when(F.col("fate") == 3, "ready").when(F.col("fate") == 7, "archiving").otherwise("ready_for_archiving")
    d.store.write("loads", chosen.select("id", "s3_key", "s3_modified", status.alias("status")), 0)
    stamps = F.when(F.col("delivery") == 1, F.lit("2024-01-01")).otherwise(F.lit("2024-02-01")).cast("timestamp")
    d.store.write("load_snapshots", chosen.select("id", F.col("id").alias("load_id"), stamps.alias("snapshot"), F.col("s3_modified").alias("inserted_at")), 0)
    present = chosen.where("fate not in (4, 5)")
    d.put(present)
    deliver(sidecar(present), d.layout.incoming)
    pairs = routing.move_pairs(routing.with_latest_snapshot(chosen, d.store.read("load_snapshots")), routing.archive_root(d.layout), d.layout)
    done = pairs.join(chosen.where("fate in (5, 6)").select("id"), "id", "left_semi")
    deliver(done.select(F.col("destination_key").alias("s3_key"), F.lit("").alias("body")), d.layout.archive)
    run_relocation_pass(t.spark, d.store, d.layout)
    run_relocation_pass(t.spark, d.store, d.layout, retry=True)
    return d.listed().unionByName(d.statuses().select(F.lit("ledger").alias("area"), F.concat_ws(" ", "s3_key", "status").alias("key")))


@query
def stream_advance(t: Inputs) -> DataFrame:
    """The discovery stream with landing and moving behind each batch, on real files; times in keys are left out."""
    d = Deliveries(t)
    for part in ("owner < 0 and delivery = 1", "owner >= 0"):  # a snapshot file is older than what follows it
        d.put(t.v_deliveries.where(part))
    deliver(sidecar(t.v_deliveries.where("owner >= 0 or delivery = 1")), d.layout.incoming)

    def later(pass_id: int) -> None:
        advance(t.spark, d.store, d.registry, d.layout, pass_id)
        run_relocation_pass(t.spark, d.store, d.layout)

    checkpoint = new_run_dir(t.spark, "stream")
    for _ in range(2):  # the second run finds nothing new
        start_discovery(t.spark, d.store, d.layout, checkpoint, {"availableNow": True}, settle_seconds=0, after_batch=later).awaitTermination()
    files = d.listed().select("area", F.regexp_replace("key", "(snapshot|timestamp)=[^/]*", "at").alias("key"))
    return files.unionByName(d.statuses().select(F.lit("ledger").alias("area"), F.concat_ws(" ", "s3_key", "status").alias("key")))


@query
def feed_sync(t: Inputs) -> DataFrame:
    """Two rounds of announcements: the datasets, the feeds and what is to be fetched."""
    store = LedgerStore(t.spark, new_run_dir(t.spark, "ledger"))
    store.write("feeds", t.v_feeds, 0)
    fetched = []
    for odd in (0, 1):
        bodies = t.v_twin_bodies.where(F.col("arrival") % 2 == odd).select((F.col("arrival") % 7).alias("feed_id"), "arrival", "body")
        fetched.append(run_feed_sync(store, bodies))
    datasets = store.read("datasets").select(
        F.lit("dataset").alias("kind"), "feed_id", F.concat_ws(" ", "identifier", "type", "start_date", "end_date").alias("what"), "last_updated_at"
    )
    moved = store.read("feeds").select(F.lit("feed").alias("kind"), F.col("id").alias("feed_id"), F.col("relative_url").alias("what"), "last_updated_at")
    asked = fetched[0].unionByName(fetched[1]).select(
        F.lit("fetch").alias("kind"), "feed_id", F.concat_ws(" ", "url", "landing_key").alias("what"), F.lit(None).cast("timestamp").alias("last_updated_at")
    )
    return datasets.unionByName(moved).unionByName(asked)


@query
def register_all(t: Inputs) -> DataFrame:
    """Tables, snapshot rows and feeds asked for twice over, with twins and clashes: what is registered, what is refused."""
    store = LedgerStore(t.spark, new_run_dir(t.spark, "ledger"))
    store.write("tables", t.v_tables, 0)
    store.write("table_snapshots", t.v_table_snapshots.withColumn("id", F.col("table_id")), 0)
    store.write("feeds", t.v_feeds.where("id % 2 = 0"), 0)
    refused = [run_registration(store, t.v_registrations, t.v_feeds) for _ in range(2)]
    tables = store.read("tables").select(F.lit("table").alias("kind"), "id", F.concat_ws(" ", "name", "s3_prefix", F.col("is_raw").cast("string")).alias("what"))
    snapshots = store.read("table_snapshots").select(F.lit("snapshot").alias("kind"), "id", F.concat_ws(" ", F.col("table_id").cast("string"), "snapshot_s3_key").alias("what"))
    known = store.read("feeds").select(F.lit("feed").alias("kind"), "id", F.col("relative_url").alias("what"))
    out = tables.unionByName(snapshots).unionByName(known)
    for i, rows in enumerate(refused):
        out = out.unionByName(rows.select(F.lit(f"refused {i}").alias("kind"), F.lit(None).cast("long").alias("id"), F.concat_ws(" ", "name", "s3_prefix", "reason").alias("what")))
    return out


@query
def stateful_watermark(t: Inputs) -> DataFrame:
    root = new_run_dir(t.spark, "watermark")
    halves = [t.v_objects.where("already_loaded"), t.v_objects.where("not already_loaded")]
    schema = listing(t).schema
    query_args = (f"{root}/output", f"{root}/checkpoint", {"availableNow": True})
    for half in halves:
        listed = half.select("table_id", "event_id", F.col("object_key").alias("key"), "last_modified", F.col("object_size").alias("size"))
        listed.write.mode("append").parquet(f"{root}/input")
        start_watermark_filter(t.spark.readStream.schema(schema).parquet(f"{root}/input"), *query_args).awaitTermination()
    return t.spark.read.parquet(f"{root}/output").select("table_id", "event_id", "key")


@query
def list_prefixes(t: Inputs) -> DataFrame:
    datasets = t.v_objects.select(F.concat(F.lit("datasets/D"), "table_id", F.lit("/"), "event_id").alias("key"))
    objects = t.v_loads.select(F.col("s3_key").alias("key")).unionByName(datasets)
    return discover.list_prefixes(objects, ["ods/", "datasets/"])


@query
def manifest_columns(t: Inputs) -> DataFrame:
    found = manifest.load_manifest_columns(t.v_loads.select("id", "s3_key"), t.v_sidecars)
    return found.select("id", joined("manifest_columns").alias("columns"))


def catalogued(t: Inputs) -> DataFrame:
    named = ledger.loads_with_table(t.v_loads, t.v_tables).select("id", "s3_key", "table_name")
    return catalog.load_catalog_columns(named, t.v_registry)


@query
def catalog_columns(t: Inputs) -> DataFrame:
    return catalogued(t).select("id", "catalog_table", F.array_join("catalog_columns", ",").alias("columns"))


@query
def schema_check(t: Inputs) -> DataFrame:
    sidecars = manifest.load_manifest_columns(catalogued(t), t.v_sidecars)
    checked = manifest.schema_check(sidecars)
    return checked.select(
        "id",
        "columns_match",
        F.size("not_in_catalog").cast("long").alias("not_in_catalog"),
        F.size("not_in_manifest").cast("long").alias("not_in_manifest"),
    )


@query
def catalog_type_map(t: Inputs) -> DataFrame:
    return catalog.with_parsed_types(t.v_registry)


@query
def feed_results(t: Inputs) -> DataFrame:
    return feeds.dataset_rows(announced(t)).select("page_id", "type", "identifier", "end_date", "last_updated_at", "url")


@query
def payload_parse(t: Inputs) -> DataFrame:
    rows = payload.payload_loads(t.v_payloads, keep=("o_orderkey",))
    partitions = F.array_join(F.transform("partition_columns", lambda p: F.concat_ws("=", p["name"], p["value"])), "/")
    return rows.select("o_orderkey", "id", "s3_key", "source_table_name", partitions.alias("partitions"))


# ---- ledger reads -----------------------------------------------------------
@query
def ledger_live(t: Inputs) -> DataFrame:
    return ledger.live(t.v_loads)


@query
def active_tables(t: Inputs) -> DataFrame:
    return ledger.active_tables(t.v_many_tables)


@query
def loads_by_status(t: Inputs) -> DataFrame:
    return ledger.loads_by_status(t.v_loads, ["ready", "archiving"], limit=1000).select("id", "status", "s3_key")


@query
def loads_by_status_all(t: Inputs) -> DataFrame:
    return ledger.loads_by_status(t.v_loads, ["ready", "archiving"]).select("id", "status", "s3_key")


@query
def loads_with_table(t: Inputs) -> DataFrame:
    ids = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("id"))
    return ledger.loads_with_table(t.v_loads, t.v_tables, ids).select("id", "table_id", "table_name", "s3_key")


@query
def tables_with_snapshot(t: Inputs) -> DataFrame:
    return ledger.tables_with_snapshot(t.v_many_tables, t.v_many_snapshots).select("id", "name", "snapshot_s3_key", "snapshot")


@query
def latest_load_snapshot(t: Inputs) -> DataFrame:
    return ledger.latest_load_snapshot(t.v_load_snapshots)


@query
def latest_snapshot_load(t: Inputs) -> DataFrame:
    return ledger.latest_snapshot_load(t.v_loads, t.v_table_snapshots)


@query
def ready_loads(t: Inputs) -> DataFrame:
    chosen = ledger.ready_loads(t.v_loads, t.v_tables, t.v_table_snapshots, per_table=100)
    return chosen.select("id", "table_id", "table_name", "s3_key", "s3_modified")


@query
def ready_loads_all(t: Inputs) -> DataFrame:
    return ledger.ready_loads(t.v_loads, t.v_tables, t.v_table_snapshots, per_table=None).select("id", "table_id", "table_name")


@query
def ledger_json(t: Inputs) -> DataFrame:
    text = ledger.ledger_json(t.v_loads, "loads")
    back = F.from_json("json", "id bigint, table_id bigint, status string, s3_key string, s3_size bigint, is_raw boolean, deleted_at date")
    return text.select(back.alias("r")).select("r.*")


@query
def dispatch_actions(t: Inputs) -> DataFrame:
    return ledger.dispatch_actions(t.v_status_loads, limit=None).select("id", "status", "action")


@query
def stuck_loads(t: Inputs) -> DataFrame:
    return ledger.stuck_loads(t.v_status_loads, limit=None).select("id", "status", "action")


# ---- ledger updates ---------------------------------------------------------
@query
def update_status_many(t: Inputs) -> DataFrame:
    ids = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("id"))
    return ledger.update_many(t.v_loads, ids, status="archived").select("id", "status")


@query
def changed_rows(t: Inputs) -> DataFrame:
    ids = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("id"))
    return ledger.changed_rows(t.v_loads, ids, status="archived").select("id", "status", "s3_key")


@query
def status_transition(t: Inputs) -> DataFrame:
    current = t.v_status_loads.select(F.col("id").alias("load_id"), "status")
    return ledger.transition(current, t.v_status_events)


@query(name="status_fold")
def folded_events(t: Inputs) -> DataFrame:
    current = t.v_status_loads.select(F.col("id").alias("load_id"), "status")
    return status_fold.fold_events(current, t.v_load_events).select("load_id", "seq", "event", "status", "next_status")


@query
def folded_status(t: Inputs) -> DataFrame:
    current = t.v_status_loads.select(F.col("id").alias("load_id"), "status")
    return status_fold.folded_status(current, status_fold.fold_events(current, t.v_load_events))


@query
def find_by_clause(t: Inputs) -> DataFrame:
    """Every nation's table, looked up by its prefix; each lookup must give exactly one row."""
    found = ledger.find_one(t.v_tables, s3_prefix="ods/T7/", is_raw=False)
    return found.join(t.v_loads.select(F.col("table_id").alias("id"), F.col("id").alias("load_id")), "id").select("id", "name", "load_id")


@query
def current_status(t: Inputs) -> DataFrame:
    return ledger.current_status(t.v_status_log)


@query
def register_tables(t: Inputs) -> DataFrame:
    candidates = t.customer.select(
        F.concat(F.lit("ods__t"), "c_custkey").alias("name"), F.concat(F.lit("ods/T"), "c_custkey", F.lit("/")).alias("s3_prefix")
    )
    return ledger.register_tables(t.v_tables, candidates)


# ---- discovery --------------------------------------------------------------
@query
def match_prefixes(t: Inputs) -> DataFrame:
    prefixes = discover.list_prefixes(t.v_loads, ["ods/"], key="s3_key")
    return discover.match_prefixes(prefixes, t.v_tables)


@query
def valid_objects(t: Inputs) -> DataFrame:
    return discover.valid_objects(t.v_objects, "object_key", "object_size").select("event_id", "object_key", "object_size")


def listing(t: Inputs) -> DataFrame:
    return t.v_objects.select("table_id", "event_id", F.col("object_key").alias("key"), "last_modified", F.col("object_size").alias("size"))


def loaded(t: Inputs) -> DataFrame:
    done = t.v_objects.where("already_loaded")
    return done.select("table_id", F.col("object_key").alias("s3_key"), F.date_trunc("second", "last_modified").alias("s3_modified"))


@query
def table_watermark(t: Inputs) -> DataFrame:
    return discover.table_watermark(loaded(t))


@query
def new_objects(t: Inputs) -> DataFrame:
    return discover.new_objects(discover.valid_objects(listing(t)), loaded(t), per_prefix=500).select("table_id", "event_id", "key")


@query
def new_objects_all(t: Inputs) -> DataFrame:
    return discover.new_objects(discover.valid_objects(listing(t)), loaded(t)).select("table_id", "event_id", "key")


@query
def unseen_objects(t: Inputs) -> DataFrame:
    return discover.unseen_objects(discover.valid_objects(listing(t)), loaded(t)).select("table_id", "event_id", "key")


def arriving(t: Inputs) -> DataFrame:
    return t.v_loads.select(
        "id", "table_id", F.col("s3_key").alias("key"), F.col("s3_modified").alias("last_modified"), F.col("s3_size").alias("size")
    )


@query
def snapshot_fold(t: Inputs) -> DataFrame:
    return discover.snapshot_fold(arriving(t), t.v_table_snapshots).select("id", "table_id", "snapshot", "is_snapshot_table")


@query
def table_snapshot_update(t: Inputs) -> DataFrame:
    return discover.table_snapshot_update(arriving(t), t.v_table_snapshots)


@query
def new_load_rows(t: Inputs) -> DataFrame:
    rows = discover.new_load_rows(arriving(t), t.v_tables, t.v_table_snapshots)
    return rows.select("id", "table_id", "status", "s3_key", "s3_modified", "s3_size", "is_raw")


@query
def dense_load_ids(t: Inputs) -> DataFrame:
    """New loads numbered without gaps behind the ids of those there are."""
    rows = discover.new_load_rows(arriving(t).drop("id"), t.v_tables, t.v_table_snapshots)
    staged = new_run_dir(t.spark, "staged")
    discover.with_row_places(rows, in_order=True).write.parquet(staged)
    last = t.v_loads.agg(F.max("id").alias("id")).first()["id"]
    numbered = discover.dense_load_ids(t.spark.read.parquet(staged), last)
    return numbered.select("id", "table_id", "s3_key", "s3_modified")


@query
def load_snapshot_rows(t: Inputs) -> DataFrame:
    return discover.load_snapshot_rows(discover.new_load_rows(arriving(t), t.v_tables, t.v_table_snapshots))


# ---- batches, routes, moves -------------------------------------------------
def batched(t: Inputs) -> DataFrame:
    ready = ledger.loads_by_status(t.v_loads, ["ready"], limit=None).select("id", "table_id", "s3_size")
    return batching.chunk_loads(ready, max_num=10, max_bytes=1_500_000)


@query
def chunk_loads(t: Inputs) -> DataFrame:
    return batched(t)


@query
def chunk_loads_global(t: Inputs) -> DataFrame:
    """All ready loads as one group, in small blocks so that these make a tree."""
    ready = ledger.loads_by_status(t.v_loads, ["ready"], limit=None).select("id", "s3_size")
    return batching.chunk_loads(ready, max_num=10, max_bytes=1_500_000, by=None, block_ids=256)


@query
def batch_stats(t: Inputs) -> DataFrame:
    return batching.batch_stats(batched(t))


def routed(t: Inputs) -> DataFrame:
    return routing.route_loads(ledger.loads_with_table(t.v_mixed_loads, t.v_tables))


@query
def route_loads(t: Inputs) -> DataFrame:
    return routed(t).select("id", "source_table_name", "destination_table_name", "source_path", "destination_path", "identifier")


@query
def routed_partitions(t: Inputs) -> DataFrame:
    out = routing.routed_partitions(routed(t), ledger.latest_load_snapshot(t.v_load_snapshots))
    pairs = F.transform("partition_columns", lambda p: F.concat_ws("=", p["name"], p["value"]))
    return out.select("id", F.array_join(pairs, "/").alias("partitions"))


def with_snapshot(t: Inputs) -> DataFrame:
    return routing.with_latest_snapshot(t.v_mixed_loads, ledger.latest_load_snapshot(t.v_load_snapshots))


@query
def archive_keys(t: Inputs) -> DataFrame:
    return with_snapshot(t).select("id", routing.archive_root().alias("destination"))


@query
def error_keys(t: Inputs) -> DataFrame:
    return t.v_mixed_loads.select("id", routing.error_root().alias("destination"))


@query
def move_pairs(t: Inputs) -> DataFrame:
    return routing.move_pairs(with_snapshot(t), routing.archive_root())


@query
def move_plan(t: Inputs) -> DataFrame:
    pairs = routing.move_pairs(t.v_mixed_loads, routing.error_root())
    here = pairs.where("id % 4 in (0, 1)").select(F.col("source_key").alias("key"))
    there = pairs.where("id % 4 in (1, 2)").select(F.col("destination_key").alias("key"))
    return relocate.move_plan(pairs, here, there)


# ---- landing ----------------------------------------------------------------
@query
def partition_literals(t: Inputs) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_totalprice")
    return landing.with_partition_literals(orders, [("snapshot", "20220101T204950Z"), ("identifier", "LOAD1.csv.gz")])


@query
def land_partitioned(t: Inputs) -> DataFrame:
    lake = new_run_dir(t.spark, "lake")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    landing.land(rows, lake, ["o_orderstatus"])
    again = rows.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    landing.land(again, lake, ["o_orderstatus"])
    return landing.read_landed(t.spark, lake, ["o_orderstatus"])


@query
def land_empty_partition(t: Inputs) -> DataFrame:
    """Orders landed by status and priority; delivered again, some of their partitions have no rows any more."""
    lake, names = new_run_dir(t.spark, "lake"), ["o_orderstatus", "o_orderpriority"]
    rows = t.orders.select("o_orderkey", "o_totalprice", *names)
    landing.land(rows, lake, names)
    delivered = rows.where("o_orderstatus in ('F', 'O')")
    expected = [tuple(r) for r in delivered.select(*names).distinct().collect()]
    again = delivered.where("o_orderstatus = 'F' or o_orderpriority < '3'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    landing.land(again, lake, names, expected=expected)
    return landing.read_landed(t.spark, lake, names)


# ---- feeds ------------------------------------------------------------------
@query
def valid_datasets(t: Inputs) -> DataFrame:
    rows = feeds.dataset_rows(feeds.valid_datasets(announced(t)))
    return rows.select("page_id", "type", "identifier", "start_date", "end_date", "last_updated_at", "url")


@query
def upsert_datasets(t: Inputs) -> DataFrame:
    stored = t.customer.select(
        F.col("c_nationkey").cast("long").alias("feed_id"),
        F.lit("stored").alias("type"),
        F.concat(F.lit("sample_"), "c_custkey").alias("identifier"),
        F.to_date(F.lit("2020-01-01")).alias("start_date"),
        F.to_date(F.lit("2020-01-02")).alias("end_date"),
        F.to_timestamp_ntz(F.lit("2020-01-03 00:00:00")).alias("last_updated_at"),
    )
    incoming = feeds.dataset_rows(feeds.valid_datasets(announced(t))).select(
        (F.col("page_id") % 10).alias("feed_id"),
        "type",
        F.concat(F.lit("sample_"), F.floor(F.col("page_id") / 2 * 9)).alias("identifier"),
        "start_date",
        "end_date",
        "last_updated_at",
        F.col("page_id").alias("arrival"),
    )
    return feeds.upsert_datasets(stored, incoming)


@query
def upsert_datasets_ordered(t: Inputs) -> DataFrame:
    """Bodies of several announcements each, in which identifiers occur again."""
    stored = t.customer.where("c_custkey % 2 = 0").select(
        F.col("c_nationkey").cast("long").alias("feed_id"),
        F.lit("stored").alias("type"),
        F.concat(F.lit("d"), "c_custkey").alias("identifier"),
        F.to_date(F.lit("2020-01-01")).alias("start_date"),
        F.to_date(F.lit("2020-01-02")).alias("end_date"),
        F.to_timestamp_ntz(F.lit("2020-01-03 00:00:00")).alias("last_updated_at"),
    )
    bodies = t.v_twin_bodies.select((F.col("arrival") % 7).alias("feed_id"), "arrival", "body")
    incoming = feeds.dataset_rows(feeds.valid_datasets(feed_bodies.feed_results(bodies)))
    return feeds.upsert_datasets(stored, incoming)


@query
def feed_watermark(t: Inputs) -> DataFrame:
    known = t.v_feeds.select("id", "relative_url", "last_updated_at")
    datasets = t.events.select(F.col("user_id").alias("feed_id"), F.col("ts").cast("timestamp").alias("last_updated_at"))
    return feeds.feed_watermark(known, datasets)


@query
def feed_requests(t: Inputs) -> DataFrame:
    override = F.when(F.col("id") % 7 == 0, F.lit("2022-05-01 10:49:50.123456Z"))
    return feeds.feed_requests(t.v_feeds, "https://feeds.example.com", override).drop("last_updated_at")


@query
def feed_access_class(t: Inputs) -> DataFrame:
    return t.v_feeds.select("id", feeds.access_class(F.col("relative_url")).alias("access_class"))


@query
def dataset_landing_key(t: Inputs) -> DataFrame:
    rows = feeds.dataset_rows(announced(t))
    return rows.select("page_id", feeds.dataset_landing_key(F.col("type"), F.col("identifier")).alias("landing_key"))


@query
def remap_feed_urls(t: Inputs) -> DataFrame:
    mapping = t.supplier.select(
        F.concat(F.lit("/datasetpublicusersapi/transactional/d"), "s_suppkey").alias("old_relative_url"),
        F.concat(F.lit("/datasetpublicusersapi/renamed/d"), "s_suppkey").alias("new_relative_url"),
    )
    return feeds.remap_feed_urls(t.v_feeds.select("id", "relative_url"), mapping)
