"""Many events a load: statuses as an automaton, folded in order.

An event maps every status to the next one, or leaves it where the event does not
apply. Maps of events in a row compose to one map, whatever status the first of them
meets, so the events of a load need not be walked by one task: events, and the
current statuses before them, are sorted into ranges of a bounded size, and every
range is walked once. Only its first load may have begun in an earlier range: there
the walk keeps the map so far instead of a status. The few loads that cross ranges
are chained from their status, which gives those events their statuses.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from lakeload.operators.ledger import STATUSES, TRANSITIONS
from lakeload.runtime import new_run_dir

NUMBER = {status: i for i, status in enumerate(STATUSES)}

#: Event -> for each status, by number, the next one's number.
EVENT_MAPS = {
    event: [NUMBER[TRANSITIONS.get((status, event), status)] for status in STATUSES] for event in sorted({e for _, e in TRANSITIONS})
}
UNCHANGED = list(range(len(STATUSES)))

ORDER = ["load_id", "at", "seq"]


#: Events and statuses of a range, about.
RANGE_ROWS = 250_000


def walked(columns: list[str], schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A sorted range -> its events with the status before each, and a row without event for how its last load ends.

    ``so_far`` takes the place of the status where the range's first load has none in it: the
    map of its earlier events here.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, current, part, status, mapped, place = False, None, None, None, None, 0
        for batch in batches:
            names = batch.schema.names
            kept, found, maps = [], [], []
            rows = zip(*(batch.column(names.index(c)).to_pylist() for c in ("load_id", "part", "kind", "event", "status")), strict=True)
            for i, (load_id, part, kind, event, given) in enumerate(rows):
                if not begun or load_id != current:
                    current, status, mapped = load_id, None, None if begun else UNCHANGED
                    begun = True
                if not kind:
                    status, mapped = given, None
                    continue
                kept.append(i)
                found.append(status)
                maps.append(mapped)
                if mapped is None:
                    status = TRANSITIONS.get((status, event), status)
                elif event in EVENT_MAPS:
                    step = EVENT_MAPS[event]
                    mapped = [step[state] for state in mapped]
            taken = batch.take(pa.array(kept, pa.int64()))
            numbers = pa.array(range(place, place + len(kept)), pa.int64())
            place += len(kept)
            values = [*(taken.column(names.index(c)) for c in columns), taken.column(names.index("part")), pa.array([True] * len(kept), pa.bool_()), numbers, found, maps]
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) if isinstance(v, list) else v.cast(f.type) for v, f in zip(values, schema, strict=True)], schema=schema)
        if begun:
            last = dict.fromkeys(schema.names) | {"load_id": current, "part": part, "is_event": False, "place": place, "status": status, "so_far": mapped}
            yield pa.RecordBatch.from_pylist([last], schema=schema)

    return run


def fold_events(current: DataFrame, events: DataFrame) -> DataFrame:
    """Apply all events of every load, in the order of ``at`` and ``seq``: the events with ``status`` and ``next_status``.

    ``current`` holds ``load_id, status``, one row a load; ``events`` ``load_id, event, at, seq``. An event
    that does not apply has NULL for ``next_status`` and changes nothing, as has every
    event of a load without a status; :func:`ledger.accepted` and :func:`ledger.rejected`
    split them. Events that are equal in ``at`` and ``seq`` are taken in the order of
    their names. Loads without events have no rows. ``place`` numbers the events of a load in their order.
    """
    spark = events.sparkSession
    columns = ["load_id", "event", "at", "seq"]
    types = {f.name: f.dataType for f in events.select(*columns).schema.fields}
    statuses = current.where("load_id is not null").select(
        F.col("load_id").cast(types["load_id"]), *[F.lit(None).cast(types[c]).alias(c) for c in columns[1:]], F.lit(0).alias("kind"), "status"
    )
    both = statuses.unionByName(events.select(*columns, F.lit(1).alias("kind"), F.lit(None).cast("string").alias("status")))
    # an explicit number, which adaptive execution keeps: a task's range does not grow with the input
    ranges = max(2 * spark.sparkContext.defaultParallelism, math.ceil(both.count() / RANGE_ROWS))
    order = ["load_id", "kind", *ORDER[1:], "event"]
    ranged = both.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    kinds = ", ".join(f"`{c}` {types[c].simpleString()}" for c in columns)
    kinds = f"{kinds}, part int, is_event boolean, place long, status string, so_far array<int>"
    schema = to_arrow_schema(spark.createDataFrame([], kinds).schema)
    path = new_run_dir(spark, "events")
    ranged.mapInArrow(walked(columns, schema), kinds).write.parquet(path)  # the ranges are drawn once
    cut = spark.read.schema(kinds).parquet(path)

    names = F.array(*[F.lit(status) for status in STATUSES])
    # A row a range; a load is chained from the range that holds its status. A status that is none of the automaton's stays as it is.
    chains = cut.where("not is_event").groupBy("load_id").agg(F.array_sort(F.collect_list(F.struct("part", "status", "so_far"))).alias("ends"))
    moved = "try_element_at(names, try_element_at(e.so_far, nullif(cast(array_position(names, found) as int), 0)) + 1)"
    after = f"if(e.so_far is null, e.status, coalesce({moved}, found))"
    chained = chains.withColumn("names", names).select("load_id", "ends", F.expr(f"transform(sequence(1, size(ends)), n -> aggregate(slice(ends, 1, n), cast(null as string), (found, e) -> {after}))").alias("after"))
    entered = chained.select("load_id", F.explode(F.arrays_zip(F.col("ends.part").alias("part"), "after")).alias("x"))
    # The next range follows the one that the load ends (a range holds its upper bound, so none between is empty): a row a range at most.
    entries = entered.select("load_id", (F.col("x.part") + 1).alias("part"), F.col("x.after").alias("entry"))
    joined = cut.where("is_event").join(F.broadcast(entries), ["load_id", "part"], "left")
    state = F.expr("try_element_at(so_far, nullif(cast(array_position(__names, entry) as int), 0))") + 1
    status = F.when(F.col("so_far").isNull(), F.col("status")).otherwise(F.coalesce(F.try_element_at("__names", state), "entry"))
    rules = F.create_map(*[x for (before, event), following in TRANSITIONS.items() for x in (F.lit(f"{before} {event}"), F.lit(following))])
    found = joined.withColumn("__names", names).withColumn("status", status)
    found = found.withColumn("next_status", F.try_element_at(rules, F.concat("status", F.lit(" "), "event")))
    return found.select(*columns, "status", "next_status", (F.col("part").cast("long") * (1 << 40) + F.col("place")).alias("place"))


def folded_status(current: DataFrame, folded: DataFrame) -> DataFrame:
    """``load_id, status, applied, rejected`` of every load after its events."""
    # Statuses as numbers are folded without a sort; one that is none of the automaton's never changes.
    names = F.array(*[F.lit(status) for status in STATUSES])
    last = folded.groupBy("load_id").agg(
        F.max_by(F.array_position(names, F.coalesce("next_status", "status")), "place").alias("number"),
        F.count("next_status").alias("applied"),
        (F.count("*") - F.count("next_status")).alias("rejected"),
    )
    last = last.select("load_id", F.try_element_at(names, F.nullif(F.col("number").cast("int"), F.lit(0))).alias("last"), "applied", "rejected")
    joined = current.select("load_id", "status").join(last, "load_id", "left")
    return joined.select("load_id", F.coalesce("last", "status").alias("status"), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("applied", "rejected")])
