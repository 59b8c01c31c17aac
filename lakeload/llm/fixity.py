"""Merkle fixity audit of WARC replicas.

Each record has a digest; the records that start in one range of offsets are hashed
together in order, and ranges are hashed sixteen by sixteen into a tree over all files
of a replica. Two replicas are equal if their roots are. If not, only the children of
nodes that differ are compared, level by level, down to the ranges, whose records are
then compared one by one.

Every node is hashed from a bounded number of parts: a range holds no more records
than record headers fit into it, an inner node sixteen children.

Edge cases: two empty replicas are equal; an empty one misses all records; a null payload
is an empty one; a null record id is compared by place like all others; records that
repeat stand at different places; of the inputs only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeload.llm.scratch import few, written

#: Bytes of a leaf range; children of an inner node; ranges of a file (its last one holds what lies beyond 4 GB).
RANGE_BYTES = 1 << 16
FAN = 16
FILE_RANGES = FAN**4

RECORDS_PER_FILE = 512

LINE_END = "\r\n"


def warc_record(record_id: Column, url: Column, html: Column) -> Column:
    """A WARC response record as text."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit(f"WARC/1.1{LINE_END}WARC-Type: response{LINE_END}WARC-Record-ID: <urn:page:"),
        F.coalesce(record_id.cast("string"), F.lit("")),
        F.lit(f">{LINE_END}WARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit(f"{LINE_END}Content-Type: text/html{LINE_END}Content-Length: "),
        F.octet_length(body).cast("string"),
        F.lit(LINE_END * 2),
        body,
        F.lit(LINE_END * 2),
    )


def page_records(pages: DataFrame, records_per_file: int = RECORDS_PER_FILE) -> DataFrame:
    """``record_id, file_no, offset, length, digest`` of the pages as WARC records.

    Files hold ids by hundreds, in order. Digests and lengths are taken where pages are
    read, so no payload is shuffled to find the offsets.
    """
    record = warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    file_no = F.pmod(F.floor(F.coalesce(F.col("page_id"), F.lit(0)) / records_per_file), F.lit(1 << 31))
    hashed = pages.select(F.col("page_id").cast("long").alias("record_id"), file_no.cast("long").alias("file_no"), record.alias("record")).select(
        "record_id", "file_no", F.octet_length("record").cast("long").alias("length"), F.sha2(F.col("record").cast("binary"), 256).alias("digest")
    )
    ahead = Window.partitionBy("file_no").orderBy("record_id", "length").rowsBetween(Window.unboundedPreceding, -1)
    return hashed.select("record_id", "file_no", F.coalesce(F.sum("length").over(ahead), F.lit(0)).alias("offset"), "length", "digest")


def hash_of(parts: Column) -> Column:
    return F.sha2(F.array_join(parts, "\n"), 256)


def range_node() -> Column:
    return F.col("file_no") * FILE_RANGES + F.least(F.floor(F.col("offset") / RANGE_BYTES), F.lit(FILE_RANGES - 1))


def tree(records: DataFrame, last: int) -> list[DataFrame]:
    """Levels of a replica's tree (``node, hash``) over the ranges 0 to ``last``, ranges first."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "digest")))
    line = lambda p: F.concat_ws(" ", p["offset"].cast("string"), p["length"].cast("string"), p["digest"])
    level = written(records.withColumn("node", range_node()).groupBy("node").agg(hash_of(F.transform(parts, line)).alias("hash")), "fixity-ranges")
    levels = [level]
    while last > 0:
        children = F.array_sort(F.collect_list(F.struct("node", "hash")))
        child = lambda c: F.concat_ws(" ", c["node"].cast("string"), c["hash"])
        above = level.groupBy(F.expr(f"node div {FAN}").alias("node")).agg(hash_of(F.transform(children, child)).alias("hash"))
        last //= FAN
        level = written(above, "fixity-level")
        levels.append(level)
    return levels


def differing(a: DataFrame, b: DataFrame, within: DataFrame | None) -> DataFrame:
    """Nodes of a level whose hashes differ, or that one replica lacks, below the nodes ``within``."""
    if within is not None:
        parents = few(within).withColumnRenamed("node", "parent")
        below = lambda level: level.join(parents, F.expr(f"node div {FAN}") == F.col("parent"), "left_semi")
        a, b = below(a), below(b)
    both = a.join(b.withColumnRenamed("hash", "other"), "node", "full_outer")
    return written(both.filter(~F.col("hash").eqNullSafe(F.col("other"))).select("node"), "fixity-differing")


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """Records in which two replicas differ: ``record_id, file_no, offset, length, digest, found_digest, status``.

    ``status`` is ``corrupt`` (other bytes at the place), ``missing`` or ``extra`` (in the replica alone).
    """
    primary, replica = written(primary, "fixity-primary"), written(replica, "fixity-replica")
    last = max(records.agg(F.coalesce(F.max(range_node()), F.lit(0))).first()[0] for records in (primary, replica))
    ours, theirs = tree(primary, last), tree(replica, last)
    nodes = None
    for a, b in zip(reversed(ours), reversed(theirs), strict=True):
        nodes = differing(a, b, nodes)
        if not nodes.head(1):
            break
    pick = lambda records: records.withColumn("node", range_node()).join(few(nodes), "node", "left_semi").drop("node")
    a, b = pick(primary), pick(replica)
    b = b.select(F.col("record_id").alias("found_id"), "file_no", "offset", F.col("length").alias("found_length"), F.col("digest").alias("found_digest"))
    both = a.join(b, ["file_no", "offset"], "full_outer")
    status = F.when(F.col("found_digest").isNull(), "missing").when(F.col("digest").isNull(), "extra").otherwise("corrupt")
    changed = ~(F.col("digest").eqNullSafe(F.col("found_digest")) & F.col("length").eqNullSafe(F.col("found_length")))
    return both.filter(changed).select(
        F.coalesce("record_id", "found_id").alias("record_id"), "file_no", "offset", F.coalesce("length", "found_length").alias("length"), "digest", "found_digest", status.alias("status")
    )
