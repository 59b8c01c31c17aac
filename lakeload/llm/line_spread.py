"""Boilerplate lines by the number of distinct sites they spread over.

A line is boilerplate if it stands in documents of at least ``min_sites`` distinct sites and in
at least ``min_texts`` distinct texts. Its first document (smallest ``doc_id``, then text) keeps
it, all others lose it: the corpus loses no content. Lines are compared with the white space
around them cut off; those shorter than ``min_chars`` code points stay. Every document counts
with its own site, copies too. A line of one text alone, however often that was copied whole,
is not boilerplate: whole copies are for near-duplicate removal.

Sites of a line are counted by HyperLogLog sketches, built per line hash from its sites before
the shuffle and merged by aggregation. Sketches decide where the estimate is clear; near the
threshold the distinct sites are counted exactly. Distinct texts are counted exactly.

Everything is built-in functions, and no text is shuffled but through its lines' hashes:
lines to be removed come back to a document as positions.

Edge cases: a null or empty text has no lines and stays as it is; a null source is a site
of its own; rows that repeat are copies of one text, and where rows also share the ``doc_id``
they all keep or all lose a line; an empty table gives no rows. All columns of the input are
kept; a column may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.llm.scratch import few, written

MIN_SITES = 8
MIN_TEXTS = 2
MIN_CHARS = 20

#: Sketches of 2^12 registers; estimates within a fifth of the threshold are counted exactly (12 standard errors).
SKETCH_BITS = 12
BAND = 0.2

#: White space around a line that does not count.
SPACE = " \t\r\f\x0b"

LINE = ["line", "line_check"]
TEXT = ["text_hash", "text_check"]


def two_hashes(value: Column) -> list[Column]:
    """128 bits together."""
    return [F.xxhash64(value), F.xxhash64(F.lit(1), value)]


def long_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """Each line that counts, as hashes, with its place and the text and site it stands in."""
    trimmed = F.btrim(F.col("at.line"), F.lit(SPACE))
    text = [h.alias(c) for h, c in zip(two_hashes(F.col("text")), TEXT, strict=True)]
    lines = F.transform(F.split("text", "\n"), lambda line, i: F.struct(line.alias("line"), i.alias("place")))
    long = F.filter(lines, lambda at: F.length(at["line"]) >= min_chars)
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("site"), *text, F.explode(long).alias("at"))
        .select("doc_id", "site", *TEXT, F.col("at.place").alias("place"), trimmed.alias("trimmed"))
        .filter(F.length("trimmed") >= min_chars)
        .select("doc_id", "site", *TEXT, "place", *[h.alias(c) for h, c in zip(two_hashes(F.col("trimmed")), LINE, strict=True)])
    )


def distinct_within(lines: DataFrame, chosen: DataFrame, columns: list[str], least: int) -> DataFrame:
    """The chosen lines with at least ``least`` distinct values of ``columns``, counted exactly."""
    pairs = lines.join(few(chosen.select(*LINE)), LINE, "left_semi").groupBy(*LINE, *columns).count()
    return pairs.groupBy(*LINE).count().filter(F.col("count") >= least).select(*LINE)


def boilerplate(lines: DataFrame, min_sites: int, min_texts: int = MIN_TEXTS) -> DataFrame:
    """``line, line_check`` and the ``keeper`` (doc_id and text) of each line on enough sites and in enough texts."""
    keeper = F.min(F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("doc_id"), *TEXT)).alias("keeper")
    sites = F.hll_sketch_estimate(F.hll_sketch_agg("site", SKETCH_BITS)).alias("sites")
    spread = written(lines.groupBy(*LINE).agg(sites, keeper), "line-spread")
    clear = spread.filter(F.col("sites") > min_sites * (1 + BAND))
    near = spread.filter((F.col("sites") <= min_sites * (1 + BAND)) & (F.col("sites") >= min_sites * (1 - BAND)))
    exact = near.join(distinct_within(lines, near, ["site"], min_sites), LINE, "left_semi")
    reached = written(clear.unionByName(exact).select(*LINE, "keeper"), "spread-lines")
    return written(reached.join(distinct_within(lines, reached, TEXT, min_texts), LINE, "left_semi"), "boilerplate")


def removed_places(docs: DataFrame, min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS, min_texts: int = MIN_TEXTS) -> DataFrame:
    """``doc_id, text_hash, text_check, places``: lines (from 0) to be removed of the documents that lose any."""
    lines = long_lines(docs, min_chars)
    # a line of one site only cannot reach the threshold: most lines end here
    several = lines.groupBy(*LINE).agg(F.min(F.xxhash64("site")).alias("low"), F.max(F.xxhash64("site")).alias("high")).filter(F.col("low") != F.col("high"))
    candidates = written(lines.join(few(written(several.select(*LINE), "repeated-lines")), LINE, "left_semi"), "line-places")
    found = candidates.join(few(boilerplate(candidates, min_sites, min_texts)), LINE)
    kept = F.col("keeper.doc_id").eqNullSafe(F.coalesce("doc_id", F.lit(2**63 - 1)))
    kept = kept & (F.col("keeper.text_hash") == F.col("text_hash")) & (F.col("keeper.text_check") == F.col("text_check"))
    return written(found.filter(~kept).groupBy("doc_id", *TEXT).agg(F.collect_set("place").alias("places")), "removed-lines")


def without_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS, min_texts: int = MIN_TEXTS) -> DataFrame:
    """The rows and columns of ``docs``, boilerplate lines cut from ``text``, and ``n_removed_lines``."""
    removed = few(removed_places(docs, min_sites, min_chars, min_texts).toDF("lost_id", "lost_text", "lost_check", "lost_places"))
    hashes, places = two_hashes(docs["text"]), removed["lost_places"]
    same = docs["doc_id"].cast("long").eqNullSafe(removed["lost_id"]) & (hashes[0] == removed["lost_text"]) & (hashes[1] == removed["lost_check"])
    left = F.filter(F.split(docs["text"], "\n"), lambda _, i: ~F.array_contains(places, i))
    text = F.when(places.isNull(), docs["text"]).otherwise(F.array_join(left, "\n"))
    lost = F.coalesce(F.array_size(places), F.lit(0)).cast("long")
    columns = [text.alias(c) if c == "text" else docs[c] for c in docs.columns if c != "n_removed_lines"]
    return docs.join(removed, same, "left").select(*columns, lost.alias("n_removed_lines"))
