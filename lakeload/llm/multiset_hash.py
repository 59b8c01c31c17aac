"""Homomorphic multiset hash of a document's paragraphs.

A text is the multiset of its paragraphs (lines). Each is hashed to a wide vector;
the fingerprint is the sum of the vectors, lane by lane, modulo a power of two.
So it does not depend on the order of paragraphs, and inserting or deleting one adds
or subtracts its vector without reading the rest.

The vector has two parts. ``EXACT`` lanes of 64 bits are a hash of the whole
paragraph: different multisets agree in all of them only by chance (1 in 2^512, not
meant against an adversary). ``ALIKE`` lanes of 32 bits hold the paragraph's pairs of
words, each counted as +1 or -1 in the lane its hash names; the cosine of two such sums
estimates the likeness of the two multisets of word pairs, with a standard error of
about 1 / sqrt(ALIKE). No text that fits a row has pairs enough to overflow a lane.

Edge cases: a null text is empty, and an empty text has the fingerprint of no
paragraph (all zero); texts with equal fingerprints are alike by 1, and nothing is alike
to an empty text but another one. Fingerprints of texts that differ only in the order
of their paragraphs are equal, by design. Of the input only ``doc_id`` and ``text``
are read.

The next document is the one that follows by descending ``doc_id`` (then by text; nulls
last), the first one after the last. Each partition holds a range of ids and, as a guest,
the document that its last one needs, so texts are shuffled once.
"""

from __future__ import annotations

import base64
import hashlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.words import U64, hashed, mixed, runs, space_words

EXACT = 8
ALIKE = 128

LANES = np.arange(1, EXACT + 1, dtype=U64)

FINGERPRINTS = "doc_id long, n_chars long, fingerprint string"
EDITED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


class Sum:
    """The fingerprint as numbers: exact lanes modulo 2^64, alike lanes modulo 2^32."""

    __slots__ = ("alike", "exact")

    def __init__(self, exact: np.ndarray | None = None, alike: np.ndarray | None = None) -> None:
        self.exact = np.zeros(EXACT, U64) if exact is None else exact
        self.alike = np.zeros(ALIKE, np.int64) if alike is None else alike

    def __add__(self, other: Sum) -> Sum:
        return Sum(self.exact + other.exact, self.alike + other.alike)

    def __sub__(self, other: Sum) -> Sum:
        return Sum(self.exact - other.exact, self.alike - other.alike)

    def text(self) -> str:
        return base64.b64encode(self.exact.astype("<u8").tobytes() + (self.alike & 0xFFFFFFFF).astype("<u4").tobytes()).decode()

    def likeness(self, other: Sum) -> float:
        """Between 0 and 1; of the alike lanes as they are stored."""
        a, b = ((s.alike & 0xFFFFFFFF).astype(np.uint32).view(np.int32).astype(np.float64) for s in (self, other))
        if np.array_equal(self.exact, other.exact) and np.array_equal(a, b):
            return 1.0
        size = float(np.sqrt(a.dot(a) * b.dot(b)))
        return float(min(1.0, max(0.0, a.dot(b) / size))) if size else 0.0


def paragraphs(text: str) -> list[str]:
    return text.split("\n") if text else []


def vector_sum(parts: Iterable[str]) -> Sum:
    """Sum of the vectors of paragraphs."""
    exact = np.zeros(EXACT, U64)
    pairs = []
    for part, times in Counter(parts).items():
        key = np.full(EXACT, xxhash.xxh3_64_intdigest(part.encode("utf-8", "surrogatepass")), U64)
        exact += mixed(mixed(key) + LANES) * U64(times)
        pairs.append((runs(hashed(space_words(part)), 2), times))
    alike = np.zeros(ALIKE, np.int64)
    if pairs:
        values = np.concatenate([v for v, _ in pairs])
        weight = np.repeat([t for _, t in pairs], [len(v) for v, _ in pairs])
        sign = np.where(values >> U64(63), -1, 1) * weight
        alike = np.bincount((values % U64(ALIKE)).astype(np.int64), sign, ALIKE).astype(np.int64)
    return Sum(exact, alike)


def changed(whole: Sum, before: list[str], after: list[str]) -> Sum:
    """``whole`` with the paragraphs ``before`` deleted and ``after`` inserted."""
    return whole - vector_sum(before) + vector_sum(after)


def fingerprinting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [text or "" for text in batch.column(1).to_pylist()]
        sums = [vector_sum(paragraphs(text)).text() for text in texts]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(sums)], names=["doc_id", "n_chars", "fingerprint"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, fingerprint`` (base64 of all lanes) of each row."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(fingerprinting, FINGERPRINTS)


def edit(text: str, following: str) -> str:
    """The last third of a text replaced by the first code points of the following one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def edited_row(doc_id: int | None, text: str, own: Sum, following: str, next_sum: Sum) -> tuple:
    other = edit(text, following)
    kept = text[: len(text) - len(text) // 3]
    same = kept.count("\n")  # paragraphs that end in the kept part are the same in both
    edited = changed(own, paragraphs(text)[same:], paragraphs(other)[same:])
    digest = hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest()
    return doc_id, len(text), digest, own.text(), edited.text(), own.likeness(edited), own.likeness(next_sum)


def following_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents in order, each part with its guests at the end -> a row for each document but the guests."""
    held = None
    names = [c.split(" ")[0] for c in EDITED.split(", ")]
    for batch in batches:
        rows = []
        for part, guest, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            own = vector_sum(paragraphs(text))
            if held and held[0] == part:
                rows.append(edited_row(*held[1:], text, own))
            held = None if guest else (part, doc_id, text, own)
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, EDITED_TYPES, strict=True)], names=names)


EDITED_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

#: Stands for a null id where ids are ordered.
LAST_ID = -(2**63)


def range_bounds(docs: DataFrame, parts: int) -> list[int]:
    """Ids that cut the table into ranges of about equal numbers of rows; one per partition, as a range shuffle has."""
    shares = [i / parts for i in range(1, parts)]
    row = docs.select(F.percentile_approx(F.col("doc_id").cast("long"), shares, 20_000)).first() if shares else None
    return sorted(set(row[0])) if row and row[0] else []


def range_finder(bounds: list[int]) -> Callable[[Iterator[pd.Series]], Iterator[pd.Series]]:
    """Number of an id's range, from the largest ids down."""
    edges = np.asarray(bounds, np.int64)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for ids in batches:
            yield pd.Series(len(edges) - np.searchsorted(edges, ids.to_numpy(), side="left"), dtype="int32")

    return run


def edited_fingerprints(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprints of each document, of its edited text, and likenesses to that and to the next document."""
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = range_bounds(docs, parts)
    n = len(bounds) + 1
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))
    part = F.pandas_udf(range_finder(bounds), "int")(key)
    rows = docs.select(part.alias("part"), key.alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # The first document of a part is the guest of the part before it; as many ids as there are parts.
    firsts = sorted((r["part"], r["first"]) for r in rows.groupBy("part").agg(F.max("key").alias("first")).collect())
    hosts = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}
    host = F.create_map(*[F.lit(x) for pair in hosts.items() for x in pair]) if hosts else F.create_map().cast("map<long,int>")
    own = F.struct("part", F.lit(False).alias("guest"))
    visit = F.struct(F.get(F.map_values(F.map_filter(host, lambda k, _: k == F.col("key"))), F.lit(0)).alias("part"), F.lit(True).alias("guest"))
    places = F.when(F.col("key").isin(list(hosts)), F.array(own, visit)).otherwise(F.array(own))
    dealt = (
        rows.withColumn("place", F.explode(places))
        .select(F.col("place.part").alias("part"), F.col("place.guest").alias("guest"), "doc_id", "text")
        .repartitionById(n, F.col("part"))
        .sortWithinPartitions("part", "guest", F.desc_nulls_last("doc_id"), "text")
    )
    return dealt.mapInArrow(following_texts, EDITED)
