"""Benchmark decontamination by a prefix-filtered set join.

Every run of ``WINDOW`` item words is a set of tokens that a document must hold
whole. Tokens are ordered by rarity in the corpus. For whole containment the
necessary prefix is one token, the rarest: a document without it cannot hold the
window. Its place in the document fixes where the window would start (positional
bound), which must lie inside the document (length bound); then the words there
are compared one by one. Words inside a window that occurs are hit.

Items are taken in blocks of a bounded number of words, one pass over the documents
each, and a document carries what earlier blocks hit. So no side needs to be small:
documents are never shuffled, and what is sent to the tasks never exceeds a block.

Edge cases: a null text has no words and is not contaminated; a document shorter
than a window cannot hold it; an item of fewer words than a window is one window of
all its words; an item without words or with a null text matches nothing; items that
repeat are all reported, a null ``item_id`` as none; rows of documents that repeat
are judged each for itself; an empty table on either side gives no hits. Of the
inputs only ``doc_id``, ``text`` and ``item_id`` are read, so other columns may
have any name.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.llm.scratch import free_worker

WINDOW = 10

#: Words of all windows that are sent to the tasks at once: about 100 MB there.
BLOCK_WORDS = 1_000_000

#: UTF-8 bytes: A-Z in lower case; every ASCII character but letters and digits separates words.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))

HITS = "doc_id long, text string, hits array<struct<start:int,length:int>>, items array<long>, n_words long"
HIT_FIELDS = [
    ("doc_id", pa.int64()),
    ("text", pa.string()),
    ("hits", pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))),
    ("items", pa.list_(pa.int64())),
    ("n_words", pa.int64()),
]

Window = tuple[bytes, ...]


def benchmark_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


def item_windows(text: str | None, width: int) -> list[Window]:
    words = benchmark_words(text)
    return [tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []


def blocks_of_items(items: DataFrame, width: int, block_words: int) -> Iterator[dict[Window, set[int]]]:
    """Windows with the items that hold them, a bounded number at a time; the driver never holds more than a block."""
    block: dict[Window, set[int]] = defaultdict(set)
    size = 0
    for item_id, text in items.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        for window in item_windows(text, width):
            size += 0 if window in block else len(window)
            block[window].update([] if item_id is None else [item_id])
            if size >= block_words:
                yield dict(block)
                block, size = defaultdict(set), 0
    if block:
        yield dict(block)


def counting(wanted: frozenset[bytes]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Occurrences of the wanted words, a row per word and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker()
        counts = dict.fromkeys(wanted, 0)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for word in filter(wanted.__contains__, benchmark_words(text)):
                    counts[word] += 1
        found = {w: n for w, n in counts.items() if n}
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

    return run


def rarest_places(windows: dict[Window, set[int]], counts: dict[bytes, int]) -> dict[bytes, list[tuple[int, Window]]]:
    """For each prefix token, the windows it stands for and its place in them."""
    places: dict[bytes, list[tuple[int, Window]]] = defaultdict(list)
    for window in windows:
        at = min(range(len(window)), key=lambda i: (counts.get(window[i], 0), window[i]))
        if all(word in counts for word in window):  # else no document holds it
            places[window[at]].append((at, window))
    return dict(places)


def matching(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker()
        windows, places = shared.value
        for batch in batches:
            hits, items, sizes = batch.column(2).to_pylist(), batch.column(3).to_pylist(), []
            for row, text in enumerate(batch.column(1).to_pylist()):
                words = benchmark_words(text)
                sizes.append(len(words))
                if places.keys().isdisjoint(words):
                    continue
                found = set()
                for i, word in enumerate(words):
                    for at, window in places.get(word, ()):
                        start = i - at
                        if start >= 0 and start + len(window) <= len(words) and tuple(words[start : start + len(window)]) == window:
                            found.add((start, len(window)))
                            items[row] = sorted({*items[row], *windows[window]})
                hits[row] = sorted({(h["start"], h["length"]) for h in hits[row]} | found)
                hits[row] = [{"start": s, "length": n} for s, n in hits[row]]
            columns = [batch.column(0), batch.column(1), hits, items, sizes]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, (_, t) in zip(columns, HIT_FIELDS, strict=True)], names=[n for n, _ in HIT_FIELDS])

    return run


def benchmark_hits(docs: DataFrame, items: DataFrame, width: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Each document with its ``hits`` (runs of words, from 0), the ``items`` it holds windows of, and ``n_words``."""
    spark = docs.sparkSession
    found = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.array().cast("array<struct<start:int,length:int>>").alias("hits"),
        F.array().cast("array<long>").alias("items"),
        F.lit(0).cast("long").alias("n_words"),
    )
    # With no item left the (then empty) block is still matched: it counts the words.
    blocks = 0
    for windows in blocks_of_items(items, width, block_words):
        wanted = frozenset(word for window in windows for word in window)
        counts = docs.select("text").mapInArrow(counting(wanted), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
        rarity = {bytes(word): n for word, n in counts.collect()}  # of the block's words only
        shared = spark.sparkContext.broadcast((windows, rarest_places(windows, rarity)))
        found = found.mapInArrow(matching(shared), HITS)
        blocks += 1
    if not blocks:
        found = found.mapInArrow(matching(spark.sparkContext.broadcast(({}, {}))), HITS)
    return found


def hit_words(hits: Column) -> Column:
    """Number of words in the union of the runs, which are sorted by start."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def step(state: Column, hit: Column) -> Column:
        end = hit["start"] + hit["length"]
        new = F.greatest(F.lit(0), end - F.greatest(state["end"], hit["start"]))
        return F.struct(F.greatest(state["end"], end).alias("end"), (state["n"] + new).alias("n"))

    return F.aggregate(hits, zero, step)["n"]


def without_contaminated(docs: DataFrame, items: DataFrame, width: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no window of any item.

    Contaminated texts are few (a benchmark is small against a corpus), but their
    number has no bound, so their ids are joined, not sent to every task. Rows that
    share a ``doc_id`` are told apart by their text.
    """
    bad = benchmark_hits(docs, items, width).filter(F.size("hits") > 0)
    keys = bad.select(F.col("doc_id").alias("bad_id"), F.xxhash64("text").alias("bad_text")).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(keys["bad_id"]) & (F.xxhash64(docs["text"]) == keys["bad_text"])
    return docs.join(keys, same, "left_anti")
