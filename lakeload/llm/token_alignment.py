"""Aligning the tokens of two vocabularies over the same bytes.

Every text is tokenised whole by both vocabularies. Where a token of either ends,
the next token of both begins with a space, and the ends are the same byte, lies an
anchor: anchors split the document into windows of token ids. Inside a window the
tokens are walked by their byte ends, which gives the groups (cut where both end)
and the links (token pairs whose bytes overlap); the result for a pair of id tuples
is remembered per worker, as texts repeat their words. Counts of linked id pairs
over all documents then weigh the links of each.

Edge cases: null and empty texts, and texts whose tokens do not join to a space and
the text in both vocabularies (one with U+2581 in it, say), have no tokens: zeros
and empty lists. Names of special tokens in a text are ordinary text. Rows that
repeat count as documents of their own; a null ``doc_id`` is carried along; ties for
an id's highest count are all best; an empty table gives no rows. Of the input only
``doc_id`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.piece_agenda import default_model, text_slices, vocabulary
from lakeload.llm.scratch import SENT_IDS, written
from lakeload.llm.tokens import default_vocabulary, text_tokens

#: Windows, and tokens in them, that a Python worker remembers before it starts anew.
REMEMBERED_WINDOWS = 300_000
REMEMBERED_TOKENS = 4_000_000

#: A pair of ids as one number: the first id times this, plus the second.
PAIR_BASE = 1 << 32

#: In the key of a window the ids of the second vocabulary follow those of the first, with this bit set.
SECOND = 1 << 30

ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, links array<long>"


def byte_level_bytes() -> dict[str, int]:
    """Characters of a byte-level vocabulary -> bytes: printable ones stand for themselves, the others count on from 256."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Windows:
    """Alignments of windows met so far, by number."""

    def __init__(self, a_length: np.ndarray, b_length: np.ndarray) -> None:
        self.a_length, self.b_length = a_length, b_length
        # Ids as text with what follows them: a comma, or a bar or semicolon at the end of their side of a group.
        self.shown = [f"{i}{end}" for n, close in ((len(a_length), "|"), (len(b_length), ";")) for i in range(n) for end in (",", close)]
        self.shown_length = np.array(list(map(len, self.shown)), np.int64)
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.texts: list[str] = []
        self.held_tokens = 0
        # By window: groups, links, and where its pairs end; by place: pair, and links of it.
        self.n_groups, self.n_links, self.pair_ends = array("q"), array("q"), array("q", [0])
        self.pairs, self.pair_links = array("q"), array("q")

    def add(self, keys: list[bytes]) -> None:
        """Walk new windows side by side, and number them.

        A pair of tokens overlaps in one stretch of bytes, so the ends of all tokens
        cut a window into one stretch for each link.
        """
        ids, sizes = np.frombuffer(b"".join(keys), "<i4").astype(np.int64), np.fromiter(map(len, keys), np.int64, len(keys)) // 4
        second = ids >= SECOND
        a, b = ids[~second], ids[second] - SECOND
        a_ends, b_ends = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        window_ends = a_ends[np.cumsum(np.bincount(np.repeat(np.arange(len(keys)), sizes)[~second], minlength=len(keys))) - 1]

        stretches = np.union1d(a_ends, b_ends)
        pairs = a[np.searchsorted(a_ends, stretches)] * PAIR_BASE + b[np.searchsorted(b_ends, stretches)]
        window = np.searchsorted(window_ends, stretches)
        distinct, at = np.unique(pairs, return_inverse=True)
        both, times = np.unique(window * len(distinct) + at, return_counts=True)
        held_by, at = np.divmod(both, len(distinct))
        shared = np.intersect1d(a_ends, b_ends, assume_unique=True)

        a_group, b_group = np.searchsorted(shared, a_ends), np.searchsorted(shared, b_ends)
        shown = np.r_[2 * a + (a_ends == shared[a_group]), 2 * (len(self.a_length) + b) + (b_ends == shared[b_group])]
        order = np.argsort(np.r_[2 * a_group, 2 * b_group + 1], kind="stable")
        text = "".join(map(self.shown.__getitem__, shown[order].tolist()))
        sizes = np.bincount(np.searchsorted(window_ends, np.r_[a_ends, b_ends]), self.shown_length[shown], len(keys)).astype(np.int64)
        text_ends = np.cumsum(sizes)

        first = len(self.texts)
        self.texts += [text[i : j - 1] for i, j in zip((text_ends - sizes).tolist(), text_ends.tolist())]
        for held, values in (
            (self.n_groups, np.bincount(np.searchsorted(window_ends, shared), minlength=len(keys))),
            (self.n_links, np.bincount(window, minlength=len(keys))),
            (self.pair_ends, len(self.pairs) + np.cumsum(np.bincount(held_by, minlength=len(keys)))),
            (self.pairs, distinct[at]),
            (self.pair_links, times),
        ):
            held.frombytes(values.astype(np.int64).tobytes())
        self.held_tokens += len(a) + len(b)
        self.numbers.update(zip(keys, range(first, first + len(keys)), strict=True))

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.frombuffer(x, np.int64) if len(x) else np.zeros(0, np.int64) for x in (self.n_groups, self.n_links, self.pair_ends, self.pairs, self.pair_links))


class Aligner:
    """Two vocabularies and the windows aligned so far."""

    def __init__(self, a_path: str, b_path: str) -> None:
        self.a_tokens, self.b_tokens = text_tokens(a_path), vocabulary(b_path)
        to_byte = byte_level_bytes()
        names = self.a_tokens.tokenizer.get_vocab()
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.a_bytes[i] = bytes(to_byte[c] for c in name if c in to_byte)
        self.b_bytes = [bytes([self.b_tokens.byte_of[i]]) if i in self.b_tokens.byte_of else text.encode() for i, text in enumerate(self.b_tokens.shown)]
        self.a_length, self.b_length = (np.array([len(x) for x in some], np.int64) for some in (self.a_bytes, self.b_bytes))
        self.a_spaced, self.b_spaced = (np.array([x[:1] == b" " for x in some]) for some in (self.a_bytes, self.b_bytes))
        self.windows = Windows(self.a_length, self.b_length)

    def joined(self, text: str, a_ids: bytes, b_ids: bytes) -> bool:
        """Whether the tokens of both vocabularies join to a space and the text."""
        a, b, whole = np.frombuffer(a_ids, "<i4"), np.frombuffer(b_ids, "<i4"), f" {text}".encode()
        return b"".join(map(self.a_bytes.__getitem__, a.tolist())) == whole and b"".join(map(self.b_bytes.__getitem__, b.tolist())) == whole

    def window_keys(self, a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        """The windows of texts one after the other, as keys, and their first tokens in the first vocabulary.

        Every text begins with a space, so where one ends is an anchor.
        """
        a_last, b_last = (np.flatnonzero(np.r_[spaced[ids[1:]], True]) for ids, spaced in ((a, self.a_spaced), (b, self.b_spaced)))
        at_a, at_b = (np.zeros(a_ends[-1] + 1, bool) for _ in range(2))
        at_a[a_ends[a_last]], at_b[b_ends[b_last]] = True, True
        a_stops, b_stops = a_last[at_b[a_ends[a_last]]] + 1, b_last[at_a[b_ends[b_last]]] + 1
        a_starts, b_starts = np.r_[0, a_stops[:-1]], np.r_[0, b_stops[:-1]]
        ids = np.empty(len(a) + len(b), "<i4")
        ids[np.arange(len(a)) + np.repeat(b_starts, a_stops - a_starts)] = a
        ids[np.arange(len(b)) + np.repeat(a_stops, b_stops - b_starts)] = b + SECOND
        packed, stops = ids.tobytes(), (4 * (a_stops + b_stops)).tolist()
        return [packed[i:j] for i, j in zip([0, *stops], stops)], a_starts

    def align(self, doc_ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
        """Alignments of a few texts."""
        held = self.windows
        if len(held.texts) > REMEMBERED_WINDOWS or held.held_tokens > REMEMBERED_TOKENS:
            held.clear()
        b_ids = self.b_tokens.encode(texts)
        a_ids = [self.a_tokens.packed(f" {text}") if text else b"" for text in texts]
        whole = [bool(text) and self.joined(text, a, b) for text, a, b in zip(texts, a_ids, b_ids)]
        filled = np.array(whole, np.int64)
        lengths = [np.array([len(x) // 4 for x in ids], np.int64) * filled for ids in (a_ids, b_ids)]
        docs, windows = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if any(whole):
            a, b = (np.frombuffer(b"".join([x for x, some in zip(ids, whole) if some]), "<i4") for ids in (a_ids, b_ids))
            keys, starts = self.window_keys(a, b, np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b]))
            docs = np.searchsorted(np.cumsum(lengths[0]), starts, "right")
            windows = np.fromiter(map(held.numbers.get, keys, repeat(-1)), np.int64, len(keys))
            missing = np.flatnonzero(windows < 0).tolist()
            if missing:
                new = [keys[i] for i in missing]
                held.add(list(dict.fromkeys(new)))
                windows[missing] = list(map(held.numbers.__getitem__, new))
        groups, links, ends, pairs, pair_links = held.arrays()
        shown = list(map(held.texts.__getitem__, windows.tolist()))
        cuts = [0, *np.cumsum(np.bincount(docs, minlength=len(texts))).tolist()]
        # (document, window) with its number of times, then (document, pair) with its number of links
        both, times = np.unique(docs * max(len(groups), 1) + windows, return_counts=True)
        doc, window = np.divmod(both, max(len(groups), 1))
        sizes = ends[window + 1] - ends[window] if len(window) else np.zeros(0, np.int64)
        places = np.arange(sizes.sum()) + np.repeat(ends[window] - np.cumsum(sizes) + sizes if len(window) else sizes, sizes)
        distinct, at = np.unique(pairs[places], return_inverse=True)
        both, at = np.unique(np.repeat(doc, sizes) * max(len(distinct), 1) + at, return_inverse=True)
        counts = np.bincount(at, np.repeat(times, sizes) * pair_links[places], len(both)).astype(np.int64)
        doc, pair = np.divmod(both, max(len(distinct), 1))
        offsets = np.r_[0, np.cumsum(np.bincount(doc, minlength=len(texts)))].astype("int32")
        total = [np.bincount(docs, x[windows], len(texts)).astype(np.int64) if len(docs) else filled for x in (groups, links)]
        return pa.RecordBatch.from_arrays(
            [
                doc_ids,
                *(pa.array(x) for x in (*lengths, *total)),
                pa.array([";".join(shown[i:j]) for i, j in zip(cuts, cuts[1:])], pa.string()),
                *(pa.ListArray.from_arrays(pa.array(offsets), pa.array(x)) for x in (distinct[pair], counts)),
            ],
            names=[field.split(" ")[0] for field in ALIGNED.split(", ")],
        )


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def alignment(a_path: str, b_path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = aligner(a_path, b_path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for first, end in text_slices(texts):
                yield tokens.align(batch.column(0)[first:end], texts[first:end])

    return run


def aligned_documents(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Every document's token counts, ``groups`` (``a1,a2|b1;a3|b2,b3``), and its distinct linked id pairs with their links.

    A pair is the first vocabulary's id times ``PAIR_BASE`` plus the second's.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(alignment(a_path or default_vocabulary(), b_path or default_model()), ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, documents, best``: how many documents link a pair, and whether no pair of its first id has more."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("documents"))
    counts = written(counts, "pairs")
    first = F.expr(f"pair div {PAIR_BASE}")
    # One row per id of the first vocabulary at most.
    highest = counts.groupBy(first.alias("first")).agg(F.max("documents").alias("highest"))
    joined = counts.withColumn("first", first).join(F.broadcast(highest), "first")
    return written(joined.select("pair", "documents", (F.col("documents") == F.col("highest")).alias("best")), "weights")


def frequent_from(counts: DataFrame, limit: int) -> int:
    """The least power of two that at most ``limit`` pairs reach: their rows can be sent to every task."""
    sizes = counts.groupBy(F.floor(F.log2("documents")).cast("int").alias("power")).count().collect()
    power, held = 64, 0
    for row in sorted(sizes, key=lambda r: -r["power"]):
        if held + row["count"] > limit:
            break
        power, held = row["power"], held + row["count"]
    return 1 << min(power, 62)


def with_pair_counts(aligned: DataFrame, sent: int = SENT_IDS // 4) -> DataFrame:
    """``aligned`` (with a unique ``row``) with ``n_best`` and ``count_sum`` instead of its pairs.

    Pairs that very many documents hold are sent to the tasks, a counted number
    of them; the others are joined by a shuffle, in which none is frequent.
    """
    weights = pair_counts(aligned)
    least = frequent_from(weights, sent)
    held = aligned.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.links").alias("links"))
    frequent = held.join(F.broadcast(weights.filter(F.col("documents") >= least)), "pair", "left")
    sums = [F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"), F.sum(F.col("links") * F.col("documents")).alias("count_sum")]
    found = frequent.filter(F.col("documents").isNotNull()).groupBy("row").agg(*sums)
    rare = weights.filter(F.col("documents") < least)
    if not rare.isEmpty():
        others = frequent.filter(F.col("documents").isNull()).select("row", "pair", "links").join(rare, "pair").groupBy("row").agg(*sums)
        found = found.unionByName(others).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    joined = aligned.drop("pairs", "links").join(found, "row", "left")
    return joined.withColumns({name: F.coalesce(name, F.lit(0).cast("long")) for name in ("n_best", "count_sum")})


def align_documents(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Alignments of all documents with the corpus-wide weight of their links; ``groups`` included."""
    aligned = aligned_documents(docs, a_path, b_path).withColumn("row", F.monotonically_increasing_id())
    return with_pair_counts(written(aligned, "aligned"))
