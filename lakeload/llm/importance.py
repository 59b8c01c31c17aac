"""Quality by importance resampling.

Two generative models over hashed n-grams (words, pairs of words, and words cut to
four and five bytes, which know inflected forms; each kind in buckets of its own): one of
the target, the labelled good texts; one of the raw text, all documents. The log importance
weight of a text is the sum, over its n-grams, of the log ratio of the two, divided by its
words and multiplied by ``LENGTH``: what a text of that many words like it would weigh, so
that the weights of short and long texts compare, and with them the noise. Ratios are
smoothed by a pseudo-count and shrunk by four standard errors of their counts, so that
n-grams too rare to tell weigh nothing and long clean texts gather no noise. An n-gram
counts ``CLIP`` times per text at most, so one text that repeats a phrase does not make
the phrase suspect; the repeats beyond, if they fill a text, are a token of their own.

The sample is drawn without replacement by Gumbel top-k: the k largest of log weight plus
``temperature`` times Gumbel noise. At temperature 1 each draw takes a text in proportion to
its importance weight; texts near the k-th are in or out by chance. Unless given, k is the number of documents whose weight
reaches the cut that parts good from bad labelled texts best. The noise comes from a
hash of the row, so a lost task draws the same again.

The target is fitted on at most ``MAX_LABELS`` labelled rows (those with the smallest
hashes of their ids), the raw model and the weights cover all documents.

Edge cases: a null or empty text weighs 0 (no n-gram); a null ``doc_id`` is scored but has no
label; a document labelled twice is good only if all its labels say so, a null label says
nothing; documents that tie with the k-th are all taken; without labels, or with one kind
only, nothing can be told apart and all rows are selected; an empty table gives no rows.
Of the inputs only ``doc_id``, ``text``, ``quality`` and ``toxic`` are read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.scratch import free_worker, with_ids, written
from lakeload.llm.words import U64, hashed, mixed, runs, word_hashes

#: Labelled rows that the target model is fitted on, at most.
MAX_LABELS = 200_000

#: Buckets of each order, as a power of two.
BITS = 18
BUCKETS = 1 << BITS
PREFIXES = (4, 5)
ORDERS = 2 + len(PREFIXES)

#: Times that one text counts an n-gram at most.
CLIP = 16

#: Repeats beyond CLIP are tokens of this bucket (among the pairs) if the pair is more than 1 in AGAIN_SHARE of the text.
AGAIN = 2 * BUCKETS - 1
AGAIN_SHARE = 20

PSEUDO_COUNT = 0.5
SHRINK_ERRORS = 4.0
TEMPERATURE = 1.0

#: Words of the text that a log weight speaks of.
LENGTH = 200

#: Words and runs of other signs, of lower-cased UTF-8.
TOKEN = re.compile(rb"[0-9a-z_\x80-\xff]+|[^\s0-9a-z_\x80-\xff]+")

SCORED = "doc_id long, good boolean, log_weight double"


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray, int]:
    """Buckets of the n-grams of a whole text, once each, their clipped counts, and the number of words."""
    words = TOKEN.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64), 0
    hashes, shift = hashed(words), U64(64 - BITS)
    kinds = [mixed(hashes), runs(hashes, 2) if len(words) > 1 else hashes[:0]]
    kinds += [mixed(hashed([w[:size] for w in words if len(w) >= size])) for size in PREFIXES]
    buckets = np.concatenate([(kind >> shift).astype(np.int64) + i * BUCKETS for i, kind in enumerate(kinds)])
    found, counts = np.unique(buckets, return_counts=True)
    filling = (found >= BUCKETS) & (found < 2 * BUCKETS) & (counts > max(CLIP, len(words) // AGAIN_SHARE))
    again = int((counts[filling] - CLIP).sum())
    return np.append(found, AGAIN), np.append(np.minimum(counts, CLIP), again), len(words)


def counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(good, text) -> counts of each bucket that occurs, once per task."""
    free_worker(word_hashes)
    raw, target = (np.zeros(ORDERS * BUCKETS, np.int64) for _ in range(2))
    for batch in batches:
        for good, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            buckets, counts, _ = ngram_counts(text)
            np.add.at(raw, buckets, counts)
            if good:
                np.add.at(target, buckets, counts)
    found = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(target[found]), pa.array(raw[found])], names=["bucket", "target", "raw"])


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log ratio of the target's model to the raw model for each bucket, 0 where the counts cannot tell."""
    out = np.zeros(ORDERS * BUCKETS)
    for order in range(ORDERS):
        part = slice(order * BUCKETS, (order + 1) * BUCKETS)
        t, r = target[part].astype(float), raw[part].astype(float)
        expected = r * (t.sum() / r.sum()) if r.sum() else r
        ratio = np.log((t + PSEUDO_COUNT) / (expected + PSEUDO_COUNT))
        error = np.sqrt(1 / (expected + PSEUDO_COUNT))
        out[part] = np.sign(ratio) * np.maximum(0, np.abs(ratio) - SHRINK_ERRORS * error)
    return out


def weighing(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker(word_hashes)
        ratios = shared.value
        for batch in batches:
            weights = [LENGTH * float(counts.dot(ratios[buckets])) / max(1, words) for buckets, counts, words in map(ngram_counts, batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(weights, pa.float64())], names=["doc_id", "good", "log_weight"])

    return run


def known_labels(labels: DataFrame, limit: int = MAX_LABELS) -> DataFrame:
    """``doc_id, good`` of at most ``limit`` labelled documents, the same ones in every run."""
    good = (F.col("quality") > 0) & (F.coalesce("toxic", F.lit(0)) == 0)
    by_doc = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("label_id"))
    return by_doc.agg(F.min(good).alias("good")).orderBy(F.xxhash64("label_id"), "label_id").limit(limit)


def best_cut(weights: np.ndarray, good: np.ndarray) -> float:
    """The weight that parts good from bad with the largest mean of the two shares on the right side."""
    order = np.argsort(weights, kind="stable")
    w, g = weights[order], good[order]
    bad_below = np.concatenate([[0], np.cumsum(~g)]) / max(1, (~g).sum())
    good_above = 1 - np.concatenate([[0], np.cumsum(g)]) / max(1, g.sum())
    edges = np.concatenate([[-np.inf], (w[1:] + w[:-1]) / 2, [np.inf]])
    distinct = np.concatenate([[True], w[1:] > w[:-1], [True]])
    return float(edges[np.argmax(np.where(distinct, bad_below + good_above, -1))])


def kth_largest(keys: DataFrame, k: int) -> int:
    """The k-th largest value of the column ``key`` (long, at least 0, below 2^48), from counts of 16 bits at a time."""
    prefix = 0
    for shift in (32, 16, 0):
        inside = keys.filter(F.shiftright("key", shift + 16) == prefix)
        digit = F.shiftright("key", shift).bitwiseAND(0xFFFF).alias("digit")
        counts = sorted((tuple(r) for r in inside.groupBy(digit).count().collect()), reverse=True)  # 65,536 rows at most
        for value, n in counts:
            if k <= n:
                prefix = (prefix << 16) | value
                break
            k -= n
    return prefix


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, temperature: float = TEMPERATURE) -> DataFrame:
    """``doc_id, log_weight, key, selected`` of each row of ``docs``."""
    spark = docs.sparkSession
    known = written(known_labels(labels), "labels")
    flagged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), F.col("doc_id") == F.col("label_id"), "left")
    counts = flagged.select("good", "text").mapInArrow(counting, "bucket long, target long, raw long")
    # one row per bucket: bounded by the parameter, whatever the corpus
    table = counts.groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw")).toArrow()
    target, raw = (np.zeros(ORDERS * BUCKETS, np.int64) for _ in range(2))
    target[table["bucket"].to_numpy()], raw[table["bucket"].to_numpy()] = table["target"].to_numpy(), table["raw"].to_numpy()

    shared = spark.sparkContext.broadcast(log_ratios(target, raw))
    weighed = flagged.select("doc_id", "good", "text").mapInArrow(weighing(shared), SCORED)
    # fixed point with 20 binary places; noise by the row's hash
    share = (F.shiftrightunsigned(F.xxhash64("doc_id", "log_weight"), 11) + 0.5) / float(1 << 53)
    noisy = F.col("log_weight") - temperature * F.log(-F.log(share))
    middle = 1 << 47
    key = F.least(F.lit(2 * middle - 1), F.greatest(F.lit(0), F.round(noisy * (1 << 20)).cast("long") + middle))
    scored = written(weighed.withColumn("key", key), "importance")

    judged = scored.filter(F.col("good").isNotNull()).select("log_weight", "good").toArrow()  # MAX_LABELS documents at most
    good = judged["good"].to_numpy(zero_copy_only=False).astype(bool)
    if k is None:
        cut = best_cut(judged["log_weight"].to_numpy(), good) if good.any() and not good.all() else float("-inf")
        k = scored.filter(F.col("log_weight") >= cut).count()
    low = kth_largest(scored, k) if k > 0 else 2 * middle
    return scored.select("doc_id", "log_weight", "key", (F.col("key") >= low).alias("selected"))


def selected_documents(docs: DataFrame, labels: DataFrame, k: int | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, but those whose ``doc_id`` was rejected. Rows without one stay."""
    rejected = resample(docs, labels, k).filter(~F.col("selected") & F.col("doc_id").isNotNull())
    return with_ids(docs, written(rejected.select("doc_id").distinct(), "rejected"), "left_anti")
