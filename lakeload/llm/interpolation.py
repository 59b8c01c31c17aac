"""Deleted interpolation: a bigram language model of the whole corpus, and the score of every text.

The probability of a token after another one mixes three estimates: the maximum
likelihood of the pair, that of the token alone, and an equal share for each known token
and one unknown. The weights depend on how often the context was seen (buckets of powers
of two) and are learned by expectation-maximisation on counts of a deleted part:
an eighth of the training texts, whose own counts are subtracted from all counts
while the weights are learned. Scores use the counts of all training texts.

Counts. Texts are dealt into batches of a few megabytes. Each batch asks for the tokens and
pairs that occur in it, once each, and brings its own counts of them; questions are
gathered by ranges of the keys' hashes, counts are added up, and each batch gets its
answers in the order of its questions. So frequent words cross the network once per
batch, not once per occurrence, and no table of all pairs is kept. Numbers travel as
byte planes (all first bytes, then all second bytes ...), which pack well.

Batches stay small whatever the rows are: texts above ``PIECE_BYTES`` are cut at white space into
pieces that are dealt like texts, each with the word before it, and their sums are added up at the
end; rows that repeat so often that they would fill a batch are counted first and read once.

Tokens are told apart by 64-bit hashes, pairs by the range and 40 bits of theirs.

Edge cases: a null or empty text is its end token alone; rows that repeat count each; a
null ``doc_id`` is trained on like the empty id; without training texts all estimates but the
equal share are zero; an empty table gives no rows. Of the input only ``doc_id`` and
``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.llm.scratch import few, written
from lakeload.llm.words import MULTIPLIER, U64, hashed, mixed, space_words

#: Stands for the end of a text, and for the start as a context; no word has it but by chance.
END = U64(0x5851F42D4C957F2D)

BATCH_BYTES = 3 << 20

#: Longer texts are cut into pieces of about so many characters.
PIECE_BYTES = 1 << 19

#: Training texts whose hash is 0 modulo this are the deleted part.
DELETED_OF = 8

CONTEXT_BUCKETS = 48
#: Expectation-maximisation ends when no weight moves by more.
TOLERANCE = 1e-6

ASKED = "batch long, kind int, bucket int, keys binary, train binary, deleted binary"
ANSWERS = "batch long, kind int, bucket int, train binary, deleted binary, n_distinct long, n_train long, n_deleted long"
CELLS = "context int, pair int, single int, n long"
PIECES = "row long, at long, doc_id long, text string, held_out boolean, copies long, before binary, last boolean"
SCORES = "row long, doc_id long, held_out boolean, copies long, n_tokens long, n_known long, base_score double, score double"

LOW40 = U64((1 << 40) - 1)


GAP = re.compile("[\x09-\x0d\x20]")


def pieces(text: str, size: int) -> Iterator[tuple[bytes | None, str, bool]]:
    """The word before, the piece, and whether it is the last one; ``text`` is cut before white space only."""
    start, before, last = 0, None, False
    while not last:
        gap = GAP.search(text, start + size)
        end = gap.start() if gap else len(text)
        last = gap is None
        yield before, text[start:end], last
        words = space_words(text[start:end])
        before, start = words[-1] if words else before, end


def cutting(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (``row, doc_id, text, held_out, copies``) in pieces."""
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.binary(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc_id, text, held_out, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for at, (before, piece, last) in enumerate(pieces(text, size)):
                    values = (row, at, doc_id, piece, held_out, copies, before, last)
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=names_of(PIECES))

    return run


def names_of(schema: str) -> list[str]:
    return [c.split(" ")[0] for c in schema.split(", ")]


def planes(values: np.ndarray) -> bytes:
    """Unsigned 64-bit numbers as eight planes of bytes."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def numbers(cells: pa.ChunkedArray) -> list[np.ndarray]:
    """The numbers of each cell of ``planes``."""
    return [np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(8, -1).T).view("<u8").ravel() for x in cells.to_pylist()]


class Batch:
    """Tokens and pairs of the texts of a batch, each distinct one once, ascending."""

    def __init__(self, table: pa.Table, bits: int) -> None:
        end, parts, firsts, sizes = np.asarray([END], U64), [], [], []
        for text, before, last in zip(*(table[c].to_pylist() for c in ("text", "before", "last")), strict=True):
            words = hashed(space_words(text))
            parts += [words, end] if last else [words]
            sizes.append(len(words) + last)
            firsts.append(END if before is None else hashed([before])[0])
        self.sizes = np.asarray(sizes, np.int64)
        following = np.concatenate(parts)
        n, some = len(following), self.sizes > 0
        starts = (np.cumsum(self.sizes) - self.sizes)[some]
        context = np.empty_like(following)
        context[1:] = following[:-1]
        context[starts] = np.asarray(firsts, U64)[some]
        pairs = mixed(context * MULTIPLIER + following)
        del context
        self.tokens, at = np.unique(np.concatenate([following, np.asarray(firsts, U64)]), return_inverse=True)
        self.token_at = at[:n].astype(np.int32)
        self.context_at = np.empty_like(self.token_at)
        self.context_at[1:] = self.token_at[:-1]
        self.context_at[starts] = at[n:][some]
        ranged = ((pairs >> U64(64 - bits)) << U64(40)) | (pairs & LOW40)
        self.pairs, at = np.unique(ranged, return_inverse=True)
        self.pair_at = at.astype(np.int32)

    def spread(self, values: pa.ChunkedArray) -> np.ndarray:
        """A number of each text for each of its tokens."""
        return np.repeat(values.to_numpy(zero_copy_only=False).astype(np.float64), self.sizes)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Totals by text."""
        return np.bincount(np.repeat(np.arange(len(self.sizes)), self.sizes), values, len(self.sizes))


def asking(bits: int) -> Callable[[tuple, pa.Table], pa.Table]:
    """Questions of a batch: keys by range, with the batch's own counts."""
    types = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 3]

    def run(key: tuple, table: pa.Table) -> pa.Table:
        batch = Batch(table, bits)
        flags = [batch.spread(table[name]) for name in ("training", "deleted")]
        rows: list[tuple] = []
        for kind, keys, at, shift in ((1, batch.tokens, batch.token_at, 64 - bits), (2, batch.pairs, batch.pair_at, 40)):
            counts = [np.bincount(at, flag, len(keys)) for flag in flags]
            rest = keys & U64((1 << shift) - 1)
            buckets, edges = np.unique(keys >> U64(shift), return_index=True)
            for bucket, start, end in zip(buckets.tolist(), edges, [*edges[1:], len(keys)], strict=True):
                rows.append((key[0].as_py(), kind, bucket, planes(rest[start:end]), *(planes(c[start:end]) for c in counts)))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names_of(ASKED))

    return run


def answering(key: tuple, table: pa.Table) -> pa.Table:
    """Total counts of the keys of a range, for each batch that asked, and one row (batch -1) about the range.

    Only batches of the deleted part (odd numbers) need the counts of that part.
    """
    keys = numbers(table["keys"])
    cuts = np.cumsum([len(x) for x in keys])[:-1]
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    del keys
    totals = [np.bincount(at, np.concatenate(numbers(table[name])), len(distinct)) for name in ("train", "deleted")]
    batches, places = table["batch"].to_pylist(), np.split(at, cuts)
    n = table.num_rows
    none = [None] * n
    columns = [
        [*batches, -1],
        [key[0].as_py()] * (n + 1),
        [key[1].as_py()] * (n + 1),
        [*(planes(totals[0][p]) for p in places), None],
        [*(planes(totals[1][p]) if b % 2 else b"" for b, p in zip(batches, places, strict=True)), None],
        [*none, int(np.count_nonzero(totals[0]))],
        [*none, int(totals[0].sum())],
        [*none, int(totals[1].sum())],
    ]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names_of(ANSWERS))


def counts_of(answers: pa.Table, kind: int, column: str) -> np.ndarray:
    """Counts of a batch's keys, in their order."""
    own = answers.filter(pa.compute.equal(answers["kind"], kind)).sort_by("bucket")
    return np.concatenate(numbers(own[column])).astype(np.float64)


def context_bucket(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(counts)[1], CONTEXT_BUCKETS - 1)


def ratio(a: np.ndarray, b: np.ndarray | float) -> np.ndarray:
    """a / b, and 0 where b is 0."""
    return np.divide(a, b, out=np.zeros_like(a), where=np.asarray(b) > 0)


def level(share: np.ndarray) -> np.ndarray:
    """A probability as quarter octaves below 1; -1 for zero."""
    safe = np.where(share > 0, share, 1)
    return np.where(share > 0, np.clip(np.rint(-4 * np.log2(safe)), 0, 255), -1).astype(np.int64)


def held_out_cells(bits: int, n_kept: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    """Held-out tokens of a deleted batch by context bucket and the levels of their two estimates."""

    def run(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table([pa.array([], pa.int32())] * 3 + [pa.array([], pa.int64())], names=["context", "pair", "single", "n"])
        batch = Batch(docs, bits)
        single, pair = (counts_of(answers, kind, "train") - counts_of(answers, kind, "deleted") for kind in (1, 2))
        context = single[batch.context_at]
        cells = np.stack([context_bucket(context), level(ratio(pair[batch.pair_at], context)), level(ratio(single[batch.token_at], float(n_kept)))])
        found, at = np.unique(cells, axis=1, return_inverse=True)
        n = np.bincount(at.ravel(), batch.spread(docs["copies"]), found.shape[1]).astype(np.int64)
        return pa.table([pa.array(row, pa.int32()) for row in found] + [pa.array(n, pa.int64())], names=["context", "pair", "single", "n"])

    return run


def scoring(bits: int, n_train: int, n_distinct: int, weights: np.ndarray) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def run(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table([pa.array([], t) for t in types], names=names_of(SCORES))
        batch = Batch(docs, bits)
        single, pair = (counts_of(answers, kind, "train") for kind in (1, 2))
        base = np.log10((single + 1) / (n_train + n_distinct + 1))
        context = single[batch.context_at]
        mixed_by = weights[context_bucket(context)]
        shares = mixed_by[:, 0] * ratio(pair[batch.pair_at], context)
        shares += mixed_by[:, 1] * ratio(single, float(n_train))[batch.token_at] + mixed_by[:, 2] / (n_distinct + 1)
        columns = [
            *(docs[name] for name in ("row", "doc_id", "held_out", "copies")),
            pa.array(batch.sizes),
            pa.array(batch.sums((single > 0)[batch.token_at]).astype(np.int64)),
            pa.array(batch.sums(base[batch.token_at])),
            pa.array(batch.sums(np.log10(shares))),
        ]
        return pa.table(columns, names=names_of(SCORES))

    return run


def learned_weights(cells: np.ndarray, n_distinct: int) -> np.ndarray:
    """Weights (pair, single, equal share) of each context bucket by expectation-maximisation on the held-out cells.

    A bucket without held-out tokens takes the weights of all of them together.
    """
    probability = lambda q: np.where(q >= 0, 2.0 ** (-q / 4), 0.0)

    def fitted(rows: np.ndarray) -> np.ndarray:
        estimates = np.stack([probability(rows[:, 1]), probability(rows[:, 2]), np.full(len(rows), 1 / (n_distinct + 1))], axis=1)
        weight = np.full(3, 1 / 3)
        before = np.zeros(3)
        while np.abs(weight - before).max() > TOLERANCE:
            before = weight
            share = estimates * weight
            share *= (rows[:, 3] / share.sum(axis=1))[:, None]
            # one more held-out token for the equal share keeps every text possible
            weight = share.sum(axis=0) + [0, 0, 1]
            weight /= weight.sum()
        return weight

    table = np.tile(fitted(cells) if len(cells) else np.asarray([0, 0, 1.0]), (CONTEXT_BUCKETS, 1))
    for bucket in np.unique(cells[:, 0]).astype(int) if len(cells) else ():
        table[bucket] = fitted(cells[cells[:, 0] == bucket])
    return table


def counted(rows: DataFrame, batch_bytes: int) -> DataFrame:
    """``rows`` (``doc_id, text, held_out``) with ``copies``: rows that repeat so often that they would fill a batch once, all others as they are."""
    twin = F.xxhash64("doc_id", "text", "held_out").alias("twin")
    sizes = rows.groupBy(twin).agg(F.count("*").alias("n"), F.max(F.coalesce(F.octet_length("text"), F.lit(0))).alias("size"))
    repeated = written(sizes.filter((F.col("n") > 1) & (F.col("n") * (F.col("size") + 32) > batch_bytes // 4)).select("twin"), "repeated-rows")
    if repeated.isEmpty():
        return rows.withColumn("copies", F.lit(1).cast("long"))
    marked, twins = rows.withColumn("twin", twin), few(repeated)
    once = marked.join(twins, "twin", "left_semi").groupBy("doc_id", "text", "held_out").agg(F.count("*").alias("copies"))
    others = marked.join(twins, "twin", "left_anti").select("doc_id", "text", "held_out", F.lit(1).cast("long").alias("copies"))
    return others.unionByName(once)


def in_pieces(rows: DataFrame, piece_bytes: int) -> DataFrame:
    """``rows`` of ``counted`` as PIECES; only texts above ``piece_bytes`` are cut, and ``row`` is null for all others."""
    empty = F.lit(None).cast("long")
    long = F.coalesce(F.octet_length("text"), F.lit(0)) > piece_bytes
    whole = rows.filter(~long).select(
        empty.alias("row"), empty.alias("at"), "doc_id", "text", "held_out", "copies", F.lit(None).cast("binary").alias("before"), F.lit(True).alias("last")
    )
    if rows.filter(long).isEmpty():
        return whole
    numbered = rows.filter(long).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", "held_out", "copies")
    # written, as the numbers of rows need not be the same when they are computed again
    return whole.unionByName(written(numbered.mapInArrow(cutting(piece_bytes), PIECES), "long-texts"))


def score_texts(docs: DataFrame, held_out: Column, batch_bytes: int = BATCH_BYTES, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Scores of all rows by a model of those that are not ``held_out``; ``train_tokens`` is the same in all rows."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    batches = max(1, size // batch_bytes, min(24, size >> 20))
    bits = max(4, (size >> 22).bit_length())  # about 4 MB of text for each range of keys

    # the deleted part has batches of its own: only those are needed to learn the weights
    training = ~F.col("held_out")
    deleted = training & (F.pmod(F.xxhash64("doc_id", F.lit("deleted")), F.lit(DELETED_OF)) == 0)
    drawn = F.xxhash64("doc_id", "text", "row", "at")
    batch = F.when(F.col("deleted"), F.pmod(drawn, F.lit(max(1, batches // DELETED_OF))) * 2 + 1).otherwise(F.pmod(drawn, F.lit(batches)) * 2)
    dealt = in_pieces(counted(rows, batch_bytes), piece_bytes).withColumn("deleted", deleted).withColumn("batch", batch)

    flags = [(flag.cast("long") * F.col("copies")).alias(name) for flag, name in ((training, "training"), (F.col("deleted"), "deleted"))]
    asked = dealt.select("batch", "text", "before", "last", *flags).groupBy("batch").applyInArrow(asking(bits), ASKED)
    answers = written(asked.groupBy("kind", "bucket").applyInArrow(answering, ANSWERS), "ngram-answers")
    facts = answers.filter((F.col("batch") == -1) & (F.col("kind") == 1)).agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_distinct", "n_train", "n_deleted")])
    n_distinct, n_train, n_deleted = facts.first()

    mine = answers.filter(F.col("batch") >= 0)
    of_deleted = mine.filter(F.col("batch") % 2 == 1).select("batch", "kind", "bucket", "train", "deleted").groupBy("batch")
    read = dealt.filter("deleted").select("batch", "text", "before", "last", "copies").groupBy("batch")
    cells = read.cogroup(of_deleted).applyInArrow(held_out_cells(bits, n_train - n_deleted), CELLS)
    # a row for each context bucket and pair of levels that occurs: bounded, whatever the corpus
    found = cells.groupBy("context", "pair", "single").agg(F.sum("n").alias("n")).toArrow()
    weights = learned_weights(np.stack([c.to_numpy().astype(np.float64) for c in found.columns], axis=1), n_distinct)

    scored = (
        dealt.select("batch", "row", "doc_id", "text", "before", "last", "held_out", "copies")
        .groupBy("batch")
        .cogroup(mine.select("batch", "kind", "bucket", "train").groupBy("batch"))
        .applyInArrow(scoring(bits, n_train, n_distinct, weights), SCORES)
    )
    scored = written(scored, "scores")
    names = names_of(SCORES)[4:]
    # a text in pieces is one row again, and rows read once are as many as they were
    joined = scored.filter("row is not null").groupBy("row", "doc_id", "held_out", "copies").agg(*[F.sum(c).alias(c) for c in names])
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    every = scored.filter("row is null").unionByName(joined).select("doc_id", "held_out", *names, each).drop("copy")
    return every.withColumn("train_tokens", F.lit(n_train).cast("long"))
