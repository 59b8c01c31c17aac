"""Best-fit packing with certified partitions.

Documents become token pieces of at most ``capacity`` ids. Pieces are dealt into
groups of bounded size; each group is packed best-fit decreasing and certified by
lower bounds from dual feasible functions. Groups that used more bins than their
bound exchange documents: the pieces of their unfilled bins are dealt anew and
packed again, until no gap is left or a round saves nothing.

Edge cases: a null or empty text is the single piece ``[0]``; rows that repeat
are packed each for itself; a null ``doc_id`` is carried along; an empty table
gives no rows. Of the input only ``doc_id`` and ``text`` are read, so other
columns may have any name.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.scratch import free_worker, worker_cache, written
from lakeload.llm.tokens import default_vocabulary, text_tokens

CAPACITY = 2048
END_ID = 0

#: Pieces packed together in one task: a few thousand are as good as all of them, and fit a task's memory.
GROUP_PIECES = 8192

#: Rounds of exchange at most; each one is kept only if it saves bins.
ROUNDS = 4

PIECE_FIELDS = [("row", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = "row long, doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, fill long, gap long"


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """Ranges of the pieces of ``n`` ids: full ones, but for a shorter first one."""
    first = n % capacity or capacity
    return [(0, first), *((at, at + capacity) for at in range(first, n, capacity))] if n > capacity else [(0, n)]


def piece_rows(capacity: int, vocabulary: str, with_ids: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        free_worker(text_tokens)
        tokens, row = text_tokens(vocabulary, named=True), TaskContext.get().partitionId() << 40
        end = np.asarray([END_ID], "<u4").tobytes()
        for batch in batches:
            columns: list[list] = [[] for _ in range(6 + with_ids)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = tokens.packed(text or "") + end
                for piece, (a, b) in enumerate(cut_points(len(ids) // 4, capacity)):
                    part = ids[a * 4 : b * 4]
                    values = [row, doc_id, piece, a, b - a, zlib.crc32(part)]
                    for column, value in zip(columns, [*values, part] if with_ids else values, strict=True):
                        column.append(value)
                    row += 1
            fields = [*PIECE_FIELDS, ("ids", pa.binary())] if with_ids else PIECE_FIELDS
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])

    return run


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents, each with a ``row`` number of its own; ``with_ids`` adds the ids (uint32 bytes)."""
    run = piece_rows(capacity, vocabulary or default_vocabulary(), with_ids)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES + (", ids binary" if with_ids else ""))


@worker_cache
def bound_functions(capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Dual feasible functions by size (rows: functions, columns: sizes 0..capacity), and what a bin holds under each.

    A dual feasible function keeps every set of sizes that fits one bin within
    one bin, so the total of the transformed sizes over the transformed capacity
    bounds the number of bins from below.
    """
    x = np.arange(capacity + 1, dtype=np.int64)
    table, room = [x], [capacity]
    for small in range(1, capacity // 2 + 1):  # large sizes count as whole bins, small ones not at all
        table.append(np.where(x > capacity - small, capacity, np.where(x >= small, x, 0)))
        room.append(capacity)
    for k in range(2, 101):  # sizes rounded down to multiples of 1/(k + 1), exact multiples kept
        exact = (x * (k + 1)) % capacity == 0
        table.append(np.where(exact, x * k, (x * (k + 1)) // capacity * capacity))
        room.append(capacity * k)
    for k in range(2, capacity // 2 + 1):  # sizes above the half by what they leave free
        half = np.where(2 * x == capacity, capacity // k, 2 * (x // k))
        table.append(np.where(2 * x > capacity, 2 * (capacity // k - (capacity - x) // k), half))
        room.append(2 * (capacity // k))
    return np.stack(table), np.asarray(room)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing of ``lengths`` has fewer bins."""
    functions, room = bound_functions(capacity)
    totals = functions @ np.bincount(lengths, minlength=capacity + 1)
    return int(np.max(-(-totals // room)))


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length, and the fill of each bin: longest first, each into the fullest bin with room.

    Bins are kept by their room; a bit per room that occurs finds the tightest one at once.
    """
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, fills = 0, []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, at = capacity, len(fills)
            fills.append(0)
        bins[i], offsets[i] = at, fills[at]
        fills[at] += n
        room -= n
        if not by_room[room]:
            rooms |= 1 << room
        by_room[room].append(at)
    return bins, offsets, np.asarray(fills, np.int64)


def packed_group(capacity: int, first_id: int) -> Callable[[tuple, pa.Table], pa.Table]:
    def run(key: tuple, table: pa.Table) -> pa.Table:
        free_worker(bound_functions)
        table = table.drop_columns(["pack_group"]).sort_by("row")
        lengths = table["length"].to_numpy()
        bins, offsets, fills = best_fit_decreasing(lengths, capacity)
        gap = len(fills) - lower_bound(lengths, capacity)
        start = first_id + (key[0].as_py() << 20)
        extra = {"sequence_id": bins + start, "offset": offsets, "fill": fills[bins], "gap": np.full(len(bins), gap)}
        for name, values in extra.items():
            table = table.append_column(name, pa.array(values, pa.int64()))
        return table

    return run


def packed_once(pieces: DataFrame, n: int, capacity: int, group_pieces: int, round_no: int) -> DataFrame:
    groups = max(1, -(-n // group_pieces))
    dealt = pieces.withColumn("pack_group", F.pmod(F.xxhash64("row", F.lit(round_no)), F.lit(groups)))
    return dealt.groupBy("pack_group").applyInArrow(packed_group(capacity, (round_no + 1) << 48), PACKED)


def bins_of(packed: DataFrame) -> tuple[int, int]:
    """Bins and pieces of a packing."""
    row = packed.agg(F.coalesce(F.sum((F.col("offset") == 0).cast("long")), F.lit(0)), F.count("*")).first()
    return row[0], row[1]


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES, rounds: int = ROUNDS) -> DataFrame:
    """``sequence_id`` and ``offset`` for each piece; also ``fill`` of its sequence and the ``gap`` its group was left with.

    A full piece is a sequence of its own. A gap of 0 certifies that no packing
    of that group has fewer sequences.
    """
    columns = [c.strip().split(" ")[0] for c in PIECES.split(",")]
    pieces = written(pieces.select(*columns), "pieces")
    whole = pieces.filter(F.col("length") >= capacity).select(
        "*", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.col("length").alias("fill"), F.lit(0).cast("long").alias("gap")
    )
    rest = pieces.filter(F.col("length") < capacity)
    current = written(packed_once(rest, rest.count(), capacity, group_pieces, 0), "packed")
    done = whole
    for round_no in range(1, rounds + 1):
        settled = (F.col("gap") <= 0) | (F.col("fill") == capacity)
        open_bins = current.filter(~settled)
        before, n = bins_of(open_bins)
        if n == 0:
            break
        again = written(packed_once(open_bins.select(*columns), n, capacity, group_pieces, round_no), "repacked")
        if bins_of(again)[0] >= before:
            break
        done, current = done.unionByName(current.filter(settled)), again
    return done.unionByName(current)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """Pieces of all documents with their place in a sequence."""
    return pack(token_pieces(docs, capacity, vocabulary), capacity)


def sequences(pieces_with_ids: DataFrame, packed: DataFrame) -> DataFrame:
    """The sequences themselves: ``sequence_id``, ``n_tokens``, ``ids`` (uint32 bytes), ``doc_ids`` in order."""
    parts = pieces_with_ids.select("row", "ids").join(packed.select("row", "doc_id", "sequence_id", "offset", "length"), "row")
    ordered = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "ids")))
    return (
        parts.groupBy("sequence_id")
        .agg(ordered.alias("parts"))
        .select(
            "sequence_id",
            F.aggregate("parts.length", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_tokens"),
            F.aggregate("parts.ids", F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"),
            F.col("parts.doc_id").alias("doc_ids"),
        )
    )


def bin_bound(packed: DataFrame, capacity: int = CAPACITY) -> tuple[int, int]:
    """Sequences used, and the lower bound for the whole corpus from its (bounded) table of lengths."""
    counts = packed.groupBy("length").count().collect()
    lengths, n = np.asarray([r[0] for r in counts], np.int64), np.asarray([r[1] for r in counts], np.int64)
    functions, room = bound_functions(capacity)
    histogram = np.zeros(capacity + 1, np.int64)
    histogram[lengths] = n
    return bins_of(packed)[0], int(np.max(-(-(functions @ histogram) // room)))
