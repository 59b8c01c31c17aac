"""Cutting each group's loads, in id order, into batches of bounded count and bytes.

Whether a load starts a batch depends on everything before it, so the rule is no
window function, and a hot group must not be walked by one task. It is cut into
blocks of neighbouring ids instead, and a block is a function of the batch that is
open before it:

1. every block works out, for each row at which a batch may first be cut in it,
   how many batches follow and what the last one holds at the block's end (a cut
   must come within the first ``max_num`` rows, so there are few such rows);
2. two blocks in a row make a function of the same form, so the blocks of a group
   are joined in a tree: ``FANOUT`` neighbours a task, level by level upwards;
   then every level, downwards, gives its nodes the batch that is open before them;
3. every block numbers its rows from there.

Ids are unique, so a block has at most ``BLOCK_IDS`` rows whatever its group's size,
and no task sees more than a block or about ``FANOUT`` summaries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lakeload.runtime import new_run_dir

BLOCK_IDS = 65_536

#: Neighbouring blocks (or nodes of the tree above them) that one task joins.
FANOUT = 64


def next_starts(sizes: np.ndarray, max_num: int, max_bytes: int) -> np.ndarray:
    """For a batch starting at each row, the row at which the next one starts."""
    ahead = np.concatenate([[0], np.cumsum(sizes)])
    rows = np.arange(len(sizes))
    by_bytes = np.searchsorted(ahead, ahead[:-1] + max_bytes, side="right") - 1
    return np.minimum(np.clip(by_bytes, rows + 1, rows + max_num), len(sizes))


def joined_rows(head: list[int], rows: int, count: int, held: int, max_num: int, max_bytes: int) -> int:
    """How many of a block's first rows still go to the batch open before it."""
    taken = 0
    while 0 < count + taken < max_num and count and taken < rows and held + head[taken] <= max_bytes:
        held += head[taken]
        taken += 1
    return taken


#: The batch that is open somewhere: its number, loads and bytes.
Open = tuple[int, int, int]
NOTHING_OPEN: Open = (-1, 0, 0)


def after_block(block: dict, before: Open, max_num: int, max_bytes: int) -> Open:
    """The batch open behind a block, given the one open before it."""
    number, count, held = before
    taken = joined_rows(block["head"], block["rows"], count, held, max_num, max_bytes)
    if taken == block["rows"]:
        return number, count + taken, held + block["total"]
    return number + block["batches"][taken], block["open_count"][taken], block["open_bytes"][taken]


def joined_blocks(a: dict, b: dict, max_num: int, max_bytes: int) -> dict:
    """Two blocks in a row as one: for each row of a first cut, what ``b`` makes of what ``a`` leaves open."""
    rows = a["rows"] + b["rows"]
    starts = [
        after_block(b, (a["batches"][t], a["open_count"][t], a["open_bytes"][t]), max_num, max_bytes)
        if t < a["rows"]
        else tuple(b[name][t - a["rows"]] for name in ("batches", "open_count", "open_bytes"))
        for t in range(min(max_num, rows))
    ]
    batches, counts, held = (list(x) for x in zip(*starts))
    head = (a["head"] + b["head"])[:max_num]
    return {"rows": rows, "total": a["total"] + b["total"], "head": head, "batches": batches, "open_count": counts, "open_bytes": held}


def tree_levels(first: int, last: int) -> int:
    """How often blocks must be joined until all from ``first`` to ``last`` have one parent."""
    levels = 1
    while int(first / FANOUT**levels) != int(last / FANOUT**levels):
        levels += 1
    return levels


def _written(df: DataFrame, label: str) -> DataFrame:
    path = new_run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _sizes(table: pa.Table, size: str) -> np.ndarray:
    return table.column(size).fill_null(0).to_numpy().astype(np.int64)


def chunk_loads(
    loads: DataFrame,
    max_num: int = 10,
    max_bytes: int = 100_000_000,
    by: str | None = "table_id",
    id_column: str = "id",
    size_column: str = "s3_size",
    block_ids: int | None = None,
) -> DataFrame:
    """Add ``batch_no`` (from 0 per group; one group when ``by`` is None).

    A batch ends when it holds ``max_num`` loads or when the next load would take
    it over ``max_bytes``; a load above ``max_bytes`` is alone. No batch is empty.
    ``block_ids`` changes how long blocks are, not the result.
    """
    if max_num < 1:
        raise ValueError("max_num must be positive")
    group = by or "__all"
    source = loads if by else loads.withColumn(group, F.lit(0))
    blocked = source.withColumn("__block", F.expr(f"`{id_column}` div {block_ids or BLOCK_IDS}"))
    group_type = source.schema[group].dataType.simpleString()

    def summarise(table: pa.Table) -> pa.Table:
        ordered = table.sort_by(id_column)
        sizes = _sizes(ordered, size_column)
        rows, following = len(sizes), next_starts(sizes, max_num, max_bytes).tolist()
        batches, last = [1] * rows, list(range(rows))
        for row in range(rows - 1, -1, -1):
            after = following[row]
            if after < rows:
                batches[row] += batches[after]
                last[row] = last[after]
        cuts = min(max_num, rows)
        held = np.concatenate([[0], np.cumsum(sizes)])
        return pa.table(
            {
                group: ordered.column(group)[:1],
                "__block": ordered.column("__block")[:1],
                "rows": pa.array([rows], pa.int64()),
                "total": pa.array([int(held[-1])], pa.int64()),
                "head": pa.array([sizes[:cuts].tolist()], pa.list_(pa.int64())),
                "batches": pa.array([batches[:cuts]], pa.list_(pa.int64())),
                "open_count": pa.array([[rows - start for start in last[:cuts]]], pa.list_(pa.int64())),
                "open_bytes": pa.array([[int(held[-1] - held[start]) for start in last[:cuts]]], pa.list_(pa.int64())),
            }
        )

    def joined(table: pa.Table) -> pa.Table:
        """The nodes below one parent -> the parent."""
        nodes = table.sort_by("__block").to_pylist()
        whole = nodes[0]
        for node in nodes[1:]:
            whole = joined_blocks(whole, node, max_num, max_bytes)
        row = {group: nodes[0][group], "__block": nodes[0]["__parent"]} | {name: whole[name] for name in ("rows", "total", "head", "batches", "open_count", "open_bytes")}
        types = {f.name: f.type for f in table.schema}
        return pa.table({name: pa.array([value], types[name]) for name, value in row.items()})

    def opened(table: pa.Table, state: Open) -> pa.Table:
        """The nodes below one parent, and the batch open before it -> the batch open before each of them."""
        ordered = table.sort_by("__block")
        entries = []
        for node in ordered.to_pylist():
            entries.append((node["__block"], *state))
            state = after_block(node, state, max_num, max_bytes)
        blocks, numbers, counts, bytes_held = zip(*entries)
        return pa.table(
            {
                group: ordered.column(group),
                "__block": pa.array(blocks, pa.int64()),
                "open_number": pa.array(numbers, pa.int64()),
                "open_count": pa.array(counts, pa.int64()),
                "open_bytes": pa.array(bytes_held, pa.int64()),
            }
        )

    def entered_first(table: pa.Table) -> pa.Table:
        return opened(table, NOTHING_OPEN)

    def entered(table: pa.Table, entry: pa.Table) -> pa.Table:
        return opened(table, tuple(entry.column(c)[0].as_py() for c in ("open_number", "open_count", "open_bytes")))

    def number_rows(table: pa.Table, entry: pa.Table) -> pa.Table:
        ordered = table.sort_by(id_column)
        sizes = _sizes(ordered, size_column)
        before = entry.to_pylist()[0]
        following = next_starts(sizes, max_num, max_bytes).tolist()
        head = sizes[: min(max_num, len(sizes))].tolist()
        row = joined_rows(head, len(sizes), before["open_count"], before["open_bytes"], max_num, max_bytes)
        first_rows = []
        while row < len(sizes):
            first_rows.append(row)
            row = following[row]
        starts = np.zeros(len(sizes), np.int64)
        starts[first_rows] = 1
        numbered = ordered.append_column("batch_no", pa.array(before["open_number"] + np.cumsum(starts), pa.int64()))
        return numbered.drop_columns(["__block"])

    summary_type = (
        f"`{group}` {group_type}, __block bigint, rows bigint, total bigint, head array<bigint>, "
        "batches array<bigint>, open_count array<bigint>, open_bytes array<bigint>"
    )
    entry_type = f"`{group}` {group_type}, __block bigint, open_number bigint, open_count bigint, open_bytes bigint"
    needed = blocked.select(group, "__block", id_column, size_column)
    nodes = [needed.groupBy(group, "__block").applyInArrow(summarise, summary_type)]
    ends = needed.agg(F.min("__block").alias("first"), F.max("__block").alias("last")).first()
    levels = 1 if ends["first"] is None else tree_levels(ends["first"], ends["last"])
    for level in range(levels):
        with_parent = nodes[level].withColumn("__parent", F.expr(f"__block div {FANOUT}"))
        if level < levels - 1:
            nodes[level] = _written(with_parent, "blocks")  # read again on the way down
            nodes.append(nodes[level].groupBy(group, "__parent").applyInArrow(joined, summary_type))
        else:
            nodes[level] = with_parent
    entries = nodes[-1].groupBy(group).applyInArrow(entered_first, entry_type)
    for level in reversed(nodes[:-1]):
        entries = level.groupBy(group, "__parent").cogroup(entries.groupBy(group, "__block")).applyInArrow(entered, entry_type)
    out_schema = StructType([*source.schema.fields, StructField("batch_no", LongType())])
    numbered = (
        blocked.groupBy(group, "__block").cogroup(entries.groupBy(group, "__block")).applyInArrow(number_rows, out_schema)
    )
    return numbered if by else numbered.drop(group)


def batch_stats(batched: DataFrame, by: str | None = "table_id", size_column: str = "s3_size") -> DataFrame:
    """Loads and bytes of each batch."""
    keys = [by, "batch_no"] if by else ["batch_no"]
    return batched.groupBy(*keys).agg(
        F.count("*").alias("load_count"), F.coalesce(F.sum(size_column), F.lit(0)).cast("bigint").alias("total_bytes")
    )
