"""Near-duplicates by an LSH forest: sorted signature orders, neighbours by longest common prefix.

Texts with equal shingle sets are one node. A node's signature holds ``HASHES``
minima of hash functions over its whole set. Each of ``ORDERS`` orders sorts all
nodes by their signature read from another place on; nodes that share a long
prefix stand together, as in a prefix tree. Candidates are the ``NEIGHBOURS``
nearest nodes on either side of an order whose prefixes agree in one minimum at
least. How deep they agree adapts to the region: among few alike the neighbours
reach down to one common minimum, in a crowded region they agree in many. A
candidate is dropped if its sketches (four bits of each minimum) agree in less than 0.64
of their places: at a similarity of 0.8 that is five standard deviations away. Of candidates
that a crowd (below) looks at as well, a stretch of an order gives those alone that join its nodes
in a tree, the likeliest first: fewer than it has nodes, whatever the crowd's size.

Candidates are confirmed on the full shingle sets of their texts, in two rounds: first the
likeliest candidate of each node; then, of all others, those between nodes that are not yet
in one component. What is left unconfirmed could not change a component.

Crowds. In a crowded region the nearest nodes are not all: a text with many copies
may be the only link between them. Nodes that agree in the first ``CROWD_HASHES``
minima of an order are a crowd, and all its pairs are looked at that are not yet in
one component, however large it is. First come rounds of hubs, the nodes with most links of
each component: every node of the crowd proposes the one hub of another component
that it agrees with most, a row a node, and links found join components. This alone decides nothing: then
come all pairs whose nodes are still in two components and whose set sizes allow the
similarity. Then a crowd is cut into chunks and each pair of chunks is a cell of its own, so no
task holds a crowd. Pairs never leave their cell, as a crowd of texts that are alike but not linked has
very many: first the cells name the nodes whose sketch agrees with another's, then they get the full
sets of these alone, confirm the pairs and give the links that join components there, fewer than
they have nodes. A pair that agrees in several orders is looked at in the first of them.

What is missed. Two similar texts are missed only if no order has them in one crowd.
Orders begin with different hash functions: at similarity 0.8 that is 0.36 to the power
of 16, about 1e-7 a pair, whatever else the corpus holds; and the sketch as above.

Edge cases: null and empty texts, and texts without words, have no shingles and
are linked with nothing; fewer words than a shingle are one shingle; rows that share
a ``doc_id`` are one document with several texts; rows without ``doc_id`` are linked
with nothing and kept; an empty table gives no rows. Of the input only ``doc_id``
and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.llm.components import components
from lakeload.llm.scratch import few, free_worker, with_ids, written
from lakeload.llm.words import MULTIPLIER, U64, hashed, mixed, runs, space_words, word_hashes

HASHES = 128
ORDERS = 16
KEY_HASHES = 16
SKETCH = 128
REGION = 16
NEIGHBOURS = 8
CROWD_HASHES = 2

#: Rounds of hubs at most; pairs they leave apart are all looked at afterwards.
HUB_ROUNDS = 3

#: Nodes of a crowd that are compared at once with as many others.
CHUNK = 1024

#: Shingles of a chunk whose nodes come with their sets, about.
CHUNK_SHINGLES = 1 << 20

#: Sketch agreement below which a pair is no candidate, against a similarity of 0.8.
SKETCH_SHARE = 0.64

#: Rows of an order looked at together.
BLOCK_ROWS = 16_384

SIGNATURES = "doc_id long, n_shingles long, set_hash binary, signature binary, sketch binary"


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a whole text."""
    return np.unique(runs(hashed(space_words(text)), width))


def hash_parameters() -> tuple[np.ndarray, np.ndarray]:
    base = mixed(np.arange(1, 2 * HASHES + 1, dtype=U64) * MULTIPLIER)
    return base[:HASHES] | U64(1), base[HASHES:]


def minima(sets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Signatures (a row each) of sets that follow each other in one array; no set is empty."""
    factors, addends = hash_parameters()
    out = np.empty((len(starts), HASHES), np.uint32)
    values = np.empty_like(sets)
    for j in range(HASHES):
        np.multiply(sets, factors[j], out=values)
        np.add(values, addends[j], out=values)
        np.right_shift(values, U64(32), out=values)
        out[:, j] = np.minimum.reduceat(values, starts)
    return out


def sketches(cells: pa.ChunkedArray) -> np.ndarray:
    """Sketches, a row each; as stored, a byte holds two places."""
    packed = np.frombuffer(b"".join(cells.to_pylist()), np.uint8).reshape(-1, SKETCH // 2)
    return np.concatenate([packed & 0xF, packed >> 4], axis=1)


def signing(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker(word_hashes)
        for batch in batches:
            sets = [shingle_set(text, width) for text in batch.column(1).to_pylist()]
            sizes = np.asarray([len(s) for s in sets], np.int64)
            full = np.flatnonzero(sizes)
            set_hash: list = [None] * len(sets)
            signature, sketch = list(set_hash), list(set_hash)
            # a few sets at a time keep the arrays inside the processor's cache
            for some in np.array_split(full, max(1, int(sizes.sum()) // 16_384)) if len(full) else ():
                if not len(some):
                    continue
                joined = np.concatenate([sets[i] for i in some])
                starts = np.concatenate([[0], np.cumsum(sizes[some])[:-1]]).astype(np.int64)
                both = np.stack([np.add.reduceat(mixed(joined), starts), np.add.reduceat(mixed(joined ^ MULTIPLIER), starts)], axis=1)
                signed = minima(joined, starts)
                low = (signed[:, :: HASHES // SKETCH] & 0xF).astype(np.uint8)
                low = low[:, ::2] | low[:, 1::2] << 4
                ordered = signed.astype(">u4")
                for at, i in enumerate(some):
                    set_hash[i], signature[i], sketch[i] = both[at].tobytes(), ordered[at].tobytes(), low[at].tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.array(set_hash, pa.binary()), pa.array(signature, pa.binary()), pa.array(sketch, pa.binary())],
                names=["doc_id", "n_shingles", "set_hash", "signature", "sketch"],
            )

    return run


def signatures(docs: DataFrame, width: int) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(signing(width), SIGNATURES)


def spanning(a: np.ndarray, b: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Places of the pairs, the largest share first, that join the same nodes as all pairs do, without a ring."""
    ranked = np.lexsort((b, a, -share))
    _, ends = np.unique(np.r_[a[ranked], b[ranked]], return_inverse=True)
    root, kept = np.arange(ends.max(initial=-1) + 1), np.zeros(len(a), bool)
    x, y = ends.reshape(2, -1)
    at = np.arange(len(a))
    while len(at):
        # the best pair of each tree leads to another one; where two lead to each other, one is the root
        tree, first = np.unique(np.stack([root[x[at]], root[y[at]]], axis=1), return_index=True)
        best = at[first // 2]
        kept[best] = True
        to = np.arange(len(root))
        to[tree] = root[x[best]] + root[y[best]] - tree
        both = to[to[tree]] == tree
        to[tree[both]] = np.minimum(tree[both], to[tree[both]])
        while (to[to] != to).any():
            to = to[to]
        root = to[root]
        at = at[root[x[at]] != root[y[at]]]
    return ranked[kept]


def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by order and key -> candidate pairs (a < b) with their sketch agreement."""

    def region_depth(common: np.ndarray, n: int) -> np.ndarray:
        """Smallest depth at which a node's region is small enough; KEY_HASHES + 1 if none is."""
        depth = np.full(n, KEY_HASHES + 1)
        for d in range(KEY_HASHES, 0, -1):
            region = np.concatenate([[0], np.cumsum(common < d)])
            depth[np.bincount(region)[region] <= REGION] = d
        return depth

    def pairs(order: np.ndarray, keys: np.ndarray, node: np.ndarray, sketch: np.ndarray) -> pa.RecordBatch:
        n = len(node)
        # minima that neighbours have in common, from the first on
        common = np.cumprod(keys[1:] == keys[:-1], axis=1).sum(axis=1) * (order[1:] == order[:-1])
        depth = region_depth(common, n)
        reach, found = common.copy(), []
        for k in range(1, min(REGION, n)):
            reach = np.minimum(reach[: n - k], common[k - 1 :])
            crowded = (depth[:-k] > KEY_HASHES) & (reach == KEY_HASHES) & (k <= NEIGHBOURS)
            near = np.flatnonzero((reach >= depth[:-k]) | crowded | ((reach > 0) & (k == 1)))
            share = (sketch[near] == sketch[near + k]).mean(axis=1) if len(near) else np.empty(0)
            near, share = near[share >= SKETCH_SHARE], share[share >= SKETCH_SHARE]
            found.append((np.minimum(node[near], node[near + k]), np.maximum(node[near], node[near + k]), share, reach[near] >= CROWD_HASHES))
        none = np.empty(0, np.int64)
        a, b, share, crowded = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (none, none, np.empty(0), none.astype(bool))
        in_crowd = np.flatnonzero(crowded)
        given = np.r_[np.flatnonzero(~crowded), in_crowd[spanning(a[in_crowd], b[in_crowd], share[in_crowd])]]
        a, b, share = a[given], b[given], share[given]
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(share.astype(np.float32))], names=["a", "b", "share"])

    def arrays(parts: list[pa.RecordBatch]) -> tuple[np.ndarray, ...]:
        table = pa.Table.from_batches(parts)
        keys = np.frombuffer(b"".join(table["key"].to_pylist()), ">u4").reshape(-1, KEY_HASHES)
        sketch = sketches(table["sketch"])
        return table["order"].to_numpy(), keys, table["node"].to_numpy(), sketch

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= BLOCK_ROWS:
            yield pairs(*arrays(held))
            table = pa.Table.from_batches(held)
            held = table.slice(table.num_rows - REGION).combine_chunks().to_batches()
    if held:
        yield pairs(*arrays(held))


def candidates(nodes: DataFrame, partitions: int) -> DataFrame:
    """Distinct candidate pairs of ``nodes`` (``node, signature, sketch``)."""
    step = HASHES // ORDERS * 4
    ring = F.concat("signature", "signature")
    order = F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1))).alias("order")
    keyed = nodes.select("node", "sketch", ring.alias("ring"), order).select(
        "order", F.expr(f"substring(ring, order * {step} + 1, {KEY_HASHES * 4})").alias("key"), "node", "sketch"
    )
    dealt = keyed.repartitionByRange(partitions, "order", "key").sortWithinPartitions("order", "key", "node")
    return dealt.mapInArrow(neighbours, "a long, b long, share float").groupBy("a", "b").agg(F.max("share").alias("share"))


def setting(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text, width).view(np.int64) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])

    return run


def linking(width: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pairs with their texts -> the pairs whose shingle sets share ``percent`` of their union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker(word_hashes)
        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            linked, last, held = [], None, None
            # by one of their ends, so that its set is made once
            for at in np.lexsort((a, b)).tolist():
                text = batch.column(3)[at].as_py()
                if last != (b[at], text):
                    last, held = (b[at], text), shingle_set(text, width)
                other = shingle_set(batch.column(2)[at].as_py(), width)
                common = len(np.intersect1d(other, held, assume_unique=True))
                if 100 * common >= percent * (len(other) + len(held) - common):
                    linked.append(at)
            yield pa.RecordBatch.from_arrays([pa.array(a[linked], pa.int64()), pa.array(b[linked], pa.int64())], names=["a", "b"])

    return run


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough.

    Texts are less to shuffle than their sets. Only a node that links a crowd has many
    pairs; adaptive execution splits those.
    """
    a, b = texts.toDF("a", "text_a"), texts.toDF("b", "text_b")
    both = pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(linking(width, percent), "a long, b long")


def likeliest(pairs: DataFrame) -> DataFrame:
    """For each node the candidate whose sketch agrees most."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node"), "a", "b", "share")
    best = ends.groupBy("node").agg(F.max(F.struct("share", "a", "b")).alias("best"))
    return best.select("best.a", "best.b").distinct()


def labelled(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs with the components of their ends; a node without one is its own."""
    a, b = parts.toDF("a", "part_a"), parts.toDF("b", "part_b")
    joined = pairs.join(a, "a", "left").join(b, "b", "left")
    return joined.select("a", "b", F.coalesce("part_a", "a").alias("part_a"), F.coalesce("part_b", "b").alias("part_b"))


def crowd_places(nodes: DataFrame) -> DataFrame:
    """``crowd, order, size, node``: the crowds of two nodes or more."""
    step = HASHES // ORDERS * 4
    order = F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1))).alias("order")
    key = F.expr(f"substring(signature, order * {step} + 1, {CROWD_HASHES * 4})")
    keyed = written(nodes.select("node", "signature", order).select(F.xxhash64("order", key).alias("crowd"), "order", "node"), "crowd-keys")
    shared = few(written(keyed.groupBy("crowd").agg(F.count("*").alias("size")).filter("size > 1"), "crowd-sizes"))
    return written(keyed.join(shared, "crowd").select("crowd", "order", "size", "node"), "crowd-places")


def crowds(places: DataFrame, parts: DataFrame, links: DataFrame) -> DataFrame:
    """``crowd, order, size, node, part, hub``: nodes of crowds that hold several components; ``hub`` has most links of its component there."""
    degrees = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))
    placed = places.join(parts, "node", "left").join(degrees, "node", "left")
    placed = placed.select("crowd", "order", "size", "node", F.coalesce("component", "node").alias("part"), F.coalesce("degree", F.lit(0)).alias("degree"))
    keyed = written(placed, "crowds")
    several = keyed.groupBy("crowd").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low <> high")
    several = few(written(several.select("crowd"), "crowds-apart"))
    members = written(keyed.join(several, "crowd"), "crowd-members")
    most = F.max(F.struct("degree", "node")).alias("most")
    hubs = members.filter("degree > 0").groupBy("crowd", "part").agg(most).select("crowd", F.col("most.node").alias("node"), F.lit(True).alias("hub"))
    return members.join(hubs, ["crowd", "node"], "left").select("crowd", "order", "size", "node", "part", F.coalesce("hub", F.lit(False)).alias("hub"))


def alike(sketch: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Share of equal places of two rows' sketches, for each pair of rows."""
    parts = [(sketch[x[k : k + 65_536]] == sketch[y[k : k + 65_536]]).mean(axis=1) for k in range(0, len(x), 65_536)]
    return np.concatenate(parts) if parts else np.empty(0)


def fitting(part: np.ndarray, size: np.ndarray, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of ``x`` and ``y`` are apart and of sizes that allow the similarity."""
    small, large = np.minimum(size[x, None], size[y]), np.maximum(size[x, None], size[y])
    return (part[x, None] != part[y]) & (100 * small >= percent * large)


def proposals(cell: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    """For each member at most one pair (a < b), with the hub it agrees with most."""
    node, part, size = (cell[c].to_numpy() for c in ("node", "part", "n_shingles"))
    sketch, guest = sketches(cell["sketch"]), cell["hub"].to_numpy()
    hubs, own = np.flatnonzero(guest), np.flatnonzero(~guest)
    best, best_hub = np.zeros(len(own)), np.zeros(len(own), np.int64)
    for some in np.array_split(hubs, len(hubs) // 32 + 1):
        if not len(some) or not len(own):
            continue
        at, other = np.nonzero(fitting(part, size, some, own, percent))
        share = np.zeros((len(some), len(own)))
        share[at, other] = alike(sketch, some[at], own[other])
        top = share.argmax(axis=0)
        better = share[top, np.arange(len(own))] > best
        best = np.maximum(best, share.max(axis=0))
        best_hub[better] = some[top[better]]
    near = np.flatnonzero(best >= SKETCH_SHARE)
    x, y = node[own[near]], node[best_hub[near]]
    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.array(best[near].astype(np.float32))], names=["a", "b", "share"])


def alike_pairs(cell: pa.Table, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of pairs of different components whose sketches agree, and that no earlier order has in one crowd."""
    node, part, size, chunk = (cell[c].to_numpy() for c in ("node", "part", "n_shingles", "chunk"))
    sketch, keys = sketches(cell["sketch"]), np.frombuffer(b"".join(cell["keys"].to_pylist()), np.uint64).reshape(-1, ORDERS)
    order, across = cell["order"][0].as_py(), cell["i"][0].as_py() != cell["j"][0].as_py()
    every = np.arange(len(node))
    for some in np.array_split(every, max(1, len(every) // 32)):
        apart = fitting(part, size, some, every, percent) & (node[some, None] < node)
        if across:
            apart &= chunk[some, None] != chunk
        at, y = np.nonzero(apart)
        near = alike(sketch, some[at], y) >= SKETCH_SHARE
        x, y = some[at[near]], y[near]
        first = ~(keys[x, :order] == keys[y, :order]).any(axis=1)
        yield x[first], y[first]


def meetings(cell: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    """The members that have a pair at all."""
    found = np.zeros(cell.num_rows, bool)
    for x, y in alike_pairs(cell, percent):
        found[x] = found[y] = True
    if found.any():
        yield from cell.select(["crowd", "order", "node", "part", "n_shingles"]).take(pa.array(np.flatnonzero(found))).to_batches()


def cell_links(cell: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    """Links (a < b), confirmed on the members' full sets, that join all components which links of the cell's pairs join."""
    lists = cell["shingles"].combine_chunks()
    sizes = lists.value_lengths().to_numpy().astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    distinct, codes = np.unique(lists.flatten().to_numpy(), return_inverse=True)
    node, root = cell["node"].to_numpy(), cell["part"].to_numpy().copy()
    marked, found = np.zeros(len(distinct), np.int64), []
    for xs, ys in alike_pairs(cell, percent):
        for x in np.unique(xs).tolist():
            others = ys[(xs == x) & (root[ys] != root[x])]
            # so many at a time that their sets are bounded too
            for y in np.array_split(others, sizes[others].sum() // CHUNK_SHINGLES + 1) if len(others) else ():
                if not len(y):
                    continue
                own, ends = codes[starts[x] : starts[x] + sizes[x]], np.cumsum(sizes[y])
                marked[own] = 1
                places = np.arange(ends[-1]) + np.repeat(starts[y] - ends + sizes[y], sizes[y])
                common = np.add.reduceat(marked[codes[places]], ends - sizes[y])
                marked[own] = 0
                for other in y[100 * common >= percent * (sizes[x] + sizes[y] - common)].tolist():
                    if root[other] != root[x]:
                        root[root == root[other]] = root[x]
                        found.append((node[x], node[other]))
    if found:
        a, b = np.array(found, np.int64).T
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def by_cell(meet: Callable[[pa.Table, int], Iterator[pa.RecordBatch]], percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows sorted by cell -> what ``meet`` gives for each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            cell = np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("crowd", "i", "j")], axis=1)
            cuts = [0, *(np.flatnonzero((cell[1:] != cell[:-1]).any(axis=1)) + 1), batch.num_rows]
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                piece = batch.slice(start, end - start)
                if held and any(held[0][c][0] != piece[c][0] for c in ("crowd", "i", "j")):
                    yield from meet(pa.Table.from_batches(held), percent)
                    held = []
                held.append(piece)
        if held:
            yield from meet(pa.Table.from_batches(held), percent)

    return run


def in_cells(rows: DataFrame) -> DataFrame:
    return rows.repartition("crowd", "i", "j").sortWithinPartitions("crowd", "i", "j")


def proposed(members: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs of ``crowds`` between components that are proposed to hubs, which visit all chunks of their crowd."""
    chunks = F.ceil(F.col("size") / CHUNK)
    placed = members.withColumn("chunk", F.pmod(F.xxhash64("node"), chunks))
    columns = ["crowd", "i", "j", "node", "part", "hub"]
    own = placed.withColumns({"i": F.col("chunk"), "j": F.col("chunk"), "hub": F.lit(False)}).select(columns)
    visits = placed.filter("hub").select("*", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("i")).withColumn("j", F.col("i")).select(columns)
    cells = in_cells(own.unionByName(visits).join(nodes.select("node", "n_shingles", "sketch"), "node"))
    return cells.mapInArrow(by_cell(proposals, percent), "a long, b long, share float").groupBy("a", "b").agg(F.max("share").alias("share"))


def visited(members: DataFrame, chunks: Column) -> DataFrame:
    """Every member in the cells of its chunk with each chunk of its crowd."""
    placed = members.withColumn("chunk", F.pmod(F.xxhash64("node"), chunks))
    visits = placed.select("*", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("other"))
    return in_cells(visits.withColumns({"i": F.least("chunk", "other"), "j": F.greatest("chunk", "other")}).drop("other"))


def crowd_links(members: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between components of ``crowds``: all pairs are looked at, and as many links kept in a cell as join its components."""
    step = HASHES // ORDERS * 4
    keys = F.concat(*[F.expr(f"substring(signature, {order * step + 1}, {CROWD_HASHES * 4})") for order in range(ORDERS)])
    described = nodes.select("node", "n_shingles", "sketch", keys.alias("keys"))
    cells = visited(members.drop("hub").join(described, "node"), F.ceil(F.col("size") / CHUNK))
    met = cells.mapInArrow(by_cell(meetings, percent), "crowd long, order int, node long, part long, n_shingles long")
    met = written(met.groupBy("crowd", "order", "node", "part").agg(F.max("n_shingles").alias("n_shingles")), "crowd-alike")
    sizes = met.groupBy("crowd").agg(F.ceil(F.greatest(F.count("*") / CHUNK, F.sum("n_shingles") / CHUNK_SHINGLES)).alias("chunks"))
    sets = shingle_sets(docs, met.select("node").distinct(), width)
    full = met.drop("n_shingles").join(sizes, "crowd").join(described, "node").join(sets, "node")
    found = visited(full, F.col("chunks")).mapInArrow(by_cell(cell_links, percent), "a long, b long")
    return written(found.distinct(), "crowd-links")


def ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def texts_of(docs: DataFrame, involved: DataFrame) -> DataFrame:
    """``node, text`` of the distinct nodes ``involved``."""
    texts = with_ids(docs.select("doc_id", "text"), written(involved, "involved"), "left_semi")
    return written(texts.select(F.col("doc_id").cast("long").alias("node"), "text"), "texts")


def shingle_sets(docs: DataFrame, involved: DataFrame, width: int) -> DataFrame:
    """``node, shingles`` of the distinct nodes ``involved``."""
    return written(texts_of(docs, involved).mapInArrow(setting(width), "node long, shingles array<long>"), "shingle-sets")


def merged(parts: DataFrame, links: DataFrame) -> DataFrame:
    """Components of ``parts`` joined by ``links`` between their nodes."""
    known = parts.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(known.unionByName(links.select("a", "b")))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs``.

    Rows are linked if their sets of shingles of ``width`` words share ``percent`` of
    their union. ``component_id`` is the smallest ``doc_id`` that links lead to;
    ``kept`` is true for the row it names.
    """
    signed = written(signatures(docs, width), "signatures")
    grouped = signed.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()).groupBy("set_hash", "n_shingles")
    nodes = written(
        grouped.agg(F.min("doc_id").alias("node"), F.any_value("signature").alias("signature"), F.any_value("sketch").alias("sketch")), "nodes"
    )
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = written(candidates(nodes, partitions), "candidates")
    texts = texts_of(docs, ends(pairs))

    links = written(confirmed(likeliest(pairs), texts, width, percent), "first-links")
    joined = components(links)
    apart = labelled(pairs, joined).filter(F.col("part_a") != F.col("part_b")).select("a", "b")
    others = written(confirmed(apart, texts, width, percent), "other-links")
    links, seen = links.unionByName(others), pairs.select("a", "b")
    joined = written(merged(joined, others), "forest-parts")
    places = crowd_places(nodes)
    for _ in range(HUB_ROUNDS):
        new = proposed(crowds(places, joined, links), nodes, percent).join(seen, ["a", "b"], "left_anti")
        new = written(new.select("a", "b"), "crowd-pairs")
        found = written(confirmed(new, texts_of(docs, ends(new)), width, percent), "hub-links")
        if found.isEmpty():
            break
        links, joined = links.unionByName(found), written(merged(joined, found), "crowd-parts")
        seen = seen.unionByName(new)
    found = crowd_links(crowds(places, joined, links), nodes, docs, width, percent)
    if not found.isEmpty():
        joined = written(merged(joined, found), "crowd-parts")

    named = nodes.select("set_hash", "n_shingles", "node").join(joined, "node", "left")
    named = named.select("set_hash", "n_shingles", F.coalesce("component", "node").alias("found"))
    own = F.col("doc_id")
    component = F.when(own.isNull() | (F.col("n_shingles") == 0), own).otherwise(F.coalesce("found", own))
    return (
        signed.select("doc_id", "n_shingles", "set_hash")
        .join(named, ["set_hash", "n_shingles"], "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, without those whose component is named after another row."""
    found = near_duplicates(docs, width, percent)
    gone = written(found.filter(~F.col("kept")).select("doc_id").distinct(), "near-copies")
    return with_ids(docs, gone, "left_anti")
