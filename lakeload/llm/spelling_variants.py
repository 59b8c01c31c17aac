"""Grouping spelling variants: words one edit apart, found in a trie kept as tables.

The trie of all words is an edge table (node, character, child) spread over the
cluster; a node is a prefix. States (word, position, node, edits) are joined with
it level by level: a match goes on, a replaced, inserted or deleted character costs
the one edit, and a state goes on only if its child leads to the two characters that
must follow. States at the end of both a word and a node with one edit are neighbours.
There are two tries, of the words and of the reversed words, and in each the first
half of a word must match: so states start deep in the trie, where nodes have few
children, and no state ever stands at the root. An edit is entered at the last place
that gives the same neighbour, so a trie finds it once.

Words of more than ``TRIE_CHARS`` characters would need as many levels. They are
compared by hashes of the word without each of its characters instead: two words
that differ in one replaced character share such a hash at that place, and a word
with one character less is such a hash itself. A place has as many such words as
there are letters at most, so no group is large.

Edge cases: null and empty texts have no words; a null ``doc_id`` counts as the empty
text before the colon; very long texts are read in stretches and very long words are
compared as said; rows that repeat count again; of equal counts the word first in
code-point order is the form; an empty table gives no rows. Of the input only
``doc_id`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.llm.scratch import SENT_IDS, written
from lakeload.runtime import BROADCAST_ROWS, lookup_join, new_run_dir, row_count_within

LETTERS = "A-Za-zÀ-ÿ"
RUNS, BREAK = re.compile(f"[{LETTERS}]+"), re.compile(f"[^{LETTERS}]")

#: A run loses a character when this divides its hash.
DELETION = 97

LEAST_CHARS = 5
LEAST_COUNT = 3

#: A form has this many times its word's occurrences at least.
FORM_RATIO = 2

#: Words that a Python worker counts before it sends them on, and characters it reads at a time.
COUNTED_WORDS = 200_000
STRETCH_CHARS = 1_000_000

#: Longer words are compared by hashes instead of the trie.
TRIE_CHARS = 40

#: Words and reversed words have a trie each; the first character of a node says which.
FORWARD, BACKWARD = ">", "<"

#: Hashes of long words are polynomials modulo a Mersenne prime.
MODULUS, BASE = (1 << 127) - 1, 0x5DEECE66D2B7E151628AED2A6ABF7158


# ---- counting ------------------------------------------------------------------
def runs_of(text: str) -> Counter:
    """Maximal runs of letters and how often they occur."""
    found, at = Counter(), 0
    while at < len(text):
        after = BREAK.search(text, at + STRETCH_CHARS) if len(text) - at > STRETCH_CHARS else None
        end = after.start() if after else len(text)
        found.update(RUNS.findall(text, at, end))
        at = end
    return found


def counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        words, n = pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())
        counts.clear()
        return pa.RecordBatch.from_arrays([words, n], ["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            before = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
            for run, n in runs_of(text or "").items():
                size = len(run)
                if size < LEAST_CHARS:
                    continue
                word = run.encode().lower()
                hashed = zlib.crc32(word, before)
                if hashed % DELETION == 0:
                    if size == LEAST_CHARS:
                        continue
                    chars, at = word.decode(), hashed % size
                    word = (chars[:at] + chars[at + 1 :]).encode()
                counts[word] += n
            if len(counts) > COUNTED_WORDS:
                yield flush()
    yield flush()


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n``: words long enough and frequent enough, over all documents."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = texts.mapInArrow(counted_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= LEAST_COUNT)


# ---- the trie ------------------------------------------------------------------
def oriented(words: DataFrame) -> DataFrame:
    """``path, size, n``: every word forward and backward, each after the mark of its trie."""
    ways = F.array(F.concat(F.lit(FORWARD), "word"), F.concat(F.lit(BACKWARD), F.reverse("word")))
    return words.select(F.explode(ways).alias("path"), (F.length("word") + 1).alias("size"), "n")


def first_place(path: Column, size: Column) -> Column:
    """Characters of a path, with its mark, that a state has matched when it starts."""
    half = F.floor((size - 1) / 2)
    return F.when(path.startswith(FORWARD), 1 + half).otherwise(size - half).cast("int")


def edge_table(paths: DataFrame) -> str:
    """Folder of the edges by ``depth`` of their node: ``node, c, child, child_n`` (the word's n if it is one), ``follow``.

    ``follow`` holds the pairs of characters that go on from the child, each after a
    space; a point stands behind the last character of a word.
    """
    least = 1 + LEAST_CHARS // 2
    steps = paths.withColumn("depth", F.explode(F.sequence(F.lit(least), F.col("size") - 1)))
    edges = steps.select(
        "depth",
        F.expr("left(path, depth)").alias("node"),
        F.expr("substr(path, depth + 1, 1)").alias("c"),
        F.when(F.col("depth") == F.col("size") - 1, F.col("n")).alias("own"),
    )
    edges = written(edges.groupBy("depth", "node", "c").agg(F.max("own").alias("child_n")).withColumn("child", F.concat("node", "c")), "trie")
    # A node has no more children than there are letters.
    letters = edges.groupBy(F.col("node").alias("child")).agg(F.collect_list("c").alias("letters"))
    letters = F.broadcast(letters) if row_count_within(letters) else letters
    further = F.concat(F.coalesce("letters", F.array().cast("array<string>")), F.when(F.col("child_n").isNotNull(), F.array(F.lit("."))).otherwise(F.array().cast("array<string>")))
    pairs = F.array_join(F.transform(further, lambda x: F.concat(F.lit(" "), "c", x)), "")
    follow = edges.join(letters, "child", "left").groupBy(F.col("node").alias("child")).agg(F.array_join(F.collect_list(pairs), "").alias("follow"))
    whole = edges.join(follow, "child", "left").withColumn("follow", F.coalesce("follow", F.lit("")))
    path = new_run_dir(paths.sparkSession, "edges")
    whole.repartition("depth", F.xxhash64("node") % 64).write.partitionBy("depth").parquet(path)
    return path


STEPS = """inline(array(
    struct(place + 1 as next, if(c = here, edits, 1) as cost),
    if(edits = 0 and c <> here, struct(place as next, 1 as cost), null),
    if(edits = 0 and c <> here and c = ahead, struct(place + 2 as next, 1 as cost), null)))"""


def pair_after(place: str) -> Column:
    """The two characters of a path behind a place, as ``follow`` holds them."""
    return F.expr(f"concat(' ', rpad(substr(path, {place} + 1, 2), 2, '.'))")


def step(states: DataFrame, edges: DataFrame) -> DataFrame:
    """One level down: every state along the edges of its node.

    A character that equals the word's matches; any other replaces the word's, is
    inserted before it, or is the one after it, which is then deleted.
    """
    here, ahead = F.expr("substr(path, place + 1, 1)"), F.expr("substr(path, place + 2, 1)")
    looking = states.withColumns({"here": here, "ahead": ahead, "kept": pair_after("place"), "lost": pair_after("place + 1")}).withColumnRenamed("node", "from")
    # Edges that no state can follow further are left out before the states behind them are made.
    useful = F.expr("c = here or c = ahead or place + 1 >= size or contains(follow, kept) or contains(follow, lost)")
    moved = looking.join(edges, (F.col("from") == F.col("node")) & F.when(F.col("edits") == 0, useful).otherwise(F.col("c") == F.col("here")))
    after = moved.select("path", "size", "child", "child_n", "follow", F.expr(STEPS)).filter(F.col("next").isNotNull() & (F.col("next") <= F.col("size")))
    at_end = F.col("next") == F.col("size")
    goes_on = F.when(at_end, F.col("child_n").isNotNull()).otherwise(F.contains("follow", pair_after("next")))
    alive = after.filter((F.col("cost") == 0) | goes_on)
    return alive.select("path", "size", F.col("next").cast("int").alias("place"), F.col("child").alias("node"), F.col("cost").alias("edits"), F.col("child_n").alias("node_n"))


def arrived(states: DataFrame) -> DataFrame:
    """States that are neighbours: all of the word used, or all but a last character that is deleted."""
    used = (F.col("edits") == 1) & (F.col("place") == F.col("size"))
    last_goes = (F.col("edits") == 0) & (F.col("place") == F.col("size") - 1)
    plain = [F.substr(c, F.lit(2)) for c in ("path", "node")]
    word, near = (F.when(F.startswith("path", F.lit(FORWARD)), p).otherwise(F.reverse(p)) for p in plain)
    return states.filter((used | last_goes) & F.col("node_n").isNotNull()).select(word.alias("word"), near.alias("near"), F.col("node_n").alias("near_n"))


def trie_neighbours(words: DataFrame) -> DataFrame | None:
    """``word, near, near_n`` of words in the trie; a pair may stand there twice. None without words."""
    paths = oriented(words)
    longest = paths.agg(F.max("size")).first()[0]
    if longest is None:
        return None
    spark, folder = words.sparkSession, edge_table(paths)
    edges = spark.read.schema("node string, c string, child_n long, child string, follow string, depth int").parquet(folder)
    begun = paths.withColumn("place", first_place(F.col("path"), F.col("size")))
    start = begun.select("path", "size", "place", F.expr("left(path, place)").alias("node"), F.lit(0).alias("edits"), F.lit(None).cast("long").alias("node_n"))
    start = written(start, "starts")
    sizes = {row["depth"]: row["count"] for row in edges.groupBy("depth").count().collect()}  # one row a level
    levels, states = [], None
    for depth in range(1 + LEAST_CHARS // 2, longest + 1):
        own = start.filter(F.col("place") == depth)
        here = own if states is None else own.unionByName(states.filter((F.col("edits") == 0) | (F.col("place") < F.col("size"))))
        own = edges.filter(F.col("depth") == depth).drop("depth")
        states = written(step(here, F.broadcast(own) if sizes.get(depth, 0) <= BROADCAST_ROWS else own), "states")
        levels.append(arrived(states))
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    return found


# ---- long words ----------------------------------------------------------------
def hashed_without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words -> their own hash (place -1), and the hash of the word without the character at each place."""
    for batch in batches:
        for word in batch.column(0).to_pylist():
            points = list(map(ord, word))
            ahead = [0]
            for p in points:
                ahead.append((ahead[-1] * BASE + p) % MODULUS)
            power, hashes = 1, [ahead[-1]]
            for i in range(len(points) - 1, -1, -1):
                hashes.append((ahead[-1] + (ahead[i] - ahead[i + 1]) * power) % MODULUS)
                power = power * BASE % MODULUS
            places = [-1, *range(len(points) - 1, -1, -1)]
            own = hashes[0].to_bytes(16)
            columns = [[own] * len(places), [len(points)] * len(places), places, [h.to_bytes(16) for h in hashes]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["own", "size", "place", "without"])


def long_neighbours(words: DataFrame, limit: int) -> DataFrame:
    """``word, near, near_n`` of the pairs in which a word has more than ``limit`` characters."""
    long = words.filter(F.length("word") >= limit)
    schema = "own binary, size long, place long, without binary"
    hashes = written(long.select("word").mapInArrow(hashed_without, schema), "hashes")
    own = hashes.filter("place = -1").select("own", "size")
    cut = hashes.filter((F.col("place") >= 0) & (F.col("size") > limit))
    a, b = cut.alias("a"), cut.alias("b")
    same = (F.col("a.without") == F.col("b.without")) & (F.col("a.place") == F.col("b.place")) & (F.col("a.size") == F.col("b.size")) & (F.col("a.own") != F.col("b.own"))
    replaced = a.join(b, same).select(F.col("a.own").alias("x"), F.col("b.own").alias("y"))
    shorter = cut.select("own", "without", "size").distinct().alias("c").join(own.alias("o"), (F.col("c.without") == F.col("o.own")) & (F.col("c.size") == F.col("o.size") + 1))
    shorter = shorter.select(F.col("c.own").alias("x"), F.col("o.own").alias("y"))
    pairs = replaced.unionByName(shorter).unionByName(shorter.select(F.col("y").alias("x"), F.col("x").alias("y")))
    names = long.select("word", "n").join(hashes_of(long), "word")
    left = names.select(F.col("own").alias("x"), "word")
    right = names.select(F.col("own").alias("y"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return pairs.join(left, "x").join(right, "y").select("word", "near", "near_n")


def hashes_of(words: DataFrame) -> DataFrame:
    """``word, own``: the hash of each word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word in batch.column(0).to_pylist():
                own = 0
                for p in map(ord, word):
                    own = (own * BASE + p) % MODULUS
                yield pa.RecordBatch.from_arrays([pa.array([word]), pa.array([own.to_bytes(16)])], ["word", "own"])

    return words.select("word").mapInArrow(run, "word string, own binary")


# ---- forms ---------------------------------------------------------------------
def neighbours(words: DataFrame, limit: int = TRIE_CHARS) -> DataFrame:
    """``word, near, near_n`` for words (``word, n``) that differ by one inserted, deleted or replaced character."""
    schema = "word string, near string, near_n long"
    found = trie_neighbours(words.filter(F.length("word") <= limit))
    found = words.sparkSession.createDataFrame([], schema) if found is None else found
    if not words.filter(F.length("word") > limit).isEmpty():
        found = found.unionByName(long_neighbours(words, limit))
    return found.groupBy("word", "near").agg(F.first("near_n").alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for words with a form: forms followed to the last, twice as far in each round.

    A form has twice its word's count at least, so there are no circles and few rounds.
    """
    links = written(forms.select("word", F.col("form").alias("root")), "roots")
    small = row_count_within(links, SENT_IDS // 4)
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        moved = written(lookup_join(links, further, "root", "left", bounded_by=small), "roots")
        if moved.filter(F.col("beyond").isNotNull()).isEmpty():
            return links
        links = moved.select("word", F.coalesce("beyond", "root").alias("root"))


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Every word of the corpus with its form and root: ``word, form, root, n, n_near, form_n``."""
    words = written(word_counts(docs), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    near = neighbours(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    known = words.join(near, "word", "left").withColumn("best_n", -F.col("best.less"))
    fits = F.col("best_n") >= FORM_RATIO * F.col("n")
    known = written(
        known.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(fits, F.col("best.near")).alias("form"), F.when(fits, F.col("best_n")).alias("form_n")),
        "forms",
    )
    found = known.join(roots(known.filter(F.col("form").isNotNull())), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
