"""Groups far larger than the neighbours a node is paired with."""

import random

import numpy as np
import pytest

from lakeload.llm import lsh_forest


def shingles(text, width):
    words = text.split()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute_force(texts, width):
    """The least id of the component of each text, by all pairs."""
    sets, parent = {i: shingles(t, width) for i, t in texts.items()}, {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b:
                common = len(sets[a] & sets[b])
                if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return {i: root(i) for i in texts}


@pytest.mark.parametrize(("width", "changed"), [(2, 20), (5, 8)])
def test_a_star_of_copies_is_one_component(llm, width, changed):
    draw = random.Random(width)
    base = [f"w{draw.randrange(10**6)}" for _ in range(400)]
    texts = {500: " ".join(base)}
    for i in [*range(500), *range(501, 1001)]:
        copy = list(base)
        for at in draw.sample(range(400), changed):
            copy[at] = f"x{draw.randrange(10**9)}"
        texts[i] = " ".join(copy)
    want = brute_force(texts, width)
    docs = llm.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in lsh_forest.near_duplicates(docs, width).collect()}
    assert got == want


def test_a_crowd_of_texts_that_are_alike_but_not_linked_makes_no_row_a_pair(llm, monkeypatch):
    draw = random.Random(7)
    base = [f"w{draw.randrange(10**6)}" for _ in range(300)]

    def changed(words, times):
        copy = list(words)
        for at in draw.sample(range(len(copy)), times):
            copy[at] = f"x{draw.randrange(10**9)}"
        return copy

    words = {i: changed(base, 11) for i in range(400)}
    words |= {1000 + i: changed(words[i], 3) for i in range(0, 400, 20)}
    texts = {i: " ".join(some) for i, some in words.items()}
    want, sizes = brute_force(texts, 2), {}

    def counted(df, label, write=lsh_forest.written):
        table = write(df, label)
        sizes[label] = max(sizes.get(label, 0), table.count())
        return table

    monkeypatch.setattr(lsh_forest, "written", counted)
    monkeypatch.setattr(lsh_forest, "CHUNK", 100)  # a crowd of several cells
    docs = llm.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in lsh_forest.near_duplicates(docs, 2).collect()}
    assert got == want
    assert len(set(want.values())) > 300  # most are linked with nothing
    # a crowd is met in 16 orders; the number of its pairs is far above that
    assert max(n for label, n in sizes.items() if label.startswith("crowd")) <= 16 * len(texts), sizes


def test_candidates_of_a_crowd_grow_with_its_nodes(llm):
    draw, words = random.Random(3), [f"w{i}" for i in range(300)]
    texts = [" ".join([*words[:at], f"x{i}", *words[at + 1 :]]) for i, at in ((i, draw.randrange(300)) for i in range(600))]
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    nodes = lsh_forest.signatures(docs, 2).withColumnRenamed("doc_id", "node")
    pairs = lsh_forest.candidates(nodes, 4).collect()
    assert len(pairs) <= lsh_forest.ORDERS * len(texts)
    assert {end for r in pairs for end in (r.a, r.b)} == set(range(len(texts)))


def test_spanning_pairs_join_what_all_pairs_join():
    draw = np.random.default_rng(5)
    for size in (0, 1, 40, 400):
        a, b = draw.integers(0, 60, size), draw.integers(60, 120, size)
        kept = lsh_forest.spanning(a, b, draw.integers(82, 90, size) / 128)

        def joined(some, a=a, b=b):
            part = np.arange(120)
            for x, y in zip(a[some], b[some], strict=True):
                part[part == part[y]] = part[x]
            return part

        whole = joined(np.arange(size))
        assert (joined(kept)[:, None] == joined(kept)).tolist() == (whole[:, None] == whole).tolist()
        assert len(kept) == 120 - len(set(whole.tolist()))
