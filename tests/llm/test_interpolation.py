"""The mixture of bigrams against plain counting."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeload.llm import interpolation

END = b"</end>"


def tokens(text):
    return [w for w in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode().lower()) if w] + [END]


def corpus(seed):
    draw = random.Random(seed)
    vocabulary = [f"Wort{i}é" if i % 7 == 0 else f"w{i}" for i in range(60)]
    texts = [(i, draw.choice([" ", "\n", " \t "]).join(draw.choices(vocabulary, [1 / (k + 1) for k in range(60)], k=draw.randrange(0, 80)))) for i in range(120)]
    long = " ".join(draw.choices(vocabulary, k=900))
    return [*texts, (500, long), (501, "  \n " + long + "  "), (502, None), (503, ""), (504, " "), *[(505, "one and the same row")] * 40, *[(None, "w1 w2")] * 30]


@pytest.mark.parametrize(("batch_bytes", "piece_bytes"), [(3 << 20, 1 << 19), (1500, 200)])
def test_scores_are_those_of_plain_counting(llm, monkeypatch, batch_bytes, piece_bytes):
    seen = {}
    learn = interpolation.learned_weights

    def remember(cells, n_distinct):
        seen["cells"], seen["weights"] = cells, learn(cells, n_distinct)
        return seen["weights"]

    monkeypatch.setattr(interpolation, "learned_weights", remember)
    rows = corpus(3)
    docs = llm.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = interpolation.score_texts(docs, F.col("doc_id") % 7 == 2, batch_bytes, piece_bytes).collect()
    ids = {r[0] for r in llm.createDataFrame(rows, "doc_id long, text string").filter(F.pmod(F.xxhash64("doc_id", F.lit("deleted")), F.lit(8)) == 0).select("doc_id").collect()}

    single, pair, kept, kept_pair = Counter(), Counter(), Counter(), Counter()
    for doc_id, text in rows:
        if doc_id is not None and doc_id % 7 == 2:
            continue
        words = tokens(text)
        pairs = list(zip([END, *words[:-1]], words, strict=True))
        single.update(words)
        pair.update(pairs)
        if doc_id not in ids:
            kept.update(words)
            kept_pair.update(pairs)
    total, distinct, kept_total = single.total(), len(single), kept.total()

    cells = Counter()
    for doc_id, text in rows:
        if doc_id in ids and not (doc_id is not None and doc_id % 7 == 2):
            words = tokens(text)
            for context, word in zip([END, *words[:-1]], words, strict=True):
                shares = (kept_pair[context, word] / kept[context] if kept[context] else 0, kept[word] / kept_total)
                levels = [int(np.clip(np.rint(-4 * np.log2(s)), 0, 255)) if s else -1 for s in shares]
                cells[min(math.frexp(kept[context])[1], 47), *levels] += 1
    assert Counter({tuple(int(v) for v in row[:3]): int(row[3]) for row in seen["cells"]}) == cells

    weights, want = seen["weights"], Counter()
    for doc_id, text in rows:
        words = tokens(text)
        base = sum(math.log10((single[w] + 1) / (total + distinct + 1)) for w in words)
        score = 0
        for context, word in zip([END, *words[:-1]], words, strict=True):
            by = weights[min(math.frexp(single[context])[1], 47)]
            of_pair = pair[context, word] / single[context] if single[context] else 0
            score += math.log10(by[0] * of_pair + by[1] * single[word] / total + by[2] / (distinct + 1))
        want[doc_id, bool(doc_id is not None and doc_id % 7 == 2), len(words), sum(single[w] > 0 for w in words), total, round(base, 6), round(score, 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got) == want


def test_learned_weights_are_a_fixed_point():
    draw = np.random.default_rng(5)
    cells = np.stack([np.full(200, 3), draw.integers(-1, 40, 200), draw.integers(4, 60, 200), draw.integers(1, 50, 200)], axis=1).astype(float)
    weight = interpolation.learned_weights(cells, 1000)[3]
    estimates = np.stack([np.where(cells[:, 1] >= 0, 2 ** (-cells[:, 1] / 4), 0), 2 ** (-cells[:, 2] / 4), np.full(200, 1 / 1001)], axis=1)
    share = estimates * weight
    again = (share / share.sum(axis=1)[:, None] * cells[:, 3:]).sum(axis=0) + [0, 0, 1]
    assert np.abs(again / again.sum() - weight).max() < 1e-5


def test_pieces_keep_every_word_and_its_context():
    text = "  aa bbbbbbbbbbbbbbbb c  d\t e   "
    found = list(interpolation.pieces(text, 3))
    assert "".join(piece for _, piece, _ in found) == text
    assert [last for _, _, last in found] == [False] * (len(found) - 1) + [True]
    words = [w for _, piece, _ in found for w in interpolation.space_words(piece)]
    assert words == interpolation.space_words(text)
