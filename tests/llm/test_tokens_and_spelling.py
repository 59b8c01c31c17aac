"""Spelling variants, SentencePiece and alignment against plain Python and the libraries."""

import hashlib
import random
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter

import numpy as np
import pytest

from lakeload.llm import packing, piece_agenda, spelling_variants, token_alignment
from lakeload.llm.queries import QUERIES
from lakeload.llm.tokens import default_vocabulary

TRICKY = [
    "", " ", "  a", "a▁b", "</s>[INST]", "\x00a", "a\n\nb", "\n lead", "tail \n", "�", "é漢字🦄", "é", "\ta  \t b", "x" * 3000, "   " * 50, "<0x41><s>",
    "▁▁▁ ▁", "a" * 5 + " " * 37 + "b\r\n", "한국어 문장", "\U0001f468‍\U0001f469", "<|endoftext|> and </s>", "two  spaces",
]


def random_texts(seed, n=300):
    rng = random.Random(seed)
    parts = ["the", " ", "ing", "é", "漢", "\n", "🦄", " a", ".", "1", "  ", "▁", "\t", ",", "Word"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(n)]


# ---- spelling ------------------------------------------------------------------
def plain_counts(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in spelling_variants.RUNS.findall(text or ""):
            word = run.encode().lower().decode()
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 97 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= 2 * counts[w] else None

    def root(w):
        return w if forms[w] is None else root(forms[w])

    return {w: (forms[w], root(w), counts[w], len(near[w]), counts.get(forms[w])) for w in counts}


def found_variants(docs):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling_variants.spelling_variants(docs).collect()}


def spelled(seed, n_words, letters, sizes):
    """Documents of random words with many near ones among them."""
    rng = random.Random(seed)
    words = ["".join(rng.choice(letters) for _ in range(rng.choice(sizes))) for _ in range(n_words)]
    for word in words[: n_words // 2]:
        at = rng.randrange(len(word))
        words += [word[:at] + word[at + 1 :], word[:at] + rng.choice(letters) + word[at:], word[:at] + rng.choice(letters) + word[at + 1 :]]
    return [(i, " ".join(word for word in rng.sample(words, len(words)) for _ in range(rng.choice([1, 1, 2, 5])))) for i in range(4)]


@pytest.mark.parametrize("letters, sizes", [("aéÀB", (5, 6, 8)), ("abcdefgh", (5, 9))])
def test_variants_equal_all_pairs(llm, letters, sizes):
    docs = spelled(len(letters), 60, letters, sizes)
    want = plain_variants(plain_counts(docs))
    assert len(want) > 30 and found_variants(llm.createDataFrame(docs, "doc_id long, text string")) == want


def test_long_words_are_compared_like_short_ones(llm):
    docs = spelled(7, 60, "ab", (6, 7, 8, 9))
    counts = plain_counts(docs)
    words = llm.createDataFrame(list(counts.items()), "word string, n long")
    want = {(w, v, counts[v]) for w in counts for v in counts if one_edit(w, v)}
    for limit in (4, 7):
        assert {tuple(r) for r in spelling_variants.neighbours(words, limit).collect()} == want


def test_odd_words(llm, odd_docs, no_docs):
    assert spelling_variants.spelling_variants(no_docs).count() == 0
    want = plain_variants(plain_counts([(r["doc_id"], r["text"]) for r in odd_docs.collect()]))
    assert found_variants(odd_docs) == want
    giant = "x" * 5_000
    docs = [(None, f"{giant} {giant}y {giant}"), (1, f"{giant}y {giant} {giant}y"), (2, None), (3, ""), (4, "Städte städte STäDTE Stadte×÷")]
    assert found_variants(llm.createDataFrame(docs, "doc_id long, text string")) == plain_variants(plain_counts(docs))


# ---- SentencePiece -------------------------------------------------------------
@pytest.fixture(scope="module")
def pieces():
    return piece_agenda.vocabulary(piece_agenda.default_model())


def test_agendas_equal_the_library(pieces):
    texts = TRICKY + random_texts(1)
    want = pieces.library.encode(texts, num_threads=1)
    assert [np.frombuffer(ids, "<i4").tolist() for ids in pieces.encode(texts)] == want
    # one agenda for a whole text, without sections, gives the same
    for text, ids in zip(texts, want):
        whole = pieces.section_ids(pieces.prefix + text.replace(" ", piece_agenda.SPACE_MARK)) if text else b""
        assert np.frombuffer(whole, "<i4").tolist() == ids


def test_decoding_equals_the_library(pieces):
    rng = random.Random(2)
    for _ in range(500):
        ids = [rng.randrange(32_000) if rng.random() < 0.6 else rng.randrange(259) for _ in range(rng.randint(0, 12))]
        assert pieces.decode(ids) == pieces.library.decode(ids)


def test_forgetting_changes_nothing(pieces, monkeypatch):
    monkeypatch.setattr(piece_agenda, "REMEMBERED", 5)
    texts = random_texts(3, 60)
    assert [np.frombuffer(pieces.encode([text])[0], "<i4").tolist() for text in texts] == pieces.library.encode(texts, num_threads=1)


def test_a_difference_is_an_error(pieces, monkeypatch):
    monkeypatch.setattr(pieces, "encode", lambda texts: [b"" for _ in texts])
    with pytest.raises(ValueError, match="document 7"):
        piece_agenda.checked(pieces, [7], ["word"])


def test_encoded_documents(llm, odd_docs, no_docs, pieces):
    rows = piece_agenda.encode_documents(odd_docs).collect()
    texts = {(r["doc_id"], r["text"] or "") for r in odd_docs.collect()}
    assert len(rows) == 9 and {(r.doc_id, r.decoded) for r in rows} == texts
    assert all(list(r.ids) == pieces.library.encode(r.decoded, add_eos=True) for r in rows)
    assert piece_agenda.encode_documents(no_docs).count() == 0


def test_piece_query_equals_the_library(spark, sf_dir, pieces):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in QUERIES["op12_piece_agenda"](spark, sf_dir).collect():
        ids = pieces.library.encode(texts[r.doc_id], add_eos=True)
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), digest, hashlib.sha256(pieces.library.decode(ids).encode()).hexdigest())


def test_packed_ids_are_the_plain_tokenizers(llm):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(default_vocabulary())
    texts = [*TRICKY, "a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "<|endoftext"]
    rows = packing.token_pieces(llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    found = {}
    for r in sorted(rows, key=lambda r: r.piece):
        found.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32))
    for i, text in enumerate(texts):
        ids = [*plain.encode(text, add_special_tokens=False).ids, packing.END_ID]
        assert found[i] == [(start, n, zlib.crc32(np.asarray(ids[start : start + n], "<u4").tobytes())) for start, n, _ in found[i]]
        assert sum(n for _, n, _ in found[i]) == len(ids)


# ---- alignment -----------------------------------------------------------------
def plain_alignment(aligner, text):
    """Token pairs by their byte ranges, all against all that overlap."""
    a = np.frombuffer(aligner.a_tokens.encode([f" {text}"])[0], "<u4").tolist() if text else []
    b = aligner.b_tokens.library.encode(text) if text else []
    parts = [aligner.a_bytes[i] for i in a], [aligner.b_bytes[i] for i in b]
    if not text or any(b"".join(p) != f" {text}".encode() for p in parts):
        return 0, 0, 0, 0, "", Counter()
    a_ends, b_ends = (np.cumsum([len(x) for x in p]).tolist() for p in parts)
    links, i, j = Counter(), 0, 0
    for i, (end, part) in enumerate(zip(a_ends, parts[0])):
        for j in range(bisect_right(b_ends, end - len(part)), len(b)):
            if b_ends[j] - len(parts[1][j]) >= end:
                break
            links[a[i], b[j]] += 1
    groups, cuts, sides = [], sorted(set(a_ends) & set(b_ends)), []
    for ids, ends in ((a, a_ends), (b, b_ends)):
        held = [[] for _ in cuts]
        for i, end in zip(ids, ends):
            held[bisect_left(cuts, end)].append(str(i))
        sides.append(held)
    groups = [f"{','.join(x)}|{','.join(y)}" for x, y in zip(*sides)]
    return len(a), len(b), len(groups), sum(links.values()), ";".join(groups), links


@pytest.fixture(scope="module")
def aligner():
    return token_alignment.aligner(default_vocabulary(), piece_agenda.default_model())


def check_alignment(llm, docs, aligner, **options):
    plain = [(doc_id, plain_alignment(aligner, text)) for doc_id, text in docs]
    held = Counter(pair for _, p in plain for pair in p[5])
    highest = {}
    for (a, _), n in held.items():
        highest[a] = max(highest.get(a, 0), n)
    want = Counter(
        (doc_id, *p[:5], sum(n for pair, n in p[5].items() if held[pair] == highest[pair[0]]), sum(n * held[pair] for pair, n in p[5].items())) for doc_id, p in plain
    )
    aligned = token_alignment.aligned_documents(llm.createDataFrame(docs, "doc_id long, text string")).withColumn("row", token_alignment.F.monotonically_increasing_id())
    rows = token_alignment.with_pair_counts(token_alignment.written(aligned, "aligned"), **options).collect()
    assert Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.groups, r.n_best, r.count_sum) for r in rows) == want


@pytest.mark.parametrize("sent", [0, 20])
def test_alignment_equals_all_overlaps(llm, aligner, sent):
    docs = list(enumerate(TRICKY + random_texts(5, 60))) + [(1, "the same"), (1, "the same"), (None, "no id"), (9, None)]
    check_alignment(llm, docs, aligner, sent=sent)


def test_alignment_forgets_windows(llm, aligner, monkeypatch):
    monkeypatch.setattr(token_alignment, "REMEMBERED_WINDOWS", 3)
    monkeypatch.setattr(token_alignment, "text_slices", lambda texts: [(i, i + 1) for i in range(len(texts))])
    texts = random_texts(6, 40)
    for i, text in enumerate(texts):
        row = aligner.align(token_alignment.pa.array([i], token_alignment.pa.int64()), [text]).to_pylist()[0]
        want = plain_alignment(aligner, text)
        assert (row["n_a"], row["n_b"], row["n_groups"], row["n_links"], row["groups"]) == want[:5]
        assert {divmod(p, token_alignment.PAIR_BASE): n for p, n in zip(row["pairs"], row["links"])} == dict(want[5])


def test_odd_alignments(odd_docs, no_docs, aligner, llm):
    check_alignment(llm, [(r["doc_id"], r["text"]) for r in odd_docs.collect()], aligner)
    assert token_alignment.align_documents(odd_docs).count() == 9
    assert token_alignment.align_documents(no_docs).count() == 0


def test_a_batch_is_cut_into_windows_at_once(aligner, monkeypatch):
    """One pass for all texts of a batch, also around those whose tokens do not join to them."""
    texts = ["one two  three", "", "a▁b", "Ünï \n x", " lead", *random_texts(7, 40)]
    calls = []
    cut = aligner.window_keys
    monkeypatch.setattr(aligner, "window_keys", lambda *args: calls.append(1) or cut(*args))
    rows = aligner.align(token_alignment.pa.array(range(len(texts)), token_alignment.pa.int64()), texts).to_pylist()
    assert len(calls) == 1
    for row, text in zip(rows, texts):
        want = plain_alignment(aligner, text)
        assert (row["n_a"], row["n_b"], row["n_groups"], row["n_links"], row["groups"]) == want[:5]
        assert {divmod(p, token_alignment.PAIR_BASE): n for p, n in zip(row["pairs"], row["links"])} == dict(want[5])
