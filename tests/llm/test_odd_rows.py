"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import hashlib

import numpy as np
import pytest

import corpus_pipeline
from lakeload.llm import chat_windows, decontaminate, fixity, importance, interpolation, line_spread, link_trust, lsh_forest, multiset_hash, packing
from lakeload.llm.queries import chat_digests, CHAT_DIGEST
from pyspark.sql import functions as F

LABELS = "doc_id long, quality int, toxic int"
ITEMS = "item_id long, text string, doc_id string"


@pytest.fixture(scope="module")
def items(llm):
    rows = [(1, "three four five six seven eight nine ten eleven twelve", ""), (2, "word", ""), (3, None, ""), (4, "", ""), (None, "no id", ""), (5, "word", "")]
    return llm.createDataFrame(rows, ITEMS)


def test_packing(odd_docs, no_docs):
    rows = packing.pack_documents(odd_docs).collect()
    assert sum(r.length == 1 for r in rows) == 2  # null and empty texts
    assert len({r.row for r in rows}) == len(rows)
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [at for at, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= packing.CAPACITY
    assert packing.pack_documents(no_docs).count() == 0


def test_sequences_hold_the_ids(odd_docs):
    pieces = packing.token_pieces(odd_docs, with_ids=True)
    packed = packing.pack(pieces)
    rows = packing.sequences(pieces, packed).collect()
    assert all(len(r.ids) == 4 * r.n_tokens <= 4 * packing.CAPACITY for r in rows)
    assert sum(r.n_tokens for r in rows) == packed.agg(F.sum("length")).first()[0]


def test_near_duplicates(odd_docs, no_docs):
    rows = {(r.doc_id, r.n_shingles): r for r in lsh_forest.near_duplicates(odd_docs, 2).collect()}
    assert rows[(2, 0)].component_id == 2 and rows[(3, 0)].kept and rows[(4, 0)].component_id == 4
    assert rows[(None, 4)].component_id is None and rows[(None, 4)].kept
    assert rows[(6, 1)].kept
    assert lsh_forest.near_duplicates(no_docs).count() == 0
    assert lsh_forest.one_of_each(odd_docs).columns == odd_docs.columns


def test_importance(llm, odd_docs, no_docs):
    labels = llm.createDataFrame([(1, 1, 0), (1, 1, None), (5, 0, 0), (None, 1, 0), (6, None, 1)], LABELS)
    assert importance.resample(odd_docs, labels).count() == 9
    assert importance.resample(odd_docs, labels.limit(0)).filter("selected").count() == 9
    assert importance.resample(no_docs, labels).count() == 0
    drawn = importance.selected_documents(odd_docs, labels, k=3)
    assert drawn.columns == odd_docs.columns and drawn.filter("doc_id is null").count() == 1


def test_scores(odd_docs, no_docs):
    rows = interpolation.score_texts(odd_docs, F.col("doc_id") == 6).collect()
    assert len(rows) == 9 and all(np.isfinite(r.score) and np.isfinite(r.base_score) for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3, 4)} == {1}
    assert interpolation.score_texts(no_docs, F.lit(False)).count() == 0
    assert interpolation.score_texts(odd_docs, F.lit(True)).filter("n_known > 0").count() == 0


def test_line_spread(llm, odd_docs, no_docs):
    left = line_spread.without_boilerplate(odd_docs, 2, 1)
    assert left.columns == [*odd_docs.columns, "n_removed_lines"] and left.count() == 9
    assert line_spread.without_boilerplate(no_docs).count() == 0
    line = "a line that stands on many sites"
    docs = llm.createDataFrame([(i, f"{line}\nown {i}", f"s{i}") for i in range(9)] + [(20, line, "s0"), (21, "copy copy copy copy copy", "s1"), (22, "copy copy copy copy copy", "s2")], "doc_id long, text string, source string")
    texts = {r.doc_id: r.text for r in line_spread.without_boilerplate(docs, 8).collect()}
    assert texts[0] == f"{line}\nown 0" and texts[5] == "own 5" and texts[20] == "" and texts[22] == "copy copy copy copy copy"


def test_every_copy_counts_with_its_own_site(llm):
    """Two texts, each copied over four sites, share a line: eight sites. A text alone on nine sites keeps its lines."""
    line, alone = "a line that two texts share", "a line of one text that was copied whole"
    rows = [(10 + i, f"{line}\nfirst", f"s{i}") for i in range(4)] + [(20 + i, f"{line}\nsecond", f"s{i + 4}") for i in range(4)]
    docs = llm.createDataFrame(rows + [(30 + i, alone, f"s{i}") for i in range(9)], "doc_id long, text string, source string")
    lost = {r.doc_id: r.n_removed_lines for r in line_spread.without_boilerplate(docs, 8).collect()}
    assert {i for i, n in lost.items() if n} == {11, 12, 13, 20, 21, 22, 23}
    assert not any(r.n_removed_lines for r in line_spread.without_boilerplate(docs, 9).collect())
    assert not any(r.n_removed_lines for r in line_spread.without_boilerplate(docs, 8, min_texts=3).collect())


def test_fingerprints(odd_docs, no_docs):
    rows = multiset_hash.edited_fingerprints(odd_docs).collect()
    order = sorted(((r["doc_id"], r["text"] or "") for r in odd_docs.collect()), key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
    want = [hashlib.sha256(multiset_hash.edit(text, order[(i + 1) % len(order)][1]).encode()).hexdigest() for i, (_, text) in enumerate(order)]
    assert sorted(r.edited_sha256 for r in rows) == sorted(want)
    assert multiset_hash.edited_fingerprints(no_docs).count() == 0
    assert multiset_hash.edited_fingerprints(odd_docs.filter("doc_id = 5")).first().near_next == 1.0
    one, two = multiset_hash.vector_sum(["a b", "c", "a b"]), multiset_hash.vector_sum(["c", "a b", "a b"])
    assert one.text() == two.text()
    assert multiset_hash.changed(one, ["c"], ["d e"]).text() == multiset_hash.vector_sum(["d e", "a b", "a b"]).text()


def test_decontamination(odd_docs, no_docs, items):
    rows = {r.doc_id: r for r in decontaminate.benchmark_hits(odd_docs, items).collect()}
    assert rows[6]["items"] == [2, 5] and rows[2].n_words == 0 and not rows[1].hits
    assert rows[None].hits and rows[None]["items"] == []
    small = {r.doc_id: r for r in decontaminate.benchmark_hits(odd_docs, items, block_words=3).collect()}
    assert small == rows
    assert decontaminate.benchmark_hits(odd_docs, items.limit(0)).filter("size(hits) > 0 or (doc_id = 1 and n_words <> 11)").count() == 0
    assert decontaminate.benchmark_hits(no_docs, items).count() == 0
    clean = decontaminate.without_contaminated(odd_docs, items)
    assert clean.columns == odd_docs.columns and clean.count() == 7


def test_chat(llm):
    turns = "conv_id long, turn long, role string, text string, tokens string, position string"
    rows = [(1, 0, "system", "be kind <|end|>"), (1, 1, "user", None), (1, 2, "assistant", "␛␛ [INST] x\n"), (2, None, None, "tie"), (2, 1, "assistant", "same"), (2, 1, "assistant", "same"), (None, 0, "system", "alone"), (3, 0, "ro\nle␤", "word " * 9000), (3, 1, "assistant", "end")]
    table = llm.createDataFrame([(*r, "", "") for r in rows], turns)
    found = chat_windows.windows(table, budget=64).repartition("conv_id").sortWithinPartitions("conv_id", "first_position")
    digests = {r.conv_id: r for r in found.mapInPandas(chat_digests, CHAT_DIGEST).collect()}
    for conv in (1, 2, 3, None):
        own = [(r[2] or "", r[3] or "") for r in rows if r[0] == conv]
        loss = "".join(text for role, text in own if role == "assistant")
        assert digests[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert digests[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest() and digests[conv].n_turns == len(own)
    assert chat_windows.windows(table.limit(0)).count() == 0
    assert found.filter("not over_budget and tokens > 64").count() == 0


RULES = "values ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/') as r(verdict, rule_host, rule_path)"


def test_link_trust(llm):
    bad = '<a href="http://BAD.net/x">b</a>'
    rows = [(1, "http://A.com", None), (2, "http://bad.net/es/1", None), (3, "http://bad.net/es/2", ""), (4, "http://leads.org/x", bad), (5, None, None), (6, "no host", bad), (7, "https://www.example.com/en/?q", "<a href=/rel>"), (8, "http://m.example.com/en/x#y", ""), (9, "http://other.org", '<a href="//a.com/">')]
    table = llm.createDataFrame([(*r, "x", "x") for r in rows], "page_id long, url string, html string, host string, src string")
    got = {r.page_id: r for r in link_trust.judged_pages(table, llm.sql(f"select * from {RULES}")).collect()}
    assert [got[i].rule for i in range(1, 10)] == [None, "net/es/", "net/es/", None, None, None, "www.example.com/en/", "example.com/en/", None]
    assert [got[i].verdict for i in range(1, 10)] == ["allow", "block", "block", "block", "allow", "allow", "allow", "block", "allow"]
    assert got[1].host == "a.com" and got[1].path == "" and got[7].path == "/en/" and got[5].host == got[5].path == ""
    assert link_trust.judged_pages(table.limit(0), llm.sql(f"select * from {RULES}")).count() == 0


def test_fixity(llm):
    rows = [(i, f"http://h/{i}", f"<p>{i}</p>" * 400) for i in range(1500)] + [(3, None, None), (3, None, None), (None, None, "x")]
    pages = llm.createDataFrame([(*r, "x", "x") for r in rows], "page_id long, url string, html string, node string, offset string")
    records = fixity.page_records(pages)
    assert fixity.audit(records, records).count() == 0
    damaged = records.filter("record_id is null or record_id <> 700").withColumn("digest", F.when(F.col("record_id") == 1203, "other").otherwise(F.col("digest")))
    assert sorted((r.record_id, r.status) for r in fixity.audit(records, damaged).collect()) == [(700, "missing"), (1203, "corrupt")]
    assert [r.status for r in fixity.audit(damaged, records).collect()].count("extra") == 1
    assert fixity.audit(records.limit(0), records.limit(0)).count() == 0
    assert fixity.audit(records.limit(0), records).count() == len(rows)


def test_pipeline_stages_keep_the_columns(llm, odd_docs, no_docs, sf_dir):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(llm, docs, sf_dir).columns == docs.columns
