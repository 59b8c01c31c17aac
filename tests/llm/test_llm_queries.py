"""Queries that have SQL against it; the others against brute force over the same tables."""

import math
import zlib
from collections import Counter

import pytest

import corpus_pipeline
from conformance.compare import connect, difference
from lakeload.llm import importance, packing
from lakeload.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_agrees_with_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE_SQL[name]) is None


def test_scores_count_as_a_plain_counter_does(spark, sf_dir):
    texts = {r.doc_id: (r.text or "").encode().lower().split() + [b""] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    counts = Counter()
    for doc_id, words in texts.items():
        counts.update(words if zlib.crc32(str(doc_id).encode()) % 7 != 2 else [])
    n, v = sum(counts.values()), len(counts)
    rows = QUERIES["op7_deleted_interpolation"](spark, sf_dir).collect()
    for r in rows:
        words = texts[r.doc_id]
        assert r.n_tokens == len(words) and r.n_known == sum(counts[w] > 0 for w in words) and r.train_tokens == n
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words), rel_tol=1e-9)
    held_out = [r for r in rows if r.held_out]
    assert sum(r.score for r in held_out) > sum(r.base_score for r in held_out)


def test_packing_meets_its_bound(spark, sf_dir):
    packed = packing.pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet")).persist()
    used, bound = packing.bin_bound(packed)
    assert bound <= used <= bound * 1.02


def test_importance_parts_labelled_texts(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    drawn = importance.resample(docs, labels).join(labels, "doc_id")
    shares = {r.clean: r.share for r in drawn.selectExpr("quality = 1 and toxic = 0 clean", "cast(selected as int) s").groupBy("clean").agg({"s": "avg"}).toDF("clean", "share").collect()}
    assert shares[True] > 0.85 and shares[False] < 0.5


def test_draws_follow_the_weights_and_differ_from_the_largest(spark):
    """Texts of one kind tie in their words; whether one is drawn is chance, more likely with a larger weight."""
    rows = [(i, " ".join(["good"] * (i % 5) + ["bad"] * (4 - i % 5) + [f"own{i}"]), "") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 5 > 2), 0) for i in range(0, 2000)], "doc_id long, quality int, toxic int")
    drawn = importance.resample(docs, labels, k=700, temperature=40.0).collect()
    chosen = {r.doc_id for r in drawn if r.selected}
    largest = {r.doc_id for r in sorted(drawn, key=lambda r: -r.log_weight)[:700]}
    assert len(chosen) == 700 and len(chosen & largest) < 690
    weight = {kind: sum(r.log_weight for r in drawn if r.doc_id % 5 == kind) / 400 for kind in range(5)}
    rate = {kind: sum(i % 5 == kind for i in chosen) / 400 for kind in range(5)}
    ranked = sorted(range(5), key=weight.get)
    assert weight[ranked[-1]] > weight[ranked[0]] and rate[ranked[-1]] > rate[ranked[0]] + 0.05
    assert {r.doc_id for r in importance.resample(docs, labels, k=700, temperature=40.0).collect() if r.selected} == chosen
    noiseless = importance.resample(docs, labels, k=700, temperature=0.0).collect()
    least = min(r.log_weight for r in noiseless if r.selected)
    assert all(r.selected or r.log_weight <= least for r in noiseless) and sum(r.selected for r in noiseless) >= 700


def test_pipeline_runs_every_stage(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert 0 < rows.select("doc_id").distinct().count() < 200
