import zlib

import numpy as np
import pytest

from recmill.llm import quality as Q
from recmill.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scores(spark):
    return {r.doc_id: r for r in QUERIES["op2_quality_classifier"](spark, SF_DIR).collect()}


@pytest.fixture(scope="module")
def truth(spark):
    return {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}


def test_scores_every_document(spark, scores):
    assert len(scores) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in scores.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in scores.items())


def test_accuracy_on_held_out_labels(scores, truth):
    seen = [(r.predicted, truth[i]) for i, r in scores.items() if r.held_out and i in truth]
    assert np.mean([p == t for p, t in seen]) > 0.97
    good = [p for p, t in seen if t == 1]
    assert np.mean(good) > 0.98


def test_equal_texts_score_alike_and_labels_of_held_out_rows_do_not_matter(spark, scores):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F

    turned = labels.withColumn("quality", F.when(Q.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in Q.quality(docs, turned).collect()}
    assert again == {i: r.score for i, r in scores.items()}
    by_text = {}
    for r in docs.collect():
        assert by_text.setdefault(r.text, scores[r.doc_id].score) == scores[r.doc_id].score


def test_prior_and_risk_on_known_mixture():
    rng = np.random.default_rng(0)
    good, bad = (np.hstack([rng.normal(at, 1, (n, 3)), np.ones((n, 1))]) for at, n in ((1.5, 4000), (-1.5, 1200)))
    model = Q.fit_arrays(good[:2000], np.vstack([good[2000:], bad]))
    assert abs(model.prior - 2000 / 3200) < 0.06
    right = np.concatenate([model.score(good[2000:]) > 0.5, model.score(bad) < 0.5])
    assert right.mean() > 0.97


def test_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (5, None), (None, 1), (6, 0), (6, 1), (4, 1)], "doc_id long, quality int")
    rows = Q.quality(odd_docs, labels).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 for r in rows)
    empty = {r.score for r, t in zip(rows, odd_docs.collect()) if not t.text}
    assert len(empty) == 1
    assert {r.score for r in Q.quality(odd_docs, labels.limit(0)).collect()} == {0.5}
    assert Q.quality(odd_docs.limit(0), labels).count() == 0
    kept = Q.keep_good(odd_docs, labels, threshold=0.0)
    assert kept.columns == odd_docs.columns and kept.count() == 10


def test_sample_is_bounded(spark, documents):
    labels = documents.filter("doc_id % 2 = 0").selectExpr("doc_id", "1 AS quality")
    small = Q.fit(documents, labels, sample=20)
    assert len(small.weights) == Q.WIDTH
