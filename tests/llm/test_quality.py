import zlib

import numpy as np
import pytest

from kiln.llm import quality
from kiln.llm.registered import QUERIES


def test_held_out_quality(spark):
    """Held-out labels, never seen in training: ranking and the decision at 0.3."""
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op2_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.3)
    held = [r for r in rows if r.held_out]
    good, poor = [r.score for r in held if r.quality], [r.score for r in held if not r.quality]
    assert np.mean([g > p for g in good for p in poor]) > 0.97
    assert np.mean([r.predicted == r.quality for r in held]) > 0.97


def test_prior_and_risk_on_known_mixtures():
    rng = np.random.default_rng(0)
    dim = len(quality.features(""))
    for prior in (0.3, 0.8):
        p = rng.normal(1, 1, (3000, dim))
        u = np.r_[rng.normal(1, 1, (int(3000 * prior), dim)), rng.normal(-1, 1, (int(3000 * (1 - prior)), dim))]
        model = quality.fit(p, u)
        assert model.prior == pytest.approx(prior, abs=0.1)
        assert (model.score(rng.normal(1, 1, (500, dim))) > 0.5).mean() > 0.97
        assert (model.score(rng.normal(-1, 1, (500, dim))) < 0.5).mean() > 0.97


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (None, 1), (7, None)], "doc_id long, quality int")
    got = quality.score_documents(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert quality.keep_good(odd, labels).columns == odd.columns
    assert quality.score_documents(none, labels).collect() == []
    assert quality.score_documents(odd, labels.where("false")).count() == odd.count()


def test_same_text_same_score(spark):
    rows = QUERIES["op2_quality"](spark, "/root/testdata/sf0.001").join(
        spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text"), "doc_id").collect()
    scores = {}
    for r in rows:
        assert scores.setdefault(r.text, r.score) == r.score


def test_sample_is_bounded_for_null_ids_and_copies(spark, monkeypatch):
    """A third of the rows without an id and a third of them one row: the samples stay near their size."""
    docs = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN null WHEN id % 3 = 1 THEN 1 ELSE id END AS doc_id",
        "CASE WHEN id % 3 = 1 THEN 'one text' ELSE concat('text number ', id) END AS text")
    labels = spark.range(3000).selectExpr("id AS doc_id", "1 AS quality")
    drawn = []
    monkeypatch.setattr(quality, "fit", lambda p, u: drawn.append((len(p), len(u))))
    quality.train(docs, labels, max_positives=300, max_unlabelled=300)
    (positives, unlabelled), = drawn
    assert positives < 400 and 50 < unlabelled < 400


def test_one_labelled_id_with_many_texts(spark, monkeypatch):
    docs = spark.range(5000).selectExpr("IF(id < 4000, 1, id) AS doc_id", "concat('text number ', id, repeat(' w', CAST(id % 977 AS INT))) AS text")
    labels = spark.createDataFrame([(1, 1), (4500, 1)], "doc_id long, quality int")
    drawn = []
    monkeypatch.setattr(quality, "fit", lambda p, u: drawn.append((len(p), len(u))))
    quality.train(docs, labels, max_positives=50, max_unlabelled=50)
    assert drawn[0][0] < 100
