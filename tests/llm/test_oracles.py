"""The registered queries with SQL against DuckDB, and the pipeline against its parts."""

import pytest

import corpus_pipeline
from kiln.llm.registered import ORACLE_SQL, QUERIES
from tests.llm.conftest import SF, bag
from tests.oracle import compare, duck


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    r = compare(spark, name, SF, duck(SF))
    assert r["cols_match"] and r["spark_rows"] == r["oracle_rows"] and r["values_match"], r


def test_thirteen_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark):
    from kiln.llm import decontam, mixing, quality, simhash, tokens

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    columns, at = docs.columns, docs
    good = {r.doc_id for r in quality.score_documents(at, labels).collect() if r.score >= 0.3}
    at = corpus_pipeline.good_quality(spark, at, SF).cache()
    assert at.columns == columns and {r.doc_id for r in at.collect()} == good
    want = {r.component_id for r in simhash.simhash_components(at).collect()}
    at = corpus_pipeline.distinct_documents(spark, at, SF).cache()
    assert at.columns == columns and sorted(r.doc_id for r in at.collect()) == sorted(want)
    want = {r.doc_id for r in decontam.report(at, bench).collect() if not r.contaminated}
    at = corpus_pipeline.clean_of_benchmark(spark, at, SF).cache()
    assert at.columns == columns and {r.doc_id for r in at.collect()} == want
    want = [r.doc_id for r in mixing.mix(at).collect() for _ in range(r.taken // r["size"] if r["size"] else 0)]
    at = corpus_pipeline.mixed_sources(spark, at, SF).cache()
    words = {r.doc_id for r in mixing.mix(at).collect() if r["size"]}
    assert at.columns == columns and sorted(r.doc_id for r in at.collect() if r.doc_id in words) == sorted(want)
    last = corpus_pipeline.token_files(spark, at, SF).collect()
    assert bag(map(tuple, last)) == bag(map(tuple, tokens.tokenize(spark, at).collect()))
    assert bag(map(tuple, last)) == bag(map(tuple, corpus_pipeline.run(spark, SF).collect()))


def _folder(spark, tmp_path, docs):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 1, 0), (7, 0, 0), (8, 0, 1), (None, 1, 0), (9, None, None)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([("i", "no words of the rows"), (None, None)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_pipeline_of_odd_rows(spark, odd, tmp_path):
    sf = _folder(spark, tmp_path, odd)
    at = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = bag(at.select("doc_id", "text").distinct().collect())
        at = stage(spark, at, sf).cache()
        assert at.columns == odd.columns, name
        assert set(bag(at.select("doc_id", "text").collect())) <= set(before), name
        assert at.where("fp = 'theirs' AND _metadata = 'theirs'").count() == at.count(), name
    last = corpus_pipeline.run(spark, sf).collect()
    assert bag(r.doc_id for r in last) == bag(r.doc_id for r in at.collect())


def test_pipeline_of_an_empty_table(spark, none, tmp_path):
    assert corpus_pipeline.run(spark, _folder(spark, tmp_path, none)).collect() == []
