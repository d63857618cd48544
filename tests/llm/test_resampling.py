import hashlib
import math
import random
import re
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.llm import resampling
from kiln.llm.registered import QUERIES
from tests.llm.conftest import SF, bag

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, max_words=2):
    words = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(words[i:i + k]) for k in range(1, max_words + 1) for i in range(len(words) - k + 1)]
    return words, [crc32(r.encode("utf-8", "surrogatepass")) % 10_000 for r in runs]


def brute(docs, target, percent=25):
    """``(doc_id, n_features, weight, score, rank)`` by the definitions alone; docs: distinct ids."""
    s, t = [0] * 10_000, [0] * 10_000
    for texts, counts in (([x for _, x in docs], s), (target, t)):
        for text in texts:
            for b in features(text)[1]:
                counts[b] += 1
    n_s, n_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + 10_000) / ((s[b] + 1) * (n_t + 10_000)))) for b in range(10_000)]
    rows, able = [], []
    for doc, text in docs:
        words, found = features(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc, len(found), weight, score))
        if len(words) >= 20:
            able.append((-score, doc))
    drawn = {doc: k + 1 for k, (_, doc) in enumerate(sorted(able)[:percent * len(able) // 100])}
    return [(*r, drawn.get(r[0])) for r in rows]


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = brute(docs, target)
    got = [(r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in QUERIES["op12_resampling"](spark, SF).collect()]
    assert bag(got) == bag(want) and any(w[4] for w in want)


def test_run_hashes():
    rng = random.Random(1)
    words = ["".join(rng.choices("abé9", k=rng.choice([1, 2, 5, 47, 48, 49, 200]))).encode() for _ in range(300)]
    for k, found in enumerate(resampling.run_hashes(words, 4)):
        assert found.tolist() == [crc32(b" ".join(words[i:i + k + 1])) for i in range(300 - k)]
    assert [len(x) for x in resampling.run_hashes([b"a"], 2)] == [1, 0]
    assert [len(x) for x in resampling.run_hashes([], 2)] == [0, 0]


def test_blocks_of_words_lose_no_run(monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["a", "Bc", "d9", "é"], k=rng.randint(0, 30))) for _ in range(50)] + [None, "", "x"]
    want = [sorted(features(t, 3)[1]) for t in texts]
    for size in (1, 2, 3, 7, 10_000):
        monkeypatch.setattr(resampling, "_BLOCK_WORDS", size)
        got = [[] for _ in texts]
        for owner, hashes, _ in resampling._features(texts, 3):
            for o, h in zip(owner.tolist(), hashes.tolist()):
                got[o].append(h % 10_000)
        assert [sorted(g) for g in got] == want


@pytest.mark.parametrize("block_rows", [3, 1000])
def test_cutoff_is_the_exact_key(spark, block_rows):
    rng = random.Random(4)
    rows = [(rng.randint(-5, 5), rng.choice([1, 2, resampling._LAST]), rng.randint(-3, 3), k) for k in range(500)]
    rows += [(0, 7, 0, 1000 + k) for k in range(250)]  # a third of the rows tie in all but their place
    keys = spark.createDataFrame(rows, "down long, id long, tie long, at long").repartition(7).cache()
    order = sorted(rows)
    for k in (1, 300, 749):
        assert resampling.cutoff(keys, k, block_rows) == order[k - 1]
    assert resampling.cutoff(keys, 0) is None and resampling.cutoff(keys, 751) is None
    ranks = {r["at"]: r["rank"] for r in resampling.ranked(keys).collect()}
    assert ranks == {r[3]: k + 1 for k, r in enumerate(order)}


def test_each_round_discards_a_quarter(spark, monkeypatch):
    rng = np.random.default_rng(1)
    keys = spark.createDataFrame([(int(v), 0, 0, k) for k, v in enumerate(rng.integers(0, 10**6, 4000))],
                                 "down long, id long, tie long, at long").repartition(9).cache()
    sizes, around = [], resampling._around

    def seen(df, pivot, rows):
        out = around(df, pivot, rows)
        sizes.append(sum(r.below + r.equal + r.above for r in out))
        return out

    monkeypatch.setattr(resampling, "_around", seen)
    resampling.cutoff(keys, 1000, 100)
    assert all(b <= 0.75 * a + 1 for a, b in zip(sizes[1:], sizes[2:])) and len(sizes) > 4


def test_weighted_median():
    assert resampling.weighted_median([((3,), 1), ((1,), 1), ((2,), 5)]) == (2,)
    assert resampling.weighted_median([((9,), 1)]) == (9,)


def test_sample_has_the_rows_drawn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("AT", F.lit("theirs")).withColumn("_KILN_AT", F.lit(1))
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = {r.doc_id for r in resampling.resample(docs, target, 40).collect() if r["rank"]}
    got = resampling.sample(docs, target, 40)
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == sorted(want)


def test_odd_rows(spark, odd, none):
    target = spark.createDataFrame([("the quick brown fox", 1), (None, 2), ("", 3)], "text string, item_id long")
    repeated = odd.unionByName(odd.where("doc_id = 1")).unionByName(odd.where("doc_id IS NULL"))
    got = resampling.resample(repeated, target, 60, 3).collect()
    want = brute([(r.doc_id, r.text) for r in repeated.collect()], ["the quick brown fox"], 0)
    assert bag(tuple(r)[:4] for r in got) == bag(w[:4] for w in want)
    n_able = sum(len(features(r.text)[0]) >= 3 for r in repeated.collect())
    drawn = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    assert [r["rank"] for r in drawn] == list(range(1, 60 * n_able // 100 + 1))
    assert [r.score for r in drawn] == sorted((r.score for r in drawn), reverse=True)
    assert resampling.resample(none, target).collect() == []
    assert all(r["rank"] is None for r in resampling.resample(odd, target.where("false"), 0).collect())
    assert resampling.sample(odd, target, 60, 3).columns == odd.columns
