import random

import numpy as np
import pytest
import xxhash

from kiln.llm import simhash
from kiln.llm.registered import QUERIES
from tests.llm.conftest import SF, bag


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [words[i:i + 3] for i in range(len(words) - 2)] or [words]
    hashes = [xxhash.xxh64_intdigest(b" ".join(p), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, radius=2, groups=False):
    prints = [brute_print(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    if groups:
        return {r: [rows[i] for i in range(len(rows)) if find(i) == r] for r in map(find, range(len(rows)))}.values()
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, f"{p:016x}", least.get(find(i))) for i, ((d, _), p) in enumerate(zip(rows, prints))]


def test_fingerprint_equals_brute_force(monkeypatch):
    rng = random.Random(1)
    texts = [None, "", "a", "a b", "A b\tc", "a b c d"] + [" ".join(rng.choices("aa bB Ä ccc".split(), k=rng.randint(1, 90))) for _ in range(50)]
    assert [simhash.fingerprint(t) for t in texts] == list(map(brute_print, texts))
    monkeypatch.setattr("kiln.llm.common.CHUNK_BYTES", 8)  # a default argument: chunk by hand instead
    monkeypatch.setattr(simhash, "byte_chunks", lambda d: __import__("kiln.llm.common", fromlist=["x"]).byte_chunks(d, 8))
    assert [simhash.fingerprint(t) for t in texts] == list(map(brute_print, texts))


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_linked_finds_every_pair(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**63, 12, dtype=np.uint64)
    fps = np.concatenate([b ^ (np.uint64(1) << rng.integers(0, 64, k).astype(np.uint64)) for b, k in zip(base, rng.integers(1, 150, 12))])
    fps = np.r_[fps, fps ^ np.uint64(6), rng.integers(0, 2**63, 300, dtype=np.uint64)]
    buckets = np.sort(rng.integers(0, 9, len(fps)))
    i, j = simhash.linked(buckets, fps, radius)
    label = np.arange(len(fps))
    for a, b in zip(i, j):
        assert buckets[a] == buckets[b]
        label[label == label[b]] = label[a]
    want = np.arange(len(fps))
    for a in range(len(fps)):
        for b in range(a):
            if buckets[a] == buckets[b] and int(fps[a] ^ fps[b]).bit_count() <= radius:
                want[want == want[a]] = want[b]
    same = lambda x: {tuple(np.flatnonzero(x == v)) for v in set(x)}
    assert same(label) == same(want)


def test_hot_bucket_in_tiles(spark):
    """Fingerprints that share most blocks, in tiles of 10 rows: the links are the same as by brute force."""
    rng = random.Random(3)
    fps = sorted({rng.getrandbits(16) << 3 | 1 << 60 for _ in range(250)})
    df = spark.createDataFrame([(f, f) for f in fps], "doc_id long, fp long")
    got = {r.fp: r.component_id for r in simhash.near_duplicates(df, 2, tile_rows=10).collect()}
    label = {f: f for f in fps}
    for a in fps:
        for b in fps:
            if a < b and (a ^ b).bit_count() <= 2 and label[a] != label[b]:
                lo, hi = sorted((label[a], label[b]))
                label = {k: lo if v == hi else v for k, v in label.items()}
    assert got == label


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 150)]
    got = dict(simhash.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(61)} | {100: 100, 150: 100, 200: 100}


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert bag(map(tuple, QUERIES["op1_simhash"](spark, SF).collect())) == bag(brute_components([tuple(r) for r in docs]))


def test_odd_rows(spark, odd, none):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert bag(map(tuple, simhash.simhash_components(odd).collect())) == bag(brute_components(rows))
    assert simhash.simhash_components(none).collect() == []


def test_one_row_of_each_component_stays(spark, odd, none):
    kept = simhash.drop_near_duplicates(odd)
    assert kept.dtypes == odd.dtypes
    groups = brute_components([tuple(r) for r in odd.select("doc_id", "text").collect()], groups=True)
    want = [min((d for d, _ in g if d is not None), default=None) for g in groups]
    assert bag(r.doc_id for r in kept.collect()) == bag(want)
    assert kept.where("doc_id = 1").count() == 1
    assert simhash.drop_near_duplicates(none).collect() == []
