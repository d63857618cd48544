import itertools

import pytest

from kiln.llm import mixing
from kiln.llm.registered import QUERIES
from tests.llm.conftest import SF, bag


def test_route_fills_overlapping_quotas():
    # ab can serve both: a is short of words of its own, b has plenty
    patterns = [("a", ["a"], 10), ("ab", ["a", "b"], 10), ("b", ["b"], 30)]
    flow = mixing.route(patterns, {"a": 20, "b": 30})
    assert flow["a", "a"] == 10 and flow["ab", "a"] == 10 and flow["b", "b"] == 30


def test_route_cost_is_least():
    """Against every split in whole units, on small cases."""
    def price(words, size):
        return sum(max(0, min(size, words - k * size)) * (k * (k + 1) // 2) for k in range(3))

    for sizes in itertools.product((1, 2, 3), repeat=3):
        for quota in itertools.product((0, 2, 4), repeat=2):
            patterns = [("a", ["a"], sizes[0]), ("ab", ["a", "b"], sizes[1]), ("b", ["b"], sizes[2])]
            flow = mixing.route(patterns, dict(zip("ab", quota)))
            best = (-1, 0)
            for x, y, u, v in itertools.product(range(5), repeat=4):  # a->a, ab->a, ab->b, b->b
                if x + y <= quota[0] and u + v <= quota[1] and x <= 3 * sizes[0] and y + u <= 3 * sizes[1] and v <= 3 * sizes[2]:
                    best = max(best, (x + y + u + v, -(price(x, sizes[0]) + price(y + u, sizes[1]) + price(v, sizes[2]))))
            got = (sum(flow.values()), -sum(price(sum(w for (p, _), w in flow.items() if p == k), s) for k, _, s in patterns))
            assert got == best


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    closed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in closed]
        if not free:
            return closed
        level = (total - sum(closed.values())) / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level >= 3 * sizes[s]]
        if not over:
            return closed | {s: weight[s] * level for s in free}
        closed |= {s: 3.0 * sizes[s] for s in over}


def check(rows, sizes_by_source):
    """rows: (source, size, source_size, target, taken)"""
    targets, taken, largest = brute_targets(sizes_by_source), {}, {}
    for source, size, source_size, target, took in rows:
        assert source_size == sizes_by_source[source] and target == pytest.approx(targets[source])
        assert took <= 3 * size and (size == 0 or took % size == 0)
        taken[source] = taken.get(source, 0) + took
        largest[source] = max(size, largest.get(source, 0))
    smallest = {}
    for source, size, *_ in rows:
        if size:
            smallest[source] = min(size, smallest.get(source, size))
    for source, words in taken.items():
        assert abs(words - targets[source]) <= near(largest[source], smallest.get(source, 0)) + 1


def near(largest, smallest):
    """Documents that are too large at the cut are passed by: what is missing is small."""
    return max(smallest, largest // 4)


def test_query_meets_its_targets(spark):
    rows = {r.doc_id: r for r in QUERIES["op10_mixing"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "text").collect()
    words = {r.doc_id: len(r.text.encode().split()) for r in docs}
    sizes = {}
    for r in docs:
        sizes[r.source] = sizes.get(r.source, 0) + words[r.doc_id]
    assert {k: r["size"] for k, r in rows.items()} == words
    check([(r.source, words[r.doc_id], rows[r.doc_id].source_size, rows[r.doc_id].target, rows[r.doc_id].taken) for r in docs], sizes)


def test_many_ranges_and_a_hot_source(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LAST_ROWS", 8)
    docs = spark.range(900).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE concat('s', id % 5) END AS source",
                                       "repeat('w ', CAST(id % 13 AS INT)) AS text")
    got = mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    sizes = {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    check([(r.source, r["size"], r.source_size, r.target, r.taken) for r in got], sizes)
    again = mixing.mix(docs.repartition(7)).collect()
    assert bag((r.doc_id, r.taken) for r in got) == bag((r.doc_id, r.taken) for r in again)


def test_odd_rows(odd, none):
    got = mixing.mix(odd).collect()
    assert len(got) == odd.count()
    sizes = {r.doc_id: r["size"] for r in got}
    assert sizes[3] == sizes[4] == sizes[5] == 0 and sizes[8] == 60_001
    rows = mixing.take(odd)
    assert rows.columns == odd.columns
    times = {d: rows.where(f"doc_id = {d}").count() for d in (7, 8, 9)}
    assert times == {d: next(r.taken // r["size"] for r in got if r.doc_id == d) for d in (7, 8, 9)}
    assert mixing.mix(none).collect() == [] and mixing.take(none).collect() == []


def test_overlapping_membership(spark):
    from pyspark.sql import functions as F

    docs = spark.range(300).selectExpr("id AS doc_id", "IF(id < 40, 'a', 'b') AS source", "'five words are in here' AS text")
    got = mixing.mix(docs, F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array("source"))).collect()
    assert sum(r.taken for r in got) == pytest.approx(1500, abs=20) and all(r.taken <= 15 for r in got)


def test_take_with_overlapping_membership(spark):
    from pyspark.sql import functions as F

    docs = spark.range(300).selectExpr("id AS doc_id", "IF(id < 40, 'a', 'b') AS source", "'five words are in here' AS text")
    member = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array("source"))
    times = {r.doc_id: r["count"] for r in mixing.take(docs, membership=member).groupBy("doc_id").count().collect()}
    want = {r.doc_id: r.taken // r["size"] for r in mixing.mix(docs, member).collect() if r.taken}
    alone = {r.doc_id: r.taken // r["size"] for r in mixing.mix(docs).collect() if r.taken}
    assert times == want != alone


def words_of(n):
    return "w " * n


def test_null_ids_repeated_ids_and_copies_come_near_their_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LAST_ROWS", 50)
    rows = [(None, words_of(5) + f"x{k}", "a") for k in range(1000)]  # null ids, different texts
    rows += [(None, words_of(6), "b")] * 3000  # one row, a third of the table
    rows += [(7, words_of(5) + f"y{k}", "c") for k in range(4000)]  # one id, different texts
    rows += [(k, words_of(9), "d") for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    got = mixing.mix(docs).collect()
    sizes = {"a": 6000, "b": 18000, "c": 24000, "d": 900}
    targets = brute_targets(sizes)
    assert 0 < targets["b"] % 18000 and 0 < targets["c"] % 24000
    taken = {}
    for r in got:
        key = next(s for s in sizes if sizes[s] == r.source_size)
        taken[key] = taken.get(key, 0) + r.taken
        assert r.taken <= 3 * r["size"]
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 6, (s, taken[s], targets[s])
    again = mixing.mix(docs.repartition(3)).collect()
    assert bag(map(tuple, got)) == bag(map(tuple, again))
    out = mixing.take(docs).groupBy("source").count().collect()
    assert {r.source: r["count"] for r in out} == {"a": taken["a"] // 6, "b": taken["b"] // 6, "c": taken["c"] // 6, "d": taken["d"] // 9}


def test_an_oversized_document_at_the_cut_is_passed(spark):
    rows = [(k, words_of(2), "a") for k in range(2000)] + [(5000 + k, words_of(1500), "b") for k in range(2)] + [(9000 + k, words_of(1), "b") for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    targets = brute_targets({"a": 4000, "b": 3900})
    taken = {}
    for r in got:
        taken[r.source_size] = taken.get(r.source_size, 0) + r.taken
    assert abs(taken[4000] - targets["a"]) <= 2 and abs(taken[3900] - targets["b"]) <= 601


def test_null_membership_is_the_own_source(spark):
    from pyspark.sql import functions as F

    docs = spark.range(60).selectExpr("id AS doc_id", "IF(id < 20, 'a', 'b') AS source", "'five words are in here' AS text")
    null = F.when(F.col("doc_id") % 3 == 0, F.array("source"))
    assert bag(map(tuple, mixing.mix(docs, null).collect())) == bag(map(tuple, mixing.mix(docs).collect()))
    assert mixing.take(docs, membership=null).count() == mixing.take(docs).count()
