import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from kiln.llm import decontam
from kiln.llm.registered import QUERIES
from tests.llm.conftest import SF, bag

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words_of(text)
        m = min(13, len(w))
        for i in range(len(w) - m + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + m]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w = words_of(text)
        hit, found = set(), set()
        for m in lengths:
            for i in range(len(w) - m + 1):
                own = windows.get(tuple(w[i:i + m]))
                if own:
                    hit.update(range(i, i + m))
                    found |= own
        ids = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def pairs(df, a="doc_id"):
    return [tuple(r) for r in df.select(a, "text").collect()]


def test_query_equals_brute_force(spark):
    want = brute(pairs(spark.read.parquet(f"{SF}/documents.parquet")), pairs(spark.read.parquet(f"{SF}/benchmark.parquet"), "item_id"))
    assert any(r[5] for r in want)
    assert bag(map(tuple, QUERIES["op9_decontamination"](spark, SF).collect())) == bag(want)


@pytest.mark.parametrize("part_words", [200_000, 7])
def test_odd_rows_and_short_items(spark, odd, none, part_words):
    items = [(1, "The QUICK brown"), (2, None), (3, ""), (4, "x"), (None, "lazy dog"), (1, "The QUICK brown"),
             (5, "word " * 13), (6, "jumps over the lazy dog the quick brown fox jumps over the lazy dog the"), (5, "apfel")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(pairs(odd), items)
    found = decontam.contamination(odd.select("doc_id", "text"), bench, "found", part_words=part_words)
    got = [(r.doc_id, r.found.n_words, sum(r.found.spans[1::2]) - sum(r.found.spans[::2]), len(r.found["items"])) for r in found.collect()]
    assert bag(got) == bag([r[:4] for r in want])
    clean = decontam.decontaminate(odd, bench)
    assert clean.columns == odd.columns
    assert bag(r.doc_id for r in clean.collect()) == bag(r[0] for r in want if not r[5])
    assert decontam.report(none, bench).collect() == []
    assert decontam.report(odd, bench.where("false")).where("n_hit > 0 or contaminated").collect() == []


def test_search_over_random_words(monkeypatch):
    rng = random.Random(5)
    for _ in range(60):
        letters = "abc" if rng.random() < 0.5 else "ab"
        text = " ".join(rng.choices(letters, k=rng.randint(0, 200)))
        items = [(str(k), " ".join(rng.choices(letters, k=rng.randint(1, 20)))) for k in range(4)]
        tables = decontam.WuManber([(i, t.encode().split()) for i, t in items])
        want = brute([(0, text)], items)[0]
        for size in (1 << 20, 10):
            monkeypatch.setattr(decontam, "alnum_words", lambda t, s=size: (p.split() for p in __import__("kiln.llm.common", fromlist=["x"]).byte_chunks(t.encode(), s)))
            n, spans, found = decontam.search_text(text, tables, [], set())
            assert (n, sum(spans[1::2]) - sum(spans[::2]), len(found)) == want[1:4]


def test_long_item_in_segments(spark, monkeypatch):
    monkeypatch.setattr(decontam, "_SEGMENT", 5)
    words = [f"w{i}" for i in range(40)]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    segments = decontam._segments(bench, 13).collect()
    windows = {tuple(bytes(r.words).split()[i:i + 13]) for r in segments for i in range(r.n - 12)}
    assert windows == {tuple(w.encode() for w in words[i:i + 13]) for i in range(28)}


def test_added_names_differ_in_any_case(spark, odd):
    docs = odd.withColumnRenamed("_kiln_found", "_KILN_FOUND").withColumn("_Kiln_found_", F.lit("theirs"))
    items = spark.createDataFrame([("i", "no such words")], "item_id string, text string")
    rows = decontam.decontaminate(docs, items)
    assert rows.columns == docs.columns and rows.count() == docs.count()
    assert rows.where("`_KILN_FOUND` = 'theirs' AND `_Kiln_found_` = 'theirs'").count() == docs.count()
    assert decontam.decontaminate(docs, items.where("false")).count() == docs.count()
