import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kiln.llm import divergence
from tests.llm.conftest import bag

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs=30, top=50):
    """By the definitions alone; rows: ``(text, lang, source)``."""
    df, n, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(LOWER))
        langs[lang].add(source)
        df[lang].update(set(terms))
        n[lang, source].update(terms)
    out = []
    for lang, sources in langs.items():
        kept = [t for t, k in df[lang].items() if k >= min_docs]

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(n[lang, s]) for s in sources}
        q = shares(sum((n[lang, s] for s in sources), Counter()))
        for s in sources:
            far = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            near = [(p[s][t] - q[t], t) for t in kept if n[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", far, len(far)), ("term", near, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(found[:most])]
    return out


def made(n=300):
    """Few terms in many documents; a third of the rows in one group; terms that tie."""
    rng = random.Random(9)
    rows = []
    for k in range(n):
        source = "hot" if k % 3 == 0 else rng.choice(["a", "b", "é", None])
        words = rng.choices(["The", "the", "cat", "Straße", "ÄÖ", "日本", "x", "y", "zz", f"rare{k}", "it's"], k=rng.randint(0, 12))
        rows.append((rng.choice([" ", "-", "\n", "7"]).join(words), rng.choice(["en", "en", "de", None]), source))
    return rows + [(None, "fr", "a"), ("", "fr", "b"), ("only one text", "fr", "c"), ("lonely", "xx", "a")]


SCHEMA = "text string, lang string, source string"


def test_against_brute_force(spark):
    rows = made()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for min_docs, top in ((30, 50), (5, 3), (10**6, 50)):
        got = divergence.audit(docs, min_docs, top)
        assert bag(map(tuple, got.collect())) == bag(brute(rows, min_docs, top))
    assert dict(got.dtypes)["value"] == "bigint" and dict(got.dtypes)["rank"] == "int"


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_colliding_digests_are_split(spark, bits):
    rows = made()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert bag(map(tuple, divergence.audit(docs, 12, 5, bits).collect())) == bag(brute(rows, 12, 5))


def test_a_digest_over_the_limit_of_terms_below_it(spark):
    # two terms in 20 documents each share a digest of 40
    rows = [("aa", "en", "s")] * 20 + [("bb", "en", "t")] * 20
    assert divergence.term_digest(b"aa", 0) == divergence.term_digest(b"bb", 0) == 0
    got = divergence.audit(spark.createDataFrame(rows, SCHEMA), 30, 50, 0).collect()
    assert bag(map(tuple, got)) == bag([("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)])


def test_broadcast_parts_and_blocks(spark, monkeypatch):
    rows = made(150)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    monkeypatch.setattr(divergence, "BLOCK_BYTES", 200)
    monkeypatch.setattr(divergence, "BLOCK_CELLS", 4)
    monkeypatch.setattr(divergence, "MOST_CELLS", 8)
    got = divergence.audit(docs, 2, 50, part_rows=3).collect()
    assert bag(map(tuple, got)) == bag(brute(rows, 2))


def test_only_numbers_are_shuffled_before_terms_are_kept(spark):
    docs = spark.createDataFrame(made(60), SCHEMA)
    found = divergence.occurrences(docs, 0)
    plan = found.groupBy("lang_id", "digest").agg(F.sum("df"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan
    exchange = found.groupBy("lang_id", "digest").agg(F.sum("df").alias("df"))
    assert [t for _, t in exchange.dtypes] == ["bigint"] * 3
    texts = found.where("term IS NOT NULL").groupBy("lang_id", "term").count()
    assert texts.count() == found.select("lang_id", "digest").distinct().count()


def test_shares_are_exact(spark):
    rows = [(0, 1, 1), (10**12, 3 * 10**12, 7), (9 * 10**15, 9 * 10**15 + 1, 10**6), (5, 0, 0)]
    df = spark.createDataFrame(rows, "n long, total long, terms long").select(divergence.share("n", "total", "terms").alias("p"))
    assert [r.p for r in df.collect()] == [1 + 10**9 * (n + 5) // (t + 5 * v) if v else 0 for n, t, v in rows]


def test_groups_with_colliding_seed(spark, monkeypatch):
    docs = spark.createDataFrame(made(30), SCHEMA)
    ids = divergence._ids
    monkeypatch.setattr(divergence, "_ids", lambda seed: ids(seed) if seed else (F.lit(1).cast("long").alias("lang_id"), F.lit(2).cast("long").alias("grp")))
    assert {r.seed for r in divergence.groups(docs).collect()} == {1}


def test_odd_rows(spark, odd, none):
    clash = odd.withColumn("grp", F.lit("theirs")).withColumn("digest", F.lit("theirs")).withColumn("N", F.lit(1)).withColumn("term", F.lit(2))
    got = divergence.audit(clash, 2).collect()
    assert bag(map(tuple, got)) == bag(brute([(r.text, r.lang, r.source) for r in odd.collect()], 2))
    assert divergence.audit(none).collect() == []
