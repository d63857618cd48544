import random
import re
import zlib
from collections import defaultdict

import numpy as np

from kiln.llm import toxicity
from kiln.llm.registered import QUERIES


def score(text):
    return toxicity.clause_score(text.encode().split(), {b"idiot": 2.0, b"scum": 3.0}.get and (lambda w: {b"idiot": 2.0, b"scum": 3.0}.get(w, 0.0)))[0]


def test_clauses_not_words():
    plain, aimed = score("what an idiot"), score("you are an idiot")
    assert 0 < plain < aimed
    assert score("you are not an idiot") < plain
    assert score("you are not here today because of that idiot") == aimed  # out of the negation's scope
    assert score("she said you are an idiot") < aimed
    assert score("scum idiot") > score("scum")
    assert score("they kill time") > 0 and score("kill time") == 0  # a threat needs a target or an insult
    assert score("a harmless line") == 0


def test_threat_before_its_object():
    plain = score("i will kill you")
    assert plain == score("they kill time") > 0 and score("we are going to shoot them") == score("burn those people") == plain
    assert 0 < score("i will not kill you") < plain  # the negation is the threat word's, also when the target is out of its scope
    assert score("i will not kill all of those other people") == score("i will not kill you")
    assert 0 < score("he said i will kill you") < plain and 0 < score("i said i will kill you") < plain
    assert score("i said i will not kill you") < score("i said i will kill you")
    assert score("i said i will kill you") == score("i will kill you") * 0.6
    assert score("kill or burn them") == 2 * plain and score("kill them and burn them") == 2 * plain
    assert score("kill that idiot") == score("kill") + score("that idiot") + toxicity.THREAT_WEIGHT
    assert score("kill") == score("kill time and burn wood") == score("i will not kill") == 0
    shape = toxicity.shape("nice words. i will kill you", toxicity.Lexicon({}))
    assert shape[0] == plain and shape[2] > 0
    assert not any(toxicity.shape("i will kill time. you are here", toxicity.Lexicon({})))  # another clause


WORDS = ["idiot", "scum", "kill", "burn", "you", "them", "not", "never", "said", "time", "and", "wood"]
WEIGHTS = {"idiot": 2.0, "scum": 3.0}


def brute_clause(words):
    """The rules, match by match: (sum of weights, number)."""
    aims = [i for i, w in enumerate(words) if w in toxicity.TARGET]
    found = []
    for i, w in enumerate(words):
        if w not in WEIGHTS and w not in toxicity.THREAT:
            continue
        weight = WEIGHTS.get(w, toxicity.THREAT_WEIGHT)
        if any(v in toxicity.NEGATION for v in words[max(0, i - toxicity.SCOPE):i]):
            weight *= 0.4
        if any(v in toxicity.REPORTED for v in words[:i]):
            weight *= 0.6
        if any(j < i for j in aims):
            weight *= 1.5
        elif w not in WEIGHTS and not any(v in WEIGHTS for v in words[:i]):
            later = [v for v in words[i + 1:] if v in WEIGHTS or v in toxicity.TARGET]
            if not later:
                continue
            weight *= 1.5 if later[0] in toxicity.TARGET else 1.0
        found.append(weight)
    return sum(found), len(found)


def test_clause_equals_brute_force():
    rng = random.Random(3)
    for _ in range(4000):
        words = rng.choices(WORDS, k=rng.randint(0, 12))
        total, n = toxicity.clause_score([w.encode() for w in words], lambda w: WEIGHTS.get(w.decode(), 0.0))
        want, n_want = brute_clause(words)
        assert abs(total - want) < 1e-9 and n == n_want, words


def test_document_equals_brute_force():
    rng = random.Random(5)
    lexicon = toxicity.Lexicon({w.encode(): x for w, x in WEIGHTS.items()})
    for _ in range(200):
        clauses = [rng.choices(WORDS, k=rng.randint(0, 9)) for _ in range(rng.randint(0, 6))]
        text = "".join(" ".join(c).upper() + rng.choice([". ", "!\n", "; ", "? "]) for c in clauses)
        found = [brute_clause(c) for c in clauses]
        total, words = sum(t for t, _ in found), sum(map(len, clauses))
        density = total / max(1, words)
        want = [max([t for t, _ in found], default=0.0), np.log1p(total), np.log1p(sum(k > 0 for _, k in found)),
                np.log1p(sum(k for _, k in found)), min(2.0, 20 * density), min(1.0, density) ** 0.5]
        assert np.allclose(toxicity.shape(text, lexicon), want)


def test_lexicon_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    marked = {r.doc_id: r.toxic for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5}
    rows = {(r.text, marked[r.doc_id]) for r in docs.collect() if marked.get(r.doc_id) is not None}
    counts = defaultdict(lambda: [0, 0])
    for text, toxic in rows:
        words = set(re.findall("[^\x00-/:-`{-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
        for w in words | {"^" + w[:k] for w in words for k in toxicity.BEGINNINGS if len(w.encode()) > 5 and len(w) > k}:
            counts[w][0] += 1
            counts[w][1] += toxic
    n, bad = len(rows), sum(t for _, t in rows)
    odds = {w: ((b + 0.5) / (bad + 1)) / ((k - b + 2) / (n - bad + 4)) for w, (k, b) in counts.items() if b >= toxicity.MIN_DOCS}
    want = {w.encode(): np.log(o) for w, o in odds.items() if o >= toxicity.MIN_ODDS}
    got = toxicity.train(docs, labels).lexicon.weight
    assert set(got) == set(want) and want and all(abs(got[w] - want[w]) < 1e-9 for w in want)


def test_composition_is_what_is_scored():
    """Every path through the five transducers by itself: the accepted ones' weights make the clause's score."""
    parts = (toxicity.insults(), toxicity.threats(), toxicity.negation(), toxicity.reported(), toxicity.target())

    def paths(states, symbols):
        if not symbols:
            return [np.prod([p.end(q) for p, q in zip(parts, states)])]
        ways = [((), 1.0, symbols[0])]
        for p, q in zip(parts, states):
            ways = [(done + (to,), f * g, out) for done, f, read in ways for to, g, out in p.ways(q, read)]
        word = {"insult!": 3.0, "threat!": toxicity.THREAT_WEIGHT}
        return [f * word.get(out, 1.0) * x for to, f, out in ways for x in paths(to, symbols[1:])]

    rng = random.Random(9)
    words = {"insult": b"scum", "threat": b"kill", "target": b"you", "negation": b"not", "reported": b"said", "other": b"time"}
    for _ in range(300):
        symbols = rng.choices(toxicity.SYMBOLS, k=rng.randint(0, 7))
        every = paths((0,) * 5, symbols)
        total, n = toxicity.clause_score([words[s] for s in symbols], lambda w: 3.0 if w == b"scum" else 0.0)
        assert abs(total - sum(every)) < 1e-9 and n == sum(x > 0 for x in every)
    assert len({q for q, _ in toxicity.GRAMMAR.step}) == 2 * 4 * 4 * 2 * 2


def test_held_out_toxicity(spark):
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op7_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5)
    held = [r for r in rows if r.held_out]
    bad, fine = [r.score for r in held if r.toxic], [r.score for r in held if not r.toxic]
    # some documents labelled toxic hold repeated or junk words only, like others that are not: nothing in them can be matched
    assert np.mean([(b > f) + (b == f) / 2 for b in bad for f in fine]) > 0.95
    assert np.mean([r.predicted for r in held if r.toxic]) > 0.9 and np.mean([r.predicted for r in held if not r.toxic]) < 0.02


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (None, 1), (7, None), (8, 1), (1, 0)], "doc_id long, toxic int")
    rows = toxicity.score_documents(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score_documents(none, labels).collect() == []
    assert toxicity.score_documents(odd, labels.where("false")).where("predicted = 1").collect() == []


def test_score_needs_the_whole_text():
    lexicon = toxicity.Lexicon({b"scum": 3.0})
    long = "nice words here. " * 200_000 + "you are scum"
    assert toxicity.shape(long, lexicon)[0] == toxicity.shape("you are scum", lexicon)[0] > 0


def test_one_labelled_id_with_many_texts(spark, monkeypatch):
    docs = spark.range(5000).selectExpr("IF(id < 4000, 1, id) AS doc_id", "concat('awful text ', id) AS text")
    labels = spark.createDataFrame([(1, 1), (4501, 0)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "_logistic", lambda x, y: seen.append(len(x)) or (np.zeros(x.shape[1]), 0.0))
    toxicity.train(docs, labels, max_labelled=50)
    assert not seen or seen[0] < 120
