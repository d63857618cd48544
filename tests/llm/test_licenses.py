import random
import re

from kiln.llm import licenses
from kiln.llm.registered import QUERIES
from tests.llm.conftest import SF, bag

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_base(text):
    w = words_of(text)
    hits = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
    places = [i for i, _ in hits]
    return len(w), len(hits), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in hits}))


def brute_matches(words, strings, least):
    """Runs of words that occur in a string and can be extended on neither side."""
    has = lambda run: any(run == s[i:i + len(run)] for s in strings for i in range(len(s)))
    out = set()
    for i in range(len(words)):
        j = i
        while j < len(words) and has(words[i:j + 1]):
            j += 1
        if j - i >= least and not (i and has(words[i - 1:j])):
            out.add((i, j))
    return out


def test_matching_statistics_equal_brute_force(monkeypatch):
    rng = random.Random(4)
    for _ in range(150):
        strings = [" ".join(rng.choices("abc", k=rng.randint(1, 12))) for _ in range(rng.randint(1, 4))]
        scanner = licenses.Scanner([("x", s) for s in strings], {"a b": "ab", "c": "c"}, min_match=3)
        words = rng.choices("abcz", k=60)
        base, long_ = [], []
        at = 0
        for run in re.split("z", " ".join(words)):
            own = run.split()
            state = scanner._walk([scanner.word(w.encode(), 0) for w in own], at, 0, 0, base, long_)
            scanner._close(at + len(own), *state, long_)
            at += len(own) + 1
        assert {(a, b) for a, b, _ in long_} == brute_matches(words, [s.split() for s in strings] + [["a", "b"], ["c"]], 3)
        text = " ".join(words)
        want = sorted([(i, 0) for i in range(59) if words[i:i + 2] == ["a", "b"]] + [(i, 1) for i in range(60) if words[i] == "c"])
        assert sorted(base) == want
        whole = scanner.scan(text)
        monkeypatch.setattr(licenses, "alnum_words", lambda t: (p.split() for p in re.findall(rb"(?:\w ?){1,7}", t.encode())))
        assert scanner.scan(text) == whole
        monkeypatch.undo()


def brute_places(run, strings):
    return sorted((k, i + len(run)) for k, s in enumerate(strings) for i in range(len(s) - len(run) + 1) if s[i:i + len(run)] == run)


def brute_chains(own, gap, least):
    """Every chain, by recursion over what may follow what; those that cover enough, chosen one after another."""
    every = []

    def go(j, covered, first):
        every.append((covered, first, own[j][1]))
        for k in range(j + 1, len(own)):
            skip = max(0, own[j][1] - own[k][0], own[j][3] - own[k][2])
            size = own[k][1] - own[k][0]
            if skip < size and own[k][0] - own[j][1] <= gap and own[k][2] + skip - own[j][3] <= gap:
                go(k, covered + size - skip, first)

    for j in range(len(own)):
        go(j, own[j][1] - own[j][0], own[j][0])
    at_end = {}  # the heaviest, then the earliest, of those with the same last match
    for c, f, e in every:
        at_end[e] = max(at_end.get(e, (0, 0)), (c, -f))
    taken = []
    for c, f, e in sorted(((c, -f, e) for e, (c, f) in at_end.items() if c >= least), key=lambda s: (-s[0], s[1], s[2])):
        if all(e <= f2 or f >= e2 for _, f2, e2 in taken):
            taken.append((c, f, e))
    return sorted(taken, key=lambda s: s[1])


def test_places_and_chains_equal_brute_force():
    rng = random.Random(7)
    n_chains = 0
    for _ in range(300):
        strings = [rng.choices("abcd", k=rng.randint(1, 14)) for _ in range(rng.randint(1, 3))]
        scanner = licenses.Scanner([("x", " ".join(s)) for s in strings], {}, min_match=2, max_gap=2, min_coverage=0.5)
        automaton = scanner.automaton
        for s in strings:
            for i in range(len(s)):
                for j in range(i + 1, len(s) + 1):
                    state = 0
                    for w in s[i:j]:
                        state = automaton.next[state][scanner.word(w.encode())]
                    assert automaton.places(state) == brute_places(s[i:j], strings)
        # matches of one template as the scan makes them: ends rise, places of one match rise
        matches, end = [], 0
        for _ in range(rng.randint(1, 7)):
            end += rng.randint(1, 3)
            size = rng.randint(1, min(4, end))
            t = rng.randint(0, 9)
            matches.append((end - size, end, t, t + size))
        got = scanner._heaviest(matches, 4)
        n_chains += len(got)
        assert got == brute_chains(matches, 2, 4)
    assert n_chains > 100


def test_a_run_that_occurs_twice_chains_at_its_second_place():
    template = "a b c d e f g h a b c d i j k l"
    s = licenses.Scanner([("x", template)], {}, min_match=4)
    r = s.scan("e f g h zz a b c d zz i j k l")  # 12 of 16 words in order
    assert r[5] == "x" and r[6] == 12 / 16 and (r[7][0]["first"], r[7][0]["last"]) == (0, 13)
    twice = s.scan(f"{template} zz {template}")
    assert [(p["first"], p["last"], p["coverage"]) for p in twice[7]] == [(0, 15, 1.0), (17, 32, 1.0)]


def test_many_copies_and_the_whole_table():
    s = licenses.Scanner()
    for label, words in licenses.TEMPLATES:
        assert label in s.scan(words.upper())[5].split(",")
    copies = s.scan((licenses.TEMPLATES[1][1] + "\n\n") * 3000)
    assert len([p for p in copies[7] if p["label"] == "mit" and p["coverage"] == 1.0]) == 3000


def test_template_and_phrase_parameters(spark):
    docs = spark.createDataFrame([(1, "Alpha beta, gamma; delta. By the foo licence!"), (2, None)], "doc_id long, text string")
    rows = licenses.scan_licenses(docs, templates=[["own", "alpha beta gamma delta"]], base={"foo licence": "foo"}).collect()
    assert [(r.n_base, r.base_labels, r.labels) for r in rows] == [(1, "foo", "foo,own"), (0, "", "")]


def test_templates_with_gaps():
    s = licenses.Scanner()
    mit = licenses.TEMPLATES[1][1].split()
    cut = " ".join(mit[:20] + ["unrelated"] + mit[22:])
    r = s.scan("Intro text. " + cut.upper() + " more")
    assert r[5] == "mit" and r[1] == 0 and r[7][0]["first"] == 2 and r[7][0]["last"] == 2 + len(mit) - 2
    assert 0.9 < r[6] < 1
    assert s.scan(" ".join(mit[:10]))[5] == ""  # too little of the template
    assert s.scan("software and the free of a copy")[5] == ""
    assert s.scan("This work is licensed under the GNU General Public License, version 3.")[5] == "gpl"


def test_query_base_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op3_licenses"](spark, SF).collect()
    assert len(rows) == len(docs) and any(r.n_base for r in rows)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(docs[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_odd_rows(odd, none):
    rows = licenses.scan_licenses(odd).collect()
    assert bag((r.doc_id, r.n_words, r.n_base) for r in rows) == bag(
        (r.doc_id, *brute_base(r.text)[:2]) for r in odd.collect())
    assert licenses.scan_licenses(none).collect() == []
