import re
from collections import Counter

import pytest

from kiln.llm import hosts
from tests.llm.conftest import bag

BLANK = re.compile(r"[\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = [w for w in BLANK.split(text) if w]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if BLANK.sub("", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_measures_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = hosts.host_rules(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        want = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and not (r.kept and r.base_failed)
    assert any(r.n_repeat_words for r in got)


def test_odd_rows(odd, none):
    got = hosts.host_rules(odd)
    assert bag((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got.collect()) == bag(
        (r.doc_id, *brute(r.text)) for r in odd.collect())
    assert hosts.host_rules(none).collect() == []


def test_shrinking(spark):
    """A host whose documents mostly fail is distrusted, one bad document at a small host isn't enough."""
    good = " ".join(f"word{k}" for k in range(40))
    noisy = " ".join(f"wo{k}%%$" for k in range(40))
    rows = [(k, "big", good) for k in range(400)] + [(1000 + k, "bad", noisy) for k in range(200)] + [(2000, "bad", good)]
    rows += [(3000, "small", noisy)] + [(4000 + k, f"h{k % 40}", noisy if k % 10 == 0 and k % 40 else good) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    table = hosts.hosts(hosts.measures(docs))
    v = {r.source: r for r in table.collect()}
    assert v["bad"].distrusted and not v["big"].distrusted
    assert v["small"].rate_any < 1 and not v["small"].distrusted
    assert 0 < v["h10"].rate_symbols < 1
    kept = {r.doc_id: r.kept for r in hosts.host_rules(docs).collect()}
    assert kept[2000] and not kept[1000] and kept[0]


def test_failures_spread_over_rules_add_up(spark):
    """Half of a host's documents fail one rule, the other half another: no rule alone fails more than half."""
    good = " ".join(f"word{k}" for k in range(40))
    noisy = " ".join(f"wo{k}%%$" for k in range(40))
    lines = "\n".join([good[:80]] * 9 + [good + " end"])
    rows = [(k, "mixed", noisy if k % 20 < 9 else lines if k % 20 < 18 else good) for k in range(200)]
    rows += [(1000 + k, f"h{k % 10}", good if k % 9 else noisy) for k in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    v = {r.source: r for r in hosts.hosts(hosts.measures(docs)).collect()}
    m = v["mixed"]
    assert m.f_symbols == m.f_lines == 90 and m.f_any == 180 and max(m.rate_symbols, m.rate_lines) < 0.5
    assert m.distrusted and [r.source for r in v.values() if r.distrusted] == ["mixed"]
    kept = {r.doc_id: r.kept for r in hosts.host_rules(docs).collect()}
    assert [k for k in range(200) if kept[k]] == [k for k in range(200) if k % 20 >= 18] and all(kept[1000 + k] for k in range(500))


def test_verdicts_change_rows_of_the_tables(spark):
    got = hosts.host_rules(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    changed = sum(not r.base_failed and not r.kept for r in got)
    assert 0 < changed < 0.05 * len(got)


@pytest.mark.parametrize("n", [0, 7, 8, 9, 30])
def test_short_and_repeating_texts(spark, n):
    docs = spark.createDataFrame([(1, "a", "x " * n), (2, "a", "a b c d e f g h " * n), (3, "a", "\n".join(["x y"] * n))], "doc_id long, source string, text string")
    got = {r.doc_id: r.n_repeat_words for r in hosts.measures(docs).collect()}
    assert got == {r.doc_id: brute(r.text)[4] for r in docs.collect()}


def test_no_python_in_the_plan(spark, odd):
    rows = hosts.measures(odd)
    plan = hosts.judged(rows, hosts.hosts(rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
