"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols: insult (a learned lexicon of words and of word
beginnings, each with a weight), threat, target, negation, reported speech, or
other. Five small transducers read a clause's symbols, each what the one before
put out. The insult transducer takes one insult or none, and the threat
transducer one threat if no insult was taken, so a path through all of them is
one match. A threat is taken at once if a target or insult came before; else
it waits, and the path counts only if one is read later ("kill you"), which
puts the threat's delayed weight out. Negation weighs what is taken within
``SCOPE`` words after a negating word, reported speech up to the clause's end, target
once someone is addressed or named. Their composition is one table over the
product of their states; it is made deterministic by sets of states, with a sum
of path weights for each. The weights of all accepted paths make the clause's
score; a document is scored by its clauses (the strongest, all together, how
many, how dense) through a logistic curve. Words outside the grammar only move
the states on, so isolated harmless words score nothing.

Learned from labelled rows outside the held-out fold, on a sample bounded by
``MAX_LABELLED`` rows (by a hash of doc_id, and of the text where ids have several
texts): the lexicon (document counts by label of words and beginnings, counted
by Spark; log-odds as weights; all words in ``MIN_DOCS`` toxic documents or more
of that sample) and the curve. Every document is then scored in one pass, as a
scalar function of its text.

Null and empty texts score like a text without matches; very long ones are read
in chunks. Repeated labels count as 1 if any says 1, copies of a text count once
in learning and are scored each; without labels of both kinds the score is the
default; a score that equals the threshold is toxic. An empty table gives no
rows. ``doc_id`` and ``text`` are read only; columns of other names do not matter.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import LOWER_ALNUM, byte_chunks, encoded, hash_share, held_out, saved

MAX_LABELLED = 20_000
MIN_DOCS = 4
MIN_ODDS = 15.0
CLEAN_PRIOR = 2.0  # clean documents that every word is taken to have been in
BEGINNINGS = (5, 6)
DEFAULT_SCORE = 0.1
THRESHOLD = 0.5
SCOPE = 3
_FLUSH = 200_000

# Words of the grammar's closed classes (lower case; English, French, German, Spanish).
THREAT = {"kill", "murder", "hurt", "destroy", "beat", "shoot", "stab", "burn", "tuer", "töten", "umbringen", "matar"}
TARGET = {"you", "your", "he", "she", "they", "him", "her", "them", "people", "toi", "vous", "tu", "du", "dich", "ihr", "tú", "usted", "ustedes"}
NEGATION = {"not", "no", "never", "isn", "aren", "wasn", "don", "doesn", "pas", "jamais", "nicht", "kein", "keine", "nie", "nunca"}
REPORTED = {"said", "says", "quoted", "reported", "claims", "claimed", "dit", "sagte", "sagt", "dijo", "dice"}

CLAUSE_END = re.compile(rb"[.!?;:\n]+")


# ---------------------------------------------------------------- grammar
SYMBOLS = ("insult", "threat", "target", "negation", "reported", "other")
#: What a path takes as its match is put out as one of these, and weighed by the word.
TAKEN = ("insult!", "threat!")
AIMED = 1.5  # factor of a match aimed at someone
THREAT_WEIGHT = 2.0


@dataclass(frozen=True)
class Transducer:
    """States 0..n-1, from 0; for a state and symbol the ways on (next state, factor, symbol put out).

    A symbol without an entry keeps the state and passes through; an empty
    entry ends the path. ``final`` is the weight of a path that ends in a state.
    """
    n: int
    step: dict[tuple[int, str], tuple[tuple[int, float, str], ...]]
    final: tuple[float, ...] = ()

    def ways(self, state: int, symbol: str) -> tuple[tuple[int, float, str], ...]:
        return self.step.get((state, symbol), ((state, 1.0, symbol),))

    def end(self, state: int) -> float:
        return self.final[state] if self.final else 1.0


def insults() -> Transducer:
    """Takes one insult of the clause (state 1) or none."""
    return Transducer(2, {(0, "insult"): ((0, 1.0, "insult"), (1, 1.0, "insult!"))})


def threats(aimed: float = AIMED, alone: float = 0.0) -> Transducer:
    """Takes one threat unless an insult is taken.

    States: 0 no target or insult yet, 1 one was read, 2 a threat taken in state 0
    waits, 3 taken. ``aimed`` is the delayed factor of a waiting threat whose
    target comes, ``alone`` the weight of one that waits to the end.
    """
    step = {(0, "target"): ((1, 1.0, "target"),), (0, "insult"): ((1, 1.0, "insult"),),
            (0, "threat"): ((0, 1.0, "threat"), (2, 1.0, "threat!")), (1, "threat"): ((1, 1.0, "threat"), (3, 1.0, "threat!")),
            (2, "target"): ((3, aimed, "target"),), (2, "insult"): ((3, 1.0, "insult"),)}
    step |= {(q, "insult!"): ((3, 1.0, "insult!"),) for q in (0, 1)} | {(q, "insult!"): () for q in (2, 3)}
    return Transducer(4, step, (0.0, 0.0, alone, 1.0))


def _weighing(n: int, factors: dict[int, float]) -> dict:
    """In the given states, what is taken is weighed by a factor."""
    return {(q, s): ((q, f, s),) for q, f in factors.items() if q < n for s in TAKEN}


def negation(scope: int = SCOPE, factor: float = 0.4) -> Transducer:
    """State k: the next k words are negated."""
    step = {(k, s): ((k - 1, factor if s in TAKEN else 1.0, s),) for k in range(1, scope + 1) for s in SYMBOLS + TAKEN}
    return Transducer(scope + 1, step | {(k, "negation"): ((scope, 1.0, "negation"),) for k in range(scope + 1)})


def reported(factor: float = 0.6) -> Transducer:
    return Transducer(2, _weighing(2, {1: factor}) | {(0, "reported"): ((1, 1.0, "reported"),)})


def target(factor: float = AIMED) -> Transducer:
    return Transducer(2, _weighing(2, {1: factor}) | {(0, "target"): ((1, 1.0, "target"),)})


@dataclass(frozen=True)
class Composed:
    """Over the product of the states: ways on (next state, factor, whether the word's weight counts), and final weights."""
    start: int
    step: dict[tuple[int, str], tuple[tuple[int, float, bool], ...]]
    final: tuple[float, ...]


def compose(*parts: Transducer) -> Composed:
    """The transducers one after another, each reading what the one before puts out."""
    states = list(product(*(range(p.n) for p in parts)))
    number = {s: k for k, s in enumerate(states)}
    table = {}
    for s in states:
        for symbol in SYMBOLS:
            ways = [((), 1.0, symbol)]
            for p, q in zip(parts, s):
                ways = [(done + (to,), f * g, out) for done, f, read in ways for to, g, out in p.ways(q, read)]
            table[number[s], symbol] = tuple((number[to], f, out in TAKEN) for to, f, out in ways)
    return Composed(0, table, tuple(math.prod(p.end(q) for p, q in zip(parts, s)) for s in states))


def determinised(c: Composed) -> tuple[dict, list[list[float]]]:
    """Sets of states in place of states: {(set, symbol): (next set, moves)} and the final weights in each set.

    A move (i, j, factor, word counts) carries the weight of the set's i-th
    state to the next set's j-th; None where every weight stays as it is.
    """
    sets = {(c.start,): 0}
    steps, todo = {}, [(c.start,)]
    while todo:
        here = todo.pop()
        for symbol in SYMBOLS:
            ways = [(i, *way) for i, q in enumerate(here) for way in c.step[q, symbol]]
            there = tuple(dict.fromkeys(to for _, to, _, _ in ways))
            if there not in sets:
                sets[there] = len(sets)
                todo.append(there)
            moves = [(i, there.index(to), f, word) for i, to, f, word in ways]
            same = len(here) == len(there) and moves == [(i, i, 1.0, False) for i in range(len(here))]
            steps[sets[here], symbol] = (sets[there], None if same else (len(there), moves))
    return steps, [[c.final[q] for q in s] for s in sets]


GRAMMAR = compose(insults(), threats(), negation(), reported(), target())
STEPS, FINAL = determinised(GRAMMAR)
CLOSED = {w.encode(): s for s, words in (("threat", THREAT), ("target", TARGET), ("negation", NEGATION), ("reported", REPORTED)) for w in words}


def clause_score(words: list[bytes], insult) -> tuple[float, int]:
    """Weight and number of the matches in a clause; ``insult(word)`` is a word's weight or 0."""
    at, weights, paths = 0, [1.0], [1]
    for w in words:
        weight = insult(w)
        at, moves = STEPS[at, "insult" if weight else CLOSED.get(w, "other")]
        if moves:
            n, ways = moves
            old, old_paths, weights, paths = weights, paths, [0.0] * n, [0] * n
            for i, j, factor, word in ways:
                weights[j] += old[i] * factor * ((weight or THREAT_WEIGHT) if word else 1.0)
                paths[j] += old_paths[i]
    total, n = 0.0, 0
    for x, k, f in zip(weights, paths, FINAL[at]):
        if f:
            total, n = total + x * f, n + k
    return total, n


# ---------------------------------------------------------------- documents
def beginnings(word: bytes) -> list[bytes]:
    """The word's beginnings of ``BEGINNINGS`` characters, marked so that they differ from words."""
    if len(word) <= BEGINNINGS[0]:
        return []
    text = word.decode("utf-8", "replace")
    return [b"^" + text[:k].encode() for k in BEGINNINGS if len(text) > k]


@dataclass
class Lexicon:
    weight: dict[bytes, float]

    def insult(self, word: bytes) -> float:
        own = self.weight.get(word)
        if own is None:
            own = max((self.weight.get(b, 0.0) for b in beginnings(word)), default=0.0)
        return own


def shape(text: str | None, lexicon: Lexicon) -> list[float]:
    """What the grammar finds in a whole text: strongest clause, all clauses, clauses, matches, density."""
    known: dict[bytes, float] = {}
    best, total, clauses, matches, n = 0.0, 0.0, 0, 0, 0
    for part in byte_chunks(encoded(text)):
        words = part.translate(LOWER_ALNUM).split()
        n += len(words)
        found = False
        for w in set(words):
            if w not in known:
                known[w] = lexicon.insult(w)
            found = found or bool(known[w]) or CLOSED.get(w) == "threat"
        if not found:
            continue  # nothing for the grammar to match
        for clause in CLAUSE_END.split(part):
            score, k = clause_score(clause.translate(LOWER_ALNUM).split(), lambda w: known.get(w, 0.0))
            if k:
                best, total, clauses, matches = max(best, score), total + score, clauses + 1, matches + k
        if len(known) > _FLUSH:
            known = {w: x for w, x in known.items() if x}
    density = total / max(1, n)
    return [best, math.log1p(total), math.log1p(clauses), math.log1p(matches), min(2.0, 20 * density), math.sqrt(min(1.0, density))]


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float

    def score(self, texts) -> np.ndarray:
        x = np.array([shape(t, self.lexicon) for t in texts]).reshape(-1, len(self.weights))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -30, 30)))


# ---------------------------------------------------------------- learning
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents by word and beginning, folded in the task before the shuffle."""
    def out(counts):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array([c[0] for c in counts.values()], pa.int64()),
             pa.array([c[1] for c in counts.values()], pa.int64())], names=["word", "n", "bad"])

    counts: dict[bytes, list[int]] = defaultdict(lambda: [0, 0])
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            words = {w for part in byte_chunks(encoded(text)) for w in part.translate(LOWER_ALNUM).split()}
            for w in words | {b for w in words for b in beginnings(w)}:
                c = counts[w]
                c[0] += 1
                c[1] += label
            if len(counts) > _FLUSH:
                yield out(counts)
                counts.clear()
    yield out(counts)


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    known = labels.where(~held_out("doc_id") & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = max_labelled / max(1, known.count())
    sample = known.where(hash_share(F.col("doc_id"), 7) < share)
    # max_labelled ids; copies of a text count once
    rows = saved(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "toxic").dropDuplicates(["text", "toxic"]),
                 "toxicity-sample")
    share = max_labelled / max(1, rows.count())
    if share < 1:  # an id may have any number of texts
        rows = rows.where(hash_share(F.xxhash64("text"), 8) < share)
    n, bad = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < bad < n:
        return Model(Lexicon({}), np.zeros(6), math.log(DEFAULT_SCORE / (1 - DEFAULT_SCORE)))
    counts = rows.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(_count, "word binary, n long, bad long")
    odds = ((F.col("bad") + 0.5) / F.lit(bad + 1.0)) / ((F.col("n") - F.col("bad") + CLEAN_PRIOR) / F.lit(n - bad + 2 * CLEAN_PRIOR))
    found = (counts.groupBy("word").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).where(F.col("bad") >= MIN_DOCS)
             .withColumn("odds", odds).where(F.col("odds") >= MIN_ODDS).collect())  # words of MIN_DOCS or more of max_labelled rows
    lexicon = Lexicon({bytes(r.word): math.log(r.odds) for r in found})

    @F.pandas_udf("array<double>")
    def matched(texts: pd.Series) -> pd.Series:
        return pd.Series([shape(t, lexicon) for t in texts])

    data = sorted(map(tuple, rows.select(matched("text").alias("x"), "toxic").collect()))  # max_labelled rows, in an order of their own
    x, y = np.array([r[0] for r in data]), np.array([float(r[1]) for r in data])
    return Model(lexicon, *_logistic(x, y))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 40) -> tuple[np.ndarray, float]:
    """Newton steps on the ridge-penalised logistic loss."""
    z = np.c_[x, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (p - y) / len(y) + ridge * np.r_[w[:-1], 0]
        h = (z * (p * (1 - p))[:, None]).T @ z / len(y) + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
    return w[:-1], float(w[-1])


def score_column(model: Model, text: str = "text") -> Column:
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts))

    return score(F.col(text))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``."""
    scored = docs.select("doc_id", "text").select("doc_id", score_column(train(docs, labels)).alias("score"))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
