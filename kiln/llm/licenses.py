"""Licence scan with a generalised suffix automaton of licence words.

The templates' words make one automaton. A text is streamed through it: after
each word, the automaton's state and length are the longest run of words ending
there that occurs in any template (matching statistics). Where a run cannot go
on and has ``MIN_MATCH`` words or more, it is a long match, at every place where
a template has it. The long matches of a template that follow each other in the
text and in the template, with gaps of at most ``MAX_GAP`` words, are chained so
that most words are covered (the heaviest path over the matches in text order),
and a chain that covers ``MIN_COVERAGE`` of its template's words is a span with
the template's label. Of chains of one template that overlap in the text, the
one that covers more stands, then the one that begins and ends earlier.

The base phrases are strings of the same automaton: where a phrase ends is read
from the state, so every place is found in the same pass.

Words that are in no template reset the automaton, and runs of template words
too short to hold the shortest phrase are skipped without a step. Texts are read
chunk by chunk; between chunks only the state and the length of the open run are
kept, so a very long text costs its own bytes, its base places and long matches.

Scalar function of the text: no shuffle, no groups, so a hot source or thousands
of copies cost nothing extra. Null and empty texts have no words and no label;
repeated rows, and rows that share an id, give a result row each; an empty table
gives none; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import alnum_words

MIN_MATCH = 4
MAX_GAP = 12
MIN_COVERAGE = 0.6

# Phrases and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Wording of public licence notices, label first.
TEMPLATES: list[tuple[str, str]] = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation the "
            "rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
                 "with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
            "following conditions are met"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
            "license as published by the free software foundation"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "the person who associated a work with this deed has dedicated the work to the public domain"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
            "provided that the above copyright notice and this permission notice appear in all copies"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following "
            "disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
            "following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd-3", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
              "products derived from this software without specific prior written permission"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable "
             "for any damages arising from the use of this software permission is granted to anyone to use this software for any "
             "purpose including commercial applications and to alter it and redistribute it freely"),
    ("bsl-1", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and "
              "accompanying documentation covered by this license the software to use reproduce display distribute execute and "
              "transmit the software and to prepare derivative works of the software"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use "
                  "compile sell or distribute this software either in source code form or as a compiled binary for any purpose "
                  "commercial or non commercial and by any means"),
    ("agpl", "it under the terms of the gnu affero general public license as published by the free software foundation either "
             "version 3 of the license or at your option any later version"),
    ("epl-2", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0"),
    ("cc-by-nc-sa", "this work is licensed under a creative commons attribution noncommercial sharealike 4 0 international license"),
    ("cc-by-nd", "this work is licensed under a creative commons attribution noderivatives 4 0 international license"),
]

REPORT = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
          "spans array<struct<label:string,first:long,last:long,coverage:double>>")


class SuffixAutomaton:
    """All runs of words of all strings; ``places`` tells where the runs of a state end in the strings."""

    def __init__(self, strings: list[tuple[int, ...]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self._ends: list[list[tuple[int, int]]] = [[]]  # (string, place after) of the prefixes that end in the state
        for k, s in enumerate(strings):
            last = 0
            for end, c in enumerate(s, 1):
                last = self._extend(last, c)
                self._ends[last].append((k, end))
        self._longer: list[list[int]] = [[] for _ in self.link]
        for v in range(1, len(self.link)):
            self._longer[self.link[v]].append(v)
        self._places: dict[int, list[tuple[int, int]]] = {}

    def places(self, state: int) -> list[tuple[int, int]]:
        """Every (string, place after) where the runs of a state end: those of all states that it is a suffix of."""
        if state not in self._places:
            found, below = [], [state]
            while below:
                v = below.pop()
                found += self._ends[v]
                below += self._longer[v]
            self._places[state] = sorted(found)
        return self._places[state]

    def _new(self, length: int, link: int, to: dict[int, int]) -> int:
        self.next.append(to)
        self.link.append(link)
        self.length.append(length)
        self._ends.append([])
        return len(self.link) - 1

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:  # an earlier string goes the same way
            q = self.next[last][c]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        new = self._new(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def _split(self, p: int, c: int, q: int) -> int:
        half = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = half
            p = self.link[p]
        self.link[q] = half
        return half

    def walk(self, words: Iterable[int], state: int, length: int) -> Iterator[tuple[int, int]]:
        """State and length of the longest run that ends at each word."""
        nxt, link, longest = self.next, self.link, self.length
        for w in words:
            while state and w not in nxt[state]:
                state = link[state]
                length = longest[state]
            if w in nxt[state]:
                state = nxt[state][w]
                length += 1
            else:
                length = 0
            yield state, length


class Scanner:
    def __init__(self, templates=TEMPLATES, base=BASE, min_match: int = MIN_MATCH, max_gap: int = MAX_GAP,
                 min_coverage: float = MIN_COVERAGE):
        """``templates``: (label, words in lower case) pairs; ``base``: label by phrase, or pairs of them."""
        base = dict(base)
        self.min_match, self.max_gap, self.min_coverage = min_match, max_gap, min_coverage
        self.labels = [label for label, _ in templates]
        texts = [t.encode().split() for _, t in templates] + [p.encode().split() for p in base]
        vocabulary: dict[bytes, int] = {}
        strings = [tuple(vocabulary.setdefault(w, len(vocabulary) + 1) for w in t) for t in texts]
        self.word = vocabulary.get
        self.size = [len(s) for s in strings]
        self.automaton = SuffixAutomaton(strings)
        self.n_templates = len(templates)
        self.base_labels = list(base.values())
        phrases = {}
        for k, s in enumerate(strings[len(templates):]):
            state = 0
            for w in s:
                state = self.automaton.next[state][w]
            phrases.setdefault(state, []).append((k, len(s)))
        #: base phrases that end where a state's run ends, shortest way up the suffix links
        self.phrases: list[tuple[tuple[int, int], ...]] = []
        for v in range(len(self.automaton.link)):
            own, u = [], v
            while u > 0:
                own += phrases.get(u, [])
                u = self.automaton.link[u]
            self.phrases.append(tuple(own))
        self.shortest = min([min_match, *(len(p.split()) for p in base)])

    def scan(self, text: str | None):
        n, state, length = 0, 0, 0
        base_hits, long_matches = [], []
        for words in alnum_words(text):
            ids = [self.word(w, 0) for w in words]
            borders = np.flatnonzero(np.r_[True, np.array(ids) == 0, True])  # of runs of template words
            first, size = borders[:-1], np.diff(borders) - 1
            walked = size >= self.shortest
            walked[-1] = size[-1] > 0  # goes on in the next chunk
            if length:  # goes on from the last one
                walked[0] = True
            for k in np.flatnonzero(walked):
                at = int(first[k])
                state, length = self._walk(ids[at:at + size[k]], n + at, state, length, base_hits, long_matches)
                if k < len(size) - 1:
                    self._close(n + at + int(size[k]), state, length, long_matches)
                    state, length = 0, 0
            n += len(words)
        self._close(n, state, length, long_matches)
        spans = self._chains(long_matches)
        base = sorted({self.base_labels[k] for _, k in base_hits})
        labels = sorted({*base, *(s[0] for s in spans)})
        places = [p for p, _ in base_hits]
        score = 1.0 if base else max((s[3] for s in spans), default=0.0)
        return (n, len(places), min(places, default=None), max(places, default=None), ",".join(base), ",".join(labels), score,
                [dict(zip(("label", "first", "last", "coverage"), s)) for s in spans])

    def _walk(self, ids, at, state, length, base_hits, long_matches) -> tuple[int, int]:
        """Go on with the open run (state, length) over words that follow at ``at``; the run that is open then."""
        for i, (new, size) in enumerate(self.automaton.walk(ids, state, length), at):
            if size <= length:
                self._close(i, state, length, long_matches)
            for k, words in self.phrases[new]:
                if words <= size:
                    base_hits.append((i + 1 - words, k))
            state, length = new, size
        return state, length

    def _close(self, end, state, length, long_matches) -> None:
        if length >= self.min_match:
            long_matches.append((end - length, end, state))

    def _chains(self, matches) -> list[tuple[str, int, int, float]]:
        """The spans of all templates: the heaviest chains that cover enough, apart in the text."""
        by_template = defaultdict(list)
        for first, end, state in matches:
            for k, t_end in self.automaton.places(state):
                if k < self.n_templates:
                    by_template[k].append((first, end, t_end - (end - first), t_end))
        best: dict[tuple[str, int], tuple] = {}
        for k, own in by_template.items():
            for covered, first, end in self._heaviest(own, self.min_coverage * self.size[k]):
                span = (self.labels[k], first, end - 1, min(1.0, covered / self.size[k]))
                if span[3] > best.get(span[:2], span[:3] + (0.0,))[3]:
                    best[span[:2]] = span
        return sorted(best.values(), key=lambda s: (s[1], s[0]))

    def _heaviest(self, own, least: float) -> list[tuple[int, int, int]]:
        """(words covered, first, end) of one template's chains of at least ``least`` words.

        ``own``: (first, end, template's first, template's end), by end. A match
        looks back only at those that end at most ``max_gap`` words before it,
        so the work does not grow with the square of the text.
        """
        longest = max(end - first for first, end, _, _ in own)
        covered, begin, low = [], [], 0
        for j, (first, end, t_first, t_end) in enumerate(own):
            top, start = end - first, first
            while own[low][1] < first - self.max_gap - longest:  # too far back for this match and all later ones
                low += 1
            for i in range(j - 1, low - 1, -1):
                _, end_i, _, t_end_i = own[i]
                if end_i < first - self.max_gap:
                    break
                skip = max(0, end_i - first, t_end_i - t_first)  # words that the match before has covered
                if skip < end - first and t_first + skip - t_end_i <= self.max_gap:
                    total = covered[i] + end - first - skip
                    if (total, -begin[i]) > (top, -start):
                        top, start = total, begin[i]
            covered.append(top)
            begin.append(start)
        taken: list[tuple[int, int, int]] = []
        for total, first, end in sorted(((c, f, o[1]) for c, f, o in zip(covered, begin, own) if c >= least),
                                        key=lambda s: (-s[0], s[1], s[2])):
            at = bisect_left(taken, first, key=lambda s: s[1])
            if (at == 0 or taken[at - 1][2] <= first) and (at == len(taken) or taken[at][1] >= end):
                taken.insert(at, (total, first, end))
        return taken


_scanners: dict = {}


def scanner(key: tuple = ()) -> Scanner:
    """This worker's scanner for the given settings."""
    if key not in _scanners:
        _scanners[key] = Scanner(**dict(key))
    return _scanners[key]


def scan_column(text: str = "text", **settings) -> Column:
    """The report of each text; settings as of ``Scanner`` (templates, base, min_match, max_gap, min_coverage)."""
    if "templates" in settings:
        settings["templates"] = tuple((label, words) for label, words in settings["templates"])
    if "base" in settings:
        settings["base"] = tuple(dict(settings["base"]).items())
    key = tuple(sorted(settings.items()))

    @F.pandas_udf(REPORT)
    def scan(texts: pd.Series) -> pd.DataFrame:
        s = scanner(key)
        out = pd.DataFrame([s.scan(t) for t in texts], columns=[c.split()[0] for c in REPORT.split(", ")[:7]] + ["spans"])
        return out.astype({"first_word": "Int64", "last_word": "Int64"})

    return scan(F.col(text))


def scan_licenses(docs: DataFrame, **settings) -> DataFrame:
    """``doc_id``, the contract's columns and the covered template spans, for each row of ``docs``."""
    return docs.select("doc_id", "text").withColumn("r", scan_column("text", **settings)).select("doc_id", "r.*")
