"""Benchmark decontamination by Wu-Manber search over words.

Every window of ``WINDOW`` consecutive words of a benchmark item is a pattern
(an item of fewer words is one pattern). Patterns of one length share tables:

* shift: how far the search may move on when it sees a block of two words at
  the end of its window; a block in no pattern lets it skip nearly a whole
  window, so most words of a clean document are never looked at;
* suffix buckets: for a block that ends patterns, the patterns by their first
  block, so that a candidate is tested only if both ends agree;
* a direct comparison of all words confirms an occurrence.

The tables hold the benchmark, which is broadcast in parts of at most
``part_words`` words (a benchmark beyond that is searched part by part, each
pass a written table). Documents are never shuffled: the search is a scalar
function of the text, so a hot source or a group of copies costs nothing extra.

Null and empty texts have no words: no hit, not contaminated. Repeated rows of
``docs`` give repeated result rows, repeated items count once, items without
words match nothing, and an item with a null id marks words but is not listed.
Items that share words or whole windows are each listed, and overlapping places
count a word once, so ties need no rule. Very long texts are read in segments
that overlap by a window, so a place across a border is found once. Without
documents there are no rows; with an empty benchmark nothing is hit. ``doc_id``
and ``text`` (``item_id`` and ``text``) are read only; names added to whole rows
are chosen so that they differ from the rows' own.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from uuid import uuid4

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import alnum_words, free_name, saved

WINDOW = 13
PART_WORDS = 200_000
FOUND = "n_words long, spans array<long>, items array<string>"
_SEGMENT = 10_000


class WuManber:
    """Shift tables and suffix buckets, a set for each pattern length."""

    def __init__(self, segments: Iterable[tuple[str | None, list[bytes]]], window: int = WINDOW):
        owners: dict[tuple[bytes, ...], set[str | None]] = defaultdict(set)
        for item, words in segments:
            m = min(window, len(words))
            if m:
                for i in range(len(words) - m + 1):
                    owners[tuple(words[i:i + m])].add(item)
        by_length = defaultdict(list)
        for p in owners:
            by_length[len(p)].append(p)
        self.longest = max(by_length, default=0)
        self.tables = []
        for m, patterns in sorted(by_length.items()):
            b = min(2, m)
            shift: dict[tuple[bytes, ...], int] = {}
            buckets: dict = {}
            for p in patterns:
                for end in range(b, m + 1):
                    block = p[end - b:end]
                    shift[block] = min(m - end, shift.get(block, m))
                buckets.setdefault(p[m - b:], {}).setdefault(p[:b], []).append((p, sorted(map(str, owners[p] - {None}))))
            self.tables.append((m, b, m - b + 1, shift, buckets))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, int, list[str]]]:
        """(first word, end, items) of every occurrence, by pattern length and place."""
        n = len(words)
        for m, b, far, shift, buckets in self.tables:
            get, i = shift.get, m  # i: end of the window
            while i <= n:
                block = (words[i - 2], words[i - 1]) if b == 2 else (words[i - 1],)
                move = get(block, far)
                if move:
                    i += move
                    continue
                for p, items in buckets[block].get(tuple(words[i - m:i - m + b]), ()):
                    if tuple(words[i - m:i]) == p:
                        yield i - m, i, items
                i += 1


def search_text(text: str | None, tables: WuManber, spans: list[int], items: set[str]) -> tuple[int, list[int], set[str]]:
    """Words of the text, and the given spans and items with the occurrences of ``tables`` added.

    Chunk by chunk: a chunk begins with the last words of the one before, as many as a pattern can need.
    """
    n, carry, found = 0, [], list(zip(spans[::2], spans[1::2]))
    items = set(items)
    for words in alnum_words(text):
        base = n - len(carry)
        n += len(words)
        words = carry + words
        for lo, hi, owners in tables.search(words):
            found.append((base + lo, base + hi))
            items.update(owners)
        carry = words[len(words) - tables.longest + 1:] if tables.longest > 1 else []
        if len(words) < tables.longest - 1:
            carry = words
    found.sort()
    merged: list[int] = []
    for lo, hi in found:
        if merged and lo <= merged[-1]:
            merged[-1] = max(merged[-1], hi)
        else:
            merged += [lo, hi]
    return n, merged, items


_built: dict = {}  # tables of this worker: the last broadcast only


def _tables(shared, window: int) -> WuManber:
    if shared.id not in _built:
        _built.clear()
        _built[shared.id] = WuManber(((i, w.split(b" ")) for i, w in shared.value), window)
    return _built[shared.id]


class _Shared:
    """A broadcast with a name by which workers keep what they build of it."""

    def __init__(self, name: str, broadcast):
        self.id, self._broadcast = name, broadcast

    @property
    def value(self):
        return self._broadcast.value


def _segments(benchmark: DataFrame, window: int) -> DataFrame:
    """Benchmark texts as ``item, words, n``: items longer than a segment in overlapping pieces that share all windows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                words = [w for part in alnum_words(text) for w in part]
                out = [words[s:s + _SEGMENT + window - 1] for s in range(0, max(1, len(words) - window + 1), _SEGMENT)] if words else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(out), pa.string()), pa.array([b" ".join(w) for w in out], pa.binary()),
                     pa.array(list(map(len, out)), pa.int64())], names=["item", "words", "n"])

    return benchmark.select(F.col("item_id").cast("string").alias("item"), "text").mapInArrow(
        cut, "item string, words binary, n long").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, out: str, window: int = WINDOW,
                  part_words: int = PART_WORDS) -> DataFrame:
    """``docs`` with a column ``out``: struct(n_words, spans, items), spans as flat [first, end) word places."""
    spark = docs.sparkSession
    segments = saved(_segments(benchmark, window), "decontam-items")
    total = segments.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = max(1, -(-total // part_words))
    for part in range(parts):
        rows = segments.where(F.pmod(F.xxhash64("item", "words"), F.lit(parts)) == part).select("item", "words").collect()
        # about part_words words: the bound of what is collected and broadcast
        shared = _Shared(uuid4().hex, spark.sparkContext.broadcast([(r.item, bytes(r.words)) for r in rows]))
        docs = docs.withColumn(out, _search(shared, window, F.col(out) if part else None))
        if parts > 1:
            docs = saved(docs, "decontam-part")
    return docs


def _search(shared: _Shared, window: int, before: Column | None) -> Column:
    if before is None:
        @F.pandas_udf(FOUND)
        def find(texts: pd.Series) -> pd.DataFrame:
            tables = _tables(shared, window)
            return _frame(search_text(t, tables, [], set()) for t in texts)

        return find(F.col("text"))

    @F.pandas_udf(FOUND)
    def find_more(texts: pd.Series, found: pd.DataFrame) -> pd.DataFrame:
        tables = _tables(shared, window)
        return _frame(search_text(t, tables, list(s), set(i)) for t, s, i in zip(texts, found["spans"], found["items"]))

    return find_more(F.col("text"), before)


def _frame(found) -> pd.DataFrame:
    rows = [(n, spans, sorted(items)) for n, spans, items in found]
    return pd.DataFrame(rows, columns=["n_words", "spans", "items"])


def n_hit(found: Column) -> Column:
    """Words inside any occurrence: the ends less the starts of the merged spans."""
    sign = F.transform(found["spans"], lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    return F.aggregate(sign, F.lit(0).cast("long"), lambda a, x: a + x)


def contaminated(found: Column) -> Column:
    return (n_hit(found) > 0) & (20 * n_hit(found) >= found["n_words"])


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's row for each document."""
    found = contamination(docs.select("doc_id", "text"), benchmark, "found")
    f = F.col("found")
    return found.select("doc_id", f["n_words"].alias("n_words"), n_hit(f).alias("n_hit"),
                        F.size(f["items"]).cast("long").alias("n_items"),
                        F.sha2(F.array_join(f["items"], ","), 256).alias("items_sha256"),
                        contaminated(f).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, with their own columns."""
    out = free_name(docs, "_kiln_found")
    return contamination(docs, benchmark, out).where(~contaminated(F.col(out))).drop(out)
