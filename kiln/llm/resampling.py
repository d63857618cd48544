"""Importance resampling of documents toward a target distribution.

1. ``bucket_counts``: features (runs of one to ``max_words`` consecutive words)
   of all documents, and of all target texts, counted in ``BUCKETS`` hash
   buckets: an array for each task, summed by Spark, so that what meets in
   the end is one row for each bucket, whatever the tables hold.
2. ``gains``: a bucket's gain is the scaled logarithm of its smoothed share in
   the target over that in the documents, rounded down. A document's weight
   is the mean gain of its features, rounded down.
3. ``score``: the weight plus a Gumbel draw seeded by the document's id. The
   highest scores are a sample without replacement in proportion to exp(weight).
4. ``cutoff``: the exact key of the last document drawn, by weighted
   median-of-medians selection. Each block of a partition (``BLOCK_ROWS`` rows)
   gives the median of its remaining keys; the median of these, weighted by
   remaining sizes, has at least a quarter of the remaining keys on either
   side, so each round discards that much. One job a round counts the keys
   around the pivot and finds the medians on both sides; the driver gets one row
   a block. When three quarters are gone, what remains is written anew, so
   all rounds together read a fixed multiple of the keys.
5. ``winners``: the rows up to the cutoff, and only those, are sorted; ranks are
   running sums of partition sizes.

Bigrams' hashes come from the words': crc32 is linear, so the crc32 of
``a b`` is that of ``a`` moved by the bytes of `` b``, xor that of `` b``; moving is
a table for each word length. Words of ``LONG_WORD`` bytes or more are hashed as they are.

Keys are ``score`` descending, ``doc_id`` ascending (null last), a hash of the text
and the row's place in the scored table, so exactly the asked number is drawn
among equal ids or repeated rows too. Null, empty and wordless texts have no
features, weight 0 and are not drawn; a null id draws as the empty id does. Texts
are taken in chunks, so very long ones need memory for their words' hashes
only. No documents: no rows; no target texts: gains from the documents alone. Of the tables,
``doc_id`` and ``text`` are read only; columns of other names do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import alnum_words, saved

BUCKETS = 10_000
MAX_WORDS = 2
MIN_WORDS = 20
PERCENT = 25
SEED = "7"
SCALE = 1000
LONG_WORD = 48
BLOCK_ROWS = 1 << 20
_BLOCK_WORDS = 200_000
_POLYNOMIAL = 0xEDB88320  # fixed value of crc32
_KEY = ["down", "id", "tie", "at"]
_LAST = (1 << 63) - 1

Key = tuple[int, ...]


# ---------------------------------------------------------------- hashes of word runs
def _move_tables() -> np.ndarray:
    """What moving a crc32 over 0, 1, ... bytes makes of each of its four bytes: values at (bytes, place, byte), flat."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, step >> 1 ^ np.uint32(_POLYNOMIAL), step >> 1).astype(np.uint32)
    now = np.arange(256, dtype=np.uint32)[None, :] << np.array([0, 8, 16, 24], np.uint32)[:, None]
    out = [now]
    for _ in range(LONG_WORD - 1):
        now = now >> 8 ^ step[now & 255]
        out.append(now)
    return np.array(out).reshape(-1)


_MOVES = _move_tables()


def _moved(crc: np.ndarray, sizes: np.ndarray | int) -> np.ndarray:
    """crc32 values moved over ``sizes`` bytes."""
    at = np.asarray(sizes) * 1024
    out = _MOVES[at + (crc & 255)]
    for place in (1, 2, 3):
        out ^= _MOVES[at + (place * 256 + (crc >> 8 * place & 255))]
    return out


def run_hashes(words: list[bytes], max_words: int) -> Iterator[np.ndarray]:
    """crc32 of all runs of 1, 2, ... ``max_words`` consecutive words, joined by one space."""
    n = len(words)
    one = run = np.fromiter(map(crc32, words), np.uint32, n)
    sizes = np.fromiter(map(len, words), np.int64, n)
    long = np.flatnonzero(sizes >= LONG_WORD)
    sizes[long] = 0
    space = np.uint32(crc32(b" "))
    for k in range(1, max_words + 1):
        if k > 1:
            run = _moved(_moved(run[:-1], 1) ^ space, sizes[k - 1:]) ^ one[k - 1:]
            for last in long[long >= k - 1].tolist():
                run[last - k + 1] = crc32(b" ".join(words[last - k + 1:last + 1]))
        yield run


def _features(texts: list[str | None], max_words: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """``(text, hash, is a word)`` of all runs in ``texts``, as arrays, in blocks of words."""
    words: list[bytes] = []
    owners, fresh = [], 0

    def block():
        owner = np.concatenate(owners)
        for k, run in enumerate(run_hashes(words, max_words)):
            first = max(0, fresh - k)  # runs that end before ``fresh`` have been given
            inside = owner[first:len(owner) - k] == owner[first + k:]
            yield owner[first:len(owner) - k][inside], run[first:][inside], k == 0

    for text, value in enumerate(texts):
        for part in alnum_words(value):
            words += part
            owners.append(np.full(len(part), text))
            if len(words) >= _BLOCK_WORDS:
                yield from block()
                fresh = min(max_words - 1, len(words))
                words = words[len(words) - fresh:]
                owners = [np.concatenate(owners)[-fresh:] if fresh else np.empty(0, np.int64)]
    if len(words) > fresh:
        yield from block()


# ---------------------------------------------------------------- weights
def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, max_words: int = MAX_WORDS) -> np.ndarray:
    """Features of the whole table in each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, hashes, _ in _features(batch.column("text").to_pylist(), max_words):
                found += np.bincount(hashes % buckets, minlength=buckets)
        used = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(found[used])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    counted = docs.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in counted.collect():
        out[r.bucket] = r.n
    return out


def gains(of_docs: np.ndarray, of_target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Each bucket's gain: its smoothed share in the target over that in the documents, as a scaled logarithm."""
    n_docs, n_target, buckets = float(of_docs.sum()), float(of_target.sum()), len(of_docs)
    return np.array([math.floor(scale * math.log((t + 1.0) * (n_docs + buckets) / ((s + 1.0) * (n_target + buckets))))
                     for s, t in zip(of_docs.tolist(), of_target.tolist())], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, max_words: int = MAX_WORDS) -> DataFrame:
    """``doc_id, at, tie, n_words, n_features, weight`` of the rows ``doc_id, at, text``."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            total, n, n_words = (np.zeros(len(texts), np.int64) for _ in range(3))
            for text, hashes, is_word in _features(texts, max_words):
                counts = np.bincount(text, minlength=len(texts))
                n += counts
                n_words += counts * is_word
                # whole numbers far below 2^53
                total += np.bincount(text, gain[hashes % len(gain)], len(texts)).astype(np.int64)
            weight = np.floor_divide(total, np.maximum(n, 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("at"), batch.column("tie"), pa.array(n_words), pa.array(n), pa.array(weight)],
                ["doc_id", "at", "tie", "n_words", "n_features", "weight"])

    rows = docs.select("doc_id", "at", F.coalesce(F.xxhash64("text"), F.lit(0)).alias("tie"), "text")
    return rows.mapInArrow(weigh, "doc_id long, at long, tie long, n_words long, n_features long, weight long")


def draw(doc_id: Column, seed: str = SEED, scale: int = SCALE) -> Column:
    """The scaled, rounded down Gumbel draw of an id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(scale)) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("long")


# ---------------------------------------------------------------- selection
def _less(keys: np.ndarray, pivot: Key) -> tuple[np.ndarray, np.ndarray]:
    """Which columns of ``keys`` are below the pivot, and which equal it."""
    below, equal = np.zeros(keys.shape[1], bool), np.ones(keys.shape[1], bool)
    for row, p in zip(keys, pivot):
        below |= equal & (row < p)
        equal &= row == p
    return below, equal


def _median(keys: np.ndarray) -> list[int]:
    """The middle key (the lower one of two)."""
    if not keys.shape[1]:
        return [0] * len(keys)
    return keys[:, np.lexsort(keys[::-1])[(keys.shape[1] - 1) // 2]].tolist()


def weighted_median(medians: list[tuple[Key, int]]) -> Key:
    """The least key at which half of the weight is reached."""
    medians = sorted(medians)
    half, upto = sum(n for _, n in medians) / 2, 0
    for key, n in medians:
        upto += n
        if upto >= half:
            return key
    raise ValueError("no medians")


def _between(low: Key | None, high: Key | None) -> Column:
    key = F.struct(*_KEY)
    out = F.lit(True)
    for bound, first in ((low, True), (high, False)):
        if bound is not None:
            value = F.struct(*(F.lit(v).cast("long").alias(c) for c, v in zip(_KEY, bound)))
            # the first column's bound by itself reaches the scan
            out = out & (key > value if first else key < value) & (
                F.col(_KEY[0]) >= bound[0] if first else F.col(_KEY[0]) <= bound[0])
    return out


def _around(keys: DataFrame, pivot: Key | None, block_rows: int) -> list:
    """For each block: how many keys are below, at and above the pivot, and the medians below and above."""
    width = len(_KEY)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, block_rows):
            if pivot is None:
                below = equal = np.zeros(block.shape[1], bool)
            else:
                below, equal = _less(block, pivot)
            under, over = block[:, below], block[:, ~below & ~equal]
            row = [under.shape[1], int(equal.sum()), over.shape[1], _median(under), _median(over)]
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row[:3]] + [pa.array([v], pa.list_(pa.int64())) for v in row[3:]],
                                             ["below", "equal", "above", "median_below", "median_above"])

    def _blocks(batches, rows):
        held, n = [], 0
        for batch in batches:
            held.append(np.array([batch.column(k).to_numpy(zero_copy_only=False) for k in range(width)]))
            n += batch.num_rows
            if n >= rows:
                yield np.concatenate(held, axis=1)
                held, n = [], 0
        if n:
            yield np.concatenate(held, axis=1)

    return keys.select(*_KEY).mapInArrow(
        count, "below long, equal long, above long, median_below array<long>, median_above array<long>").collect()


def cutoff(keys: DataFrame, k: int, block_rows: int = BLOCK_ROWS) -> Key | None:
    """The ``k``-th least of the keys (columns ``_KEY``, none null); None if ``k`` is 0 or there are fewer."""
    low = high = None
    seen = _around(keys, None, block_rows)
    written = left = sum(r.above for r in seen)
    if not 0 < k <= left:
        return None
    pivot = weighted_median([(tuple(r.median_above), r.above) for r in seen if r.above])
    while True:
        seen = _around(keys.where(_between(low, high)), pivot, block_rows)
        below, equal = sum(r.below for r in seen), sum(r.equal for r in seen)
        if below < k <= below + equal:
            return pivot
        if k <= below:
            high, left = pivot, below
            pivot = weighted_median([(tuple(r.median_below), r.below) for r in seen if r.below])
        else:
            low, k, left = pivot, k - below - equal, left - below - equal
            pivot = weighted_median([(tuple(r.median_above), r.above) for r in seen if r.above])
        if 4 * left <= written:
            keys, written = saved(keys.where(_between(low, high)), "resampling-keys"), left


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``rank``, their place (from 1) in the order of ``_KEY``."""
    tagged = saved(rows.repartitionByRange(*_KEY).sortWithinPartitions(*_KEY)
                   .withColumn("place", F.monotonically_increasing_id()), "resampling-winners")
    part = F.shiftright("place", 33)
    counts = sorted((r.part, r.n) for r in tagged.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before, at = [], 0
    for p, n in counts:  # a row for each partition
        before.append((p, at))
        at += n
    starts = F.broadcast(rows.sparkSession.createDataFrame(before, "part long, before long"))
    return (tagged.join(starts, part == F.col("part"))
            .withColumn("rank", F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1).drop("place", "part", "before"))


# ---------------------------------------------------------------- operator
def _scored(docs: DataFrame, target: DataFrame, buckets: int, max_words: int, seed: str) -> DataFrame:
    gain = gains(bucket_counts(docs, buckets, max_words), bucket_counts(target, buckets, max_words))
    rows = weighted(docs, gain, max_words).withColumn("score", F.col("weight") + draw(F.col("doc_id"), seed))
    return saved(rows.withColumn("down", -F.col("score")).withColumn("id", F.coalesce("doc_id", F.lit(_LAST))), "resampling-scores")


def _drawn(scored: DataFrame, percent: int, min_words: int, block_rows: int) -> tuple[DataFrame, Column]:
    """The winners with their ranks, and the condition that a scored row is one."""
    able = F.col("n_words") >= min_words
    keys = scored.where(able)
    last = cutoff(keys, percent * keys.count() // 100, block_rows)
    if last is None:
        won = F.lit(False)
    else:
        won = able & ~_between(last, None)
    return ranked(scored.where(won)), won


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, buckets: int = BUCKETS,
             max_words: int = MAX_WORDS, seed: str = SEED, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of each row of ``docs`` (``rank`` null if it isn't drawn)."""
    rows = docs.select("doc_id", "text").withColumn("at", F.monotonically_increasing_id())
    scored = _scored(rows, target, buckets, max_words, seed)
    winners, won = _drawn(scored, percent, min_words, block_rows)
    out = ["doc_id", "n_features", "weight", "score"]
    return winners.select(*out, "rank").unionByName(scored.where(~won).select(*out, F.lit(None).cast("long").alias("rank")))


def sample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, buckets: int = BUCKETS,
           max_words: int = MAX_WORDS, seed: str = SEED, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The rows of ``docs`` that are drawn, with their own columns."""
    tag = "_kiln_at"
    while tag.lower() in {c.lower() for c in docs.columns}:
        tag += "_"
    held = saved(docs.withColumn(tag, F.monotonically_increasing_id()), "resampling-docs")
    scored = _scored(held.select("doc_id", "text", F.col(tag).alias("at")), target, buckets, max_words, seed)
    winners, _ = _drawn(scored, percent, min_words, block_rows)
    return held.join(winners.select(F.col("at").alias(tag)), tag, "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))
