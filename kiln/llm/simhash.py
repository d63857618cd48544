"""SimHash near-duplicate detection with bit-sliced comparison.

1. ``fingerprints``: a 64-bit SimHash of each whole text, in Python over Arrow
   batches (words, shingles, XXH64, bit counts by numpy).
2. ``links``: distinct fingerprints only (copies fold in a partial aggregate).
   The 64 bits are cut into ``radius + 2`` blocks; two fingerprints within the
   radius agree in two blocks at least, so every pair of blocks is a bucket key.
   Inside the buckets, fingerprints are compared bit-sliced: bit planes are
   stored vertically (64 fingerprints to a word), a plane of a word and of the
   same word shifted by s lanes differ in the bits of 64 pairs at once, and
   carry-save counters add the planes up. Once all 64 distances of a block
   exceed the radius, the block is abandoned. A bucket of more than
   ``tile_rows`` fingerprints is cut into tiles, and every pair of tiles is
   compared, so a task never holds more than two tiles: nothing is capped.
   A task returns a spanning forest of its links, not all pairs.
3. ``components``: large-star / small-star rounds over the forest edges, each
   round a written table under the shared folder.

Null and empty texts have no words and the fingerprint 0, which links like any
other. Repeated rows give repeated result rows. A null id gets a row too; a
component's id is its smallest id that isn't null.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import byte_chunks, encoded, free_name, saved

SHINGLE = 3
RADIUS = 2
SEED = 42
TILE_ROWS = 8192
_BATCH_ROWS = 1 << 18
_WORK = 1 << 16  # (word, shift) blocks compared at a time


# ---------------------------------------------------------------- fingerprints
def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of one text: bit set if in over half the shingles' hashes."""
    ones, total, carry = np.zeros(64, dtype=np.int64), 0, []
    for part in byte_chunks(encoded(text).lower()):  # bytes.lower() lower-cases A-Z only
        words = carry + part.split()
        carry = words[max(0, len(words) - shingle + 1):] if shingle > 1 else []
        n = len(words) - shingle + 1
        if n > 0:
            parts = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
            total += n
            ones += _bit_counts(np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), dtype=np.uint64, count=n))
    if not total and carry:  # fewer words than a shingle
        total = 1
        ones = _bit_counts(np.array([xxhash.xxh64_intdigest(b" ".join(carry), SEED)], dtype=np.uint64))
    return sum(1 << b for b in range(64) if 2 * ones[b] > total)


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    out = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at:at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        out += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return out


def fingerprint_column(text: str = "text", shingle: int = SHINGLE) -> Column:
    """The fingerprint as a signed 64-bit integer."""

    @F.pandas_udf("long")
    def simhash(texts):
        out = np.fromiter((fingerprint(t, shingle) for t in texts), dtype=np.uint64, count=len(texts))
        return texts.__class__(out.view(np.int64))

    return simhash(F.col(text))


# ---------------------------------------------------------------- bit-sliced comparison
def _planes(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """Bit planes: row k holds bit bits[k] of 64 fingerprints a word, padded by one empty word."""
    lanes = -(-len(fps) // 64) * 64 + 64
    out = np.zeros((len(bits), lanes // 64), dtype=np.uint64)
    for k, b in enumerate(bits):
        plane = np.zeros(lanes, dtype=np.uint8)
        plane[:len(fps)] = (fps >> np.uint64(b)) & np.uint64(1)
        out[k] = np.packbits(plane, bitorder="little").view(np.uint64)
    return out


def _shifted(plane: np.ndarray, word: np.ndarray, by_word: np.ndarray, by_bit: np.ndarray) -> np.ndarray:
    """For each block, the 64 lanes of ``plane`` that begin ``by`` lanes after the block's own."""
    at = np.minimum(word + by_word, len(plane) - 1)
    low = plane[at] >> by_bit
    up = plane[np.minimum(at + 1, len(plane) - 1)]
    # a shift by 64 is undefined: shift in two steps
    return low | ((up << (np.uint64(63) - by_bit)) << np.uint64(1))


class _Forest:
    """Components of what was linked so far, as pointers to the smallest member."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            la, lb = self.label[a], self.label[b]
            apart = la != lb
            if not apart.any():
                return
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            np.minimum.at(self.label, np.maximum(la, lb), np.minimum(la, lb))
            while True:
                nearer = self.label[self.label]
                if np.array_equal(nearer, self.label):
                    break
                self.label = nearer


def linked(buckets: np.ndarray, fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Forest edges (i, j) among rows of the same bucket within ``radius`` bits; rows come sorted by bucket."""
    n = len(fps)
    none = np.zeros(0, dtype=np.int64)
    if n < 2:
        return none, none
    first = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]])
    end = np.repeat(np.r_[first[1:], n], np.diff(np.r_[first, n]))  # end of each row's bucket
    ahead = end - np.arange(n) - 1  # rows of the bucket after each row
    if not ahead.any():
        return none, none
    planes = _planes(fps, list(range(64)))
    lanes = np.zeros((planes.shape[1] - 1) * 64, dtype=np.int64)
    lanes[:n] = ahead
    lanes = lanes.reshape(-1, 64)
    reach = lanes.max(axis=1)
    forest = _Forest(n)
    words = np.flatnonzero(reach)
    todo = np.cumsum(reach[words])
    at = 0
    while at < len(words):  # blocks of a few words, all their shifts together
        to = max(at + 1, int(np.searchsorted(todo, (todo[at - 1] if at else 0) + _WORK)))
        own = words[at:to]
        for low in range(1, int(reach[own].max()) + 1, max(1, _WORK // len(own))):
            high = np.minimum(reach[own] + 1, low + max(1, _WORK // len(own)))
            count = np.maximum(high - low, 0)
            word = np.repeat(own, count)
            shift = low + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            forest.join(*_compare(planes, lanes, word, shift, radius))
        at = to
    child = np.flatnonzero(forest.label != np.arange(n))
    return forest.label[child], child


def _compare(planes: np.ndarray, lanes: np.ndarray, word: np.ndarray, shift: np.ndarray, radius: int):
    """Pairs (row, row + shift) within the radius, of all 64 lanes of each (word, shift) block."""
    width = max(2, (radius + 1).bit_length())  # counter bits
    by_word, by_bit = shift // 64, (shift % 64).astype(np.uint64)
    # a lane whose partner lies outside its bucket has exceeded the radius from the start
    out_of_reach = np.empty(len(word), dtype=np.uint64)
    for k in range(0, len(word), 1 << 14):
        over = lanes[word[k:k + (1 << 14)]] < shift[k:k + (1 << 14), None]
        out_of_reach[k:k + (1 << 14)] = np.packbits(over, axis=1, bitorder="little").view(np.uint64).ravel()
    exceeded = out_of_reach
    counter = [np.zeros(len(word), dtype=np.uint64) for _ in range(width)]
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    for k in range(64):
        plane = planes[k]
        carry = plane[word] ^ _shifted(plane, word, by_word, by_bit)
        for b in range(width):  # carry-save: add one bit to 64 counters
            counter[b], carry = counter[b] ^ carry, counter[b] & carry
        exceeded = exceeded | carry | _above(counter, radius)
        if k % 4 == 3:
            alive = exceeded != full
            if not alive.all():  # abandon blocks of which all distances exceed the radius
                word, shift, by_word, by_bit, exceeded = (x[alive] for x in (word, shift, by_word, by_bit, exceeded))
                counter = [x[alive] for x in counter]
                if not len(word):
                    break
    near = np.unpackbits((~exceeded).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    block, lane = np.nonzero(near)
    left = word[block] * 64 + lane
    return left, left + shift[block]


def _above(counter: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes of which the counter is more than ``radius``."""
    above, equal = np.zeros_like(counter[0]), ~np.zeros_like(counter[0])
    for b in range(len(counter) - 1, -1, -1):
        if radius >> b & 1:
            equal = equal & counter[b]
        else:
            above = above | (equal & counter[b])
            equal = equal & ~counter[b]
    return above


# ---------------------------------------------------------------- links between distinct fingerprints
def _bucket_keys(fp: Column, radius: int) -> Column:
    """Every pair of the ``radius + 2`` blocks of bits, as bucket keys."""
    n = radius + 2
    edges = [round(64 * i / n) for i in range(n + 1)]

    def block(i: int) -> Column:
        bits = edges[i + 1] - edges[i]
        return F.shiftrightunsigned(fp, edges[i]).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))

    return F.array(*(F.struct(F.lit(k).alias("band"), block(i).alias("b0"), block(j).alias("b1"))
                     for k, (i, j) in enumerate(combinations(range(n), 2))))


def links(distinct: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Forest edges ``(a, b)`` between the fingerprints ``fp`` (distinct, not null) at ``radius`` bits or fewer."""
    keys = ["band", "b0", "b1"]
    rows = distinct.select("fp", F.explode(_bucket_keys(F.col("fp"), radius)).alias("key")).select("fp", "key.*")
    hot = rows.groupBy(*keys).count().where(F.col("count") > tile_rows).select(
        *keys, F.ceil(F.col("count") / tile_rows).cast("int").alias("tiles"))
    # most buckets have one tile; a row of a larger one goes to each pair of tiles that its own tile is in
    tiled = rows.join(hot, keys, "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    pairs = F.expr("transform(sequence(0, tiles - 1), t -> struct(least(t, own) AS lo, greatest(t, own) AS hi))")
    spread = tiled.withColumn("own", own).select("fp", *keys, F.explode(pairs).alias("tile")).select(
        "fp", F.xxhash64(*keys, "tile.lo", "tile.hi").alias("bucket"))
    dealt = spread.repartition(F.col("bucket")).sortWithinPartitions("bucket")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_b, held_f = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def run(b, f):
            i, j = linked(b, f.view(np.uint64), radius)
            return pa.RecordBatch.from_arrays([pa.array(f[i]), pa.array(f[j])], names=["a", "b"])

        for batch in batches:
            held_b = np.r_[held_b, batch.column("bucket").to_numpy(zero_copy_only=False)]
            held_f = np.r_[held_f, batch.column("fp").to_numpy(zero_copy_only=False)]
            if len(held_b) >= _BATCH_ROWS:
                cut = int(np.searchsorted(held_b, held_b[-1]))  # the last bucket may go on
                if cut:
                    yield run(held_b[:cut], held_f[:cut])
                    held_b, held_f = held_b[cut:], held_f[cut:]
        if len(held_b):
            yield run(held_b, held_f)

    return dealt.mapInArrow(compare, "a long, b long").where("a != b")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for each node of the edges ``(a, b)``, by large-star and small-star rounds until nothing changes."""
    now = saved(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "simhash-edges")
    mark = None
    while True:
        new = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if new == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = new
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        now = saved(small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
                    .where("u != v").distinct(), "simhash-stars")


def near_duplicates(prints: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """``fp, root, component_id`` for the rows ``(doc_id, fp)``: the smallest doc_id of all that are reachable."""
    nodes = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-nodes")
    roots = components(links(nodes, radius, tile_rows))
    placed = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("rep").alias("component_id"))
    return placed.join(least, "root").select("fp", "root", "component_id")


def simhash_components(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``."""
    prints = saved(docs.select("doc_id", fingerprint_column("text", shingle).alias("fp")), "simhash-prints")
    comp = near_duplicates(prints, radius)
    return prints.join(comp, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one row left of each component: that of the smallest doc_id (of repeated rows, one).

    The rows are written once with their fingerprints and a number each, by
    which the kept one is named, whatever ids repeat and columns are there.
    """
    fp, at = free_name(docs, "_kiln_fp"), free_name(docs, "_kiln_at")
    held = saved(docs.withColumn(fp, fingerprint_column("text", shingle)).withColumn(at, F.monotonically_increasing_id()), "simhash-docs")
    rows = held.select("doc_id", F.col(fp).alias("fp"), F.col(at).alias("at"))
    comp = near_duplicates(rows.select("doc_id", "fp"), radius)
    best = rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("at"))).alias("best"))
    kept = best.join(comp, "fp").groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.at").alias(at))
    return held.join(kept, at, "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))
