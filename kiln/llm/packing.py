"""Best-fit packing of documents into token sequences of one length, by local search.

1. ``pieces``: every document's ids, with the end id; documents longer than a
   sequence are cut into whole sequences, of which the first may be shorter.
   One narrow pass; the pieces are written once.
2. ``place``: pieces that fill a sequence are placed alone. The others are
   dealt evenly over tasks, in the order of their place in the pieces table,
   and packed in groups of ``GROUP_ITEMS``, so that a task's memory does not
   grow with the table. Within a group:

   * best fit, longest first;
   * then the sequence that holds least is emptied: a document, or a pair of
     documents, moves to another underfull sequence, or is exchanged for a
     shorter document or pair there: where that fills the other one up, or
     else where it takes most tokens away. Each step raises the sum of squared
     fills. A sequence that can't be emptied stays, better packed than before,
     and the next one is tried, until a whole round empties none or the
     group's lower bound is reached;
   * if the bound is not reached, both steps once more from best fit in the
     order they come, which leaves other rooms; the better result stays.

3. ``sequences``: the packed sequences themselves, with the ids.

Groups are of random composition, so each comes near its own lower bound and
the whole misses the table's bound by less than one sequence for each group.

Null and empty texts hold the end id alone and are packed like others; null
ids and repeated rows are packed each. Very long texts are encoded in slices.
Ties (equal lengths) go in the order of the pieces table. An empty table gives
no rows. Only ``doc_id`` and ``text`` are read; columns of other names do not matter.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import saved
from kiln.llm.tokens import VOCABULARY, encoder

END_ID = 0
LENGTH = 2048
GROUP_ITEMS = 16_384
_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_ROWS = 1000


# ---------------------------------------------------------------- pieces
def cut(n: int, length: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of a document of ``n`` ids."""
    first = n if n <= length else n % length or length
    return [(0, first)] + [(at, length) for at in range(first, n, length)]


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, end_id: int = END_ID, length: int = LENGTH,
           with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece, and ``at``, its place in this written table.

    with_ids: also ``ids``, the piece's ids as little-endian unsigned 32-bit integers.
    """
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_ids
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(vocabulary), np.array([end_id], "<u4")
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part, rows = batch.slice(at, _ROWS), []
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), enc.encode(part.column("text").to_pylist())):
                    raw = np.concatenate([ids, end]).astype("<u4", copy=False)
                    for k, (start, n) in enumerate(cut(len(raw), length)):
                        own = raw[start:start + n].tobytes()
                        rows.append((doc_id, k, start, n, zlib.crc32(own), own)[:len(names)])
                    if len(rows) >= _ROWS:
                        yield _batch(rows, names, kinds)
                        rows = []
                yield _batch(rows, names, kinds)

    schema = _PIECE + (", ids binary" if with_ids else "")
    made = docs.select("doc_id", "text").mapInArrow(encode, schema)
    return saved(made.withColumn("at", F.monotonically_increasing_id()), "packing-pieces")


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


# ---------------------------------------------------------------- packing a group
def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that no packing can do without: for each k, items longer than capacity - k stand alone, those over half
    stand apart, and those from k to half fill what these leave."""
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    n_upto, sum_upto = np.cumsum(counts), np.cumsum(counts * np.arange(capacity + 1))
    half = capacity // 2
    k = np.arange(half + 1)
    over_half = n_upto[-1] - n_upto[half]
    apart_free = (n_upto[capacity - k] - n_upto[half]) * capacity - (sum_upto[capacity - k] - sum_upto[half])
    small = sum_upto[half] - np.r_[0, sum_upto[:half]]
    return int(over_half + np.maximum(0, -((apart_free - small) // capacity)).max())


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Items, as they come, each in the bin that it leaves least room in; ``free`` has a bit for each room that some bin has."""
    bins: list[list[int]] = []
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    free = 0
    for item, n in enumerate(lengths):
        fitting = free >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            k = with_room[room].pop()
            if not with_room[room]:
                free ^= 1 << room
        else:
            room, k = capacity, len(bins)
            bins.append([])
        bins[k].append(item)
        if room > n:
            with_room[room - n].append(k)
            free |= 1 << (room - n)
    return bins


class _Underfull:
    """The bins with room, by what could be taken out of them: nothing (0), a document's length or a pair's.

    ``reach[t]`` is the most that could go into such a bin in place of ``t``; ``rooms`` counts bins by ``t`` and room.
    """

    def __init__(self, capacity: int):
        self.holders: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
        self.reach = np.full(capacity + 1, -1)
        self.capacity = capacity
        self.rooms = np.zeros((capacity + 1) * (capacity + 1), np.uint16)
        self.amounts: dict[int, tuple[int, set[int]]] = {}

    def add(self, k: int, room: int, lengths: list[int]) -> None:
        found = {0, *lengths}
        found.update(a + b for a, b in combinations(_twice(lengths), 2))
        self.amounts[k] = room, found
        for t in found:
            insort(self.holders[t], (room, k))
            self.rooms[t * (self.capacity + 1) + room] += 1
            self.reach[t] = t + self.holders[t][-1][0]

    def remove(self, k: int) -> None:
        room, found = self.amounts.pop(k)
        for t in found:
            rest = self.holders[t]
            del rest[bisect_left(rest, (room, k))]
            self.rooms[t * (self.capacity + 1) + room] -= 1
            self.reach[t] = t + rest[-1][0] if rest else -1

    def place(self, n: int, most: int) -> tuple[bool, int, int] | None:
        """The least amount ``t < n`` in place of which ``n`` fits into a bin that then is fuller than the giver,
        whose room is ``most``: such a bin that it fills up, or else the fullest one."""
        exact = self.rooms[n:n * self.capacity + 1:self.capacity]  # of room n - t, for t from 0 to n - 1
        t = int((exact > 0).argmax())
        if exact[t]:
            return True, t, self.holders[t][bisect_left(self.holders[t], (n - t, -1))][1]
        for t in np.flatnonzero(self.reach[:n] >= n).tolist():
            room, k = self.holders[t][bisect_left(self.holders[t], (n - t, -1))]
            if room < most + n - t:
                return False, t, k
        return None


def _twice(lengths: list[int]) -> list[int]:
    """Each length at most twice, in order: enough to make all sums of two."""
    lengths = sorted(lengths)
    return [n for k, n in enumerate(lengths) if k < 2 or lengths[k - 2] != n]


def local_search(bins: list[list[int]], lengths: list[int], capacity: int, bound: int) -> list[list[int]]:
    """Empties bins by moves and exchanges that raise the sum of squared fills; see the module's text."""
    fill = [sum(lengths[i] for i in b) for b in bins]
    pool = _Underfull(capacity)

    def enter(k: int) -> None:
        if 0 < fill[k] < capacity:
            pool.add(k, capacity - fill[k], [lengths[i] for i in bins[k]])

    def take(k: int, amount: int) -> list[int]:
        """A document or a pair of that many tokens out of bin ``k``."""
        first: dict[int, int] = {}
        got: list[int] = []
        for i in bins[k] if amount else ():
            if lengths[i] == amount:
                got = [i]
                break
            if not got and (j := first.get(amount - lengths[i])) is not None:
                got = [j, i]
            first.setdefault(lengths[i], i)
        bins[k] = [i for i in bins[k] if i not in got]
        fill[k] -= amount if got else 0
        return got

    def best_step(k: int) -> tuple[int, int, int] | None:
        own = [lengths[i] for i in bins[k]]
        steps = []
        for amounts in (sorted(set(own)), sorted({a + b for a, b in combinations(_twice(own), 2)})):
            for n in amounts:
                if (found := pool.place(n, capacity - fill[k])) is not None:
                    exact, t, other = found
                    steps.append((exact, (n - t) * (fill[other] - fill[k] + n - t), n, t, other))
            if steps and (steps[-1][0] or max(steps)[0]):
                break
        return max(steps)[2:] if steps else None

    def emptied(k: int) -> bool:
        pool.remove(k)
        while bins[k] and (step := best_step(k)) is not None:
            n, t, other = step
            pool.remove(other)
            go, come = take(k, n), take(other, t)
            bins[k] += come
            bins[other] += go
            fill[k] += t
            fill[other] += n
            enter(other)
        enter(k)
        return not bins[k]

    for k in range(len(bins)):
        enter(k)
    left, progress = len(bins), True
    while progress and left > bound:
        progress = False
        for k in sorted(pool.amounts, key=lambda k: (fill[k], k)):
            if left > bound and k in pool.amounts and emptied(k):
                left, progress = left - 1, True
    return [b for b in bins if b]


def pack(lengths: np.ndarray, capacity: int = LENGTH) -> list[list[int]]:
    """Bins of item numbers for items of 1 to ``capacity`` tokens."""
    bound, best = lower_bound(lengths, capacity), None
    for order in (np.argsort(-lengths, kind="stable"), np.arange(len(lengths))):
        if best is None or len(best) > bound:
            items = lengths[order].tolist()
            found = local_search(best_fit(items, capacity), items, capacity, bound)
            if best is None or len(found) < len(best):
                best = [[int(order[i]) for i in b] for b in found]
    return best


# ---------------------------------------------------------------- Spark jobs
def place(found: DataFrame, length: int = LENGTH, group_items: int = GROUP_ITEMS) -> DataFrame:
    """The rows of ``pieces`` with ``sequence_id`` and ``offset``."""
    spark = found.sparkSession
    groups = max(1, math.ceil(found.where(F.col("length") < length).count() / group_items))
    tasks = min(groups, int(spark.conf.get("spark.sql.shuffle.partitions")))
    narrow = found.select("doc_id", "piece", "start", "length", "ids_crc32", "at")
    schema = _PIECE + ", at long, sequence_id long, offset long"

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_id = TaskContext.get().partitionId() << 40
        waiting, n = [], 0
        for batch in batches:
            waiting.append(batch)
            n += batch.num_rows
            if n >= 2 * group_items:  # the last group has one to two groups' rows
                table = pa.Table.from_batches(waiting)
                while table.num_rows >= 2 * group_items:
                    yield _packed(table.slice(0, group_items), length, next_id)
                    next_id += group_items
                    table = table.slice(group_items)
                waiting, n = table.to_batches(), table.num_rows
        if n:
            yield _packed(pa.Table.from_batches(waiting), length, next_id)

    # dealt evenly without a key; sorted, so that a task that runs again packs the same groups
    return narrow.repartition(tasks).sortWithinPartitions("at").mapInArrow(packed, schema)


def _packed(table: pa.Table, capacity: int, first_id: int) -> pa.RecordBatch:
    lengths = table.column("length").to_numpy()
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    whole = np.flatnonzero(lengths == capacity)
    sequence[whole] = first_id + np.arange(len(whole))
    rest = np.flatnonzero(lengths < capacity)
    for k, items in enumerate(pack(lengths[rest], capacity)):
        own = rest[items]
        sequence[own] = first_id + len(whole) + k
        offset[own] = np.cumsum(lengths[own]) - lengths[own]
    table = table.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))
    return table.combine_chunks().to_batches()[0]


def pack_documents(docs: DataFrame, vocabulary: str = VOCABULARY, end_id: int = END_ID, length: int = LENGTH) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece of ``docs``."""
    return place(pieces(docs, vocabulary, end_id, length), length).drop("at")


def sequences(docs: DataFrame, vocabulary: str = VOCABULARY, end_id: int = END_ID, length: int = LENGTH) -> DataFrame:
    """The packed sequences: ``sequence_id, n_tokens, ids`` (little-endian unsigned 32-bit) and ``pieces``, an array of
    ``offset, doc_id, piece, length`` in their order."""
    found = pieces(docs, vocabulary, end_id, length, with_ids=True)
    placed = saved(place(found, length), "packing-places").select("at", "sequence_id", "offset")
    held = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    # a sequence has no more than ``length`` pieces
    return found.join(placed, "at").groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), held.alias("held")).select(
        "sequence_id", "n_tokens",
        F.aggregate("held", F.lit(b""), lambda ids, p: F.concat(ids, p["ids"])).alias("ids"),
        F.transform("held", lambda p: p.dropFields("ids")).alias("pieces"))
