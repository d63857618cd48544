"""Mixing sources to target weights by a min-cost flow.

1. ``sized``: the words of each document, written once under the shared folder
   with its membership pattern (the sorted sources it may serve) and a seeded
   hash of its id.
2. ``source_targets``: targets by weight, capped at ``max_repeats`` times a
   source's size, the excess reshared until none is above: a fixed point of
   "target = min(cap, level x weight)", each round one small aggregate.
3. ``route``: one row for each pattern (not for each document) is routed to
   the quotas by successive shortest paths; a pattern's first pass costs 0, its
   second 1, its third 3, so words are repeated only where fresh ones are used up.
   The flow splits into the connected parts of patterns and sources.
4. ``cuts``: a pattern's flow is whole passes over all its documents plus a
   remainder, taken by the first documents in a seeded order. Where the
   remainder ends is found by digits of ``BITS`` bits: a histogram of ``2**BITS``
   ranges for each pattern, then one of the range in which it ends, and so on
   until that range has no more than ``LAST_ROWS`` rows. Documents of earlier
   ranges go in; those of the last range go in while they fit, in order, past
   any that is too large, and then one is added or exchanged while that comes
   nearer. So a pattern that holds a third of all rows never meets in one task.
5. A document's ``taken`` depends on its pattern's row of the cut table and, in
   a last range, on its own row of the table of those chosen there.

Order: a seeded hash of the id (of the text, where the id is null), then a hash
of the text, then the row's place, so that neither null ids nor repeated rows
go in or out together. Rows equal in id and text are interchangeable, so reruns agree.

The driver gets one row for each distinct pattern, and the ranges of each. Null
texts have size 0; a null source is a source of its own; a null ``membership`` is
the document's own source; an empty one is in no quota. Very long texts are counted in place. An empty
table gives no rows. Extra columns of any name come back from ``take`` untouched.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kiln.llm.common import saved

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = "mix-1"
HASH_BITS = 60
PLACE_BITS = 66
BITS = 6
LAST_ROWS = 4096
BROADCAST_ROWS = 100_000
MOST_CHOSEN = 1_000_000  # numbers
WORD = r"[^\x20\x09-\x0D]+"


def size_column(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _bits60(text: Column) -> Column:
    """60 bits of the md5."""
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def seeded_hash(doc_id: str = "doc_id", text: str = "text", seed: str = SEED) -> Column:
    """60 bits of md5(seed:doc_id), or of the seed and the text's md5 where the id is null."""
    own = F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(F.col(text), F.lit("")))))
    return _bits60(F.concat(F.lit(f"{seed}:"), own))


def _sized_columns(membership: Column | None, seed: str) -> list[Column]:
    own = F.array("source")
    member = own if membership is None else F.coalesce(membership, own)
    return [member.alias("membership"), pattern_column(member).alias("pattern"), size_column().alias("size"),
            seeded_hash(seed=seed).alias("h"), _bits60(F.coalesce("text", F.lit(""))).alias("tie"),
            F.monotonically_increasing_id().alias("place")]


def sized(docs: DataFrame, membership: Column | None, seed: str) -> DataFrame:
    """``doc_id, source, membership, pattern, size, h, tie, place`` of each row, written once."""
    return saved(docs.select("doc_id", "source", *_sized_columns(membership, seed)), "mix-sizes")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``source, source_size, weight, target`` from the rows ``source, size``."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1  # one row for each source
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    totals = saved(totals.withColumn("weight", weight), "mix-sources")
    cap = F.col("source_size") * max_repeats
    level, closed = 0.0, -1
    while True:
        below = cap <= F.col("weight") * F.lit(level)
        if closed < 0:
            below = F.lit(False)
        now = totals.agg(F.sum("source_size"), F.sum(F.when(below, cap)), F.sum(F.when(~below, F.col("weight"))),
                         F.count(F.when(below, 1))).first()
        words, spent, open_weight, n = now[0] or 0, now[1] or 0, now[2] or 0, now[3]
        if n == closed or not open_weight:
            break
        closed, level = n, (words - spent) / open_weight
    return totals.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.lit(float(level))))


# ---------------------------------------------------------------- flow
def route(patterns: list[tuple[str, list[str | None], int]], quotas: dict[str | None, int],
          max_repeats: int = MAX_REPEATS) -> dict[tuple[str, str | None], int]:
    """Words that each pattern sends to each source: as much of the quotas as can be filled, at least cost."""
    flow: dict[tuple[str, str | None], int] = {}
    by_source = defaultdict(list)
    for p in patterns:
        for s in p[1]:
            by_source[s].append(p)
    seen: set[str] = set()
    for p in patterns:
        if p[0] in seen:
            continue
        part, todo, sources = [], [p], set()  # a connected part
        seen.add(p[0])
        while todo:
            q = todo.pop()
            part.append(q)
            for s in q[1]:
                if s not in sources:
                    sources.add(s)
                    for r in by_source[s]:
                        if r[0] not in seen:
                            seen.add(r[0])
                            todo.append(r)
        flow |= _cheapest(part, {s: quotas.get(s, 0) for s in sources}, max_repeats)
    return flow


def _cheapest(patterns, quotas, max_repeats):
    """Successive shortest paths with potentials; arcs: start -> pattern (one for each pass), pattern -> source, source -> end."""
    graph: dict = defaultdict(list)
    to, cap, cost = [], [], []

    def arc(a, b, c, w):
        for x, y, room, price in ((a, b, c, w), (b, a, 0, -w)):
            graph[x].append(len(to))
            to.append(y)
            cap.append(room)
            cost.append(price)

    routes = {}
    for key, sources, size in patterns:
        for k in range(max_repeats):
            arc("start", ("p", key), size, k * (k + 1) // 2)
        for s in sources:
            routes[key, s] = len(to)
            arc(("p", key), ("s", s), size * max_repeats, 0)
    for s, quota in quotas.items():
        arc(("s", s), "end", quota, 0)
    potential: dict = defaultdict(int)
    order = {"start": 0, "end": 1}
    while True:
        dist, via, heap = {"start": 0}, {}, [(0, 0, "start")]
        while heap:
            d, _, u = heapq.heappop(heap)
            if d > dist[u]:
                continue
            for e in graph[u]:
                v = to[e]
                if cap[e] > 0 and (new := d + cost[e] + potential[u] - potential[v]) < dist.get(v, math.inf):
                    dist[v], via[v] = new, e
                    heapq.heappush(heap, (new, order.setdefault(v, len(order)), v))
        if "end" not in dist:
            break
        for v, d in dist.items():
            potential[v] += min(d, dist["end"])
        for v in graph:
            if v not in dist:
                potential[v] += dist["end"]
        path, v = [], "end"
        while v != "start":
            path.append(via[v])
            v = to[via[v] ^ 1]
        room = min(cap[e] for e in path)
        for e in path:
            cap[e] -= room
            cap[e ^ 1] += room
    return {k: cap[e ^ 1] for k, e in routes.items()}


# ---------------------------------------------------------------- cuts
_KEYS = (("h", HASH_BITS), ("tie", HASH_BITS), ("place", PLACE_BITS))
#: For each digit of the order: the key it is part of, and how far it is shifted.
_DIGITS = [(key, bits - BITS * (k + 1)) for key, bits in _KEYS for k in range(bits // BITS)]
_CUT = "pattern string, passes long, h_from long, h_mask long, tie_from long, tie_mask long, place_from long, place_mask long"


def _digit(k: int) -> Column:
    key, shift = _DIGITS[k]
    return F.shiftright(key, shift).bitwiseAND((1 << BITS) - 1).cast("int")


def _masked(key: str) -> Column:
    return F.col(key).bitwiseAND(F.col(f"{key}_mask"))


def _in_range() -> Column:
    """The row is in the range in which its pattern's remainder ends."""
    return (_masked("h") == F.col("h_from")) & (_masked("tie") == F.col("tie_from")) & (_masked("place") == F.col("place_from"))


def _before_range() -> Column:
    out = F.lit(False)
    for key, _ in reversed(_KEYS):
        out = (_masked(key) < F.col(f"{key}_from")) | ((_masked(key) == F.col(f"{key}_from")) & out)
    return out


class _Cut:
    """Where a pattern's remainder ends, as far as it is known: the first digits of the order, and what is left for the range."""

    def __init__(self, passes: int, remainder: int):
        self.passes, self.left, self.digits = passes, remainder, []

    def row(self, pattern: str) -> tuple:
        out = [pattern, self.passes]
        for key, _ in _KEYS:
            start = mask = 0
            for (of, shift), digit in zip(_DIGITS, self.digits):
                if of == key:
                    start |= digit << shift
                    mask |= ((1 << BITS) - 1) << shift
            out += [start, mask & ((1 << 63) - 1)]
        return tuple(out)


def cuts(sizes: DataFrame, quotas: dict[str, tuple[int, int]], n_rows: dict[str, int]) -> tuple[DataFrame, DataFrame]:
    """``_CUT`` rows, one for each pattern, and ``place``, the rows of the last ranges that go in.

    sizes: ``pattern, size, h, tie, place``; quotas: ``(passes, remainder)`` of each pattern;
    n_rows: its rows.
    """
    spark = sizes.sparkSession
    found = {p: _Cut(*q) for p, q in quotas.items()}
    open_ = {p for p, c in found.items() if c.left and n_rows[p] > LAST_ROWS}
    rows = sizes.select("pattern", "size", "h", "tie", "place")

    def table(patterns) -> DataFrame:
        return _broadcast(spark.createDataFrame([found[p].row(p) for p in sorted(patterns)], _CUT), len(patterns))

    for k in range(len(_DIGITS)):
        if not open_:
            break
        held = rows.join(table(open_), "pattern").where(_in_range())
        ranges = defaultdict(list)
        for r in held.groupBy("pattern", _digit(k).alias("digit")).agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect():
            ranges[r.pattern].append((r.digit, r["size"], r.n))
        for p in sorted(open_):
            cut = found[p]
            for digit, size, n in sorted(ranges[p]):
                if size >= cut.left:  # the remainder is below the pattern's size, so it ends in a range
                    break
                cut.left -= size
            cut.digits.append(digit)
            if n <= LAST_ROWS:
                open_.discard(p)
        if open_:  # the next digit is looked for in these ranges only
            rows = saved(rows.join(table(open_), "pattern").where(_in_range()).select(*rows.columns), "mix-ranges")
    ends = [(p, c.left) for p, c in found.items() if c.left]
    cut = spark.createDataFrame([c.row(p) for p, c in sorted(found.items())], _CUT)
    left = _broadcast(spark.createDataFrame(ends, "pattern string, left long"), len(ends))
    last = (sizes.select("pattern", "size", "h", "tie", "place").join(left, "pattern")
            .join(_broadcast(cut, len(found)), "pattern").where(_in_range()))
    chosen = last.select("pattern", "size", "h", "tie", "place", "left").groupBy("pattern").applyInArrow(_fill, "place long")
    return cut, saved(chosen, "mix-chosen")


def _fill(rows: pa.Table) -> pa.Table:
    """Of the (at most ``LAST_ROWS``) rows of a last range, those that go in: in order while they fit, then whatever
    addition or exchange of one for one brings the sum nearer, until none does."""
    size, place = rows.column("size").to_numpy(), rows.column("place").to_numpy()
    left, out, rest = rows.column("left")[0].as_py(), [], []
    for i in np.lexsort([rows.column(k).to_numpy() for k in ("place", "tie", "h")]).tolist():
        if size[i] <= left:
            left -= int(size[i])
            out.append(i)
        else:
            rest.append(i)
    while left and rest:
        inside = np.r_[0, size[out]]  # 0: nothing is given for it
        order = np.argsort(inside, kind="stable")
        wanted = size[rest] - left
        at = np.searchsorted(inside[order], wanted).clip(0, len(order) - 1)
        steps = [(abs(left - int(size[j]) + int(inside[order[k]])), n, int(order[k]))
                 for n, j in enumerate(rest) for k in {int(at[n]), max(0, int(at[n]) - 1)}]
        off, n, give = min(steps)
        if off >= abs(left):
            break
        left += int(inside[give]) - int(size[rest[n]])
        come = rest.pop(n)
        if give:
            rest.append(out.pop(give - 1))
        out.append(come)
    return pa.table({"place": place[out]})


def _broadcast(df: DataFrame, n: int, most: int = BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(df) if n <= most else df


def plan(sizes: DataFrame, targets: DataFrame, max_repeats: int = MAX_REPEATS) -> tuple[DataFrame, DataFrame]:
    """``cuts`` for the rows ``pattern, membership, size, h, tie, place`` and the quotas ``source, target``."""
    groups = sizes.groupBy("pattern").agg(F.first("membership").alias("membership"), F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    patterns = sorted((r.pattern, list(r.membership), r["size"]) for r in groups)
    flow = route(patterns, {r.source: math.floor(r.target) for r in targets.collect()}, max_repeats)
    out = defaultdict(int)
    for (pattern, _), words in flow.items():
        out[pattern] += words
    return cuts(sizes, {p: divmod(out[p], size) if size else (0, 0) for p, _, size in patterns}, {r.pattern: r.n for r in groups})


def pattern_column(membership: Column) -> Column:
    return F.to_json(F.array_sort(F.array_distinct(membership)))


def mix(docs: DataFrame, membership: Column | None = None, weights: tuple[int, ...] = WEIGHTS,
        max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for each row of ``docs``.

    membership: the array of sources a document may serve (its ``source`` alone if not given).
    """
    sizes = sized(docs, membership, seed)
    targets = source_targets(sizes, weights, max_repeats)
    t = _small(targets.select(F.col("source").alias("of"), "source_size", "target"), "mix-targets")
    return _with_times(sizes, *plan(sizes, targets, max_repeats)).join(t, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def _with_times(sizes: DataFrame, cut: DataFrame, chosen: DataFrame) -> DataFrame:
    """``times``: how often each row is taken."""
    extra = _broadcast(chosen.select(F.col("place").alias("chosen")), chosen.count(), MOST_CHOSEN)
    rows = sizes.join(_small(cut, "mix-cuts"), "pattern").join(extra, F.col("place") == F.col("chosen"), "left")
    return rows.withColumn("times", F.col("passes") + (_before_range() | F.col("chosen").isNotNull()).cast("long"))


def _small(df: DataFrame, name: str) -> DataFrame:
    """Written once; broadcast if it has no more than ``BROADCAST_ROWS`` rows, else joined as Spark sees fit."""
    df = saved(df, name)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def take(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = SEED,
         membership: Column | None = None) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken (0 to ``max_repeats`` times), with its own columns.

    membership: as in ``mix``. Rows without words are in no quota; they go with their hash like the others.
    """
    # whole rows as one column, so that names do not clash; the choice joins small tables to them and moves no text
    held = saved(docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *_sized_columns(membership, seed)), "mix-docs")
    sizes = held.select("row.doc_id", "row.source", "membership", "pattern", "size", "h", "tie", "place")
    rows = _with_times(held, *plan(sizes, source_targets(sizes, weights, max_repeats), max_repeats))
    copies = F.when(F.col("times") > 0, F.sequence(F.lit(1).cast("long"), F.col("times"))).otherwise(F.array().cast("array<bigint>"))
    return rows.select("row", F.explode(copies)).select("row.*")
