"""Host-level quality rules, with DataFrame functions only.

1. ``measures``: counts of each whole text, by array functions of its own row
   (no shuffle, no Python). The 8-word windows of a text are hashed (XXH64 of
   the words' XXH64); a text without two equal windows is done, any other sorts
   its windows to find the equal ones.
2. ``hosts``: failures of each rule, and of any rule, by host, one partial
   aggregate. A host's rate is shrunk by a beta prior whose mean and strength
   come from all hosts (moments: the spread of the rates beyond what chance
   gives; worth ``MIN_STRENGTH`` to ``MAX_STRENGTH`` documents), so a host of a few
   documents is judged mostly by the others, a large one by its own.
3. ``judged``: a host is distrusted if its rate of documents that fail any
   rule is above the prior's mean by more than ``TAIL`` standard deviations of
   its own beta posterior; failures that are spread over several rules add up.
   The verdict goes back to the documents: at a distrusted host a document must
   pass every rule; elsewhere only the base rules decide.

A third of all rows at one host costs nothing: the aggregate folds in the map
tasks, and the hosts are broadcast if they are few (checked), else joined, where
Spark splits a skewed key. Null texts have no words and fail the base rule; a
null source is a host of its own; repeated rows count each; a rate that equals
the bound is trusted. An empty table gives no rows. A very long text is
measured in its row's arrays. ``doc_id``, ``source`` and ``text`` are read only; columns
of other names do not matter. Window hashes are 64
bits: two different windows of one text count as equal once in 10^11 texts of
20,000 words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import saved

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
TAIL = 1.0
MIN_STRENGTH, MAX_STRENGTH = 5.0, 100.0
BROADCAST_ROWS = 100_000
BLANK = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]+"

#: Rules over the measures: true where a document fails.
RULES: dict[str, str] = {
    "short": f"n_words < {MIN_WORDS}",
    "repeats": f"100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "lines": "10 * n_dup_lines > 3 * n_lines",
    "letters": "word_chars > 20 * n_words OR (word_chars < 2 * n_words)",
}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _covered(starts: Column, width: int) -> Column:
    """Places in the union of [start, start + width), for ascending starts."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(
        starts, zero,
        lambda a, s: F.struct((s + width).alias("end"), (a["n"] + s + width - F.greatest(a["end"], s)).alias("n")),
        lambda a: a["n"])


def _repeat_words(hashes: Column, width: int = WINDOW) -> Column:
    """Words in windows that occur twice or more, from the words' hashes."""
    def repeated(windows: Column) -> Column:
        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(o: Column) -> Column:
            near = lambda k: F.get(o, k)["h"]  # noqa: E731  null beyond the ends
            own = F.transform(o, lambda x, k: F.when((x["h"] == near(k - 1)) | (x["h"] == near(k + 1)), x["i"]))
            return F.sort_array(F.filter(own, lambda i: i.isNotNull()))

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
            _covered(_let(ordered, starts), width))

    windows = F.transform(F.sequence(F.lit(1), F.size(hashes) - (width - 1)), lambda i: F.xxhash64(F.slice(hashes, i, width)))
    return F.when(F.size(hashes) <= width, F.lit(0)).otherwise(_let(windows, repeated))


def measures(docs: DataFrame) -> DataFrame:
    """``doc_id, source`` and the counts of each row of ``docs``."""
    text = F.coalesce("text", F.lit(""))
    hashes = F.transform(F.filter(F.split(text, BLANK), lambda w: w != ""), lambda w: F.xxhash64(w))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counts = _let(hashes, lambda h: F.struct(F.size(h).alias("n_words"), _repeat_words(h).alias("n_repeat_words")))
    by_line = _let(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    out = docs.select(
        "doc_id", "source", counts.alias("c"), by_line.alias("l"),
        F.length(F.regexp_replace(text, BLANK, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOL, ""))).cast("long").alias("n_symbols"))
    return out.select("doc_id", "source", "word_chars", "n_symbols",
                      *(F.col(c).cast("long").alias(c.split(".")[1]) for c in ("c.n_words", "c.n_repeat_words", "l.n_lines", "l.n_dup_lines")))


def base_failed() -> Column:
    return F.expr(f"({RULES['short']}) OR ({RULES['repeats']})")


def _any_rule() -> Column:
    return F.expr(" OR ".join(f"({r})" for r in RULES.values()))


def hosts(rows: DataFrame, tail: float = TAIL) -> DataFrame:
    """``source, n``, the failures and shrunk rate of each rule and of ``any``, the ``bound`` of the latter's posterior,
    the prior's ``expected`` rate and ``distrusted``, from the measures."""
    failed = {name: F.expr(rule) for name, rule in RULES.items()} | {"any": _any_rule()}
    totals = saved(rows.groupBy("source").agg(
        F.count("*").alias("n"), *(F.count(F.when(bad, 1)).alias(f"f_{r}") for r, bad in failed.items())), "hosts")
    n = F.col("n")
    # two rows of sums come to the driver: the mean of each rule, then the spread around it
    sums = totals.agg(F.sum("n").alias("n"), F.count("*").alias("k"), *(F.sum(f"f_{r}").alias(r) for r in failed)).first()
    mean = {r: sums[r] / sums["n"] if sums["n"] else 0.0 for r in failed}
    spread = totals.agg(*(F.sum(n * F.pow(F.col(f"f_{r}") / n - F.lit(mean[r]), 2)).alias(r) for r in failed)).first()
    a, b = {}, {}
    for r, m in mean.items():
        by_chance = m * (1 - m) * (sums["k"] - 1) / max(1, sums["n"] or 0)
        beyond = (spread[r] or 0.0) / max(1, sums["n"] or 0) - by_chance  # variance between the hosts
        strength = min(max(m * (1 - m) / beyond - 1, MIN_STRENGTH), MAX_STRENGTH) if beyond > 0 else MAX_STRENGTH
        a[r] = F.col(f"f_{r}") + F.lit(m * strength)
        b[r] = n - F.col(f"f_{r}") + F.lit((1 - m) * strength)
    both = a["any"] + b["any"]
    deviation = F.sqrt(a["any"] * b["any"] / (both * both * (both + 1)))
    return totals.select(
        "source", "n", *(f"f_{r}" for r in failed), *((a[r] / (a[r] + b[r])).alias(f"rate_{r}") for r in failed),
        (a["any"] / both - F.lit(tail) * deviation).alias("bound"), F.lit(mean["any"]).alias("expected")).withColumn(
        "distrusted", F.col("bound") > F.col("expected"))


def judged(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The measures with ``base_failed``, the host's ``rate_any`` and ``distrusted``, and ``kept``."""
    v = saved(verdicts.select(F.col("source").alias("host"), "rate_any", "distrusted"), "host-verdicts")
    v = F.broadcast(v) if v.count() <= BROADCAST_ROWS else v
    return (rows.join(v, F.col("source").eqNullSafe(F.col("host"))).withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & ~(F.col("distrusted") & _any_rule())))


def host_rules(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs``: the contract's columns."""
    rows = saved(measures(docs), "host-measures")
    return judged(rows, hosts(rows)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
