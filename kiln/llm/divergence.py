"""Source divergence audit: how the terms of each (language, source) group differ from the other sources' and the language's.

Strings are materialized late. Terms travel as fixed-width digests; their text
stays where it was found until it is known which terms are kept.

1. ``occurrences``: each task folds its documents' terms, block by block, into
   rows ``lang_id, grp, digest, n, df`` (all 64-bit numbers) and writes them. A block's
   distinct terms have their text beside them once, in a column that only step 3 reads.
2. ``candidates``: document frequencies summed by (language, digest). Terms that
   share a digest only add up, so no term to be kept is missed.
3. ``named``: the least and the greatest text of each candidate. The text column
   is joined with the candidates, broadcast in parts of ``PART_ROWS`` rows, so what is
   shuffled is the text of candidates alone. Where least and greatest differ, terms
   collide: the documents are read again for those digests, their terms get
   numbers of their own and are judged by their own document frequency.
4. ``kept_counts``: counts by (group, term) of kept terms; shares in exact
   integers (decimals where a product could pass 64 bits).
5. ``pairs``: sums of absolute differences between the sources of a language, over
   blocks of terms, each a table of at most ``MOST_CELLS`` terms by sources in one
   task that gives one sum for each two sources; so no term's pairs are listed.
6. ``top_terms``: ranks by value on digests alone; the text is joined back to what
   can be in the first ``top`` places, and ties are ordered by it.

Groups have 64-bit digests too, with a seed under which no two groups of the
table collide. The most frequent word, or a group with a third of all rows,
is folded in the tasks before any shuffle.

Null text, language and source count as ''. Texts without terms (empty ones
too) still make their group. Repeated rows and ids are documents each; very long
texts are one block. Ties are ordered by the item's UTF-8 bytes. An empty table gives no rows.
``text``, ``lang`` and ``source`` are read only; columns of other names do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kiln.llm.common import encoded, saved

MIN_DOCS = 30
TOP = 50
SCALE = 1_000_000_000
SMOOTH = 5
DIGEST_BITS = 64
BLOCK_BYTES = 8 << 20
PART_ROWS = 500_000
BLOCK_CELLS = 100_000
MOST_CELLS = 8_000_000

#: A-Z to a-z; every byte but a-z and 0x80-0xFF to a space.
LOWER_ALPHA = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_OCCURRENCE = "lang_id long, grp long, digest long, n long, df long, term string"
_TERM = ["lang_id", "digest", "sub"]


# ---------------------------------------------------------------- terms
def term_digest(term: bytes, bits: int = DIGEST_BITS) -> int:
    """The low ``bits`` of the term's XXH64, as a signed 64-bit number."""
    h = xxhash.xxh64_intdigest(term) & ((1 << bits) - 1)
    return h - (1 << 64) if h >> 63 else h


def groups(docs: DataFrame) -> DataFrame:
    """``seed, lang_id, grp, lang, source``: each occurring group, with digests under which none collide."""
    names = saved(docs.select(_or_empty("lang"), _or_empty("source")).distinct(), "divergence-groups")
    seed = 0
    while True:
        found = names.select(F.lit(seed).alias("seed"), *_ids(seed), "lang", "source")
        n, n_ids, n_langs, n_lang_ids = found.agg(
            F.count("*"), F.countDistinct("grp"), F.countDistinct("lang"), F.countDistinct("lang_id")).first()
        if n == n_ids and n_langs == n_lang_ids:
            return found
        seed += 1


def _or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")).alias(name)


def _ids(seed: int) -> tuple[Column, Column]:
    return F.xxhash64(F.lit(seed), "lang").alias("lang_id"), F.xxhash64(F.lit(seed), "lang", "source").alias("grp")


def occurrences(docs: DataFrame, seed: int, bits: int = DIGEST_BITS, all_texts: bool = False) -> DataFrame:
    """``lang_id, grp, digest, n, df, term``: a row for each term and group of a block of documents.

    term: the text, once for each language and term of a block (all_texts: in each row).
    """
    rows = docs.select(_or_empty("lang"), _or_empty("source"), F.col("text")).select(*_ids(seed), "text")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, grps, texts, size = [], [], [], 0
        for batch in batches:
            for lang, grp, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                langs.append(lang)
                grps.append(grp)
                texts.append(encoded(text))
                size += len(texts[-1])
                if size >= BLOCK_BYTES:
                    yield from _folded(langs, grps, texts, bits, all_texts)
                    langs, grps, texts, size = [], [], [], 0
        yield from _folded(langs, grps, texts, bits, all_texts)

    return rows.mapInArrow(fold, _OCCURRENCE)


def _terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The text that each term stands in, its code, and the distinct terms by code."""
    data = b" ".join(texts).translate(LOWER_ALPHA)
    inside = np.r_[False, np.frombuffer(data, np.uint8) != 32, False]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    terms = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.r_[0, np.cumsum(sizes)].astype(np.int64)),
                                             pa.py_buffer(data.replace(b" ", b"")))
    coded = terms.dictionary_encode()
    return np.searchsorted(ends, starts, "right"), np.asarray(coded.indices).astype(np.int64), coded.dictionary


def _folded(langs: list[int], grps: list[int], texts: list[bytes], bits: int, all_texts: bool) -> Iterator[pa.RecordBatch]:
    owner, code, terms = _terms(texts)
    if not len(code):
        return
    digests = np.fromiter((term_digest(t.encode(), bits) for t in terms.to_pylist()), np.int64, len(terms))
    names, grp_of = np.unique(np.array(grps, np.int64), return_inverse=True)
    lang_of = np.zeros(len(names), np.int64)
    lang_of[grp_of] = langs
    in_doc, n = np.unique(owner * len(terms) + code, return_counts=True)
    in_grp, at, df = np.unique(grp_of[in_doc // len(terms)] * len(terms) + in_doc % len(terms), return_inverse=True, return_counts=True)
    total = np.bincount(at, n, len(in_grp)).astype(np.int64)
    grp, term = in_grp // len(terms), in_grp % len(terms)
    silent = np.zeros(len(term), bool)
    if not all_texts:
        silent[:] = True
        silent[np.unique(np.unique(lang_of, return_inverse=True)[1][grp] * len(terms) + term, return_index=True)[1]] = False
    text = terms.take(pa.array(term, mask=silent)).cast(pa.string())
    yield pa.RecordBatch.from_arrays(
        [pa.array(lang_of[grp]), pa.array(names[grp]), pa.array(digests[term]), pa.array(total), pa.array(df.astype(np.int64)), text],
        ["lang_id", "grp", "digest", "n", "df", "term"])


# ---------------------------------------------------------------- kept terms
def candidates(found: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang_id, digest`` of the digests whose terms together are in at least ``min_docs`` documents of the language."""
    df = found.groupBy("lang_id", "digest").agg(F.sum("df").alias("df"))
    return saved(df.where(F.col("df") >= min_docs).select("lang_id", "digest"), "divergence-candidates")


def among(rows: DataFrame, wanted: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """The ``rows`` whose ``lang_id, digest`` are among the (distinct) ``wanted``, broadcast in parts of about ``part_rows``."""
    parts = max(1, math.ceil(wanted.count() / part_rows))
    out = None
    for k in range(parts):
        mine = F.pmod("digest", F.lit(parts)) == k if parts > 1 else F.lit(True)
        some = rows.where(mine).join(F.broadcast(wanted.where(mine)), ["lang_id", "digest"])
        out = some if out is None else out.unionByName(some)
    return out


def named(found: DataFrame, wanted: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """``lang_id, digest, least, greatest``: the texts of each wanted digest, first and last in order."""
    texts = among(found.where("term IS NOT NULL").select("lang_id", "digest", "term"), wanted, part_rows)
    return saved(texts.groupBy("lang_id", "digest").agg(F.min("term").alias("least"), F.max("term").alias("greatest")),
                 "divergence-named")


def kept_terms(docs: DataFrame, seed: int, min_docs: int = MIN_DOCS, bits: int = DIGEST_BITS,
               part_rows: int = PART_ROWS) -> tuple[DataFrame, DataFrame]:
    """The kept terms, ``lang_id, digest, sub, term``, and ``lang_id, grp, digest, sub, n, n_lang``: their occurrences in
    each group that has any, and in the language. ``sub`` tells terms of one digest apart."""
    found = saved(occurrences(docs, seed, bits), "divergence-occurrences")
    names = named(found, candidates(found, min_docs), part_rows)
    alone = names.where("least = greatest").select("lang_id", "digest", F.lit(0).alias("sub"), F.col("least").alias("term"))
    counts = among(found.select("lang_id", "grp", "digest", "n"), alone.select("lang_id", "digest"), part_rows)
    counts = counts.withColumn("sub", F.lit(0))
    kept = alone
    shared = names.where("least < greatest").select("lang_id", "digest")
    if not shared.isEmpty():
        again = saved(among(occurrences(docs, seed, bits, all_texts=True), shared, part_rows), "divergence-collisions")
        true_df = again.groupBy("lang_id", "digest", "term").agg(F.sum("df").alias("df")).where(F.col("df") >= min_docs)
        order = Window.partitionBy("lang_id", "digest").orderBy("term")  # the terms of one digest
        split = saved(true_df.select("lang_id", "digest", F.row_number().over(order).alias("sub"), "term"), "divergence-split")
        kept = kept.unionByName(split)
        counts = counts.unionByName(again.join(split, ["lang_id", "digest", "term"]).select("lang_id", "grp", "digest", "n", "sub"))
    total = counts.groupBy("lang_id", "grp", "digest", "sub").agg(F.sum("n").alias("n"))
    in_lang = F.sum("n").over(Window.partitionBy(*_TERM))  # a row for each source
    return kept, saved(total.withColumn("n_lang", in_lang), "divergence-counts")


# ---------------------------------------------------------------- shares
def share(n: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (n + SMOOTH) / (total + SMOOTH * terms)), exact; 0 where there are no terms."""
    return F.expr(f"""CASE WHEN {terms} = 0 THEN 0L ELSE 1L + CAST({SCALE} AS DECIMAL(10, 0)) * CAST({n} + {SMOOTH} AS DECIMAL(19, 0))
                      div CAST({total} + {SMOOTH} * {terms} AS DECIMAL(19, 0)) END""")


def statistics(of_groups: DataFrame, kept: DataFrame, counts: DataFrame) -> DataFrame:
    """The groups with ``n_grp, n_lang_all, terms, sources, p_none``: occurrences of kept terms in the group and the
    language, kept terms and sources of the language, and the share of a term the group does not have."""
    in_grp = counts.groupBy("lang_id", "grp").agg(F.sum("n").alias("n_grp"))
    stats = of_groups.select("lang_id", "grp", "lang", "source").join(in_grp, ["lang_id", "grp"], "left").fillna(0, ["n_grp"])
    langs = stats.groupBy("lang_id").agg(F.sum("n_grp").alias("n_lang_all"), F.count("*").alias("sources"))
    stats = stats.join(langs, "lang_id").join(kept.groupBy("lang_id").agg(F.count("*").alias("terms")), "lang_id", "left")
    return saved(stats.fillna(0, ["terms"]).withColumn("p_none", share("0", "n_grp", "terms")), "divergence-statistics")


def _small(df: DataFrame, part_rows: int) -> DataFrame:
    """Broadcast if it has no more than ``part_rows`` rows, else joined as Spark sees fit."""
    return F.broadcast(df) if df.count() <= part_rows else df


def pairs(stats: DataFrame, counts: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """``grp, other, value``: the summed differences of each group to each other source of its language."""
    # a block gives a row for each two sources: it has several terms for each source, if memory allows
    size = f"least(greatest({BLOCK_CELLS} div sources, 4 * sources), greatest({MOST_CELLS} div sources, 1))"
    blocks = F.expr(f"greatest(1L, CAST(ceil(terms / ({size})) AS BIGINT))")
    of_grp = stats.select("lang_id", "grp", "n_grp", "terms", "p_none", blocks.alias("blocks"))
    cells = counts.join(_small(of_grp.drop("p_none"), part_rows), ["lang_id", "grp"]).select(
        "lang_id", F.pmod(F.xxhash64("digest", "sub"), F.col("blocks")).alias("block"), "grp", "digest", "sub",
        share("n", "n_grp", "terms").alias("p"))
    none = of_grp.select("lang_id", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "grp",
                         F.lit(None).cast("long").alias("digest"), F.lit(0).alias("sub"), F.col("p_none").alias("p"))

    def differences(table: pa.Table) -> pa.Table:
        grp, digest, sub, p = (table.column(c).to_numpy() for c in ("grp", "digest", "sub", "p"))
        plain = table.column("digest").is_null().to_numpy()
        grps, order = np.unique(grp[plain], return_index=True)
        digest = table.column("digest").fill_null(0).to_numpy()[~plain]
        place = np.lexsort((sub[~plain], digest))
        new = np.r_[True, (np.diff(digest[place]) != 0) | (np.diff(sub[~plain][place]) != 0)][:len(place)]
        term = np.empty(len(place), np.int64)
        term[place] = np.cumsum(new) - 1
        shares = np.tile(p[plain][order], (int(new.sum()), 1))
        shares[term, np.searchsorted(grps, grp[~plain])] = p[~plain]
        n = len(grps)
        value = np.array([np.abs(shares - shares[:, k:k + 1]).sum(0) for k in range(n)], np.int64).reshape(n, n)
        one, other = np.nonzero(~np.eye(n, dtype=bool))
        return pa.table({"grp": grps[one], "other": grps[other], "value": value[one, other]})

    sums = cells.unionByName(none).groupBy("lang_id", "block").applyInArrow(differences, "grp long, other long, value long")
    return sums.groupBy("grp", "other").agg(F.sum("value").alias("value"))


def top_terms(stats: DataFrame, kept: DataFrame, counts: DataFrame, top: int = TOP, part_rows: int = PART_ROWS) -> DataFrame:
    """``grp, item, value, rank``: the terms by which each group most exceeds its language."""
    of_grp = stats.select("lang_id", "grp", "n_grp", "n_lang_all", "terms")
    over = counts.join(_small(of_grp, part_rows), ["lang_id", "grp"]).select(
        "grp", *_TERM, (share("n", "n_grp", "terms") - share("n_lang", "n_lang_all", "terms")).alias("value")).where("value > 0")
    by_value = Window.partitionBy("grp").orderBy(F.desc("value"))
    able = saved(over.withColumn("rank", F.rank().over(by_value)).where(F.col("rank") <= top).drop("rank"), "divergence-top")
    texts = kept.join(_small(able, part_rows), _TERM).select("grp", F.col("term").alias("item"), "value")
    order = Window.partitionBy("grp").orderBy(F.desc("value"), "item")
    return texts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, bits: int = DIGEST_BITS, part_rows: int = PART_ROWS) -> DataFrame:
    """``lang, source, part, item, value, rank``: each group's distance to the other sources of its language (``pair``),
    and the terms it has more of than the language (``term``, first ``top``)."""
    of_groups = saved(groups(docs), "divergence-group-ids")
    first = of_groups.first()
    kept, counts = kept_terms(docs, first.seed if first else 0, min_docs, bits, part_rows)
    stats = statistics(of_groups, kept, counts)
    name = stats.select("grp", "lang", "source")
    others = stats.select(F.col("grp").alias("other"), F.col("source").alias("item"))
    by_value = Window.partitionBy("grp").orderBy(F.desc("value"), "item")  # a row for each source
    both = pairs(stats, counts, part_rows).join(others, "other").select("grp", "item", "value").withColumn(
        "rank", F.row_number().over(by_value)).withColumn("part", F.lit("pair"))
    terms = top_terms(stats, kept, counts, top, part_rows).withColumn("part", F.lit("term"))
    return both.unionByName(terms).join(name, "grp").select("lang", "source", "part", "item", "value", "rank")
