"""How far the sources of a language differ in their terms: one-hot level products.

A language's terms are rows and its (group, count level) pairs are columns of an indicator
matrix ``X``: a one where the term has that level in that group. ``X`` transposed times ``X``
holds the joint tables of all pairs of groups: how many terms have level a in one group and level
b in the other. Levels are numbers of equal price, so a joint table and the prices of its levels
give the sum over all terms.

Only levels of a positive count are multiplied. What a pair of groups owes to terms that one or
both of them lack follows from the levels of each group alone, since with ``z`` for the level of
count zero::

    sum f(g, h) = V f(z, z) + sum over g > 0 of f(g, z) - f(z, z)
                + sum over h > 0 of f(z, h) - f(z, z)
                + sum over both > 0 of f(g, h) - f(g, z) - f(z, h) + f(z, z)

Blocks hold terms of like frequency, so rare terms, which are most, have few levels; the blocks
of a frequency are as many as the language has terms for. Inside a block the product is made tile by tile. All numbers are integers: products count terms of one
block, which single precision holds exactly, prices and sums are 64-bit.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contactloom.llm.store import written

SCALE, LEAST_DOCUMENTS, TOP = 1_000_000_000, 10, 10
# Terms of a block (at most, about), columns of a tile, distinct terms that a task holds before it hands
# them on.
BLOCK_TERMS, TILE, HELD_TERMS = 512, 1024, 200_000

# Bytes of terms, A-Z in small letters; all others become blanks.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term by language and source, summed as far as a task
    sees them; a row without term counts the documents of its group."""
    counts: dict[tuple[str, str], Counter] = defaultdict(Counter)
    docs: dict[tuple[str, str], Counter] = defaultdict(Counter)

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), found in docs.items():
            terms = list(found)
            yield pa.record_batch({
                "lang": pa.array([lang] * len(terms), pa.string()),
                "source": pa.array([source] * len(terms), pa.string()),
                "term": pa.array([t.decode() for t in terms], pa.string()),
                "n": pa.array([counts[lang, source][t] for t in terms], pa.int64()),
                "docs": pa.array(found.values(), pa.int64())})
        counts.clear()
        docs.clear()

    held = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(c).to_pylist()
                                        for c in ("lang", "source", "text")), strict=True):
            own = Counter(text.encode().translate(_BYTES).split())
            own[b""] = 1
            counts[lang, source].update(own)
            before = len(docs[lang, source])
            docs[lang, source].update(own.keys())
            held += len(docs[lang, source]) - before
            if held > HELD_TERMS:
                yield from rows()
                held = 0
    yield from rows()


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs`` over all ``docs(text, lang, source)``, nulls as empty
    strings. The row of each group with an empty term counts its documents."""
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                          for c in ("text", "lang", "source")])
    return (texts.mapInArrow(count_terms, "lang string, source string, term string, n long, "
                                          "docs long")
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"),
                                                   F.sum("docs").alias("docs")))


def share(count: str | Column, total: str | Column) -> Column:
    """``1 + floor(SCALE * (count + 2) / total)`` by long division in base 10^5 and 10^4, exact
    for totals up to 9e13."""
    d = total if isinstance(total, Column) else F.col(total)
    c = (count if isinstance(count, Column) else F.col(count)) + F.lit(2).cast("long")

    def over(x: Column) -> Column:
        return F.call_function("div", x, d)

    first = (c % d) * F.lit(100_000)
    second = (first % d) * F.lit(10_000)
    return over(c) * F.lit(SCALE) + over(first) * F.lit(10_000) + over(second) + F.lit(1)


def price(p: str | Column, q: str | Column) -> Column:
    p, q = (F.col(x) if isinstance(x, str) else x for x in (p, q))
    return F.call_function("div", (p - q) * (p - q), p + q)


def prices(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def block_product(block: pa.Table) -> pa.Table:
    """What the terms of a block add to each ordered pair of its groups, from the product of
    their indicator columns."""
    _, term = np.unique(block.column("term").to_numpy(zero_copy_only=False).astype(object),
                        return_inverse=True)
    names = block.column("source").combine_chunks().dictionary_encode()
    group = names.indices.to_numpy().astype(np.int64)
    p, zero = (block.column(c).to_numpy() for c in ("p", "zero"))
    order = np.lexsort((p, group))
    new = np.ones(len(order), bool)
    new[1:] = (group[order][1:] != group[order][:-1]) | (p[order][1:] != p[order][:-1])
    column = np.empty(len(order), np.int64)
    column[order] = np.cumsum(new) - 1
    first = order[new]
    of, level, none = group[first], p[first], zero[first]
    by_column = np.argsort(column, kind="stable")
    at = np.searchsorted(column[by_column], np.arange(0, len(first) + TILE, TILE))

    def tile(k: int) -> np.ndarray:
        cells = by_column[at[k]:at[k + 1]]
        x = np.zeros((term.max() + 1, min(TILE, len(first) - k * TILE)), np.float32)
        x[term[cells], column[cells] - k * TILE] = 1
        return x

    n_groups, n_tiles = len(names.dictionary), len(at) - 1
    sums = np.zeros((n_groups, n_groups), np.int64)
    for i in range(n_tiles):
        left = tile(i).T
        for j in range(i, n_tiles):
            joint = left @ (tile(j) if i != j else left.T)
            a, b = np.nonzero(joint)
            times = joint[a, b].astype(np.int64)
            a, b = a + i * TILE, b + j * TILE
            keep = of[a] < of[b]
            a, b, times = a[keep], b[keep], times[keep]
            both = (prices(level[a], level[b]) - prices(level[a], none[b])
                    - prices(none[a], level[b]) + prices(none[a], none[b]))
            np.add.at(sums, (of[a], of[b]), times * both)
    sums += sums.T
    a, b = np.nonzero(sums)
    lang = block.column("lang")[0].as_py()
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()),
                     "source": names.dictionary.take(pa.array(a)).cast(pa.string()),
                     "item": names.dictionary.take(pa.array(b)).cast(pa.string()),
                     "value": pa.array(sums[a, b])})


def pair_values(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for every ordered pair of groups of a language.

    ``cells(lang, source, term, lang_n, terms, p, zero)`` are the terms that groups hold;
    ``groups(lang, source, terms, zero)`` all groups with the number of kept terms.
    """
    like = F.floor(F.log2(F.col("lang_n").cast("double"))).cast("int")
    blocks = F.ceil(F.col("terms") / BLOCK_TERMS)
    dealt = cells.withColumn("size", like).withColumn(
        "block", F.pmod(F.xxhash64("term"), blocks))
    both = dealt.groupBy("lang", "size", "block").applyInArrow(
        block_product, "lang string, source string, item string, value long")

    levels = cells.groupBy("lang", "source", "p", "zero").agg(F.count("*").alias("n"))
    others = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("other"))
    lacking = (levels.join(others, "lang").where("source <> item")
               .groupBy("lang", "source", "item")
               .agg(F.sum(F.col("n") * (price("p", "other") - price("zero", "other")))
                    .alias("value")))
    reverse = lacking.select("lang", F.col("item").alias("source"),
                             F.col("source").alias("item"), "value")
    pairs = groups.join(others, "lang").where("source <> item").select(
        "lang", "source", "item", (F.col("terms") * price("zero", "other")).alias("value"))
    return (pairs.unionByName(lacking).unionByName(reverse).unionByName(both)
            .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))


def divergence(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS,
               top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank`` over ``docs(text, lang, source)``.

    A group is the documents of one language and source; a language keeps the terms that are in
    at least ``least_documents`` of its documents. A term's level in a group is
    ``1 + floor(10^9 * (n + 2) / (N + 2 V))`` for n of the group's N kept occurrences and V kept
    terms. Part ``pair`` sums ``f(p, q) = floor((p - q)^2 / (p + q))`` over all kept terms for
    each other group of the language; part ``term`` holds the ``top`` terms that a group has
    more of than its language, by the same f. Ranks go by value, then by item in byte order.

    Null text, lang and source count as empty strings, which are values like any other. Groups
    without kept terms have pairs with the levels of zero; a language that keeps no terms has
    pairs of value 0; a group alone in its language has none. Equal rows count each. Extra
    columns are ignored. No rows give none.
    """
    counted = written(term_counts(docs), "terms")
    found = counted.where("term <> ''")
    kept = (found.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"),
                                              F.sum("docs").alias("docs"))
            .where(F.col("docs") >= least_documents).drop("docs"))
    held = written(found.select("lang", "source", "term", "n").join(kept, ["lang", "term"]),
                   "held")
    vocabulary = (held.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n"))
                  .groupBy("lang").agg(F.count("*").alias("terms"),
                                       F.sum("lang_n").alias("lang_total")))
    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    size = F.col("total") + 2 * F.col("terms")
    lang_size = F.col("lang_total") + 2 * F.col("terms")
    groups = written(
        counted.where("term = ''").select("lang", "source")
        .join(totals, ["lang", "source"], "left").join(vocabulary, "lang", "left")
        .select("lang", "source", F.coalesce("terms", zero).alias("terms"),
                F.coalesce("total", zero).alias("total"),
                F.coalesce("lang_total", zero).alias("lang_total"))
        .withColumn("zero", F.when(F.col("terms") > 0, share(zero, size)).otherwise(1)), "groups")
    cells = written(
        held.join(groups.select("lang", "source", "terms", "total", "lang_total", "zero"),
                  ["lang", "source"])
        .select("lang", "source", "term", "lang_n", "terms", "zero", share("n", size).alias("p"),
                share("lang_n", lang_size).alias("q")), "cells")

    pairs = pair_values(cells, groups.select("lang", "source", "terms", "zero"))
    own = cells.where("p > q").select("lang", "source", F.col("term").alias("item"),
                                      price("p", "q").alias("value"))
    window = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = F.row_number().over(window)
    return (pairs.withColumn("rank", ranked).withColumn("part", F.lit("pair"))
            .unionByName(own.withColumn("rank", ranked).where(F.col("rank") <= top)
                         .withColumn("part", F.lit("term")))
            .select("lang", "source", "part", "item", "value", "rank"))
