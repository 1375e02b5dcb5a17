"""Keywords of a table inside texts, as plain substrings: an inverted q-gram index.

A text that contains a term contains all of the term's q-grams, so it is enough to look the term
up by the rarest of them. Texts offer their distinct q-grams once, as numbers; those that no term
has fall away in an equi-join, and what is left tells how many texts hold each gram; every term
then chooses its rarest gram, and a term with a gram that no text holds is settled. Texts and terms
meet on that gram and ``contains`` confirms. Terms shorter than q are grams of their own length.
Up to three characters fit into a number as they are, so there meeting is proof enough; longer
grams are hashed. No text meets a term without a common gram, and no plan node compares all texts
with all terms.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contactloom import rules
from contactloom.llm.words import window_hashes
from contactloom.operators.join import lookup
from contactloom.session import importable, materialise, spread

GRAM = 4
# As many code points, of 21 bits each, are a number of their own.
EXACT = 3


def grams(points: np.ndarray, size: int) -> np.ndarray:
    """Distinct numbers of the substrings of ``size`` code points; none of shorter texts."""
    if len(points) < size:
        return np.zeros(0, np.int64)
    if size > EXACT:
        found = window_hashes(points, size)
    else:
        found = points[:len(points) - size + 1].copy()
        for j in range(1, size):
            found <<= np.uint64(21)
            found |= points[j:len(points) - size + 1 + j]
    return np.unique(found).view(np.int64)


def gram_rows(size: int, whole: bool) -> Callable[
        [Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of (first column, size, gram) for the texts in the second column, of all sizes up to
    ``size`` or, if the text counts as a ``whole``, of its own length at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                rows, sizes, found = [], [], [np.zeros(0, np.int64)]
                for i, text in enumerate(part.column(1).to_pylist()):
                    points = np.frombuffer((text or "").encode("utf-32-le"), np.uint32).astype(
                        np.uint64)
                    for n in ([min(size, len(points))] if whole else range(1, size + 1)):
                        if n:
                            found.append(grams(points, n))
                            rows.append((i, len(found[-1])))
                            sizes.append((n, len(found[-1])))
                at, n = (np.repeat(*np.array(x, np.int64).reshape(-1, 2).T)
                         for x in (rows, sizes))
                yield pa.record_batch([part.column(0).take(pa.array(at)),
                                       pa.array(n.astype(np.int32)),
                                       pa.array(np.concatenate(found))],
                                      [part.schema.names[0], "_size", "_gram"])

    return run


def index(df: DataFrame, column: str, text: str, size: int, whole: bool = False) -> DataFrame:
    """``column, _size, _gram`` of a table."""
    schema = T.StructType([df.schema[column], T.StructField("_size", T.IntegerType()),
                           T.StructField("_gram", T.LongType())])
    return df.select(column, F.col(text).alias("_t")).mapInArrow(gram_rows(size, whole), schema)


def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First column and term for those of a text's candidates that it contains."""
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            part = batch.slice(start, 64)
            at, found = [], []
            for i, (text, terms) in enumerate(zip(part.column(1).to_pylist(),
                                                  part.column(2).to_pylist(), strict=True)):
                held = [t for t in terms if t in text]
                at += [i] * len(held)
                found += held
            yield pa.record_batch([part.column(0).take(pa.array(at, pa.int64())),
                                   pa.array(found, pa.string())],
                                  [part.schema.names[0], "term"])


def substring_hits(df: DataFrame, key: str, text: Column | str, terms: DataFrame,
                   term: str = "term", size: int = GRAM) -> DataFrame:
    """``key, term`` for each row of ``df`` and each distinct term that its text contains.

    ``key`` identifies a row and is not null. Comparison is exact: lower-case both sides for
    another meaning. Null texts contain nothing; null and empty terms are in no text. Repeated
    terms count once.
    """
    importable(df.sparkSession)
    gram = ["_size", "_gram"]
    text = F.col(text) if isinstance(text, str) else text
    texts = df.select(key, text.alias("_text"))
    known = terms.select(F.col(term).alias("term")).where("term <> ''").distinct()
    # Written, so that Spark knows its size and moves the grams of the texts only if it is large.
    parts = materialise(index(known, "term", "term", size, whole=True))
    held = materialise(index(spread(texts), key, "_text", size)
                       .join(parts.select(*gram).distinct(), gram).select(key, *gram))
    counts = held.groupBy(*gram).agg(F.count(F.lit(1)).alias("n"))
    rarest = (lookup(parts, counts, gram).groupBy("term", "_size")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "_gram")).alias("best"))
              .where("best.n > 0").select("term", "_size", F.col("best._gram").alias("_gram")))
    met = held.join(rarest, gram)
    proof = (F.length("term") == F.col("_size")) & (F.col("_size") <= EXACT)
    sure, likely = (met.where(which).select(key, "term") for which in (proof, ~proof))
    # One row for a text and its candidates: a text travels once, not once for each term.
    asked = texts.join(likely.groupBy(key).agg(F.collect_list("term").alias("_terms")), key)
    return sure.unionByName(asked.select(key, "_text", "_terms").mapInArrow(
        confirmed, T.StructType([df.schema[key], known.schema["term"]])))


def classify_by_substrings(df: DataFrame, key: str, text: Column | str, table: DataFrame,
                           default: str = rules.GENERAL, size: int = GRAM) -> DataFrame:
    """Category by plain substrings out of a keyword table (term, prio, niche), first prio wins.

    The counterpart of ``match.classify_by_table`` for keywords that may stand inside words, and
    of ``classify.classify`` for tables too large to travel inside the plan. Of equal prio the
    smallest niche wins; rows without a keyword get ``default``.
    """
    rule = table.groupBy("term").agg(F.min(F.struct("prio", "niche")).alias("rule"))
    hits = lookup(substring_hits(df, key, text, table, "term", size), rule, "term")
    best = hits.groupBy(key).agg(F.min("rule")["niche"].alias("niche"))
    return lookup(df, best, key).withColumn("niche", F.coalesce("niche", F.lit(default)))
