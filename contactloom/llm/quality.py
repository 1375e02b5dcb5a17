"""Quality rules: fixed base rules, and cutoffs certified on labelled documents.

Half of the labelled documents, by a hash of the id, propose. For every measure a fixed row of
cutoffs, from lax to strict, is tested in each stratum (language and length band) on the good
documents that pass the base rules, and goes on while the exact binomial (Clopper-Pearson)
upper bound of the false rejections is at most ``risk``; of these the cutoff that separates the
labels best is proposed, the laxest of equals. A document goes if any cutoff rejects it, so
the other half certifies them together: proposals join one by one, the best first, as long as the
bound for all that have joined holds. The order is fixed before the half is looked at, so a
stratum errs at the level of one test; the level is divided by the number of strata. With
confidence ``1 - error`` no stratum loses more than ``risk`` of its good documents to all of its
cutoffs. Without enough labels nothing is certified and nothing rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from math import exp, lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contactloom.llm.store import written
from contactloom.llm.words import mix, slices, split_words, window_hashes

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
LANGUAGES = ("en", "de", "fr", "es")
LONG_WORDS = 200
# Measures and their cutoffs, lax to strict.
CUTOFFS = {
    "symbol_share": (0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.05, 0.02, 0.01),
    "capital_share": (0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1),
    "mark_share": (2.0, 1.5, 1.0, 0.8, 0.5, 0.3, 0.2, 0.1),
    "digit_share": (0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1),
    "repeated_line_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
          "n_capitals", "n_marks", "n_digits")


def per_text(hits: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of true bytes in each text."""
    sums = np.zeros(len(hits) + 1, np.int64)
    np.cumsum(hits, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def byte_set(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[np.frombuffer(chars, np.uint8)] = True
    return out


IS_SYMBOL, IS_MARK = byte_set(SYMBOLS), byte_set(b"!?")
IS_CAPITAL, IS_DIGIT = byte_set(bytes(range(65, 91))), byte_set(bytes(range(48, 58)))
# A byte that starts a code point and is not white space.
STARTS_WORD_CHAR = (np.arange(256) & 0xC0) != 0x80
STARTS_WORD_CHAR[[9, 10, 11, 12, 13, 32]] = False


def repeated_words(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Words of each text that lie in a 3-word window found twice or more in that text."""
    n = len(hashes)
    covered = np.zeros(n, bool)
    if n >= 3:
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        inside = text[:-2] == text[2:]
        at = np.flatnonzero(inside)
        keys = mix(window_hashes(hashes, 3)[at] + text[at].astype(np.uint64)
                   * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(keys)
        same = keys[order[1:]] == keys[order[:-1]]
        again = np.zeros(len(at), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        for step in range(3):
            covered[at[again] + step] = True
    return per_text(covered, first)


def repeated_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier one."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines), len(lines) - len(set(lines))


def measure(batches: Iterator[pa.RecordBatch], with_text: bool = False
            ) -> Iterator[pa.RecordBatch]:
    """The counts of each text beside the other columns."""
    for whole in batches:
        for batch in slices(whole, "text"):
            w = split_words(batch.column("text"))
            lines = [repeated_lines(w.text_of(i)) for i in range(batch.num_rows)]
            counts = {
                "n_words": np.diff(w.first),
                "word_chars": per_text(STARTS_WORD_CHAR[w.data], w.offsets),
                "n_symbols": per_text(IS_SYMBOL[w.data], w.offsets),
                "n_dup_lines": [x[1] for x in lines],
                "n_repeat_words": repeated_words(w.hashes, w.first),
                "n_lines": [x[0] for x in lines],
                "n_capitals": per_text(IS_CAPITAL[w.data], w.offsets),
                "n_marks": per_text(IS_MARK[w.data], w.offsets),
                "n_digits": per_text(IS_DIGIT[w.data], w.offsets)}
            yield pa.record_batch(
                {n: batch.column(n) for n in batch.schema.names if n != "text" or with_text}
                | {n: pa.array(v, pa.int64()) for n, v in counts.items()})


def at_most(k: int, n: int, p: float) -> float:
    """Probability of at most ``k`` hits in ``n`` trials of chance ``p``."""
    return sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
                   + i * log(p) + (n - i) * log(1 - p)) for i in range(k + 1))


def upper_bound_holds(k: int, n: int, risk: float, level: float) -> bool:
    """Whether the Clopper-Pearson upper bound of ``k`` in ``n`` at ``level`` is <= ``risk``.

    The bound is the chance at which at most ``k`` hits have probability ``level``.
    """
    return n > 0 and k <= n * risk and at_most(k, n, risk) <= level


def shares() -> dict[str, Column]:
    """Measures as columns; zero where the text has no words or lines."""
    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))

    return {"symbol_share": share("n_symbols", "word_chars"),
            "capital_share": share("n_capitals", "word_chars"),
            "mark_share": share("n_marks", "n_words"),
            "digit_share": share("n_digits", "word_chars"),
            "repeated_line_share": share("n_dup_lines", "n_lines")}


def stratum() -> Column:
    name = F.when(F.col("lang").isin(*LANGUAGES), F.col("lang")).otherwise(F.lit("other"))
    return F.concat_ws("/", name, F.when(F.col("n_words") >= LONG_WORDS, F.lit("long"))
                       .otherwise(F.lit("short")))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def choose(counts: dict, risk: float, level: float) -> dict[str, float]:
    """Proposed cutoff of each measure in one stratum, from its label counts, best first."""
    good, bad = counts["good"], counts["bad"]
    found = []
    for name, cutoffs in CUTOFFS.items():
        best, chosen = 0.0, None
        for i, cutoff in enumerate(cutoffs):
            wrong, right = counts[f"good_{name}_{i}"], counts[f"bad_{name}_{i}"]
            if not upper_bound_holds(wrong, good, risk, level):
                break
            gain = (right / bad if bad else 0.0) - wrong / good
            if gain > best:
                best, chosen = gain, cutoff
        if chosen is not None:
            found.append((-best, name, chosen))
    return {name: cutoff for _, name, cutoff in sorted(found)}


def rejected_by(chosen: dict[str, dict[str, float]], first: int | None = None) -> Column:
    """Whether one of the (``first``) cutoffs of its stratum rejects a document."""
    columns, out = shares(), F.lit(False)
    for where, cutoffs in sorted(chosen.items()):
        for name, cutoff in list(cutoffs.items())[:first]:
            out |= (F.col("stratum") == where) & (columns[name] > cutoff)
    return out


def certified_cutoffs(measured: DataFrame, labels: DataFrame, risk: float, error: float
                      ) -> dict[str, dict[str, float]]:
    """Cutoffs by stratum. Only label counts, at most ten rows twice, reach the driver."""
    strata = 2 * (len(LANGUAGES) + 1)
    known = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
             .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.min("quality").alias("quality")))
    labelled = (measured.where(~base_failed()).join(known, "doc_id")
                .withColumn("stratum", stratum())
                .withColumn("half", F.pmod(F.xxhash64("doc_id"), F.lit(2))))
    sums = []
    for kind, wanted in (("good", 1), ("bad", 0)):
        hit = F.col("quality") == wanted
        sums.append(F.count(F.when(hit, 1)).alias(kind))
        for name, column in shares().items():
            sums += [F.count(F.when(hit & (column > c), 1)).alias(f"{kind}_{name}_{i}")
                     for i, c in enumerate(CUTOFFS[name])]
    rows = labelled.where("half = 0").groupBy("stratum").agg(*sums).collect()
    proposed = {r["stratum"]: choose(r.asDict(), risk, error / (len(CUTOFFS) * strata))
                for r in rows}
    joint = [F.count(F.when(rejected_by(proposed, k), 1)).alias(f"first_{k}")
             for k in range(1, len(CUTOFFS) + 1)]
    rows = labelled.where("half = 1 AND quality = 1").groupBy("stratum").agg(
        F.count("*").alias("good"), *joint).collect()
    return {r["stratum"]: certified(proposed.get(r["stratum"], {}), r.asDict(), risk,
                                    error / strata) for r in rows}


def certified(proposed: dict[str, float], counts: dict, risk: float, level: float
              ) -> dict[str, float]:
    """The first proposals of a stratum that together keep the bound on the second half."""
    k = 0
    while k < len(proposed) and upper_bound_holds(counts[f"first_{k + 1}"], counts["good"], risk,
                                                  level):
        k += 1
    return dict(list(proposed.items())[:k])


def measured_rows(docs: DataFrame) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"),
                        F.col("lang").cast("string"))
    return written(texts.mapInArrow(
        measure, "doc_id long, lang string, " + ", ".join(f"{n} long" for n in COUNTS)),
        "measured")


def judged(measured: DataFrame, chosen: dict[str, dict[str, float]]) -> DataFrame:
    """``stratum``, ``base_failed`` and ``kept`` added to counts."""
    return (measured.withColumn("stratum", stratum())
            .withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & ~rejected_by(chosen)))


def quality(docs: DataFrame, labels: DataFrame, risk: float = 0.02, error: float = 0.05
            ) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` for each row of ``docs(doc_id, text, lang)``.

    ``labels(doc_id, quality)`` has 1 for good and 0 for bad; null labels are ignored and of
    several labels of one document the lowest counts. Null, empty and wordless texts have no
    words and fail the base rules. A null or unknown language is the stratum "other". Rows
    with equal or null doc_id are judged one by one. Extra columns are ignored.
    """
    measured = measured_rows(docs)
    chosen = certified_cutoffs(measured, labels, risk, error)
    return judged(measured, chosen).select("doc_id", *COUNTS, "stratum", "base_failed", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, risk: float = 0.02, error: float = 0.05
              ) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with all their columns.

    Texts are measured twice, once for the cutoffs and once for the verdicts, instead of
    joining verdicts to texts.
    """
    chosen = certified_cutoffs(measured_rows(docs), labels, risk, error)
    others = [c for c in docs.columns if c not in ("text", "lang")]
    inner = [f"c{i}" for i in range(len(others))]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(others, inner, strict=True)],
                       F.col("lang").cast("string"), F.col("text").cast("string"))
    result = T.StructType([*rows.schema.fields,
                           *(T.StructField(n, T.LongType()) for n in COUNTS)])
    kept = judged(rows.mapInArrow(partial(measure, with_text=True), result), chosen).where(
        "kept").select(*[F.col(n).alias(c) for c, n in zip(others, inner, strict=True)],
                       "lang", "text")
    return kept.select(*[f"`{c}`" for c in docs.columns])
