"""Benchmark passages in documents, by spaced seeds; DataFrame functions only.

Tokens are runs of letters and digits, lower-cased; in scripts without blanks each character is
a token. A document holds a passage of an item if
some window of 13 of its tokens equals a window of the item in all but at most two places.
Each of three masks keeps every third token of the window: two substitutions fall into two of
them at most, so one mask sees equal tokens. The masked tokens of every window are hashed, the
hashes of documents and items are joined, and at each hit the whole windows are compared token
by token. Items of 8 to 12 tokens are one window of their own length with proportionally fewer
substitutions and masks. Items under 8 tokens are found as a whole and without substitutions:
anywhere if they have enough characters, else where they fill a line.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW, SUBSTITUTIONS, SHORTEST = 13, 2, 8
# Item seeds are broadcast up to this many rows (about 100 MB); beyond it they are shuffled.
BROADCAST_SEEDS = 400_000
# Items under 8 tokens with so many characters are found inside lines, too; a character of a
# script without blanks counts as four.
SURE_CHARACTERS, WIDE_CHARACTER = 24, 4
NO_ID = -(2**63)

# Thai to Khmer, Han, Hiragana, Katakana: scripts without blanks.
UNSPACED = ("\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u2fdf\u3005-\u3007\u3021-\u3029"
            "\u3031-\u303c\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
            "\uff66-\uff9f" + r"\x{20000}-\x{3ffff}")
TOKEN = rf"[{UNSPACED}&&[\p{{L}}\p{{N}}]]|[\p{{L}}\p{{N}}&&[^{UNSPACED}]]+"


def tokens(text: str) -> Column:
    lowered = F.lower(F.coalesce(F.col(text).cast("string"), F.lit("")))
    words = F.array_remove(F.split(lowered, r"[^\p{L}\p{N}]+"), "")
    # Texts without any such character take the shorter way.
    return F.when(lowered.rlike(f"[{UNSPACED}]"),
                  F.regexp_extract_all(lowered, F.lit(TOKEN), F.lit(0))).otherwise(words)


def characters(text: str) -> Column:
    """Characters of the tokens, those of scripts without blanks counted as several."""
    return F.aggregate(tokens(text), F.lit(0), lambda n, w: n + F.when(
        w.rlike(f"[{UNSPACED}]"), F.lit(WIDE_CHARACTER)).otherwise(F.length(w)))


def token_hashes(text: str) -> Column:
    """Hashes of the tokens, to be computed once for a row.

    The condition always holds. It depends on the partition, so Spark does not compute the
    tokens again in the filters on them that it would move below this column.
    """
    once = F.when(F.spark_partition_id() >= 0, tokens(text))
    return F.transform(once, lambda w: F.xxhash64(w))


def allowed(width: int) -> int:
    """Substitutions allowed in a window; none in items under 8 tokens."""
    return 0 if width < SHORTEST else width * SUBSTITUTIONS // WINDOW


def masks(width: int) -> list[list[int]]:
    """Token places that each mask keeps; one mask more than substitutions allowed."""
    step = allowed(width) + 1
    return [list(range(first, width, step)) for first in range(step)]


def window_seeds(hashes: str, at: str, width: int) -> Column:
    """Seeds of the window of ``width`` tokens that begins at ``at``."""
    return F.array(*[
        F.xxhash64(F.lit(width * 100 + m),
                   *[F.get(F.col(hashes), F.col(at) + F.lit(place)) for place in places])
        for m, places in enumerate(masks(width))])


def seeds(rows: DataFrame, hashes: str, width: int) -> DataFrame:
    """A row for each window that fits and for each mask: the rows' columns, ``at``, ``seed``."""
    return (rows.select("*", F.posexplode(hashes).alias("at", "_first"))
            .drop("_first").where(F.col("at") + width <= F.size(hashes))
            .select("*", F.explode(window_seeds(hashes, "at", width)).alias("seed")))


def window(hashes: str, at: str, width: int) -> Column:
    """The window that begins at ``at``, cut out before it is compared.

    The condition always holds. It depends on the partition, so Spark does not move the
    comparison below this column, into the join: the join's generated code stays small enough
    to be compiled, and only windows, not whole texts, come out of it.
    """
    return F.when(F.spark_partition_id() >= 0, F.slice(hashes, F.col(at) + 1, width))


def equal_tokens() -> Column:
    """Equal places of two windows."""
    same = F.zip_with("doc_window", "item_window", lambda x, y: (x == y).cast("int"))
    return F.aggregate(same, F.lit(0), lambda n, x: n + x)


def hits_by_broadcast(own: DataFrame, items: DataFrame, width: int) -> DataFrame:
    """Window pairs with a common seed: the items' seeds go to where the documents are."""
    wanted = seeds(items, "item_hashes", width).select(
        "seed", "item_id", F.col("at").alias("item_at"),
        F.slice("item_hashes", F.col("at") + 1, width).alias("item_window"))
    # The join runs in the same generated code as the seeds: arrays are not copied.
    return seeds(own, "doc_hashes", width).join(F.broadcast(wanted), "seed").select(
        "row_id", "text_key", F.col("at").alias("doc_at"), "item_id", "item_at",
        window("doc_hashes", "at", width).alias("doc_window"), "item_window")


def hits_by_shuffle(own: DataFrame, items: DataFrame, width: int) -> DataFrame:
    """The same for any number of item seeds: seeds and places are shuffled alone, and windows
    are fetched for the pairs that meet."""
    wanted = seeds(items, "item_hashes", width).select(
        "seed", "item_id", "item_key", F.col("at").alias("item_at"))
    met = (seeds(own, "doc_hashes", width)
           .select("seed", "row_id", "text_key", F.col("at").alias("doc_at"))
           .join(wanted, "seed").drop("seed").distinct())
    placed = met.join(own, ["row_id", "text_key"]).withColumn(
        "doc_window", window("doc_hashes", "doc_at", width)).drop("doc_hashes")
    return placed.join(items.select("item_key", "item_hashes").distinct(), "item_key").select(
        "row_id", "text_key", "doc_at", "item_id", "item_at", "doc_window",
        F.slice("item_hashes", F.col("item_at") + 1, width).alias("item_window"))


def whole_lines(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Hits of ``items(item_id, item_hashes)`` that fill a line of a document."""
    mark = F.xxhash64(F.lit("\n"))
    lowered = F.lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    # Always true, and not movable: else a filter on the breaks finds all words for each word.
    found = F.when(F.spark_partition_id() >= 0, F.regexp_extract_all(
        F.concat(F.lit("\n"), lowered, F.lit("\n")), F.lit(rf"[\r\n]+|{TOKEN}"), F.lit(0)))
    hashes = F.transform(found, lambda w: F.when(w.rlike(r"^[\r\n]"), mark).otherwise(
        F.xxhash64(w)))
    # Breaks are the places of the marks: between two of them lies a line.
    marked = docs.select(F.col("doc_id").cast("long"),
                         F.xxhash64(F.col("text").cast("string")).alias("text_key"),
                         hashes.alias("hashes")).withColumn("breaks", F.filter(
        F.sequence(F.lit(0), F.size("hashes") - 1), lambda k: F.get("hashes", k) == mark))
    lines = (marked.select("*", F.posexplode("breaks").alias("n", "at"))
             .withColumn("width", F.get("breaks", F.col("n") + 1) - F.col("at") - 1)
             .where(F.col("width").between(1, SHORTEST - 1))
             .select("doc_id", "text_key", (F.col("at") - F.col("n")).alias("doc_at"),
                     F.slice("hashes", F.col("at") + 2, F.col("width")).alias("item_hashes")))
    return lines.join(items, "item_hashes").select(
        "doc_id", "text_key", "item_id", "doc_at", F.lit(0).alias("item_at"),
        F.size("item_hashes").alias("equal"))


def passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, text_key, item_id, n_windows, best, first_at`` for each document and item
    that share a passage: how many window pairs, the most equal tokens in one, and the first
    token of the document in one.

    Reads ``docs(doc_id, text)`` and ``benchmark(item_id, text)``; extra columns are ignored.
    Null, empty and wordless texts hold nothing. Items under 8 tokens are found as a whole, with
    fewer than ``SURE_CHARACTERS`` only where they fill a line. Rows with equal doc_id and text count once, as do items with equal id and text; ``text_key``
    tells texts under one doc_id apart. Empty tables give no rows.
    """
    items = benchmark.select(F.col("item_id").cast("long"),
                             token_hashes("text").alias("item_hashes"),
                             characters("text").alias("characters")).distinct()
    sized = items.withColumn("width", F.least(F.size("item_hashes"), F.lit(WINDOW))).withColumn(
        "inside", (F.col("width") >= SHORTEST) | (F.col("characters") >= SURE_CHARACTERS))
    # At most 13 different widths, and the number of windows of each; the short items that
    # must fill a line.
    counts = (sized.where("width > 0").groupBy("inside", "width")
              .agg(F.sum(F.size("item_hashes") - F.col("width") + 1).alias("windows")).collect())
    widths = {r["width"]: r["windows"] for r in counts if r["inside"]}
    sized, in_lines = sized.where("inside"), sized.where("NOT inside AND width > 0")
    sized = sized.withColumn("item_key", F.xxhash64("item_hashes"))
    # Rows are told apart by id and text; a null id is a number of its own.
    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("row_id"),
                      F.xxhash64(F.col("text").cast("string")).alias("text_key"),
                      token_hashes("text").alias("doc_hashes"))
    found = []
    for width, windows in sorted(widths.items()):
        few = windows * len(masks(width)) <= BROADCAST_SEEDS
        hits = (hits_by_broadcast if few else hits_by_shuffle)(
            own, sized.where(F.col("width") == width), width)
        hits = hits.withColumn("equal", equal_tokens()).where(
            F.col("equal") >= width - allowed(width))
        found.append(hits.select(
            F.when(F.col("row_id") != NO_ID, F.col("row_id")).alias("doc_id"), "text_key",
            "item_id", "doc_at", "item_at", "equal"))
    if not all(r["inside"] for r in counts):
        found.append(whole_lines(docs, in_lines.select("item_id", "item_hashes")))
    if not found:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, text_key long, item_id long, n_windows long, best int, "
            "first_at int")
    return (reduce(DataFrame.union, found).distinct()
            .groupBy("doc_id", "text_key", "item_id")
            .agg(F.count("*").alias("n_windows"), F.max("equal").alias("best"),
                 F.min("doc_at").alias("first_at")))


def without_passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a passage of an item; all columns stay.

    Null, empty and wordless texts hold nothing and stay. Of rows with equal doc_id (null
    included) only those whose text holds a passage go; repeated rows stay or go together.
    Without items all rows stay.
    """
    hit = passages(docs, benchmark).select(
        F.col("doc_id").alias("_hit_id"), F.col("text_key").alias("_hit_key")).distinct()
    return docs.join(hit, docs["doc_id"].cast("long").eqNullSafe(F.col("_hit_id"))
                     & (F.xxhash64(docs["text"].cast("string")) == F.col("_hit_key")),
                     "left_anti")
