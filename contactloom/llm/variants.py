"""Spelling variants: words one edit apart, by search schemes over FM-indexes.

A word is cut into two halves. An edit falls into one of them, so a near word agrees with the
other: it begins with the word's first half, or ends with its second. Two searches find them
all. One matches the first half exactly from the delimiter on and extends to the right through
the second half, allowing one error; the other matches the second half from its delimiter
backwards and extends to the left. An index gives one reading direction, so the two directions
are two indexes: one of the words and one of the words spelt backwards. In either the pattern
grows at its front, and the interval of suffix ranks that begin with it shrinks.

Shards: a near word of length m shares (m - 1) // 2 code points at least with the exact half,
so indexed words go to the shard of their side, length and that many first (last) code points,
and a word asks the three shards for the lengths around its own. Many such keys share a shard and
its index. Words with one half in common are all that a key holds, however often a word occurs.

An answer is counted by the side that shares the exact half; if both sides do, by the left one.
So counts and the best partner are summed in the task, and no pair leaves it.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom.llm.store import written

SHORTEST, LEAST, TIMES, EVERY = 5, 3, 2, 97
# Index words of a shard (about), queries searched at a time, distinct words that a task holds
# before it hands them on.
SHARD_WORDS, QUERIES_AT_ONCE, HELD_WORDS = 20_000, 4_096, 500_000

# Code points of runs as Latin-1 bytes, A-Z in small letters; all others become blanks.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32
               for b in range(256))


def altered(doc_id: str, run: bytes) -> bytes:
    """The run (Latin-1) without one code point if the checksum of document and run says so."""
    utf8 = run if run.isascii() else run.decode("latin-1").encode()
    h = zlib.crc32(f"{doc_id}:".encode() + utf8)
    if h % EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of each word, summed as far as a task sees them."""
    held: Counter = Counter()

    def rows() -> pa.RecordBatch:
        return pa.record_batch({
            "word": pa.array([w.decode("latin-1") for w in held], pa.string()),
            "n": pa.array(held.values(), pa.int64())})

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(),
                                batch.column("text").to_pylist(), strict=True):
            runs = text.encode("latin-1", "replace").translate(_BYTES).split()
            name = "" if doc_id is None else str(doc_id)
            for run, n in Counter(runs).items():
                word = altered(name, run)
                if len(word) >= SHORTEST:
                    held[word] += n
            if len(held) > HELD_WORDS:
                yield rows()
                held.clear()
    yield rows()


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word, n``: the words of all ``docs(doc_id, text)`` with at least ``LEAST`` occurrences."""
    texts = docs.select(F.col("doc_id").cast("long"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return (texts.mapInArrow(count_words, "word string, n long").groupBy("word")
            .agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST))


class Index:
    """FM-index of words, each between two delimiters; symbol 0 ends the text, 1 delimits."""

    def __init__(self, words: list[bytes]) -> None:
        text = np.frombuffer(b"\x01" + b"".join(w + b"\x01" for w in words) + b"\x00", np.uint8)
        self.words = words
        # The text position before each word, to find the word a suffix begins with.
        self.starts = np.cumsum([0] + [len(w) + 1 for w in words])[:-1]
        self.suffixes = suffixes(text)
        before = text[self.suffixes - 1]
        self.n = len(text)
        order = np.argsort(before, kind="stable")
        # Where each symbol stands before the sorted suffixes; one sorted list for all symbols.
        self.places = before[order].astype(np.int64) * self.n + order
        self.first = np.searchsorted(before[order], np.arange(257))
        self.before = before
        self.symbols = np.unique(text[text > 1]).astype(np.int64)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Suffixes that follow the symbol among the first ``at``, as a rank in the index."""
        return np.searchsorted(self.places, symbol * self.n + at)

    def extend(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with one symbol more at their front."""
        return self.rank(symbol, low), self.rank(symbol, high)

    def word_at(self, ranks: np.ndarray) -> np.ndarray:
        """Numbers of the words whose delimiter begins the suffixes of these ranks."""
        return np.searchsorted(self.starts, self.suffixes[ranks])


def suffixes(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling."""
    rank, span = text.astype(np.int64), 1
    while True:
        after = np.zeros(len(rank), np.int64)
        after[:-span or None] = rank[span:] + 1
        joint = rank * (max(len(text), 256) + 2) + after
        values, rank = np.unique(joint, return_inverse=True)
        if len(values) == len(text) or span > len(text):
            return np.argsort(rank, kind="stable")
        span *= 2


def search(index: Index, queries: list[bytes], lengths: np.ndarray, longer: bool
           ) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, word): words of the wanted length that end like the second half of the
    query and differ from it by exactly one edit in the first half, the ``longer`` one or not."""
    sizes = np.array([len(q) for q in queries])
    half = (sizes + longer) // 2
    width = int(sizes.max())
    letters = np.zeros((len(queries), width), np.int64)
    for i, q in enumerate(queries):
        letters[i, :len(q)] = np.frombuffer(q, np.uint8)
    rows = np.arange(len(queries))
    one = np.ones(len(queries), np.int64)
    low, high = index.extend(0 * one, index.n * one, one)
    # The exact half, from the last delimiter backwards.
    for step in range(int((sizes - half).max())):
        on = np.flatnonzero(step < sizes - half)
        low[on], high[on] = index.extend(low[on], high[on], letters[on, sizes[on] - 1 - step])
    # States without an error: query, letters left of the first half, interval.
    states = [rows, half.copy(), low, high]
    wrong: list[list[np.ndarray]] = []  # the same, with one error, and the change in length
    edit = lengths - sizes
    for _ in range(int(half.max()) + 1):
        keep = states[3] > states[2]
        q, left, low, high = (s[keep] for s in states)
        if not len(q):
            break
        # Deletion: the word lacks this letter.
        at = np.flatnonzero((left > 0) & (edit[q] == -1))
        wrong.append([q[at], left[at] - 1, low[at], high[at]])
        # Replacement and insertion: any letter, as many as may stand there.
        at = np.flatnonzero((edit[q] == 1) | (edit[q] == 0) & (left > 0))
        wide = high[at] - low[at] > len(index.symbols)
        many, few = at[wide], at[~wide]
        owner = np.concatenate([np.repeat(many, len(index.symbols)),
                                np.repeat(few, high[few] - low[few])])
        offset = np.arange(len(owner) - len(many) * len(index.symbols)) - np.repeat(
            np.cumsum(high[few] - low[few]) - (high[few] - low[few]), high[few] - low[few])
        symbol = np.concatenate([np.tile(index.symbols, len(many)), index.before[
            np.repeat(low[few], high[few] - low[few]) + offset].astype(np.int64)])
        tried = np.unique(owner * 256 + symbol)
        owner, symbol = tried // 256, tried % 256
        replaced = edit[q[owner]] == 0
        own = letters[q[owner], np.maximum(left[owner] - 1, 0)]
        ok = (symbol > 1) & ~(replaced & (symbol == own))
        owner, symbol, replaced = owner[ok], symbol[ok], replaced[ok]
        a, b = index.extend(low[owner], high[owner], symbol)
        some = b > a
        wrong.append([q[owner][some], (left[owner] - replaced)[some], a[some], b[some]])
        # The exact way on.
        at = np.flatnonzero(left > 0)
        a, b = index.extend(low[at], high[at], letters[q[at], left[at] - 1])
        states = [q[at], left[at] - 1, a, b]
    q, left, low, high = (np.concatenate(s) for s in zip(*wrong, strict=True))
    ended: list[list[np.ndarray]] = []
    while len(q):
        done = left == 0
        a, b = index.extend(low[done], high[done], np.ones(int(done.sum()), np.int64))
        ended.append([q[done], a, b])
        q, left, low, high = q[~done], left[~done], low[~done], high[~done]
        low, high = index.extend(low, high, letters[q, left - 1])
        some = high > low
        q, left, low, high = q[some], left[some] - 1, low[some], high[some]
    q, low, high = (np.concatenate(s) for s in zip(*ended, strict=True))
    size = np.maximum(high - low, 0)
    q = np.repeat(q, size)
    ranks = np.repeat(low, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    # One word may be reached by edits at several places.
    pairs = np.unique(q * len(index.words) + index.word_at(ranks))
    return pairs // len(index.words), pairs % len(index.words)


def search_shard(shard: pa.Table) -> pa.Table:
    """For each query of a shard: how many near words it has here, and the best of them.

    ``side`` 0 has words as they are and finds those that share the query's end; ``side`` 1 has
    words spelt backwards and finds those that share its beginning.
    """
    backwards = bool(shard.column("side")[0].as_py())
    turn = (lambda w: w[::-1]) if backwards else (lambda w: w)
    indexed = shard.filter(shard.column("indexed"))
    asked = shard.filter(pa.compute.invert(shard.column("indexed")))
    words = [turn(w.encode("latin-1")) for w in indexed.column("word").to_pylist()]
    out = {"word": [], "n_near": [], "form": [], "form_n": []}
    if words and asked.num_rows:
        index = Index(words)
        counts = indexed.column("n").to_pylist()
        lengths = asked.column("size").to_numpy()
        queries = [turn(w.encode("latin-1")) for w in asked.column("word").to_pylist()]
        for i in range(0, len(queries), QUERIES_AT_ONCE):
            part = queries[i:i + QUERIES_AT_ONCE]
            found: dict[int, list] = {}
            for q, w in zip(*(x.tolist() for x in search(
                    index, part, lengths[i:i + QUERIES_AT_ONCE], backwards)), strict=True):
                query, word = part[q], words[w]
                if not backwards and word.startswith(query[:len(query) // 2]):
                    continue  # the other side counts it
                rank = (-counts[w], turn(word))
                best = found.setdefault(q, [0, rank])
                best[0] += 1
                best[1] = min(best[1], rank)
            for q, (n, (best_n, form)) in found.items():
                out["word"].append(turn(part[q]).decode("latin-1"))
                out["n_near"].append(n)
                out["form"].append(form.decode("latin-1"))
                out["form_n"].append(-best_n)
    return pa.table(out, schema=pa.schema([("word", pa.string()), ("n_near", pa.int64()),
                                           ("form", pa.string()), ("form_n", pa.int64())]))


def shard_key(side: Column, size: Column, word: Column) -> Column:
    """Words of this length that a query can find agree with it in this much of one end."""
    shared = F.floor((size - 1) / 2).cast("int")
    end = F.when(side == 1, F.substring(word, F.lit(1), shared)).otherwise(
        F.substring(word, -shared, shared))
    return F.xxhash64(side, size, end)


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, form, form_n`` for each of ``words(word, n)`` with a near word: how many
    differ by one edit, and the most frequent of them (the first in code-point order)."""
    shards = -(-words.count() // SHARD_WORDS)
    size = F.length("word")
    sides = words.withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
    rows = sides.withColumn("size", size).withColumn("indexed", F.lit(True)).unionByName(
        sides.withColumn("size", F.explode(F.array(size - 1, size, size + 1)))
        .withColumn("indexed", F.lit(False)))
    dealt = rows.withColumn("shard", F.pmod(
        shard_key(F.col("side"), F.col("size"), F.col("word")), F.lit(max(1, shards))))
    found = dealt.groupBy("side", "shard").applyInArrow(
        search_shard, "word string, n_near long, form string, form_n long")
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"),
        F.min(F.struct((-F.col("form_n")).alias("rank"), "form")).alias("best")).select(
        "word", "n_near", F.col("best.form").alias("form"),
        (-F.col("best.rank")).alias("form_n"))


def followed(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``forms(word, form)``: the last form of the chain, by doubling."""
    ways = written(forms.select("word", F.col("form").alias("root")), "ways")
    while True:
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ways = written(ways.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"),
            F.col("next").isNotNull().alias("moved")), "ways")
        if ways.where("moved").isEmpty():
            return ways.select("word", "root")
        ways = ways.drop("moved")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each word of ``docs(doc_id, text)``.

    Runs of A-Z, a-z and U+00C0 to U+00FF are words with A-Z in small letters; where
    ``EVERY`` divides the checksum of ``<doc_id>:<run>``, one code point of the run is deleted.
    Words have at least ``SHORTEST`` code points and ``LEAST`` occurrences (``n``). Near words
    differ by exactly one code point inserted, deleted or replaced; ``form`` is the most frequent
    one (the first in code-point order of equals) if it has ``TIMES`` as many occurrences as the
    word, ``root`` the last word that forms lead to.

    Null and empty texts hold no words. A null doc_id counts as an empty one in the checksum.
    Equal rows count each. Extra columns are ignored. No rows give none.
    """
    words = written(vocabulary(docs), "words")
    near = written(words.join(near_words(words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("form_n") >= TIMES * F.col("n"), F.struct("form", "form_n")).alias("best")),
        "near")
    formed = near.select("word", "n", "n_near", "best.form", "best.form_n")
    roots = followed(formed.where("form IS NOT NULL").select("word", "form"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
