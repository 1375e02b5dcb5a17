"""Packing of token sequences: first-fit decreasing with a tournament tree of capacities."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from contactloom.llm.store import written
from contactloom.llm.words import _LOWER, SLICE_BYTES, slices, text_buffer

GROUP_PIECES = 20_000
CACHED_WORDS, CACHED_PIECES = 200_000, 20_000

# Kinds of bytes: white space, letters, digits, marks, and those beside which nothing is cut.
SPACE, LETTER, DIGIT, MARK, GLUE = range(5)
KINDS = np.full(256, GLUE, np.uint8)
KINDS[33:127] = MARK
KINDS[[9, 10, 11, 12, 13, 32]] = SPACE
KINDS[48:58] = DIGIT
KINDS[65:91] = KINDS[97:123] = LETTER
KINDS[0x80:0xC0] = KINDS[0xC3] = LETTER  # U+00C0 to U+00FF; ``separated`` mends the others
KINDS[ord("'")] = GLUE


def byte_letters() -> dict[int, str]:
    """Character that a byte-level vocabulary shows for each byte: printable Latin-1 bytes
    stand for themselves, the others for the characters from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    letters = {b: chr(b) for b in plain}
    rest = [b for b in range(256) if b not in letters]
    return letters | {b: chr(256 + i) for i, b in enumerate(rest)}


def separated(data: np.ndarray, offsets: np.ndarray, added: re.Pattern | None = None
              ) -> tuple[np.ndarray, np.ndarray]:
    """Texts with the same token ids whose words are shorter and repeat more often.

    A blank goes between letters, digits and other marks, where the tokenizer splits anyhow,
    and A-Z become small letters. Left as they are: what stands beside an apostrophe (it may
    begin a split of its own), beside a character outside printable Latin-1 (it may be a blank,
    or change with its neighbours when the text is normalized) and in an ``added`` token. Longer
    data, one text over the size of a slice, stays whole, to hold no arrays of its length.
    """
    if not 0 < len(data) <= 2 * SLICE_BYTES:
        return data, offsets
    kinds, low = KINDS[data], _LOWER[data]
    wide = np.flatnonzero((data == 0xC2) | (data >= 0xC4))
    kinds[wide] = kinds[wide + 1] = GLUE
    kinds[wide[data[wide] >= 0xE0] + 2] = GLUE
    kinds[wide[data[wide] >= 0xF0] + 3] = GLUE
    signs = np.flatnonzero((data[1:] == 0x97) | (data[1:] == 0xB7))  # of times and division
    signs = signs[data[signs] == 0xC3]
    kinds[signs] = kinds[signs + 1] = GLUE
    before = wide[wide > 0] - 1
    low[before] = data[before]
    for found in added.finditer(low.tobytes()) if added else ():
        kinds[found.start():found.end()] = GLUE
        low[found.start():found.end()] = data[found.start():found.end()]
    left, right = kinds[:-1], kinds[1:]
    cuts = 1 + np.flatnonzero(((left != right) | (left == DIGIT)) & (left != SPACE)
                              & (right != SPACE) & (left != GLUE) & (right != GLUE))
    return np.insert(low, cuts, 32), offsets + np.searchsorted(cuts, offsets)


class WordIds(dict):
    """Token ids (little-endian bytes) of words between ASCII white space, kept while they fit.

    The tokenizer drops white space and never joins across it, so the ids of a text are those
    of its words. Words of plain Latin-1 characters go straight to the tokenizer's model with
    the tokenizer's own split pattern, letters with at most a comma or a full stop after them
    without it; words that hold an added token pass the whole tokenizer, all others its
    normalizer and pre-tokenizer. Words met once are kept apart as ``young``, so that they push
    out no frequent ones. Each of the two caches, when full, becomes its older one, out of which
    words in use come back; memory stays at four times the limit.
    """

    SIMPLE = re.compile(r"[!-~¡-ÿ]+")
    SPLIT = regex.compile(
        r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.lower()
                      for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Added tokens all hold a character that words of letters and , . do not have.
        self.words_are_free = all(any(not c.isalpha() and c not in ",." for c in t)
                                  for t in self.added)
        self.tokenize = self.tokenizer.model.tokenize
        self.letters = byte_letters()
        self.added_bytes = re.compile(b"|".join(
            re.escape(t.encode()) for t in self.added)) if self.added else None
        self.older: dict[bytes, bytes] = {}
        self.young: dict[bytes, bytes] = {}
        self.older_young: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.as_bytes = [i.to_bytes(4, "little") for i in range(max(
            self.tokenizer.get_vocab().values(), default=-1) + 1)]

    def ids(self, piece: str) -> bytes:
        table = self.as_bytes
        return b"".join([table[t.id] for t in self.tokenize(piece)])

    def of_letters(self, piece: str) -> bytes:
        return self.ids(piece if piece.isascii()
                        else "".join(map(self.letters.__getitem__, piece.encode())))

    def known(self, piece: str) -> bytes:
        got = self.pieces.get(piece)
        if got is None:
            if len(self.pieces) >= CACHED_PIECES:
                self.pieces.clear()
            got = self.pieces[piece] = self.of_letters(piece)
        return got

    def of_word(self, word: bytes) -> bytes:
        text = word.decode()
        if self.words_are_free and word.isalpha():
            return self.ids(text.lower())
        if self.words_are_free and (text.isascii() or self.SIMPLE.fullmatch(text)):
            if text.isalpha():
                return self.of_letters(text.lower())
            if text[-1] in ",." and text[:-1].isalpha():
                return self[word[:-1]] + self.known(text[-1])
        low = text.lower()
        if any(t in low for t in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids,
                            "<u4").tobytes()
        if self.SIMPLE.fullmatch(text):
            return b"".join(map(self.known, self.SPLIT.findall(low)))
        t = self.tokenizer
        return b"".join(self.ids(p) for p, _ in t.pre_tokenizer.pre_tokenize_str(
            t.normalizer.normalize_str(text)))

    def __missing__(self, word: bytes) -> bytes:
        got = self.young.get(word, self.older.get(word, self.older_young.get(word)))
        if got is not None:
            if len(self) >= CACHED_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = got
            return got
        got = self.of_word(word)
        if len(word) <= 64:
            if len(self.young) >= CACHED_WORDS:
                self.older_young, self.young = self.young, {}
            self.young[word] = got
        return got


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def token_bytes(text: bytes, path: str, end_id: int) -> bytes:
    return b"".join(map(word_ids(path).__getitem__, text.split())) + np.array(
        [end_id], "<u4").tobytes()


def cut(path: str, end_id: int, size: int, with_ids: bool
        ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pieces of at most ``size`` tokens for each text, with a number for dealing them out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(TaskContext.get().partitionId())
        for whole in batches:
            for batch in slices(whole, "text"):
                data, offsets = separated(*text_buffer(batch.column("text")),
                                          word_ids(path).added_bytes)
                rows: list[tuple] = []
                for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                    ids = token_bytes(data[offsets[i]:offsets[i + 1]].tobytes(), path, end_id)
                    for at in range(0, len(ids), 4 * size):
                        part = ids[at:at + 4 * size]
                        rows.append((doc_id, at // 4, len(part) // 4, zlib.crc32(part),
                                     len(ids) // 4, part if with_ids else None))
                columns = list(zip(*rows, strict=True))
                yield pa.record_batch({
                    "doc_id": pa.array(columns[0], pa.int64()),
                    "start": pa.array(columns[1], pa.int64()),
                    "length": pa.array(columns[2], pa.int64()),
                    "ids_crc32": pa.array(columns[3], pa.int64()),
                    "doc_tokens": pa.array(columns[4], pa.int64()),
                    "ids": pa.array(columns[5], pa.binary()),
                    "deal": pa.array(rng.integers(0, 2**62, len(rows)))})

    return run


def first_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, taken in the given order, by first fit.

    A tournament tree holds in each node the largest free capacity below it; the leftmost bin
    that fits is found on one way down from the root.
    """
    leaves = 1 << max(0, (len(lengths) - 1).bit_length())
    tree = [size] * (2 * leaves)
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for k, need in enumerate(lengths.tolist()):
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < need:
                node += 1
        bins[k], offsets[k] = node - leaves, size - tree[node]
        tree[node] -= need
        node //= 2
        while node:
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
            node //= 2
    return bins, offsets


def place(size: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "start", "ids_crc32", "deal"],
                                  ascending=[False, True, True, True, True])
        bins, offsets = first_fit(group["length"].to_numpy(), size)
        group["sequence_id"] = (group["part"].to_numpy() << 32) + bins
        group["offset"] = offsets
        return group.drop(columns=["part", "deal"])

    return run


def pack(docs: DataFrame, path: str, end_id: int, size: int = 4096, with_ids: bool = False
         ) -> DataFrame:
    """Where each piece of each text lies in sequences of at most ``size`` tokens.

    Returns ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and, if
    ``with_ids``, ``ids`` (little-endian unsigned 32-bit). A text is its token ids and then
    ``end_id``; texts over ``size`` tokens are cut every ``size``. Pieces are dealt at random
    to groups of about 20,000, each packed on its own, so no group grows with the input or
    with repeated rows. Null and empty texts are the end id alone; rows with equal or null
    doc_id are packed as rows of their own. Extra columns are ignored. No rows give none.
    """
    columns = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
               "ids binary")
    pieces = written(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .mapInArrow(cut(path, end_id, size, with_ids), columns + ", deal long"), "pieces")
    parts = max(1, -(-pieces.count() // GROUP_PIECES))
    placed = (pieces.withColumn("part", F.pmod("deal", F.lit(parts)))
              .groupBy("part").applyInPandas(
                  place(size), columns + ", sequence_id long, offset long"))
    return placed if with_ids else placed.drop("ids")


def sequences(placed: DataFrame) -> DataFrame:
    """``sequence_id, n_tokens, ids`` of rows packed ``with_ids``: the ids in order, unpadded."""
    return placed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts")).select(
        "sequence_id", "n_tokens",
        F.expr("aggregate(parts, X'', (all, p) -> concat(all, p.ids))").alias("ids"))
