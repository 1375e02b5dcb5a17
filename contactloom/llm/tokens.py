"""Token counts of a unigram vocabulary: Aho-Corasick matches, count-only Viterbi.

The counts equal those of the public ``Unigram`` tokenizer over the same pieces and scores
with a metaspace split (a mark for each blank, one before the text): pieces never cross a
mark, so a text's count is the sum over its marked words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from math import inf

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHED_WORDS = 500_000
Vocabulary = list[tuple[str, float]]


def read_vocabulary(path: str) -> Vocabulary:
    """Pieces and scores of a sentencepiece file, in order of their ids."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter(dict):
    """Token counts of marked words, kept while they fit in memory.

    Over a word, every vocabulary match comes from one pass of an Aho-Corasick automaton. For
    each end the best score so far and its number of pieces are carried, nothing else. Of
    equal scores the match that starts first wins, as in the tokenizer, which only replaces a
    path by a strictly better one and meets earlier starts first; the automaton reports the
    matches of one end from the longest on. Where no single character piece starts, the
    character itself is a step at the lowest score less ten; it counts as its UTF-8 bytes if
    the vocabulary has byte pieces, else a run of them counts as one.

    A line end that is in no piece is such a step for itself, so the lines are counted apart;
    that is exact where all scores are whole numbers.
    """

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        pieces = {p for p, _ in vocabulary}
        self.single = {p for p in pieces if len(p) == 1}
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self.bytes = all(f"<0x{b:02X}>" in pieces for b in range(256))
        self.by_line = (self.bytes and not any("\n" in p for p in pieces)
                        and all(float(s).is_integer() for _, s in vocabulary))

    def count(self, word: str) -> int:
        if not self.single.issuperset(word):
            return self.count_with_unknown(word)
        best, pieces = [-inf] * (len(word) + 1), [0] * (len(word) + 1)
        best[0] = 0.0
        for last, (length, value) in self.automaton.iter(word):
            end = last + 1
            score = best[end - length] + value
            if score > best[end]:
                best[end] = score
                pieces[end] = pieces[end - length] + 1
        return pieces[-1]

    def count_with_unknown(self, word: str) -> int:
        ends: list[list[tuple[int, float]]] = [[] for _ in range(len(word) + 1)]
        for last, match in self.automaton.iter(word):
            ends[last + 1].append(match)
        best, pieces, in_run = [0.0], [0], [False]
        for end in range(1, len(word) + 1):
            score, start, unknown = -inf, -1, False
            for length, value in ends[end]:
                if best[end - length] + value > score:
                    score, start = best[end - length] + value, end - length
            char = word[end - 1]
            if char not in self.single and best[end - 1] + self.unknown > score:
                score, start, unknown = best[end - 1] + self.unknown, end - 1, True
            if not unknown:
                step = 1
            elif self.bytes:
                step = len(char.encode())
            else:
                step = 0 if in_run[start] else 1
            best.append(score)
            pieces.append(pieces[start] + step)
            in_run.append(unknown)
        return pieces[-1]

    def __missing__(self, word: str) -> int:
        """Count of a marked word, or after a line end of a piece of text without mark."""
        n = self.count(word[1:] if word.startswith("\n") else MARK + word)
        if len(self) >= CACHED_WORDS:
            self.clear()
        if len(word) <= 64:
            self[word] = n
        return n

    def of_text(self, text: str) -> int:
        if not text:
            return 0
        marked = text.replace(" ", MARK)
        if marked[0] != MARK:
            marked = MARK + marked
        if not self.by_line:
            return sum(map(self.count, (MARK + w for w in marked.split(MARK)[1:])))
        total = 0
        for line in marked.split("\n"):
            head, *words = line.split(MARK)
            if head:
                total += self["\n" + head]
            total += sum(map(self.__getitem__, words))
        return total + marked.count("\n")


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(read_vocabulary(path))


def count(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_text = counter(path).of_text
        for batch in batches:
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array([of_text(t or "") for t in (
                    x.as_py() for x in batch.column("text"))], pa.int64())})

    return run


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens`` for each row of ``docs(doc_id, text)``, over whole texts.

    ``path`` names a sentencepiece file whose pieces and scores are read as a unigram
    vocabulary. Null and empty texts have no tokens. Rows with equal or null doc_id are
    counted one by one. Extra columns are ignored; no rows give none.
    """
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        count(path), "doc_id long, n_tokens long")
