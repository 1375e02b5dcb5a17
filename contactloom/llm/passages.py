"""Repeated passages: found by hashes, confirmed, and located with Aho-Corasick automata.

A passage is a run of words of which every window of ``width`` words starts at two or more
places of the corpus.

1. Each window is stood for by the least of its 8-word phrases (leftmost of equals), so equal
   windows always share a phrase. Phrases are counted over the whole corpus.
2. Documents are dealt to shards of bounded size; each shard gets the recurring phrases that
   it has, and gives the runs of words under them. Their windows are counted over the whole
   corpus by 96 bits of two hashes: those found twice are confirmed. Windows travel to a bucket
   of their phrase, many to a row and once for a shard; those under a very common phrase go by
   their own hash. There are as many rounds as keep the rows of one in proportion to the texts,
   and each takes its share of the buckets. A confirmed window goes to one place, its first,
   with the shards that have it, and neighbouring ones make up a passage, so the passages
   together hold each repeated window once.
3. A passage is sent to the shards that have one of its windows. There its phrases of 8 words
   in steps of 28 are compiled to an automaton; a window of 35 words always holds one of them
   whole. All documents of the shard are streamed through it, and the windows around each
   occurrence are compared with the passages' word by word.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contactloom.llm.store import written
from contactloom.llm.words import (
    Words,
    long_window_hashes,
    mix,
    runs,
    slices,
    sliding_min,
    split_words,
    window_hashes,
)

PHRASE = 8
SHARD_BYTES = 8 << 20
SHARD_BITS = 20
MAX_SHARDS = 1 << SHARD_BITS
REGION_BITS, POSITION_BITS = 22, 20
PLACE_BITS = 24
STEP = 1 << 22
OTHER = np.uint64(0xD1B54A32D192ED03)
WINDOW_BYTES = 14  # of a window in the shuffle of its round: two hashes and its part of a place
ROUND_SHARE = 0.5  # bytes of the windows of a round for each byte of text
BUCKET_WINDOWS = 1 << 19
COMMON = 4096  # places of a phrase whose windows are dealt by their own hash, at least
PIECE = 512
FOUND = T.StructType([
    T.StructField("bucket", T.LongType()), T.StructField("shard", T.LongType()),
    *[T.StructField(n, T.BinaryType()) for n in ("window", "other", "twice", "begin", "n")]])
HOMES = "region long, place int, n int, shards array<int>"


def window_phrases(h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of ``width`` words, where its least phrase begins; and all phrase
    hashes. Windows and phrases that cross texts are for the caller to leave out."""
    phrases = window_hashes(h, PHRASE)
    span = width - PHRASE + 1
    windows = max(0, len(h) - width + 1)
    at = np.empty(windows, np.int64)
    for a in range(0, windows, STEP):
        b = min(a + STEP, windows)
        part = phrases[a:b + span - 1]
        place = np.arange(len(part), dtype=np.uint64)
        packed = ((part >> np.uint64(PLACE_BITS)) << np.uint64(PLACE_BITS)) | place
        least = sliding_min(packed, span) & np.uint64((1 << PLACE_BITS) - 1)
        at[a:b] = least.astype(np.int64) + a
    return at, phrases


def whole_windows(w: Words, width: int) -> np.ndarray:
    """Whether the window that starts at each word lies within one text."""
    windows = max(0, len(w.hashes) - width + 1)
    text = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    return text[:windows] == text[width - 1:width - 1 + windows]


def phrase_rows(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                w = split_words(batch.column("text"))
                at, phrases = window_phrases(w.hashes, width)
                at = np.unique(at[whole_windows(w, width)])
                text = np.searchsorted(w.first, at, "right") - 1
                yield pa.record_batch({
                    "phrase": pa.array(phrases[at].view(np.int64)),
                    "shard": batch.column("shard").take(pa.array(text))})

    return run


def regions(width: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The words of runs of windows under recurring phrases, and the number of windows."""
    def run(texts: pa.Table, recurring: pa.Table) -> pa.Table:
        known = np.sort(recurring.column("phrase").to_numpy().view(np.uint64))
        names, words, counts = [], [], []
        if texts.num_rows and len(known):
            shard = texts.column("shard")[0].as_py()
            for batch in texts.select(["text"]).combine_chunks().to_batches():
                for part in slices(batch, "text"):
                    w = split_words(part.column("text"))
                    at, phrases = window_phrases(w.hashes, width)
                    found = phrases[at]
                    place = np.minimum(np.searchsorted(known, found), len(known) - 1)
                    inside = whole_windows(w, width)
                    for a, b in runs((known[place] == found) & inside):
                        for c in range(a, b, 1 << POSITION_BITS):
                            d = min(b, c + (1 << POSITION_BITS))
                            names.append((((shard << REGION_BITS) + len(names))
                                          << POSITION_BITS))
                            words.append(b" ".join(
                                w.data[w.starts[c]:w.ends[d + width - 2]].tobytes().split()))
                            counts.append(d - c)
        return pa.table({"region": pa.array(names, pa.int64()),
                         "words": pa.array(words, pa.binary()).cast(pa.string()),
                         "windows": pa.array(counts, pa.int64())})

    return run


def cuts(*changes: np.ndarray) -> np.ndarray:
    """Where runs begin, the first one too, if ``changes`` tell where neighbours differ."""
    return np.concatenate(([0], np.flatnonzero(reduce(np.logical_or, changes)) + 1))


def region_windows(width: int, common: np.ndarray, buckets: int, rounds: int, now: int
                   ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Windows of regions whose bucket is of round ``now``: a row for each bucket and shard in
    a slice, with a hash of each window, some bits of another one, whether the slice has it
    twice, and its first place there as runs of places.

    Equal windows have one bucket: that of their phrase, or of themselves if the phrase is one
    of the sorted ``common`` ones.
    """
    def found(batch: pa.RecordBatch) -> Iterator[tuple]:
        w = split_words(batch.column("words"))
        anchors, phrases = window_phrases(w.hashes, width)
        hashes = long_window_hashes(w.hashes, width)
        key = phrases[anchors]
        if len(common):
            place = np.minimum(np.searchsorted(common, key), len(common) - 1)
            key = np.where(common[place] == key, hashes, key)
        bucket = (mix(key) % np.uint64(buckets)).astype(np.int64)
        at = np.flatnonzero(whole_windows(w, width) & (bucket % rounds == now))
        if not len(at):
            return
        region = np.searchsorted(w.first, at, "right") - 1
        codes = batch.column("region").to_numpy()[region] + at - w.first[region]
        window, bucket = hashes[at], bucket[at]
        other = (long_window_hashes(mix(w.hashes ^ OTHER), width)[at]
                 >> np.uint64(32)).astype(np.uint32)
        shard = codes >> (REGION_BITS + POSITION_BITS)
        order = np.lexsort((codes, other, window, shard))
        x, y, z = window[order], other[order], shard[order]
        first = cuts(x[1:] != x[:-1], y[1:] != y[:-1], z[1:] != z[:-1])
        twice = np.diff(first, append=len(order)) > 1
        kept = order[first]
        order = np.lexsort((codes[kept], bucket[kept], shard[kept]))
        kept, twice = kept[order], twice[order]
        window, other, codes = window[kept], other[kept], codes[kept]
        bucket, shard = bucket[kept], shard[kept]
        row = cuts(bucket[1:] != bucket[:-1], shard[1:] != shard[:-1])
        for a, b in itertools.pairwise([*row.tolist(), len(kept)]):
            own = codes[a:b]
            run = cuts(own[1:] != own[:-1] + 1)
            yield (int(bucket[a]), int(shard[a]), window[a:b].tobytes(), other[a:b].tobytes(),
                   np.packbits(twice[a:b]).tobytes(), own[run].tobytes(),
                   np.diff(run, append=b - a).astype(np.int32).tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "words"):
                rows = list(found(batch))
                yield pa.record_batch({
                    f.name: pa.array([r[i] for r in rows],
                                     pa.int64() if i < 2 else pa.binary())
                    for i, f in enumerate(FOUND)})

    return run


def joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """The numbers in all values of a binary column."""
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def confirm(rows: pa.Table) -> pa.Table:
    """Windows of a bucket that have two places: runs of their first places, with the shards
    that have any window of the run."""
    window, other = joined(rows["window"], np.uint64), joined(rows["other"], np.uint32)
    sizes = pc.binary_length(rows["window"]).to_numpy() // 8
    flags = [np.unpackbits(np.frombuffer(t, np.uint8), count=n) for t, n in zip(
        rows["twice"].to_pylist(), sizes.tolist(), strict=True)]
    count = 1 + np.concatenate(flags).astype(np.int64)
    shard = np.repeat(rows["shard"].to_numpy(), sizes)
    begin, n = joined(rows["begin"], np.int64), joined(rows["n"], np.int32)
    codes = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(len(window))
    order = np.argsort(window, kind="stable")
    x, y = window[order], other[order]
    if np.any((x[1:] == x[:-1]) & (y[1:] != y[:-1])):
        order = np.lexsort((other, window))
        x, y = window[order], other[order]
    first = cuts(x[1:] != x[:-1], y[1:] != y[:-1])
    total = np.add.reduceat(count[order], first)
    home = np.minimum.reduceat(codes[order], first)
    good = np.flatnonzero(total > 1)
    if not len(good):
        return pa.table({"region": pa.array([], pa.int64()), "place": pa.array([], pa.int32()),
                         "n": pa.array([], pa.int32()),
                         "shards": pa.array([], pa.list_(pa.int32()))})
    by_home = good[np.argsort(home[good])]
    own = home[by_home]
    region = own >> POSITION_BITS
    run = cuts((own[1:] != own[:-1] + 1), region[1:] != region[:-1])
    run_of = np.full(len(first), -1)
    run_of[by_home] = np.repeat(np.arange(len(run)), np.diff(run, append=len(own)))
    member = np.repeat(run_of, np.diff(first, append=len(order)))
    held = member >= 0
    pairs = np.unique((member[held] << SHARD_BITS) | shard[order][held])
    ends = np.searchsorted(pairs >> SHARD_BITS, np.arange(len(run) + 1))
    return pa.table({
        "region": pa.array(region[run] << POSITION_BITS),
        "place": pa.array((own[run] & ((1 << POSITION_BITS) - 1)).astype(np.int32)),
        "n": pa.array(np.diff(run, append=len(own)).astype(np.int32)),
        "shards": pa.ListArray.from_arrays(
            pa.array(ends.astype(np.int32)),
            pa.array((pairs & ((1 << SHARD_BITS) - 1)).astype(np.int32)))})


def cut_passages(width: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Neighbouring confirmed windows of the regions of a shard as passages, in pieces of at
    most ``PIECE`` windows, with the shards that have any of these."""
    def run(areas: pa.Table, homes: pa.Table) -> pa.Table:
        texts, shards = [], []
        region = homes["region"].to_numpy()
        order = np.lexsort((homes["place"].to_numpy(), region))
        region, place, n = region[order], homes["place"].to_numpy()[order], homes[
            "n"].to_numpy()[order]
        lists = homes["shards"].combine_chunks()
        first = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(
            zero_copy_only=False)))).astype(np.int64)
        held = lists.flatten().to_numpy()
        low = np.searchsorted(region, areas["region"].to_numpy())
        high = np.searchsorted(region, areas["region"].to_numpy(), "right")
        for i in np.flatnonzero(low < high).tolist():
            parts = areas["words"][i].as_buffer().to_pybytes().split(b" ")
            begin, size, rows = (v[low[i]:high[i]] for v in (place, n, order))
            flags = np.zeros(len(parts), bool)
            for a, b in zip(begin.tolist(), size.tolist(), strict=True):
                flags[a:a + b] = True
            for a, b in runs(flags):
                for c in range(a, b, PIECE):
                    d = min(b, c + PIECE)
                    # Runs in order of place do not overlap: those within c:d are neighbours
                    j = np.searchsorted(begin + size, c, "right")
                    k = np.searchsorted(begin, d)
                    texts.append(b" ".join(parts[c:d + width - 1]))
                    shards.append(np.unique(np.concatenate(
                        [held[first[r]:first[r + 1]] for r in rows[j:k].tolist()])))
        return pa.table({"words": pa.array(texts, pa.binary()).cast(pa.string()),
                         "shards": pa.array(shards, pa.list_(pa.int32()))})

    return run


def spaced(w: Words, i: int) -> str:
    """The words of text ``i`` with one blank around each, a character for each byte."""
    return b" ".join([b"", *w.text_of(i).split(), b""]).decode("latin-1")


class Passages:
    """Automaton over phrases of some passages, and their windows."""

    def __init__(self, texts: pa.Array, width: int):
        self.width, self.stride = width, width - PHRASE + 1
        self.words = split_words(texts)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for p in range(len(texts)):
            own = spaced(self.words, p)[1:-1].split(" ")
            for at in range(0, len(own) - PHRASE + 1, self.stride):
                self.automaton.add_word(" " + " ".join(own[at:at + PHRASE]) + " ")
        if len(self.automaton):
            self.automaton.make_automaton()
        starts = np.flatnonzero(whole_windows(self.words, width))
        hashes = long_window_hashes(self.words.hashes, width)[starts]
        order = np.argsort(hashes)
        self.windows, self.starts = hashes[order], starts[order]

    def cover(self, w: Words, i: int, hashes: np.ndarray) -> np.ndarray:
        """Words of text ``i`` that lie in a window which some passage has too.

        The automaton finds the phrases; windows over them are looked up by hash, and each run
        of windows that follow one another in a passage is compared word by word.
        """
        low, high = int(w.first[i]), int(w.first[i + 1])
        covered = np.zeros(high - low, bool)
        count = high - low - self.width + 1
        if count <= 0 or not len(self.windows):
            return covered
        ends = np.fromiter((end for end, _ in self.automaton.iter(spaced(w, i))), np.int64)
        if not len(ends):
            return covered
        after = np.cumsum(w.ends[low:high] - w.starts[low:high] + 1)
        begins = np.searchsorted(after, ends) - PHRASE + 1
        around = np.zeros(count + 1, np.int64)
        np.add.at(around, np.clip(begins - self.stride + 1, 0, count), 1)
        np.add.at(around, np.minimum(begins + 1, count), -1)
        found = hashes[low:low + count]
        place = np.minimum(np.searchsorted(self.windows, found), len(self.windows) - 1)
        hit = (np.cumsum(around)[:count] > 0) & (self.windows[place] == found)
        source = self.starts[place]
        follows = hit[1:] & hit[:-1] & (source[1:] == source[:-1] + 1)
        firsts = np.flatnonzero(hit & ~np.concatenate(([False], follows)))
        lasts = np.flatnonzero(hit & ~np.concatenate((follows, [False])))
        for a, b in zip(firsts.tolist(), lasts.tolist(), strict=True):
            at = int(source[a])
            if self.same(w, low + a, at, b - a + self.width):
                covered[a:b + self.width] = True
            else:
                for c in range(a, b + 1):
                    if self.same(w, low + c, at + c - a, self.width):
                        covered[c:c + self.width] = True
        return covered

    def same(self, w: Words, at: int, own: int, n: int) -> bool:
        """Whether ``n`` words of text and passage are the same, byte for byte."""
        v = self.words
        return (w.data[w.starts[at]:w.ends[at + n - 1]].tobytes().split()
                == v.data[v.starts[own]:v.ends[own + n - 1]].tobytes().split())


def removal(w: Words, i: int, covered: np.ndarray) -> tuple[str, str]:
    """Digest of the kept words, and the text without the covered words: a removed word takes
    the white space up to the next word with it."""
    low = int(w.first[i])
    keep = np.flatnonzero(~covered) + low
    parts = [w.data[w.starts[k]:w.ends[k]].tobytes() for k in keep] if covered.any() else (
        w.text_of(i).split())
    digest = hashlib.sha256(b" ".join(parts)).hexdigest()
    if not covered.any():
        return digest, w.text_of(i).decode()
    begin, stop = int(w.offsets[i]), int(w.offsets[i + 1])
    pieces, at = [], begin
    for a, b in runs(covered):
        pieces.append(w.data[at:w.starts[low + a]].tobytes())
        at = int(w.starts[low + b]) if low + b < int(w.first[i + 1]) else stop
    pieces.append(w.data[at:stop].tobytes())
    return digest, b"".join(pieces).decode()


def locate(width: int, columns: list[str]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(texts: pa.Table, passages: pa.Table) -> pa.Table:
        out = []
        known = Passages(passages.column("words").combine_chunks(), width)
        for batch in texts.combine_chunks().to_batches():
            for part in slices(batch, "text"):
                w = split_words(part.column("text"))
                hashes = long_window_hashes(w.hashes, width)
                counts, removed, digests, left = [], [], [], []
                for i in range(part.num_rows):
                    covered = known.cover(w, i, hashes)
                    digest, text = removal(w, i, covered)
                    counts.append(len(covered))
                    removed.append(int(covered.sum()))
                    digests.append(digest)
                    left.append(text)
                out.append(pa.table(
                    {c: part.column(c) for c in columns}
                    | {"text": pa.array(left, pa.string()),
                       "n_words": pa.array(counts, pa.int64()),
                       "n_removed": pa.array(removed, pa.int64()),
                       "kept_sha256": pa.array(digests, pa.string())}))
        empty = pa.schema([(c, texts.schema.field(c).type) for c in columns]
                          + [("text", pa.string()), ("n_words", pa.int64()),
                             ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
        return pa.concat_tables([t.cast(empty) for t in out]) if out else empty.empty_table()

    return run


def remove_repeats(docs: DataFrame, width: int = 35) -> DataFrame:
    """``docs`` with the words of repeated passages taken out of ``text``; ``width`` is 8 or
    more.

    A word goes if a window of ``width`` consecutive words over it has a word sequence that
    also starts anywhere else in the input, in the same text or another row. All other columns
    stay, whatever their names (but ``n_words``, ``n_removed``, ``kept_sha256`` are replaced:
    words before, words removed, and the SHA-256 of the kept words joined by one space). The
    new text keeps its other white space. A null text counts as empty and becomes empty. Equal
    rows repeat each other. No rows give none.
    """
    if width < PHRASE:
        raise ValueError(f"width must be at least {PHRASE}")
    others = [c for c in docs.columns
              if c not in ("text", "n_words", "n_removed", "kept_sha256")]
    inner = [f"c{i}" for i in range(len(others))]
    own = docs.select(
        *[F.col(f"`{c}`").alias(n) for c, n in zip(others, inner, strict=True)],
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = min(MAX_SHARDS, size // SHARD_BYTES + 1)
    own = own.withColumn("shard", F.pmod(F.xxhash64("text", *(
        [inner[others.index("doc_id")]] if "doc_id" in others else [])), F.lit(shards)))
    texts = own.select("shard", "text")

    found = written(texts.mapInArrow(phrase_rows(width), "phrase long, shard long")
                    .groupBy("phrase", "shard").agg(F.count("*").alias("n")), "phrases")
    often = found.groupBy("phrase").agg(F.sum("n").alias("n")).where("n > 1")
    recurring = written(found.drop("n").join(often, "phrase"), "recurring")

    def grouped(df: DataFrame):
        return df.groupBy("shard")

    areas = written(grouped(texts).cogroup(grouped(recurring.select("phrase", "shard")))
                    .applyInArrow(regions(width), "region long, words string, windows long"),
                    "regions", "zstd")
    windows = areas.agg(F.sum("windows")).first()[0] or 0
    rounds = max(1, -int(-windows * WINDOW_BYTES // max(1, size * ROUND_SHARE)))
    buckets = rounds * (windows // (BUCKET_WINDOWS * rounds) + 1)
    common = np.sort(np.array([r.phrase for r in recurring.where(
        F.col("n") > max(COMMON, windows >> 20)).select("phrase").distinct().collect()],
        np.int64).view(np.uint64))
    homes = [written(areas.select("region", "words").mapInArrow(
        region_windows(width, common, buckets, rounds, now), FOUND)
        .groupBy("bucket").applyInArrow(confirm, HOMES), "homes", "zstd")
        for now in range(rounds)]
    shard = F.shiftright("region", REGION_BITS + POSITION_BITS).alias("shard")
    passages = written(
        grouped(areas.select("region", "words", shard))
        .cogroup(grouped(reduce(DataFrame.unionAll, homes).select("*", shard)))
        .applyInArrow(cut_passages(width), "words string, shards array<int>"), "passages", "zstd")
    sent = passages.select(F.explode("shards").alias("shard"), "words").withColumn(
        "shard", F.col("shard").cast("long"))

    result = T.StructType([own.schema[n] for n in inner] + [
        T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())])
    done = grouped(own).cogroup(grouped(sent)).applyInArrow(locate(width, inner), result)
    return done.select(*[F.col(n).alias(c) for c, n in zip(others, inner, strict=True)],
                       "text", "n_words", "n_removed", "kept_sha256")
