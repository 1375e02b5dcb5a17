"""SimHash near-duplicates: meet-in-the-middle ball hashing.

A fingerprint is 64 majority votes over the XXH64 hashes of a text's word shingles. Two
fingerprints that differ in at most ``2 * RADIUS`` bits have a number between them that is at
most ``RADIUS`` bits from each, so both emit it if each emits its whole ball: all variants with
up to ``RADIUS`` bits changed. By the triangle inequality the reverse holds too: whoever meets
in a variant is within ``2 * RADIUS`` bits. A variant's group is therefore linked as a chain, never
as all of its pairs, and connectivity stays exact.

Variants are not shuffled one by one. The first ``k`` bits of a variant are its bucket; a
fingerprint goes once to each bucket that holds some of its variants, and the task of the
bucket writes the variants out, sorts them and links what collides. ``k`` follows the number of
distinct fingerprints. Buckets with too many variants are told apart by further bits before
they are shuffled, until none is too large; every fingerprint keeps all of its variants.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom.llm.components import components
from contactloom.llm.store import written
from contactloom.llm.words import slices

BITS, RADIUS, SEED = 64, 2, 42
# Fingerprints to a bucket, variants that one task holds at a time, and bits by which larger
# buckets are told apart.
BUCKET_ROWS, BUCKET_VARIANTS, STEP_BITS = 256, 2_000_000, 6
HASHES = 1 << 16


def shingle_hashes(words: list[bytes], width: int) -> Iterator[np.ndarray]:
    """XXH64 of every run of ``width`` words joined by spaces, in pieces; of the whole sequence
    if it is shorter."""
    line = b" ".join(words)
    width = min(width, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))[:len(words) - width + 1]
    ends = ends[width - 1:]
    digest = xxhash.xxh64_intdigest
    for i in range(0, len(begins), HASHES):
        yield np.array([digest(line[a:b], SEED) for a, b in zip(
            begins[i:i + HASHES].tolist(), ends[i:i + HASHES].tolist(), strict=True)],
            np.uint64)


def majority(text: bytes, width: int) -> np.ndarray:
    """64 flags, highest bit first: whether over half of the hashes have the bit."""
    words = text.lower().split()  # bytes: A-Z only, blanks are 0x20 and 0x09-0x0D
    ones, n = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(words, width) if words else ():
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        for i in range(0, len(bits), 255):
            ones += bits[i:i + 255].sum(axis=0, dtype=np.uint8)
        n += len(hashes)
    return 2 * ones > n


def sign(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                flags = np.array([majority((t.as_py() or "").encode(), width)
                                  for t in batch.column("text")], bool)
                prints = np.packbits(flags, axis=1).view(">u8")[:, 0].astype(np.uint64)
                yield pa.record_batch({"doc_id": batch.column("doc_id"),
                                       "print": pa.array(prints.view(np.int64))})

    return run


def fingerprints(docs: DataFrame, width: int = 5) -> DataFrame:
    """``doc_id, print`` for each row of ``docs(doc_id, text)``; ``print`` is the fingerprint as
    a signed 64-bit number, zero for null, empty and wordless texts."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        sign(width), "doc_id long, print long")


def flips(bits: int, most: int = RADIUS) -> list[int]:
    """All numbers below ``2 ** bits`` with at most ``most`` ones."""
    return [sum(1 << p for p in places) for r in range(most + 1)
            for places in combinations(range(bits), r)]


def changed(bucket: str, bits: int) -> Column:
    """In how many of its first ``bits`` bits the variants of a bucket differ from a print."""
    return F.bit_count(F.shiftrightunsigned("print", BITS - bits).bitwiseXOR(F.col(bucket)))


def spread(prints: DataFrame, bits: int) -> DataFrame:
    """``bucket, print``: a row for each bucket that holds variants of a print."""
    own = F.shiftrightunsigned("print", BITS - bits)
    near = F.transform(F.lit(flips(bits)), lambda m: own.bitwiseXOR(m.cast("long")))
    return prints.select(F.explode(near).alias("bucket"), "print")


def refined(rows: DataFrame, bits: int, more: int) -> DataFrame:
    """The same variants in buckets of ``bits + more`` bits."""
    after = F.shiftrightunsigned("print", BITS - bits - more).bitwiseAND(
        F.lit((1 << more) - 1))
    left = rows.withColumn("left", F.lit(RADIUS) - changed("bucket", bits))
    return (left.select("*", F.explode(F.lit(flips(more))).alias("m"))
            .where(F.bit_count(F.col("m").cast("long")) <= F.col("left"))
            .select(F.shiftleft("bucket", more).bitwiseOR(
                after.bitwiseXOR(F.col("m").cast("long"))).alias("bucket"), "print"))


def n_variants(bits: int) -> Column:
    """Variants of a row's print in its bucket."""
    rest = BITS - bits
    sizes = [sum(comb(rest, r) for r in range(left + 1)) for left in range(RADIUS, -1, -1)]
    return F.get(F.lit(sizes), changed("bucket", bits)).cast("long")


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node reachable from each of ``n`` nodes over links a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        after = label.copy()
        for at in (label[a], label[b], a, b):
            np.minimum.at(after, at, low)
        after = after[after]
        if np.array_equal(after, label):
            return label
        label = after


def collisions(prints: np.ndarray, bucket: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (root, print) that connect all prints that share a variant inside the bucket."""
    rest = BITS - bits
    own = prints >> np.uint64(rest) if rest < BITS else np.zeros_like(prints)
    used = np.bitwise_count(own ^ np.uint64(bucket))
    low = prints & np.uint64((1 << rest) - 1)
    variants, owners = [], []
    for left in range(RADIUS + 1):
        who = np.flatnonzero(used == RADIUS - left)
        masks = np.array(flips(rest, left), np.uint64)
        variants.append((low[who, None] ^ masks[None, :]).reshape(-1))
        owners.append(np.repeat(who, len(masks)))
    variant, owner = np.concatenate(variants), np.concatenate(owners)
    order = np.argsort(variant)
    variant, owner = variant[order], owner[order]
    meet = np.flatnonzero(variant[1:] == variant[:-1])
    if not len(meet):
        return prints[:0], prints[:0]
    pairs = np.unique(np.sort(np.stack([owner[meet], owner[meet + 1]]), axis=0), axis=1)
    root = roots(len(prints), *pairs)
    linked = np.flatnonzero(root != np.arange(len(prints)))
    return prints[root[linked]], prints[linked]


def link_buckets(bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(bucket: int, parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            prints = np.unique(np.concatenate(parts))
            if len(prints) > 1:
                a, b = collisions(prints, bucket, bits)
                if len(a):
                    yield pa.record_batch({"a": pa.array(a.view(np.int64)),
                                           "b": pa.array(b.view(np.int64))})

        open_bucket, parts = None, []
        for batch in batches:
            buckets = batch.column("bucket").to_numpy().view(np.uint64)
            prints = batch.column("print").to_numpy().view(np.uint64)
            cuts = np.flatnonzero(buckets[1:] != buckets[:-1]) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(buckets)], strict=True):
                if a == b:
                    continue
                if open_bucket != int(buckets[a]):
                    if parts:
                        yield from linked(open_bucket, parts)
                    open_bucket, parts = int(buckets[a]), []
                parts.append(prints[a:b].copy())
        if parts:
            yield from linked(open_bucket, parts)

    return run


def ball_links(prints: DataFrame, bits: int, most: int = BUCKET_VARIANTS) -> DataFrame:
    """``a, b``: links that connect all distinct ``prints(print)`` within ``2 * RADIUS`` bits."""
    found, rows = [], spread(prints, bits)
    while True:
        large = written(rows.groupBy("bucket").agg(F.sum(n_variants(bits)).alias("n"))
                        .where(F.col("n") > most).select("bucket"), "large")
        some = not large.isEmpty()
        small = rows.join(large, "bucket", "left_anti") if some else rows
        found.append(written(
            small.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
                link_buckets(bits), "a long, b long"), "ball"))
        if not some:
            return reduce(DataFrame.union, found)
        more = min(STEP_BITS, BITS - bits)
        rows = written(refined(rows.join(large, "bucket", "left_semi"), bits, more), "refined")
        bits += more


def bucket_bits(n: int) -> int:
    """Bits of a bucket for ``n`` distinct fingerprints."""
    return min(BITS // 2, max(4, (n // BUCKET_ROWS).bit_length()))


def simhash_duplicates(docs: DataFrame, width: int = 5) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row of ``docs(doc_id, text)``.

    Words are runs of other characters than 0x20 and 0x09-0x0D, A-Z in small letters; texts with
    fewer than ``width`` words have one shingle. Fingerprints (16 hexadecimal digits) are linked at
    ``2 * RADIUS`` differing bits or fewer; ``component_id`` is the smallest doc_id reachable,
    the row's own included. Null, empty and wordless texts have the fingerprint zero and are
    linked like any other. Rows with equal doc_id are rows of their own; a null doc_id links
    like any other, but a component takes its name from ids that are not null, if it has any.
    Extra columns are ignored. No rows give none.
    """
    signed = written(fingerprints(docs, width), "signed")
    prints = written(signed.groupBy("print").agg(F.min("doc_id").alias("lowest")), "prints")
    links = ball_links(prints.select("print"), bucket_bits(prints.count()))
    found = components(links).withColumnRenamed("node", "print")
    placed = prints.join(found, "print", "left").select(
        "print", "lowest", F.coalesce("component", "print").alias("component"))
    names = placed.groupBy("component").agg(F.min("lowest").alias("component_id"))
    named = placed.join(names, "component").select("print", "component_id")
    return signed.join(named, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id")
