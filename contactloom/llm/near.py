"""Near-duplicates: MinHash signatures, a multi-index Hamming join, exact confirmation.

A document's word shingles give two signatures. The index signature has 50 MinHash symbols
in 10 chunks of 5. By pigeonhole two signatures that differ in fewer than 20 places agree in
at least one chunk up to one place, so a row for each chunk and each place left out finds
every such pair; at a similarity of 0.8 a chunk has two or more errors with probability
0.263, all ten chunks with 1.6e-6. The distance signature has 2048 bits, one for each of 2048
further MinHashes; at similarity 0.8 a bit differs with probability 0.1, and pairs up to the
distance five standard deviations above that mean (273) go on to be confirmed on their full
shingle sets. No partner or bucket is capped.

Large groups: equal sets are one node. In a bucket each node is first compared with one hub
only, the one of smallest doc_id, as originals tend to come before their copies; confirmed
links give provisional components. What is left are pairs of nodes in one
bucket but in different components, with one of them outside the hub's component; these are
joined, each pair in the first bucket that it shares, and only those within the distance
become rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom.llm.components import components
from contactloom.llm.store import written
from contactloom.llm.words import mix, slices, split_words, window_hashes

CHUNKS, CHUNK = 10, 5
BITS = 2048
_rng = np.random.default_rng(75)
_MULT = _rng.integers(0, 2**64, CHUNKS * CHUNK + BITS, dtype=np.uint64) | np.uint64(1)
_ADD = _rng.integers(0, 2**64, CHUNKS * CHUNK + BITS, dtype=np.uint64)
NO_ID = -(2**63)


def distance_limit(similarity: float, sigmas: float = 5.0) -> int:
    """Largest bit distance of the pairs that are confirmed."""
    p = (1 - similarity) / 2
    return ceil(BITS * p + sigmas * sqrt(BITS * p * (1 - p)))


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one after another, and where each begins.

    Words are lower-cased (A-Z). A text of 1 to ``width - 1`` words has one shingle, its whole
    sequence; a text without words has none.
    """
    w = split_words(texts, lower=True)
    grams = window_hashes(w.hashes, width)
    sets, sizes = [], np.zeros(len(w.first), np.int64)
    for i in range(len(w.first) - 1):
        a, b = int(w.first[i]), int(w.first[i + 1])
        if b - a >= width:
            one = np.unique(grams[a:b - width + 1])
        elif b > a:
            one = window_hashes(w.hashes[a:b], b - a) ^ np.uint64(b - a)
        else:
            continue
        sets.append(one)
        sizes[i + 1] = len(one)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), np.cumsum(sizes)


def minima(values: np.ndarray, begins: np.ndarray, which: range) -> np.ndarray:
    """MinHash values: a row for each hash function, a column for each non-empty set."""
    out = np.empty((len(which), len(begins)), np.uint64)
    for row, j in enumerate(which):
        out[row] = np.minimum.reduceat(values * _MULT[j] + _ADD[j], begins)
    return out


def index_keys(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """``CHUNKS * CHUNK`` bucket keys of each set: a chunk with one place left out."""
    symbols = mix(minima(values, begins, range(CHUNKS * CHUNK)))
    keys = np.empty((len(begins), CHUNKS * CHUNK), np.int64)
    for c in range(CHUNKS):
        part = symbols[c * CHUNK:(c + 1) * CHUNK]
        for out in range(CHUNK):
            h = np.full(len(begins), c * CHUNK + out + 1, np.uint64)
            for place in range(CHUNK):
                if place != out:
                    h = mix(h * np.uint64(31) + part[place])
            keys[:, c * CHUNK + out] = h.view(np.int64)
    return keys


def distance_words(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The bit signature of each set as ``BITS / 64`` integers."""
    out = np.zeros((len(begins), BITS // 64), np.uint64)
    for j in range(BITS):
        low = mix(minima(values, begins, range(CHUNKS * CHUNK + j, CHUNKS * CHUNK + j + 1)))[0]
        out[:, j // 64] |= (low & np.uint64(1)) << np.uint64(j % 64)
    return out.view(np.int64)


def digest(one: np.ndarray) -> bytes:
    return hashlib.blake2b(one.tobytes(), digest_size=16).digest()


def long_lists(rows: np.ndarray) -> pa.Array:
    n, width = rows.shape
    return pa.ListArray.from_arrays(
        pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(rows.reshape(-1), pa.int64()))


def sign(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                values, at = shingle_sets(batch.column("text"), width)
                sizes = np.diff(at)
                full = np.flatnonzero(sizes)
                keys = (index_keys(values, at[full]) if len(full)
                        else np.zeros((0, CHUNKS * CHUNK), np.int64))
                place = np.full(len(sizes), -1, np.int64)
                place[full] = np.arange(len(full))
                pick = pa.array(place, mask=place < 0)
                yield pa.record_batch({
                    "id": batch.column("id"),
                    "text_key": batch.column("text_key"),
                    "n_shingles": pa.array(sizes),
                    "node": pa.array([digest(values[at[i]:at[i + 1]]) if sizes[i] else None
                                      for i in range(len(sizes))], pa.binary()),
                    "keys": long_lists(keys).take(pick)})

    return run


def full_sets(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                values, at = shingle_sets(batch.column("text"), width)
                full = np.flatnonzero(np.diff(at))
                if not len(full):
                    continue
                sets = [values[at[i]:at[i + 1]] for i in full]
                yield pa.record_batch({
                    "node": pa.array([digest(s) for s in sets], pa.binary()),
                    "bits": long_lists(distance_words(values, at[full])),
                    "shingles": pa.array([s.tobytes() for s in sets], pa.binary())})

    return run


def confirm(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Keep pairs with 100 * intersection >= percent * union of their full sets."""
    def linked(one: bytes, other: bytes) -> bool:
        x, y = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
        both = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * both >= percent * (len(x) + len(y) - both)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [linked(x.as_buffer(), y.as_buffer()) for x, y in zip(
                batch.column("shingles"), batch.column("other"), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def distance(x: str, y: str) -> Column:
    parts = [F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i))))
             for i in range(BITS // 64)]
    return sum(parts[1:], parts[0])


def first_shared(x: str, y: str) -> Column:
    """Zero-based place of the first equal bucket key."""
    return F.array_position(F.zip_with(x, y, lambda p, q: p == q), F.lit(True)) - 1


def labelled(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``id, text_key, n_shingles, component, component_id`` for each row; ``id`` is ``NO_ID`` for
    null, ``component`` is null for texts without words."""
    limit = distance_limit(percent / 100)
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
                        F.xxhash64(F.col("text").cast("string")).alias("text_key"),
                        F.col("text").cast("string").alias("text"))
    signed = written(texts.mapInArrow(
        sign(width), "id long, text_key long, n_shingles long, node binary, keys array<long>"), "signed")
    nodes = written(
        signed.where("node IS NOT NULL").groupBy("node")
        .agg(F.min(F.when(F.col("id") != NO_ID, F.col("id"))).alias("lowest"),
             F.first("keys").alias("keys"))
        .withColumn("id", F.coalesce("lowest", F.lit(NO_ID))), "nodes")

    rows = nodes.select("id", "node", F.posexplode("keys").alias("bucket", "key"))
    shared = (rows.groupBy("key").agg(F.min(F.struct("id", "node")).alias("first"),
                                      F.count("*").alias("n"))
              .where("n > 1").select("key", F.col("first.node").alias("hub")))
    members = written(rows.drop("id").join(shared, "key"), "members")
    wanted = members.select("node").distinct().join(nodes.select("node", "id"), "node")
    sets = written(
        texts.drop("text_key").join(wanted.select("id").distinct(), "id").mapInArrow(
            full_sets(width), "node binary, bits array<long>, shingles binary")
        .join(wanted.select("node"), "node", "left_semi")
        .groupBy("node").agg(F.first("bits").alias("bits"),
                             F.first("shingles").alias("shingles")), "sets")
    bits = sets.select("node", "bits")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) within the distance, confirmed on their full sets."""
        left = sets.select(F.col("node").alias("a"), "shingles")
        right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("other"))
        return pairs.join(left, "a").join(right, "b").mapInArrow(
            confirm(percent), "a binary, b binary")

    spokes = (members.where("node <> hub").select(F.col("hub").alias("a"),
                                                  F.col("node").alias("b")).distinct()
              .join(bits.select(F.col("node").alias("a"), F.col("bits").alias("x")), "a")
              .join(bits.select(F.col("node").alias("b"), F.col("bits").alias("y")), "b")
              .where(distance("x", "y") <= limit).select("a", "b"))
    links = written(confirmed(spokes), "links")
    found = components(links)

    def part(name: str) -> Column:
        return F.coalesce("component", F.col(name))

    placed = (members.join(found.withColumnRenamed("node", "hub"), "hub", "left")
              .withColumn("main", part("hub")).drop("component", "hub")
              .join(found, "node", "left").withColumn("part", part("node")).drop("component"))
    placed = written(placed, "placed")
    aside = placed.where("part <> main")
    sketch = written(bits.join(nodes.select("node", "keys"), "node"), "sketch")
    left = (aside.select("key", "bucket", F.col("node").alias("a"), F.col("part").alias("pa"))
            .join(sketch.select(F.col("node").alias("a"), F.col("bits").alias("x"),
                                F.col("keys").alias("xs")), "a"))
    right = (placed.join(aside.select("key").distinct(), "key", "left_semi")
             .select(F.col("key").alias("other_key"), F.col("node").alias("b"),
                     F.col("part").alias("pb"),
                     (F.col("part") != F.col("main")).alias("aside"))
             .join(sketch.select(F.col("node").alias("b"), F.col("bits").alias("y"),
                                 F.col("keys").alias("ys")), "b"))
    rest = left.join(right,
                     (F.col("key") == F.col("other_key")) & (F.col("pa") != F.col("pb"))
                     & (~F.col("aside") | (F.col("a") < F.col("b")))
                     & (distance("x", "y") <= limit)
                     & (first_shared("xs", "ys") == F.col("bucket")))
    more = written(confirmed(rest.select("a", "b").distinct()), "links")
    joined = components(found.select(F.col("node").alias("a"), F.col("component").alias("b"))
                        .union(more))

    named = nodes.join(joined, "node", "left").select(
        "node", "lowest", F.coalesce("component", "node").alias("component"))
    # Written, so that the join meets plain shuffles and a large component can be split.
    names = written(
        named.groupBy("component").agg(F.min("lowest").alias("component_id")), "names")
    of_node = named.join(names, "component").select("node", "component", "component_id")
    return signed.drop("keys").join(of_node, "node", "left").drop("node")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, text_key, n_shingles, component_id, kept`` for each row of
    ``docs(doc_id, text)``; ``text_key`` is a hash of the text.

    Rows are linked if 100 * (common shingles) >= percent * (all shingles of both);
    ``component_id`` is the smallest doc_id reachable over links, ``kept`` whether that is the
    row's own. Null or wordless texts link with nothing and stay. Rows with equal doc_id are
    rows of their own; a null doc_id links like any other, but a component takes its name
    from ids that are not null, if it has any. Extra columns are ignored. No rows give none.
    """
    own = F.when(F.col("id") != NO_ID, F.col("id"))
    return labelled(docs, width, percent).select(
        own.alias("doc_id"), "text_key", "n_shingles",
        F.when(F.col("component").isNull(), own)
        .otherwise(F.col("component_id")).alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates and all columns: the row of
    smallest doc_id, nulls last, and of equal ids the one whose text has the least hash.

    Texts without words are in no group. They all stay, but of rows equal in doc_id and text one
    stays, null ids and texts included. No rows give none.
    """
    alone = F.concat(F.lit("text without words "), "id", F.lit(" "), F.coalesce(
        "text_key", F.lit(0)))  # longer than any component's name
    first = F.min(F.struct((F.col("id") == NO_ID).alias("last"), "id", "text_key"))
    kept = (labelled(docs, width, percent)
            .groupBy(F.coalesce("component", F.encode(alone, "utf-8")).alias("group"))
            .agg(first.alias("first"))
            .select(F.col("first.id").alias("_id"), F.col("first.text_key").alias("_key")))
    keyed = docs.withColumns({
        "_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)),
        "_key": F.xxhash64(F.col("text").cast("string"))})
    return (keyed.join(kept, ["_id", "_key"], "left_semi")
            .dropDuplicates(["_id", "_key"]).drop("_id", "_key"))
