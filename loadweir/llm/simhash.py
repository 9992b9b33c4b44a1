"""Near-duplicates by 64-bit SimHash fingerprints, joined by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``2 h`` bits have a common variant within ``h`` bits of both.
Every distinct fingerprint emits all its variants within ``h`` bits; those that share a variant meet
in one place, are at most ``2 h`` bits apart, and are linked. The variants are dealt out in rounds by
a linear code of their bits: a round emits only the flips that lead into its class, so no variant is
made twice and the disk holds one round at a time. A cheap round of single flips comes first; what it
and each later fold have joined travels along as a root, and a place links roots that differ only, by
a forest, so that a group of n fingerprints near each other makes rows in proportion to n.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations, repeat
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadweir.llm.common import forget, staged, tidy_shuffles
from loadweir.llm.components import components
from loadweir.session import shared_dir

BITS = 64
SEED = 42
#: Bits of the code that deals variants to rounds: 2 ** 3 rounds.
ROUND_BITS = 3
#: Variants that one bucket gets in a round, about.
BUCKET_VARIANTS = 1_000_000
#: Fingerprints whose variants of a round are made at once.
CHUNK = 4_000


def fingerprint(text: str | None, width: int) -> int:
    """The unsigned fingerprint of a text's shingles of ``width`` words, each as often as it stands.

    A-Z in lower case; words are separated by ASCII blanks. Fewer words than ``width`` are one
    shingle; no words (null, empty, blank): 0. A bit is 1 if it is in over half of the hashes.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    if len(words) <= width:
        return digest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    begins = np.concatenate([[0], ends[:-1]])[: len(words) - width + 1].tolist()
    shingles = [joined[a:b] for a, b in zip(begins, (ends[width - 1 :] - 1).tolist())]
    hashes = np.fromiter(map(digest, shingles, repeat(SEED)), "<u8", len(shingles))
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    over = 2 * bits.sum(axis=0, dtype=np.int32) > len(hashes)
    return int(np.packbits(over, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """``key`` and ``fp``, the fingerprint's 64 bits as a long, for every row."""
    schema = T.StructType([docs.schema[key], T.StructField("fp", T.LongType(), False)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, width) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], [key, "fp"])

    return docs.select(key, text).mapInArrow(run, schema)


def _flips(half: int) -> list[np.ndarray]:
    """All sets of at most ``half`` bits as masks, by the code of the round they lead to.

    The code of a fingerprint is linear: the places of its bits, modulo the number of rounds, joined
    by exclusive or. So flipping a mask's bits changes the code by the mask's own code.
    """
    by_code: list[list[int]] = [[] for _ in range(1 << ROUND_BITS)]
    for k in range(half + 1):
        for places in combinations(range(BITS), k):
            code = 0
            for p in places:
                code ^= p % (1 << ROUND_BITS)
            by_code[code].append(sum(1 << p for p in places))
    return [np.array(masks, np.uint64) for masks in by_code]


def _codes(fps: np.ndarray) -> np.ndarray:
    codes = np.zeros(len(fps), np.int64)
    for b in range(ROUND_BITS):
        mask = np.uint64(sum(1 << j for j in range(BITS) if j >> b & 1))
        codes |= (np.bitwise_count(fps & mask).astype(np.int64) & 1) << b
    return codes


def _bucket(variants: np.ndarray, buckets: int) -> np.ndarray:
    mixed = (variants * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    return (mixed % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)


def _emit(turn: int | None, half: int, buckets: int):
    """The variants of one round (of all if None), packed into one row for each bucket and chunk.

    A variant comes with the number of its mask, which gives its fingerprint back, and with its root
    where that is another one.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips = _flips(half)
        firsts = np.cumsum([0, *map(len, flips)])
        everything = np.concatenate(flips)
        for batch in batches:
            whole, known = (batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (0, 1))
            for start in range(0, len(whole), CHUNK):
                fps, roots = whole[start : start + CHUNK], known[start : start + CHUNK]
                codes = _codes(fps)
                found = []
                for code in range(len(flips)) if turn is not None else [None]:
                    of = codes == code if code is not None else np.ones(len(fps), bool)
                    masks = everything if code is None else flips[code ^ turn]
                    first = 0 if code is None else firsts[code ^ turn]
                    numbers = np.arange(first, first + len(masks), dtype=np.uint16)
                    found.append(
                        (
                            np.bitwise_xor.outer(fps[of], masks).ravel(),
                            np.tile(numbers, int(of.sum())),
                            np.repeat(roots[of], len(masks)),
                            np.repeat(roots[of] != fps[of], len(masks)),
                        )
                    )
                variants, numbers, owners, joined = map(np.concatenate, zip(*found))
                bucket = _bucket(variants, buckets)
                order = np.argsort(bucket, kind="stable")
                variants, numbers, owners, joined = (x[order] for x in (variants, numbers, owners, joined))
                ends = np.cumsum(np.bincount(bucket, minlength=buckets))
                rows = [(i, a, b) for i, (a, b) in enumerate(zip([0, *ends[:-1]], ends)) if b > a]
                packed = [
                    [variants[a:b].tobytes() for _, a, b in rows],
                    [numbers[a:b].tobytes() for _, a, b in rows],
                    [np.packbits(joined[a:b]).tobytes() for _, a, b in rows],
                    [owners[a:b][joined[a:b]].tobytes() for _, a, b in rows],
                ]
                columns = [pa.array([i for i, _, _ in rows], pa.int32()), *(pa.array(x, pa.binary()) for x in packed)]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "variants", "masks", "joined", "roots"])

    return run


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least node that links reach, and the node, for every node that is not the least itself."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = places[: len(a)], places[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if np.array_equal(new, label):
            other = label != np.arange(len(nodes))
            return nodes[label[other]], nodes[other]
        label = new


def _collide(radius: int, half: int):
    """A forest of the roots in a bucket whose fingerprints share a variant, each link checked against ``radius``."""

    def run(table: pa.Table) -> pa.Table:
        everything = np.concatenate(_flips(half))
        packed = [table.column(c).to_pylist() for c in ("variants", "masks", "joined", "roots")]
        variants = np.frombuffer(b"".join(packed[0]), np.uint64)
        fps = variants ^ everything[np.frombuffer(b"".join(packed[1]), np.uint16)]
        joined = [np.unpackbits(np.frombuffer(j, np.uint8), count=len(v) // 8) for v, j in zip(packed[0], packed[2])]
        roots = fps.copy()
        roots[np.concatenate(joined).view(bool)] = np.frombuffer(b"".join(packed[3]), np.uint64)
        ordered = np.sort(variants)
        shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        place = np.searchsorted(shared, variants)
        place[place == len(shared)] = 0
        met = np.flatnonzero(shared[place] == variants) if len(shared) else np.zeros(0, np.int64)
        v, f, r = variants[met], fps[met], roots[met].view(np.int64)
        order = np.lexsort((r, v))
        v, f, r = v[order], f[order], r[order]
        # those that share a variant are all near each other: a chain through their roots is enough
        at = np.flatnonzero((v[1:] == v[:-1]) & (r[1:] != r[:-1]))
        at = at[np.bitwise_count(f[at] ^ f[at + 1]) <= radius]
        a, b = _forest(r[at], r[at + 1])
        return pa.table({"a": pa.array(a), "b": pa.array(b)})

    return run


def linked(distinct: DataFrame, radius: int = 4) -> DataFrame:
    """``fp``, ``root``: the least fingerprint that links within ``radius`` bits reach, for each of ``distinct``.

    ``distinct`` has a column ``fp``, each once. Variants travel packed, a row for each bucket and
    chunk; the number of buckets grows with the input, so that a bucket holds
    :data:`BUCKET_VARIANTS`. After the round of single flips, the first of the full rounds and the
    last, links are folded into the roots, and their tables deleted.
    """
    if radius % 2 or not 0 < radius <= 6:
        raise ValueError("the radius is 2, 4 or 6")
    spark, half = distinct.sparkSession, radius // 2
    least, rows = int(spark.conf.get("spark.sql.shuffle.partitions")), distinct.count()
    turns = [(half, turn) for turn in range(1 << ROUND_BITS)]
    roots = staged(distinct.select("fp", F.col("fp").alias("root")), "roots")
    for several in ([[(1, None)]] if half > 1 else []) + [turns[:1], turns[1:]]:
        paths = []
        for flips, turn in several:
            each = sum(comb(BITS, k) for k in range(flips + 1)) >> (0 if turn is None else ROUND_BITS)
            buckets = max(least, rows * each // BUCKET_VARIANTS + 1)
            schema = "bucket int, variants binary, masks binary, joined binary, roots binary"
            packed = roots.mapInArrow(_emit(turn, flips, buckets), schema)
            paths.append(shared_dir(spark, "links"))
            met = packed.groupBy("bucket").applyInArrow(_collide(2 * flips, flips), "a long, b long")
            met.write.parquet(paths[-1])
        edges = spark.read.schema("a long, b long").parquet(*paths)
        found = components(edges).select(F.col("node").alias("root"), F.col("root").alias("over"))
        before, roots = roots, staged(roots.join(found, "root", "left").select("fp", F.coalesce("over", "root").alias("root")), "roots")
        forget(spark, before, *paths)
    return roots


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, radius: int = 4
) -> DataFrame:
    """``key``, ``fp`` and ``component_id``, the smallest key that links reach, for every row.

    Links join rows whose fingerprints differ in at most ``radius`` bits. Rows without words have
    fingerprint 0 and are linked like any other. Repeated rows come back as often as they came. A
    null key is never the smallest; a component of null keys alone has a null id. Other columns play
    no part; ``key`` may be a struct, which is compared field by field.
    """
    spark = docs.sparkSession
    with tidy_shuffles(spark):
        marked = staged(fingerprints(docs, key, text, width), "fingerprints")
        distinct = staged(marked.groupBy("fp").agg(F.min(key).alias("first")), "distinct")
        roots = linked(distinct.select("fp"), radius)
        named = distinct.join(roots, "fp")
        smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
        named = staged(named.join(smallest, "root").select("fp", "component_id"), "named")
        found = staged(marked.join(named, "fp").select(key, "fp", "component_id"), "near-duplicates")
        forget(spark, marked, distinct, roots, named)
        return found


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, radius: int = 4) -> DataFrame:
    """``docs`` with one row of each component of near-duplicates: that of the smallest ``key``; columns as they are.

    Components are those of :func:`near_duplicates`: fingerprints of the shingles of ``width`` words
    within ``radius`` bits. Rows without words (null, empty, blank) have one fingerprint and so are
    copies of each other. Of repeated rows one stays. A null key is the largest.
    """
    spark, row = docs.sparkSession, "row_of_" + "_".join(docs.columns)
    numbered = staged(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    # nulls come last in the order of the smallest
    order = F.struct(F.col(f"`{key}`").isNull().alias("none"), F.col(f"`{key}`").alias("id"), F.col(f"`{row}`").alias("n"))
    found = near_duplicates(numbered.select(order.alias("key"), F.col(f"`{text}`").alias("text")), "key", "text", width, radius)
    gone = staged(found.where("key <> component_id").select(F.col("key.n").alias(row)), "gone")
    forget(spark, found)
    return numbered.join(gone, row, "left_anti").drop(row)
