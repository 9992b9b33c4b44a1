"""Jaccard join of n-gram sets: rare-first prefix filtering with length, positional and suffix filters.

A text's set holds the hashes of its distinct n-grams. All sets are put in one order, rare n-grams
first. Of two sets similar by ``percent`` both have their first common n-gram among their first
``s - ceil(percent * s / 100) + 1`` ones, so they meet there, and nowhere else need be looked for.

* Counts are of the whole corpus. Parts of about :data:`PART_BYTES` send each distinct n-gram once,
  with its number of sets, packed by bucket; a bucket adds up and sends back one byte for each, the
  logarithm of the count. A set that has more n-grams of its own than its prefix is long can be similar
  to no other one, and stays behind; n-grams that no other set has are in no entry.
* An entry is a prefix n-gram with the set's size, the n-gram's place, and how many n-grams lie behind
  it in each of :data:`RANGES` ranges of their hashes. Sets that meet are held against the length
  filter (sizes), the positional one (what is left behind both places) and the suffix one (the ranges
  differ by at least so much), and then compared whole, each pair once.
* Components are wanted, not all pairs. In each round the sets of an n-gram are compared with some of
  them, eight times as many as in the round before, unless links have joined them already; those then leave.
  It ends when no n-gram has two sets that were neither compared nor joined, so no link between
  different components is lost, and a group of near copies is joined without all of its pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadweir.llm.common import blocks_for, flat, forget, pack, slices, small_batches, staged, tidy_shuffles
from loadweir.llm.components import ONE_TASK, components, in_one_task

#: Bytes of text in a part, about.
PART_BYTES = 8 << 20
#: Bytes of text whose n-grams one bucket counts, about.
BUCKET_BYTES = 16 << 20
#: Words whose hashes a part keeps at hand.
KNOWN_WORDS = 1 << 16
#: Ranges of hashes by which the suffix filter counts, a power of two.
RANGES = 8
#: How many times as many sets are compared with in each round.
GROWTH = 8
#: Factors of the hash of an n-gram: the words' hashes in a polynomial, and the finaliser of splitmix64.
STEP, MIX_1, MIX_2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * MIX_1
    h = (h ^ (h >> np.uint64(27))) * MIX_2
    return h ^ (h >> np.uint64(31))


def ngram_set(text: str | None, width: int, known: dict | None = None) -> np.ndarray:
    """The sorted hashes of a text's distinct n-grams of ``width`` words, A-Z in lower case.

    Words are separated by ASCII blanks. Fewer words than ``width`` are one n-gram; no words (null,
    empty, blank) give an empty set.
    """
    known = _WordHashes() if known is None else known
    words = (text or "").encode().lower().split()
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    if not width:
        return hashes
    count, total = len(words) - width + 1, np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        total = total * STEP + hashes[i : i + count]
    return np.unique(_mixed(total))


def _eligible(size: int, percent: int) -> bool:
    """Whether a set of that size can be similar to a different one."""
    return 100 * size >= percent * (size + 1)


def _prefix(size: int, percent: int) -> int:
    return size + percent * -size // 100 + 1


def _part_keys(sets: list[np.ndarray], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of a part's n-grams, a bucket and 32 bits each, and in how many sets they are."""
    if not sets:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.unique(_keys(np.concatenate(sets), buckets), return_counts=True)


def _keys(hashes: np.ndarray, buckets: int) -> np.ndarray:
    low = np.uint64(32)
    return ((hashes >> low) % np.uint64(buckets)) << low | (hashes & np.uint64(0xFFFFFFFF))


def _send(width: int, percent: int, buckets: int):
    """A part's distinct n-grams, one row for each bucket."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in zip(batch.column(0).to_pylist(), batch.column(1)):
                known, sets = _WordHashes(), {}
                for text in texts.values:
                    found = ngram_set(text.as_py(), width, known)
                    if _eligible(len(found), percent):
                        sets[xxhash.xxh3_128_digest(found)] = found
                keys, counts = _part_keys(list(sets.values()), buckets)
                del known, sets
                ends = np.searchsorted(keys, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32))
                rest = keys.astype(np.uint32)
                rows = []
                for b in np.flatnonzero(np.diff(ends)).tolist():
                    here = slice(ends[b], ends[b + 1])
                    several = np.flatnonzero(counts[here] > 1).astype(np.uint32)
                    extra = counts[here][several].astype(np.uint32)
                    rows.append((b, part, rest[here].tobytes(), several.tobytes(), extra.tobytes()))
                kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
                columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "part", "rests", "several", "extra"])

    return run


def _count(table: pa.Table) -> pa.Table:
    """For each part, the logarithm of every n-gram's number of sets in the corpus; 0: in one set only."""
    rests, ends = flat(table.column("rests"), np.uint32)
    counts, begins = np.ones(len(rests), np.uint32), [0, *ends[:-1].tolist()]
    for begin, at, extra in zip(begins, table.column("several").to_pylist(), table.column("extra").to_pylist()):
        counts[begin + np.frombuffer(at, np.uint32).astype(np.int64)] = np.frombuffer(extra, np.uint32)
    classes = np.empty(len(rests), np.uint8)
    for at in slices(rests):
        _, place = np.unique(rests[at], return_inverse=True)
        sums = np.bincount(place, weights=counts[at])
        classes[at] = np.floor(np.log2(sums)).astype(np.uint8)[place]
    found = [classes[a:b].tobytes() for a, b in zip(begins, ends.tolist())]
    columns = {"part": table.column("part"), "bucket": table.column("bucket"), "classes": pa.array(found, pa.binary())}
    return pa.table(columns)


def _order(width: int, percent: int, buckets: int, schema: pa.Schema):
    """Every row of a part, with its set: rare first, less what it has alone, for those that may have partners."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        part, known = left.column("part")[0].as_py(), _WordHashes()
        rows = left.column("rows").combine_chunks().flatten()
        sets = [ngram_set(t.as_py(), width, known) for t in left.column("texts")[0].values]
        del known
        digests = [xxhash.xxh3_128_digest(s) if len(s) else None for s in sets]
        sent = {d: s for d, s in zip(digests, sets) if _eligible(len(s), percent) and d}
        keys, _ = _part_keys(list(sent.values()), buckets)
        replies = dict(zip(right.column("bucket").to_pylist(), right.column("classes").to_pylist()))
        classes = np.frombuffer(b"".join(replies[b] for b in sorted(replies)), np.uint8)
        if len(classes) != len(keys):
            raise RuntimeError(f"part {part}: {len(classes)} counts for {len(keys)} n-grams")
        shared = []
        for found, digest in zip(sets, digests):
            if digest not in sent:
                shared.append(None)
                continue
            rank = classes[np.searchsorted(keys, _keys(found, buckets))]
            if int((rank == 0).sum()) >= _prefix(len(found), percent):
                shared.append(None)
                continue
            order = np.lexsort((found, rank))
            shared.append(found[order][rank[order] > 0].view(np.int64))
        first = (part >> 32 << 40) | ((part & 0xFFFFFFFF) << 20)
        columns = [
            rows.field(0) if isinstance(rows, pa.StructArray) else rows,
            pa.array(np.arange(first, first + len(sets), dtype=np.int64)),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array(digests, pa.binary()),
            pa.array(shared, pa.list_(pa.int64())),
        ]
        return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema.names)

    return run


def _entries(percent: int):
    """The prefix of every set: its shared n-grams, the first of which stands behind those it has alone."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, size, shared in zip(*(batch.column(i) for i in range(3))):
                n, size, hashes = n.as_py(), size.as_py(), np.array(shared.values.to_numpy(zero_copy_only=False), np.int64)
                alone = size - len(hashes)
                taken = max(0, min(_prefix(size, percent) - alone, len(hashes)))
                ranges = (hashes.view(np.uint64) >> np.uint64(64 - RANGES.bit_length() + 1)).astype(np.int64)
                one = np.zeros((taken, RANGES), np.int32)
                one[np.arange(taken), ranges[:taken]] = 1
                behind = np.bincount(ranges, minlength=RANGES).astype(np.int32) - np.cumsum(one, axis=0, dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(taken + 1, dtype=np.int32) * RANGES), pa.array(behind.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes[:taken]),
                        pa.array(np.full(taken, n, np.int64)),
                        pa.array(np.full(taken, size, np.int64)),
                        pa.array(np.arange(alone, alone + taken, dtype=np.int64)),
                        lists,
                    ],
                    ["gram", "n", "size", "place", "behind"],
                )

    return run


def _passes(percent: int, x: str, y: str) -> str:
    """SQL: the length, positional and suffix filters on two entries of one n-gram, as the first they share."""
    least = f"ceil({percent} * ({x}.size + {y}.size) / {100 + percent}.0)"
    left = f"({x}.size - {x}.place - 1)", f"({y}.size - {y}.place - 1)"
    apart = f"aggregate(zip_with({x}.behind, {y}.behind, (p, q) -> abs(p - q)), 0, (s, d) -> s + d)"
    return (
        f"100 * least({x}.size, {y}.size) >= {percent} * greatest({x}.size, {y}.size)"
        f" and 1 + least({left[0]}, {left[1]}) >= {least}"
        f" and {apart} <= {left[0]} + {left[1]} - 2 * ({least} - 1)"
    )


def similar_sets(reps: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a``, ``b`` that join all of ``reps`` (``n``, ``size``, ``shared``: staged) similar by ``percent`` or more."""
    spark = reps.sparkSession
    schema = "gram long, n long, size long, place long, behind array<int>"
    entries = staged(reps.select("n", "size", "shared").mapInArrow(_entries(percent), schema), "entries")
    several = entries.groupBy("gram").agg(F.min("n").alias("lo"), F.max("n").alias("hi")).where("lo < hi")
    live = staged(entries.join(several.select("gram"), "gram", "left_semi").withColumn("root", F.col("n")), "live")
    forget(spark, entries)
    links = staged(spark.range(0).select(F.col("id").alias("a"), F.col("id").alias("b")), "links")
    seen, turn = links, 0
    while rows := live.count():
        most = GROWTH**turn
        near = in_one_task(live, rows * most, 8 * ONE_TASK)
        place = F.row_number().over(Window.partitionBy("gram").orderBy(F.xxhash64("n"), "n"))
        firsts = staged(near.withColumn("rank", place).where(F.col("rank") <= most).drop("rank"), "firsts")
        several = in_one_task(firsts, rows * most, 8 * ONE_TASK)
        met = near.alias("x").join(several.alias("y"), "gram").where(f"x.root <> y.root and {_passes(percent, 'x', 'y')}")
        pairs = met.select(F.least("x.n", "y.n").alias("a"), F.greatest("x.n", "y.n").alias("b")).distinct()
        pairs = staged(pairs.join(seen, ["a", "b"], "left_anti"), "pairs")
        # only the sets that some pair asks for travel to the pairs
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("n")).distinct()
        sets = staged(reps.join(nodes, "n", "left_semi"), "compared")
        of = [sets.select(F.col("n").alias(c), F.col("size").alias(f"size_{c}"), F.col("shared").alias(f"set_{c}")) for c in "ab"]
        both = pairs.join(of[0], "a").join(of[1], "b").withColumn("same", F.size(F.array_intersect("set_a", "set_b")))
        found = staged(both.where(f"100 * same >= {percent} * (size_a + size_b - same)").select("a", "b"), "similar")
        links, seen = links.unionByName(found), seen.unionByName(pairs)
        roots = staged(components(links, small=True).toDF("n", "over"), "roots")
        own = in_one_task(roots, rows)
        left = in_one_task(live, rows).join(in_one_task(firsts, rows).select("gram", "n"), ["gram", "n"], "left_anti")
        left = staged(left.join(own, "n", "left").withColumn("root", F.coalesce("over", "root")).drop("over"), "left")
        rest = in_one_task(left, rows)
        mixed = rest.groupBy("gram").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
        before, live = live, staged(rest.join(mixed.select("gram"), "gram", "left_semi"), "live")
        forget(spark, before, firsts, left, roots, sets)
        turn += 1
    return links


def similar_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id``, the smallest key that links reach, for every row.

    Rows link when their sets of distinct n-grams are similar by ``percent`` or more (equal 64-bit
    hashes count as equal n-grams). Rows of equal sets are copies and always link; one of them stands
    for all. A row without words (null, empty, blank) has an empty set, links with nothing and is its
    own component. Repeated rows come back as often as they came. A null key is never the smallest; a
    component of null keys alone has a null id. Other columns play no part; an empty table gives no row.
    """
    spark = docs.sparkSession
    with tidy_shuffles(spark), small_batches(spark):
        parts = pack(docs.select(key, text), text, PART_BYTES, "parts")
        size = parts.agg(F.sum(F.expr("aggregate(texts, 0L, (s, t) -> s + octet_length(t))"))).first()[0] or 0
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), blocks_for(size, BUCKET_BYTES))
        sent = parts.select("part", "texts").mapInArrow(
            _send(width, percent, buckets), "bucket int, part long, rests binary, several binary, extra binary"
        )
        replies = sent.groupBy("bucket").applyInArrow(_count, "part long, bucket int, classes binary")
        replies = staged(replies, "counts")
        kind = docs.schema[key].dataType
        schema = T.StructType([T.StructField("key", kind)]).add("n", "long").add("size", "long")
        schema = schema.add("digest", "binary").add("shared", T.ArrayType(T.LongType()))
        arrow = _arrow_schema(schema)
        both = parts.groupBy("part").cogroup(replies.groupBy("part"))
        sets = staged(both.applyInArrow(_order(width, percent, buckets, arrow), schema), "sets")
        forget(spark, parts, replies)
        firsts = sets.where("digest is not null").groupBy("digest").agg(F.min("n").alias("n"), F.min("key").alias("first"))
        firsts = staged(firsts, "firsts")
        reps = sets.where("shared is not null").select("n", "size", "shared").join(firsts.select("n"), "n", "left_semi")
        reps = staged(reps, "reps")
        roots = components(similar_sets(reps, percent)).withColumnRenamed("node", "n")
        named = firsts.join(roots, "n", "left").select("digest", "first", F.coalesce("root", "n").alias("root"))
        least = named.groupBy("root").agg(F.min("first").alias("least"))
        named = staged(named.join(least, "root").select("digest", "least"), "named")
        component = F.when(F.col("digest").isNull(), F.col("key")).otherwise(F.col("least"))
        found = sets.drop("shared").join(named, "digest", "left")
        return found.select(F.col("key").alias(key), F.col("size").alias("n_shingles"), component.alias("component_id"))


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
