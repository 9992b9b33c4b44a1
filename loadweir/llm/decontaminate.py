"""Benchmark decontamination: every suffix of the test texts is looked up in suffix arrays of the training texts.

A shard of training documents, a few megabytes as they lie in a task, becomes one array of word ids
and its suffix array. Each test suffix is found by binary search; its matches of a window's length or
more, joined along a diagonal, are the longest verbatim matches. Nothing is shuffled. Test texts are
taken in blocks of bounded size, one after another, so neither the driver nor a task holds them all.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadweir.llm.common import blocks_for, staged

SHARD_BYTES = 4 << 20
#: Bytes of test text in one block, about.
BLOCK_BYTES = 8 << 20
#: Bytes that stand between words: ASCII but for digits and letters. Letters go to lower case.
_APART = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower())
MATCH = T.StructType(
    [
        T.StructField("start", T.IntegerType()),
        T.StructField("length", T.IntegerType()),
        T.StructField("item", T.StringType()),
        T.StructField("item_start", T.IntegerType()),
    ]
)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text: runs of digits, letters and all characters beyond ASCII; A-Z in lower case."""
    return (text or "").encode().translate(_APART).split()


class Packed:
    """Word ids with a key at each place: the next words' ids in one integer, as many as fit.

    Id 0, a word that is in no test text or the end of a document, ends the text that a key sees.
    """

    def __init__(self, ids: np.ndarray, bits: int):
        self.per = 62 // bits
        self.bits, n = bits, len(ids)
        self.ids = np.concatenate([ids, np.zeros(self.per + 1, np.int64)])
        alive, key = np.ones(n, bool), np.zeros(n, np.int64)
        for j in range(self.per):
            word = self.ids[j : j + n]
            alive &= word > 0
            key = key << bits | np.where(alive, word, 0)
        self.key = np.concatenate([key, np.zeros(1, np.int64)])


def suffix_array(packed: Packed) -> np.ndarray:
    """The places of all known words, ordered by the text from there to the next unknown word.

    The first sort is by keys; what is equal then is ordered by the rank of the text that follows,
    twice as far each time. Only places that are still equal are sorted again.
    """
    ids, n = packed.ids[: len(packed.key) - 1], len(packed.key) - 1
    ends = np.flatnonzero(np.concatenate([ids, [0]]) == 0)
    run = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)
    places = np.flatnonzero(ids)
    order = places[np.argsort(packed.key[places], kind="stable")]
    keys = packed.key[order]
    new = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(order) else np.zeros(0, bool)
    rank = np.zeros(n + 1, np.int64)
    group = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0)) if len(order) else order
    rank[order] = group + 1
    seen = packed.per
    slots = np.arange(len(order))
    while True:
        alone = np.concatenate([new[1:], [True]]) & new if len(order) else new
        open_ = slots[~alone[slots] & (run[order[slots]] >= seen)]
        if not len(open_):
            return order
        at = order[open_]
        follow = rank[np.minimum(at + seen, n)]
        by = np.lexsort((follow, group[open_]))
        at, follow, own = at[by], follow[by], group[open_]
        order[open_] = at
        new[open_] = np.concatenate([[True], (own[1:] != own[:-1]) | (follow[1:] != follow[:-1])])
        group[open_] = np.maximum.accumulate(np.where(new[open_], open_, 0))
        rank[at] = group[open_] + 1
        slots, seen = open_, 2 * seen


class Block:
    """Test texts as word ids, and each distinct window with the places where it stands."""

    def __init__(self, items: list[tuple[str, str]], width: int):
        self.names = [name for name, _ in items]
        split = [words_of(text) for _, text in items]
        self.vocabulary: dict[bytes, int] = {}
        for words in split:
            for word in words:
                self.vocabulary.setdefault(word, len(self.vocabulary) + 1)
        self.bits = max(1, len(self.vocabulary).bit_length())
        windows: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for i, words in enumerate(split):
            ids = [self.vocabulary[w] for w in words]
            size = min(width, len(ids))
            for j in range(len(ids) - size + 1 if ids else 0):
                windows.setdefault(tuple(ids[j : j + size]), []).append((i, j))
        self.sizes = sorted({len(w) for w in windows})
        self.windows = {n: np.array([w for w in windows if len(w) == n], np.int64) for n in self.sizes}
        self.places = {n: [p for w, p in windows.items() if len(w) == n] for n in self.sizes}


def _narrowed(key: np.ndarray, order: np.ndarray, step: int, low, high, value, right: bool) -> np.ndarray:
    """The first slot in each range whose key ``step`` words on is not below (``right``: is above) its value."""
    low, high = low.copy(), high.copy()
    while (going := np.flatnonzero(low < high)).size:
        middle = (low[going] + high[going]) // 2
        there = key[order[middle] + step]
        down = there <= value[going] if right else there < value[going]
        low[going] = np.where(down, middle + 1, low[going])
        high[going] = np.where(down, high[going], middle)
    return low


def find(packed: Packed, order: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slots of the suffix array, from and to, whose texts begin with each of the windows."""
    n, size = windows.shape
    per, bits = packed.per, packed.bits
    low, high = np.zeros(n, np.int64), np.full(n, len(order), np.int64)
    for step in range(0, size, per):
        some = windows[:, step : step + per]
        value = np.zeros(n, np.int64)
        for j in range(some.shape[1]):
            value = value << bits | some[:, j]
        spare = bits * (per - some.shape[1])
        first, last = value << spare, (value << spare) | ((1 << spare) - 1)
        low, high = (
            _narrowed(packed.key, order, step, low, high, first, False),
            _narrowed(packed.key, order, step, low, high, last, True),
        )
    return low, high


def _joined(found: list[tuple[int, int, int, int]], size: int) -> list[dict]:
    """Windows found, as (item, item place, place), joined to the longest matches along each diagonal."""
    out: list[list[int]] = []
    for item, diagonal, place in sorted({(i, p - j, p) for i, j, p, _ in found}):
        if out and out[-1][0] == item and out[-1][1] == diagonal and place <= out[-1][3]:
            out[-1][3] = place + size
        else:
            out.append([item, diagonal, place, place + size])
    return [{"start": a, "length": b - a, "item": i, "item_start": a - d} for i, d, a, b in out]


def search_shard(texts: list[str | None], block: Block) -> tuple[list[int], dict[int, list[dict]]]:
    """How many words each text has, and the matches of those texts that have any."""
    split = [words_of(t) for t in texts]
    sizes = np.array([len(words) for words in split], np.int64)
    ends = np.cumsum(sizes + 1)
    ids = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
    known = np.fromiter(
        (i for words in split for i in map(block.vocabulary.get, words, repeat(0))), np.int64, int(sizes.sum())
    )
    place = np.arange(len(known)) + np.repeat(np.arange(len(split)), sizes)
    ids[place] = known
    packed = Packed(ids, block.bits)
    order = suffix_array(packed)
    matches: dict[int, list[dict]] = {}
    for size in block.sizes:
        low, high = find(packed, order, block.windows[size])
        found: dict[int, list[tuple[int, int, int, int]]] = {}
        for w in np.flatnonzero(high > low):
            at = order[low[w] : high[w]]
            for doc, p in zip(np.searchsorted(ends, at, side="right").tolist(), at.tolist()):
                begin = int(ends[doc] - sizes[doc] - 1)
                found.setdefault(doc, []).extend((i, j, p - begin, size) for i, j in block.places[size][w])
        for doc, each in found.items():
            named = [m | {"item": block.names[m["item"]]} for m in _joined(each, size)]
            matches.setdefault(doc, []).extend(named)
    return sizes.tolist(), matches


def n_covered(matches: list[dict]) -> int:
    """How many words the matches cover together."""
    total = reach = 0
    for start, end in sorted((m["start"], m["start"] + m["length"]) for m in matches):
        total += max(0, end - max(start, reach))
        reach = max(reach, end)
    return total


def _search(block):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def searched() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            n_words, matches = search_shard(table.column("text").to_pylist(), block.value)
            before = table.column("matches").to_pylist()
            found = [(old or []) + matches.get(i, []) for i, old in enumerate(before)]
            columns = {
                "n_words": pa.array(n_words, pa.int64()),
                "n_hit": pa.array([n_covered(m) for m in found], pa.int64()),
                "items": pa.array([sorted({m["item"] for m in ms}) for ms in found], pa.list_(pa.string())),
                "matches": pa.array(found, table.schema.field("matches").type),
            }
            kept = [table.column(c).combine_chunks() for c in ("row", "text")]
            return pa.RecordBatch.from_arrays(
                [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in kept] + list(columns.values()),
                ["row", "text", *columns],
            )

        for batch in batches:
            start = 0
            for i, n in enumerate(pc.binary_length(batch.column("text")).fill_null(0).to_pylist()):
                size += n + 16
                if size > SHARD_BYTES:
                    held.append(batch.slice(start, i + 1 - start))
                    yield searched()
                    held, size, start = [], 0, i + 1
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if held:
            yield searched()

    return run


def find_matches(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = 10
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit`` (words in a match), ``items`` (found ids, as sorted strings) and ``matches``.

    A match is ``width`` words or more in a row that also stand in a row in an item; an item of fewer
    words, but not none, matches as a whole. ``matches`` have the first word in the document, the
    length, the item and its first word there: the longest ones. Null and empty texts have no words
    and no matches; neither have items without words. Columns of these names in ``docs`` are replaced.
    """
    spark = docs.sparkSession
    added = ["n_words", "n_hit", "items", "matches"]
    source = docs.drop(*(c for c in docs.columns if c in added))
    others = [F.col(f"`{c}`") for c in source.columns if c != text]
    none = F.lit(None).cast(T.ArrayType(MATCH))
    rows = F.struct(*others) if others else F.struct(F.lit(0).alias("none"))
    work = source.select(rows.alias("row"), F.col(f"`{text}`").alias("text"), none.alias("matches"))
    schema = T.StructType(
        [
            work.schema["row"],
            work.schema["text"],
            T.StructField("n_words", T.LongType()),
            T.StructField("n_hit", T.LongType()),
            T.StructField("items", T.ArrayType(T.StringType())),
            T.StructField("matches", T.ArrayType(MATCH)),
        ]
    )
    tests = items.select(F.col(f"`{item_id}`").cast("string").alias("name"), F.col(f"`{item_text}`").alias("body"))
    total = tests.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks = blocks_for(total, BLOCK_BYTES)
    numbered = tests.withColumn("block", F.pmod(F.xxhash64("name", "body"), F.lit(blocks)))
    for k in range(blocks):
        # one block: at most about BLOCK_BYTES of test text
        block = Block([(r.name or "", r.body) for r in numbered.where(F.col("block") == k).collect()], width)
        if k:
            work = staged(work, "searched")
        work = work.select("row", "text", "matches").mapInArrow(_search(spark.sparkContext.broadcast(block)), schema)
    columns = [F.col("text").alias(c) if c == text else F.col(f"row.`{c}`") for c in source.columns]
    return work.select(*columns, *added)


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without those that hold a match; all columns and all other rows as they are."""
    return find_matches(docs, items, **options).where("n_hit = 0").select(*[f"`{c}`" for c in docs.columns])
