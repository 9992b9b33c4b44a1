"""Ranked lexical search by a K2-treap over the term-document grid of every part of the corpus.

A part's grid has a row for each term, frequent ones first, and a column for each document, short ones
first; a cell holds the term's impact in the document. The grid is cut into quarters again and again,
down to single cells; a node keeps the greatest impact below it, a mask of the quarters that hold
anything, and nothing of the others. A node with a single cell keeps its row and column and is not cut
further, so a part has fewer than three nodes for two cells. Nodes stand in the order of a
breadth-first walk, so the masks alone give the places of the children.

A query follows the paths of its terms' rows at the same time. A state is a range of documents and, for
each term, the node whose quarter holds the term's row and this range; the weighted sum of their maxima
bounds the score of every document in the range. States are taken best first, some at once, and halved,
until a range is one document, whose bound is its score; states below the last score that is kept go.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadweir.llm.common import forget, lower_ascii, small_batches, staged, tidy_shuffles

#: Bytes of text in a part, about.
PART_BYTES = 8 << 20
#: Bytes of query texts that travel to every task at once; a longer table is searched in blocks.
BLOCK_BYTES = 4 << 20
#: States taken from a query's frontier at once.
TAKEN = 64
#: Fixed values of the scores: the impact's scale, its weight of a document's length, and their base.
SCALE, NORM, BASE = 1_000_000_000, 90, 100
#: A byte of a term is a letter a-z, a digit, or not ASCII; A-Z become a-z and others part terms.
TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
TERM_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: How an index is written, a part being a large row: the writer looks at its memory after each, and a
#: reader, which takes a row group's rows together, finds few in one.
WRITTEN = {
    "parquet.block.size.row.check.min": "1",
    "parquet.page.size.row.check.min": "1",
    "parquet.block.size": str(16 << 20),
}
#: Columns of an index besides ``ids``.
PARTS = ("terms", "dfs", "masks", "tops", "rows", "columns")


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order, with repeats; null, empty and a text of other marks have none."""
    return (text or "").encode().translate(TERM_BYTES).split()


def measure(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """How many rows have a term, and all terms with repeats."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(terms_of(t.as_py())) for t in batch.column(0)]
            yield pa.RecordBatch.from_pydict({"n": [sum(s > 0 for s in sizes)], "l": [sum(sizes)]})

    found = docs.select(text).mapInArrow(run, "n long, l long").agg(F.sum("n"), F.sum("l")).first()
    return found[0] or 0, found[1] or 0


def _spread(values: np.ndarray) -> np.ndarray:
    """Every bit at twice its place."""
    values = values.astype(np.uint64)
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF),
        (8, 0x00FF00FF00FF00FF),
        (4, 0x0F0F0F0F0F0F0F0F),
        (2, 0x3333333333333333),
        (1, 0x5555555555555555),
    ):
        values = (values | (values << np.uint64(shift))) & np.uint64(mask)
    return values


def treap(rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray, height: int) -> tuple[np.ndarray, ...]:
    """Masks, maxima, rows and columns of the nodes over distinct cells; rows and columns of single cells only."""
    codes = _spread(rows) << np.uint64(1) | _spread(columns)
    order = np.argsort(codes).astype(np.int32)
    codes, impacts = codes[order], impacts[order].astype(np.uint32)
    # From the whole grid down: only cells of nodes that hold several go on, so a level takes no more
    # memory than they do. begins: where the cells of each of these nodes begin.
    alive, begins = np.arange(len(codes)), np.zeros(1, np.int64)
    several = np.array([len(codes) > 1])
    tops, cells = [impacts.max(keepdims=True)], [np.where(several, -1, order[:1])]
    masks = []
    for depth in range(height):
        level = np.zeros(len(several), np.uint8)
        if several.any():
            below = codes[alive] >> np.uint64(2 * (height - 1 - depth))
            first = np.flatnonzero(np.concatenate([[True], below[1:] != below[:-1]]))
            quarter = np.uint8(1) << (below[first] & np.uint64(3)).astype(np.uint8)
            level[several] = np.bitwise_or.reduceat(quarter, np.searchsorted(first, begins))
        masks.append(level)
        if not several.any():
            break
        counts = np.diff(np.append(first, len(alive)))
        tops.append(np.maximum.reduceat(impacts[alive], first))
        several = counts > 1
        cells.append(np.where(several, -1, order[alive[first]]))
        alive = alive[np.repeat(several, counts)]
        begins = np.cumsum(counts[several]) - counts[several]
    masks += [np.zeros(len(x), np.uint8) for x in tops[len(masks) :]]
    cell = np.concatenate(cells)
    place = [np.where(cell < 0, -1, x[cell]).astype(np.int32) for x in (rows, columns)]
    return np.concatenate(masks), np.concatenate(tops), *place


class _Index:
    """The nodes of one part, with places of children, and a last empty node that stands for nothing.

    Of an array of ``terms`` only those that are ``wanted`` are kept.
    """

    def __init__(self, row: dict, wanted: pa.Array | None = None) -> None:
        if wanted is None:
            self.terms = {t: i for i, t in enumerate(row["terms"])}
        else:
            places = pc.index_in(wanted, value_set=row["terms"]).to_pylist()
            self.terms = {t: i for t, i in zip(wanted.to_pylist(), places) if i is not None}
        masks, tops, rows, columns = (
            np.frombuffer(row[c], k) for c, k in zip(PARTS[2:], (np.uint8, np.uint32, np.int32, np.int32))
        )
        self.masks = np.append(masks, np.uint8(0))
        self.tops = np.append(tops, np.uint32(0))
        self.rows, self.columns = np.append(rows, np.int32(-1)), np.append(columns, np.int32(-1))
        sizes = np.bitwise_count(self.masks)
        self.children = np.cumsum(sizes, dtype=np.int32)
        self.children -= sizes
        self.children += 1
        self.none = len(masks)
        self.ids = row["ids"]
        self.height = height_of(len(row["terms"]), len(self.ids))

    def best(self, terms: list[bytes], weights: list[int], k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and columns that hold the best ``k`` documents of at least ``floor``; ties of the last are all there."""
        found = [(self.terms[t], w) for t, w in zip(terms, weights) if t in self.terms and w > 0]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        rows, weights = (np.array(x, np.int64) for x in zip(*found))
        scores, columns = np.zeros(0, np.int64), np.zeros(0, np.int64)
        nodes = self._there(np.zeros((1, len(rows)), np.int64), rows)
        bounds, levels, places = self.tops[nodes] @ weights, np.zeros(1, np.int64), np.zeros(1, np.int64)
        floor = max(floor, 1)
        while len(bounds):
            if len(bounds) > TAKEN:
                best = np.argpartition(bounds, len(bounds) - TAKEN)
                now, later = best[-TAKEN:], best[:-TAKEN]
            else:
                now, later = np.arange(len(bounds)), np.zeros(0, np.int64)
            level, place = levels[now], places[now]
            shift = (self.height - 1 - level)[:, None]
            halves = [self._half(nodes[now], rows, shift, half) for half in (0, 1)]
            new = np.concatenate(halves)
            new_bounds = self.tops[new] @ weights
            new_levels = np.concatenate([level + 1, level + 1])
            new_places = np.concatenate([place * 2, place * 2 + 1])
            over = new_bounds >= floor
            done = over & (new_levels == self.height)
            if done.any():
                scores = np.concatenate([scores, new_bounds[done]])
                columns = np.concatenate([columns, new_places[done]])
                if len(scores) >= k:
                    floor = max(floor, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
                    kept = scores >= floor
                    scores, columns = scores[kept], columns[kept]
            more = over & ~done & (new_bounds >= floor)
            rest = later[bounds[later] >= floor]
            bounds = np.concatenate([bounds[rest], new_bounds[more]])
            levels = np.concatenate([levels[rest], new_levels[more]])
            places = np.concatenate([places[rest], new_places[more]])
            nodes = np.concatenate([nodes[rest], new[more]])
        return scores, columns

    def _there(self, nodes: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Nodes, less those whose single cell is in another row."""
        at = self.rows[nodes]
        return np.where((at >= 0) & (at != rows), self.none, nodes)

    def _half(self, nodes: np.ndarray, rows: np.ndarray, shift: np.ndarray, half: int) -> np.ndarray:
        """The nodes of the terms' rows in the lower or the upper half of each range."""
        quarter = ((rows >> shift & 1) << 1 | half).astype(np.uint8)
        masks = self.masks[nodes]
        before = np.bitwise_count(masks & ((np.uint8(1) << quarter) - np.uint8(1)))
        below = np.where(masks >> quarter & 1, self.children[nodes] + before, self.none)
        at = self.columns[nodes]
        stays = (at >= 0) & ((at >> shift & 1) == half)
        return np.where(stays, nodes, self._there(below, rows))


def height_of(terms: int, documents: int) -> int:
    """How often a grid is cut into quarters until single cells are left."""
    return max(1, (max(terms, documents) - 1).bit_length())


def build_index(docs: DataFrame, n: int, total: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each part of the corpus: document keys, terms, their documents in the part, and the K2-treap.

    ``n`` and ``total`` are those of :func:`measure`. Rows without a term are in no part. A part holds
    about :data:`PART_BYTES` of text, and whole texts only, so a longer text is a part by itself.
    Columns: ``ids`` array of keys, ``terms`` array of binary, ``dfs`` array of int, and four binaries.
    """
    fields = [T.StructField("ids", T.ArrayType(docs.schema[key].dataType)), T.StructField("terms", T.ArrayType(T.BinaryType()))]
    fields.append(T.StructField("dfs", T.ArrayType(T.IntegerType())))
    schema = T.StructType(fields + [T.StructField(c, T.BinaryType()) for c in PARTS[2:]])

    def closed(ids: list[pa.Array], counts: list[np.ndarray], known: dict[bytes, int]) -> pa.RecordBatch:
        keys, sizes = pa.concat_arrays(ids), np.array([len(c) for c in counts], np.int64)
        order = np.argsort(sizes, kind="stable")
        column = np.empty(len(order), np.uint32)
        column[order] = np.arange(len(order))
        cells = np.concatenate(counts).astype(np.uint64)
        cells <<= np.uint64(32)
        cells |= np.repeat(column, sizes)
        cells.sort()
        first = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
        tf, cells = np.diff(np.append(first, len(cells))), cells[first]
        term, column = (cells >> np.uint64(32)).astype(np.uint32), cells.astype(np.uint32)
        del cells, first
        dfs = np.bincount(term, minlength=len(known))
        by_df = np.argsort(-dfs, kind="stable")
        row = np.empty(len(by_df), np.uint32)
        row[by_df] = np.arange(len(by_df))
        m = np.array([BASE - NORM + NORM * s * n // total for s in sizes[order].tolist()], np.int64)
        impacts = ((SCALE * tf) // (1000 * tf + 8 * m[column])).astype(np.uint32)
        del tf
        nodes = treap(row[term], column, impacts, height_of(len(known), len(sizes)))
        words = pa.array(list(known), pa.binary()).take(pa.array(by_df))
        lists = [one(x).cast(f.type) for x, f in zip((keys.take(pa.array(order)), words, pa.array(dfs[by_df])), _arrow(schema))]
        return pa.RecordBatch.from_arrays([*lists, *map(packed, nodes)], schema.names)

    def one(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    def packed(values: np.ndarray) -> pa.Array:
        ends = pa.array([0, values.nbytes], pa.int32()).buffers()[1]
        return pa.Array.from_buffers(pa.binary(), 1, [None, ends, pa.py_buffer(values)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, counts, known, size = [], [], {}, 0
        for batch in batches:
            # keys are copied: a slice would keep its whole batch, with the texts
            taken = []
            for i, value in enumerate(batch.column(1)):
                found = terms_of(text := value.as_py())
                if not found:
                    continue
                if size and size + len(text) > PART_BYTES:
                    ids.append(batch.column(0).take(pa.array(taken, pa.int64())))
                    yield closed(ids, counts, known)
                    ids, counts, known, size, taken = [], [], {}, 0, []
                taken.append(i)
                counts.append(np.fromiter((known.setdefault(t, len(known)) for t in found), np.uint32, len(found)))
                size += len(text)
            ids.append(batch.column(0).take(pa.array(taken, pa.int64())))
        if counts:
            yield closed(ids, counts, known)

    return docs.select(key, text).mapInArrow(run, schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def weighted_terms(index: DataFrame, items: DataFrame, n: int, item: str, text: str) -> DataFrame:
    """``item``, ``terms`` and ``weights`` of every item: each of its terms that the corpus has, once."""
    wanted = items.select(F.col(item).alias("item"), F.explode(_terms(text)).alias("term")).distinct()
    counts = index.select(F.explode(F.arrays_zip("terms", "dfs")).alias("t")).select("t.terms", "t.dfs")
    found = wanted.select("term").distinct()
    counts = counts.select(F.col("terms").cast("string").alias("term"), "dfs").join(found, "term", "left_semi")
    counts = counts.groupBy("term").agg(F.sum("dfs").alias("df"))
    weight = F.expr(f"cast(floor(1000 * ln({2 * n + 2} / (2.0D * df + 1))) as bigint)")
    weighted = wanted.join(counts, "term").select("item", F.struct("term", weight.alias("weight")).alias("t"))
    sums = weighted.groupBy("item").agg(F.sort_array(F.collect_set("t")).alias("t"))
    return sums.select("item", F.col("t.term").alias("terms"), F.col("t.weight").alias("weights"))


def _terms(text: str) -> Column:
    return F.array_distinct(F.regexp_extract_all(lower_ascii(F.col(text)), F.lit(TERM_PATTERN), F.lit(0)))


def _search(block: list[tuple], k: int, kind: pa.Schema):
    """The best ``k`` documents of each item among the parts of a task, each part searched above the last kept score."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple[int, object]]] = [[] for _ in block]
        wanted = pa.array(sorted({t for _, terms, _ in block for t in terms}), pa.binary())
        for batch in batches:
            for row in range(batch.num_rows):
                part = dict(zip(("ids", *PARTS), (column[row] for column in batch.columns)))
                nodes = {c: part[c].as_buffer() for c in PARTS[2:]}
                index = _Index({"ids": part["ids"].as_py(), "terms": part["terms"].values, **nodes}, wanted)
                del part, nodes
                for place, (_, terms, weights) in enumerate(block):
                    mine = held[place]
                    floor = mine[-1][0] if len(mine) >= k else 1
                    scores, columns = index.best(terms, weights, k, floor)
                    if len(scores):
                        mine += [(s, index.ids[c]) for s, c in zip(scores.tolist(), columns.tolist())]
                        mine.sort(key=lambda x: (-x[0], x[1] is None, x[1] if x[1] is not None else 0))
                        del mine[k:]
                del index
            del batch
        rows = [(item, key, score) for (item, _, _), mine in zip(block, held) for score, key in mine]
        for start in range(0, len(rows), 10_000):
            some = rows[start : start + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in some], f.type) for i, f in enumerate(kind)], kind.names)

    return run


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``item``, ``rank``, ``key`` and ``score`` of each item's ``k`` best rows of ``docs`` with a score above 0.

    Equal scores stand by ascending key, a null key last; repeated rows are ranked as often as they come. Items
    and rows without terms (null, empty, other marks alone) give no row, nor do items none of whose
    terms the corpus has; items of equal id are one item with the terms of all. The index is written to the shared folder
    once; a table of items beyond :data:`BLOCK_BYTES` is searched in blocks against it, and only a
    block travels to the tasks. Each task returns its own best ``k``, so what meets at the end is a row
    for each item, task and rank. Other columns play no part.
    """
    spark = docs.sparkSession
    if key == item:
        raise ValueError("keys and items need different names")
    with tidy_shuffles(spark), small_batches(spark):
        n, total = measure(docs, text)
        index = build_index(docs, n, total, key, text)
        index = staged(index, "index", WRITTEN)
        weighted = staged(weighted_terms(index, items, n, item, item_text), "weighted")
        size = F.expr("aggregate(terms, 0L, (s, t) -> s + octet_length(t) + 16)")
        total_bytes = weighted.agg(F.sum(size)).first()[0] or 0
        blocks = -(-total_bytes // BLOCK_BYTES)
        schema = T.StructType([T.StructField("item", items.schema[item].dataType), T.StructField("key", docs.schema[key].dataType)])
        schema = schema.add("score", "long")
        found = []
        numbered = weighted.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(max(1, blocks))))
        for block in range(blocks):
            rows = [
                (r["item"], [t.encode() for t in r["terms"]], r["weights"])
                for r in numbered.where(F.col("block") == block).collect()
            ]
            best = index.mapInArrow(_search(rows, k, _arrow(schema)), schema)
            found.append(staged(best, "best"))
        forget(spark, index)
        place = Window.partitionBy("item").orderBy(F.desc("score"), F.col("key").asc_nulls_last())
        found = reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)
        ranked = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
        return ranked.select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")
