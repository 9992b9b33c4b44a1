"""Spelling variants: words within one inserted, deleted or replaced letter, by a bit-sliced position index.

Words that are one error apart share their first or their last half, so they meet under one of a few
keys (:func:`_keys`), dealt to buckets of bounded size. A bucket's index has a bitset over its words for
every pair of position and letter: the words with that letter there. All of the bucket's words are
looked up at once, letter by letter: a bitset of words that agree so far, without error, and three of
words with one, which has replaced a letter, added one to them or left one out of them. The last two
read the index one position on or one back. Each step is a few AND and OR over whole machine words.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadweir.llm.common import forget, lower_ascii, staged, tidy_shuffles

#: Maximal runs of these are words.
WORD_PATTERN = r"[A-Za-zÀ-ÿ]+"
#: Letters that a bucket's words have in all, about; a bucket of long words holds fewer of them.
BUCKET_LETTERS = 40_000
#: Words that are looked up in an index at once.
CHUNK = 512


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", modulus: int = 199) -> DataFrame:
    """``word`` and ``n``, its occurrences in the corpus, after the planted errors of the contract.

    Only A-Z are lower-cased. Where the CRC-32 of ``<key>:<word>`` is a multiple of ``modulus``, the
    letter at its remainder by the length is deleted; a null key counts as an empty text, and a word
    of one letter becomes an empty one. Null, empty and other texts without a letter have no word.
    """
    runs = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(WORD_PATTERN), F.lit(0))
    each = docs.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("key"), F.explode(runs).alias("run"))
    each = each.select("key", lower_ascii(F.col("run")).alias("run"))
    h = F.crc32(F.concat("key", F.lit(":"), "run").cast("binary"))
    at = F.expr("cast(h % char_length(run) as int)")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    word = F.when(F.col("h") % modulus == 0, cut).otherwise(F.col("run"))
    return each.withColumn("h", h).select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def _keys() -> Column:
    """What a word is found under: for each length of the shorter of two words, its first and its last letters.

    Of two words of lengths L and L or L + 1 with one error between them, one half of L letters, from
    the start or from the end, is untouched by it.
    """
    length = F.char_length("word")
    keys = []
    for shorter in (length, length - 1):
        half = F.floor(shorter / 2).cast("int")
        for side, part in ((0, F.substring("word", F.lit(1), half)), (1, F.right("word", half))):
            keys.append(F.struct(shorter.alias("shorter"), F.lit(side).alias("side"), part.alias("half")))
    return F.array(*keys)


def _neighbours(words: list[str], indexed: np.ndarray, asks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs of an asking and an indexed word with exactly one error between them."""
    lengths = np.array([len(w) for w in words], np.int64)
    index = np.flatnonzero(indexed)
    slices = -(-len(index) // 64)
    rows: dict[tuple[int, str], int] = {}
    at_row, at_bit = [], []
    for bit, i in enumerate(index.tolist()):
        for p, letter in enumerate(words[i]):
            at_row.append(rows.setdefault((p, letter), len(rows)))
            at_bit.append(bit)
    # a row for each pair of position and letter, and a last one without a word
    bits = np.zeros((len(rows) + 1, slices * 64), np.uint8)
    bits[at_row, at_bit] = 1
    has = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
    none = len(rows)
    of_length: dict[int, np.ndarray] = {}

    def long(n: int) -> np.ndarray:
        if n not in of_length:
            found = np.zeros(slices * 64, np.uint8)
            found[: len(index)] = lengths[index] == n
            of_length[n] = np.packbits(found, bitorder="little").view(np.uint64)
        return of_length[n]

    everything = np.full(slices, ~np.uint64(0))
    by_length: dict[int, list[int]] = defaultdict(list)
    for i in np.flatnonzero(asks).tolist():
        by_length[len(words[i])].append(i)
    found_a, found_b = [], []
    for length, places in by_length.items():
        for start in range(0, len(places), CHUNK):
            some = places[start : start + CHUNK]
            exact = np.tile(everything, (len(some), 1))
            replaced = np.zeros_like(exact)
            # words with one letter more, and with one less, than what has been read
            more, less = exact.copy(), np.zeros_like(exact)
            for i in range(length):
                here, on, back = (
                    has[[rows.get((p, words[q][i]), none) for q in some]] for p in (i, i + 1, i - 1)
                )
                less = (less & back) | exact
                replaced = (replaced & here) | (exact & ~here)
                exact = exact & here
                more = (more & on) | exact
            hit = (replaced & long(length)) | (more & long(length + 1)) | (less & long(length - 1))
            q, bit = np.nonzero(np.unpackbits(hit.view(np.uint8), axis=1, count=len(index), bitorder="little"))
            found_a.append(np.array(some)[q])
            found_b.append(index[bit])
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_a), np.concatenate(found_b)


def _look_up(table: pa.Table) -> pa.Table:
    """The pairs of a bucket, each asking word's once."""
    flags: dict[str, list[bool]] = {}
    for word, indexed, asks in zip(*(table.column(c).to_pylist() for c in ("word", "indexed", "asks"))):
        held = flags.setdefault(word, [False, False])
        held[0] |= indexed
        held[1] |= asks
    words = list(flags)
    marks = np.array(list(flags.values()), bool).reshape(-1, 2)
    a, b = _neighbours(words, marks[:, 0], marks[:, 1])
    names = pa.array(words, pa.string())
    return pa.table({"word": names.take(pa.array(a)), "near": names.take(pa.array(b))})


def near_words(words: DataFrame) -> DataFrame:
    """All pairs ``word``, ``near``, both ways, that are one error apart, of distinct ``words`` (column ``word``).

    A key that a bucket can't hold is dealt to as many blocks as it needs: a word is indexed in one of
    them and looked up in each, so no pair is lost and no task gets a group that grows with the data.
    Words of one letter are compared by the same keys, of which some are empty.
    """
    keyed = words.select("word", F.explode(_keys()).alias("key"))
    keyed = staged(keyed.select("word", F.char_length("word").alias("letters"), "key"), "keyed")
    counts = keyed.groupBy("key").agg(F.count("*").alias("words"), F.sum("letters").alias("all")).where("words > 1")
    blocks = F.ceil(F.col("all") / BUCKET_LETTERS).alias("blocks")
    lengths = counts.groupBy("key.shorter").agg(F.greatest(F.lit(1), F.ceil(F.sum("all") / BUCKET_LETTERS)).alias("buckets"))
    placed = keyed.join(counts.select("key", blocks), "key").join(lengths, F.col("key.shorter") == F.col("shorter"))
    own = F.pmod(F.xxhash64("word"), F.col("blocks"))
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
    placed = placed.select("word", "key", "shorter", "buckets", own.alias("own"), block)
    bucket = F.struct("shorter", F.pmod(F.xxhash64("key", "block"), F.col("buckets")).alias("part")).alias("bucket")
    placed = placed.select(bucket, "word", (F.col("block") == F.col("own")).alias("indexed"), F.lit(True).alias("asks"))
    return placed.groupBy("bucket").applyInArrow(_look_up, "word string, near string").distinct()


def variants(counts: DataFrame, letters: int = 6, least: int = 5, ratio: int = 5) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of every word of ``counts`` (``word``, ``n``).

    Words have at least ``letters`` letters and ``least`` occurrences. A form is the near word of the
    largest ``n``, the smallest in code-point order of equal ones, if it has at least ``ratio`` times as many;
    a root is found by following forms, whose counts grow, to the last. Null words are left out; an
    empty table gives no row.
    """
    spark = counts.sparkSession
    with tidy_shuffles(spark):
        words = counts.where(f"char_length(word) >= {letters} and n >= {least}").select("word", "n")
        words = staged(words, "words")
        pairs = staged(near_words(words), "near")
        ranked = pairs.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
        best = F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near").alias("near"))).alias("best")
        near = ranked.groupBy("word").agg(F.count("*").alias("n_near"), best)
        form = F.when(-F.col("best.order") >= ratio * F.col("n"), F.col("best.near"))
        found = words.join(near, "word", "left").withColumn("form", form)
        form_n = F.when(F.col("form").isNotNull(), -F.col("best.order"))
        found = staged(
            found.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form", form_n.alias("form_n")),
            "forms",
        )
        # only words with a form have a way to go; it halves in each round
        steps = staged(found.where("form is not null").select("word", F.col("form").alias("to")), "steps")
        while True:
            on = steps.select(F.col("word").alias("to"), F.col("to").alias("further"))
            after = staged(steps.join(on, "to", "left").select("word", F.coalesce("further", "to").alias("to"), "further"), "steps")
            moved = after.where("further is not null").isEmpty()
            forget(spark, steps)
            steps = after.drop("further")
            steps.staged_at = after.staged_at
            if moved:
                break
        forget(spark, pairs, words)
        rooted = found.join(steps, "word", "left").withColumn("root", F.coalesce("to", "word"))
        return rooted.select("word", "form", "root", "n", "n_near", "form_n")
