"""Byte-level BPE: encode texts to ids with character offsets, and decode ids to bytes and text.

The ``tokenizers`` library runs over Arrow batches. It works on characters, so each byte is mapped to
a printable character first (:func:`byte_table`); decoding reverses that table. A token may hold part
of a character: decoding joins bytes before it reads characters, also across chunks.
"""

from __future__ import annotations

import base64
import codecs
import os
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import types as T

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Characters that go to the library at once, which bounds the memory of its encodings.
CHUNK_CHARS = 1_000_000
#: Distinct pieces whose ids a Python worker keeps at once.
KNOWN_PIECES = 300_000
#: Texts of characters below this one (Latin, Greek, Cyrillic) are split without the library.
PLAIN_END = 0x530


def byte_table() -> list[str]:
    """The character of each byte: itself where Latin-1 has a visible one, else the next from U+0100."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ids from a rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def tokenizer(path: str):
    """The library's tokenizer of the pieces of a rank file, made once in each Python worker.

    The ranks name tokens, not pairs: every split of a token into two tokens is a merge of its rank.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, models, pre_tokenizers

    table, ranks = byte_table(), read_ranks(path)
    shown = {token: "".join(table[b] for b in token) for token in ranks}
    merges = [
        (shown[token[:i]], shown[token[i:]])
        for token, _ in sorted(ranks.items(), key=lambda x: x[1])
        for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks
    ]
    vocab = {shown[token]: rank for token, rank in ranks.items()}
    made = Tokenizer(models.BPE(vocab=vocab, merges=merges, ignore_merges=True, cache_capacity=100_000))
    made.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return made


@lru_cache(maxsize=2)
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all tokens in a row, and where each id's begin and how many they are (-1: no such id).

    They are read back from the characters that the library shows them as.
    """
    byte_of = {shown: b for b, shown in enumerate(byte_table())}
    shown = {i: token for token, i in tokenizer(path).get_vocab().items()}
    sizes = np.array([len(shown[i]) if i in shown else -1 for i in range(max(shown) + 1)], np.int64)
    joined = bytes(byte_of[c] for i in sorted(shown) for c in shown[i])
    held = np.maximum(sizes, 0)
    return np.frombuffer(joined, np.uint8), np.cumsum(held) - held, sizes


def _ragged(firsts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The indices of runs that begin at ``firsts``, one after another, and where each run ends."""
    after = np.cumsum(sizes)
    total = int(after[-1]) if len(after) else 0
    return np.repeat(firsts - (after - sizes), sizes) + np.arange(total), after


def decoded_bytes(ids: np.ndarray, per_row: np.ndarray, path: str) -> pa.Array:
    """A binary array: the bytes of each row's ids, ``per_row`` of them each."""
    joined, firsts, sizes = token_bytes(path)
    if len(ids) and (ids.min() < 0 or ids.max() >= len(sizes) or (sizes[ids] < 0).any()):
        raise ValueError("an id is not in the vocabulary")
    place, after = _ragged(firsts[ids], sizes[ids])
    bounds = np.concatenate([[0], after])[np.concatenate([[0], np.cumsum(per_row)])].astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(per_row), [None, pa.py_buffer(bounds), pa.py_buffer(joined[place].tobytes())]
    )


def _class(kind: str) -> str:
    """The characters of a Unicode category below :data:`PLAIN_END`, as ranges of a character class."""
    marks = [unicodedata.category(chr(c))[0] == kind for c in range(PLAIN_END)] + [False]
    edges = [c for c in range(PLAIN_END + 1) if marks[c] != (c > 0 and marks[c - 1])]
    return "".join(f"\\u{a:04x}-\\u{b - 1:04x}" for a, b in zip(edges[::2], edges[1::2]))


class Pieces:
    """Splits texts as the pattern does, and asks the library for the ids of each distinct piece once.

    The library's own splitter takes most of its time. Texts of the scripts below :data:`PLAIN_END`
    are split by an equal pattern of the standard library, all others by the library's splitter.
    What is known of a piece is kept in a bounded table.
    """

    def __init__(self, path: str, pattern: str, offsets: bool):
        from tokenizers import Regex, pre_tokenizers

        self.library, self.offsets = tokenizer(path), offsets
        self.forget()
        self.split = pre_tokenizers.Split(Regex(pattern), "isolated").pre_tokenize_str
        letters, numbers, blanks = _class("L"), _class("N"), r"\t-\r \x85\xa0"
        plain = (
            pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{blanks}{letters}{numbers}]")
            .replace(r"\p{L}", f"[{letters}]")
            .replace(r"\p{N}", f"[{numbers}]")
            .replace(r"\S", f"[^{blanks}]")
            .replace(r"\s", f"[{blanks}]")
        )
        self.plain = re.compile(plain).findall if pattern == public_tokenizers.PATTERN else None
        self.all_plain = re.compile(f"[\x00-{chr(PLAIN_END - 1)}]*").fullmatch

    def of(self, text: str) -> list[str]:
        if self.plain and self.all_plain(text):
            return self.plain(text)
        return [text[a:b] for _, (a, b) in self.split(text)]

    def learn(self, pieces: list[str]) -> None:
        """Append the ids, and offsets, of pieces not seen before to the table."""
        found = self.library.encode(pieces, is_pretokenized=True, add_special_tokens=False)
        sizes = np.bincount(np.array(found.word_ids, np.int64), minlength=len(pieces))
        columns = [np.array(found.ids, np.int32)]
        if self.offsets:
            columns += list(np.array(found.offsets, np.int32).reshape(-1, 2).T)
        first = len(self.sizes)
        self.known.update(zip(pieces, range(first, first + len(pieces))))
        self.sizes = np.concatenate([self.sizes, sizes])
        self.columns = [np.concatenate(pair) for pair in zip(self.columns, columns)]
        self.firsts = np.cumsum(self.sizes) - self.sizes

    def forget(self) -> None:
        self.known, self.sizes = {}, np.zeros(0, np.int64)
        self.firsts, self.columns = self.sizes, [np.zeros(0, np.int32)] * (3 if self.offsets else 1)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
        """How many ids each text has; all ids and, if asked for, all starts and ends."""
        pieces = [self.of(text) for text in texts]
        flat = list(chain.from_iterable(pieces))
        distinct = set(flat)
        if len(self.known) > KNOWN_PIECES:
            self.forget()
        if new := list(distinct.difference(self.known)):
            self.learn(new)
        index = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        sizes = self.sizes[index]
        place, after = _ragged(self.firsts[index], sizes)
        columns = [c[place] for c in self.columns]
        per_text = np.array([len(p) for p in pieces], np.int64)
        bounds = np.concatenate([[0], np.cumsum(per_text)])
        if self.offsets:
            lengths = np.concatenate([[0], np.cumsum(np.fromiter(map(len, flat), np.int64, len(flat)))])
            begins = lengths[:-1] - np.repeat(lengths[bounds[:-1]], per_text)
            shift = np.repeat(begins, sizes).astype(np.int32)
            columns[1:] = [c + shift for c in columns[1:]]
        return np.diff(np.concatenate([[0], after])[bounds]), columns


@lru_cache(maxsize=2)
def _pieces(path: str, pattern: str, offsets: bool) -> Pieces:
    return Pieces(path, pattern, offsets)


def _chunks(texts: list[str]) -> Iterator[list[str]]:
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > CHUNK_CHARS:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def encode(
    docs: DataFrame,
    text: str = "text",
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    offsets: bool = True,
) -> DataFrame:
    """``docs`` with ``ids`` (array of int) and, if asked for, ``starts`` and ``ends`` of each token.

    Starts and ends count characters; a token within a character spans that whole character. Null
    and empty texts give empty arrays. Strings that look like special tokens are ordinary text.
    Columns of these names in ``docs`` are replaced; all other columns and all rows are kept.
    ``path`` is the rank file on every executor, by default the installed multilingual one.
    """
    path = path or public_tokenizers.path(RANKS)
    added = ["ids", "starts", "ends"] if offsets else ["ids"]
    names = docs.columns
    kept = [c for c in names if c not in added]
    places = names.index(text)
    schema = T.StructType(
        [docs.schema[c] for c in kept] + [T.StructField(c, T.ArrayType(T.IntegerType(), False)) for c in added]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _pieces(path, pattern, offsets)
        for batch in batches:
            done = 0
            for texts in _chunks([t or "" for t in batch.column(places).to_pylist()]):
                sizes, flat = made.encode(texts)
                bounds = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                part = batch.slice(done, len(texts))
                done += len(texts)
                columns = [part.column(names.index(c)) for c in kept]
                columns += [pa.ListArray.from_arrays(bounds, pa.array(f, pa.int32())) for f in flat]
                yield pa.RecordBatch.from_arrays(columns, [*kept, *added])

    return docs.mapInArrow(run, schema)


def decode(docs: DataFrame, ids: str = "ids", path: str | None = None) -> DataFrame:
    """``docs`` with ``decoded`` (binary, the tokens' bytes) and ``decoded_text``.

    Null ids decode to nothing. Bytes that are no UTF-8 (a sequence cut within a character) stay in
    ``decoded`` as they are and show as U+FFFD in ``decoded_text``. An id outside the vocabulary fails.
    """
    path = path or public_tokenizers.path(RANKS)
    added = ["decoded", "decoded_text"]
    names = docs.columns
    kept = [c for c in names if c not in added]
    place = names.index(ids)
    schema = T.StructType(
        [docs.schema[c] for c in kept]
        + [T.StructField("decoded", T.BinaryType()), T.StructField("decoded_text", T.StringType())]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(place)
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            decoded = decoded_bytes(flat, column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), path)
            texts = [b.as_py().decode("utf-8", "replace") for b in decoded]
            columns = [batch.column(names.index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, decoded, pa.array(texts, pa.string())], [*kept, *added])

    return docs.mapInArrow(run, schema)


def decode_pieces(pieces: Iterable[Iterable[int]], path: str | None = None) -> Iterator[str]:
    """The text of ids that arrive in pieces: a character split between two comes with the later one."""
    path = path or public_tokenizers.path(RANKS)
    reader = codecs.getincrementaldecoder("utf-8")("replace")
    for piece in pieces:
        ids = np.array(list(piece), np.int64)
        yield reader.decode(decoded_bytes(ids, np.array([len(ids)]), path)[0].as_py())
    yield reader.decode(b"", final=True)


def round_trip(
    docs: DataFrame, key: str, text: str = "text", path: str | None = None, pattern: str = public_tokenizers.PATTERN
) -> DataFrame:
    """Encode each text and decode its ids again, in one pass that keeps neither.

    Columns: ``key``; ``n_tokens`` long; ``ids_sha256`` of the ids as little-endian unsigned 32-bit
    integers; ``decoded_sha256`` of the decoded bytes; ``same`` boolean, whether those are the text's.
    """
    path = path or public_tokenizers.path(RANKS)
    schema = T.StructType(
        [docs.schema[key]]
        + [T.StructField("n_tokens", T.LongType())]
        + [T.StructField(c, T.StringType()) for c in ("ids_sha256", "decoded_sha256")]
        + [T.StructField("same", T.BooleanType())]
    )
    names = schema.fieldNames()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _pieces(path, pattern, False)
        for batch in batches:
            done = 0
            for texts in _chunks([t or "" for t in batch.column(1).to_pylist()]):
                sizes, (ids,) = made.encode(texts)
                decoded = decoded_bytes(ids, sizes, path).to_pylist()
                raw, ends = ids.astype("<u4").tobytes(), 4 * np.cumsum(sizes)
                hashed = [sha256(raw[a:b]).hexdigest() for a, b in zip([0, *ends[:-1]], ends)]
                back = [sha256(d).hexdigest() for d in decoded]
                same = [d == t.encode() for d, t in zip(decoded, texts)]
                part = batch.column(0).slice(done, len(texts))
                done += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [part, *(pa.array(x, t) for x, t in zip((sizes, hashed, back, same), types))], names
                )

    types = [pa.int64(), pa.string(), pa.string(), pa.bool_()]
    return docs.select(key, text).mapInArrow(run, schema)
