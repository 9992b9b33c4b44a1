"""Chat formatting in budgeted windows.

The rows of a conversation come by turn. Prefix sums of their tokens, counted of the turns as they
are written, choose spans of whole turns that fit a budget; each window starts with the system turn and some turns of history, which are repeated
and masked, and ends with new turns. Every assistant text is under the loss mask once.

A turn is written ``<turn NUMBER KIND ROLE>TEXT</turn>`` and a line break; KIND is ``new`` or
``repeat``. ``\\``, ``<`` and ``>`` in roles and texts get a ``\\`` before them, so a text can hold any
control string and is read back as it was.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from hashlib import sha256

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCABULARY = "byte_bpe_50k.json"
#: History takes at most the budget divided by this.
HISTORY_SHARE = 3
_TURN = re.compile(r"<turn (\d+) (new|repeat) ((?:[^\\<>]+|\\.)*)>((?:[^\\<>]+|\\.)*)</turn>\n", re.DOTALL)
SPAN = T.StructType().add("start", "integer").add("end", "integer")
WINDOW = T.StructType(
    [
        T.StructField("window", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("loss", T.ArrayType(SPAN)),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("first_turn", T.LongType()),
        T.StructField("n_new", T.LongType()),
    ]
)


def escape(text: str) -> str:
    return re.sub(r"[\\<>]", r"\\\g<0>", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def read_turns(window: str) -> Iterator[tuple[int, bool, str, str, int, int]]:
    """Number, whether new, role, text, and where the text begins and ends, of each turn of a window."""
    end = 0
    for found in _TURN.finditer(window):
        if found.start() != end:
            break
        end = found.end()
        number, kind, role, text = found.groups()
        yield int(number), kind == "new", unescape(role), unescape(text), found.start(4), found.end(4)
    if end != len(window):
        raise ValueError(f"no turn at character {end}")


@lru_cache(maxsize=2)
def _counter(path: str):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True
    return made


@lru_cache(maxsize=100_000)
def _size(path: str, text: str) -> int:
    """Tokens of a short piece of a turn's mark."""
    return len(_counter(path).encode(text, add_special_tokens=False).ids)


def _marks(path: str, number: int) -> tuple[int, int]:
    """Tokens of ``<turn NUMBER new`` and ``<turn NUMBER repeat``. A space begins a token, so sizes add up."""
    both = _size(path, "<turn") + _size(path, f" {number}")
    return both + _size(path, " new"), both + _size(path, " repeat")


def count_tokens(turns: DataFrame, role: str, text: str, path: str) -> DataFrame:
    """``turns`` with ``n_tokens`` of what is written behind a turn's KIND, counted before rows of a conversation meet."""
    names = turns.columns
    places = names.index(role), names.index(text)
    schema = T.StructType([*turns.schema.fields, T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _counter(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                roles, bodies = (part.column(p).to_pylist() for p in places)
                texts = [f" {escape(r)}>{escape(t)}</turn>\n" for r, t in zip(roles, bodies)]
                sizes = [len(e.ids) for e in made.encode_batch_fast(texts, add_special_tokens=False)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sizes, pa.int64())], [*names, "n_tokens"])

    return turns.mapInArrow(run, schema)


@dataclass
class _Turn:
    number: int
    role: str
    text: str
    tokens: int  # as a new turn
    again: int  # as a repeated one
    before: int  # tokens of all turns before this one: the prefix sum

    def written(self, new: bool) -> tuple[str, int, int]:
        head = f"<turn {self.number} {'new' if new else 'repeat'} {escape(self.role)}>"
        body = escape(self.text)
        return f"{head}{body}</turn>\n", len(head), len(head) + len(body)


@dataclass
class _Windows:
    """The windows of one conversation, made as its turns come. Holds no more than a window's turns."""

    budget: int
    history: int
    path: str
    system: _Turn | None = None
    past: list[_Turn] = field(default_factory=list)
    new: list[_Turn] = field(default_factory=list)
    repeated: list[_Turn] = field(default_factory=list)
    count: int = 0
    total: int = 0
    turns: int = 0

    def _begin(self, turn: _Turn) -> None:
        """Choose what a window repeats: the system turn, then the last turns that fit in a share of the budget."""
        self.repeated = [self.system] if self.system and self.count else []
        fixed = sum(t.again for t in self.repeated)
        room = min(self.budget // HISTORY_SHARE, self.budget - fixed - turn.tokens)
        for old in reversed(self.past[-self.history :] if self.history else []):
            if old.again > room:
                break
            self.repeated.insert(1 if fixed or self.system in self.repeated else 0, old)
            room -= old.again

    def add(self, role: str, text: str, tokens: int) -> dict | None:
        """A turn of ``tokens`` behind its KIND."""
        new, again = _marks(self.path, self.turns)
        turn = _Turn(self.turns, role, text, tokens + new, tokens + again, self.total)
        done = None
        fixed = sum(t.again for t in self.repeated)
        if self.new and fixed + turn.before - self.new[0].before + turn.tokens > self.budget:
            done = self.close()
        if not self.new:
            self._begin(turn)
        if turn.number == 0 and role == "system":
            self.system = turn
        self.new.append(turn)
        self.turns += 1
        self.total += turn.tokens
        return done

    def close(self) -> dict | None:
        if not self.new:
            return None
        span = self.total - self.new[0].before
        repeated = self.repeated
        text, loss, at = [], [], 0
        for turn, new in [(t, False) for t in repeated] + [(t, True) for t in self.new]:
            written, begin, end = turn.written(new)
            if new and turn.role == "assistant":
                loss.append({"start": at + begin, "end": at + end})
            text.append(written)
            at += len(written)
        made = {
            "window": self.count,
            "text": "".join(text),
            "loss": loss,
            "n_tokens": sum(t.again for t in repeated) + span,
            "first_turn": self.new[0].number,
            "n_new": len(self.new),
        }
        keep = [t for t in [*self.past, *self.new] if t is not self.system]
        self.past = keep[-self.history :] if self.history else []
        self.new, self.count = [], self.count + 1
        return made


def format_windows(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    budget: int = 1024,
    history: int = 2,
    path: str | None = None,
) -> DataFrame:
    """One row per window: ``conversation``, then ``window``, ``text``, ``loss``, ``n_tokens``, ``first_turn``, ``n_new``.

    Rows go by ``turn`` (nulls first); ties by role and text; repeated rows are turns of their own. A
    null role or text is empty; rows with a null conversation are one conversation. The first turn,
    if its role is ``system``, is in every window; up to ``history`` earlier turns are repeated while
    they fit in a third of the budget. ``n_tokens`` are those of the whole ``text``, marks and escapes
    included. A turn that does not fit beside the system turn has a window of its own with it: turns
    are never cut, and no other window is over the budget. ``loss`` are
    the character ranges of the new assistant texts, as escaped. Other columns play no part.

    Windows are made from a sorted stream that holds one window at a time, so a conversation may be
    of any length. An empty table gives no windows.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    rows = turns.select(
        F.col(f"`{conversation}`").alias("c"),
        F.col(f"`{turn}`").alias("t"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("r"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("x"),
    )
    ordered = count_tokens(rows, "r", "x", path).repartition("c").sortWithinPartitions("c", "t", "r", "x")
    schema = T.StructType([T.StructField(conversation, rows.schema["c"].dataType), *WINDOW.fields])
    kinds = [pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))] + [pa.int64()] * 3

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, at, ids, found, kind = None, object(), [], [], None

        def out() -> pa.RecordBatch:
            columns = [pa.array([w[n] for w in found], k) for n, k in zip(WINDOW.fieldNames(), kinds)]
            made = pa.RecordBatch.from_arrays([pa.array(ids, kind), *columns], [conversation, *WINDOW.fieldNames()])
            ids.clear()
            found.clear()
            return made

        def put(window) -> None:
            if window:
                ids.append(at)
                found.append(window)

        for batch in batches:
            kind = batch.schema.field("c").type
            columns = [batch.column(n).to_pylist() for n in ("c", "r", "x", "n_tokens")]
            for c, r, x, n in zip(*columns):
                if state is None or c != at:
                    if state:
                        put(state.close())
                    state, at = _Windows(budget, history, path), c
                put(state.add(r, x, n))
            if len(found) > 500:
                yield out()
        if state:
            put(state.close())
        if found:
            yield out()

    return ordered.mapInArrow(run, schema)


def read_back(windows: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """What the windows of each conversation say: turns, loss and characters, each turn counted where it is new."""
    key = windows.schema[conversation].dataType
    rows = windows.select(F.col(f"`{conversation}`").alias("c"), "window", "text", "loss")
    ordered = rows.repartition("c").sortWithinPartitions("c", "window")
    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows"]
    texts = {"turns_sha256", "loss_sha256"}
    schema = T.StructType(
        [T.StructField(conversation, key)]
        + [T.StructField(n, T.StringType() if n in texts else T.LongType()) for n in names]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, ids, found, kind = object(), None, [], [], None

        def put() -> None:
            if state:
                ids.append(at)
                found.append([state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5]])

        def out() -> pa.RecordBatch:
            columns = [
                pa.array([f[i] for f in found], pa.string() if n in texts else pa.int64()) for i, n in enumerate(names)
            ]
            made = pa.RecordBatch.from_arrays([pa.array(ids, kind), *columns], [conversation, *names])
            ids.clear()
            found.clear()
            return made

        for batch in batches:
            kind = batch.schema.field("c").type
            for c, text, loss in zip(*(batch.column(n).to_pylist() for n in ("c", "text", "loss"))):
                if state is None or c != at:
                    put()
                    at, state = c, [0, sha256(), 0, sha256(), 0, 0]
                for _, new, role, body, _, _ in read_turns(text):
                    if new:
                        state[0] += 1
                        state[1].update(f"{role}\n{body}\n".encode())
                for span in loss:
                    body = unescape(text[span["start"] : span["end"]])
                    state[2] += len(body)
                    state[3].update(body.encode())
                state[4] += len(text)
                state[5] += 1
            if len(found) > 5000:
                yield out()
        put()
        if found:
            yield out()

    return ordered.mapInArrow(run, schema)
