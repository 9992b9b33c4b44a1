"""WARC archives with revisit records, and a capture index merged from locally sorted runs.

Records are written by Spark's text writer, gzipped, one archive per task; payloads are UTF-8. Each
archive that is read back gives a run of captures sorted by URL key and time. The runs are dealt into
ranges of keys, and each range merges its slices of all runs with a loser tree, which yields capture
histories in one global order.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterable, Iterator
from hashlib import sha1
from typing import Any
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadweir.llm.common import blocks_for, staged, tidy_shuffles
from loadweir.session import shared_dir

END = "\r\n\r\n"
#: Records of one archive at most, bytes of its payloads, about, and captures of one range of the index, about.
ARCHIVE_RECORDS = 20_000
ARCHIVE_BYTES = 256 * 1024 * 1024
RANGE_CAPTURES = 200_000
#: Bytes that are packed, and unpacked, in one step while an archive is read.
STEP = 256 * 1024
CAPTURE = (
    "url_key string, captured string, record_id string, url string, record_type string, refers_to string,"
    " payload_digest string, payload_bytes long, archive string, offset long, length long"
)
NAMES = [part.split()[0] for part in CAPTURE.split(", ")]
KINDS = [pa.int64() if part.endswith("long") else pa.string() for part in CAPTURE.split(", ")]


def url_key(url: str) -> str:
    """The key by which captures of a URL stand together: host from the right, then path and query, in lower case."""
    try:
        parts = urlsplit(url.strip().lower())
        host = ",".join(reversed((parts.hostname or "").split(".")))
    except ValueError:
        return url.lower()
    return f"{host}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def _line(text: str) -> str:
    """A header's value: line breaks as %0D and %0A."""
    return text.replace("\r", "%0D").replace("\n", "%0A")


def record(record_id: str, url: str, captured: str, payload: str, digest: str, refers_to: str | None) -> str:
    """A record without its closing :data:`END`; a revisit leaves out the payload but has its size and digest."""
    raw = payload.encode()
    body = "" if refers_to is not None else payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{_line(record_id)}>",
        f"WARC-Target-URI: {_line(url)}",
        f"WARC-Date: {captured}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Bytes: {len(raw)}",
    ]
    if refers_to is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{_line(refers_to)}>")
    head.append(f"Content-Length: {len(raw) if body else 0}")
    return "\r\n".join(head) + END + body


def _digest(raw: bytes) -> str:
    return base64.b32encode(sha1(raw).digest()).decode()


def write(pages: DataFrame, path: str, page_id: str, url: str, html: str, captured: Column, least_bytes: int = 0) -> None:
    """Write a record for every row of ``pages`` as gzipped archives in the folder ``path``.

    Archives hold at most :data:`ARCHIVE_RECORDS` and, if a task's payloads are of mean length, about
    :data:`ARCHIVE_BYTES`. Of rows with equal payloads of at least ``least_bytes`` bytes, that with the largest ``page_id``
    (of repeated rows one) is a response, the others are revisits of it; smaller ones are all
    responses. A null payload is empty; a null id or URL is written as an empty one.
    """
    spark = pages.sparkSession
    body = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    rows = staged(
        pages.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(f"`{page_id}`").alias("id"),
            F.coalesce(F.col(f"`{url}`"), F.lit("")).alias("url"),
            F.coalesce(F.date_format(captured, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("1970-01-01T00:00:00Z")).alias("at"),
            body.alias("body"),
            F.sha1(body.cast("binary")).alias("sha"),
            F.octet_length(body).alias("size"),
        ),
        "payloads",
    )
    # payloads stay where they are: only ids and digests meet by digest
    small = rows.select("row", "id", "sha", "size")
    first = small.where(F.col("size") >= least_bytes).groupBy("sha").agg(F.max(F.struct("id", "row")).alias("top"))
    revisits = small.where(F.col("size") >= least_bytes).join(first, "sha").where(F.col("row") != F.col("top.row"))
    revisits = revisits.select("row", F.coalesce(F.col("top.id").cast("string"), F.lit("")).alias("refers_to"))
    joined = rows.join(revisits, "row", "left").select("id", "url", "at", "body", "sha", "refers_to")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [
                record("" if i is None else str(i), u, at, body, base64.b32encode(bytes.fromhex(sha)).decode(), refers)
                for i, u, at, body, sha, refers in zip(*(c.to_pylist() for c in batch.columns))
            ]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.string())], ["value"])

    writer = joined.mapInArrow(run, "value string").write.option("lineSep", END).option("compression", "gzip")
    mean = rows.agg(F.avg("size")).first()[0] or 1
    most = max(1, min(ARCHIVE_RECORDS, int(ARCHIVE_BYTES // max(mean, 1))))
    writer.option("maxRecordsPerFile", most).text(path)


def unpacked(packed: memoryview, step: int = STEP) -> Iterator[bytes]:
    """What a gzipped archive holds, in pieces of at most ``step`` bytes; its gzip members follow one another."""
    unpack = zlib.decompressobj(wbits=47)
    for start in range(0, len(packed), step):
        part = bytes(packed[start : start + step])
        while True:
            piece = unpack.decompress(part, step)
            if piece:
                yield piece
            part = unpack.unconsumed_tail
            if unpack.eof:
                part = unpack.unused_data
                if not part:
                    break
                unpack = zlib.decompressobj(wbits=47)
            elif not part and len(piece) < step:
                break
        if unpack.eof and start + step < len(packed):
            unpack = zlib.decompressobj(wbits=47)
    if len(packed) and not unpack.eof:
        raise ValueError("the archive is cut off")


def parse(pieces: Iterable[bytes]) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Offset, length, headers and payload of each record of an unpacked archive, which comes in ``pieces``.

    One record, and what follows it in its last piece, is held at a time.
    """
    held, at, left = bytearray(), 0, iter(pieces)

    def more() -> bool:
        piece = next(left, None)
        held.extend(piece or b"")
        return piece is not None

    while held or more():
        seen = 0
        while (split := held.find(END.encode(), seen)) < 0:
            seen = max(0, len(held) - len(END) + 1)
            if not b"WARC/".startswith(held[:5]) or not more():
                raise ValueError(f"no record at byte {at}")
        if not held.startswith(b"WARC/"):
            raise ValueError(f"no record at byte {at}")
        lines = held[:split].decode().split("\r\n")[1:]
        headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
        begin = split + 4
        end = begin + int(headers["Content-Length"])
        while len(held) < end + 4 and more():
            pass
        if held[end : end + 4] != END.encode():
            raise ValueError(f"the record at byte {at} does not end at byte {at + end}")
        yield at, end + 4, headers, bytes(held[begin:end])
        at += end + 4
        del held[: end + 4]


def _id(urn: str | None) -> str | None:
    return None if urn is None else urn.removeprefix("<urn:page:").removesuffix(">")


def runs(spark: SparkSession, path: str) -> DataFrame:
    """The captures of each archive of ``path``, with ``place``, their order by URL key, time and offset within it.

    A worker holds an archive as it is packed, one record unpacked, and the captures. A response whose payload has another digest than its header fails the job.
    """
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                found: list[tuple[Any, ...]] = []
                for offset, length, head, payload in parse(unpacked(memoryview(content.as_buffer()))):
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    if head["WARC-Type"] == "response" and _digest(payload) != digest:
                        raise ValueError(f"the payload at byte {offset} of {name} is not the one written")
                    uri, refers = head["WARC-Target-URI"], _id(head.get("WARC-Refers-To"))
                    size, rid = int(head["X-Payload-Bytes"]), _id(head["WARC-Record-ID"])
                    found.append(
                        (url_key(uri), head["WARC-Date"], rid, uri, head["WARC-Type"], refers, digest, size, name, offset, length)
                    )
                found.sort(key=lambda r: (r[0], r[1], r[8], r[9]))
                if found:
                    columns = [pa.array(c, k) for c, k in zip(zip(*found), KINDS)]
                    places = pa.array(range(len(found)), pa.int64())
                    yield pa.RecordBatch.from_arrays([*columns, places], [*NAMES, "place"])

    return archives.mapInArrow(run, f"{CAPTURE}, place long")


class LoserTree:
    """Merges sorted sequences: each inner node keeps the loser of its match, the root the winner.

    After the winner is taken, only the matches on its way to the root are played again.
    """

    def __init__(self, sequences: list[Iterator[tuple]]):
        self.sequences = sequences
        self.size = len(sequences)
        self.heads = [next(s, None) for s in sequences]
        self.losers = [0] * max(1, self.size)
        winners = [0] * self.size + list(range(self.size))
        for node in range(self.size - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._before(a, b) else (b, a)
        self.winner = winners[1] if self.size > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or (x, a) < (y, b))

    def __iter__(self) -> Iterator[tuple]:
        while self.size and self.heads[self.winner] is not None:
            yield self.heads[self.winner]
            best = self.winner
            self.heads[best] = next(self.sequences[best], None)
            node = (best + self.size) // 2
            while node:
                if self._before(self.losers[node], best):
                    best, self.losers[node] = self.losers[node], best
                node //= 2
            self.winner = best


def merge(found: DataFrame) -> DataFrame:
    """The captures of staged :func:`runs` in global order: that of ``range``, then of ``position``.

    Ranges of URL key, time, archive and offset hold about :data:`RANGE_CAPTURES`, so that a URL
    captured very often spans several. A range holds its slices of the runs as keys in memory.
    """
    spark = found.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), blocks_for(found.count(), RANGE_CAPTURES))
    order = ["url_key", "captured", "archive", "offset"]
    dealt = found.repartitionByRange(ranges, *order).sortWithinPartitions("archive", "place")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        keys = [table.column(c).to_pylist() for c in order]
        starts = [0] + [i for i in range(1, len(table)) if keys[2][i] != keys[2][i - 1]] + [len(table)]
        slices = [
            zip(*(k[a:b] for k in keys), range(a, b)) for a, b in zip(starts, starts[1:])
        ]
        merged = table.take(pa.array([row[4] for row in LoserTree(slices)], pa.int64())).drop_columns(["place"])
        task = pa.array([TaskContext.get().partitionId()] * len(table), pa.int32())
        merged = merged.append_column("range", task).append_column("position", pa.array(range(len(table)), pa.int64()))
        yield from merged.to_batches(max_chunksize=10_000)

    return dealt.mapInArrow(run, f"{CAPTURE}, range int, position long")


def archive_and_index(
    pages: DataFrame, captured: Column, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0
) -> DataFrame:
    """Write ``pages`` as archives in the shared folder, read them back, and return their merged index."""
    spark = pages.sparkSession
    path = shared_dir(spark, "archives")
    with tidy_shuffles(spark):
        write(pages, path, page_id, url, html, captured, least_bytes)
        return staged(merge(staged(runs(spark, path), "runs")), "index")
