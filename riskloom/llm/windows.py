"""Bounded-space online packing: token streams into fixed-length sequences with a fixed number of open windows.

Every task reads its documents once and keeps ``OPEN_WINDOWS`` windows open.  A document (its ids and the end id; what
is longer than a window first gives whole windows) goes into the open window where it leaves the least room.  Where it
fits into none and no more windows may be opened, the fullest window is emitted: it is first filled up with the head of
the document, whose rest is placed anew.  At the end of a task up to ``OPEN_WINDOWS`` windows are left over.  They are
packed again in the same way, ``GROUP`` of them in a task, until one group is left; its last windows are joined, and the
last one is cut into powers of two, which need no padding.  So no token of padding is made, and a task holds a bounded
number of tokens, however large its input is.

``pack_documents`` gives the sequences with their ids, ``pieces`` their segments, ``padded`` the length that a sequence
takes.

Defined results: a null text is an empty text (its only token is the end id); repeated rows and equal ids are packed
each for itself; a null document id stays null; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm import bytesops
from riskloom.llm.exprs import quoted
from riskloom.session import stage

CAPACITY = 1024
OPEN_WINDOWS = 64
GROUP = 1024  # left-over windows that a task packs again

SEQUENCES = (
    "sequence_id bigint, fill int, complete boolean, ids binary, doc_ids array<bigint>, starts array<bigint>, "
    "lengths array<int>, doc_tokens array<bigint>"
)
_ARROW = pa.schema(
    [
        ("sequence_id", pa.int64()),
        ("fill", pa.int32()),
        ("complete", pa.bool_()),
        ("ids", pa.binary()),
        ("doc_ids", pa.list_(pa.int64())),
        ("starts", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int32())),
        ("doc_tokens", pa.list_(pa.int64())),
    ]
)

#: A piece: document, its first token, tokens of the document, the ids.
Piece = tuple[int | None, int, int, np.ndarray]


def _cut(item: list[Piece], head: int) -> tuple[list[Piece], list[Piece]]:
    """The first ``head`` tokens of an item and the rest."""
    for n, (doc, start, tokens, ids) in enumerate(item):
        if head < len(ids):
            tail = [(doc, start + head, tokens, ids[head:])] + item[n + 1 :]
            return item[:n] + ([(doc, start, tokens, ids[:head])] if head else []), tail
        head -= len(ids)
    return item, []


class Windows:
    """Open windows by room; complete ones are collected in ``full``."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.by_room: dict[int, list[list[Piece]]] = {}
        self.rooms = 0  # bit r is set if a window with r free places is open
        self.open = 0
        self.full: list[list[Piece]] = []

    def _take(self, room: int) -> list[Piece]:
        windows = self.by_room[room]
        window = windows.pop()
        if not windows:
            self.rooms &= ~(1 << room)
        self.open -= 1
        return window

    def _put(self, window: list[Piece], room: int) -> None:
        if room:
            self.by_room.setdefault(room, []).append(window)
            self.rooms |= 1 << room
            self.open += 1
        else:
            self.full.append(window)

    def add(self, item: list[Piece], size: int) -> None:
        while size > self.capacity:
            head, item = _cut(item, self.capacity)
            self.full.append(head)
            size -= self.capacity
        while size:
            fits = self.rooms >> size
            if fits:  # best fit
                room = size + (fits & -fits).bit_length() - 1
                self._put(self._take(room) + item, room - size)
                return
            if self.open < self.limit:
                self._put(item, self.capacity - size)
                return
            room = (self.rooms & -self.rooms).bit_length() - 1  # the fullest goes
            head, item = _cut(item, room)
            self.full.append(self._take(room) + head)
            size -= room

    def left(self) -> list[list[Piece]]:
        """What is still open, the fullest first."""
        return [w for room in sorted(self.by_room) for w in self.by_room[room]]

    def joined(self) -> list[list[Piece]]:
        """What is still open as complete sequences: joined to whole windows, the last cut at powers of two."""
        rest = [p for w in self.left() for p in w]
        size, out = sum(len(p[3]) for p in rest), []
        while size:
            n = self.capacity if size >= self.capacity else 1 << (size.bit_length() - 1)
            head, rest = _cut(rest, n)
            out.append(head)
            size -= n
        return out


def _rows(windows: list[list[Piece]], complete: bool, first: int) -> Iterator[pa.RecordBatch]:
    for lo in range(0, len(windows), 512):
        part = windows[lo : lo + 512]
        ids = [np.concatenate([p[3] for p in w]) for w in part]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(first + lo, first + lo + len(part)), pa.int64()),
                pa.array(map(len, ids), pa.int32()),
                pa.array([complete] * len(part), pa.bool_()),
                pa.array([x.astype(x.dtype.newbyteorder("<")).tobytes() for x in ids], pa.binary()),
                pa.array([[p[0] for p in w] for w in part], _ARROW.field("doc_ids").type),
                pa.array([[p[1] for p in w] for w in part], _ARROW.field("starts").type),
                pa.array([[len(p[3]) for p in w] for w in part], _ARROW.field("lengths").type),
                pa.array([[p[2] for p in w] for w in part], _ARROW.field("doc_tokens").type),
            ],
            schema=_ARROW,
        )


def _packing(items, capacity: int, limit: int, number: int, last: bool):
    """A task's work: ``items`` turns its batches into (item, size); ``last`` closes what is left, too."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made = number << 56 | TaskContext.get().partitionId() << 32
        windows = Windows(capacity, limit)
        for item, size in items(batches):
            windows.add(item, size)
            if len(windows.full) >= 2048:
                yield from _rows(windows.full, True, made)
                made += len(windows.full)
                windows.full = []
        done = windows.full + (windows.joined() if last else [])
        yield from _rows(done, True, made)
        if not last:
            yield from _rows(windows.left(), False, made + len(done))

    return pack


def _documents(tokenizer: str, end_id: int):
    def items(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[Piece], int]]:
        from riskloom.llm.chunk_tokens import ByteTokenizer, shared

        for batch in batches:
            model = shared(ByteTokenizer, tokenizer)
            for at, texts in bytesops.blocks(batch, "text"):
                ids, bounds = model.encode([t or b"" for t in texts])
                keys = batch.column("doc_id").slice(at, len(texts)).to_pylist()
                end = np.array([end_id], ids.dtype)
                for key, lo, hi in zip(keys, bounds[:-1].tolist(), bounds[1:].tolist()):
                    own = np.concatenate([ids[lo:hi], end])
                    yield [(key, 0, len(own), own)], len(own)

    return items


def _left_over(width: int):
    def items(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[Piece], int]]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, at, item = np.frombuffer(row["ids"], f"<u{width}"), 0, []
                for doc, start, n, tokens in zip(row["doc_ids"], row["starts"], row["lengths"], row["doc_tokens"]):
                    item.append((doc, start, tokens, ids[at : at + n]))
                    at += n
                yield item, at

    return items


def id_width(tokenizer: str) -> int:
    """Bytes of an id in ``ids``: 2, or 4 where the vocabulary is larger."""
    from riskloom.llm.chunk_tokens import ByteTokenizer, shared

    return shared(ByteTokenizer, tokenizer).dtype().itemsize


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    open_windows: int = OPEN_WINDOWS,
    end_id: int = 0,
    tokenizer: str = "byte_bpe_50k.json",
) -> DataFrame:
    """Sequences: ``sequence_id``, ``fill`` tokens, their ``ids`` (little-endian, ``id_width`` bytes each) and, in order
    of place, each segment's document, first token, length and the document's number of tokens."""
    if capacity < 1 or open_windows < 1:
        raise ValueError("capacity and open_windows must be positive")
    texts = docs.select(quoted(id_col).cast("bigint").alias("doc_id"), quoted(text_col).cast("string").alias("text"))
    work = _packing(_documents(tokenizer, end_id), capacity, open_windows, 0, False)
    made = [stage(texts.mapInArrow(work, SEQUENCES), "windows")]
    items, width = _left_over(id_width(tokenizer)), max(GROUP, 4 * open_windows)
    while True:
        rest = made[-1].filter(~F.col("complete"))
        groups = -(-rest.count() // width)
        if not groups:
            break
        dealt = rest.repartition(groups, F.pmod(F.xxhash64("sequence_id"), F.lit(groups)))
        if groups == 1:
            dealt = dealt.coalesce(1)
        work = _packing(items, capacity, open_windows, len(made), groups == 1)
        made.append(stage(dealt.mapInArrow(work, SEQUENCES), "windows"))
    every = made[0]
    for more in made[1:]:
        every = every.unionByName(more)
    return every.filter("complete").drop("complete")


def padded(fill: Column, capacity: int = CAPACITY) -> Column:
    """The length a sequence takes: its own where that is a power of two, else the capacity."""
    return F.when(F.bit_count(fill) == 1, fill).otherwise(F.lit(capacity)).cast("int")


def pieces(sequences: DataFrame, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """One row per segment, with the CRC of its ids as little-endian 32-bit numbers."""
    width = id_width(tokenizer)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                sizes = part.column("lengths").value_lengths().to_numpy()
                flat = {n: part.column(n).flatten() for n in ("doc_ids", "starts", "lengths", "doc_tokens")}
                lengths = flat["lengths"].to_numpy().astype(np.int64)
                before = np.cumsum(lengths) - lengths
                raw = np.frombuffer(b"".join(part.column("ids").to_pylist()), f"<u{width}").astype("<u4")
                crcs = [zlib.crc32(raw[a : a + n]) for a, n in zip(before.tolist(), lengths.tolist())]
                first = np.cumsum(sizes) - sizes
                yield pa.RecordBatch.from_arrays(
                    [
                        flat["doc_ids"],
                        flat["starts"],
                        pa.array(lengths),
                        pa.array(crcs, pa.int64()),
                        flat["doc_tokens"],
                        pa.array(np.repeat(part.column("sequence_id").to_numpy(), sizes)),
                        pa.array(before - np.repeat(before[first], sizes)),
                    ],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
                )

    return sequences.select("sequence_id", "ids", "doc_ids", "starts", "lengths", "doc_tokens").mapInArrow(
        read,
        "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    )
