"""Token-id output: whole texts as packed rows of an id matrix, with segment lengths and position resets.

Texts are tokenized, an end id follows each, and documents longer than a row are cut without loss.  Within a task the
pieces are packed best-fit, longest first; the bin is found by a segment tree over the free room of open bins.  A task
holds at most ``BUFFER_TOKENS`` tokens; rows that are not nearly full go on into its next buffer.

Each result row is one row of the matrix: ``ids`` (little-endian, ``capacity`` numbers, padded with the end id),
``positions`` (16-bit, 0 again at each segment), ``cu_seqlens`` (0, then the end of each segment), and the document,
piece and first token of each segment.  ``matrices`` joins rows into matrices, ``read_back`` gives documents again.

Defined results: a null text is an empty text; repeated rows, equal and null ids are packed each for itself; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm import bytesops
from riskloom.llm.exprs import quoted

CAPACITY = 2048
BUFFER_TOKENS = 4_000_000
NEARLY_FULL = 0.98

ROWS = (
    "row_id bigint, n_tokens int, ids binary, positions binary, cu_seqlens array<int>, doc_ids array<bigint>, "
    "pieces array<int>, starts array<bigint>"
)


class RoomTree:
    """Open bins by free room; finds the smallest room that is large enough in log(capacity) steps."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.some = [0] * (2 * self.leaves)  # number of open bins below each node
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, b: int) -> None:
        self.bins[room].append(b)
        node = room + self.leaves
        while node:
            self.some[node] += 1
            node >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """(room, bin) with the least room of ``size`` or more."""
        some, node = self.some, size + self.leaves
        if not some[node]:
            while node > 1 and (node & 1 or not some[node + 1]):  # up until a right neighbour holds bins
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:  # down to its smallest room
                node *= 2
                node += not some[node]
        room = node - self.leaves
        while node:
            some[node] -= 1
            node >>= 1
        return room, self.bins[room].pop()


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Items of each bin."""
    tree, bins = RoomTree(capacity), []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = tree.take(sizes[i])
        if found is None:
            room, b = capacity, len(bins)
            bins.append([])
        else:
            room, b = found
        bins[b].append(i)
        if room > sizes[i]:
            tree.add(room - sizes[i], b)
    return bins


def token_rows(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = 0,
    tokenizer: str = "word_bpe_49k.json",
) -> DataFrame:
    """Packed matrix rows of all documents; see the module for their columns."""
    if not 0 < capacity <= 1 << 16:
        raise ValueError("capacity must be 1 to 65536")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from riskloom.llm.tokens import WordTokenizer

        words = None
        base, made = TaskContext.get().partitionId() << 33, 0
        pending: list[tuple] = []  # (doc, piece, start, ids)
        tokens = 0
        for batch in batches:
            words = words or WordTokenizer(tokenizer)
            for at, texts in bytesops.blocks(batch, "text"):
                ids, bounds = words.encode(texts)
                keys = batch.column("doc_id").slice(at, len(texts)).to_pylist()
                for key, lo, hi in zip(keys, bounds[:-1].tolist(), bounds[1:].tolist()):
                    own = np.append(ids[lo:hi], ids.dtype.type(end_id))
                    pending += [(key, n, s, own[s : s + capacity]) for n, s in enumerate(range(0, len(own), capacity))]
                    tokens += len(own)
                if tokens >= BUFFER_TOKENS:
                    out, pending = _packed(pending, capacity, end_id, False)
                    tokens = sum(len(p[3]) for p in pending)
                    for part in _rows(out, base + made, capacity, end_id):
                        made += part.num_rows
                        yield part
        out, _ = _packed(pending, capacity, end_id, True)
        for part in _rows(out, base + made, capacity, end_id):
            made += part.num_rows
            yield part

    return docs.select(
        quoted(id_col).cast("bigint").alias("doc_id"), quoted(text_col).cast("string").alias("text")
    ).mapInArrow(write, ROWS)


def _packed(pieces: list[tuple], capacity: int, end_id: int, last: bool) -> tuple[list[list[tuple]], list[tuple]]:
    """(rows, pieces left for the next buffer)."""
    rows, left = [], []
    for items in best_fit_decreasing([len(p[3]) for p in pieces], capacity):
        row = [pieces[i] for i in items]
        if last or sum(len(p[3]) for p in row) >= NEARLY_FULL * capacity:
            rows.append(row)
        else:
            left += row
    if not last and not rows:  # nothing can be completed by waiting longer
        return _packed(pieces, capacity, end_id, True)
    return rows, left


def _rows(rows: list[list[tuple]], first: int, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("row_id", pa.int64()),
            ("n_tokens", pa.int32()),
            ("ids", pa.binary()),
            ("positions", pa.binary()),
            ("cu_seqlens", pa.list_(pa.int32())),
            ("doc_ids", pa.list_(pa.int64())),
            ("pieces", pa.list_(pa.int32())),
            ("starts", pa.list_(pa.int64())),
        ]
    )
    steps = np.arange(capacity, dtype="<u2")
    for lo in range(0, len(rows), 512):
        out = []
        for n, row in enumerate(rows[lo : lo + 512], first + lo):
            sizes = [len(p[3]) for p in row]
            total = sum(sizes)
            kind = row[0][3].dtype.newbyteorder("<")
            ids = np.full(capacity, end_id, kind)
            ids[:total] = np.concatenate([p[3] for p in row])
            positions = np.concatenate([steps[:s] for s in sizes] + [steps[: capacity - total]])
            ends = [0, *np.cumsum(sizes).tolist()]
            out.append((n, total, ids.tobytes(), positions.tobytes(), ends, *[[p[k] for p in row] for k in range(3)]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema
        )


def matrices(rows: DataFrame, height: int = 256) -> DataFrame:
    """Rows joined into matrices of up to ``height`` rows: one binary id matrix and one position matrix each.

    ``cu_seqlens`` holds the cumulative lengths over the whole matrix without padding between rows; ``row_tokens`` the
    tokens of each row.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, height):
                part = batch.slice(lo, height)
                ends, total = [0], 0
                for e in part.column("cu_seqlens").to_pylist():
                    ends += [total + x for x in e[1:]]
                    total = ends[-1]
                yield pa.RecordBatch.from_pydict(
                    {
                        "matrix_id": pa.array([part.column("row_id")[0].as_py()], pa.int64()),
                        "height": pa.array([part.num_rows], pa.int32()),
                        "ids": pa.array([b"".join(part.column("ids").to_pylist())], pa.binary()),
                        "positions": pa.array([b"".join(part.column("positions").to_pylist())], pa.binary()),
                        "cu_seqlens": pa.array([ends], pa.list_(pa.int64())),
                        "row_tokens": pa.array([part.column("n_tokens").to_pylist()], pa.list_(pa.int32())),
                    }
                )

    return rows.select("row_id", "n_tokens", "ids", "positions", "cu_seqlens").mapInArrow(
        join,
        "matrix_id bigint, height int, ids binary, positions binary, cu_seqlens array<bigint>, row_tokens array<int>",
    )


def write_matrices(rows: DataFrame, path: str, height: int = 256) -> None:
    """Write the matrices below ``path`` through Spark's own writer, so a retried task leaves no double."""
    matrices(rows, height).write.parquet(path)
