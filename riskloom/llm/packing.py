"""Best-fit packing of token pieces into fixed-length sequences by hierarchical merging of underfull bins.

Every partition packs its own pieces best-fit, largest first.  Bins that are nearly full are done; the others become
items of the next round, which deals them to fewer groups and packs again, until one group of bounded size is left or
a round at the smallest number of groups saves nothing.  A bin carries the list of its pieces, at most one per token,
so a record is bounded; no task holds more than ``GROUP_ITEMS`` items at once.

Defined results: a null text is an empty text (its only token is the end id); repeated rows and equal ids are packed
each for itself; a null document id stays null; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm import bytesops
from riskloom.llm.exprs import quoted
from riskloom.session import stage

CAPACITY = 2048
SLACK = 8  # a bin with at most so many free places is done
GROUP_ITEMS = 200_000  # items that one task packs at a time
FAN_IN = 8  # groups merged into one by a round

PIECES = "doc_id bigint, piece int, start bigint, length int, ids_crc32 bigint"
BINS = (
    "bin bigint, fill int, doc_ids array<bigint>, pieces array<int>, starts array<bigint>, lengths array<int>, "
    "crcs array<bigint>"
)
LISTS = ("doc_ids", "pieces", "starts", "lengths", "crcs")


def token_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = 0,
    tokenizer: str = "word_bpe_49k.json",
) -> DataFrame:
    """One row per piece: the ids of each text and ``end_id``, cut only where they are more than ``capacity``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from riskloom.llm.tokens import WordTokenizer

        words = None
        for batch in batches:
            words = words or WordTokenizer(tokenizer)
            for at, texts in bytesops.blocks(batch, "text"):
                ids, bounds = words.encode(texts)
                rows = []
                keys = batch.column("doc_id").slice(at, len(texts)).to_pylist()
                for key, lo, hi in zip(keys, bounds[:-1].tolist(), bounds[1:].tolist()):
                    own = np.append(ids[lo:hi].astype("<u4"), np.uint32(end_id)).astype("<u4")
                    for n, start in enumerate(range(0, len(own), capacity)):
                        part = own[start : start + capacity]
                        rows.append((key, n, start, len(part), zlib.crc32(part.tobytes())))
                yield _batch(rows, PIECES)

    return docs.select(
        quoted(id_col).cast("bigint").alias("doc_id"), quoted(text_col).cast("string").alias("text")
    ).mapInArrow(cut, PIECES)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [[] for _ in fields]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields]
    )


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each item: longest first, each into the open bin where it leaves the least room."""
    bins = np.empty(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if a bin with r free places is open
    made = 0
    sizes = lengths.tolist()
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = sizes[i]
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms &= ~(1 << room)
        else:
            b, room = made, capacity
            made += 1
        bins[i] = b
        left = room - size
        if left:
            open_bins[left].append(b)
            rooms |= 1 << left
    return bins


def _merged(items: pa.Table, capacity: int) -> pa.Table:
    """The bins made of ``items``, each with the pieces of all its items."""
    fills = items.column("fill").to_numpy()
    which = best_fit(fills, capacity)
    order = np.argsort(which, kind="stable")
    head = np.flatnonzero(np.diff(which[order], prepend=-1))
    taken = items.take(pa.array(order)).combine_chunks()
    out = {"bin": taken.column("bin").take(pa.array(head)), "fill": pa.array(np.add.reduceat(fills[order], head), pa.int32())}
    for name in LISTS:
        lists = taken.column(name).combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        sizes = lists.value_lengths().to_numpy()
        ends = np.concatenate([np.add.reduceat(sizes, head)]) if len(head) else np.zeros(0, np.int64)
        out[name] = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(ends)]), pa.int32()), lists.flatten()
        )
    return pa.table(out)


def _pack_partition(capacity: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, GROUP_ITEMS):
                part = batch.slice(lo, GROUP_ITEMS)
                if n + part.num_rows > GROUP_ITEMS and held:
                    yield from _merged(pa.Table.from_batches(held), capacity).to_batches(20_000)
                    held, n = [], 0
                held.append(part)
                n += part.num_rows
        if n:
            yield from _merged(pa.Table.from_batches(held), capacity).to_batches(20_000)

    return pack


def pack(pieces: DataFrame, capacity: int = CAPACITY, slack: int = SLACK) -> DataFrame:
    """Each piece with its ``sequence_id`` and ``offset``; sequences hold at most ``capacity`` tokens.

    ``pieces`` has doc_id, piece, start, length (1 to ``capacity``) and ids_crc32, as ``token_pieces`` gives them.
    """
    spark = pieces.sparkSession
    source = stage(pieces, "pieces")
    items = source.select(
        F.monotonically_increasing_id().alias("bin"),
        F.col("length").alias("fill"),
        *[
            F.array(c).alias(n)
            for c, n in zip(("doc_id", "piece", "start", "length", "ids_crc32"), LISTS)
        ],
    )
    done = []
    count, groups = None, None
    while True:
        bins = stage(items.mapInArrow(_pack_partition(capacity), BINS), "bins")
        done.append(bins.filter(F.col("fill") >= capacity - slack))
        rest = bins.filter(F.col("fill") < capacity - slack)
        left = rest.count()
        if left == 0:
            break
        least = -(-left // GROUP_ITEMS)
        if groups == least and (groups == 1 or left > 0.999 * count):
            done.append(rest)
            break
        before = groups or max(1, source.count() // GROUP_ITEMS, bins.select(F.spark_partition_id()).distinct().count())
        groups, count = max(least, -(-before // FAN_IN)), left
        items = rest.repartition(groups, F.pmod(F.xxhash64("bin"), F.lit(groups)))
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    return every.mapInArrow(
        _placed, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    )


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of each bin with their places in it."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 1024):
            part = batch.slice(lo, 1024)
            sizes = part.column("lengths").value_lengths().to_numpy()
            lengths = part.column("lengths").flatten().to_numpy().astype(np.int64)
            before = np.cumsum(lengths) - lengths
            first = np.cumsum(sizes) - sizes
            flat = {n: part.column(n).flatten() for n in LISTS}
            yield pa.RecordBatch.from_arrays(
                [
                    flat["doc_ids"],
                    flat["pieces"],
                    flat["starts"],
                    pa.array(lengths),
                    flat["crcs"],
                    pa.array(np.repeat(part.column("bin").to_numpy(), sizes)),
                    pa.array(before - np.repeat(before[first], sizes)),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, **options) -> DataFrame:
    return pack(token_pieces(docs, capacity=capacity, **options), capacity)
