"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text; a chunk ends where ``MASK_BITS`` of its bits are zero.  These bits depend
on the last ``LOOK_BACK`` bytes only, so an insertion moves no cut but those next to it, and equal passages are cut
alike wherever they stand.  Of any ``FAR`` words in a row without such a cut, those of least hash are cut at their
least, so no passage of 50 words lacks cuts, however short its words or its period.  These cuts depend on the words of
the window and the ``LOOK_BACK`` bytes before them only.  Chunks are counted by digest over all documents;
those of two documents or more are repeats, and all but the ones of the document of least id are copies.  White space
of any kind is a blank.

Consecutive repeats of a document make a run.  A shared passage begins and ends beside the run, as cuts near its ends
differ: at most as far as the next cut by the mask (before the run ``LOOK_BACK`` bytes more) and ``FAR`` words off.  A
run counts if it and these words hold at least ``words`` words and the run itself ``OWN_WORDS``.  Its spans are the
parts that are copies and those that are not.

Equal digests (64 bits) are taken for equal chunks.  Defined results: null and empty texts have no chunk; rows of one
id are one document, null ids too; within a document a chunk that comes again is no repeat; an empty table gives an
empty result; columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from riskloom.llm import bytesops
from riskloom.llm.exprs import fresh, quoted

MASK_BITS = 5  # chunks of 32 bytes on average
LOOK_BACK = 20
MASK = np.uint32(((1 << MASK_BITS) - 1) << (LOOK_BACK - MASK_BITS))
WORDS = 50
OWN_WORDS = 6
FAR = 16  # with 10 words for LOOK_BACK, a cut in the first 27 of 50 words, one in the last 17, more than 6 between
BLANKS = bytes(32 if 9 <= c <= 13 else c for c in range(256))

CHUNKS = "doc_id bigint, row bigint, at int, start int, length int, words int, beside int, digest bigint"


def gear_hash(data: np.ndarray) -> np.ndarray:
    """h[i] = (h[i - 1] << 1) + GEAR[data[i]] modulo 2 ** 32, all places at once by doubling the window."""
    h = bytesops.GEAR[data]
    step = 1
    while step < 32:
        more = h.copy()
        more[step:] += h[:-step] << np.uint32(step)
        h = more
        step *= 2
    return h


def _over(values: np.ndarray, n: int, best: np.ufunc) -> np.ndarray:
    """``best`` over each n values in a row, n a power of two."""
    step = 1
    while step < n:
        values = best(values[:-step], values[step:])
        step *= 2
    return values


def cuts(data: np.ndarray, offsets: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a chunk ends after each byte of a run of texts, their ends not counted, and whether by the mask.

    Each text is cut only where it has had ``LOOK_BACK`` bytes of its own.  The mask asks for the upper bits of the last
    ``LOOK_BACK`` to be zero, so a cut by it is a hash below ``1 << (LOOK_BACK - MASK_BITS)``.
    """
    none = np.uint32(1 << LOOK_BACK)
    low = gear_hash(data) & (none - np.uint32(1))
    size = np.diff(offsets)
    early = np.arange(len(data)) - np.repeat(offsets[:-1], size) < LOOK_BACK
    low[early] = none
    low[np.concatenate([offsets[1:] - 1, offsets[1:][size > 1] - 2])] = none
    masked = (low & MASK == 0) & (low < none)
    found = masked.copy()
    # words with the white space after them; what comes before the first one of a text goes as a word
    opens = begins.copy()
    opens[offsets[:-1]] = True
    at = np.flatnonzero(opens)
    if len(at) < FAR:
        return found, masked
    least = np.minimum.reduceat(low, at)
    text = np.searchsorted(offsets, at, "right")
    window = _over(least, FAR, np.minimum)
    bare = (text[: len(window)] == text[FAR - 1 :]) & (window >= 1 << (LOOK_BACK - MASK_BITS)) & (window < none)
    zeros = np.zeros(FAR - 1, np.uint32)
    wanted = _over(np.concatenate([zeros, np.where(bare, window, 0), zeros]).astype(np.uint32), FAR, np.maximum)
    word = np.cumsum(opens) - 1
    hit = np.flatnonzero((low == np.where(wanted == least, least, none + 1)[word]))
    _, first = np.unique(word[hit], return_index=True)
    found[hit[first]] = True
    return found, masked


def chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per chunk: its place, its code points and words, how many words a passage may go on beside, its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at, texts in bytesops.blocks(batch, "text"):
                yield _chunk_rows(texts, batch.column("doc_id").slice(at, len(texts)), row)
                row += len(texts)

    return docs.select(
        quoted(id_col).cast("bigint").alias("doc_id"), quoted(text_col).cast("string").alias("text")
    ).mapInArrow(run, CHUNKS)


def _chunk_rows(texts: list[bytes | None], ids: pa.Array, row: int) -> pa.RecordBatch:
    data, offsets = bytesops.joined(texts, BLANKS)
    space = bytesops.SPACE[data]
    begins = ~space
    begins[1:] &= space[:-1]
    found, masked = cuts(data, offsets, begins)
    edges = [
        np.concatenate([[lo], np.flatnonzero(found[lo:hi]) + lo + 1, [hi]]) if hi > lo else np.zeros(0, np.int64)
        for lo, hi in zip(offsets[:-1].tolist(), (offsets[1:] - 1).tolist())
    ]
    count = np.array([max(len(e) - 1, 0) for e in edges], np.int64)
    starts = np.concatenate([e[:-1] for e in edges]).astype(np.int64)
    ends = np.concatenate([e[1:] for e in edges]).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), count)
    first = np.repeat(np.cumsum(count) - count, count)
    place = np.arange(len(starts)) - first
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
    word = np.concatenate([[0], np.cumsum(begins)])
    words = word[ends] - word[starts]
    # how far a passage may go on before and after: no cut by the mask, save one that looks back over its beginning
    marks = np.unique(np.concatenate([np.flatnonzero(masked) + 1, offsets[:-1], offsets[1:] - 1]))
    last = marks[np.maximum(np.searchsorted(marks, starts, "left") - 1, 0)] - LOOK_BACK
    before = np.minimum(word[starts] - word[np.maximum(last, offsets[owner])], FAR + LOOK_BACK // 2 + 1)
    then = marks[np.minimum(np.searchsorted(marks, ends, "right"), len(marks) - 1)]
    after = np.minimum(word[np.minimum(then, offsets[owner + 1] - 1)] - word[ends], FAR + 1)
    packed = before << 16 | after
    return pa.RecordBatch.from_arrays(
        [
            ids.take(pa.array(owner)),
            pa.array(owner + row),
            pa.array(place, pa.int32()),
            pa.array(points[starts] - points[offsets[owner]], pa.int32()),
            pa.array(points[ends] - points[starts], pa.int32()),
            pa.array(words, pa.int32()),
            pa.array(packed, pa.int32()),
            pa.array(bytesops.segment_hashes(data, starts, ends).view(np.int64)),
        ],
        names=["doc_id", "row", "at", "start", "length", "words", "beside", "digest"],
    )


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(doc_id, row, start, end, words, first_doc_id, is_copy): the passages that other documents hold, too.

    Places are code points, the end exclusive.  ``first_doc_id`` is the least id of a document with one of the span's
    chunks; ``is_copy`` marks spans of later documents.
    """
    all_chunks = chunks(docs, id_col, text_col)
    last = F.lit(2**63 - 1)  # rows without an id are one document, after all others
    key = F.coalesce("doc_id", last)
    shared = (
        all_chunks.groupBy("digest")
        .agg(F.min(key).alias("least"), F.max(key).alias("most"))
        .filter(F.col("least") != F.col("most"))
        .select("digest", "least")
    )
    found = all_chunks.join(shared, "digest").withColumn("is_copy", key != F.col("least"))
    line = Window.partitionBy("row").orderBy("at")
    runs = found.withColumn(
        "run", F.sum(F.when(F.col("at") - F.lag("at", 1, -2).over(line) != 1, 1).otherwise(0)).over(line)
    )
    # what a run holds in all decides whether it counts
    inside = Window.partitionBy("row", "run").orderBy("at")
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own = F.sum("words").over(whole)
    reach = (
        own
        + F.shiftright(F.first("beside").over(whole), 16)
        + F.last("beside").over(whole).bitwiseAND(F.lit(0xFFFF))
    )
    long = runs.withColumn("own", own).withColumn("reach", reach).filter(
        (F.col("own") >= min(OWN_WORDS, words)) & (F.col("reach") >= words)
    )
    # a chunk of hardly a word, which any text may hold, goes along with its neighbours
    sure = F.when(F.col("words") >= 3, F.col("is_copy"))
    flag = F.coalesce(
        F.last(sure, True).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        F.first(sure, True).over(inside.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
        F.col("is_copy"),
    )
    parted = long.withColumn("is_copy", flag).withColumn(
        "part",
        F.sum(F.when(F.col("is_copy") != F.lag("is_copy", 1).over(inside), 1).otherwise(0)).over(inside),
    )
    return (
        parted.groupBy("row", "run", "part", "is_copy")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.min("start").alias("start"),
            F.max(F.col("start") + F.col("length")).alias("end"),
            F.sum("words").alias("words"),
            F.min("least").alias("first_doc_id"),
        )
        .select("doc_id", "row", "start", "end", "words", "first_doc_id", "is_copy")
    )


def without_copies(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the copied spans cut out of the texts; a row per row, all other columns as they were."""
    of, found = fresh(docs, "__of", "__cuts")
    cuts = (
        spans.filter("is_copy")
        .groupBy(F.col("doc_id").alias(of))
        .agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias(found))
    )
    text = quoted(text_col).cast("string")
    none = F.array().cast("array<struct<start:int,end:int>>")
    edges = F.concat(F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"))), F.coalesce(F.col(found), none))
    kept = F.array_join(
        F.zip_with(
            edges,
            F.slice(edges, F.lit(2), F.size(edges)),
            lambda a, b: F.substring(
                text, a["end"] + 1, F.greatest(F.coalesce(b["start"], F.length(text)) - a["end"], F.lit(0))
            ),
        ),
        "",
    )
    joined = docs.join(cuts, quoted(id_col).cast("bigint").eqNullSafe(F.col(of)), "left")
    clean = F.when(F.col(found).isNull() | text.isNull(), text).otherwise(kept)
    return joined.select(*[clean.alias(c) if c == text_col else quoted(c) for c in docs.columns])
