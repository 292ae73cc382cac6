"""Alignment of two tokenizers' tokens over the same bytes, and how often their ids meet in the corpus.

Both tokenizers read a space and the text.  Tokens of one and the other that share bytes belong together; the least
groups that both cut alike are the components of this relation.  They are found by pointer jumping over all tokens of a
block of texts: every token points to its farthest-right overlapping token (a token that ends where one of the other
tokenizer ends is the last of its component: the first tokenizer's points to itself, the other's to that one), and all
pointers are doubled at once until they rest, which labels each token with the last token of its component after a
logarithm of the longest chain.

Counts of linked id pairs are numbers of documents.  A table of pairs is too large to send out as a whole, so only its
most frequent part, at most ``SENT_PAIRS`` rows, is broadcast; links of other pairs, none of them hot, meet their counts
in a shuffle.  Per id of the first tokenizer only the highest count is sent, a row per vocabulary entry at most.

Defined results: texts that are null, empty, or whose tokens' bytes differ from the space and the text (as where a text
holds U+2581) have no tokens, zero counts and no groups; they count for no pair.  Repeated rows and equal or null ids are
documents each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm import bytesops
from riskloom.llm.exprs import quoted
from riskloom.session import stage

FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
SENT_PAIRS = 1 << 18  # rows of id pair and count that are broadcast, about 30 bytes each
BINS = 16  # classes of counts per doubling, to find what may be sent

ALIGNED = (
    "row_id bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
    "pairs array<bigint>, times array<int>"
)


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(last token of each A token's component, of each B token's, B token at each A end, A token at each B end).

    Components are named by their last A token.  Both arrays ascend and have the same last value.
    """
    b_at = np.searchsorted(ends_b, ends_a)
    a_at = np.searchsorted(ends_a, ends_b)
    n = len(ends_a)
    to = np.empty(n + len(ends_b), np.int64)
    to[:n] = np.where(ends_b[b_at] == ends_a, np.arange(n), n + b_at)
    to[n:] = a_at
    while True:
        further = to[to]
        if np.array_equal(further, to):
            return to[:n], to[n:], b_at, a_at
        to = further


class _Bytes:
    """The bytes of a vocabulary, to be laid out for many tokens at once."""

    def __init__(self, entries: list[bytes]):
        self.size = np.fromiter(map(len, entries), np.int64, len(entries))
        self.at = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(entries), np.uint8)

    def of(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        ends = np.cumsum(size)
        return self.flat[np.repeat(self.at[ids] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]


class Aligner:
    def __init__(self, first: str, second: str):
        from riskloom.llm.chunk_tokens import ByteTokenizer, PieceTokenizer, shared

        self.models = [shared(ByteTokenizer, first, plain=True), shared(PieceTokenizer, second)]
        self.bytes = [_Bytes(m.token_bytes()) for m in self.models]
        most = max(m.size for m in self.models)
        self.told = [f"{i}{mark}" for i in range(most) for mark in ",|;"]

    def _tokens(self, texts: list[bytes | None]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """(which texts have tokens, ids of these texts by each tokenizer, tokens of each of these texts)."""
        from riskloom.llm.chunk_tokens import chunk_starts, flat_texts

        data, bounds = flat_texts([b" " + t if t else b"" for t in texts])
        starts = chunk_starts(data, bounds)
        hashes = bytesops.segment_hashes(data, starts, np.append(starts[1:], len(data)))
        sizes = np.diff(bounds)
        good, ids, counts = sizes > 0, [], []
        for model, entries in zip(self.models, self.bytes):
            own, at = model.encode_flat(data, bounds, starts, hashes)
            length = np.concatenate([[0], np.cumsum(entries.size[own])])
            good &= np.diff(length[at]) == sizes
            ids.append(own)
            counts.append(np.diff(at))
        wrong = np.zeros(len(texts), bool)
        mine, ends = data[np.repeat(good, sizes)], np.cumsum(np.where(good, sizes, 0))
        for own, n, entries in zip(ids, counts, self.bytes):
            differ = np.concatenate([[0], np.cumsum(entries.of(own[np.repeat(good, n)]) != mine)])
            wrong |= differ[ends] != differ[ends - np.where(good, sizes, 0)]
        good &= ~wrong
        ids = [own[np.repeat(good, n)] for own, n in zip(ids, counts)]
        return good, ids, [np.where(good, n, 0) for n in counts]

    def rows(self, texts: list[bytes | None]) -> list[pa.Array]:
        """The columns of ``ALIGNED`` from n_a on."""
        good, (a, b), (n_a, n_b) = self._tokens(texts)
        if not len(a):
            nothing = pa.array(np.zeros(len(texts), np.int64))
            lists = [pa.array([[]] * len(texts), pa.list_(k)) for k in (pa.int64(), pa.int32())]
            return [*[nothing] * 4, pa.array([""] * len(texts), pa.string()), *lists]
        ends_a, ends_b = (np.cumsum(e.size[x]) for e, x in zip(self.bytes, (a, b)))
        last_a, last_b, b_at, a_at = terminals(ends_a, ends_b)
        closes_a = last_a == np.arange(len(a))
        closes_b = ends_a[a_at] == ends_b
        doc_a, doc_b = (np.repeat(np.arange(len(texts)), n) for n in (n_a, n_b))
        n_groups = np.bincount(doc_a[closes_a], minlength=len(texts))
        # a link is a run of bytes without an end inside: one closes at every end
        more = ~closes_b
        n_links = n_a + np.bincount(doc_b[more], minlength=len(texts))
        width = np.int64(self.models[1].size)
        linked = np.concatenate([a * width + b[b_at], a[a_at[more]] * width + b[more]])
        space = np.int64(self.models[0].size) * width
        keys, times = np.unique(np.concatenate([doc_a, doc_b[more]]) * space + linked, return_counts=True)
        at = np.searchsorted(keys, np.arange(len(texts) + 1) * space).astype(np.int32)
        return [
            *[pa.array(x.astype(np.int64)) for x in (n_a, n_b, n_groups, n_links)],
            pa.array(self._told(a, b, last_a, last_b, closes_a, closes_b, n_a + n_b), pa.string()),
            pa.ListArray.from_arrays(pa.array(at), pa.array(keys % space)),
            pa.ListArray.from_arrays(pa.array(at), pa.array(times.astype(np.int32))),
        ]

    def _told(self, a, b, last_a, last_b, closes_a, closes_b, tokens) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` for each text."""
        number = np.cumsum(closes_a) - 1  # of the group a last token closes
        group_a, group_b = number[last_a], number[last_b]
        upto_a, upto_b = (np.concatenate([[0], np.cumsum(np.bincount(g, minlength=number[-1] + 1))]) for g in (group_a, group_b))
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + upto_b[group_a]] = a.astype(np.int64) * 3 + closes_a
        codes[np.arange(len(b)) + upto_a[group_b + 1]] = b.astype(np.int64) * 3 + 2 * closes_b
        out, told, lo = [], self.told, 0
        for n in tokens.tolist():
            out.append("".join([told[c] for c in codes[lo : lo + n].tolist()])[:-1])
            lo += n
        return out


_made: dict[tuple[str, str], Aligner] = {}


def aligned(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", first: str = FIRST, second: str = SECOND
) -> DataFrame:
    """One row per document: its numbers of tokens, groups and links, the groups written out (``a1,a2|b1;a3|b2,b3``, ids
    in order), and its distinct linked id pairs (first id times the second vocabulary's size plus second id) with how
    often each is linked.  ``row_id`` tells rows apart."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made = TaskContext.get().partitionId() << 33
        for batch in batches:
            if (first, second) not in _made:
                _made[first, second] = Aligner(first, second)
            for at, texts in bytesops.blocks(batch, "text"):
                columns = _made[first, second].rows(texts)
                rows = pa.array(range(made, made + len(texts)), pa.int64())
                made += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [rows, batch.column("doc_id").slice(at, len(texts)), *columns],
                    names=[f.split()[0] for f in ALIGNED.split(", ")],
                )

    return docs.select(
        quoted(id_col).cast("bigint").alias("doc_id"), quoted(text_col).cast("string").alias("text")
    ).mapInArrow(work, ALIGNED)


def pair_counts(found: DataFrame, width: int) -> DataFrame:
    """(pair, n, best): documents that hold each pair linked, and whether no pair of its first id has a higher count."""
    counts = stage(
        found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "pairs"
    )
    counts = counts.withColumn("first", F.expr(f"pair div {width}"))
    highest = counts.groupBy("first").agg(F.max("n").alias("highest"))  # a row per entry of the first vocabulary
    return counts.join(F.broadcast(highest), "first").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def vocabulary_size(name: str) -> int:
    from riskloom.llm.chunk_tokens import PieceTokenizer, shared

    return shared(PieceTokenizer, name).size


def with_counts(found: DataFrame, second: str = SECOND, sent_pairs: int = SENT_PAIRS) -> DataFrame:
    """``aligned`` rows with ``n_best`` (links whose pair has the highest count of its first id) and ``count_sum`` (the
    counts of all links added up) in place of the pairs.  Other columns of ``found`` stay."""
    found = stage(found, "aligned")
    size_class = F.floor(F.log2("n") * BINS).cast("int")
    counts = stage(pair_counts(found, vocabulary_size(second)).withColumn("class", size_class), "counts")
    room, least = sent_pairs, None
    for row in counts.groupBy("class").count().orderBy(F.desc("class")).collect():  # some hundred classes at most
        room -= row["count"]
        if room < 0:
            break
        least = row["class"]
    often = F.lit(False) if least is None else F.col("class") >= least
    links = found.select("row_id", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select(
        "row_id", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times")
    )
    near = links.join(F.broadcast(counts.where(often).select("pair", "n", "best")), "pair", "left")
    rare = near.where("n is null").select("row_id", "pair", "times").join(counts.where(~often), "pair")

    def sums(rows: DataFrame) -> DataFrame:
        return rows.groupBy("row_id").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("n") * F.col("times")).alias("count_sum"),
        )

    every = sums(near.where("n is not null")).unionByName(sums(rare)).groupBy("row_id")
    every = every.agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("bigint")
    return (
        found.drop("pairs", "times")
        .join(every, "row_id", "left")
        .withColumns({c: F.coalesce(c, zero) for c in ("n_best", "count_sum")})
    )
