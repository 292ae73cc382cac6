"""Near duplicates by improved consistent weighted sampling over TF-IDF word shingles.

A text is its set of five-word shingles, each with the weight (1 + ln tf) * (1 + relative idf) ** DAMPING.  The relative idf
runs from 0 (in every document) to 1 (rare); document frequencies come from all documents, counted in a sketch of
``2 ** SKETCH_BITS`` buckets.  They are smoothed by a thousandth of the documents, or by the mean load of a bucket if
that is more, so what is rare or what the sketch can't tell apart weighs the same.  The damping keeps the copies of a
large group, whose shingles are frequent just because of the group, about as close to each other as without weights.

``SAMPLES`` consistent samples per text (the same shingle is drawn by two texts with a probability equal to their
weighted Jaccard similarity) are banded; texts that share a band are candidates, and a pair is a link if its weighted
Jaccard similarity, computed on all shingles, is ``THRESHOLD`` or more.  Classes are the connected components.

Equal texts are one node from the start.  Within a bucket of texts that share a band, all are first compared with one
of them; then only pairs of different classes so far are compared: all of them in small buckets, in large ones those
with changing hubs and at last the others, block against block.  In large buckets, shingles that no other text there has are counted first;
two texts share at most the rest, which rules out most pairs of a group of copies with several changes each, and a
text with little of its own makes a good hub.  So a group of copies costs about one comparison per text.  Hubs of many
pairs are split, no bucket or group is gathered, and no possible link is left out.  A pair of similarity 0.8 shares a band with
a probability above 0.999; pairs with fewer than ``AGREE`` equal samples (4.4 standard deviations below the mean at
0.8) are not looked at further.

Defined results: a null text is a class of its own per row; an empty text is a copy of other empty texts and has no
shingles; a text of one to four words has one shingle, all its words; ASCII case does not matter for shingles; repeated
rows belong to one class; ``class_id`` is the least document id of the class (null if all are null); an empty table
gives an empty result; columns other than the id and the text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm import bytesops
from riskloom.llm.exprs import fresh, parts_for, quoted
from riskloom.llm.graphs import components
from riskloom.session import stage

WORDS = 5
THRESHOLD = 0.8
SAMPLES = 64
BAND = 4  # samples per band
AGREE = 37
SKETCH_BITS = 20
SKETCH_PARTS = 64
DAMPING = 0.25
SMOOTH, SMOOTH_SHARE = 8.0, 0.001  # document frequencies far below this number or share are all alike
SMALL = 16  # buckets of so many texts or fewer are compared in full in the second round
HUBS = 2  # rounds of changing hubs in larger ones, before what is left is compared in blocks
BLOCK = 256  # texts
HUB_PAIRS = 256  # pairs per copy of a hub
ROWS_PER_PART, TEXTS_PER_PART = 400_000, 4_000  # of short rows, and of rows with all shingles of a text

_rng = np.random.default_rng(2010)
_TABLE = 1 << 16
_R = _rng.gamma(2.0, 1.0, _TABLE).astype(np.float32)
_LNC = np.log(_rng.gamma(2.0, 1.0, _TABLE)).astype(np.float32)
_BETA = _rng.random(_TABLE, dtype=np.float32)
_OVER_R = 1 / _R
_TAKE = _rng.integers(0, 2**32, SAMPLES, dtype=np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 2**32, SAMPLES, dtype=np.uint32)


# ---------------------------------------------------------------- shingles and weights


def distinct_shingles(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, tf, bounds): each text's distinct shingles in order, and how often it has them."""
    hashes, bounds = bytesops.word_shingles(texts, WORDS)
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        hashes[lo:hi].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    new[bounds[:-1][np.diff(bounds) > 0]] = True
    at = np.flatnonzero(new)
    return hashes[at], np.diff(np.append(at, len(hashes))), np.searchsorted(at, bounds)


def _places(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(quoted(id_col).cast("bigint").alias("doc_id"), quoted(text_col).cast("string").alias("text"))


def digest(text: Column) -> Column:
    """128 bits that stand for a text."""
    return F.unhex(F.md5(text))


def shingle_weights(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """The idf part of a shingle's weight by sketch bucket, from the document frequencies of all documents."""
    size = 1 << (SKETCH_BITS - SKETCH_PARTS.bit_length() + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros(1 << SKETCH_BITS, np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for _, texts in bytesops.blocks(batch, "text"):
                hashes, _, bounds = distinct_shingles(texts)
                counts += np.bincount(_places(hashes), minlength=len(counts))
                totals += len(texts), len(hashes)
        parts = [*counts.reshape(SKETCH_PARTS, size), totals]
        yield _sketch_rows(range(SKETCH_PARTS + 1), parts)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
                counts = np.frombuffer(zlib.decompress(data), np.int64)
                sums[part] = sums[part] + counts if part in sums else counts
        yield _sketch_rows(list(sums), list(sums.values()))

    parts = (
        _source(docs, id_col, text_col)
        .mapInArrow(count, "part int, counts binary")
        .repartition(SKETCH_PARTS + 1, "part")
        .mapInArrow(add, "part int, counts binary")
    )
    counts, totals = np.zeros((SKETCH_PARTS, size), np.int64), np.zeros(2, np.int64)
    for part, data in parts.collect():  # a fixed number of rows of fixed size
        found = np.frombuffer(zlib.decompress(data), np.int64)
        if part == SKETCH_PARTS:
            totals += found
        else:
            counts[part] += found
    n = max(int(totals[0]), 1)
    smooth = max(SMOOTH, SMOOTH_SHARE * n, totals[1] / counts.size)
    df = np.minimum(counts.reshape(-1), n)
    relative = np.log((n + smooth) / (df + smooth)) / np.log((n + smooth) / smooth)
    return ((1 + relative) ** DAMPING).astype(np.float32)


def _sketch_rows(parts, counts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(list(parts), pa.int32()),
            pa.array([zlib.compress(c.astype(np.int64).tobytes(), 1) for c in counts], pa.binary()),
        ],
        names=["part", "counts"],
    )


def weights_of(hashes: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    w = idf[_places(hashes)]
    many = tf > 1
    if many.any():
        w[many] *= 1 + np.log(tf[many].astype(np.float32))
    return w


# ---------------------------------------------------------------- consistent weighted samples


def samples(hashes: np.ndarray, weights: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 16-bit print of each consistent sample: one row per text, one column per sample.

    Sample i of a text is the pair (shingle, t) of least a, where t = floor(ln w / r + beta) and
    ln a = ln c - r (t - beta + 1), with r, c ~ Gamma(2, 1) and beta ~ U(0, 1) drawn by the hash of shingle and i.
    """
    out = np.zeros((len(bounds) - 1, SAMPLES), np.uint16)
    low = (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    high = (hashes >> np.uint64(32)).astype(np.uint32)
    log_w = np.log(weights)
    filled = np.flatnonzero(np.diff(bounds) > 0)
    at = 0
    while at < len(filled):  # some texts at a time, so that the arrays stay in cache
        to = max(at + 1, int(np.searchsorted(bounds[filled + 1], bounds[filled[at]] + 16_384, "right")))
        rows = filled[at:to]
        lo, hi = bounds[rows[0]], bounds[rows[-1] + 1]
        x, y, s = low[lo:hi], high[lo:hi], log_w[lo:hi]
        starts = bounds[rows] - lo
        for i in range(SAMPLES):
            draw = (x * _TAKE[i] + _ADD[i]) >> np.uint32(16)
            beta, r = _BETA[draw], _R[draw]
            t = np.floor(s * _OVER_R[draw] + beta)
            log_a = _LNC[draw] - r * (t - beta + 1)
            print_ = (y * _TAKE[i]) ^ (t.astype(np.int32).view(np.uint32) * np.uint32(0x9E3779B1))
            key = ((log_a + np.float32(256)).view(np.uint32).astype(np.uint64) << np.uint64(32)) | print_
            least = np.minimum.reduceat(key, starts) & np.uint64(0xFFFFFFFF)
            out[rows, i] = ((least * np.uint64(0x9E3779B1)) >> np.uint64(13)).astype(np.uint16)
        at = to
    return out


def signatures(docs: DataFrame, idf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, weight, prints, bands) of every row; the last two are null without shingles."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in bytesops.blocks(batch, "text"):
                hashes, tf, bounds = distinct_shingles(texts)
                w = weights_of(hashes, tf, idf.value)
                prints = samples(hashes, w, bounds)
                total = np.concatenate([[0], np.cumsum(w, dtype=np.float64)])
                some = np.diff(bounds) > 0
                bands = np.ascontiguousarray(prints).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(at, len(texts)),
                        batch.column("digest").slice(at, len(texts)),
                        pa.array(total[bounds[1:]] - total[bounds[:-1]]),
                        pa.array([p.tobytes() if s else None for p, s in zip(prints, some)], pa.binary()),
                        pa.array([b.tolist() if s else None for b, s in zip(bands, some)], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "digest", "weight", "prints", "bands"],
                )

    return _source(docs, id_col, text_col).withColumn("digest", digest(F.col("text"))).mapInArrow(
        sign, "doc_id bigint, digest binary, weight double, prints binary, bands array<bigint>"
    )


# ---------------------------------------------------------------- links


def _agreeing(pairs: DataFrame, nodes: DataFrame, parts: int) -> DataFrame:
    """The pairs that weight and samples allow to be links."""
    sides = nodes.select("node", "weight", "prints")
    a, b = (sides.select([F.col(c).alias(f"{c}_{s}") for c in sides.columns]) for s in "ab")
    near = (
        pairs.coalesce(parts)
        .join(a, F.col("a") == F.col("node_a"))
        .coalesce(parts)
        .join(b, F.col("b") == F.col("node_b"))
        .coalesce(parts)
        .filter(F.least("weight_a", "weight_b") >= F.lit(THRESHOLD * 0.9999) * F.greatest("weight_a", "weight_b"))
        .select("a", "b", "prints_a", "prints_b")
    )

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, SAMPLES)
                for c in ("prints_a", "prints_b")
            )
            yield batch.filter(pa.array((x == y).sum(1) >= AGREE)).select(["a", "b"])

    return near.mapInArrow(agree, "a bigint, b bigint")


def _shingles_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, hashes, tf) of the given nodes (node, doc_id, digest), read from their texts."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    wanted = nodes.select(key.alias("key"), "digest", "node")
    named = docs.filter(F.col("text").isNotNull()).select(key.alias("key"), digest(F.col("text")).alias("digest"), "text")
    # of equal rows one is read; the join has brought them together
    # by a shuffle of both sides: what is wanted grows with the documents
    rows = named.join(wanted.hint("merge"), ["key", "digest"]).dropDuplicates(["key", "digest"]).select("node", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in bytesops.blocks(batch, "text"):
                hashes, tf, bounds = distinct_shingles(texts)
                cuts = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("node").slice(at, len(texts)),
                        pa.array([hashes[lo:hi].tobytes() for lo, hi in cuts], pa.binary()),
                        pa.array(
                            [tf[lo:hi].astype("<u4").tobytes() if (tf[lo:hi] > 1).any() else b"" for lo, hi in cuts],
                            pa.binary(),
                        ),
                    ],
                    names=["node", "hashes", "tf"],
                )

    return rows.mapInArrow(cut, "node bigint, hashes binary, tf binary")


def _verified(pairs: DataFrame, shingles: DataFrame, idf) -> DataFrame:
    n = pairs.count()
    few, parts = parts_for(n, ROWS_PER_PART), parts_for(n, TEXTS_PER_PART)
    return _compared(pairs, shingles, idf, few, parts)


def _compared(pairs: DataFrame, shingles: DataFrame, idf, few: int, parts: int) -> DataFrame:
    """The pairs whose weighted Jaccard similarity is high enough, with it.

    All partners of a hub ``a`` are dealt to copies of it, ``HUB_PAIRS`` or so for each, and stream past it.
    """
    copies = pairs.groupBy("a").agg(F.ceil(F.count("*") / HUB_PAIRS).cast("int").alias("copies"))
    partners = (
        pairs.join(copies, "a")
        .coalesce(few)
        .select("a", F.pmod(F.xxhash64("b"), F.col("copies")).cast("int").alias("copy"), F.col("b").alias("node"))
        .join(shingles, "node")
        .coalesce(parts)
        .select("a", "copy", F.lit(1).alias("role"), "node", "hashes", "tf")
    )
    hubs = (
        copies.select("a", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
        .join(shingles.withColumnRenamed("node", "a"), "a")
        .coalesce(parts)
        .select("a", "copy", F.lit(0).alias("role"), F.col("a").alias("node"), "hashes", "tf")
    )
    dealt = partners.unionByName(hubs).repartition(parts, "a", "copy").sortWithinPartitions("a", "copy", "role")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, key = None, None
        for batch in batches:
            found = []
            columns = [batch.column(c) for c in ("a", "copy", "role", "node", "hashes", "tf")]
            for i in range(batch.num_rows):  # row by row, so that one batch is not held twice
                a, copy, role, node, h, t = (c[i].as_py() for c in columns)
                own = read_shingles(h, t, idf.value)
                if role == 0:
                    if key != (a, copy):
                        hub, key = own, (a, copy)
                elif key == (a, copy):
                    s = similarity(hub, own)
                    if s >= THRESHOLD:
                        found.append((a, node, s))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in zip(*found)], names=["a", "b", "similarity"]
                )

    return dealt.mapInArrow(compare, "a bigint, b bigint, similarity double")


def read_shingles(hashes: bytes, tf: bytes, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(sorted hashes, weights, sum of weights) of a staged text."""
    found = np.frombuffer(hashes, np.uint64)
    w = weights_of(found, np.frombuffer(tf, "<u4") if tf else np.ones(len(found), np.uint32), idf)
    return found, w, float(w.sum(dtype=np.float64))


def similarity(x: tuple, y: tuple) -> float:
    """Weighted Jaccard similarity of two texts: (sorted hashes, weights, sum of weights)."""
    if len(x[0]) < len(y[0]):
        x, y = y, x
    at = np.searchsorted(x[0], y[0])
    at[at == len(x[0])] = 0
    same = x[0][at] == y[0] if len(x[0]) else np.zeros(len(y[0]), bool)
    shared = float(np.minimum(x[1][at[same]], y[1][same]).sum(dtype=np.float64))
    union = x[2] + y[2] - shared
    return shared / union if union else 1.0


def _ordered_pairs(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _links(docs: DataFrame, nodes: DataFrame, idf) -> DataFrame | None:
    """(node, root) of the texts linked to one of a lesser number; None if there are none."""
    banded = nodes.filter(F.col("bands").isNotNull()).select("node", F.posexplode("bands").alias("band", "prints"))
    keyed = banded.select(F.xxhash64("band", "prints").alias("bucket"), "node")
    few = parts_for(nodes.count() * (SAMPLES // BAND), ROWS_PER_PART)
    shared = (
        keyed.groupBy("bucket")
        .agg(F.count("*").alias("n"), F.min("node").alias("hub"))
        .filter(F.col("n") > 1)
    )
    members = stage(keyed.join(shared, "bucket").coalesce(few), "members")
    counted = members.agg(F.count("*").alias("rows"), F.max("n").alias("most")).first()
    few, big = parts_for(counted["rows"], ROWS_PER_PART), counted["most"]
    if big is None:
        return None
    stars = members.filter(F.col("node") != F.col("hub")).select(*_ordered_pairs(F.col("hub"), F.col("node")))
    tested = stage(_agreeing(stars.distinct(), nodes, few), "pairs")
    in_buckets = stage(nodes.join(members.select("node"), "node", "left_semi").select("node", "doc_id", "digest").coalesce(few), "wanted")
    shingles = stage(_shingles_of(docs, in_buckets), "shingles")
    links = stage(_verified(tested, shingles, idf), "links")
    roots, turn, mass = components(links), 0, None
    while big > 2:  # in buckets of two, every pair has been looked at
        turn += 1
        # members of buckets that still hold more than one class
        now = members.filter("n > 2").join(roots, "node", "left").select(
            "bucket", "n", "node", F.coalesce("root", "node").alias("root")
        )
        mixed = now.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
        now = stage(now.coalesce(few).join(mixed.coalesce(few).select("bucket"), "bucket").coalesce(few), "mixed")
        left = now.agg(F.count("*").alias("rows"), F.max("n").alias("most")).first()
        if not left["rows"]:
            break
        last = turn > HUBS or left["most"] <= SMALL
        pairs = _cross_pairs(now.filter(F.col("n") <= SMALL))
        if left["most"] > SMALL:
            large = now.filter(F.col("n") > SMALL)
            if mass is None:
                mass = stage(_shared_mass(large.select("node").distinct().coalesce(few), nodes, shingles, idf, few), "mass")
            able = stage(large.join(mass, "node").coalesce(few), "able")
            if not last:
                pairs = pairs.unionByName(_hub_pairs(able, turn))
        untested = pairs.distinct().coalesce(few).join(tested, ["a", "b"], "left_anti")
        more = stage(_agreeing(untested, nodes, few), "pairs")
        found = _verified(more, shingles, idf).select("a", "b")
        if last and left["most"] > SMALL:
            found = found.unionByName(_family_links(able, shingles, idf, few))
        found = stage(found, "links")
        if found.limit(1).count():
            # the classes so far stand for the links that made them
            so_far = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
            roots = components(so_far.unionByName(found.select("a", "b")))
        if last:
            break
        tested = tested.unionByName(more)
    return roots


def _shared_mass(wanted: DataFrame, nodes: DataFrame, shingles: DataFrame, idf, parts: int) -> DataFrame:
    """(node, weight, mass): the weight of each text, and that of its shingles which another wanted text has, too.

    Texts whose own shingles alone weigh too much for any link are left out.
    """

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                hashes = [np.frombuffer(h, np.uint64) for h in part.column("hashes").to_pylist()]
                tf = [
                    np.frombuffer(t, "<u4") if t else np.ones(len(h), np.uint32)
                    for t, h in zip(part.column("tf").to_pylist(), hashes)
                ]
                flat = np.concatenate(hashes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(flat.view(np.int64)),
                        pa.array(np.repeat(part.column("node").to_numpy(), [len(h) for h in hashes])),
                        pa.array(weights_of(flat, np.concatenate(tf), idf.value).astype(np.float64)),
                    ],
                    names=["hash", "node", "w"],
                )

    cells = shingles.join(wanted, "node", "left_semi").mapInArrow(unfold, "hash bigint, node bigint, w double")
    alone = (
        cells.groupBy("hash")
        .agg(F.count("*").alias("n"), F.min("node").alias("node"), F.min("w").alias("w"))
        .filter("n = 1")
        .groupBy("node")
        .agg(F.sum("w").alias("alone"))
    )
    return (
        wanted.join(nodes.select("node", "weight"), "node")
        .join(alone, "node", "left")
        .select("node", "weight", (F.col("weight") - F.coalesce("alone", F.lit(0.0))).alias("mass"))
        .filter(F.col("mass") >= F.lit(THRESHOLD * 0.9999) * F.col("weight"))
        .coalesce(parts)
    )


def _possible(one: str, two: str) -> Column:
    """Whether two texts can be a link: what they share is at most the lesser mass."""
    shared = F.least(f"{one}mass", f"{two}mass")
    union = F.col(f"{one}weight") + F.col(f"{two}weight") - shared
    return shared >= F.lit(THRESHOLD * 0.9999) * union


def _cross_pairs(rows: DataFrame) -> DataFrame:
    """The pairs of a small bucket whose members are of different classes."""
    other = rows.select("bucket", *[F.col(c).alias(f"other_{c}") for c in rows.columns if c not in ("bucket", "n")])
    on = (F.col("node") < F.col("other_node")) & (F.col("root") != F.col("other_root"))
    return rows.join(other, "bucket").filter(on).select(F.col("node").alias("a"), F.col("other_node").alias("b"))


def _family_links(able: DataFrame, shingles: DataFrame, idf, few: int) -> DataFrame:
    """(a, b): links between classes among the members of large buckets, all looked at, block against block.

    Buckets with common members are one family.  A family is dealt to blocks of about ``BLOCK`` texts, and each pair
    of blocks is one small matrix product in a task, which gives back links only.
    """
    hub = able.groupBy("bucket").agg(F.min("node").alias("hub"))
    kin = components(able.join(hub, "bucket").select("node", "hub").distinct(), "node", "hub")
    kin = kin.select(F.col("node").alias("member"), F.col("root").alias("kin"))
    texts = able.select("node", "root").distinct().coalesce(few)
    named = texts.join(kin, F.col("node") == F.col("member"), "left").select(
        "node", "root", F.coalesce("kin", "node").alias("family")
    )
    sizes = named.groupBy("family").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).coalesce(few)
    dealt = (
        named.join(sizes, "family")
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "family",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            "own",
            "node",
            "root",
        )
        .coalesce(few)
        .join(shingles, "node")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            columns = [batch.column(c) for c in ("family", "i", "j", "own", "node", "root", "hashes", "tf")]
            for n in range(batch.num_rows):
                *now, own, node, root, h, t = (c[n].as_py() for c in columns)
                if now != key:
                    yield from _block_links(key, held, idf.value)
                    key, held = now, []
                held.append((own, node, root, h, t))
        yield from _block_links(key, held, idf.value)

    return (
        dealt.repartition("family", "i", "j")
        .sortWithinPartitions("family", "i", "j")
        .mapInArrow(compare, "a bigint, b bigint")
    )


def _block_links(key, rows: list[tuple], idf: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Links between texts of different classes, of block i with block j (or within one block)."""
    if len(rows) < 2:
        return
    _, i, j = key
    own, node, root = (np.array([r[k] for r in rows]) for k in range(3))
    texts = [read_shingles(r[3], r[4], idf) for r in rows]
    flat = np.concatenate([t[0] for t in texts])
    known, place, count = np.unique(flat, return_inverse=True, return_counts=True)
    column = np.where(count > 1, np.cumsum(count > 1) - 1, -1)[place]  # what one text alone has is no part of a link
    who = np.repeat(np.arange(len(rows)), [len(t[0]) for t in texts])
    weight = np.concatenate([t[1] for t in texts])
    shared = np.zeros((len(rows), len(rows)), np.float32)
    order = np.argsort(column, kind="stable")
    edges = np.searchsorted(column[order], np.arange(0, int((count > 1).sum()) + 1024, 1024))
    for lo, hi in zip(edges[:-1], edges[1:]):
        part = order[lo:hi]
        if len(part):
            # sqrt(x) sqrt(y) is at least min(x, y): no link is lost, and equal weights are exact
            cells = np.zeros((len(rows), 1024), np.float32)
            cells[who[part], column[part] % 1024] = np.sqrt(weight[part])
            shared += cells @ cells.T
    total = np.array([t[2] for t in texts], np.float32)
    near = shared >= THRESHOLD * 0.999 * (total[:, None] + total[None, :] - shared)
    near &= (root[:, None] != root[None, :]) & (node[:, None] < node[None, :])
    if i != j:
        near &= own[:, None] != own[None, :]
    found = [(x, y) for x, y in zip(*np.nonzero(near)) if similarity(texts[x], texts[y]) >= THRESHOLD]
    if found:
        x, y = (np.array(c) for c in zip(*found))
        yield pa.RecordBatch.from_arrays([pa.array(node[x]), pa.array(node[y])], names=["a", "b"])


def _hub_pairs(rows: DataFrame, turn: int) -> DataFrame:
    """Each bucket's members with its hub: the text with the least weight of its own, later of another class."""
    share = F.struct(F.col("mass") / F.col("weight"), F.xxhash64("node", F.lit(turn)))
    kind = F.struct("node", "root", "weight", "mass")
    hubs = rows.groupBy("bucket").agg(F.max_by(kind, share).alias("hub"))
    if turn > 1:
        rest = rows.join(hubs, "bucket").filter(F.col("root") != F.col("hub.root")).drop("hub")
        hubs = rest.groupBy("bucket").agg(F.max_by(kind, share).alias("hub"))
    hubs = hubs.select("bucket", *[F.col(f"hub.{c}").alias(f"hub_{c}") for c in ("node", "root", "weight", "mass")])
    return (
        rows.join(hubs, "bucket")
        .filter((F.col("root") != F.col("hub_root")) & _possible("", "hub_"))
        .select(*_ordered_pairs(F.col("node"), F.col("hub_node")))
    )


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, class_id, first_digest) of every row.

    The row to keep of a class is one with ``doc_id`` = ``class_id`` and ``digest`` = ``first_digest``.
    """
    idf = docs.sparkSession.sparkContext.broadcast(shingle_weights(docs, id_col, text_col))  # 4 MB, whatever the input
    signed = stage(signatures(docs, idf, id_col, text_col), "signatures")
    nodes = stage(
        signed.filter(F.col("digest").isNotNull())
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.first("weight").alias("weight"),
            F.first("prints").alias("prints"),
            F.first("bands").alias("bands"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    roots = _links(_source(docs, id_col, text_col), nodes, idf)
    known = nodes.select("node", "digest", "doc_id")
    if roots is None:
        rooted = known.withColumn("root", F.col("node"))
    else:
        rooted = known.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = rooted.groupBy("root").agg(
        F.min("doc_id").alias("class_id"),
        F.min_by("digest", F.struct(F.col("doc_id").isNull(), "doc_id", "digest")).alias("first_digest"),
    )
    named = rooted.join(first, "root").select("digest", "class_id", "first_digest")
    alone = signed.filter(F.col("digest").isNull()).select(
        "doc_id", "digest", F.col("doc_id").alias("class_id"), F.col("digest").alias("first_digest")
    )
    return signed.select("doc_id", "digest").join(named, "digest").select(
        "doc_id", "digest", "class_id", "first_digest"
    ).unionByName(alone)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class, that of the least id, all its columns as they were; rows without a text all stay."""
    firsts = (
        classes(docs, id_col, text_col)
        .filter(F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("digest") == F.col("first_digest")))
        .select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("of"), F.col("digest").alias("first"))
        .distinct()
    )
    key, mark, of, first = fresh(docs, "__key", "__digest", "__of", "__first")
    firsts = firsts.withColumnsRenamed({"of": of, "first": first})
    text = quoted(text_col).cast("string")
    marked = docs.filter(text.isNotNull()).select(
        "*",
        F.coalesce(quoted(id_col).cast("bigint").cast("string"), F.lit("")).alias(key),
        digest(text).alias(mark),
    )
    kept = marked.join(firsts, (F.col(key) == F.col(of)) & (F.col(mark) == F.col(first)), "left_semi")
    kept = kept.dropDuplicates([key, mark]).drop(key, mark)
    return kept.unionByName(docs.filter(text.isNull()))
