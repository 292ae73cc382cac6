"""Merkle manifest, bounded-space packing, tokenizer alignment, and token ids, against plain versions."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskloom.llm import alignment, manifest, packing, queries, windows
from riskloom.llm.chunk_tokens import ByteTokenizer, PieceTokenizer, shared
from riskloom.llm.tokens import WordTokenizer
from tests.oracle import connect, difference

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"
ODD = [None, "", " ", "\n", "a \u2581 b", "don't stop 3 km now", "na\u00efve caf\u00e9 \u65e5\u672c\u8a9e \U0001f600 \u00d7\u00f7",
       "x <|endoftext|> y </s> <unk>", "a\0b", "  x  ", "\n\u00a0\n x", "word " * 3000, "z" * 5000]
PIECES = [" ", "  ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\u00a0", "\u2003", "\u3000", "a", "the", "X", "\u00e9", "e\u0301",
          "\u65e5\u672c", "1", "23", "\u0663", "\u00bd", "'s", ".", "!!", "<|endoftext|>", "<s>", "\0", "\U0001f600", "\u00d7", "\u2026"]


def mixed(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def library(plain=False, name="byte_bpe_50k.json"):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = plain
    return t


def sentences():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def split(ids, bounds):
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]


def test_chunked_ids_equal_whole_texts():
    texts = [t for t in mixed(6000) + ODD if t]
    for plain in (False, True):
        got = split(*ByteTokenizer(plain=plain).encode([t.encode() for t in texts]))
        assert got == [e.ids for e in library(plain).encode_batch(texts, add_special_tokens=False)]
    got = split(*PieceTokenizer().encode([b" " + t.encode() for t in texts]))
    assert got == sentences().encode(texts)
    few = ByteTokenizer(max_chunks=10)  # forgets all the time
    for t in texts[:200]:
        assert split(*few.encode([t.encode()]))[0] == library().encode(t, add_special_tokens=False).ids


def test_word_ids_know_special_tokens_and_nul():
    texts = ["a <|endoftext|> b", "<|startoftext|>x", "a\0b \0 c", "plain words, here", "", "<| no token |>"]
    own = library(name="word_bpe_49k.json")
    assert split(*WordTokenizer().encode([t.encode() for t in texts])) == [
        e.ids for e in own.encode_batch(texts, add_special_tokens=False)
    ]


def table(spark, texts=ODD, ids=None):
    rows = [(i, "s", "en", len(t or ""), t) for i, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows + rows[:1] + [(None, None, None, None, "no id")], SCHEMA)


# ------------------------------------------------------------------ manifest

def H(*x):
    return hashlib.sha256("".join(x).encode()).hexdigest()


def plain_manifest(rows, arity):
    """(leaf, subroot, root, proof text) of each row."""
    cell = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    runs = {}
    for r in rows:
        runs.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, H(*map(cell, r))))

    def tree(leaves):
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append([H(*levels[-1][i : i + arity]) for i in range(0, len(levels[-1]), arity)])
        return levels

    def path(levels, i):
        out = []
        for level in levels[:-1]:
            lo = i - i % arity
            out += [x for j, x in enumerate(level[lo : lo + arity], lo) if j != i]
            i //= arity
        return "".join(out)

    names = sorted(runs, key=lambda k: (k is not None, (k or "").encode()))
    trees = {k: tree([x[2] for x in sorted(runs[k])]) for k in names}
    top = tree([trees[k][-1][0] for k in names])
    return sorted(
        (leaf, trees[k][-1][0], top[-1][0], path(trees[k], i) + path(top, n))
        for n, k in enumerate(names)
        for i, leaf in enumerate(trees[k][0])
    )


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


@pytest.mark.parametrize("arity, n", [(2, 1), (2, 21), (3, 11)])
def test_manifest_equals_plain_trees(spark, arity, n):
    rng = random.Random(n)
    rows = [(rng.choice([None, i]), rng.choice(["a", None]), rng.choice([None, "en", "\u00e9", "", "de"]), i, f"t {i} \u00e9") for i in range(n)]
    df = spark.createDataFrame(rows + rows[:2], SCHEMA)
    made = manifest.manifest(df.withColumn("run", F.lit(1)).withColumn("digest", F.lit(2)), FIELDS, "lang", "doc_id", arity)
    hexed = [manifest.shown(F.col(c)) for c in ("leaf", "subroot", "root")]
    got = made.select(*hexed, manifest.proof_text(F.col("proof")), manifest.shown(manifest.fold(F.col("leaf"), F.col("proof")))).collect()
    want = plain_manifest(df.collect(), arity)
    assert sorted(tuple(r)[:4] for r in got) == want
    assert {r[4] for r in got} == {want[0][2]}


def test_manifest_of_an_empty_table_and_its_sql(spark, sf_dir):
    df = spark.createDataFrame([], SCHEMA)
    assert manifest.manifest(df, FIELDS, "lang", "doc_id").count() == 0
    got = queries.op11_manifest(spark, sf_dir)
    assert difference(got, connect("sf0.001"), queries.ORACLES["op11_manifest"]) is None
    bad = {r["doc_id"] for r in got.where("not verified").collect()}
    assert bad == {r["doc_id"] for r in got.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0}


# ------------------------------------------------------------------ windows

def check_windows(rows, texts, capacity=1024):
    """Every id lies in one piece, sequences are gapless and full or as long as a power of two."""
    by_place, by_doc = {}, {}
    for r in rows:
        by_place.setdefault(r["sequence_id"], []).append(r)
        by_doc.setdefault(r["doc_id"], []).append(r)
    for own in by_place.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at == capacity or at & (at - 1) == 0
    for key, said in texts.items():
        want = []
        for t in said:
            ids = library().encode(t or "", add_special_tokens=False).ids + [0]
            want.append(np.array(ids, "<u4"))
        own = by_doc[key]
        assert sum(r["length"] for r in own) == sum(map(len, want))
        if len(said) == 1:
            assert sorted((r["start"], r["start"] + r["length"]) for r in own)[-1][1] == len(want[0]) == own[0]["doc_tokens"]
            for r in own:
                assert r["ids_crc32"] == zlib.crc32(want[0][r["start"] : r["start"] + r["length"]].tobytes())


@pytest.mark.parametrize("open_windows", [1, 64])
def test_windows_hold_every_id_once(spark, open_windows):
    df = table(spark).withColumn("ids", F.lit("clash")).withColumn("starts", F.lit(1))
    rows = windows.pieces(windows.pack_documents(df, open_windows=open_windows)).collect()
    check_windows(rows, {0: [ODD[0]] * 2, None: ["no id"], **{i: [t] for i, t in enumerate(ODD) if i}})


def test_left_over_windows_are_merged_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(windows, "GROUP", 4)
    texts = mixed(300, 5)
    df = table(spark, texts).where("doc_id > 0").repartition(20)
    rows = windows.pieces(windows.pack_documents(df, open_windows=2)).collect()
    check_windows(rows, {i: [t] for i, t in enumerate(texts) if i})


def test_windows_of_an_empty_table_and_of_the_given_one(spark, sf_dir):
    assert windows.pieces(windows.pack_documents(table(spark).limit(0))).count() == 0
    rows = queries.op12_windows(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    check_windows(rows, {r["doc_id"]: [r["text"]] for r in docs})


def test_windows_are_best_fits():
    w = windows.Windows(10, 2)
    piece = lambda doc, n: ([(doc, 0, n, np.arange(n))], n)
    for doc, n in ((1, 6), (2, 7), (3, 3), (4, 8)):
        w.add(*piece(doc, n))
    # 3 goes to 2, which is full; 4 opens a window; then nothing fits and the fullest is topped up
    assert [[p[0] for p in x] for x in w.full] == [[2, 3]]
    w.add(*piece(5, 5))
    assert [[(p[0], len(p[3])) for p in x] for x in w.full[1:]] == [[(4, 8), (5, 2)]]
    assert sorted(sum(len(p[3]) for p in x) for x in w.left()) == [9]


# ------------------------------------------------------------------ alignment

def plain_alignment(text):
    """(tokens of A, of B, groups, links, written groups), None where texts have no tokens."""
    if not text:
        return None
    a, b = library(True).encode(" " + text, add_special_tokens=False).ids, sentences().encode(text)
    tables = [shared(ByteTokenizer, plain=True).token_bytes(), shared(PieceTokenizer).token_bytes()]
    if any(b"".join(t[i] for i in ids) != (" " + text).encode() for t, ids in zip(tables, (a, b))):
        return None
    ends = [np.cumsum([len(t[i]) for i in ids]).tolist() for t, ids in zip(tables, (a, b))]
    links = [(a[sum(x < e for x in ends[0])], b[sum(x < e for x in ends[1])]) for e in sorted({*ends[0], *ends[1]})]
    groups, i, j = [], 0, 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        x, y = sum(e <= cut for e in ends[0]), sum(e <= cut for e in ends[1])
        groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
        i, j = x, y
    return len(a), len(b), len(groups), links, ";".join(groups)


@pytest.mark.parametrize("sent", [5, 1 << 18])
def test_alignment_equals_plain_version(spark, sent):
    texts = [t for t in ODD if len(t or "") < 100] + mixed(120, 3) + ["the cat sat on the mat"] * 3
    df = table(spark, texts).withColumn("pairs", F.lit(1)).withColumn("row_id", F.lit(2))
    rows = alignment.with_counts(alignment.aligned(df), sent_pairs=sent).collect()
    found = {t: plain_alignment(t) for t in {*texts, "no id"}}
    said = [r["text"] for r in df.collect()]
    df_count = Counter(p for t in said if found[t] for p in set(found[t][3]))
    best = {}
    for (x, _), n in df_count.items():
        best[x] = max(best.get(x, 0), n)
    want = []
    for t in said:
        v = found[t]
        own = v[3] if v else []
        want.append(
            (*v[:3], len(own), sum(df_count[p] == best[p[0]] for p in own), sum(df_count[p] for p in own), v[4])
            if v
            else (0, 0, 0, 0, 0, 0, "")
        )
    got = [tuple(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")) for r in rows]
    assert sorted(got) == sorted(want)


def test_alignment_of_an_empty_table(spark):
    assert alignment.with_counts(alignment.aligned(table(spark).limit(0))).count() == 0


def test_pointers_of_long_chains():
    a, b = np.arange(2, 4001, 2), np.append(np.arange(1, 4000, 2), 4000)
    last_a, last_b, _, _ = alignment.terminals(a, b)
    assert set(last_a) == set(last_b) == {len(a) - 1}  # one component, however long


def test_facts_of_packed_pieces(spark, sf_dir):
    """Pieces of a document follow each other without a gap, and places in a sequence do, too."""
    rows = queries.op5_packing(spark, sf_dir).collect()
    own = library(name="word_bpe_49k.json")
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    for key, text in texts.items():
        ids = np.array(own.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for n, r in enumerate(sorted(by[key], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (n, n * packing.CAPACITY)
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
