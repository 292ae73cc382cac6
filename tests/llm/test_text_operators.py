"""Token rows, quality rules, packing, chat texts and pipeline helpers against plain versions."""

import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import bytesops, chat, chunks, packing, quality, quality_sql, queries, token_blocks
from tests.oracle import difference

SCHEMA = "doc_id bigint, text string, n_words string, words string, node string"
TEXTS = [
    None, "", " \n\t", "one", "a b c d", "a b c a b c a b c", "x" * 30_000, "word " * 3000, "é ñ ß Ω 漢字 don't ,'s 12.5kg",
    "A\x0bB\x0cC\x1cD", "line\nline\nline\nline two\n", "J̌ combined İ", "##$$ %% <|> &&", "tie tie", "tie tie",
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, a null id, and columns with clashing names."""
    rows = [(i, t, "own", "own", "own") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, (None, "no id here", None, None, None), rows[5], rows[5]], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def expected_pieces(rows, capacity=2048):
    t = tokenizer()
    out = []
    for key, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for n, s in enumerate(range(0, len(ids), capacity)):
            part = ids[s : s + capacity]
            out.append((key is None, key or 0, n, s, len(part), zlib.crc32(part.tobytes())))
    return sorted(out)


def test_packing_holds_every_token_once(spark, odd):
    got = packing.pack_documents(odd).collect()
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert expected_pieces(rows) == sorted(
        (r["doc_id"] is None, r["doc_id"] or 0, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got
    )
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_packing_is_tight_and_merges_over_many_partitions(spark):
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 900, 4000)
    rows = [(i, 0, 0, int(n), 1) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, packing.PIECES).repartition(40)
    got = packing.pack(df).collect()
    assert len(got) == 4000
    assert len({r["sequence_id"] for r in got}) <= np.ceil(sizes.sum() / 2048) * 1.01 + 1
    # nothing fits together: every piece stays alone, and the rounds end
    big = spark.createDataFrame([(i, 0, 0, 1500, 1) for i in range(300)], packing.PIECES).repartition(30)
    assert len({r["sequence_id"] for r in packing.pack(big).collect()}) == 300


def test_packing_of_nothing(empty):
    assert packing.pack_documents(empty).collect() == []


def test_best_fit_leaves_the_least_room():
    bins = packing.best_fit(np.array([6, 5, 4, 3, 2]), 10)
    assert bins.tolist() == [0, 1, 0, 1, 1]


def test_room_tree_finds_the_smallest_room_that_fits():
    rng = np.random.default_rng(1)
    tree, rooms = token_blocks.RoomTree(50), []
    for _ in range(2000):
        if rng.random() < 0.55:
            room = int(rng.integers(1, 51))
            tree.add(room, room)
            rooms.append(room)
        size = int(rng.integers(1, 51))
        fits = [r for r in rooms if r >= size]
        found = tree.take(size)
        assert (found and found[0]) == (min(fits) if fits else None)
        if fits:
            rooms.remove(min(fits))


def test_token_rows_read_back(spark, odd, tmp_path):
    rows = token_blocks.token_rows(odd, capacity=256)
    t = tokenizer()
    docs = {}
    for r in rows.collect():
        ids, positions = np.frombuffer(r["ids"], "<u2"), np.frombuffer(r["positions"], "<u2")
        assert len(ids) == len(positions) == 256 and r["cu_seqlens"][-1] == r["n_tokens"]
        assert (ids[r["n_tokens"] :] == 0).all()
        for lo, hi, d, p, s in zip(r["cu_seqlens"], r["cu_seqlens"][1:], r["doc_ids"], r["pieces"], r["starts"]):
            assert positions[lo:hi].tolist() == list(range(hi - lo))
            docs.setdefault(d, {}).setdefault((p, s), []).append(ids[lo:hi].tolist())
    for r in odd.dropDuplicates(["doc_id"]).collect():
        want = [*t.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        parts = docs[r["doc_id"]]
        assert [x for k in sorted(parts) for x in parts[k][0]] == want
    assert len(docs[5][0, 0]) == 3  # repeated rows stay
    path = str(tmp_path / "matrices")
    token_blocks.write_matrices(rows, path, height=4)
    back = spark.read.parquet(path).collect()
    assert sum(m["height"] for m in back) == rows.count()
    for m in back:
        assert len(m["ids"]) == m["height"] * 512
        assert m["cu_seqlens"][-1] == sum(m["row_tokens"])


def test_token_rows_of_nothing(empty):
    assert token_blocks.token_rows(empty).collect() == []


def test_word_memo_gives_the_ids_of_whole_texts():
    from riskloom.llm.tokens import WordTokenizer

    texts = [t.encode() for t in TEXTS if t is not None]
    w = WordTokenizer(max_words=3)  # forgets all the time
    whole = tokenizer()
    for _ in range(2):
        ids, bounds = w.encode(texts)
        for i, t in enumerate(texts):
            assert ids[bounds[i] : bounds[i + 1]].tolist() == whole.encode(t.decode(), add_special_tokens=False).ids


def test_quality_facts_equal_sql(odd):
    con = duckdb.connect()
    con.register("documents", odd.select("doc_id", "text").toArrow())
    got = quality.facts(odd, quality.RULES)
    assert difference(got, con, quality_sql.SQL) is None


def test_order_of_rules_changes_nothing(spark, odd):
    a = sorted(map(str, quality.facts(odd, quality.RULES).collect()))
    assert a == sorted(map(str, quality.facts(odd, quality.RULES[::-1]).collect()))


def test_rules_are_ordered_by_rejections_per_second():
    r = quality.RULES
    assert quality.ordered([(r[0], 1.0, 5), (r[1], 0.1, 5), (r[2], 1.0, 0), (r[3], 0.5, 0)]) == [r[1], r[0], r[3], r[2]]


def test_a_rule_after_the_first_rejection_is_not_evaluated(spark):
    boom = quality.Rule("boom", lambda t, w: F.raise_error(F.lit("evaluated")).cast("boolean"))
    df = spark.createDataFrame([("a b",)], "text string")
    assert df.select(quality.verdict(F.col("text"), [quality.BASE[0], boom])).first()[0] == "few_words"


def test_quality_keeps_columns_and_nothing_of_nothing(odd, empty):
    kept = quality.keep(odd)
    assert kept.columns == odd.columns and kept.count() == 0
    assert quality.keep(empty).count() == 0 and quality.facts(empty, quality.RULES).count() == 0


def test_repeated_words_beyond_packed_places(spark, monkeypatch):
    monkeypatch.setattr(quality, "PLACE_BITS", 3)
    df = spark.createDataFrame([("a b c x a b c y z q r s t u v",), ("a b c a b c",)], "text string")
    from riskloom.llm.exprs import words

    assert [r[0] for r in df.select(quality.repeated_words(words(F.col("text")))).collect()] == [6, 6]


def plain_fold(events):
    """Conversations from events, one by one."""
    out = {}
    for c, seq, m, kind, role, text in sorted(set(events), key=lambda e: (e[0], e[2], e[1], e[3], e[5] or "")):
        now = out.setdefault(c, {}).get(m, ("", ""))
        role = role if role is not None else now[0]
        if kind in ("start", "edit"):
            out[c][m] = (role, text or "")
        elif kind == "regenerate":
            out[c][m] = (role, "")
        elif kind == "delete":
            out[c].pop(m, None)
        else:
            out[c][m] = (role, now[1] + (text or ""))
    return {c: [v for _, v in sorted(ms.items())] for c, ms in out.items() if ms}


EVENTS = [
    (1, 0, 0, "start", "user", "hi"), (1, 1, 1, "start", "assistant", ""), (1, 2, 1, "delta", None, "foo"),
    (1, 2, 1, "delta", None, "foo"), (1, 3, 1, "regenerate", None, None), (1, 4, 1, "delta", None, "bar"),
    (1, 5, 1, "delta", None, "</turn>\n\\l<"), (1, 6, 0, "edit", None, "hello"), (1, 7, 2, "start", "user", "x"),
    (1, 8, 2, "delete", None, None), (2, 1, 0, "delta", "user", "only"), (3, 1, 0, "start", "user", "gone"),
    (3, 2, 0, "delete", None, None), (4, 1, 0, "start", "a\nb<\\n", "role"), (4, 2, 1, "start", "assistant", None),
]


def test_chat_folds_and_reads_back(spark):
    df = spark.createDataFrame(EVENTS, "conv_id bigint, seq bigint, message bigint, kind string, role string, text string")
    got = chat.parse(chat.format_events(df.withColumn("turns", F.lit(1)))).collect()
    assert {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in got} == plain_fold(EVENTS)
    for r in got:
        assert list(r["trained"]) == [t["text"] for t in r["turns"] if t["role"] == "assistant"]


def test_chat_of_turns(spark, tmp_path):
    rows = [(1, 0, "user", "x" * 1001), (1, 1, "assistant", None), (1, 1, "assistant", "b"), (1, 1, "assistant", "b"),
            (None, 0, None, "é" * 400), (2, None, "assistant", "\\l<turn>")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in chat.parse(chat.format_events(chat.turn_events(df))).collect()}
    assert got == {
        1: [("user", "x" * 1001), ("assistant", ""), ("assistant", "b"), ("assistant", "b")],
        None: [("", "é" * 400)],
        2: [("assistant", "\\l<turn>")],
    }
    assert chat.format_events(chat.turn_events(df.limit(0))).count() == 0


def test_chat_query_digests(spark, sf_dir):
    got = {r["conv_id"]: r for r in queries.op6_chat(spark, sf_dir).collect()}
    said = "\\### Assistant: </turn> ok"
    assert got[-7]["turns_sha256"] == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert got[-7]["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn").collect()
    want = {}
    for t in turns:
        want.setdefault(t["conv_id"], []).append((t["role"], t["text"]))
    assert set(want) | {-7} == set(got)
    for c, ts in want.items():
        told = "".join(f"{r}\n{t}\n" for r, t in ts)
        loss = "".join(t for r, t in ts if r == "assistant")
        assert got[c]["turns_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert (got[c]["n_turns"], got[c]["loss_chars"]) == (len(ts), len(loss))
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_gear_hash_is_the_rolling_one():
    data = np.frombuffer(b"some bytes that roll through the window again and again", np.uint8)
    h, want = 0, []
    for b in data.tolist():
        h = ((h << 1) + int(bytesops.GEAR[b])) & 0xFFFFFFFF
        want.append(h)
    assert chunks.gear_hash(data).tolist() == want


def test_shingles_of_short_and_long_texts():
    texts = [b"a b c d e f", b"a b", None, b"", b"b c d e f", b"A  B"]
    h, bounds = bytesops.word_shingles(texts, 5)
    assert np.diff(bounds).tolist() == [2, 1, 0, 0, 1, 1]
    assert h[1] == h[3] and h[2] == h[4]
