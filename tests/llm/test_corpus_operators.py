"""Near copies, repeats, benchmark passages, personal data, the two classifiers and the pipeline."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskloom.llm import chunks, graphs, langid, neardup, pii, queries, templates, toxicity
from riskloom.session import stage

SCHEMA = "doc_id bigint, text string, node string, start string, h string"
RNG = random.Random(4)
VOCABULARY = ["".join(RNG.choice("abcdefghijklmnop") for _ in range(RNG.randint(2, 9))) for _ in range(4000)]


def prose(n):
    return [RNG.choice(VOCABULARY) for _ in range(n)]


def near(words, edits):
    out = list(words)
    for i in RNG.sample(range(len(out)), edits):
        out[i] = RNG.choice(VOCABULARY)
    return out


@pytest.fixture(scope="module")
def copies():
    """(doc_id, text): a large chain-like group of near copies, pairs, exact copies, odd texts."""
    base = prose(220)
    texts = [" ".join(near(base, RNG.randint(0, 4))) for _ in range(60)]
    texts += [" ".join(base)] * 20
    for _ in range(15):
        w = prose(RNG.randint(60, 150))
        texts += [" ".join(w), " ".join(near(w, RNG.randint(1, 6)))]
    texts += [" ".join(prose(80)) for _ in range(30)]
    texts += ["", "", None, None, "two words", "two words", "TWO words", "a b c d e f g" * 4000]
    rows = list(enumerate(texts))
    RNG.shuffle(rows)
    return rows


def brute_classes(rows, idf):
    """Components of all pairs by the operator's own similarity."""
    known = [(i, t.encode()) for i, t in rows if t is not None]
    h, tf, b = neardup.distinct_shingles([t for _, t in known])
    own = []
    for lo, hi in zip(b[:-1], b[1:]):
        w = neardup.weights_of(h[lo:hi], tf[lo:hi], idf)
        own.append((h[lo:hi], w, float(w.sum(dtype=np.float64))))
    parent = {i: i for i, _ in known}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, t) in enumerate(known):
        for m, (j, u) in enumerate(known[:n]):
            linked = t == u or (len(own[n][0]) and len(own[m][0]) and neardup.similarity(own[n], own[m]) >= 0.8)
            if linked:
                a, c = sorted((find(i), find(j)))
                parent[c] = a
    return {i: find(i) for i, _ in known} | {i: i for i, t in rows if t is None}


def test_classes_equal_brute_force(spark, copies):
    df = spark.createDataFrame([(i, t, "x", "x", "x") for i, t in copies], SCHEMA).repartition(5)
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(df).collect()}
    want = brute_classes(copies, neardup.shingle_weights(df))
    assert got == want
    assert len({got[i] for i in range(80)}) == 1
    kept = neardup.keep_one(df.unionByName(df.limit(3)))
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.where("text IS NOT NULL").collect()) == sorted(
        {c for i, c in want.items() if dict(copies)[i] is not None}
    )


def test_large_buckets_are_compared_exactly(spark, copies, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL", 2)
    monkeypatch.setattr(neardup, "HUB_PAIRS", 3)
    monkeypatch.setattr(neardup, "BLOCK", 7)
    df = spark.createDataFrame([(i, t, "x", "x", "x") for i, t in copies], SCHEMA)
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(df).collect()}
    assert got == brute_classes(copies, neardup.shingle_weights(df))


def test_samples_meet_as_often_as_the_weights_agree():
    rng = np.random.default_rng(2)
    agree, similar = [], []
    for _ in range(60):
        h = np.sort(rng.integers(0, 2**63, 400, dtype=np.uint64))
        cut = int(rng.integers(40, 360))
        w = rng.choice(np.array([1.0, 1.2, 1.41, 2.3], np.float32), 400)
        a, b = slice(0, cut), slice(cut // 3, 400)
        p = [neardup.samples(h[s], w[s], np.array([0, len(h[s])]))[0] for s in (a, b)]
        agree.append((p[0] == p[1]).mean())
        similar.append(neardup.similarity((h[a], w[a], w[a].sum()), (h[b], w[b], w[b].sum())))
    assert abs(np.mean(agree) - np.mean(similar)) < 0.03
    assert np.corrcoef(agree, similar)[0, 1] > 0.9


def test_near_duplicates_of_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert neardup.classes(none).count() == 0 and neardup.keep_one(none).count() == 0


def test_components(spark):
    edges = [(5, 4), (4, 3), (3, 9), (7, 8), (20, 21), (21, 22), (22, 23), (23, 24), (1, 1)]
    got = graphs.components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert {r["node"]: r["root"] for r in got.collect()} == {4: 3, 5: 3, 9: 3, 8: 7, 21: 20, 22: 20, 23: 20, 24: 20}


def test_components_send_nothing_to_all_executors(spark, monkeypatch):
    """Each step's joins meet by a shuffle, however small: broadcasts would add up in the driver."""
    plans, staged = [], graphs.stage

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return staged(df, name)

    monkeypatch.setattr(graphs, "stage", seen)
    got = graphs.components(spark.createDataFrame([(i, i + 1) for i in range(12)], "a bigint, b bigint"))
    assert sorted(map(tuple, got.collect())) == [(i, 0) for i in range(1, 13)]
    assert len(plans) > 1 and all("SortMergeJoin" in plan and "Broadcast" not in plan for plan in plans)


def test_repeated_passages_are_found_and_cut(spark):
    shared, short = prose(70), prose(12)
    rows = []
    for i in range(40):
        own = prose(120)
        if i % 4 == 0:
            own[30:30] = shared
        if i % 4 == 1:
            own[50:50] = short
        rows.append((i, ("é " if i % 3 else "\n") + " ".join(own), "x", "x", "x"))
    rows += [(100, None, "x", "x", "x"), (101, "", "x", "x", "x"), (None, " ".join(shared), "x", "x", "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    spans = stage(chunks.repeats(df))
    found = spans.collect()
    assert {r["doc_id"] for r in found} == {i for i in range(40) if i % 4 == 0} | {None}
    text = {i: t for i, t, *_ in rows}
    passage = " ".join(shared)
    for r in found:
        assert text[r["doc_id"]][r["start"] : r["end"]] in f"{text[r['doc_id']]}"
        if r["words"] >= 30:  # beside it two documents may share a chunk that the first one lacks
            assert r["is_copy"] == (r["doc_id"] != 0) and r["first_doc_id"] == 0
        at = text[r["doc_id"]].index(passage)
        assert at - 5 <= r["start"] and r["end"] <= at + len(passage) + 5
    clean = chunks.without_copies(df, spans)
    assert clean.columns == df.columns
    after = {r["doc_id"]: r["text"] for r in clean.collect()}
    for i, t in text.items():
        cut = sum(r["end"] - r["start"] for r in found if r["doc_id"] == i and r["is_copy"])
        assert len(after[i] or "") == len(t or "") - cut
    assert chunks.repeats(df.limit(0)).count() == 0


def test_short_and_periodic_passages_are_found(spark):
    rng = random.Random(9)
    shared = [" ".join(rng.choices(VOCABULARY, k=51 + i % 10)) for i in range(200)]
    shared += [" ".join((rng.choices(VOCABULARY, k=1 + i % 8) * 60)[:60]) for i in range(100)]
    shared += [" ".join(rng.choices("0123456789", k=51)) for _ in range(100)]
    texts = [" ".join([*rng.choices(VOCABULARY, k=40), p, *rng.choices(VOCABULARY, k=40)]) for p in shared * 2]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {r["doc_id"] for r in chunks.repeats(df).collect()} == set(range(len(texts)))
    assert chunks.chunks(df).where(f"words > {2 * chunks.FAR}").count() == 0


def test_chunks_resist_insertions(spark):
    text = " ".join(prose(400))
    df = spark.createDataFrame([(1, text), (2, "inserted " + text)], "doc_id bigint, text string")
    by = {}
    for r in chunks.chunks(df).collect():
        by.setdefault(r["doc_id"], set()).add(r["digest"])
    assert len(by[1] & by[2]) >= 0.9 * len(by[1])


ITEMS = [
    (1, "A train leaves Paris at 9 and travels 120 km to Lyon in 2 hours, what is the speed of the train if it stops twice"),
    (2, "short question about seven words here"),
    (3, None), (4, ""), (5, "A train leaves Paris at 9 and travels 120 km to Lyon in 2 hours, what is the speed of the train if it stops twice"),
]


def test_reparameterised_questions_are_found(spark):
    exact = ITEMS[0][1]
    other = exact.replace("Paris", "Rome").replace("Lyon", "Turin").replace("120", "300").replace("2 hours", "5 hours")
    mixed = exact.replace("to Lyon", "to Lyon").replace("at 9", "at 120")  # 9 and 120 become the same number
    pad = " ".join(prose(40))
    rows = [(1, f"{pad}. {exact}. {pad}"), (2, f"{pad}. {other} {pad}"), (3, pad), (4, None), (5, ""), (6, mixed),
            (7, f"x {ITEMS[1][1]} y"), (None, exact), (1, exact), (8, "SEVEN WORDS IN CAPITALS " * 20)]
    df = spark.createDataFrame([(i, t, "x", "x", "x") for i, t in rows], SCHEMA)
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = templates.contaminated(df, bench).collect()
    pairs = sorted((r["doc_id"] or 0, r["item_id"], r["reparameterised"]) for r in got)
    assert pairs == [(0, 1, False), (0, 5, False), (1, 1, False), (1, 1, False), (1, 5, False), (1, 5, False),
                     (2, 1, True), (2, 5, True), (6, 1, True), (6, 5, True), (7, 2, False)]
    clean = templates.keep_clean(df, bench)
    assert clean.columns == df.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == [3, 4, 5, 8]
    assert templates.contaminated(df.limit(0), bench).count() == 0
    assert templates.contaminated(df, bench.limit(0)).count() == 0


def leaks(spark, texts, items):
    """Sorted (text number, item number) pairs."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    return sorted((r["doc_id"], r["item_id"]) for r in templates.contaminated(docs, bench).collect())


def test_passages_in_other_case_are_found(spark):
    item = "In Évreux the straße of Élodie and Óscar leads from the old market to the ΟΔΟΣ of Σίσυφος, over 3 hills"
    plain = "the quick answer to such a long question is never given by those who have read the whole of it"
    pad = " ".join(prose(30))
    texts = [f"{pad} {f(x)} {pad}" for x in (item, plain) for f in (str, str.upper, str.lower, str.title)]
    assert leaks(spark, [*texts, pad, pad.upper()], [item, plain]) == [(i, i // 4) for i in range(8)]


def test_slots_that_disagree_split_the_alignment(spark):
    item = (
        "a bus carries 40 children from the school to the lake and then 40 of them walk home along the narrow path "
        "beside the river while 3 teachers and 7 parents wait at the lake for the next bus"
    )
    split = item.replace("carries 40", "carries 55")  # 40 becomes 55 and stays 40, a long verbatim run behind it
    merged = item.replace("3 teachers", "5 teachers").replace("7 parents", "5 parents").replace("40", "90")
    short = "does 4 plus 4 make 8 here"
    texts = [f"well {split} then", merged, "does 4 plus 5 make 8 here", "does 3 plus 3 make 9 here", item[60:100]]
    assert leaks(spark, texts, [item, short]) == [(0, 0), (1, 0), (3, 1)]


def test_slots_of_several_words_and_common_changes(spark):
    item = "Tom has 3 apples and 4 pears in his basket and gives 2 apples to his sister who has 5 km to walk home that day"
    walk = "We know that Tom Baker walked 12 km from Athens to Sparta in 3 days, how many km did Tom Baker walk each day"
    pad = " ".join(prose(30))
    changed = [item.replace("Tom", "Mary Ann"), item.replace("3 apples", "4 apples"), item.replace("5 km", "9 miles"),
               item.replace("3 apples", "120 apples").replace("5 km", "120 km"), "Νίκος" + item[3:]]
    moved = [walk.replace("Tom Baker", "Άννα"), walk.replace("Athens", "Москва").replace("Sparta", "New York City"),
             walk.replace("12 km", "30 miles")]
    texts = [f"{pad} {x}, {pad}" for x in changed + moved] + [pad]
    want = [(i, 0) for i in range(len(changed))] + [(len(changed) + i, 1) for i in range(len(moved))]
    assert leaks(spark, texts, [item, walk]) == want


def test_items_dense_in_slots_are_found_as_they_stand(spark):
    items = ["12 km 5 kg 7 h 30 min 9 lb 11 oz 4 ft 6 in 2 l", "3 + 4 = 7", "and Ana Bo Cy Di", "17"]
    pad = " ".join(prose(20))
    texts = [f"{pad} {x}, {pad}" for x in items] + [pad, "13 km 5 kg 7 h 31 min 9 lb 12 oz 4 ft 7 in 2 l", "3 + 5 = 8"]
    assert leaks(spark, texts, items) == [(i, i) for i in range(4)]


def test_first_word_of_an_item_inside_a_sentence(spark):
    item = "What is the capital of France"
    texts = [f'one asked, "{item}?"', "one said, What is the capital of Spain then", "What is the capital of Chile",
             "one said, Rome is the capital of Spain then", "one said, what is the capital of a land"]
    assert leaks(spark, texts, [item]) == [(0, 0), (1, 0), (2, 0)]


def test_item_blocks_give_the_same(spark, monkeypatch, sf_dir):
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(map(str, templates.contaminated(docs, bench).collect()))
    monkeypatch.setattr(templates, "BLOCK_WINDOWS", 1500)
    assert sorted(map(str, templates.contaminated(docs, bench).collect())) == whole


def test_leaks_equal_plain_search(spark, sf_dir):
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    want = {(d["doc_id"], b["item_id"]) for d in docs for b in bench if b["text"] in d["text"]}
    got = {(r["doc_id"], r["item_id"]) for r in queries.op4_decontamination(spark, sf_dir).collect()}
    assert want <= got
    for d, b in got - want:  # whatever else is found shares a long run of words
        a, c = (re.findall(r"\w+", x[0]["text"].lower()) for x in ([r for r in docs if r["doc_id"] == d], [r for r in bench if r["item_id"] == b]))
        runs = {tuple(c[k : k + 8]) for k in range(len(c) - 7)}
        assert any(tuple(a[k : k + 8]) in runs for k in range(len(a) - 7))


PLAIN = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def plain_spans(text):
    out = []
    for n, (kind, pattern) in enumerate(PLAIN):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": lambda: True,
                "ip": lambda: all(int(x) <= 255 for x in m.group().split(".")),
                "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if ok:
                out.append((m.start(), n, kind, m.end()))
    return [f"{k}:{a}:{e}" for a, _, k, e in sorted(out)]


ODD = [
    None, "", "no data", "a@b.c_d@e.f x@y", "a..b@c-d.e.f.", "@@a@b.c@d.e", "é a@b.co Ω 1.2.3.4.5.6.7.8 999.1.1.1",
    "0000001.2.3.4 1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1111 0", "4111  1111 1111 1111", "12 4111111111111111",
    "+1 (132) 555-1352 +12 +1.2.3 ) +4912345678901234567890", "+1 555 123 4567(8) ()", "5" * 5000, "a" * 20_000 + "@",
    "1-" * 3000, "x@" * 300 + "y.z", "+" * 100 + "1 234 567 8901", "call 132-555-1352 or mail a @ b.c",
]


def test_base_spans_equal_plain_search(spark, sf_dir):
    df = spark.createDataFrame([(i, t, "x", "x", "x") for i, t in enumerate(ODD)], SCHEMA)
    rows = pii.report(pii.find(df.unionByName(df.where("doc_id = 8")))).collect()
    assert len(rows) == len(ODD) + 1
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for got, text in [(r, ODD[r["doc_id"]]) for r in rows] + [
        (r, texts[r["doc_id"]]) for r in queries.op8_personal_data(spark, sf_dir).collect()
    ]:
        want = plain_spans(text or "")
        assert got["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), (text, got["spans"], want)
        assert [s for s in got["spans"].split(",") if s.split(":")[0] in pii.BASE] == want
        assert [got[f"n_{k}"] for k in pii.BASE] == [sum(s.startswith(k) for s in want) for k in pii.BASE]


def test_trees_add_what_looks_alike(spark):
    """Card numbers with a wrong check digit look like cards and are added; long prices are not."""
    rng = random.Random(1)
    rows = []
    for i in range(800):
        head = f"4{rng.randint(0, 10**14 - 1):014d}"
        right = next(d for d in "0123456789" if luhn(head + d))
        number = head + (right if i % 20 else str((int(right) + 1) % 10))
        card = " ".join(number[k : k + 4] for k in range(0, 16, 4))
        rows.append((i, f"some words card {card} and more {rng.randint(1000000, 9999999)}/{rng.randint(10, 99)} words"))
    found = pii.report(pii.find(spark.createDataFrame(rows, "doc_id bigint, text string"))).collect()
    wrong = [r for r in found if r["doc_id"] % 20 == 0]
    assert all(r["n_card"] == (r["doc_id"] % 20 > 0) for r in found)
    assert sum("number:" in r["spans"] for r in wrong) > 0.9 * len(wrong)
    for r in found:
        for s in filter(None, r["spans"].split(",")):
            _, a, e = s.split(":")
            assert "/" not in rows[r["doc_id"]][1][int(a) : int(e)]


def test_added_spans_that_do_not_overlap_all_stay(spark):
    class Scores:
        def selected(self, rows):
            return rows

    spans = [(1, "address", 0, 20, 0.8), (1, "number", 15, 30, 0.7), (1, "address", 25, 40, 0.9),
             (2, "address", 0, 20, 0.6), (2, "number", 15, 30, 0.9), (2, "address", 25, 40, 0.8)]
    loose = spark.createDataFrame(
        [(k, k, *s, 0) for k, *s in spans], "k1 bigint, k2 int, kind string, start int, end int, score double, label int"
    )
    got = pii._added(loose, Scores())
    assert got.columns == ["k1", "k2", "kind", "start", "end"]
    assert sorted((r["k1"], r["start"]) for r in got.collect()) == [(1, 0), (1, 25), (2, 15)]


FORMS = [
    ("secret", 'token = "{}"', "9a8b99b6f89edc9746a2ef7e89e21f68bcb4543d"),
    ("secret", "the api key: {}, keep it", "sk_9aZ81kQpL0x7Yt52WbC3mN4d"),
    ("secret", "we saw {} in the log", "q8ZtY2xP0LkW7bVnM4cR1sDfG6hJ"),
    ("hexgroups", "host {} answers", "2001:0db8:85a3:08d3:1319:8a2e:0370:7344"),
    ("hexgroups", "the card at {} is new", "a4:5e:60:c2:1b:9f"),
    ("account", "account {} was used", "DE44 5001 0517 5407 3249 31"),
    ("account", "pay to {} today", "FR7630006000011234567890189"),
    ("spelled", "write to {} today", "anna.kuhn at postweb dot com"),
    ("spelled", "or {} instead", "joe (at) mailer (dot) org"),
    ("address", "mail {} now", "jöhn@ümail.com"),
    ("number", "call {} now", "132-555-1352"),
    ("number", "card {} ok", "4111 1111 1111 1112"),
]
LIKE = ["on 2024-05-17 10:30:45 we met", "it cost 1 000 000 in 2020", "isbn 978-3-16-148410-0 is out", "verse 3:16:1 says so",
        "he looked at the dot of ink", "section12ofthedocument is long", "file/name/2024/draft here", "part 123456789 x", "at@home",
        "see HTTP_STATUS_CODE_NAME_12 there", "the number 4111111111111112 is odd", "AB12 THE QUICK BROWN FOX"]


def test_added_spans_of_every_form(spark):
    """Planted spans of each form are found whole and nothing else is, however small the table."""
    rows = [(n, said.format(x)) for n, (_, said, x) in enumerate(FORMS)] + [(100 + n, x) for n, x in enumerate(LIKE)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.report(pii.find(df)).collect()}
    hit = 0
    for n, (kind, said, x) in enumerate(FORMS):
        at = said.index("{")
        hit += f"{kind}:{at}:{at + len(x)}" in got[n].split(",")
    assert hit >= 0.9 * len(FORMS), {n: got[n] for n in range(len(FORMS))}
    wrong = {k: v for k, v in got.items() if k >= 100 and v}
    assert len(wrong) <= 1, wrong


def test_spans_are_added_on_given_tables(spark, sf_dir):
    rows = [r["spans"] for r in queries.op8_personal_data(spark, "/root/testdata/sf0.01").collect()]
    added = [s for x in rows for s in x.split(",") if s.split(":")[0] in pii.LOOSE]
    assert added and all(s.startswith("secret:") for s in added)


def test_redaction(spark):
    df = spark.createDataFrame(
        [(1, "é a@b.co, +1 234 567 8901!", "n", "s", "h"), (2, None, "n", "s", "h"), (3, "clean", "n", "s", "h"),
         (None, "1.2.3.4", "n", "s", "h"), (1, "é a@b.co, +1 234 567 8901!", "n", "s", "h")], SCHEMA,
    )
    got = pii.redact(df)
    assert got.columns == df.columns
    assert sorted((r["text"] or "") for r in got.collect()) == ["", "[IP]", "clean"] + ["é [EMAIL], [PHONE]!"] * 2
    assert pii.redact(df.limit(0)).count() == 0


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op10_toxicity(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = got.where("held_out").join(labels, "doc_id").collect()
    hits = sum(r["predicted"] == 1 and r["toxic"] == 1 for r in rows)
    assert hits >= 0.85 * sum(r["toxic"] for r in rows)
    assert hits >= 0.95 * sum(r["predicted"] for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)


def test_toxicity_of_odd_tables(spark):
    rows = [(1, None, "x", "x", "x"), (2, "", "x", "x", "x"), (2, "z" * 50_000, "x", "x", "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    for train in ([], [(b"only one kind", 1)] * 9, [(None, 0), (b"", 1)] * 5):
        got = toxicity.score(df, toxicity.fit(train)).collect()
        assert len(got) == 3 and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score(df.limit(0), toxicity.fit([])).count() == 0


def test_languages_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op7_language(spark, sf).where("held_out")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)


def test_languages_of_odd_texts(spark):
    train = [(f"the cat number {i} sat".encode(), "en") for i in range(20)] + [(f"die katze {i} sitzt".encode(), "de") for i in range(20)]
    rows = [(1, None), (2, ""), (3, "12 34 !!"), (4, "katze die"), (4, "the cat"), (5, "the " * 20_000), (6, "² ½ Ⅷ ①")]
    df = spark.createDataFrame([(i, t, "x", "x", "x") for i, t in rows], SCHEMA)
    got = [(r["doc_id"], r["lang_pred"]) for r in langid.predict(df, langid.fit(train)).collect()]
    assert sorted(got) == [(1, "und"), (2, "und"), (3, "und"), (4, "de"), (4, "en"), (5, "en"), (6, "und")]
    alone = langid.predict(df, langid.fit([(b"ab", "xx")])).collect()
    assert {r["lang_pred"] for r in alone} == {"und", "xx"}
    assert {r["lang_pred"] for r in langid.predict(df, langid.fit([])).collect()} == {"und"}
    assert langid.predict(df.limit(0), langid.fit(train)).count() == 0


def test_sample_of_languages_is_bounded(spark):
    """The least key hashes of each language, one text a key, whatever repeats."""
    rows = [(i % 400, f"text {i:04d}", "en" if i % 400 < 300 else "de") for i in range(1200)]
    rows += [(None, "x", "en"), (1, None, "en"), (2, "x", None), (3, "x", "und")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = langid.training_rows(df, F.col("doc_id") >= 0, 50, 70)
    assert len(got) == 70 and {lang for _, lang in got} == {"de", "en"}
    assert all(int(t.split()[1]) < 400 for t, _ in got) and got == langid.training_rows(df.repartition(7), F.col("doc_id") >= 0, 50, 70)


@pytest.mark.parametrize("k", [1, 2, 3, 4, 5, 6, 20])
def test_codewords_differ_in_many_bits(k):
    code = langid.codewords(k)
    assert code.shape[0] == k and set(np.unique(code)) <= {-1.0, 1.0}
    far = [(code[i] != code[j]).sum() for i in range(k) for j in range(i)]
    assert not far or min(far) >= max(1, code.shape[1] // 4)


def test_pipeline_stages_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    before, after = None, docs
    for name, step in corpus_pipeline.STAGES:
        before, after = after, stage(step(spark, after, sf_dir))
        if name != "packing":
            assert after.columns == docs.columns and 0 < after.count() <= before.count()
        if name == "decontamination":
            assert not any(b["text"] in d["text"] for d in after.collect() for b in bench)
        if name == "personal data":
            assert not any(plain_spans(d["text"]) for d in after.collect())
    assert after.select("doc_id").distinct().count() == before.count()


def test_pipeline_of_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered_in_the_entry(spark):
    import __spark_entry__ as entry

    assert {f"op{n}" for n in range(1, 14)} <= {q.split("_")[0] for q in entry.queries()}
    assert "pipeline" in entry.queries() and "op2_quality" in entry.oracle_sql()
