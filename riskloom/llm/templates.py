"""Benchmark decontamination by template windows and slot consistency.

Words are stripped of ASCII punctuation at both ends and lowered in ASCII.  Typed placeholders take the place of
numbers (digits, no letters), quantities (a digit first, then letters, or a number and a listed unit) and names (capitals
of any script inside a sentence; adjacent ones are one name, so names may have any number of words).  Windows of
``WINDOW`` template words, at least half of them literal, are hashed; an item of fewer is one window of its own.  All
words are hashed a second time in windows of literal, fully case-folded words, so copies in other case and copies dense
in slots are found as they stand.  An item whose first word has a capital is read a second time as it reads inside a
sentence; that word must be the same there.  Windows of a document that occur in an item are aligned: along one alignment
the words of the item covered by common windows of either kind are counted.  In a span of them every slot value of the
item must always meet the same value of the document, so an alignment is split where one does not; different values may
meet the same new one.  A document contains an item if such a span, or the words covered literally, are ``RUN`` words or
more (or all words of a shorter item); if a slot value differs the question was re-parameterised.

The item side is broadcast in blocks of at most ``BLOCK_WINDOWS`` windows, each block to one scan of the documents, so
its size is bounded whatever the benchmark; a document's windows stay in the task that reads it.

Defined results: null and empty texts match nothing, nor do items without words; repeated document rows give repeated
rows, equal items one row each; null ids stay null; an empty table on either side gives an empty result; columns other
than ids and texts are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm import bytesops
from riskloom.llm.exprs import fresh, quoted

WINDOW = 8
RUN = 13
BLOCK_WINDOWS = 1_000_000

UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb lbs oz ml l s sec min h hr hrs ms kb mb gb w kw v a hz mph kmh km/h "
    "meter meters metre metres mile miles gram grams kilogram kilograms liter liters litre litres second seconds "
    "minute minutes hour hours day days week weeks month months year years degree degrees percent dollar dollars "
    "euro euros cent cents pound pounds inch inches foot feet"
).split()

NUMBER, QUANTITY, NAME = (np.uint64(x) for x in (11, 22, 44))

_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_LOWER = np.frombuffer(bytesops.LOWER, np.uint8)
_STOP = np.zeros(256, bool)
_STOP[[33, 46, 58, 63, 10]] = True


@dataclass
class Templates:
    """The words of a run of texts, and their template words, which may stand for several words."""

    literal: np.ndarray  # hashes of the case-folded words without outer punctuation
    first: np.ndarray  # first[i]:first[i + 1] are the words of text i
    opening: np.ndarray  # whether a word has a capital only because it opens a sentence
    token: np.ndarray  # the template word of each word
    hashes: np.ndarray  # of template words
    slot: np.ndarray  # whether a template word is a placeholder
    said: np.ndarray  # a hash of what stands there
    head: np.ndarray  # its first word
    size: np.ndarray  # its words
    tokens: np.ndarray  # tokens[i]:tokens[i + 1] are the template words of text i


def _upper_pairs() -> np.ndarray:
    """Whether two bytes are a capital letter in UTF-8."""
    out = np.zeros((256, 256), bool)
    for c in range(0x80, 0x800):
        if chr(c).isupper():
            out[tuple(chr(c).encode())] = True
    return out


_UPPER = _upper_pairs()


def _unit_hashes() -> np.ndarray:
    data, offsets = bytesops.joined([u.encode() for u in UNITS])
    return np.sort(bytesops.segment_hashes(data, offsets[:-1], offsets[1:] - 1))


def _bare(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the words without outer punctuation; a word of nothing else has no length."""
    inner = _LETTER[data] | _DIGIT[data]
    place = np.arange(len(data))
    after = np.minimum.accumulate(np.where(inner, place, len(data))[::-1])[::-1]  # next letter or digit
    before = np.maximum.accumulate(np.where(inner, place, -1))  # the last one
    return after[starts], before[ends - 1] + 1


def _folded(text: bytes | None) -> bytes | None:
    if text is None or text.isascii():
        return text
    return text.decode("utf-8", "surrogateescape").casefold().encode("utf-8", "surrogateescape")


def _literal(texts: list[bytes | None]) -> np.ndarray:
    """Hashes of the case-folded words; folding neither makes nor takes words."""
    data, _ = bytesops.joined([_folded(t) for t in texts])
    s, e = _bare(data, *bytesops.words_of(data))
    return bytesops.segment_hashes(data, s[s < e], e[s < e])


def _capital(data: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Whether the words that begin at ``s`` begin with a capital of any script."""
    head, second = data[s], data[np.minimum(s + 1, len(data) - 1)]
    out = ((head >= 65) & (head <= 90)) | _UPPER[head, second]
    for i in np.flatnonzero(head >= 0xE0).tolist():
        out[i] = data[s[i] : s[i] + 4].tobytes().decode("utf-8", "ignore")[:1].isupper()
    return out


def templates(texts: list[bytes | None], inside: bool = False) -> Templates:
    """``inside`` reads the first word of each text as one inside a sentence."""
    data, offsets = bytesops.joined(texts, None)
    starts, whole_ends = bytesops.words_of(data)
    s, e = _bare(data, starts, whole_ends)
    kept = s < e
    opens = np.ones(len(starts), bool)  # a sentence begins with the word
    opens[1:] = _STOP[data[whole_ends[:-1] - 1]]
    opens |= (starts == 0) | (data[starts - 1] == 10)
    if not inside:
        opens |= data[starts - 1] == 0
    else:
        opens[starts == 0] = False
        opens[1:] &= data[starts[1:] - 1] != 0
    s, e, opens, whole = s[kept], e[kept], opens[kept], whole_ends[kept]
    first = np.searchsorted(s, offsets)
    n = len(s)
    digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
    letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
    has_digit, has_letter = digits[e] > digits[s], letters[e] > letters[s]
    hashes = bytesops.segment_hashes(_LOWER[data], s, e)
    literal = hashes.copy() if all(t is None or t.isascii() for t in texts) else _literal(texts)
    number = has_digit & ~has_letter
    quantity = _DIGIT[data[s]] & has_letter
    capital = _capital(data, s)
    name = capital & ~opens & ~quantity
    new = np.ones(n, bool)  # a word that begins a template word
    if n:
        units = _unit_hashes()
        at = np.minimum(np.searchsorted(units, hashes), len(units) - 1)
        unit = units[at] == hashes
        own = np.zeros(n, bool)  # the same text as the word before, with nothing but white space between
        own[1:] = whole[:-1] == e[:-1]
        own[first[:-1][first[:-1] < n]] = False
        same = own.copy()
        same[1:] &= (name[1:] & name[:-1]) | (unit[1:] & number[:-1])
        new = ~same
    head = np.flatnonzero(new)
    token = np.cumsum(new) - 1
    size = np.diff(np.append(head, n))
    for kind, where in ((NUMBER, number), (QUANTITY, quantity), (NAME, name)):
        hashes[where] = kind
    folded = hashes[head]
    folded[(size > 1) & number[head]] = QUANTITY
    place = np.arange(n) - head[token] if n else np.zeros(0, np.int64)
    said = np.bitwise_xor.reduceat(bytesops.mix(literal + place.astype(np.uint64)), head) if n else literal
    return Templates(
        literal,
        first,
        capital & opens & ~quantity & ~number,
        token,
        folded,
        (number | quantity | name)[head],
        said,
        head,
        size,
        np.append(token, len(head))[first],
    )


def windows(t: Templates, n: int, literal: bool) -> tuple[np.ndarray, np.ndarray]:
    """(first place, hash) of the n-word windows inside one text: all of them by their literal words, or those of
    template words with at least half of them literal."""
    bounds = t.first if literal else t.tokens
    grams = bytesops.ngram_hashes(t.literal if literal else t.hashes, n)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    m = len(grams)
    good = owner[:m] == owner[n - 1 : n - 1 + m]
    if not literal:
        slots = np.concatenate([[0], np.cumsum(t.slot)])
        good &= 2 * (slots[n : n + m] - slots[:m]) <= n
    at = np.flatnonzero(good)
    return at, grams[at]


@dataclass
class Items:
    """A block of benchmark items, some read twice, their windows sorted by size and hash."""

    texts: Templates
    ids: list
    number: np.ndarray  # which item each text is
    inside: np.ndarray  # whether it is read as inside a sentence
    by_size: dict[tuple[int, bool], tuple[np.ndarray, np.ndarray]]  # (words, literal): hashes in order, first places


def read_items(rows: list[tuple]) -> Items:
    """``rows`` are (id, text as bytes)."""
    plain = templates([text for _, text in rows])
    heads = plain.first[:-1]
    again = np.flatnonzero((np.diff(plain.first) > 0) & np.append(plain.opening, False)[heads])
    number = np.concatenate([np.arange(len(rows)), again]).astype(np.int64)
    inside = np.arange(len(number)) >= len(rows)
    t = _chained(plain, templates([rows[i][1] for i in again], True))
    by_size = {}
    for literal in (False, True):
        count = np.diff(t.first if literal else t.tokens)
        for n in sorted({min(WINDOW, int(c)) for c in count if c}):
            at, h = windows(t, n, literal)
            text = np.searchsorted(t.first if literal else t.tokens, at, "right") - 1
            own = np.minimum(count[text], WINDOW) == n
            if literal:
                own &= ~inside[text]
            order = np.argsort(h[own], kind="stable")
            by_size[n, literal] = (h[own][order], at[own][order])
    return Items(t, [i for i, _ in rows], number, inside, by_size)


def _chained(a: Templates, b: Templates) -> Templates:
    """The texts of ``a``, then those of ``b``."""
    words, tokens = len(a.literal), len(a.hashes)
    shift = {"first": words, "head": words, "token": tokens, "tokens": tokens}
    parts = {}
    for f in fields(Templates):
        x, y = getattr(a, f.name), getattr(b, f.name) + shift.get(f.name, 0) if f.name in shift else getattr(b, f.name)
        parts[f.name] = np.concatenate([x[:-1], y]) if f.name in ("first", "tokens") else np.concatenate([x, y])
    return Templates(**parts)


def _agreeing(covered: list[int], slots: dict[int, tuple], weight: dict[int, int]) -> list[int]:
    """Of the covered template words the heaviest run in which no slot value of the item meets two of the document."""
    best, most, lo, now = (0, 0), 0, 0, 0
    met: dict = {}  # value of the item -> [value of the document, times in the run]
    for hi, k in enumerate(covered):
        if k in slots:
            a, b = slots[k]
            while a in met and met[a][0] != b:
                if covered[lo] in slots:
                    gone = slots[covered[lo]][0]
                    met[gone][1] -= 1
                    if not met[gone][1]:
                        del met[gone]
                now -= weight[covered[lo]]
                lo += 1
            met.setdefault(a, [b, 0])[1] += 1
        now += weight[k]
        if now > most:
            best, most = (lo, hi + 1), now
    return covered[slice(*best)]


def matches(texts: list[bytes | None], items: Items) -> Iterator[tuple]:
    """(text number, item id, words covered, words of the item, slots, changed slots) of each item in a text."""
    t, known_texts = templates(texts), items.texts
    typed: dict[tuple, set] = defaultdict(set)  # (text, item text, places between their template words) -> covered ones
    verbatim: dict[tuple, set] = defaultdict(set)  # the same of words
    for (n, literal), (known, where) in items.by_size.items():
        at, h = windows(t, n, literal)
        table = np.zeros(1 << 16, bool)
        table[(known >> np.uint64(48)).astype(np.int64)] = True
        maybe = table[(h >> np.uint64(48)).astype(np.int64)]
        at, h = at[maybe], h[maybe]
        lo, hi = np.searchsorted(known, h, "left"), np.searchsorted(known, h, "right")
        own, theirs = (t.first, known_texts.first) if literal else (t.tokens, known_texts.tokens)
        for place, a, b in zip(at[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
            text = int(np.searchsorted(own, place, "right")) - 1
            for k in where[a:b].tolist():
                item = int(np.searchsorted(theirs, k, "right")) - 1
                if literal:
                    verbatim[text, item, place - k].update(range(k, k + n))
                elif items.inside[item] and k == known_texts.tokens[item] and t.said[place] != known_texts.said[k]:
                    continue  # another word than the item's first one
                else:
                    typed[text, item, place - k].update(range(k, k + n))
    for (text, item, shift), words in verbatim.items():  # what is covered word by word counts for template words, too
        for k in words:
            j = int(known_texts.token[k])
            same = known_texts.head[j] == k and all(x in words for x in range(k, k + int(known_texts.size[j])))
            i = int(t.token[k + shift])
            if same and t.head[i] == k + shift and t.size[i] == known_texts.size[j] and (text, item, i - j) in typed:
                typed[text, item, i - j].add(j)
    best: dict[tuple, tuple] = {}

    def found(text: int, item: int, words: int, slots: int, changed: int) -> None:
        size = int(known_texts.first[item + 1] - known_texts.first[item])
        key = (text, int(items.number[item]))
        if words >= min(RUN, size) and (key not in best or (words, -changed) > (best[key][0], -best[key][3])):
            best[key] = (words, size, slots, changed)

    for (text, item, shift), places in typed.items():
        covered = sorted(places)
        weight = {k: int(known_texts.size[k]) for k in covered}
        slots = {
            k: (int(known_texts.said[k]), int(t.said[k + shift]))
            for k in covered
            if known_texts.slot[k] and t.slot[k + shift]
        }
        run = _agreeing(covered, slots, weight)
        pairs = [slots[k] for k in run if k in slots]
        found(text, item, sum(weight[k] for k in run), len(pairs), sum(a != b for a, b in set(pairs)))
    for (text, item, _), words in verbatim.items():
        inner = {int(known_texts.token[k]) for k in words}
        found(text, item, len(words), sum(bool(known_texts.slot[k]) for k in inner), 0)
    for (text, number), row in sorted(best.items()):
        yield (text, items.ids[number], *row)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, words_covered, item_words, slots, changed_slots, reparameterised), a row per item in a text."""
    spark = docs.sparkSession
    source = docs.select(quoted(id_col).cast("bigint").alias("doc_id"), quoted(text_col).cast("string").alias("text"))
    asked = benchmark.select(
        F.col(item_col).cast("bigint").alias("item_id"), F.col(item_text_col).cast("string").alias("text")
    ).filter(F.col("text").isNotNull())
    # (length + 1) / 2 words at most, three windows each
    weight = asked.agg(F.coalesce(F.sum(2 * F.length("text") + 2), F.lit(0))).first()[0]
    parts = max(1, int(-(-weight // BLOCK_WINDOWS)))
    out = None
    for part in range(parts):
        rows = asked.filter(F.pmod(F.xxhash64("text"), F.lit(parts)) == part).orderBy("item_id", "text").collect()
        items = spark.sparkContext.broadcast(read_items([(r["item_id"], r["text"].encode()) for r in rows]))
        found = source.mapInArrow(_finder(items), _FOUND)
        out = found if out is None else out.unionByName(found)
    return out.withColumn("reparameterised", F.col("changed_slots") > 0)


_FOUND = "doc_id bigint, item_id bigint, words_covered int, item_words int, slots int, changed_slots int"


def _finder(items):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in bytesops.blocks(batch, "text"):
                ids = batch.column("doc_id").slice(at, len(texts))
                rows = [(ids[r[0]].as_py(), *r[1:]) for r in matches(texts, items.value)]
                if rows:
                    kinds = [pa.int64(), pa.int64()] + [pa.int32()] * 4
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                        names=["doc_id", "item_id", "words_covered", "item_words", "slots", "changed_slots"],
                    )

    return find


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **columns) -> DataFrame:
    """The rows whose text holds no benchmark item, all columns as they were.

    A row is known again by a hash of id and text, so rows that share an id are judged each for itself.
    """
    own, other = fresh(docs, "__own", "__other")
    marked = docs.withColumn(own, F.xxhash64(quoted(id_col).cast("string"), quoted(text_col).cast("string")))
    found = contaminated(marked.select(own, quoted(text_col).alias("said")), benchmark, own, "said", **columns)
    bad = found.select(F.col("doc_id").alias(other)).distinct()
    return marked.join(bad, F.col(own) == F.col(other), "left_anti").drop(own)
