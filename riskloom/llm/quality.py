"""Quality rules as a short-circuit cascade, built-in functions only.

A rule is a rejection test on a text.  ``measured`` runs each rule on a bounded sample, timing it and counting what it
rejects; ``ordered`` sorts rules by rejections per second; ``verdict`` chains them in one CASE, so a text pays only for
the rules before the first that rejects it.  The order changes the cost, never the verdict.

Words are runs of characters other than ASCII white space.  Defined results: a null text has no words and fails;
repeated rows are judged alike, each for itself; an empty table gives an empty result and any order of rules; columns
other than the id and the text are neither read nor changed by ``keep``.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.exprs import let, quoted, total, words
from riskloom.session import stage

SAMPLE_ROWS = 500  # texts on which cost and selectivity are measured
SYMBOLS = "[#*$%&|<>]"


def chars_in_words(w: Column) -> Column:
    return F.length(F.array_join(w, "")).cast("bigint")


def symbols(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint")


def word_lines(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def repeated_lines(lines: Column) -> Column:
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint")


PLACE_BITS = 20  # of a packed window: its place; the rest is the head of its hash


def _window(w: Column, i: Column, n: int) -> Column:
    return F.xxhash64(*[F.get(w, i + j) for j in range(n)])


def _found_again(places: Column, w: Column, n: int) -> Column:
    """Those of the places whose window has the same hash as that of another one, in order."""
    return let(
        F.sort_array(F.transform(places, lambda i: F.struct(_window(w, i, n).alias("h"), i.alias("i")))),
        lambda s: F.sort_array(
            F.filter(
                s,
                lambda x, j: F.get(s, j - 1)["h"].eqNullSafe(x["h"]) | F.get(s, j + 1)["h"].eqNullSafe(x["h"]),
            )["i"]
        ),
    )


def _candidates(w: Column, n: int) -> Column:
    """Places of windows that share the head of their hash with another one.

    Sorting packed longs is far cheaper than sorting records of hash and place.
    """
    low = F.lit((1 << PLACE_BITS) - 1).cast("bigint")
    packed = F.transform(
        F.slice(w, F.lit(1), F.size(w) - (n - 1)),
        lambda x, i: F.xxhash64(x, *[F.get(w, i + j) for j in range(1, n)])
        .bitwiseAND(F.lit(-(1 << PLACE_BITS)).cast("bigint"))
        .bitwiseOR(i),
    )
    neighbours = let(
        F.sort_array(packed),
        lambda s: F.zip_with(
            s,
            F.slice(s, F.lit(2), F.size(s)),
            lambda x, y: F.when(
                F.shiftrightunsigned(x.bitwiseXOR(y), PLACE_BITS) == 0,
                F.array(x.bitwiseAND(low).cast("int"), y.bitwiseAND(low).cast("int")),
            ),
        ),
    )
    return F.array_distinct(F.flatten(F.filter(neighbours, lambda p: p.isNotNull())))


def repeated_words(w: Column, n: int = 3) -> Column:
    """Words that lie in an n-word window found at least twice in the text, the first one included."""
    places = F.when(F.size(w) < (1 << PLACE_BITS), _candidates(w, n)).otherwise(
        F.sequence(F.lit(0), F.size(w) - n)  # too long to pack: all places
    )
    covered = let(
        _found_again(places, w, n),
        lambda p: total(
            F.zip_with(
                p,
                F.slice(p, F.lit(2), F.greatest(F.size(p), F.lit(1))),
                lambda x, y: F.least(F.lit(n), F.coalesce(y - x, F.lit(n))).cast("bigint"),
            )
        ),
    )
    return F.when(F.size(w) > n, covered).otherwise(F.lit(0)).cast("bigint")


@dataclass(frozen=True)
class Rule:
    """``rejects(text, words)`` is true for a text that should go; null texts come as empty ones."""

    name: str
    rejects: Callable[[Column, Column], Column]


def too_few_words(n_words: Column, least: int = 50) -> Column:
    return n_words < least


def too_many_repeats(n_repeat: Column, n_words: Column) -> Column:
    return F.lit(100) * n_repeat > F.lit(50) * n_words


def _letters(text: Column, w: Column) -> Column:
    """Letters of the words: what is not a letter is rarer, so that is counted."""
    return chars_in_words(w) - F.regexp_count(text, F.lit(r"[^\p{L}\x20\x09-\x0D]"))


def _line_share(text: Column, pattern: str, tenths: int) -> Column:
    return let(
        word_lines(text),
        lambda lines: F.lit(10) * F.size(F.filter(lines, lambda x: x.rlike(pattern))) > F.lit(tenths) * F.size(lines),
    )


#: The two rules of the base verdict, then the method's own.
BASE = (
    Rule("few_words", lambda t, w: too_few_words(F.size(w))),
    Rule("repeated_words", lambda t, w: too_many_repeats(repeated_words(w), F.size(w))),
)
RULES = (
    Rule("symbols", lambda t, w: F.lit(10) * symbols(t) > F.size(w)),
    Rule(
        "word_length",
        lambda t, w: let(chars_in_words(w), lambda c: (c < F.lit(2) * F.size(w)) | (c > F.lit(15) * F.size(w))),
    ),
    Rule(
        "repeated_lines",
        lambda t, w: let(
            word_lines(t),
            lambda x: let(repeated_lines(x), lambda n: (n >= 3) & (F.lit(10) * n > F.lit(3) * F.size(x))),
        ),
    ),
    Rule("few_letters", lambda t, w: F.lit(10) * _letters(t, w) < F.lit(6) * chars_in_words(w)),
    Rule("capitals", lambda t, w: F.regexp_count(t, F.lit(r"\p{Lu}")) > F.lit(2) * F.size(w)),
    Rule("bullet_lines", lambda t, w: _line_share(t, r"^\s*[-*•‣]", 9)),
    Rule("cut_lines", lambda t, w: _line_share(t, r"(\.\.\.|…)\s*$", 3)),
)


def verdict(text: Column, rules: list[Rule] | tuple[Rule, ...], found_words: Column | None = None) -> Column:
    """The name of the first rule that rejects the text, null if none does; later rules are not evaluated."""
    text = F.coalesce(text, F.lit(""))

    def chain(w: Column) -> Column:
        case = None
        for rule in rules:
            case = (F if case is None else case).when(rule.rejects(text, w), F.lit(rule.name))
        return F.lit(None).cast("string") if case is None else case

    return chain(found_words) if found_words is not None else let(words(text), chain)


def measured(docs: DataFrame, rules, text_col: str = "text", rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, int]]:
    """(rule, seconds, rejected) of each rule on a sample of at most ``rows`` texts.

    The sample decides the order of the rules and nothing else.
    """
    sample = stage(docs.select(quoted(text_col).cast("string").alias("text")).limit(rows), "rule-sample")

    def run(rejected: Column) -> tuple[float, int]:
        times = []
        for _ in range(2):
            began = time.perf_counter()
            n = sample.agg(F.count_if(rejected).alias("n")).first()["n"]
            times.append(time.perf_counter() - began)
        return min(times), n

    least, _ = run(let(words(F.col("text")), lambda w: F.size(w) < 0))
    out = []
    for rule in rules:
        seconds, n = run(F.coalesce(verdict(F.col("text"), [rule]).isNotNull(), F.lit(False)))
        out.append((rule, max(seconds - least, 1e-3), n))
    return out


def ordered(measures: list[tuple[Rule, float, int]]) -> list[Rule]:
    """Most rejections per second first; equal ones by cost, then by name."""
    return [r for r, _, _ in sorted(measures, key=lambda m: (-m[2] / m[1], m[1], m[0].name))]


def facts(docs: DataFrame, rules, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, base verdict and final verdict of every document; ``rules`` come after the base ones."""
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    found = docs.select(quoted(id_col).alias("doc_id"), text.alias("text"), words(text).alias("words"))
    w, t = F.col("words"), F.col("text")
    counted = found.select(
        "doc_id",
        "text",
        "words",
        F.size(w).cast("bigint").alias("n_words"),
        chars_in_words(w).alias("word_chars"),
        symbols(t).alias("n_symbols"),
        let(word_lines(t), repeated_lines).alias("n_dup_lines"),
        repeated_words(w).alias("n_repeat_words"),
    )
    failed = too_few_words(F.col("n_words")) | too_many_repeats(F.col("n_repeat_words"), F.col("n_words"))
    return counted.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        F.when(failed, F.lit(False)).otherwise(verdict(t, rules, w).isNull()).alias("kept"),
    )


def keep(docs: DataFrame, rules=BASE + RULES, text_col: str = "text") -> DataFrame:
    """The rows whose text no rule rejects, all columns as they were."""
    order = ordered(measured(docs, rules, text_col))
    return docs.filter(verdict(quoted(text_col).cast("string"), order).isNull())
