"""Word-level text expressions (whole texts, no regular expressions per word)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F


def tokens(c: Column) -> Column:
    """Lower-case runs of letters, accented ones included."""
    return F.filter(F.split(F.lower(c), r"[^\p{L}]+"), lambda w: w != "")


def _by_length(words: Column, lexicon: Sequence[str]) -> list[tuple[Column, list[str]]]:
    """(runs of n words, the terms of n words) for every length of a term."""
    found: dict[int, list[str]] = {}
    for term in dict.fromkeys(lexicon):
        found.setdefault(len(term.split(" ")), []).append(term)
    return [(words if n == 1 else _runs(words, n), terms) for n, terms in sorted(found.items())]


def _runs(words: Column, n: int) -> Column:
    """Every ``n`` words that follow each other; a shorter run at the end equals no term of ``n`` words."""
    return F.transform(words, lambda w, i: F.array_join(F.slice(words, i + 1, n), " "))


def _among(terms: Sequence[str]) -> Callable[[Column], Column]:
    return lambda w: w.isin(*terms)


def known_terms(words: Column, lexicon: Sequence[str]) -> Column:
    """The terms of the lexicon that occur, with repeats: single words first, then phrases by length.

    A term of several words, parted by single blanks, occurs wherever its words follow each other; occurrences
    may overlap.  More than a few terms are looked up in a set, so the time depends on how many lengths the
    terms have, not on how many there are.
    """
    parts = [F.filter(runs, _among(terms)) for runs, terms in _by_length(words, lexicon)]
    return F.concat(*parts) if parts else F.filter(words, lambda w: F.lit(False))


def word_hits(words: Column, lexicon: Sequence[str]) -> Column:
    """How many occurrences of lexicon terms the tokens hold."""
    return F.size(known_terms(words, lexicon))


def has_any(words: Column, lexicon: Sequence[str]) -> Column:
    """Whether a lexicon term occurs; the search ends at the first one."""
    out = None
    for runs, terms in _by_length(words, lexicon):
        hit = F.exists(runs, _among(terms))
        out = hit if out is None else out | hit
    return F.lit(False) if out is None else out
