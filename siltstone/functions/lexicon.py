"""Keyword lists: does a text contain one?

Matching ignores case: text and keywords are compared in lower case, whatever the length of the list.  A keyword must not touch a letter, digit or underscore of ASCII on a side where it has
such a character itself; so ASCII keywords match whole words, and CJK keywords match anywhere.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_")

#: Longer lists are matched by an automaton in Python, shorter ones by a Java pattern.
NATIVE = 500


def keywords(raw: Iterable[str], least: int = 1) -> list[str]:
    """Distinct keywords of at least `least` characters without the white space around them."""
    return sorted({w for w in raw if len(w.strip()) >= least})


def _side(ch: str, look: str) -> str:
    return look if ch in _WORD else ""


def as_pattern(words: Iterable[str]) -> str:
    """A pattern for lower-case text."""
    one = [_side(w[0], "(?<![A-Za-z0-9_])") + re.sub(r"([\\.\[\]{}()*+?^$|&~#-])", r"\\\1", w) + _side(w[-1], "(?![A-Za-z0-9_])") for w in (w.lower() for w in words)]
    return "(?:" + "|".join(sorted(one, key=len, reverse=True)) + ")"


class Matcher:
    """An automaton over many keywords."""

    def __init__(self, words: Iterable[str]) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for w in words:
            self.automaton.add_word(w.lower(), len(w.lower()))
        self.automaton.make_automaton()

    def first(self, s: str) -> str | None:
        """The match that begins first, the longest of those, in lower case; None if there is none."""
        s, best = s.lower(), None
        for end, n in self.automaton.iter(s):
            a, b = end - n + 1, end + 1
            left = a == 0 or s[a] not in _WORD or s[a - 1] not in _WORD
            right = b == len(s) or s[b - 1] not in _WORD or s[b] not in _WORD
            if left and right and (best is None or (a, -n) < (best[0], -best[1])):
                best = (a, n)
        return s[best[0] : best[0] + best[1]] if best else None


def has_keyword(words: list[str]) -> Callable[[Column], Column]:
    """A column function: true if the text contains a keyword that is not blank.  Null gives false."""
    words = [w for w in words if w.strip()]
    if not words:
        return lambda c: F.lit(False)
    if len(words) <= NATIVE:
        pattern = as_pattern(words)
        return lambda c: F.coalesce(F.lower(c).rlike(pattern), F.lit(False))

    @F.pandas_udf("boolean")
    def match(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = Matcher(words)  # once a task
        for texts in batches:
            yield texts.map(lambda t: isinstance(t, str) and m.first(t) is not None).astype(bool)

    return lambda c: match(F.lower(c))
