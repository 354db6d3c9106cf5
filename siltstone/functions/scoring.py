"""Pluggable scorers: a label and a probability for a text, or a number such as its perplexity.

Models are not part of this package.  A scorer is loaded once in each task and is given whole batches.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN, PADDING = "<UNK>", "<PAD>"


class Scorer(Protocol):
    def predict(self, texts: list[str]) -> list[tuple[int, float]]: ...


def labeller(load: Callable[[], Scorer], longest: int | None = 256) -> Callable[[Column], Column]:
    """A column function from a text to ``struct<label, prob>``; the text is stripped and cut to `longest` characters first."""

    @F.pandas_udf("label int, prob double")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load()
        for texts in batches:
            yield pd.DataFrame(model.predict([(t or "").strip()[:longest] for t in texts]), columns=["label", "prob"])

    return label


def line_labeller(load: Callable[[], Scorer], longest: int | None = 256) -> Callable[[Column], Column]:
    """The same for an array of lines: one call of the model for all lines of a batch."""

    @F.pandas_udf("array<struct<label:int,prob:double>>")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for conts in batches:
            sizes = [0 if c is None else len(c) for c in conts]
            flat = model.predict([(t or "").strip()[:longest] for c in conts if c is not None for t in c])
            at, out = 0, []
            for n in sizes:
                out.append([{"label": a, "prob": b} for a, b in flat[at : at + n]])
                at += n
            yield pd.Series(out)

    return label


def encode_chars(text: str, vocab: dict[str, int], size: int) -> list[int]:
    """Characters as numbers, unknown ones as UNKNOWN, padded or cut to `size`."""
    own = list(text)[:size]
    return [vocab.get(c, vocab[UNKNOWN]) for c in own] + [vocab[PADDING]] * (size - len(own))


def sliding_perplexity(nll: Callable[[list[int], int], float], n_tokens: int, window: int = 1024, stride: int = 512) -> float:
    """Perplexity of a long sequence by overlapping windows: only tokens that the last window did not cover count.

    `nll(range of positions, new)` is the mean negative log likelihood of the last `new` positions of the window.
    """
    total, done = 0.0, 0
    for begin in range(0, n_tokens, stride):
        end = min(begin + window, n_tokens)
        total += nll(list(range(begin, end)), end - done) * (end - done)
        done = end
        if end == n_tokens:
            break
    return math.exp(total / done) if done else float("nan")


class CharTrigrams:
    """A deterministic stand-in for a language model: character trigrams with one added to each count."""

    def __init__(self, texts: list[str]) -> None:
        grams = Counter()
        for t in texts:
            grams.update(self.grams(t))
        self._learn(grams)

    @staticmethod
    def grams(text: str) -> Iterator[str]:
        """The trigrams and bigrams of a text and its start."""
        t = f"\x02\x02{text}"
        yield from (t[i : i + 3] for i in range(len(t) - 2))
        yield from (t[i : i + 2] for i in range(len(t) - 1))

    def _learn(self, grams: dict[str, int]) -> None:
        self.three = Counter({g: n for g, n in grams.items() if len(g) == 3})
        self.two = Counter({g: n for g, n in grams.items() if len(g) == 2})
        self.size = len({g[2] for g in self.three}) + 1  # each character ends a trigram

    @classmethod
    def of_column(cls, df: DataFrame, col: str = "text") -> CharTrigrams:
        """Learnt from all texts of a column (nulls are none).  The driver gets the counts, a row for each distinct n-gram."""

        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            grams = Counter()
            for pdf in batches:
                for t in pdf["text"]:
                    if isinstance(t, str):
                        grams.update(cls.grams(t))
            yield pd.DataFrame({"gram": list(grams), "n": list(grams.values())})

        counts = df.select(F.col(col).alias("text")).mapInPandas(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
        model = cls([])
        model._learn({r["gram"]: r["n"] for r in counts.collect()})
        return model

    def perplexity(self, text: str, window: int = 1024, stride: int = 512) -> float:
        t = f"\x02\x02{text}"

        def nll(places: list[int], new: int) -> float:
            own = places[len(places) - new :]
            return -sum(math.log((self.three[t[i : i + 3]] + 1) / (self.two[t[i : i + 2]] + self.size)) for i in own) / max(1, len(own))

        return sliding_perplexity(nll, len(text), window, stride)


def perplexity(model: CharTrigrams) -> Callable[[Column], Column]:
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: model.perplexity(t) if isinstance(t, str) else None)

    return score


def per_line(load: Callable[[], Callable[[str], str | None]]) -> Callable[[Column], Column]:
    """Any Python function of a line as a column function; rows where it gives None are to be filtered out."""

    @F.pandas_udf("string")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        f = load()
        for texts in batches:
            yield texts.map(lambda t: f(t) if isinstance(t, str) else None)

    return apply
