"""Collapsing consecutive repeats: three or more copies of one pattern in a row leave one.

The same result as replacing ``(.+?)\\1\\1+`` by ``\\1``, without its quadratic cost.  Many texts are looked at
together, as one array in which every line end is a value of its own, so that no pattern goes beyond a line.
Periods below 8 are tried one by one.  Three copies of a longer pattern have two equal 16-grams, and few lines
have any; in those, a longer period p needs many pairs of equal 8-grams at distance p, so counting the distances
leaves few periods to try.  Only lines that are full of equal 8-grams go another way: blocks of p characters that
begin at multiples of p are compared with the next by their hashes, n log n comparisons in all.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_BASE, _MOD = 911382323, (1 << 31) - 1
_GRAM = 8


#: By period, where x[i] == x[i + p] holds: from a (included) to b.  Only as long as at least three copies need.
Runs = dict[int, tuple[np.ndarray, np.ndarray]]


def _at_period(x: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], (x[:-p] == x[p:]).astype(np.int8), [0]]))
    a, b = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
    ok = b - a >= 2 * p
    return a[ok], b[ok]


def _covered(lo: np.ndarray, hi: np.ndarray, q: int, runs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Which places lo..hi lie in a run of period q."""
    a, b = runs
    k = np.searchsorted(a, lo, side="right") - 1
    return (k >= 0) & (b[k] + q >= hi) if len(a) else np.zeros(len(lo), bool)


def _by_blocks(x: np.ndarray, known: Runs) -> Runs:
    """The runs of periods from 8 on at which some block equals the next.

    Blocks inside a run of a known period that divides theirs tell nothing new: the shorter pattern always goes first.
    """
    n = len(x)
    power, prefix, h, w = [1], [0], 0, 1
    for c in x.tolist():
        h, w = (h * _BASE + c + 1) % _MOD, w * _BASE % _MOD
        prefix.append(h)
        power.append(w)
    pre = np.array(prefix, np.int64)
    known, out, parts = dict(known), {}, defaultdict(list)
    for q in known:
        for m in range(2 * q, n // 3 + 1, q):
            parts[m].append(q)
    for p in range(_GRAM, n // 3 + 1):
        cut = pre[::p]
        # the hash of block k is prefix[(k + 1) p] - prefix[k p] * base^p
        block = (cut[1:] - cut[:-1] * power[p]) % _MOD
        lo = np.nonzero(block[1:] == block[:-1])[0] * p
        for q in parts[p] if len(lo) else ():
            lo = lo[~_covered(lo, lo + 2 * p, q, known[q])]
        if len(lo) and len((runs := _at_period(x, p))[0]):
            known[p] = out[p] = runs
            for m in range(2 * p, n // 3 + 1, p):
                parts[m].append(p)
        parts.pop(p, None)
    return out


def _long_runs(x: np.ndarray, known: Runs) -> Runs:
    """The runs of periods from 8 on that are not inside those of the shorter ones in `known`."""
    n = len(x)
    gram = np.zeros(n - _GRAM + 1, np.uint64)
    for i in range(_GRAM):
        gram = gram * np.uint64(_BASE) + x[i : n - _GRAM + 1 + i]
    order = np.argsort(gram, kind="stable")
    own = gram[order]
    first = np.concatenate([[True], own[1:] != own[:-1]])
    size = np.diff(np.append(np.nonzero(first)[0], len(own)))
    if (size * (size - 1) // 2).sum() > 20 * n:
        return _by_blocks(x, known)
    count = np.zeros(n, np.int64)
    step = 1
    rank = np.arange(len(own)) - np.repeat(np.nonzero(first)[0], size)
    while (later := np.nonzero(rank >= step)[0]).size:
        np.add.at(count, order[later] - order[later - step], 1)
        step += 1
    p = np.arange(n)
    return {q: _at_period(x, q) for q in np.nonzero((count >= 2 * p - _GRAM + 1) & (p >= _GRAM) & (3 * p <= n))[0].tolist()}


def _lines_with_long_repeats(x: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where the lines begin and end (at `ends`) that have two equal grams of 2 x 8 characters."""
    n, size = len(x), 2 * _GRAM
    if n < size:
        return
    gram, width = x.astype(np.uint64) + np.uint64(1), 1
    while width < size:
        gram = gram[:-width] * np.uint64(pow(_BASE, width, 1 << 64)) + gram[width:]
        width *= 2
    line = np.searchsorted(ends, np.arange(len(gram)))
    whole = np.arange(len(gram)) + size <= ends[line]
    gram, line = gram[whole] ^ line[whole].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), line[whole]
    order = np.argsort(gram, kind="stable")
    for k in np.unique(line[order[1:][gram[order[1:]] == gram[order[:-1]]]]).tolist():
        yield int(ends[k - 1]) + 1 if k else 0, int(ends[k])


def _runs(x: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int]]:
    """(a, p, b): x[i] == x[i + p] for a <= i < b, and b - a >= 2 p; as long as possible."""
    short = {p: _at_period(x, p) for p in range(1, min(_GRAM - 1, len(x) // 3) + 1)}
    found = [(0, short)]
    for lo, hi in _lines_with_long_repeats(x, ends):
        if hi - lo >= 3 * _GRAM:
            cuts = {p: np.searchsorted(a, [lo, hi]) for p, (a, _) in short.items()}
            found.append((lo, _long_runs(x[lo:hi], {p: (short[p][0][i:j] - lo, short[p][1][i:j] - lo) for p, (i, j) in cuts.items()})))
    return [(a + lo, p, b + lo) for lo, runs in found for p, ab in runs.items() for a, b in zip(*(v.tolist() for v in ab))]


def _cuts(runs: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """What goes: at each leftmost start the shortest pattern is taken, and of its copies the first stays."""
    heapq.heapify(runs)
    out, at = [], 0
    while runs:
        a, p, b = runs[0]
        if max(a, at) > b - 2 * p:
            heapq.heappop(runs)
        elif a < at:
            heapq.heapreplace(runs, (at, p, b))
        else:
            heapq.heappop(runs)
            at = a + ((b - a) // p + 1) * p
            out.append((a + p, at))
    return out


def collapse_texts(texts: list[str]) -> list[str]:
    """Each text without its consecutive repeats."""
    whole = "\n".join(texts)
    x = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.nonzero(x == 10)[0]
    x = x.copy()
    x[ends] = 0x110000 + np.arange(len(ends))  # no character
    cuts = _cuts(_runs(x, np.append(ends, len(x))))
    out, k, begin = [], 0, 0
    for t in texts:
        parts, at, end = [], begin, begin + len(t)
        while k < len(cuts) and cuts[k][0] < end:
            parts.append(whole[at : cuts[k][0]])
            at = cuts[k][1]
            k += 1
        out.append("".join(parts) + whole[at:end] if parts else t)
        begin = end + 1
    return out


def collapse_line(s: str) -> str:
    return collapse_texts([s])[0]


#: Characters that are looked at together (one longer text is looked at alone).
_TOGETHER = 1_000_000


@F.pandas_udf(StringType())
def collapse_repeats(texts: pd.Series) -> pd.Series:
    """Line by line, since a pattern never holds a line feed.  Null stays null."""
    out: list[str | None] = [t if isinstance(t, str) else None for t in texts]
    held: list[int] = []
    size = 0
    for i, t in enumerate(out):
        if t:
            held.append(i)
            size += len(t)
        if held and (size >= _TOGETHER or i == len(out) - 1):
            for k, done in zip(held, collapse_texts([out[k] for k in held])):
                out[k] = done
            held, size = [], 0
    return pd.Series(out, dtype=object)
