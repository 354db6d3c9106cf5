"""Script conversion by a phrase table, such as traditional to simplified characters.

A text is cut into keys of the table and single characters so that there are as few pieces as possible; where
two cuts have equally many, the one with the shorter first piece is taken.  Each key is then replaced.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


class Converter:
    def __init__(self, table: dict[str, str]) -> None:
        self.table = {k: v for k, v in table.items() if k}
        lengths: dict[str, set[int]] = {}
        for k in self.table:
            lengths.setdefault(k[0], set()).add(len(k))
        self.lengths = {c: sorted(n | {1}) for c, n in lengths.items()}

    def convert(self, s: str) -> str:
        if not any(c in self.lengths for c in s):
            return s
        n = len(s)
        pieces, step = [0] * (n + 1), [1] * n
        for i in range(n - 1, -1, -1):
            best, size = pieces[i + 1] + 1, 1
            for k in self.lengths.get(s[i], ()):
                if 1 < k <= n - i and s[i : i + k] in self.table and pieces[i + k] + 1 < best:
                    best, size = pieces[i + k] + 1, k
            pieces[i], step[i] = best, size
        out, i = [], 0
        while i < n:
            key = s[i : i + step[i]]
            out.append(self.table.get(key, key))
            i += step[i]
        return "".join(out)


def read_table(df: DataFrame, variant: str) -> dict[str, str]:
    """The table of one variant from rows ``variant, from, to``; of rows with one key the last by ``to`` wins.  Tables have thousands of rows."""
    return {r["from"]: r["to"] for r in df.filter(F.col("variant") == variant).orderBy("from", "to").collect()}


def converter(table: dict[str, str]) -> Callable[[Column], Column]:
    """A column function for any table."""
    own = Converter(table)

    @F.pandas_udf(StringType())
    def convert(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: own.convert(t) if isinstance(t, str) else None)

    return convert


def native_converter(table: dict[str, str]) -> Callable[[Column], Column]:
    """A column function without Python, for tables whose longer keys are few or agree with their characters.

    Characters are translated one by one.  A longer key that would come out differently is hidden behind a
    private character first.
    """
    single = {k: v for k, v in table.items() if len(k) == 1 and k != v}
    if any(len(v) != 1 for v in single.values()):
        raise ValueError("single characters must become single characters")
    odd = {k: v for k, v in table.items() if len(k) > 1 and v != "".join(single.get(c, c) for c in k)}
    if len(odd) > 200:
        raise ValueError("too many phrases; use converter()")
    marks = {k: chr(0xF0000 + i) for i, k in enumerate(sorted(odd, key=lambda k: (-len(k), k)))}

    def convert(c: Column) -> Column:
        for k, mark in marks.items():
            c = F.replace(c, F.lit(k), F.lit(mark))
        c = F.translate(c, "".join(single), "".join(single.values())) if single else c
        for k, mark in marks.items():
            c = F.replace(c, F.lit(mark), F.lit(odd[k]))
        return c

    return convert
