"""Corpus statistics: aggregates that are combined before they are shuffled."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scoring import PADDING, UNKNOWN
from ..functions.text import ngrams


def document_frequency(texts: DataFrame, text: str = "text", n: int = 3, more_than: int = 1000) -> DataFrame:
    """``trigram, n_texts``: n-grams that occur in more than `more_than` texts."""
    own = texts.select(F.explode(F.array_distinct(ngrams(F.col(text), n))).alias("trigram"))
    return own.groupBy("trigram").agg(F.count(F.lit(1)).alias("n_texts")).filter(F.col("n_texts") > more_than)


def _char_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each batch's characters with their counts, and the first text (by number) and place where they stand."""
    for rows in batches:
        rows = rows.sort_values("at", kind="stable")
        points = np.frombuffer("".join(rows["t"]).encode("utf-32-le", "surrogatepass"), np.uint32)
        char, first, n = np.unique(points, return_index=True, return_counts=True)
        begin = np.cumsum([0, *rows["t"].str.len()])
        text = np.searchsorted(begin, first, side="right") - 1
        yield pd.DataFrame({"char": [chr(c) for c in char], "n": n, "at": rows["at"].to_numpy()[text], "place": first - begin[text]})


def char_vocabulary(texts: DataFrame, text: str = "text", order: str | None = None, least: int = 1, most: int = 10_000) -> DataFrame:
    """``char, id``: the `most` frequent characters, then the unknown and the padding mark.

    Ties go to the character seen first by `order` (a unique number of the text), or to the smaller character.
    The numbering window runs over at most `most` rows.
    """
    own = texts.select(F.split(F.trim(text), "\t")[0].alias("t"), (F.col(order).cast("long") if order else F.lit(0).cast("long")).alias("at")).filter("t <> ''")
    each = own.mapInPandas(_char_counts, "char string, n long, at long, place long")
    seen = F.min(F.struct("at", "place")) if order else F.min("char")
    top = each.groupBy("char").agg(F.sum("n").alias("n"), seen.alias("seen")).filter(F.col("n") >= least).orderBy(F.desc("n"), "seen").limit(most)
    ranked = top.select("char", (F.row_number().over(W.orderBy(F.desc("n"), "seen")) - 1).alias("id"))
    marks = ranked.agg(F.count(F.lit(1)).cast("int").alias("n")).select(F.explode(F.array(F.struct(F.lit(UNKNOWN).alias("char"), F.col("n").alias("id")), F.struct(F.lit(PADDING).alias("char"), (F.col("n") + 1).alias("id")))).alias("x")).select("x.*")
    return ranked.unionByName(marks)


def rows_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))


def line_counts(before: DataFrame, cont: str, kept: Column) -> DataFrame:
    """Documents and lines before and after; `kept` is the array of lines that stay."""
    stays = F.size(kept) > 0
    return before.agg(
        F.count(F.lit(1)).alias("docs_before"),
        F.count_if(stays).alias("docs_after"),
        F.coalesce(F.sum(F.size(cont)), F.lit(0)).alias("lines_before"),
        F.coalesce(F.sum(F.when(stays, F.size(kept)).otherwise(0)), F.lit(0)).alias("lines_after"),
    )


#: One line of a statistics log: ratio, dialogues of two, others.
LOG_LINE = r"([0-9.]+)[^0-9]+([0-9]+)[^0-9]+([0-9]+)\s*$"


def mine_logs(logs: DataFrame, line: str = "value") -> DataFrame:
    """Means and sums over the statistics lines of many logs."""
    part = lambda i, kind: F.regexp_extract(line, LOG_LINE, i).cast(kind)
    rows = logs.filter(F.col(line).rlike(LOG_LINE)).select(part(1, "double").alias("ratio"), part(2, "long").alias("two"), part(3, "long").alias("multi"))
    return rows.agg(F.avg("ratio").alias("mean_ratio"), F.sum(F.col("ratio") * F.col("two")).alias("suitable"), F.sum("two").alias("two"), F.sum("multi").alias("multi"))
