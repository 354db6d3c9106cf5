"""First-wins deduplication.

The survivor of a group is its first row by an order column, so results do not depend on partitioning.  The key
is a fixed-width digest, and the winner of each group is found by an ordinary aggregate that is combined before
the shuffle: a key that very many rows share is one row from each task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import text_hash


def first_wins(df: DataFrame, key: Column, order: str, within: str | None = "file") -> DataFrame:
    """The rows of `df` whose key no earlier row (by `order`) of the same `within` has.  `order` is unique inside it."""
    parts = [within] if within else []
    keyed = df.withColumn("_key", key)
    winners = keyed.groupBy(*parts, "_key").agg(F.min(order).alias("_first")).select(*[F.col(c).alias(f"_{c}") for c in parts], "_first")
    on = df[order] == winners["_first"]
    for c in parts:
        on = on & df[c].eqNullSafe(winners[f"_{c}"])
    return df.join(winners, on, "left_semi")


def first_rows(df: DataFrame, key: str, order: str, keep: list[str], within: str | None = "file") -> DataFrame:
    """As first_wins for narrow rows: the columns `keep` of each group's first row, in one pass over `df`."""
    parts = [within] if within else []
    rows = df.groupBy(*parts, key).agg(F.min_by(F.struct(*keep), order).alias("_row"))
    return rows.select(*parts, key, "_row.*")


def hash_key(texts: Column) -> Column:
    """Of an array of utterances: the hash of all, joined by blanks."""
    return text_hash(F.array_join(texts, " "))


def charset_key(cont: Column) -> Column:
    """Of an array of lines: the sorted set of their characters."""
    return F.array_join(F.array_sort(F.array_distinct(F.filter(F.split(F.array_join(cont, ""), ""), lambda c: c != ""))), "")


def exact_dedup(df: DataFrame, texts: str = "texts", order: str = "seq", within: str | None = "file") -> DataFrame:
    return first_wins(df, hash_key(F.col(texts)), order, within)


def charset_dedup(df: DataFrame, cont: str = "cont", order: str = "line_no", within: str | None = "file") -> DataFrame:
    """Documents of one file with the same set of characters count as near-duplicates."""
    return first_wins(df, F.sha2(charset_key(F.col(cont)), 256), order, within)
