"""Exact deduplication by skew-safe combining.

Rows are combined three times, each time on digest *and* full content:

1. locally, inside the task that read them (the map-side half of step 2);
2. among the rows of one digest that drew the same salt, so that a text which a third of all rows
   share is merged by `salts` tasks and not by one;
3. among the salt winners of one digest: at most `salts` rows a text, however often it occurs.

The verdict goes back to the documents by (digest, salt), so that join is as even as step 2.  It
needs no text as long as no two contents share a digest; step 3 sees all contents and would tell.
If two do, the join compares the content too.

Defined results: a null text counts as empty; all empty texts are one group.  Ties in length go to
the smallest id, a null id comes last.  Rows with the same id and text are the same document given
twice: both count in the group's size and both carry its verdict.  An empty table gives no rows.
Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, doc_id, materialize, salt_mask, salt_of, salts_in

#: The characters that do not count when texts are compared.
SPACE = "\t\n\x0b\x0c\r "


def normalised(text: Column) -> Column:
    """`text` without white space; null is empty."""
    out = F.coalesce(text, F.lit(""))
    for ch in SPACE:
        out = F.replace(out, F.lit(ch), F.lit(""))
    return out


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _step() -> Column:
    """Wider than the distance of any two ids."""
    return F.lit(str(2**65)).cast("decimal(20,0)")


def _rank(n_points: Column, key: Column) -> Column:
    """One number that is larger for longer texts and then for smaller ids: fixed width, so it aggregates by hash."""
    behind = F.lit(NULL_ID).cast("decimal(20,0)") - F.coalesce(key, F.lit(NULL_ID)).cast("decimal(20,0)")
    return (n_points.cast("decimal(10,0)") * _step() + behind).cast("decimal(38,0)")


def _id_of(rank: Column) -> Column:
    return (F.lit(NULL_ID).cast("decimal(20,0)") - F.pmod(rank, _step())).cast("long")


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = 32,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per row of `docs`: ``doc_id, keep_id, group_size, kept, digest``.

    The longest original text of a group of equal texts stays, then the smallest id.  `salts` may be
    1 to 63.  `digest` may collide; results are the same.
    """
    norm = normalised(F.col(text_col))
    base = docs.select(
        doc_id(id_col).alias("doc_id"),
        norm.alias("norm"),
        digest(norm).alias("digest"),
        salt_of(doc_id(id_col), salts).alias("salt"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("n_points"),
    )
    by_salt = base.groupBy("digest", "salt", "norm").agg(F.max(_rank(F.col("n_points"), F.col("doc_id"))).alias("best"), F.count(F.lit(1)).alias("n"))
    whole = by_salt.groupBy("digest", "norm").agg(F.max("best").alias("best"), F.sum("n").alias("group_size"), F.bit_or(salt_mask(F.col("salt"))).alias("mask"))
    winners = whole.select("digest", "norm", _id_of(F.col("best")).alias("keep_id"), "group_size", F.explode(salts_in(F.col("mask"), salts)).alias("salt"))
    classes = materialize(winners.drop("norm"), "exact-classes")
    keys = ["digest", "salt"]
    rows = base.drop("norm", "n_points")
    if not classes.groupBy(keys).count().filter("count > 1").isEmpty():  # two contents with one digest
        classes, rows, keys = winners, base.drop("n_points"), ["digest", "salt", "norm"]
    same = F.coalesce(F.col("doc_id"), F.lit(NULL_ID)) == F.col("keep_id")
    return rows.join(classes, keys).select("doc_id", F.nullif(F.col("keep_id"), F.lit(NULL_ID)).alias("keep_id"), "group_size", same.alias("kept"), "digest")
