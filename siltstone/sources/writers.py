"""Writing results: JSON lines or text, a folder for each input file, and nothing for empty results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What follows an input's base name.
SUFFIX = {"formatted": "_format.json", "processed": "_processed.json", "original": "_original.json", "filtered": "_filter", "deduplicated": "_dedup"}


def output_name(file: Column, kind: str) -> Column:
    """``a.b.json`` gives ``a_format.json`` or, for kinds that keep the extension, ``a.b_filter.json``."""
    base = F.element_at(F.split(file, "/"), -1)
    if SUFFIX[kind].endswith(".json"):
        return F.concat(F.split(base, r"\.")[0], F.lit(SUFFIX[kind]))
    return F.regexp_replace(base, r"^(.*)(\.[^.]*)$", f"$1{SUFFIX[kind]}$2")


def save_json(df: DataFrame, path: str, by: str | None = None, mode: str = "error") -> bool:
    """JSON lines in UTF-8, unescaped; nothing is written for no rows.  Returns whether there were any."""
    if df.isEmpty():
        return False
    writer = df.write.mode(mode)
    (writer.partitionBy(by) if by else writer).json(path)
    return True


def save_documents(docs: DataFrame, path: str, by: str | None = None, mode: str = "error") -> bool:
    """Documents that still have lines."""
    return save_json(docs.filter(F.size("cont") > 0), path, by, mode)


def save_text(df: DataFrame, path: str, column: str = "value", mode: str = "append") -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode(mode).text(path)


def split_rejects(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """What stays, and what goes with its ``reject_reason``."""
    marked = df.withColumn("reject_reason", reason)
    return marked.filter("reject_reason is null").drop("reject_reason"), marked.filter("reject_reason is not null")


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, by column name."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out
