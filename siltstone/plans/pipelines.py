"""The four jobs, end to end, as lazy plans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import dedup, dialogue, threads, webdoc


def format_threads(blogs: DataFrame, strict: bool = True) -> DataFrame:
    """Raw blogs to conversations."""
    return threads.conversations(blogs, strict)


def filter_dialogues(convs: DataFrame, **how) -> DataFrame:
    """Conversations (``file, seq, conv``) to cleaned dialogues."""
    return dialogue.clean_dialogues(dialogue.from_utterances(convs), **how)


def filter_documents(docs: DataFrame, blacklisted: Callable[[Column], Column] | None = None, labels=None, **how) -> DataFrame:
    return webdoc.clean_documents(docs, blacklisted, labels, **how)


def dedup_and_merge(docs: DataFrame, score: Callable[[Column], Column] | None = None, at_most: float | None = None, skip: str | None = None) -> DataFrame:
    """Near-duplicates of a file go, then an optional score limit, the length band and the global order.

    Files whose name begins with `skip` (merged ones of an earlier run) are left out.
    """
    docs = docs.filter(~F.col("file").startswith(skip)) if skip else docs
    docs = dedup.charset_dedup(docs)
    if score:
        docs = docs.withColumn("perplexity", score(F.array_join("cont", "\n")))
        docs = docs.filter(F.col("perplexity") <= at_most) if at_most is not None else docs
    return webdoc.by_length(docs)
