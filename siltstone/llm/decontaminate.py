"""Benchmark decontamination with a distributed positional inverted index.

`build_index` cuts the training documents into segments and inverts each: a row per segment and term
holds the ascending positions of that term in the segment.  Segments are cut by size, so a very common
word is spread over all of them and no task gathers a whole posting list.  Documents in a segment are
one position apart, so a phrase cannot run over a document's end.

`find` takes phrases (term lists), a bounded block at a time.  Only postings of terms that occur in the
block leave the index, and a segment tries the phrases whose rarest term in the block it has.  There a phrase starts
from its rarest term in the segment; the lists of its other
terms, in order of rarity and moved by their offsets, are intersected until none is left.  With
`slop` 0 matches are exact phrases; otherwise each term may be up to `slop` positions off its place
relative to the rarest (proximity).

Defined results: null and blank texts have no words; an item without words has no windows.  An item
shorter than a window is one window.  Item ids are compared as strings, null as the empty string;
items with the same id count as one item.  Documents with the same id stay separate rows.  Empty
tables give no rows, or rows without hits.  Other columns are not looked at.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_id, materialize

#: Bytes of text in a segment of the index, and in a block of items that is sent to all segments.
SEGMENT, BLOCK = 4 << 20, 4 << 20

INDEX = "segment long, term binary, n long, postings binary, doc_id long, start long"

#: Words are runs of ASCII letters and digits and of all that is not ASCII; letters A-Z are lower-cased.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_WORD_BYTES).split()


def _invert(segment: int, ids: list, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
    """The rows of one segment.  No Python object is made for a word: they are found and encoded as arrays."""
    raw = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    is_word = raw != 32
    edge = np.diff(is_word.astype(np.int8), prepend=0)
    starts, ends = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    first = np.concatenate([[0], np.searchsorted(starts, text_ends[:-1])]) if len(texts) > 1 else np.array([0])
    n_words = np.diff(np.append(first, len(starts)))
    doc_start = first + np.arange(len(texts))  # one free position after each document
    schema = pa.schema([("segment", pa.int64()), ("term", pa.binary()), ("n", pa.int64()), ("postings", pa.binary()), ("doc_id", pa.int64()), ("start", pa.int64())])
    k = len(texts)
    yield pa.RecordBatch.from_arrays([pa.array(np.full(k, segment)), pa.nulls(k, pa.binary()), pa.array(n_words), pa.nulls(k, pa.binary()), pa.array(ids, pa.int64()), pa.array(doc_start)], schema=schema)
    if not len(starts):
        return
    position = (np.arange(len(starts)) + np.repeat(np.arange(len(texts)), n_words)).astype("<i4")
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    terms = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[is_word].tobytes())]).dictionary_encode()
    code = terms.indices.to_numpy()
    count = np.bincount(code, minlength=len(terms.dictionary))
    sorted_ = position[np.argsort(code, kind="stable")]
    ends4 = np.concatenate([[0], np.cumsum(count) * 4])
    for at in range(0, len(count), 1 << 16):
        to = min(at + (1 << 16), len(count))
        m = to - at
        off = (ends4[at : to + 1] - ends4[at]).astype(np.int32)
        lists = pa.Array.from_buffers(pa.binary(), m, [None, pa.py_buffer(off), pa.py_buffer(sorted_[ends4[at] // 4 : ends4[to] // 4].tobytes())])
        yield pa.RecordBatch.from_arrays([pa.array(np.full(m, segment)), terms.dictionary.slice(at, m), pa.array(count[at:to]), lists, pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64())], schema=schema)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_bytes: int = SEGMENT) -> DataFrame:
    """The index as a table: rows with a term are posting lists, the others say where a document lies in its segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = t.as_buffer().to_pybytes().translate(_WORD_BYTES) if t.is_valid else b""
                ids.append(i)
                texts.append(raw)
                size += len(raw)
                if size >= segment_bytes:
                    yield from _invert(segment, ids, texts)
                    segment, ids, texts, size = segment + 1, [], [], 0
        if ids:
            yield from _invert(segment, ids, texts)

    return materialize(docs.select(doc_id(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, INDEX), "postings")


def windows(items: list[tuple[str, list[bytes]]], size: int) -> dict[tuple[bytes, ...], set[str]]:
    """Each distinct window of `size` words with the items that have it."""
    out: dict[tuple[bytes, ...], set[str]] = {}
    once: dict[bytes, bytes] = {}  # one object a term, for memory and for what is sent
    for key, own in items:
        own = [once.setdefault(w, w) for w in own]
        for i in range(max(1, len(own) - size + 1) if own else 0):
            out.setdefault(tuple(own[i : i + size]), set()).add(key)
    return out


def occurrences(lists: dict[bytes, np.ndarray], phrase: tuple[bytes, ...], slop: int = 0) -> np.ndarray:
    """Start positions of `phrase`: intersect the offset-adjusted lists, rarest term first."""
    order = sorted(range(len(phrase)), key=lambda i: len(lists[phrase[i]]))
    at = lists[phrase[order[0]]].astype(np.int64) - order[0]
    for i in order[1:]:
        if not len(at):
            break
        there = lists[phrase[i]]
        lo = np.searchsorted(there, at + i - slop)
        if slop:
            at = at[lo < np.searchsorted(there, at + i + slop, side="right")]
        else:
            lo[lo == len(there)] = 0
            at = at[there[lo] == at + i]
    return at


def _match(phrases: dict[tuple[bytes, ...], set[str]], slop: int):
    often = Counter(t for p in phrases for t in set(p))
    by_rarest: dict[bytes, list[tuple[tuple[bytes, ...], tuple[str, ...]]]] = {}
    for p, k in phrases.items():
        by_rarest.setdefault(min(p, key=lambda t: (often[t], t)), []).append((p, tuple(sorted(k))))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        is_doc = pdf["term"].isna().to_numpy()
        own = pdf[~is_doc]
        lists = {bytes(t): np.frombuffer(p, dtype="<i4") for t, p in zip(own["term"], own["postings"])}
        place = pdf.loc[is_doc, ["start", "n"]].astype("int64").sort_values("start")
        start, n = place["start"].to_numpy(), place["n"].to_numpy()
        have = lists.__contains__
        ids: dict[int, set[str]] = {}
        docs, los, his = [], [], []
        # only phrases whose rarest term (among those asked for) the segment has
        for phrase, keys in itertools.chain.from_iterable(by_rarest.get(t, ()) for t in lists):
            if not all(map(have, phrase)) or not len(at := occurrences(lists, phrase, slop)):
                continue
            d = np.maximum(np.searchsorted(start, at, side="right") - 1, 0)
            lo, hi = np.maximum(at - start[d] - slop, 0), np.minimum(at - start[d] + len(phrase) + slop, n[d])
            ok = lo < hi
            docs.append(d[ok])
            los.append(lo[ok])
            his.append(hi[ok])
            for x in np.unique(d[ok]).tolist():
                ids.setdefault(x, set()).update(keys)
        rows = []
        if docs:
            d, lo, hi = np.concatenate(docs), np.concatenate(los), np.concatenate(his)
            order = np.lexsort((lo, d))
            d, lo, hi = d[order], lo[order], hi[order]
            cut = np.concatenate([[0], np.nonzero(np.diff(d))[0] + 1, [len(d)]])
            for x, y in zip(cut[:-1], cut[1:]):
                far = np.maximum.accumulate(hi[x:y])  # ranges that overlap or touch become one
                new = np.concatenate([[True], lo[x + 1 : y] > far[:-1]])
                rows.append((int(pdf["segment"].iloc[0]), int(start[d[x]]), sorted(ids[int(d[x])]), lo[x:y][new].tolist(), far[np.append(np.nonzero(new)[0][1:], y - x) - 1].tolist()))
        return pd.DataFrame(rows, columns=["segment", "start", "items", "lo", "hi"])

    return run


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    held, size = [], 0
    for row in items.toLocalIterator():
        held.append((row[0] or "", words(row[1])))
        size += len(row[1] or "")
        if size >= block_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held


def find(index: DataFrame, items: DataFrame, size: int = 13, slop: int = 0, block_bytes: int = BLOCK) -> DataFrame:
    """``segment, start, items, lo, hi``: documents with hits, the items that occur and the hit word ranges.

    `items` has two columns, id (string) and text; it is taken in blocks of about `block_bytes`, each
    against all segments.
    """
    schema = "segment long, start long, items array<string>, lo array<long>, hi array<long>"
    out = None
    for block in _blocks(items, block_bytes):
        phrases = windows(block, size)
        if not phrases:
            continue
        terms = index.sparkSession.createDataFrame([(bytearray(t),) for t in sorted({t for p in phrases for t in p})], "term binary")
        need = index.join(F.broadcast(terms), "term", "left_semi").unionByName(index.filter("term is null"))  # `terms` is at most one block
        hits = need.groupBy("segment").applyInPandas(_match(phrases, slop), schema)
        out = hits if out is None else out.unionByName(hits)
    return index.sparkSession.createDataFrame([], schema) if out is None else out


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = 13,
    share: int = 20,
    segment_bytes: int = SEGMENT,
    block_bytes: int = BLOCK,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items, contaminated``.

    Contaminated: at least one word in ``share`` lies inside an occurring window.
    """
    index = build_index(docs, id_col, text_col, segment_bytes)
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")), F.col(item_text_col))
    hits = find(index, items, size, 0, block_bytes).groupBy("segment", "start").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.arrays_zip(F.flatten(F.collect_list("lo")).alias("lo"), F.flatten(F.collect_list("hi")).alias("hi"))).alias("ranges"),
    )
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate("ranges", zero, lambda a, x: F.struct(F.greatest(a["end"], x["hi"]).alias("end"), (a["n"] + F.greatest(F.lit(0).cast("long"), x["hi"] - F.greatest(a["end"], x["lo"]))).alias("n")), lambda a: a["n"])
    hits = hits.select("segment", "start", "items", covered.alias("hit"))
    places = index.filter("term is null").select("segment", "start", "doc_id", F.col("n").alias("n_words"))
    n_hit = F.coalesce("hit", F.lit(0).cast("long"))
    return places.join(hits, ["segment", "start"], "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )
