"""Language-model scoring by prediction by partial matching.

The model is a trie of byte contexts up to `order` bytes.  A byte is coded in the longest context that
was seen; if it was not seen there, an escape is coded (method D: each distinct symbol gives half a count
to the escape) and the next shorter context is tried, without the symbols that the longer one has ruled
out (exclusion).  Below order 0 all symbols left are equally likely.  Shorter contexts count a symbol
only where it was new in the longer one (update exclusion).  A text ends with a symbol of its own, so
the code lengths are of a proper distribution over texts.

*Adaptive* scoring (`adaptive_scores`) starts each document from an empty trie and learns as it goes.

*Pretrained* scoring (`pretrained_scores`) learns from all training documents, in three steps:

1. One scan cuts the documents into parts.  A part keeps its texts, compressed, and says by bucket which
   trie nodes and words occur in it and how often in training.  A bucket has all contexts of some pairs of
   preceding bytes, or the words with some hash.
2. A bucket's requests are merged (in a tree, at most `fan_in` at a time) into its share of the model, code lengths are worked out there, and each part gets its own ones back.
3. Each part scores its texts.

No task holds the whole model, and what is sent back to a part is what occurs in it.

Defined results: a null text is empty, which is one end symbol and one end token.  Rows with the same
id are separate documents.  Without training documents all symbols are equally likely.  An empty table
gives no rows.  Other columns are not looked at.
"""

from __future__ import annotations

import math
import struct
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_id, give_back, input_bytes, materialize

#: Bytes that UTF-8 never has: before a text, and after it.  All but START can be predicted.
START, END, SYMBOLS = 0xFE, 0xFF, 255

#: Bytes of text in one part, at most (but for one longer text).
PART = 32 << 20

#: Bytes of text that are looked at together inside a part.
CHUNK = 2 << 20


class Trie:
    """A trie of contexts that is kept symbol by symbol."""

    def __init__(self, order: int) -> None:
        self.order = order
        self.counts: dict[bytes, Counter] = defaultdict(Counter)

    def log10(self, past: bytes, symbol: int) -> float:
        out, excluded = 0.0, set()
        for j in range(self.order, -1, -1):
            seen = self.counts.get(past[len(past) - j :])
            if not seen:
                continue
            fresh = {s: c for s, c in seen.items() if s not in excluded}
            total = sum(fresh.values())
            if symbol in fresh:
                return out + math.log10((fresh[symbol] - 0.5) / total)
            if fresh:
                out += math.log10(0.5 * len(fresh) / total)
            excluded = set(seen)
        return out - math.log10(SYMBOLS - len(excluded))

    def learn(self, past: bytes, symbol: int) -> None:
        for j in range(self.order, -1, -1):
            seen = self.counts[past[len(past) - j :]]
            seen[symbol] += 1
            if seen[symbol] > 1:  # not new here: shorter contexts have it
                return

    def score(self, text: str | None, learn: bool, score: bool = True) -> float:
        raw = bytes([START]) * self.order + (text or "").encode("utf-8", "replace") + bytes([END])
        total = 0.0
        for i in range(self.order, len(raw)):
            past = raw[i - self.order : i]
            if score:
                total += self.log10(past, raw[i])
            if learn:
                self.learn(past, raw[i])
        return total


def adaptive_scores(docs: DataFrame, order: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, score``: each document's log10 probability under a trie that learns from that document alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [t if isinstance(t, str) else "" for t in pdf["text"]]
            ids = pd.array([None if pd.isna(i) else int(i) for i in pdf["doc_id"]], dtype="Int64")
            yield pd.DataFrame({"doc_id": ids, "n_bytes": [len(t.encode("utf-8", "replace")) for t in texts], "score": [Trie(order).score(t, learn=True) for t in texts]})

    # an id may be null: as strings, ids stay whole in pandas
    return docs.select(doc_id(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(run, "doc_id long, n_bytes long, score double")


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def _grams(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The packed context and symbol at every place of the texts, end included, and where each text begins."""
    pad, end = bytes([START]) * order, bytes([END])
    raw = np.frombuffer(b"".join(x for t in texts for x in (pad, t, end)), dtype=np.uint8)
    key = raw[: len(raw) - order].astype(np.int64)
    for j in range(1, order + 1):
        key <<= 8
        key |= raw[j : len(raw) - order + j]
    key = key[raw[order:] != START]
    return key, np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])


def _squeeze(x: np.ndarray | bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(x if isinstance(x, bytes) else np.ascontiguousarray(x).tobytes())


def _spread(x: bytes, dtype: str | None = None) -> np.ndarray | bytes:
    raw = zstandard.ZstdDecompressor().decompress(x)
    return np.frombuffer(raw, dtype=dtype) if dtype else raw


def _squeeze_sorted(x: np.ndarray) -> bytes:
    return _squeeze(np.diff(x, prepend=0))


def _spread_sorted(x: bytes) -> np.ndarray:
    return np.cumsum(_spread(x, "<i8"))


def _gram_bucket(gram: np.ndarray, buckets: int) -> np.ndarray:
    """By the two bytes before the symbol, so that all contexts of order 2 and more that go together meet."""
    pair = (gram >> 8) & 0xFFFF
    return (pair * 40503 >> 4) % buckets


def _word_buckets(own: list[bytes], buckets: int) -> np.ndarray:
    return np.fromiter((xxhash.xxh32_intdigest(w) for w in own), dtype=np.int64, count=len(own)) % buckets + buckets


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Names in ascending order, each once, and the sums of their counts."""
    name, n = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(name, kind="stable")
    name, n = name[order], n[order]
    first = np.nonzero(np.append(True, name[1:] != name[:-1]))[0]
    return name[first], np.add.reduceat(n, first)


PARTS = "part long, bucket int, docs binary, names binary, n binary"


def _part(part: int, ids: list, trained: list[bool], texts: list[bytes], order: int, buckets: int) -> pd.DataFrame:
    """The rows of one part: its texts (bucket null), and by bucket the names of nodes or words and their counts."""
    grams: list[tuple[np.ndarray, np.ndarray]] = []  # each at most half as long as the one before, so that few copies of a node are held
    for flag in (True, False):
        own = [t for t, x in zip(texts, trained) if x == flag]
        for lo, hi in _chunks(own):
            n = pd.Series(_grams(own[lo:hi], order)[0]).value_counts(sort=False)
            grams.append(_merged([(n.index.to_numpy(dtype="<i8"), n.to_numpy(dtype="<i8") * flag)]))
            del n
            while len(grams) > 1 and 2 * len(grams[-1][0]) > len(grams[-2][0]):
                grams[-2:] = [_merged(grams[-2:])]
    name, n = _merged(grams)  # in ascending order
    del grams
    rows = [(part, None, _squeeze(_pack_docs(ids, trained, texts)), None, None)]
    at = _gram_bucket(name, buckets)
    by = np.argsort(at, kind="stable")
    own, first = np.unique(at[by], return_index=True)
    for b, x in zip(own.tolist(), np.split(by, first[1:])):
        rows.append((part, b, None, _squeeze_sorted(name[x]), _squeeze(n[x])))
    del name, n, x
    words: Counter = Counter()
    for t, x in zip(texts, trained):
        if x:
            words.update(t.lower().split())
    words[b""] += sum(trained)
    for t, x in zip(texts, trained):
        if not x:
            for w in t.lower().split():
                words.setdefault(w, 0)
    word, n = list(words), np.fromiter(words.values(), dtype="<i8", count=len(words))
    del words
    at = _word_buckets(word, buckets)
    by = np.argsort(at, kind="stable")
    own, first = np.unique(at[by], return_index=True)
    for b, x in zip(own.tolist(), np.split(by, first[1:])):
        rows.append((part, b, None, _squeeze(b" ".join(word[i] for i in x)), _squeeze(n[x])))
    return pd.DataFrame(rows, columns=["part", "bucket", "docs", "names", "n"]).astype({"bucket": "Int32"})


def _pack_docs(ids: list, trained: list[bool], texts: list[bytes]) -> bytes:
    head = struct.pack("<q", len(ids)) + np.array([i is not None for i in ids], dtype="<i1").tobytes() + np.array([i or 0 for i in ids], dtype="<i8").tobytes()
    return head + np.array(trained, dtype="<i1").tobytes() + np.array([len(t) for t in texts], dtype="<i8").tobytes() + b"".join(texts)


def _unpack_docs(raw: bytes) -> tuple[list, list[bool], list[bytes]]:
    n = struct.unpack_from("<q", raw)[0]
    known = np.frombuffer(raw, "<i1", n, 8)
    ids = np.frombuffer(raw, "<i8", n, 8 + n)
    trained = np.frombuffer(raw, "<i1", n, 8 + 9 * n)
    ends = 8 + 18 * n + np.cumsum(np.frombuffer(raw, "<i8", n, 8 + 10 * n))
    texts = [raw[a:b] for a, b in zip(np.append(8 + 18 * n, ends[:-1]).tolist(), ends.tolist())]
    return [int(i) if k else None for i, k in zip(ids, known)], trained.astype(bool).tolist(), texts


def _merge(is_word: bool, names: pd.Series, n: pd.Series) -> tuple[np.ndarray | list[bytes], np.ndarray]:
    if is_word:
        total: dict[bytes, int] = {}
        for x, c in zip(names, n):
            for w, k in zip(_spread(x).split(b" "), _spread(c, "<i8").tolist()):
                total[w] = total.get(w, 0) + k
        return list(total), np.fromiter(total.values(), dtype="<i8", count=len(total))
    own, at = np.unique(np.concatenate([_spread_sorted(x) for x in names]), return_inverse=True)
    return own, np.bincount(at, weights=np.concatenate([_spread(x, "<i8") for x in n]), minlength=len(own)).astype("<i8")


def _sums(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own, at = np.unique(key, return_inverse=True)
    return own, np.bincount(at, weights=n, minlength=len(own))


def _look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0.0)


class Levels:
    """Counts of all orders, and what exclusion needs: for each context the mass that its symbols have one order down."""

    def __init__(self, gram: np.ndarray, n: np.ndarray, order: int, lowest: int, below: "Levels | None" = None) -> None:
        self.order, self.lowest, self.below = order, lowest, below
        self.grams, self.contexts = {}, {}
        self.grams[order] = _sums(gram, n)
        for j in range(order - 1, lowest - 1, -1):  # a shorter context counts the longer ones that have the symbol
            longer = self.grams[j + 1][0]
            self.grams[j] = _sums(longer & ((1 << 8 * (j + 1)) - 1), np.ones(len(longer)))
        for j in range(lowest, order + 1):
            own, count = self.grams[j]
            context, total = _sums(own >> 8, count)
            _, distinct = _sums(own >> 8, np.ones(len(own)))
            down = self.count(j - 1, own & ((1 << 8 * j) - 1)) if j else np.zeros(len(own))
            self.contexts[j] = (context, total, distinct, _sums(own >> 8, down)[1])

    def count(self, j: int, gram: np.ndarray) -> np.ndarray:
        return self.below.count(j, gram) if j < self.lowest else _look(*self.grams[j], gram)

    def context(self, j: int, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if j < self.lowest:
            return self.below.context(j, context)
        keys, total, distinct, down = self.contexts[j]
        return _look(keys, total, context), _look(keys, distinct, context), _look(keys, down, context)

    def log10(self, gram: np.ndarray) -> np.ndarray:
        out, open_ = np.zeros(len(gram)), np.arange(len(gram))
        gone, mass = np.zeros(len(gram)), np.zeros(len(gram))  # symbols ruled out, and their count at this order
        for j in range(self.order, -1, -1):
            g = gram[open_]
            total, distinct, down = self.context(j, (g >> 8) & ((1 << 8 * j) - 1))
            c = self.count(j, g & ((1 << 8 * (j + 1)) - 1))
            fresh, left = distinct - gone, total - mass
            with np.errstate(divide="ignore", invalid="ignore"):
                hit = c > 0
                add = np.where(hit, np.log10((c - 0.5) / left), np.where((total > 0) & (fresh > 0), np.log10(0.5 * fresh / left), 0.0))
            out[open_] += add
            keep = ~hit
            seen = total[keep] > 0
            open_ = open_[keep]
            gone, mass = np.where(seen, distinct[keep], 0.0), np.where(seen, down[keep], 0.0)
        out[open_] -= np.log10(SYMBOLS - gone)
        return out


def pretrained_scores(
    docs: DataFrame,
    trained: Column,
    order: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_bytes: int = PART,
    buckets: int | None = None,
    fan_in: int = 512,
) -> DataFrame:
    """Score every document by a model that learns from the rows where `trained` is true.

    Returns ``doc_id, trained, n_tokens, n_known, train_tokens, base_score, score``; the base is a unigram
    model of words with one added to each count, the score is the trie's.  `order` is 2 to 6.  `buckets`
    follows the input's size if it is not given.
    """
    if not 2 <= order <= 6:
        raise ValueError("order must be 2 to 6")
    many = buckets or min(max(256, math.ceil(input_bytes(docs) / part_bytes)), 1 << 16)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held, size = TaskContext.get().partitionId() << 32, ([], [], []), 0
        for pdf in batches:
            for i, x, t in zip(pdf["doc_id"], pdf["trained"], pdf["text"]):
                raw = t.encode("utf-8", "replace") if isinstance(t, str) else b""
                held[0].append(None if pd.isna(i) else int(i))
                held[1].append(bool(x))
                held[2].append(raw)
                size += len(raw)
                if size >= part_bytes:
                    yield _part(part, *held, order, many)
                    part, held, size = part + 1, ([], [], []), 0
                    give_back()
            pdf = t = raw = None  # the next batch, or the last part, needs the room
        if held[0]:
            yield _part(part, *held, order, many)
            held = None
        give_back()

    rows = docs.select(doc_id(id_col).alias("doc_id"), F.coalesce(trained, F.lit(False)).alias("trained"), F.col(text_col).alias("text"))
    # an id may be null: as strings, ids stay whole in pandas
    cut_up = materialize(rows.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(cut, PARTS), "ppm-parts")
    needs = cut_up.filter("bucket is not null").select("part", "bucket", "names", "n")
    n_parts = cut_up.filter("bucket is null").count()
    groups = max(1, math.ceil(n_parts / fan_in))  # of parts, so that what meets in a task stays small
    needs = needs.withColumn("group", F.pmod(F.xxhash64("part"), F.lit(groups)).cast("int"))

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        bucket, group = int(pdf["bucket"].iloc[0]), int(pdf["group"].iloc[0])
        names, n = _merge(bucket >= many, pdf["names"], pdf["n"])
        return pd.DataFrame({"bucket": [bucket], "group": [group], "names": [_squeeze(b" ".join(names)) if bucket >= many else _squeeze_sorted(names)], "n": [_squeeze(n)]})

    # a tree of merges: no task meets more than `fan_in` requests of a bucket, however frequent its bytes are
    model, left = needs, groups
    while True:
        model = model.groupBy("bucket", "group").applyInPandas(merge, "bucket int, group int, names binary, n binary")
        if left == 1:
            break
        left = math.ceil(left / fan_in)
        model = materialize(model.withColumn("group", F.pmod("group", F.lit(left))), "ppm-merged")
    model = materialize(model.drop("group"), "ppm-model")

    def totals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for b, names, n in zip(pdf["bucket"], pdf["names"], pdf["n"]):
                c = _spread(n, "<i8")
                if b >= many:
                    yield pd.DataFrame({"gram": [-1], "c": [int(c.sum())], "distinct": [int((c > 0).sum())]})
                else:  # distinct nodes of order 2, counted by the node of order 1
                    two = np.unique(_spread_sorted(names)[c > 0] & 0xFFFFFF)
                    own, k = np.unique(two & 0xFFFF, return_counts=True)
                    yield pd.DataFrame({"gram": own, "c": k, "distinct": 0})

    # at most 256 x 256 rows, and one: the nodes of orders 0 and 1, which all others fall back on, and the words' totals
    low = model.mapInPandas(totals, "gram long, c long, distinct long").groupBy("gram").agg(F.sum("c").alias("c"), F.sum("distinct").alias("distinct")).toPandas()
    of_words = low["gram"] == -1
    n_train, n_distinct = int(low["c"][of_words].sum()), int(low["distinct"][of_words].sum())
    low = low[~of_words].sort_values("gram")
    below = Levels(low["gram"].to_numpy(dtype=np.int64), low["c"].to_numpy(dtype=np.float64), 1, 0)

    def tell(own: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        bucket = int(model["bucket"].iloc[0])
        c = _spread(model["n"].iloc[0], "<i8")
        out = []
        if bucket >= many:
            count = dict(zip(_spread(model["names"].iloc[0]).split(b" "), c.tolist()))
            for x in own["names"]:
                wanted = _spread(x).split(b" ")
                out.append(_squeeze(np.fromiter(map(count.__getitem__, wanted), dtype="<i8", count=len(wanted))))
        else:
            gram = _spread_sorted(model["names"].iloc[0])
            value = Levels(gram[c > 0], c[c > 0].astype(np.float64), order, 2, below).log10(gram).astype("<f4")
            for x in own["names"]:
                out.append(_squeeze(value[np.searchsorted(gram, _spread_sorted(x))]))
        return pd.DataFrame({"part": own["part"], "bucket": bucket, "names": own["names"], "value": out})

    copies = model.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    told = needs.groupBy("bucket", "group").cogroup(copies.groupBy("bucket", "group")).applyInPandas(lambda own, model: tell(own, model) if len(own) and len(model) else pd.DataFrame({"part": [], "bucket": [], "names": [], "value": []}), "part long, bucket int, names binary, value binary")

    def score(own: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        ids, flags, texts = _unpack_docs(_spread(own["docs"].iloc[0]))
        is_word = (told["bucket"] >= many).to_numpy()
        word: dict[bytes, int] = {}
        for x, c in zip(told["names"][is_word], told["value"][is_word]):
            word.update(zip(_spread(x).split(b" "), _spread(c, "<i8").tolist()))
        grams = [_spread_sorted(x) for x in told["names"][~is_word]]
        length = np.concatenate([_spread(x, "<f4") for x in told["value"][~is_word]]).astype(np.float64)
        index = pd.Index(np.concatenate(grams))
        total = np.zeros(len(texts))
        for lo, hi in _chunks(texts):
            key, starts = _grams(texts[lo:hi], order)
            total[lo:hi] = np.add.reduceat(length[index.get_indexer(key)], starts)
        n, known, base = [], [], []
        whole = math.log10(n_train + n_distinct + 1)
        for t in texts:
            tokens = t.lower().split()
            tokens.append(b"")
            c = np.fromiter(map(word.__getitem__, tokens), dtype=np.int64, count=len(tokens))
            n.append(len(tokens))
            known.append(int(np.count_nonzero(c)))
            base.append(float(np.log10(c + 1.0).sum() - len(tokens) * whole))
        return pd.DataFrame({"doc_id": pd.array(ids, dtype="Int64"), "trained": flags, "n_tokens": n, "n_known": known, "train_tokens": n_train, "base_score": base, "score": total})

    def scored(own: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        try:
            return score(own, told)
        finally:
            give_back()

    texts = cut_up.filter("bucket is null").select("part", "docs")
    return texts.groupBy("part").cogroup(told.groupBy("part")).applyInPandas(scored, "doc_id long, trained boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
