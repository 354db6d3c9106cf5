"""Edit-aware token counts.

A document keeps a segment tree over its pre-tokens: leaves hold the text, sizes and token counts of runs of
pre-tokens, inner nodes the sums of their children.  Trees are a table (`token_trees`), which `edit_trees` takes with
edits and gives back with the trees as they are then, so that a later round of edits starts from those.

An edit replaces a range of characters.  Only pre-tokens that it touches, with one before them as context, are split
and encoded again; splitting stops where a new boundary falls on an old one behind the edit, since a pre-token depends
on nothing to its left.  Then the leaves there are exchanged and the sums above them brought up to date.  The text is
held leaf by leaf, so an edit costs what it touches, not the length of the text.  Edits that lie close together are one
edit, so that many of them never cost more than encoding anew.  The count is that of encoding the edited text anew.

Encoding is byte-level BPE with public vocabulary files (their path is a parameter); nothing is trained.

Defined results: a null text is empty and has no tokens.  Edits are taken in order of their start; one
that overlaps an earlier one, or lies outside the text, is left out and counted in ``n_skipped``.  Edits
without a document are left out.  Rows with the same id each get all edits of the id.  An empty table
gives no rows.  Other columns are not looked at.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import regex
import tiktoken
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_id, materialize

#: Pre-tokens in a leaf.
LEAF = 32

#: Edits with fewer unchanged characters between them are made together.
GAP = 256

#: Counts of pre-tokens that a task remembers.
REMEMBERED = 300_000


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> tuple[regex.Pattern, Callable[[str], int]]:
    """The pre-token pattern, and a function that counts one pre-token's tokens."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    known: dict[str, int] = {}
    encode = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._encode_single_piece

    def count(piece: str) -> int:
        n = known.get(piece)
        if n is None:
            if len(known) > REMEMBERED:
                known.clear()
            n = known[piece] = len(encode(piece))
        return n

    return regex.compile(pattern), count


class TokenTree:
    """A segment tree over the pre-tokens of one text.

    A leaf holds about LEAF pre-tokens: their text, and the characters and tokens of each.  `sums` holds, for each
    leaf and inner node, both totals; inner nodes sit in an array with the children of node i at 2i and 2i + 1.
    """

    def __init__(self, text: str, pattern: regex.Pattern, count: Callable[[str], int], sizes: np.ndarray | None = None, counts: np.ndarray | None = None) -> None:
        """Encodes `text`, unless its pre-tokens' `sizes` and `counts` are known."""
        self.pattern, self.count, self.encoded = pattern, count, 0
        if sizes is None:
            pieces = pattern.findall(text)
            self.encoded = len(pieces)
            sizes, counts = np.array([len(p) for p in pieces], np.int64), np.array([count(p) for p in pieces], np.int64)
        ends = np.append(0, np.cumsum(sizes))
        s, c = sizes.tolist(), counts.tolist()
        self._plant([(text[ends[i] : ends[min(i + LEAF, len(s))]], s[i : i + LEAF], c[i : i + LEAF]) for i in range(0, len(s), LEAF)])

    def _plant(self, leaves: list[tuple[str, list[int], list[int]]]) -> None:
        self.leaves = leaves or [("", [], [])]
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        sums = np.zeros((2 * self.width, 2), np.int64)
        sums[self.width : self.width + len(self.leaves)] = [(len(t), sum(c)) for t, _, c in self.leaves]
        level = self.width // 2
        while level:
            sums[level : 2 * level] = sums[2 * level : 4 * level : 2] + sums[2 * level + 1 : 4 * level : 2]
            level //= 2
        self.sums = sums.tolist()

    @property
    def total(self) -> int:
        return self.sums[1][1]

    @property
    def size(self) -> int:
        """Characters of the text."""
        return self.sums[1][0]

    @property
    def text(self) -> str:
        return "".join(t for t, _, _ in self.leaves)

    def kept(self) -> tuple[str, bytes, bytes]:
        """Text, sizes and counts, as a table keeps them."""
        pack = lambda k: zstandard.ZstdCompressor(level=1).compress(np.array([x for leaf in self.leaves for x in leaf[k]], "<u4").tobytes())
        return self.text, pack(1), pack(2)

    def _leaf_at(self, at: int) -> tuple[int, int]:
        """The leaf that holds character `at` (the last one, if none does), and where it begins."""
        node, begin = 1, 0
        while node < self.width:
            node *= 2
            if at >= begin + self.sums[node][0] and self.sums[node + 1][0]:
                begin += self.sums[node][0]
                node += 1
        return node - self.width, begin

    def between(self, start: int, end: int) -> str:
        """The characters start..end."""
        if start >= end:
            return ""
        leaf, begin = self._leaf_at(start)
        parts, size = [], 0
        while begin + size < end and leaf < len(self.leaves):
            parts.append(self.leaves[leaf][0])
            size += len(parts[-1])
            leaf += 1
        return "".join(parts)[start - begin : end - begin]

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace characters start..end (end exclusive) by `new`."""
        leaf, begin = self._leaf_at(max(0, start - 1))
        # begin one pre-token before the one that the edit touches or adjoins
        place, sizes = begin, self.leaves[leaf][1]
        i = 0
        while i < len(sizes) and place + sizes[i] < start:
            place += sizes[i]
            i += 1
        if i:
            i -= 1
            place -= sizes[i]
        elif leaf:
            leaf -= 1
            sizes = self.leaves[leaf][1]
            i = len(sizes) - 1
            begin = place - len(self.leaves[leaf][0])
            place -= sizes[i]
        # the text from the leaf on, with as many leaves as are needed: `upto` is the first that is not in it
        upto, held = leaf, begin
        while upto < len(self.leaves) and (upto == leaf or held <= end):
            held += len(self.leaves[upto][0])
            upto += 1
        text = self.between(begin, start) + new + self.between(end, held)
        moved, base = start + len(new) - end, begin
        to, j, old = leaf, i, place  # old boundaries behind the edit, found as they are needed
        fresh: list[tuple[int, int]] = []
        at = place
        while True:
            m = self.pattern.match(text, at - base)
            nxt = base + m.end() if m and m.end() > at - base else at + 1
            # what comes next may change a match that ends near the end of what is held
            if upto < len(self.leaves) and not text[nxt + 1 - base :].strip():
                text += self.leaves[upto][0]
                upto += 1
                continue
            if at - base >= len(text):
                to, j = len(self.leaves) - 1, len(self.leaves[-1][1])
                break
            fresh.append((nxt - at, self.count(text[at - base : nxt - base])))
            at = nxt
            while old + moved < at or old < end:
                if j >= len(self.leaves[to][1]):
                    if to + 1 >= len(self.leaves):
                        break
                    to, j = to + 1, 0
                    continue
                old += self.leaves[to][1][j]
                j += 1
            if old + moved == at and old >= end:
                break
        self.encoded += len(fresh)
        head, tail = self.leaves[leaf], self.leaves[to]
        rest = sum(tail[1][j:])
        s = head[1][:i] + [a for a, _ in fresh] + tail[1][j:]
        c = head[2][:i] + [b for _, b in fresh] + tail[2][j:]
        t = text[: at - base] + tail[0][len(tail[0]) - rest :]
        if to == leaf and len(s) <= 4 * LEAF:  # the usual case: one leaf and the sums above it
            node = self.width + leaf
            a, b = len(t) - self.sums[node][0], sum(c) - self.sums[node][1]
            self.leaves[leaf] = (t, s, c)
            while node:
                self.sums[node][0] += a
                self.sums[node][1] += b
                node //= 2
        else:
            ends = np.append(0, np.cumsum(s)).tolist()
            self._plant(self.leaves[:leaf] + [(t[ends[k] : ends[min(k + LEAF, len(s))]], s[k : k + LEAF], c[k : k + LEAF]) for k in range(0, len(s), LEAF)] + self.leaves[to + 1 :])

    def edit_all(self, edits: list[tuple[int, int, str]]) -> int:
        """Make edits whose places are those of the text as it is now, in order; how many were left out."""
        ranges: list[list[tuple[int, int, str]]] = []
        last, done, size = 0, 0, self.size
        for start, end, new in edits:
            if last <= start <= end <= size:
                if not ranges or start - last > GAP:
                    ranges.append([])
                ranges[-1].append((start, end, new))
                last, done = end, done + 1
        for own in reversed(ranges):  # from the back, so that places stay right
            first, parts, at = own[0][0], [], own[0][0]
            own_text = self.between(first, own[-1][1])
            for start, end, new in own:
                parts += [own_text[at - first : start - first], new]
                at = end
            self.edit(first, own[-1][1], "".join(parts))
        return len(edits) - done


TREE = "text string, sizes binary, counts binary"


def token_trees(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "byte_bpe_50k.tiktoken", path: str | None = None) -> DataFrame:
    """A tree for each document: ``doc_id, n_tokens, n_pieces, text, sizes, counts``.

    `path` is that of the vocabulary file, which the workers read; it defaults to the installed one.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pattern, count = encoder(path or public_tokenizers.path(vocabulary), public_tokenizers.PATTERN)
        for pdf in batches:
            rows = [(t.total, t.encoded, *t.kept()) for t in (TokenTree(text, pattern, count) for text in pdf["text"])]
            yield pd.DataFrame(rows, columns=["n_tokens", "n_pieces", "text", "sizes", "counts"]).assign(doc_id=_ids(pdf))

    rows = docs.select(doc_id(id_col).cast("string").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInPandas(run, f"doc_id long, n_tokens long, n_pieces long, {TREE}")


def _ids(pdf: pd.DataFrame) -> pd.api.extensions.ExtensionArray:
    """As strings, ids that may be null stay whole in pandas."""
    return pd.array([None if v is None else int(v) for v in pdf["doc_id"]], dtype="Int64")


def edit_trees(
    trees: DataFrame,
    edits: DataFrame | None = None,
    propose: Callable[[str], list[tuple[int, int, str]]] | None = None,
    vocabulary: str = "byte_bpe_50k.tiktoken",
    path: str | None = None,
    keep: bool = True,
) -> DataFrame:
    """The trees after edits: ``doc_id, n_before, n_tokens, n_edits, n_skipped, n_pieces, n_encoded`` and, with `keep`, the new trees.

    Edits come from a table ``doc_id, start, end, new`` (characters), or `propose` names them for a text.  `n_encoded`
    pre-tokens were encoded again for the edits; `n_pieces` is how many the text had.
    """
    rows = trees
    if edits is not None:
        own = edits.filter(F.col("start").isNotNull() & F.col("end").isNotNull()).groupBy(doc_id("doc_id").alias("own")).agg(F.array_sort(F.collect_list(F.struct(F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), F.coalesce(F.col("new"), F.lit("")).alias("new")))).alias("edits"))
        rows = rows.join(own, F.col("doc_id") == F.col("own"), "left").drop("own")
    names = ["n_before", "n_tokens", "n_edits", "n_skipped", "n_pieces", "n_encoded"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pattern, count = encoder(path or public_tokenizers.path(vocabulary), public_tokenizers.PATTERN)
        numbers = lambda x: np.frombuffer(zstandard.ZstdDecompressor().decompress(x), "<u4").astype(np.int64)
        for pdf in batches:
            out = []
            listed = pdf["edits"] if "edits" in pdf else [None] * len(pdf)
            for text, sizes, counts, before, pieces, given in zip(pdf["text"], pdf["sizes"], pdf["counts"], pdf["n_tokens"].tolist(), pdf["n_pieces"].tolist(), listed):
                todo = propose(text) if propose else [] if given is None else [(e["start"], e["end"], e["new"]) for e in given]
                if not todo:
                    out.append((before, before, 0, 0, pieces, 0, text, sizes, counts) if keep else (before, before, 0, 0, pieces, 0))
                    continue
                tree = TokenTree(text, pattern, count, numbers(sizes), numbers(counts))
                skipped = tree.edit_all(todo)
                row = (before, tree.total, len(todo) - skipped, skipped, pieces, tree.encoded)
                out.append((*row, *tree.kept()) if keep else row)
            yield pd.DataFrame(out, columns=names + ["text", "sizes", "counts"] * keep).assign(doc_id=_ids(pdf))

    schema = "doc_id long, " + ", ".join(f"{n} long" for n in names) + (f", {TREE}" if keep else "")
    return rows.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(run, schema)


def count_with_edits(
    docs: DataFrame,
    edits: DataFrame | None = None,
    propose: Callable[[str], list[tuple[int, int, str]]] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = "byte_bpe_50k.tiktoken",
    path: str | None = None,
) -> DataFrame:
    """One row per document: ``doc_id, n_before, n_after, n_edits, n_skipped, n_pieces, n_encoded``; trees are kept in the shared folder."""
    trees = materialize(token_trees(docs, id_col, text_col, vocabulary, path), "token-trees", compression="zstd")
    return edit_trees(trees, edits, propose, vocabulary, path, keep=False).withColumnRenamed("n_tokens", "n_after")


#: What `mask_addresses` replaces: runs of non-space with an at sign, and what goes there.
_ADDRESS, MASK = regex.compile(r"[^\x20\x09-\x0D@]++@[^\x20\x09-\x0D]+"), "<EMAIL>"


def mask_addresses(text: str) -> list[tuple[int, int, str]]:
    """Edits that put a mask in place of every word with an at sign."""
    return [(m.start(), m.end(), MASK) for m in _ADDRESS.finditer(text)] if "@" in text else []
