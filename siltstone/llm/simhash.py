"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are compared with numpy: exclusive-or, then bit counts.  What is not compared cannot
link:

* two fingerprints within `radius` bits agree on at least one of ``radius + 1`` bands of bits, so
  tiles are cut inside the rows that share a band's value;
* inside them rows are in order of their population count and cut into tiles, and pairs of tiles whose counts
  differ by more than `radius` are skipped, since each differing bit changes the count by one at most.

Both rules are exact: nothing within the radius is lost.  A band value that many fingerprints share is
cut into tiles by population count and a hash, and each pair of tiles is a group of its own, so no
task holds the whole of it; one that very many share is banded once more on its other bits.  Copies (equal fingerprints) are merged before, and a tile gives at
most one link a row (a spanning forest), never all of its pairs.

Components come from smallest-label spreading with pointer jumping over the links; labels are written
to the shared folder each round.

Defined results: a null or blank text has fingerprint zero, which links like any other.  Rows with
the same id are the same document given twice.  A null id comes last and is null where it is the
smallest.  An empty table gives no rows.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, doc_id, materialize, salt_mask, salt_of, salts_in

#: Texts are split into words piece by piece, so that one very long text needs little memory.
PIECE = 1 << 22


def word_pieces(raw: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """The words of `raw` (runs of bytes other than ASCII white space), in lists from pieces of about `size` bytes."""
    at = 0
    while len(raw) - at > size:
        end = at + size
        cut = max(raw.rfind(c, at, end) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
        if cut <= at:  # one word fills the piece: go on to its end
            ends = [x for x in (raw.find(c, end) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if x >= 0]
            cut = min(ends) if ends else len(raw)
        yield raw[at:cut].split()
        at = cut
    yield raw[at:].split()


def shingle_hashes(text: str | None, width: int, seed: int = 42) -> Iterator[np.ndarray]:
    """XXH64 of the shingles of `width` words, in arrays."""
    held: list[bytes] = []
    any_ = False
    for words in word_pieces((text or "").encode("utf-8", "replace").lower()):
        words = held + words
        if len(words) >= width:
            shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
            yield np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in shingles), dtype=np.uint64, count=len(words) - width + 1)
            any_ = True
        held = words[-(width - 1) :] if width > 1 else []
    if not any_ and held:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(held), seed)], dtype=np.uint64)


def _bit_sums(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduceat(bits, starts, axis=0, dtype=np.int32)


def fingerprints(texts: list[str | None], width: int = 3, seed: int = 42) -> np.ndarray:
    """One unsigned 64-bit fingerprint a text: a bit is set if it is set in over half the shingle hashes."""
    sums = np.zeros((len(texts), 64), dtype=np.int64)
    n = np.zeros(len(texts), dtype=np.int64)
    held: list[np.ndarray] = []
    owner: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if held:
            starts = np.cumsum([0] + [len(x) for x in held[:-1]])
            np.add.at(sums, owner, _bit_sums(np.concatenate(held), starts))
        held.clear()
        owner.clear()
        size = 0

    for i, text in enumerate(texts):
        for h in shingle_hashes(text, width, seed):
            for at in range(0, len(h), 1 << 16):
                part = h[at : at + (1 << 16)]
                held.append(part)
                owner.append(i)
                n[i] += len(part)
                size += len(part)
                if size >= 1 << 16:
                    flush()
    flush()
    return np.packbits((2 * sums > n[:, None]).astype(np.uint8), axis=1, bitorder="little").view(np.uint64).reshape(-1)


def fingerprint_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fp = fingerprints([t if isinstance(t, str) else None for t in pdf["text"]], width, seed)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "fp": fp.view(np.int64)})

    return docs.select(F.coalesce(doc_id(id_col), F.lit(NULL_ID)).alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(run, "doc_id long, fp long")


def forest(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The smallest index that each of 0..n-1 can reach over the links u-v."""
    label = np.arange(n)
    while len(u):
        low = np.minimum(label[u], label[v])
        was = label.copy()
        np.minimum.at(label, u, low)
        np.minimum.at(label, v, low)
        label = label[label]
        if (label == was).all():
            break
    return label


class _Links:
    """Collects links between rows of one batch and keeps a spanning forest of them."""

    def __init__(self, n: int) -> None:
        self.n, self.u, self.v, self.held = n, [], [], 0

    def add(self, u: np.ndarray, v: np.ndarray) -> None:
        if len(u):
            self.u.append(u)
            self.v.append(v)
            self.held += len(u)
            if self.held > 500_000:
                self._shrink()

    def _shrink(self) -> np.ndarray:
        label = forest(self.n, np.concatenate(self.u), np.concatenate(self.v)) if self.u else np.arange(self.n)
        own = np.nonzero(label != np.arange(self.n))[0]
        self.u, self.v, self.held = [own], [label[own]], len(own)
        return label

    def result(self, fp: np.ndarray) -> pd.DataFrame:
        self._shrink()
        return pd.DataFrame({"a": fp[self.u[0]], "b": fp[self.v[0]]})


def near_by_key(key: np.ndarray, fp: np.ndarray, radius: int, links: _Links, rows: int = 64) -> None:
    """Link rows of equal `key` within `radius`; rows are ordered by key, then by population count.

    All rows are cut into tiles of `rows`, whatever their keys.  A tile is compared with itself, and with a later one
    if a key goes on from its last row to that one's first and their population counts do not differ beyond the radius.
    """
    n = -len(fp) % rows
    bits = np.append(fp, np.zeros(n, fp.dtype)).view(np.uint64).reshape(-1, rows)
    key = np.append(key, -1 - np.arange(n)).reshape(-1, rows)  # rows that fill up the last tile have keys of their own
    count = np.bitwise_count(bits).astype(np.int16)
    live, step = np.arange(len(bits)), 0
    while len(live):
        for i in range(0, len(live), 512):
            a = live[i : i + 512]
            near = np.bitwise_count(bits[a][:, :, None] ^ bits[a + step][:, None, :]) <= radius
            near &= key[a][:, :, None] == key[a + step][:, None, :]
            tile, u, v = np.nonzero(near)
            u, v = a[tile] * rows + u, (a[tile] + step) * rows + v
            links.add(u[u < v], v[u < v])
        step += 1
        live = live[live + step < len(bits)]
        live = live[(key[live, -1] == key[live + step, 0]) & (count[live + step, 0] - count[live, -1] <= radius)]


def near_in_tiles(a: np.ndarray, b: np.ndarray | None, radius: int, rows: int = 256) -> pd.DataFrame:
    """Spanning links among the rows of tile `a`, or between tiles `a` and `b`."""
    fp = a if b is None else np.concatenate([a, b])
    left, right, at = a.view(np.uint64), (a if b is None else b).view(np.uint64), 0 if b is None else len(a)
    links = _Links(len(fp))
    for i in range(0, len(left), rows):
        near = np.bitwise_count(left[i : i + rows, None] ^ right[None, :]) <= radius
        u, v = np.nonzero(near)
        links.add(u + i, v + at)
    return links.result(fp)


def _bands(radius: int, inside: int = 0) -> list[int]:
    """Masks that have all bits of `inside` and one part each of the others: fingerprints within `radius` agree under one."""
    free, n = [b for b in range(64) if not inside >> b & 1], radius + 1
    return [inside | sum(1 << b for b in free[len(free) * i // n : len(free) * (i + 1) // n]) for i in range(n)]


def _masks(masks: list[int], first: int) -> Column:
    """An array of structs of each mask and its number, from `first` on."""
    return F.array(*[F.struct(F.lit(first + i).alias("band"), F.lit(m - (m >> 63 << 64)).cast("long").alias("mask")) for i, m in enumerate(masks)])


def _banded(rows: DataFrame, masks: Column) -> DataFrame:
    """``fp, band, value``: a row for each of `masks`."""
    return rows.select("fp", F.explode(masks).alias("m")).select("fp", "m.band", F.col("fp").bitwiseAND(F.col("m.mask")).alias("value"))


def near_links(prints: DataFrame, radius: int = 3, tile: int = 2048, dense: int = 8) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints (column ``fp``) that connect all within `radius` of each other.

    The rows of a band's value are compared in one task up to `tile` of them, and as pairs of tiles, each a group of its own, up to
    `dense` times as many.  Beyond that they are banded once more, on the bits that the band leaves: fingerprints
    within the radius agree on one of those parts too.  So the work a fingerprint makes does not grow with the table
    until values of both bands together (28 bits, for radius 3) are shared by more than a tile.
    """
    outer, n = _bands(radius), radius + 1
    banded = _banded(prints, _masks(outer, 0))
    crowd = materialize(banded.groupBy("band", "value").count().filter(F.col("count") > tile), "simhash-large")
    small, large = banded, None
    if not crowd.isEmpty():
        small = banded.join(crowd, ["band", "value"], "left_anti")
        large = banded.join(crowd, ["band", "value"])
        deep = crowd.filter(F.col("count") > dense * tile)
        if not deep.isEmpty():
            large = large.filter(F.col("count") <= dense * tile)
            inner = F.array(*[_masks(_bands(radius, m), n + i * n) for i, m in enumerate(outer)])
            again = materialize(_banded(banded.join(deep, ["band", "value"]), F.get(inner, F.col("band"))), "simhash-inner")
            crowd = materialize(again.groupBy("band", "value").count().filter(F.col("count") > tile), "simhash-large")
            small = small.unionByName(again.join(crowd, ["band", "value"], "left_anti"))
            large = large.unionByName(again.join(crowd, ["band", "value"]))

    def in_order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in batches:  # rows of one value can go on in the next batch; there are `tile` of them at most
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            band, value = pdf["band"].to_numpy(), pdf["value"].to_numpy()
            new = np.concatenate([[True], (band[1:] != band[:-1]) | (value[1:] != value[:-1])])
            cut = int(np.nonzero(new)[0][-1])
            held = pdf.iloc[cut:]
            if cut:
                fp, links = pdf["fp"].to_numpy()[:cut], _Links(cut)
                near_by_key(np.cumsum(new)[:cut], fp, radius, links)
                yield links.result(fp)
        if held is not None:
            fp, links = held["fp"].to_numpy(), _Links(len(held))
            near_by_key(np.zeros(len(fp), np.int64), fp, radius, links)
            yield links.result(fp)

    def tiles(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf["own"].to_numpy()
        fp, first = pdf["fp"].to_numpy(), own == pdf["ta"].to_numpy()
        if pdf["ta"].iloc[0] == pdf["tb"].iloc[0]:
            return near_in_tiles(fp, None, radius)
        return near_in_tiles(fp[first], fp[~first], radius) if first.any() and not first.all() else pd.DataFrame({"a": [], "b": []}, dtype="int64")

    out = None
    if large is not None:
        count = F.bit_count("fp")
        many = F.ceil(F.col("count") / (2.0 * tile)).cast("long")
        own = count * many + F.pmod(F.xxhash64(F.lit("tile"), "fp"), many)
        cut = large.select("band", "value", "fp", own.alias("own"), F.explode(F.sequence((count - radius) * many, (count + radius + 1) * many - 1)).alias("other"))
        cut = cut.select("band", "value", "fp", "own", F.least("own", "other").alias("ta"), F.greatest("own", "other").alias("tb"))
        out = cut.groupBy("band", "value", "ta", "tb").applyInPandas(tiles, "a long, b long")
    ordered = small.repartition("band", "value").sortWithinPartitions("band", "value", F.bit_count("fp")).mapInPandas(in_order, "a long, b long")
    return ordered if out is None else ordered.unionByName(out)


def told(rows: DataFrame, key: str, table: DataFrame, salts: int = 32) -> DataFrame:
    """`rows` with the columns of `table` (unique by `key`) for their `key`; a key that very many rows have is spread over `salts` groups."""
    rows = rows.withColumn("salt", salt_of(F.struct(*rows.columns), salts))
    asked = rows.groupBy(key, "salt").agg(F.lit(0).alias("one")).drop("one").join(table, key)
    return rows.join(asked, [key, "salt"], "left").drop("salt")


def connected(links: DataFrame) -> DataFrame:
    """``v, label`` for each end of a link: label is the smallest end that v can reach."""
    both = materialize(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    label = materialize(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("low")).select("v", F.least("v", "low").alias("label")), "labels")
    total = None
    while True:
        # labels only ever fall, so an unchanged sum means that none changed
        now = label.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if now == total:
            return label
        total = now
        next_ = told(both, "b", label.withColumnRenamed("v", "b")).groupBy(F.col("a").alias("v")).agg(F.min("label").alias("low"))
        lower = label.join(next_, "v", "left").select("v", F.least("label", "low").alias("label"))
        top = told(lower, "label", lower.select(F.col("v").alias("label"), F.col("label").alias("top")))
        label = materialize(top.select("v", F.coalesce("top", "label").alias("label")), "labels", done=[label])


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 3,
    radius: int = 3,
    salts: int = 32,
    tile: int = 2048,
    dense: int = 8,
    seed: int = 42,
) -> DataFrame:
    """One row per row of `docs`: ``doc_id, fingerprint`` (16 hex digits), ``component_id`` (the smallest id reachable)."""
    rows = materialize(fingerprint_table(docs, id_col, text_col, width, seed).withColumn("salt", salt_of(F.col("doc_id"), salts)), "simhash-rows")
    by_salt = rows.groupBy("fp", "salt").agg(F.min("doc_id").alias("first"))
    prints = materialize(by_salt.groupBy("fp").agg(F.min("first").alias("first"), F.bit_or(salt_mask(F.col("salt"))).alias("mask")), "simhash-prints")
    links = materialize(near_links(prints.select("fp"), radius, tile, dense), "simhash-links")
    least = prints.withColumnRenamed("first", "component_id")
    if not links.isEmpty():
        label = connected(links)
        linked = label.join(prints, F.col("v") == F.col("fp")).select("v", "label", "first")
        lowest = linked.groupBy("label").agg(F.min("first").alias("low"))
        found = told(linked, "label", lowest, salts).select("v", "low")
        least = prints.join(found, F.col("fp") == F.col("v"), "left").select("fp", "mask", F.coalesce("low", "first").alias("component_id"))
    least = least.select("fp", "component_id", F.explode(salts_in(F.col("mask"), salts)).alias("salt"))
    null = F.lit(NULL_ID)
    return rows.join(least, ["fp", "salt"]).select(F.nullif("doc_id", null).alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.nullif("component_id", null).alias("component_id"))
