"""Language identification with a bidirectional gated recurrent network over bytes.

The network is trained here, in numpy, by backpropagation through time.  Two gated recurrent layers read the
bytes of a text, one from each end; at every position (letters, digits, blanks and all else) a softmax over
both states labels the byte.  A document's probabilities are the mean over all positions of its whole text.

States run over words and lines.  So that one long text is read in bounded memory and many rows at once, texts are
read in windows of WINDOW bytes; in each, both layers begin CONTEXT bytes further out, and only the window's own
positions count.  A text of one window is read as a whole.

Training takes a bounded sample: at most `docs_per_lang` labelled documents a language (those with the smallest hash
of their id) and, of each, at most `pieces` pieces of PIECE bytes, from places all over the text.  Everything else
covers all rows and whole texts.

Defined results: a null text, an empty one and one without a letter are ``und`` with score 0; so are all
rows if there is nothing to learn from.  A null language is not learned, nor is a row with a null `trained`.  Rows
with the same id are separate rows; they go to the same side of the split.  An empty table gives no rows.  Other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import doc_id

UNKNOWN = "und"

#: Bytes that are labelled together, and how much further out the states begin.
WINDOW, CONTEXT = 512, 32

#: Bytes of a training piece.
PIECE = 64

#: A network has a label for each language; there are no more than this.
MOST_LANGUAGES = 1000

#: Positions times labels that are held at once.
_ROOM = 1 << 21


def normal(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "replace")


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class BiGRU:
    """Parameters by name; a layer is ``x`` (input by byte: update, reset and candidate) and ``u`` (state to the same)."""

    def __init__(self, labels: list[str], hidden: int = 8, seed: int = 0) -> None:
        rng = np.random.default_rng(seed)
        self.labels, self.hidden, self.floor = labels, hidden, 0.0
        self.p = {"out": rng.normal(0, 0.3, (2 * hidden, len(labels))), "bias": np.zeros(len(labels))}
        for d in "fb":
            self.p |= {f"x{d}": rng.normal(0, 0.3, (256, 3 * hidden)), f"u{d}": rng.normal(0, 0.3, (hidden, 3 * hidden))}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _read(self, x: np.ndarray, mask: np.ndarray | None, d: str, keep: list | None = None) -> np.ndarray:
        """States at every position of the byte rows `x` (position x row x state); `keep` gets what backpropagation needs."""
        k, dtype = self.hidden, self.p["out"].dtype
        into, u = self.p[f"x{d}"], self.p[f"u{d}"]
        h = np.zeros((len(x), k), dtype)
        out = np.empty((x.shape[1], len(x), k), dtype)
        for t in range(x.shape[1]) if d == "f" else reversed(range(x.shape[1])):
            a, s = into[x[:, t]], h @ u
            g = _sigmoid(a[:, : 2 * k] + s[:, : 2 * k])
            z, r, s = g[:, :k], g[:, k:], s[:, 2 * k :]
            n = np.tanh(a[:, 2 * k :] + r * s)
            new = n + z * (h - n)
            m = None
            if mask is not None:
                m = mask[:, t, None]
                new = np.where(m, new, h)
            if keep is not None:
                keep.append((t, h, z, r, s, n, m))
            h = out[t] = new
        return out

    def _add_logits(self, x: np.ndarray, mask: np.ndarray | None, d: str, e: np.ndarray) -> None:
        """Add to `e` (position x row x label) what the states of one layer say; `x` and `mask` are position x row.

        The same states as those of `_read`, in arrays that are used again at each position.
        """
        k, u, into = self.hidden, self.p[f"u{d}"], self.p[f"x{d}"]
        half = np.float32(0.5)
        gates, cand, u_gates, u_cand = into[:, : 2 * k] * half, into[:, 2 * k :].copy(), u[:, : 2 * k] * half, u[:, 2 * k :].copy()
        out = self.p["out"][:k] if d == "f" else self.p["out"][k:]
        rows = x.shape[1]
        h, g, s, n, sn = (np.zeros((rows, w), np.float32) for w in (k, 2 * k, 2 * k, k, k))
        says = np.empty((rows, e.shape[2]), np.float32)
        z, r = g[:, :k], g[:, k:]
        for t in range(len(x)) if d == "f" else reversed(range(len(x))):
            np.take(gates, x[t], axis=0, out=g, mode="clip")
            np.take(cand, x[t], axis=0, out=n, mode="clip")
            g += np.matmul(h, u_gates, out=s)
            np.tanh(g, out=g)
            g *= half
            g += half
            np.matmul(h, u_cand, out=sn)
            sn *= r
            n += sn
            np.tanh(n, out=n)
            if mask is None:
                h -= n
                h *= z
                h += n
            else:
                np.copyto(h, n + z * (h - n), where=mask[t][:, None])
            e[t] += np.matmul(h, out, out=says)

    def label(self, x: np.ndarray, mask: np.ndarray | None = None) -> np.ndarray:
        """Probabilities of each label at each position (position x row x label) of the byte rows `x`."""
        x = np.ascontiguousarray(x.T)
        e = np.empty((*x.shape, len(self.labels)), np.float32)
        e[:] = self.p["bias"]
        self._add_logits(x, None, "f", e)  # what follows a row's end does not reach back
        self._add_logits(x, None if mask is None else np.ascontiguousarray(mask.T), "b", e)
        e -= e.max(axis=2, keepdims=True)
        np.exp(e, out=e)
        e /= e.sum(axis=2, keepdims=True)
        return e

    def means(self, texts: list[bytes]) -> np.ndarray:
        """For each text the means over all its positions of the label probabilities, and of the largest of them (zero for an empty text)."""
        sums = np.zeros((len(texts), len(self.labels) + 1))
        rows = []  # text, where the row begins and ends, where its own positions begin and end in it
        for i, t in enumerate(texts):
            for at in range(0, len(t), WINDOW):
                lo, end = max(0, at - CONTEXT), min(len(t), at + WINDOW)
                rows.append((min(len(t), end + CONTEXT) - lo, i, lo, at - lo, end - lo))
        rows.sort()
        most = max(1, _ROOM // ((WINDOW + 2 * CONTEXT) * max(len(self.labels), self.hidden)))
        for j in range(0, len(rows), most):
            part = rows[j : j + most]
            size, i, lo, own, end = (np.array(c) for c in zip(*part))
            wide = int(size[-1])
            x = np.frombuffer(b"".join(texts[r[1]][r[2] : r[2] + r[0]].ljust(wide, b"\0") for r in part), np.uint8).reshape(len(part), wide)
            at = np.arange(wide)[:, None]
            q = self.label(x, None if size[0] == wide else (at < size).T)
            if own.any() or (end < wide).any():
                q *= ((at >= own) & (at < end))[:, :, None]
            np.add.at(sums, i, np.column_stack([q.sum(axis=0), q.max(axis=2).sum(axis=0)]))
        return sums / np.maximum(1, np.array([len(t) for t in texts]).reshape(-1, 1))

    def loss(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over all positions, and its gradients by backpropagation through time."""
        kept: dict[str, list] = {"f": [], "b": []}
        both = np.concatenate([self._read(x, mask, d, kept[d]) for d in "fb"], axis=2)
        e = both @ self.p["out"] + self.p["bias"]
        e -= e.max(axis=2, keepdims=True)
        q = np.exp(e)
        q /= q.sum(axis=2, keepdims=True)
        m, n = mask.T, mask.sum()
        loss = -float((np.log(q[:, np.arange(len(y)), y] + 1e-12) * m).sum() / n)
        q[:, np.arange(len(y)), y] -= 1
        q *= (m / n)[:, :, None].astype(q.dtype)
        g = {"out": np.einsum("tbh,tbl->hl", both, q), "bias": q.sum(axis=(0, 1))}
        back, k = q @ self.p["out"].T, self.hidden
        for i, d in enumerate("fb"):
            u = self.p[f"u{d}"]
            gx, gu = np.zeros_like(self.p[f"x{d}"]), np.zeros_like(u)
            dh = np.zeros((len(x), k), q.dtype)
            for t, h, z, r, s, cand, on in reversed(kept[d]):
                dh = dh + back[t][:, i * k : (i + 1) * k]
                dn = np.where(on, dh * (1 - z) * (1 - cand * cand), 0)
                dz = np.where(on, dh * (h - cand) * z * (1 - z), 0)
                dr = dn * s * r * (1 - r)
                np.add.at(gx, x[:, t], np.concatenate([dz, dr, dn], axis=1))
                of_state = np.concatenate([dz, dr, dn * r], axis=1)
                gu += h.T @ of_state
                dh = np.where(on, dh * z, dh) + of_state @ u.T
            g |= {f"x{d}": gx, f"u{d}": gu}
        return loss, g

    def fit(self, own: list[bytes], y: np.ndarray, weight: np.ndarray, steps: int = 300, batch: int = 128, rate: float = 0.015, seed: int = 0) -> "BiGRU":
        """Adam on minibatches drawn by weight."""
        rng = np.random.default_rng(seed)
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        size = np.array([len(w) for w in own])
        x = np.frombuffer(b"".join(w.ljust(PIECE, b"\0") for w in own), np.uint8).reshape(len(own), PIECE)
        for step in range(1, steps + 1):
            at = rng.choice(len(own), batch, p=weight)
            longest = size[at].max()
            mask = np.arange(longest)[None, :] < size[at][:, None]
            _, g = self.loss(x[at, :longest], mask, y[at])
            now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, v in g.items():
                first[k] = 0.9 * first[k] + 0.1 * v
                second[k] = 0.999 * second[k] + 0.001 * v * v
                self.p[k] -= (now * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self

    def calibrate(self, held: list[bytes], low: float = 0.001) -> "BiGRU":
        """Set `floor`: halfway from chance to how sure the labels of all but a share `low` of these pieces are, on the mean.

        Below it a text of at least one piece's length is in no learned language.  One in several learned languages is
        sure of each position, so it is not below.
        """
        chance = 1 / len(self.labels)
        self.floor = chance + 0.5 * (float(np.quantile(self.means(held)[:, -1], low)) - chance) if len(held) else 0.0
        return self


def pieces_of(raw: bytes, most: int) -> list[bytes]:
    """At most `most` pieces of PIECE bytes: all that lie side by side, or as many from hashed places."""
    n = max(1, -(-len(raw) // PIECE))
    if n <= most:
        return [raw[i * PIECE : (i + 1) * PIECE] for i in range(n) if raw]
    at = {xxhash.xxh64_intdigest(raw[:PIECE], i) % (len(raw) - PIECE + 1) for i in range(most)}
    return [raw[i : i + PIECE] for i in sorted(at)]


def train(docs: DataFrame, trained: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_per_lang: int = 400, pieces: int = 12, steps: int = 300, seed: int = 0) -> BiGRU | None:
    """Fit the network on a bounded sample of the rows where `trained` is true; None if there is nothing to learn from.

    Every fifth document of the sample is kept back for the floor of the scores.
    """
    draw = F.xxhash64(F.lit(seed), doc_id(id_col))
    own = docs.select(F.col(lang_col).cast("string").alias("lang"), draw.alias("draw"), F.col(text_col).alias("text"), trained.alias("trained")).filter("trained and lang is not null")
    # how many rows a language has tells how small a hash must be, so that little more than the sample is shuffled
    counted = own.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(counted) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not counted:
        return None
    share = F.create_map(*[F.lit(x) for r in counted for x in (r["lang"], min(1.0, 2.0 * docs_per_lang / r["n"]))])
    some = own.filter(F.pmod("draw", F.lit(1 << 30)) < F.element_at(share, F.col("lang")) * (1 << 30))
    by = W.partitionBy("lang").orderBy("draw", F.xxhash64("text"))
    some = some.select("lang", "draw", "text", F.row_number().over(by).alias("rank")).filter(F.col("rank") <= docs_per_lang).select("lang", "text", "rank")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(lang, rank % 5 == 0, p) for lang, rank, text in zip(pdf["lang"], pdf["rank"].tolist(), pdf["text"]) for p in pieces_of(normal(text if isinstance(text, str) else None), pieces)]
            yield pd.DataFrame(rows, columns=["lang", "held", "piece"])

    few = some.mapInPandas(cut, "lang string, held boolean, piece binary").toPandas()  # docs_per_lang * pieces * PIECE bytes a language at most
    fit = few[~few["held"].astype(bool)]
    if not len(fit):
        return None
    labels = sorted(fit["lang"].unique())
    held = few[few["held"].astype(bool) & few["lang"].isin(labels) & (few["piece"].map(len) == PIECE)]
    number = {k: i for i, k in enumerate(labels)}
    # in one order, so that results do not hang on that of the rows
    fit = fit.assign(piece=[bytes(p) for p in fit["piece"]]).sort_values(["lang", "piece"], ignore_index=True)
    y = fit["lang"].map(number).to_numpy()
    weight = 1 / np.bincount(y)[y] / len(labels)
    net = BiGRU(labels, seed=seed).fit(list(fit["piece"]), y, weight, steps=steps, seed=seed)
    return net.calibrate([bytes(p) for p in held["piece"]])


def _label_texts(net: BiGRU, batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        langs, scores, sure = [UNKNOWN] * len(batch), np.zeros(len(batch)), np.zeros(len(batch))
        held: list[tuple[int, bytes]] = []
        size = 0
        for i, t in enumerate(batch):
            if isinstance(t, str) and has_letter(t):
                held.append((i, normal(t)))
                size += len(held[-1][1])
            if held and (size >= 1 << 20 or i == len(batch) - 1):
                means = net.means([raw for _, raw in held])
                q = means[:, :-1]
                for (k, _), best, score, each in zip(held, q.argmax(axis=1).tolist(), q.max(axis=1).tolist(), means[:, -1].tolist()):
                    langs[k], scores[k], sure[k] = net.labels[best], min(1.0, score), each
                held, size = [], 0
        yield pd.DataFrame({"lang_pred": langs, "score": scores, "sure": sure})


def predictor(net: BiGRU):
    """A column function of a text: the label with the largest mean probability over all its positions, that mean, and how sure each position is."""

    @F.pandas_udf("lang_pred string, score double, sure double")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from _label_texts(net, batches)

    return label


def in_learned_language(net: BiGRU, text: Column) -> Column:
    """False for texts without a letter, and for those of a piece's length at least whose labels are less sure than the floor."""
    guess = predictor(net)(F.coalesce(text, F.lit("")))
    return (guess["lang_pred"] != UNKNOWN) & ((guess["sure"] >= net.floor) | (F.octet_length(text) < PIECE))


def predict(docs: DataFrame, net: BiGRU | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score``."""
    rows = docs.select(doc_id(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if net is None:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    return rows.select("doc_id", predictor(net)(F.col("text")).alias("x")).select("doc_id", "x.lang_pred", "x.score")


def identify(docs: DataFrame, trained: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **how) -> DataFrame:
    """Train on the rows where `trained` is true, then predict every row: ``doc_id, lang_pred, score``."""
    return predict(docs, train(docs, trained, id_col, text_col, lang_col, **how), id_col, text_col)
