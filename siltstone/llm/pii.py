"""Personal data: span candidates, boosted trees, calibrated thresholds.  DataFrame functions only.

1. Generators propose spans, with high recall.  Four are the base patterns (email, ip, card, phone); the
   rest look for what those miss: spelt-out addresses, numbers without a plus, short card numbers, IPv6,
   identity numbers, secrets.  Spans of different generators may overlap.
2. Every candidate gets format features (digits, separators, check sums, ...) and context features (cue
   words before it, what it touches).
3. Boosted trees score the candidates; they become CASE expressions.  What they learn from is planted: true spans
   of each kind and look-alikes (order and part numbers, hardware addresses, placeholders, numbers whose check
   digit is wrong), each behind a phrase of a template and between the left and right contexts of real
   candidates.  At most `sample` contexts are drawn, those with the smallest hash of what they are.
4. A threshold for each kind is calibrated on the templates that the trees have not seen: the lowest with at least
   `precision`.  A kind for which there is none goes by its format's own rules.  Base spans that pass their own
   check always stay; others stay if they reach the threshold and overlap no base span and no accepted one before
   them.

So a document's spans depend on the table only through that sample of contexts, and not on how rows are dealt out.

Patterns are written so that they take linear time: quantifiers are possessive and a match cannot start
in the middle of a run of its own characters, unless the last match ended there.

Texts are read once.  What leaves that scan is the candidates with a little context; positions (code
points) are running sums over a document's candidates.

Defined results: a null text is empty and has no spans.  Repeated rows each get their own result.  An
empty table gives no rows.  Other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import doc_id, materialize

#: Kinds in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone", "ssn", "secret")

CONTEXT = 24


@dataclass(frozen=True)
class Generator:
    name: str
    kind: str
    pattern: str
    #: A cheap test that a text must pass before the pattern is tried.
    hint: str
    base: bool = False


GENERATORS = (
    Generator("email", "email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", True),
    Generator("ip", "ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", True),
    Generator("card", "card", r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9]){11,}+", r"[0-9](?:[\x20-]?[0-9]){11}", True),
    Generator("phone", "phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", True),
    Generator("spelt_email", "email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]{1,63}+){1,8}+", r"[\[(]at[\])]"),
    Generator("local_phone", "phone", r"(?<![0-9A-Za-z+.-])(?:[0-9]{1,3}[\x20.-])?(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])", r"[0-9]{3}[\x20.-][0-9]{4}"),
    Generator("ipv6", "ip", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])", r":[0-9A-Fa-f]{1,4}:[0-9A-Fa-f]{1,4}:"),
    Generator("ssn", "ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
    Generator("secret", "secret", r"(?<![A-Za-z])(?:password|passwd|token|secret|api_?key)\x20{0,2}[=:]\x20{0,2}[\x22']?[A-Za-z0-9+/_.-]{6,256}+[\x22']?", r"(?:password|passwd|token|secret|api_?key)\x20{0,2}[=:]"),
)

#: Cue words that a candidate's left context may hold; `other` are those of numbers that are nobody's.
CUES = {
    "phone": "tel|phone|call|fax|mobil|numero",
    "card": "card|visa|karte|carte|tarjeta|iban",
    "email": "mail|contact|write|kontakt",
    "ip": "ip|host|addr|server",
    "ssn": "ssn|social",
    "other": "order|invoice|serial|part|version|item|track|isbn|model|total|mac|finger|batch|article|rechnung|bestell|facture|commande|pedido|factura|sku|lot",
}

#: Characters before a candidate in which a cue counts as near.
NEAR = 16

#: Phrases before planted spans (true) and look-alikes (false) of each generator.  Every third one is kept
#: for calibration.
TEMPLATES = {
    ("local_phone", True): ("call", "tel.", "my phone:", "fax", "mobile", "Telefon", "llame al numero", "tel:", ""),
    ("local_phone", False): ("order", "part no.", "serial", "item", "invoice", "track", "Rechnung", "facture", "pedido", "sku"),
    ("card", True): ("card", "visa", "my card number", "carte", "Karte", "tarjeta", "charge card", ""),
    ("card", False): ("order", "tracking", "invoice", "serial", "Bestellung", "commande", "lot", "batch", "model"),
    ("ssn", True): ("ssn", "social security", "her ssn is", "my social:", "ssn:", ""),
    ("ssn", False): ("part", "item", "model", "serial", "article", "lot", "order", "batch", "sku"),
    ("secret", True): ("", "set", "the", "my", "use", "export"),
    ("secret", False): ("", "set", "the", "my", "use", "export"),
    ("spelt_email", True): ("mail", "write to", "contact", "", "Kontakt", "e-mail:"),
    ("ipv6", True): ("ip", "host", "server", "", "addr", "from"),
    ("ipv6", False): ("mac", "fingerprint", "serial", "mac:", "finger", "model"),
    ("ip", False): ("version", "", "item", "order", "part", "model"),
    ("phone", False): ("order", "", "item", "version", "total", "part"),
}


def _planted_span(name: str, true: bool, rng: np.random.Generator) -> str:
    """A span of a generator's form.  False ones are look-alikes by their context, by a wrong check digit or by being a placeholder."""
    d = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    word = lambda n: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), n))
    if name == "local_phone":
        a, b, c = str(rng.integers(201, 990)), d(3), d(4)
        return [f"{a}-{b}-{c}", f"({a}) {b}-{c}", f"{a} {b} {c}", f"1 {a}.{b}.{c}"][rng.integers(0, 2 if true else 4)] if true or rng.random() < 0.7 else f"000-{b}-{c}"
    if name == "card":
        n = int(rng.integers(13, 16))
        raw = str(rng.integers(3, 7)) + d(n - 2)
        check = sum(sum(divmod(int(x) * (2 - i % 2), 10)) for i, x in enumerate(reversed(raw)))
        return raw + str((-check + (0 if true or rng.random() < 0.5 else int(rng.integers(1, 10)))) % 10)
    if name == "ssn":
        return f"{rng.integers(1, 666):03}-{rng.integers(1, 100):02}-{rng.integers(1, 10000):04}" if true or rng.random() < 0.5 else f"000-{d(2)}-{d(4)}"
    if name == "secret":
        value = "".join(rng.choice(list("0123456789abcdefABCDEF"), rng.integers(16, 41))) if true else word(int(rng.integers(6, 12)))
        return f"{rng.choice(['token', 'password', 'secret', 'api_key'])}{rng.choice([' = ', '=', ': '])}" + (f'"{value}"' if rng.random() < 0.5 else value)
    if name == "spelt_email":
        return f"{word(5)} [at] {word(7)} [dot] {rng.choice(['com', 'org', 'net'])}"
    if name == "ipv6":
        return ":".join(f"{x:04x}" if true else f"{x % 256:02x}" for x in rng.integers(0, 65536, 8))
    if name == "ip":
        return f"{rng.integers(256, 999)}.{rng.integers(0, 99)}.{rng.integers(0, 99)}.{rng.integers(0, 99)}"
    return "+" + d(int(rng.integers(3, 8)))


def planted(contexts: list[tuple[str, str]], each: int = 40, seed: int = 0) -> list[tuple[str, str, str, str, bool, bool]]:
    """``name, match, left, right``, whether it is true, and whether it is kept for calibration: `each` rows a template."""
    rng, out = np.random.default_rng(seed), []
    contexts = contexts or [("", "")]
    for (name, true), phrases in TEMPLATES.items():
        for i, phrase in enumerate(phrases):
            for _ in range(each):
                left, right = contexts[rng.integers(0, len(contexts))]
                match = _planted_span(name, true, rng)
                out.append((name, match, f"{left.rstrip('0123456789+')} {phrase} "[-CONTEXT:], f" {right}"[:CONTEXT], true, i % 3 == 2))
    return out


def _hinted(text: Column, hint: str) -> Column:
    return F.contains(text, F.lit(hint)) if len(hint) == 1 else text.rlike(hint)


def _found(text: Column, g: Generator) -> Column:
    """An array with, for each match: the length of the gap before it, the match and its context."""
    matches = F.regexp_extract_all(text, F.lit(g.pattern), F.lit(0))
    gaps = F.split(text, g.pattern, -1)
    after = F.slice(gaps, 2, F.greatest(F.size(gaps) - 1, F.lit(0)))
    gap = F.zip_with(gaps, after, lambda a, b: F.struct(F.length(a).alias("gap"), F.right(a, F.lit(CONTEXT)).alias("left"), F.left(b, F.lit(CONTEXT)).alias("right")))
    all_ = F.zip_with(matches, gap, lambda m, x: F.struct(x["gap"].alias("gap"), m.alias("match"), x["left"].alias("left"), x["right"].alias("right")))
    kind = "array<struct<gap:int,match:string,left:string,right:string>>"
    return F.when(_hinted(text, g.hint), F.filter(all_, lambda x: x["match"].isNotNull())).otherwise(F.array().cast(kind)).alias(g.name)


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, r"[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True for digit strings whose Luhn sum is a multiple of ten."""
    each = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda d: d != ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, d: a + d) % 10 == 0


def _octets(c: Column) -> Column:
    part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
    return F.forall(F.split(c, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.lpad(part(p), 3, "0") <= "255"))


def base_valid(name: Column, match: Column) -> Column:
    """Whether a base pattern's match passes its own check; null for other generators."""
    d = _digits(match)
    n = F.length(d)
    return (
        F.when(name == "email", F.lit(True))
        .when(name == "ip", _octets(match))
        .when(name == "card", F.when(n.between(16, 19), luhn(d)).otherwise(F.lit(False)))
        .when(name == "phone", n.between(8, 15))
    )


def _by_format(name: Column, match: Column) -> Column:
    """What a format's own rules say of a candidate."""
    d = _digits(match)
    n = F.length(d)
    return F.coalesce(
        F.when(name == "card", n.between(13, 19) & F.when(n <= 19, luhn(d)).otherwise(F.lit(False)) & match.rlike("^[3-6]")),
        base_valid(name, match),
        F.when(name == "ssn", ~match.rlike("^(?:000|666|9)") & ~match.rlike("-00-") & ~match.rlike("0000$")),
        F.when(name == "secret", match.rlike(r"[=:].*[0-9]") & match.rlike(r"[=:].*[A-Za-z]") & (F.length(match) >= 14)),
        F.when(name == "local_phone", n.between(10, 13) & ~match.rlike(r"^[01]{3}")),
        F.lit(True),
    )


def _features(c: DataFrame) -> dict[str, Column]:
    m, left = F.col("match"), F.lower("left")
    d = _digits(m)
    n = F.length(d)
    out = {f"is_{g.name}": (F.col("name") == g.name) for g in GENERATORS}
    out |= {
        "chars": F.length(m),
        "digits": n,
        "separators": F.length(F.regexp_replace(m, r"[A-Za-z0-9]", "")),
        "letters": F.length(F.regexp_replace(m, r"[^A-Za-z]", "")),
        "luhn": F.when(n.between(12, 19), luhn(d)).otherwise(F.lit(False)),
        "octets": F.when(F.col("name") == "ip", _octets(m)).otherwise(F.lit(False)),
        "first_digit": F.coalesce(F.substring(d, 1, 1).try_cast("int"), F.lit(-1)),
        "format": _by_format(F.col("name"), m),
        "touches_left": F.col("left").rlike("[A-Za-z0-9]$"),
        "touches_right": F.col("right").rlike("^[A-Za-z0-9]"),
        "distinct": F.size(F.array_distinct(F.split(F.substring(m, 1, 64), ""))),
    }
    out |= {f"cue_{k}": left.rlike(f"(?:{p})") for k, p in CUES.items()}
    out |= {f"near_{k}": F.right(left, F.lit(NEAR)).rlike(f"(?:{p})") for k, p in CUES.items()}
    return {k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in out.items()}


# --- boosted trees, fitted in numpy on the bounded sample


@dataclass
class Node:
    value: float = 0.0
    feature: int = -1
    cut: float = 0.0
    low: "Node | None" = None
    high: "Node | None" = None


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, cuts: list[np.ndarray], depth: int, rate: float) -> Node:
    node = Node(value=rate * g.sum() / (h.sum() + 1.0))
    best, gain = None, 1e-6
    if depth and len(g) >= 20:
        whole = g.sum() ** 2 / (h.sum() + 1.0)
        for f in range(x.shape[1]):
            for cut in cuts[f]:
                low = x[:, f] <= cut
                if 5 <= low.sum() <= len(g) - 5:
                    now = g[low].sum() ** 2 / (h[low].sum() + 1.0) + g[~low].sum() ** 2 / (h[~low].sum() + 1.0) - whole
                    if now > gain:
                        best, gain = (f, float(cut)), now
    if best:
        low = x[:, best[0]] <= best[1]
        node.feature, node.cut = best
        node.low = _grow(x[low], g[low], h[low], cuts, depth - 1, rate)
        node.high = _grow(x[~low], g[~low], h[~low], cuts, depth - 1, rate)
    return node


def _apply(node: Node, x: np.ndarray) -> np.ndarray:
    if node.feature < 0:
        return np.full(len(x), node.value)
    return np.where(x[:, node.feature] <= node.cut, _apply(node.low, x), _apply(node.high, x))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 20, depth: int = 3, rate: float = 0.4) -> list[Node]:
    """Gradient boosting with logistic loss and second-order leaf values."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, 12)))[:-1] if len(x) else np.zeros(0) for f in range(x.shape[1])]
    score, out = np.zeros(len(y)), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        out.append(_grow(x, y - p, p * (1 - p), cuts, depth, rate))
        score += _apply(out[-1], x)
    return out


def _as_sql(node: Node, names: list[str]) -> str:
    if node.feature < 0:
        return f"{node.value:.8f}D"
    return f"CASE WHEN {names[node.feature]} <= {node.cut!r}D THEN {_as_sql(node.low, names)} ELSE {_as_sql(node.high, names)} END"


def calibrate(score: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The lowest threshold from which on at least `precision` of the candidates are right; infinite if there is none.

    It lies halfway between the lowest score that stays and the next below; where all stay, at even odds or at the lowest.
    """
    order = np.argsort(-score, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    last = np.append(np.diff(score[order]) != 0, True) if len(y) else np.zeros(0, bool)  # equal scores go together
    ok = np.nonzero((right >= precision) & last)[0]
    if not len(ok):
        return float("inf")
    low = float(score[order][ok[-1]])
    return (low + float(score[order][ok[-1] + 1])) / 2 if ok[-1] + 1 < len(y) else min(0.0, low)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 2_000, precision: float = 0.98) -> DataFrame:
    """One row per row of `docs`: ``doc_id, row, spans``; a span is ``kind_no, start, end, base, score``, in order."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    one = docs.select(doc_id(id_col).alias("doc_id"), text.alias("text"))
    scanned = materialize(one.select("doc_id", F.monotonically_increasing_id().alias("row"), *[_found(F.col("text"), g) for g in GENERATORS]), "pii-candidates")

    listed = F.array(*[F.struct(F.lit(g.name).alias("name"), F.lit(KINDS.index(g.kind)).alias("kind_no"), F.col(g.name).alias("found")) for g in GENERATORS])
    some = scanned.filter(" or ".join(f"size({g.name}) > 0" for g in GENERATORS))
    each = some.select("row", F.explode(listed).alias("x")).select("row", "x.name", "x.kind_no", F.posexplode("x.found").alias("place", "y")).select("row", "name", "kind_no", "place", "y.gap", "y.match", "y.left", "y.right")
    upto = F.sum(F.col("gap") + F.length("match")).over(W.partitionBy("row", "name").orderBy("place").rowsBetween(W.unboundedPreceding, W.currentRow))
    each = each.withColumn("end", upto).withColumn("start", F.col("end") - F.length("match"))
    each = each.withColumn("base", F.coalesce(base_valid(F.col("name"), F.col("match")), F.lit(False)))
    features = _features(each)
    names = list(features)
    known = materialize(each.select("row", "name", "kind_no", "start", "end", "base", "left", "right", *[v.alias(k) for k, v in features.items()]), "pii-features")

    drawn = known.select("left", "right").orderBy(F.xxhash64("left", "right"), "left", "right").limit(sample).collect()
    rows = planted([(r["left"], r["right"]) for r in drawn])
    plants = docs.sparkSession.createDataFrame(rows, "name string, match string, left string, right string, true boolean, held boolean")
    learned = plants.select("name", "true", "held", *[v.alias(k) for k, v in _features(plants).items()]).collect()
    x = np.array([[r[k] for k in names] for r in learned], dtype=float)
    y = np.array([r["true"] for r in learned], dtype=float)
    held = np.array([r["held"] for r in learned], dtype=bool)
    of_kind = {g.name: KINDS.index(g.kind) for g in GENERATORS}
    kind = np.array([of_kind[r["name"]] for r in learned], dtype=int)
    trees = fit_trees(x[~held], y[~held])
    score = sum((_apply(t, x) for t in trees), np.zeros(len(y)))
    least = [calibrate(score[held & (kind == k)], y[held & (kind == k)], precision) for k in range(len(KINDS))]

    known = known.withColumn("score", F.expr(" + ".join(_as_sql(t, names) for t in trees)))
    threshold = F.element_at(F.array(*[F.lit(t if np.isfinite(t) else None).cast("double") for t in least]), F.col("kind_no") + 1)
    spans = known.select("row", "name", "kind_no", "start", "end", "base", "score", F.coalesce(F.col("score") >= threshold, F.col("format") > 0).alias("taken")).filter(F.col("base") | F.col("taken"))
    # other spans must not overlap a base span, nor an earlier other one
    by = W.partitionBy("row").orderBy("start", "end", "kind_no", "name")
    before, after = by.rowsBetween(W.unboundedPreceding, -1), by.rowsBetween(1, W.unboundedFollowing)
    spans = spans.withColumn("free", F.col("base") | ((F.coalesce(F.max("end").over(before), F.lit(0)) <= F.col("start")) & (F.coalesce(F.min(F.when(F.col("base"), F.col("start"))).over(after), F.col("end")) >= F.col("end"))))
    listed = F.array_sort(F.collect_list(F.struct("kind_no", "start", "end", "base", "score"))).alias("spans")
    per_row = spans.filter("free").groupBy(F.col("row").alias("own")).agg(listed)
    empty = F.array().cast("array<struct<kind_no:int,start:bigint,end:bigint,base:boolean,score:double>>")
    return scanned.select("doc_id", "row").join(per_row, F.col("row") == F.col("own"), "left").select("doc_id", "row", F.coalesce("spans", empty).alias("spans"))


def span_string(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind_no"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``doc_id, text`` with every selected span replaced by its kind in brackets, such as ``[EMAIL]``."""
    found = find_pii(docs, id_col, text_col, **how)
    spans = found.filter(F.size("spans") > 0).select(F.col("doc_id").alias("own"), "spans").dropDuplicates(["own"])
    kinds = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    by_start = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind_no"].alias("kind_no"))))
    # cut the text before each span that does not overlap the last, and put its kind there
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    text = F.col("text")
    step = lambda a, s: F.when(s["start"] >= a["at"], F.struct(s["end"].alias("at"), F.concat(a["out"], F.array(text.substr((a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.element_at(kinds, s["kind_no"] + 1))).alias("out"))).otherwise(a)
    done = F.aggregate(by_start, begin, step, lambda a: F.concat(F.array_join(a["out"], ""), text.substr((a["at"] + 1).cast("int"), F.length(text))))
    one = docs.select(doc_id(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return one.join(spans, F.col("doc_id") == F.col("own"), "left").select("doc_id", F.when(F.col("spans").isNull(), text).otherwise(done).alias("text"))
