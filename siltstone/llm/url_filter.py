"""URL verdicts from rules and a path-template tree.

Rules decide first: a rule is ``host/path``, fits its host and all subdomains, and the longest that fits
wins.  What no rule decides, the tree does:

1. Paths are cut into segments and digits become ``#``; equal paths of a host are then counted together.
2. From the root down, a segment stays literal if it has at least one in `branches` of the rows that
   reached its node; all others become the wildcard ``*``.  So a node has at most ``branches + 1``
   children, and ids and titles fall together.
   The first `depth` segments are looked at in any case, further ones level by level while a node has both
   blocked and allowed rows and more than one path; below any other there is nothing to tell apart.
3. Children of one node whose share of blocked rows does not differ significantly are merged: they get
   one common count.
4. A node's purity is its share of blocked among labelled rows, smoothed towards its parent's with
   `weight` rows; the root's parent is the share over all hosts.  Templates at or above `limit` are
   rejected.

Labels are the rows that rules decided, or any column of one's own.

Only counts by host and path are shuffled, after they were summed up where they were read, so a host
with a third of all pages is some counts from each task.  Verdicts go back by (host, path, salt): a
template that is as hot is spread over `salts` groups.

Defined results: a null url or one without ``://`` has an empty host and path; all of those are one
template.  Without any label all is allowed.  Repeated rows each get the same result.  An empty table
gives no rows.  Other columns are not looked at.
"""

from __future__ import annotations

import itertools
import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_id, materialize, salt_mask, salt_of, salts_in

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and what it says; both null if none fits.  `rules`: (action, ``host/path``)."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, name in sorted(rules, key=lambda r: len(r[1])):  # later ones, the longer, come first
        h, _, p = name.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule, action = F.when(fits, F.lit(name)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(action)
    return rule, action


def _merged(z: float):
    """Merge children of one node (at most branches + 1 rows) whose blocked shares do not differ significantly."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(share=(pdf["bad"] + 1) / (pdf["bad"] + pdf["good"] + 2)).sort_values(["share", "node"], ignore_index=True)
        group, bad, good, at = [], 0, 0, 0
        for b, g in zip(pdf["bad"].tolist(), pdf["good"].tolist()):
            if group and bad + good and b + g:
                p, q = (bad + 1) / (bad + good + 2), (b + 1) / (b + g + 2)
                if abs(p - q) > z * math.sqrt(p * (1 - p) / (bad + good + 2) + q * (1 - q) / (b + g + 2)):
                    at, bad, good = at + 1, 0, 0
            group.append(at)
            bad, good = bad + b, good + g
        sums = pdf.assign(group=group).groupby("group")[["bad", "good"]].transform("sum")
        return pd.DataFrame({"node": pdf["node"], "parent": pdf["parent"], "bad": sums["bad"], "good": sums["good"]})

    return run


def templates(counts: DataFrame, depth: int = 4, branches: int = 32) -> DataFrame:
    """`counts` (``host, shape, bad, good, ...``, with ``n`` rows each) with a column ``nodes``: its template's nodes from the root down."""
    sep = "\u0001"  # no part of a url
    seg = F.filter(F.split("shape", "/"), lambda s: s != "")
    rows = counts.withColumn("seg", seg).withColumn("at", F.col("host")).withColumn("nodes", F.array("host"))
    for d in itertools.count():
        here = F.get("seg", F.lit(d))
        if d >= depth:
            divided = (F.sum("bad") > 0) & (F.sum("good") > 0) & (F.min("shape") != F.max("shape"))
            rows = rows.join(rows.groupBy("at").agg(divided.alias("divided")).filter("divided"), "at", "left")
            here = F.when(F.col("divided"), here)
        rows = materialize(rows.withColumn("here", here).drop("divided"), "url-level")
        if rows.filter("here is not null").isEmpty():
            return rows.drop("seg", "at", "here")
        by_child = rows.filter("here is not null").groupBy("at", "here").agg(F.sum("n").alias("n"))
        total = rows.groupBy("at").agg(F.sum("n").alias("total"))
        literal = by_child.join(total, "at").filter(F.col("n") * branches >= F.col("total")).select("at", "here", F.lit(True).alias("literal"))
        name = F.concat("at", F.lit(sep), F.when(F.col("literal"), F.col("here")).otherwise("*"))
        rows = rows.join(literal, ["at", "here"], "left")
        rows = rows.withColumn("nodes", F.when(F.col("here").isNull(), F.col("nodes")).otherwise(F.concat("nodes", F.array(name))))
        rows = rows.withColumn("at", F.element_at("nodes", -1)).drop("literal", "here")


def template_purity(rows: DataFrame, weight: float = 8.0, z: float = 1.96) -> DataFrame:
    """``node, purity`` of every node; `rows` has ``nodes, bad, good``."""
    # at most one row of sums: the share over all hosts
    all_ = rows.agg(F.sum("bad"), F.sum("good")).first()
    bad, good = int(all_[0] or 0), int(all_[1] or 0)
    prior = bad / (bad + good) if bad + good else 0.0
    pair = F.transform("nodes", lambda n, i: F.struct(n.alias("node"), F.when(i > 0, F.get("nodes", i - 1)).otherwise(F.lit("")).alias("parent"), i.alias("level")))
    each = rows.select(F.explode(pair).alias("x"), "bad", "good").groupBy("x.level", "x.parent", "x.node").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    each = materialize(each, "url-nodes")
    smooth = lambda above: (F.col("bad") + weight * above) / (F.col("bad") + F.col("good") + weight)
    level = each.filter("level = 0").select("node", smooth(F.lit(prior)).alias("purity"))
    out = level
    for d in range(1, int(each.agg(F.max("level")).first()[0] or 0) + 1):
        own = each.filter(F.col("level") == d).groupBy("parent").applyInPandas(_merged(z), "node string, parent string, bad long, good long")
        level = own.join(level.select(F.col("node").alias("parent"), F.col("purity").alias("above")), "parent").select("node", smooth(F.col("above")).alias("purity"))
        level = materialize(level, "url-purity")
        out = out.unionByName(level)
    return out


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    label: Column | None = None,
    depth: int = 4,
    branches: int = 32,
    weight: float = 8.0,
    limit: float = 0.5,
    salts: int = 32,
) -> DataFrame:
    """One row per page: the id, ``host, path, rule, verdict, template, purity``.

    `label` (true: blocked, false: allowed, null: not labelled) defaults to what the rules say.
    """
    url = F.col(url_col)
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    rows = pages.select(doc_id(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), (F.lit(None).cast("boolean") if label is None else label).alias("label"))
    rows = rows.withColumn("rule", rule).withColumn("action", action).withColumn("label", F.coalesce("label", F.col("action") == "block"))
    rows = rows.withColumn("shape", F.regexp_replace("path", "[0-9]+", "#")).withColumn("salt", salt_of(F.col("page_id"), salts))
    rows = materialize(rows, "url-rows")
    sums = [F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("label"), 1)).alias("bad"), F.count(F.when(~F.col("label"), 1)).alias("good")]
    by_salt = rows.groupBy("host", "shape", "salt").agg(*sums)
    counts = by_salt.groupBy("host", "shape").agg(*[F.sum(c).alias(c) for c in ("n", "bad", "good")], F.bit_or(salt_mask(F.col("salt"))).alias("mask"))
    cut = materialize(templates(counts, depth, branches), "url-templates")
    purity = template_purity(cut, weight)
    leaf = cut.select("host", "shape", "mask", F.element_at("nodes", -1).alias("node"))
    known = leaf.join(purity, "node").select("host", "shape", F.translate("node", "\u0001", "/").alias("template"), "purity", F.explode(salts_in(F.col("mask"), salts)).alias("salt"))
    own = F.when(F.col("purity") >= limit, "block").otherwise("allow")
    return rows.join(known, ["host", "shape", "salt"]).select(F.col("page_id").alias(id_col), "host", "path", "rule", F.coalesce("action", own).alias("verdict"), "template", "purity")
