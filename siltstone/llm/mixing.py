"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target in words.  A document of the source is then due ``target / source size``
copies on average (or a share of that by its own weight).  The whole part is certain: that many
copies are taken outright.  The fraction is an inclusion probability p; documents are ranked by

    (U / (1 - U)) / (p / (1 - p))          U: uniform, from a seeded hash of the id

and the front of that order is taken until the source's words are reached: a sample of fixed size,
with unequal probabilities, that reruns draw alike.

No source is ever ordered in one task.  Ranks are first counted in `bins` bins of U's scale (by default so
many that one of the largest source has some BIN_ROWS documents); running
sums over the bins of a source say which bin holds the cut, and only documents in that bin are
ordered one by one.

Defined results: a null text has no words; documents without words are due copies but take no
words.  Null sources form a source of their own, the last one.  Ties in rank go by id, then by size.
A row that occurs twice is two documents with the same rank.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import doc_id, materialize

#: Sources are few; their totals come to the driver if there are no more than this.
MOST_SOURCES = 200_000

#: Expected words are added up in millionths.
MICRO = 1_000_000

#: Documents of the largest source that a bin holds on average, unless it is given how many bins there are.
BIN_ROWS = 20_000

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """Share `total` by weight; shares stop at `most` times their size, the excess goes to the others by weight."""
    out = [0.0] * len(sizes)
    open_ = [i for i in range(len(sizes)) if weights[i] > 0]
    while open_ and total > 0:
        unit = total / sum(weights[i] for i in open_)
        full = [i for i in open_ if unit * weights[i] > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = unit * weights[i]
            break
        for i in full:
            out[i] = most * sizes[i]
            total -= out[i]
        open_ = [i for i in open_ if i not in set(full)]
    return out


def uniform(key: Column, seed: int) -> Column:
    """Uniform in (0, 1), from a hash."""
    return (F.call_function("shiftrightunsigned", F.xxhash64(F.lit(seed), key), F.lit(11)).cast("double") + 0.5) / float(2**53)


def _targets(spark: SparkSession, totals: list, weights: list[float], share: float, most: float) -> DataFrame:
    named = sorted((r for r in totals if r["source"] is not None), key=lambda r: r["source"]) + [r for r in totals if r["source"] is None]
    sizes = [r["source_size"] for r in named]
    targets = water_fill(sizes, [weights[i % len(weights)] for i in range(len(named))], share * sum(sizes), most)
    rows = [(r["source"], r["source_size"], t) for r, t in zip(named, targets)]
    return spark.createDataFrame(rows, "source string, source_size long, target double")


def mix(
    docs: DataFrame,
    weights: list[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weight: Column | None = None,
    seed: int = 42,
    bins: int | None = None,
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, taken``.

    Sources in code-point order (null last) weigh `weights`, repeating.  They share `share` times the
    words there are; a target stops at `most` times its source.  `weight` (0 to 1) scales what a
    document is due against others of its source; the source then may stay below its target.
    """
    spark = docs.sparkSession
    base = materialize(
        docs.select(doc_id(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), n_words(F.col(text_col)).alias("size"), (F.lit(1.0) if weight is None else F.coalesce(weight.cast("double"), F.lit(0.0))).alias("w")),
        "mix-sizes",
    )
    totals = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    few = totals.limit(MOST_SOURCES + 1).collect()
    if len(few) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources; map them to fewer first")
    bins = bins or max(4096, max((r["n"] for r in few), default=0) // BIN_ROWS)
    targets = _targets(spark, few, list(weights), share, most)
    joined = base.join(F.broadcast(targets), base["source"].eqNullSafe(targets["source"])).drop(targets["source"])  # at most MOST_SOURCES rows
    due = F.when(F.col("source_size") > 0, F.least(F.lit(most), F.col("w") * F.col("target") / F.col("source_size"))).otherwise(0.0)
    u = uniform(F.col("doc_id"), seed)
    rows = joined.withColumn("due", due).withColumn("whole", F.floor("due").cast("long")).withColumn("p", F.col("due") - F.col("whole"))
    odds = (u / (1 - u)) / (F.col("p") / (1 - F.col("p")))
    rows = rows.withColumn("q", F.when(F.col("p") > 0, odds))
    # q is mapped back to (0, 1) for the bins: an order-preserving scale on which ranks spread evenly
    rows = rows.withColumn("bin", F.when(F.col("q").isNotNull(), F.floor(F.col("q") / (1 + F.col("q")) * bins).cast("int")))
    rest = rows.groupBy("source").agg((F.sum(F.round(F.col("size") * F.col("p") * MICRO).cast("decimal(38,0)")) / MICRO).cast("double").alias("rest"))  # whole numbers, so that the order does not matter
    counted = rows.filter("bin is not null").groupBy("source", "bin").agg(F.sum("size").alias("words"))
    run = W.partitionBy("source").orderBy("bin").rowsBetween(W.unboundedPreceding, W.currentRow)  # at most `bins` rows a source
    counted = counted.withColumn("upto", F.sum("words").over(run))
    cuts = (
        counted.join(rest.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .groupBy("source")
        .agg(
            F.min(F.when(F.col("upto") >= F.col("rest"), F.col("bin"))).alias("cut_bin"),
            F.coalesce(F.max(F.when(F.col("upto") < F.col("rest"), F.col("upto"))), F.lit(0)).alias("before"),
            F.max("rest").alias("rest"),
        )
        .withColumnRenamed("source", "cut_source")
    )
    rows = rows.join(F.broadcast(cuts), rows["source"].eqNullSafe(cuts["cut_source"]), "left").drop("cut_source")
    inside = rows.filter("bin = cut_bin").withColumn("upto", F.sum("size").over(W.partitionBy("source").orderBy("q", "doc_id", "size").rowsBetween(W.unboundedPreceding, W.currentRow)))
    # the document on the cut is taken if that comes nearer to the target
    inside = inside.withColumn("extra", F.when(F.col("before") + F.col("upto") - F.col("size") / 2.0 <= F.col("rest"), 1).otherwise(0)).drop("upto")
    outside = rows.filter("not coalesce(bin = cut_bin, false)").withColumn("extra", F.when(F.col("bin").isNotNull() & (F.col("cut_bin").isNull() | (F.col("bin") < F.col("cut_bin"))), 1).otherwise(0))
    copies = (F.col("whole") + F.col("extra")).cast("long")
    return outside.unionByName(inside).select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
