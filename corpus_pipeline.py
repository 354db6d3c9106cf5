"""From raw documents to a training mix.  Each stage takes what its predecessor kept.

Defined results: null and empty texts have no letter and go in the first stage.  Rows with one id and one text are one
document; rows that share an id, or have none, and differ in their text are different documents, which stages tell
apart by a hash of id and text.  An empty table gives no rows.  Extra columns are kept, whatever their names; only
``copies`` and ``taken`` give way to those of the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import free_name, materialize
from siltstone.llm.decontaminate import decontaminate
from siltstone.llm.exact_dedup import exact_dedup, normalised, sha256
from siltstone.llm.language_id import in_learned_language, train
from siltstone.llm.mixing import mix, n_words
from siltstone.llm.simhash import simhash_components

def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those in no language that was learned."""
    net = train(docs, F.lit(True))
    return docs if net is None else docs.filter(in_learned_language(net, F.col("text")))


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with a number that stands for id and text, and its column's name."""
    key = free_name(docs, "row_key")
    return docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), sha256(F.coalesce(F.col("text"), F.lit(""))))), key


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of equal texts, and one row of each kept document."""
    kept = exact_dedup(docs).filter("kept").select(F.col("doc_id").alias("kept_id"), F.col("digest").alias("kept_digest")).distinct()
    own = free_name(docs, "digest")
    rows = docs.withColumn(own, sha256(normalised(F.col("text"))))
    same = rows["doc_id"].cast("long").eqNullSafe(kept["kept_id"]) & (rows[own] == kept["kept_digest"])
    return rows.join(kept, same, "left_semi").dropDuplicates(["doc_id", own]).drop(own)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component: that with the smallest hash of id and text."""
    rows, key = _keyed(docs)
    kept = simhash_components(rows, id_col=key).filter("doc_id = component_id").select(F.col("doc_id").alias("kept_key")).distinct()
    return rows.join(kept, rows[key] == kept["kept_key"], "left_semi").drop(key)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a window of a benchmark item occurs, however long they are."""
    rows, key = _keyed(docs)
    bad = decontaminate(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=key).filter("n_hit > 0").select(F.col("doc_id").alias("bad_key")).distinct()
    return rows.join(bad, rows[key] == bad["bad_key"], "left_anti").drop(key)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with ``copies`` (how often) and ``taken`` (words, repeats counted)."""
    rows = docs.drop("copies", "taken")
    keys = F.col("doc_id").alias("mix_id"), F.col("source").alias("mix_source"), F.col("size").alias("mix_size")
    took = mix(docs).filter("copies > 0").groupBy(*keys).agg(F.max("copies").alias("copies"), F.max("taken").alias("taken"))
    same = rows["doc_id"].cast("long").eqNullSafe(took["mix_id"]) & rows["source"].cast("string").eqNullSafe(took["mix_source"]) & (n_words(rows["text"]) == took["mix_size"])
    return rows.join(took, same).select(*[rows[c] for c in rows.columns], took["copies"], took["taken"])


STAGES = [("language_id", language_id), ("exact_dedup", exact), ("near_dedup", near), ("decontaminate", clean_of_benchmark), ("mix", mixed)]

#: The network and the fingerprints are beyond SQL; the tests hold the pipeline against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
