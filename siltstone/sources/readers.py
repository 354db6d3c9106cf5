"""Reading the corpus shapes.

Schemas are given, never inferred.  Rows carry ``file`` and an order inside it: ``seq`` (place in a JSON array) or
``line_no`` (a number that grows along the file, unique, with gaps).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lexicon import keywords
from ..operators.threads import BLOG

UTTERANCE = "struct<id:int,sender:string,text:string,time:string,person_id:string,person:string>"
WEB_DOCUMENT = "url string, lang string, cont array<string>"
DIALOGUE = "struct<senders:array<string>,texts:array<string>>"


def file_name() -> Column:
    return F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)


def read_blogs(spark: SparkSession, path: str) -> DataFrame:
    """Whole-file JSON arrays of raw blogs; the id maps are maps, not structs."""
    return spark.read.schema(BLOG).option("multiLine", True).option("mode", "FAILFAST").json(path).select("*", file_name().alias("file"))


def _whole(spark: SparkSession, path: str, kind: str) -> DataFrame:
    df = spark.read.text(path, wholetext=True).select(file_name().alias("file"), "value")
    return df.select("file", F.from_json("value", kind).alias("all"), "value")


def read_conversations(spark: SparkSession, path: str) -> DataFrame:
    """Whole-file JSON arrays of conversations (arrays of utterances): ``file, seq, conv``."""
    return _whole(spark, path, f"array<array<{UTTERANCE}>>").select("file", F.posexplode("all").alias("seq", "conv"))


def read_dialogues(spark: SparkSession, path: str, wrapped: bool = False, compat: bool = False) -> DataFrame:
    """Processed dialogues: ``file, seq, senders, texts``.

    `wrapped`: the array is the only element of another.  `compat`: files with a single dialogue are left out.
    Payloads that are no array are left out.
    """
    if wrapped:
        df = _whole(spark, path, f"array<array<{DIALOGUE}>>").select("file", F.element_at("all", 1).alias("all"))
    else:
        df = _whole(spark, path, f"array<{DIALOGUE}>")
        df = df.filter(F.col("value").rlike(r"\A\s*\[")).select("file", "all")
    df = df.filter(F.col("all").isNotNull() & ((F.size("all") > 1) if compat else F.lit(True)))
    return df.select("file", F.posexplode("all").alias("seq", "x")).select("file", "seq", "x.senders", "x.texts")


def read_text_lists(spark: SparkSession, path: str) -> DataFrame:
    """Whole-file JSON arrays of conversations that are plain arrays of texts: ``texts``."""
    return _whole(spark, path, "array<array<string>>").select(F.explode("all").alias("texts"))


def read_documents(spark: SparkSession, path: str, schema: str = WEB_DOCUMENT, skip: int = -1) -> DataFrame:
    """JSON lines: the columns of `schema`, ``file`` and ``line_no``.  Files are split freely; bad lines raise an error.

    The first ``skip + 1`` lines of each file are left out, which needs files of one split.
    """
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    # rows of one split are numbered in their order, and splits of a file by where they begin
    number = F.monotonically_increasing_id() % F.lit(1 << 33)
    df = df.select("*", file_name().alias("file"), (F.col("_metadata.file_block_start") * 2 + number).alias("line_no"))
    if skip < 0:
        return df
    first = df.groupBy("file").agg(F.min("line_no").alias("_first"))
    return df.join(first, "file").filter(F.col("line_no") > F.col("_first") + skip).drop("_first")


def lines_between(df: DataFrame, first: int, last: int, order: str = "line_no") -> DataFrame:
    return df.filter(F.col(order).between(first, last))


def read_keywords(spark: SparkSession, path: str, least: int = 1, encoding: str | None = None) -> list[str]:
    """Keyword lists, one a line; files with ``gbk`` in their path are GBK.  Lists are small and come to the driver."""
    raw = spark.read.format("binaryFile").load(path).select("path", "content").collect()
    rows = [line for r in raw for line in bytes(r["content"]).decode(encoding or ("gbk" if "gbk" in r["path"] else "utf-8")).replace("\r\n", "\n").split("\n")]
    return keywords(rows, least)


def read_bland(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of trigrams: ``trigram``."""
    return spark.read.text(path).filter(F.length(F.trim("value")) > 0).select(F.from_json(F.concat(F.lit("["), "value", F.lit("]")), "array<string>")[0].alias("trigram"))


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """Vector files: the first field of each line but the first line of a file."""
    df = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\n")).alias("line_no", "line"))
    return df.filter((F.col("line_no") >= 1) & (F.col("line") != "")).select("line_no", F.split("line", " ")[0].alias("word"))
