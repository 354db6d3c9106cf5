"""The web filter over a stream of JSON lines.

Its steps are narrow, so they run unchanged.  Exact duplicates are dropped within a watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import charset_key
from ..operators.webdoc import clean_documents
from ..sources.readers import WEB_DOCUMENT, file_name


def document_stream(spark: SparkSession, path: str, files_per_batch: int = 16) -> DataFrame:
    df = spark.readStream.schema(WEB_DOCUMENT).option("maxFilesPerTrigger", files_per_batch).json(path)
    return df.select("*", file_name().alias("file"), F.col("_metadata.file_modification_time").alias("at"))


def clean_stream(docs: DataFrame, within: str = "1 hour", **how) -> DataFrame:
    """Cleaned documents; of those with one character set and file, the first inside the watermark stays."""
    cleaned = clean_documents(docs, **how).withColumn("key", F.sha2(charset_key(F.col("cont")), 256))
    return cleaned.withWatermark("at", within).dropDuplicatesWithinWatermark(["file", "key"]).drop("key")
