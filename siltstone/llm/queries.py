"""The registered queries of this subpackage: one for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import decontaminate
from .exact_dedup import exact_dedup
from .language_id import identify
from .mixing import mix
from .pii import KINDS, find_pii, span_string
from .ppm import pretrained_scores
from .simhash import simhash_components
from .substring_dedup import substring_dedup
from .token_counts import count_with_edits, mask_addresses
from .url_filter import judge_urls


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(n: int) -> Column:
    """Null for a null id: such rows are held out, nothing is learned from them."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pretrained_scores(table(spark, sf_dir, "documents"), _remainder(7) != 2)
    return out.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document, before and after each word with an at sign is masked."""
    return count_with_edits(table(spark, sf_dir, "documents"), propose=mask_addresses)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = identify(table(spark, sf_dir, "documents"), _remainder(3) != 1)
    return out.select("doc_id", F.coalesce(_remainder(3) == 1, F.lit(True)).alias("held_out"), "lang_pred", "score")


#: Fixed values: the rules that op4 judges by.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    of_kind = lambda k: F.filter(base, lambda s: s["kind_no"] == k)  # noqa: E731
    n = [F.size(of_kind(k)).cast("long").alias(f"n_{KINDS[k]}") for k in range(4)]
    return found.select("doc_id", *n, F.sha2(span_string(base), 256).alias("base_sha256"), span_string(F.col("spans")).alias("spans"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(table(spark, sf_dir, "documents"))
    spans = F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))))
    return out.select("doc_id", "n_dup_words", spans.alias("spans"), "partners")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).withColumnRenamed("digest", "text_sha256")


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), r AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM r
"""


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


OP10_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), bw AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), sizes AS (
  SELECT DISTINCT least(len(w), 13) AS k FROM bw WHERE len(w) > 0
), bg AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT item_id, w, least(len(w), 13) AS k, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM bw WHERE len(w) > 0)
), dg AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw CROSS JOIN sizes WHERE len(w) >= k)
), m AS (
  SELECT doc_id, i, dg.k AS k, item_id FROM dg JOIN bg ON dg.k = bg.k AND dg.g = bg.g
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM m) GROUP BY doc_id
), it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""


# --- what SQL can say of operators that it cannot express as a whole


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path and rule of op4's operator; verdicts where a rule decides."""
    out = judge_urls(table(spark, sf_dir, "pages"), URL_RULES)
    return out.select("page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("verdict"))


_FITS = "\n".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}') THEN '{a} {h}/{p}'" for a, h, p in sorted(((a, *r.split("/", 1)) for a, r in URL_RULES), key=lambda x: -len(x[1]) - len(x[2])))

URL_RULES_SQL = rf"""
WITH u AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), r AS (SELECT *, CASE {_FITS} END AS r FROM u)
SELECT page_id, host, path, split_part(r, ' ', 2) AS rule, split_part(r, ' ', 1) AS verdict FROM r
"""


def mix_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of op7's operator, and whether each target keeps to twice the source."""
    out = mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", (F.col("target") <= 2 * F.col("source_size")).alias("bounded"), (F.col("taken") <= 2 * F.col("size")).alias("taken_bounded"))


MIX_SIZES_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ 	-]+')) AS BIGINT) AS size FROM documents)
SELECT doc_id, size, CAST(sum(size) OVER (PARTITION BY source) AS BIGINT) AS source_size, TRUE AS bounded, TRUE AS taken_bounded FROM d
"""


def pii_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans by kind of op6's operator."""
    return op6_pii(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone")


PII_BASE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), m AS (
  SELECT doc_id, regexp_extract_all(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+') AS email,
         regexp_extract_all(t, '[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)') AS ip,
         list_transform(regexp_extract_all(t, '[0-9](?:[ -]?[0-9])+'), lambda x: reverse(regexp_replace(x, '[^0-9]', '', 'g'))) AS card,
         list_transform(regexp_extract_all(t, '\+[0-9][ ().0-9-]+[0-9]'), lambda x: length(regexp_replace(x, '[^0-9]', '', 'g'))) AS phone
  FROM d
)
SELECT doc_id, CAST(len(email) AS BIGINT) AS n_email,
       CAST(len(list_filter(ip, lambda x: len(list_filter(string_split(x, '.'), lambda p: length(ltrim(p, '0')) > 3 OR CAST(right('000' || ltrim(p, '0'), 3) AS INTEGER) > 255)) = 0)) AS BIGINT) AS n_ip,
       CAST(len(list_filter(card, lambda x: length(x) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, CAST(length(x) AS BIGINT) + 1), lambda i: CASE WHEN i % 2 = 1 THEN CAST(x[i] AS INTEGER) WHEN CAST(x[i] AS INTEGER) > 4 THEN CAST(x[i] AS INTEGER) * 2 - 9 ELSE CAST(x[i] AS INTEGER) * 2 END)) % 10 = 0)) AS BIGINT) AS n_card,
       CAST(len(list_filter(phone, lambda n: n BETWEEN 8 AND 15)) AS BIGINT) AS n_phone
FROM m
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ppm_score": op1_ppm_score,
    "op2_token_counts": op2_token_counts,
    "op3_language_id": op3_language_id,
    "op4_url_filter": op4_url_filter,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_pii": op6_pii,
    "op7_mix_sources": op7_mix_sources,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_decontaminate": op10_decontaminate,
    "url_rules": url_rules,
    "mix_sizes": mix_sizes,
    "pii_base_counts": pii_base_counts,
}

ORACLE_SQL: dict[str, str] = {
    "op9_exact_dedup": OP9_SQL,
    "op10_decontaminate": OP10_SQL,
    "url_rules": URL_RULES_SQL,
    "mix_sizes": MIX_SIZES_SQL,
    "pii_base_counts": PII_BASE_SQL,
}
