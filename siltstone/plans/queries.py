"""One query for each operator, on the driver's tables, and the SQL that gives the same rows.

Where the tables hold nothing that an operator changes, query and SQL put the same marks into the input first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T
from ..functions.conversion import converter, native_converter
from ..functions.lexicon import has_keyword
from ..functions.repair import repair
from ..functions.repeats import collapse_repeats
from ..functions.scoring import CharTrigrams, perplexity
from ..operators import dedup, dialogue, stats, threads, webdoc
from ..sources.writers import output_name

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

Query = Callable[[SparkSession, str], DataFrame]


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The web-document shape: lines of the text, the source as file, the id as order."""
    return table(spark, sf_dir, "documents").select("doc_id", "lang", F.col("source").alias("file"), F.col("doc_id").alias("line_no"), T.lines(F.col("text")).alias("cont"), "text")


def dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.from_turns(table(spark, sf_dir, "conversations"))


# --- functions of one text: query and SQL give id, length and digest of the result


def text_query(name: str, f: Callable[[Column], Column], sql: str | None, mark: tuple[str, str] | None = None, of: tuple[str, str, str] = ("documents", "doc_id", "text")) -> None:
    """`sql` is an expression over t; `mark` derives the input in Spark SQL and in the oracle's SQL from the column."""
    tab, key, col = of

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = table(spark, sf_dir, tab).select(key, F.expr(mark[0] if mark else col).alias("t"))
        return df.select(key, f(F.col("t")).alias("out")).select(key, F.length("out").cast("long").alias("n"), F.md5("out").alias("digest"))

    QUERIES[name] = run
    if sql:
        ORACLE_SQL[name] = f"SELECT {key}, CAST(length(o) AS BIGINT) AS n, md5(o) AS digest FROM (SELECT {key}, {sql} AS o FROM (SELECT {key}, {mark[1] if mark else col} AS t FROM {tab}))"


def sub(pattern: str, by: str = "", t: str = "t") -> str:
    return f"regexp_replace({t}, '{pattern}', '{by}', 'g')"


def both(expr: str) -> tuple[str, str]:
    """An input that Spark and the oracle spell alike but for line feeds and tabs."""
    return expr.replace("NL", "char(10)").replace("CR", "char(13)").replace("TAB", "char(9)"), expr.replace("NL", "chr(10)").replace("CR", "chr(13)").replace("TAB", "chr(9)")


PAGES = ("pages", "page_id", "html")
text_query("strip_trailing_ws", T.strip_trailing, sub(r"(?m)[ \t]+$"), both("replace(text, NL, '  ' || NL) || ' ' || TAB"))
text_query("collapse_newlines", T.collapse_newlines, sub(r"\n{2,}", r"\n\n").replace(r"'\n\n'", "chr(10) || chr(10)"), both("replace(text, NL, NL || NL || NL)"))
text_query("wiki_category", T.drop_category, sub(r"(?m)^Category:.*$"), both("'Category:x' || NL || text || NL || 'Category:y z'"))
text_query("normalize_newlines", T.normalize_newlines, "replace(replace(t, chr(13) || chr(10), chr(10)), chr(13), chr(10))", both("replace(text, NL, CR || NL) || CR"))
_BOOK = r"(?m)^Published by.*$", r"(?m)^Copyright.*$", r"(?m)^Edited by.*$", r"(?m)^Smashwords [eE]dition.*$", r"(?m)^All rights reserved.*$", r"(?m)^(?:Part|PART|Chapter|CHAPTER) (?:I+|i+|\p{Nd}+)(?::.*)?$", r"(?m)^ISBN.*$", r"(?m)^[# \-*]+$"
_book_sql = "t"
for _p in _BOOK:
    _book_sql = sub(_p, t=_book_sql)
text_query("bookcorpus_strip", T.drop_book_lines, _book_sql, both("'Published by A' || NL || 'Chapter 12: x' || NL || '- * #' || NL || text || NL || 'ISBN 1'"))
text_query("stackex", T.expand_answers, "replace(replace(t, 'Q:' || chr(10) || chr(10), 'Question:' || chr(10)), 'A:' || chr(10) || chr(10), 'Answer:' || chr(10))", both("'Q:' || NL || NL || text || NL || 'A:' || NL || NL || 'yes'"))
text_query("dm_trim", T.trim_mathematics, "array_to_string(string_split(t, chr(10))[3:len(string_split(t, chr(10))) - 1], chr(10))", both("'a' || NL || text || NL || 'b' || NL || 'c'"))
text_query("unindent", T.unindent, sub("(?m)^ *"), both("'   ' || replace(text, NL, NL || '  ')"))
text_query("toc_numbers", T.drop_toc, "array_to_string(list_filter(string_split(" + sub(r"(?m)^[* ]+$", t=sub(r"\[\p{Nd}+\]", t=sub(r"(?m)[ ]{4,}[\p{Nd}\-]+$"))) + ", chr(10)), lambda x: NOT contains(x, '     ')), chr(10))", both("replace(text, NL, '[3]      12' || NL || '* *' || NL) || NL || 'a      b'"))
text_query("strip_single_space", T.strip_single_space, "CASE WHEN t LIKE ' %' AND t NOT LIKE '  %' THEN substring(t, 2) ELSE t END", both("' ' || text"))
_STAGE, _QUOTED = r"(?m)^\[(.*)\]$", r'(?m)^"(.*)"$'
_turns = f"string_split(replace(replace(t, '\" \"', '\"' || chr(10) || '\"'), chr(10) || '\" ', chr(10) || '\"'), chr(10))"
_turns = f"array_to_string(list_filter({_turns}, lambda x, i: i = 1 OR {_turns}[i - 1] <> x), chr(10))"
text_query("subtitle_lines", T.clean_subtitles, f"regexp_replace({sub(_STAGE, t=sub(_QUOTED, chr(92) + '1', t=_turns))}, '\\n+', chr(10), 'g')", both("'[x]' || NL || replace(text, NL, NL || '\"a\" \"b\"' || NL || 'c' || NL || 'c' || NL)"))
text_query("news_forum", T.clean_news_forum, None, both("'Title - user' || NL || 'url' || NL || text || NL || '> quote' || NL || '[1]: note'"))
text_query("novel_strips", T.clean_novel, None, both("'[Illustration: x]' || NL || text || NL || NL || 'Project Gutenberg' || NL || NL || 'CHAPTER IV'"))
text_query("unwrap_lines", lambda c: T.unwrap(c, 100_000), None)
text_query("markdown_links", T.drop_markdown_links, None, both("text || ' see [doc](http://x/y) http://a.b/c... http://a-' || NL || 'b'"))
_STRIP, _GAPS = r"\A[\s\x{a0}\x{3000}\x{2028}]+|[\s\x{a0}\x{3000}\x{2028}]+\z", "chr(10) || chr(10)"
_gaps = lambda t: f"regexp_replace({t}, '\\n{{2,}}', {_GAPS}, 'g')"
_fixed = _gaps(sub(r"(?m)[ \t]+$", t="replace(replace(t, chr(13) || chr(10), chr(10)), chr(13), chr(10))"))
text_query("fix_document_by_name", lambda c: T.fix_document(c, F.lit("Wikipedia (en).txt")), sub(_STRIP, t=_gaps(sub(r"(?m)^Category:.*$", t=_fixed))), both("text || CR || NL || 'Category:x'"))
text_query("remove_control", T.remove_control, sub(r"\p{C}"))
text_query("strip_hashtag", T.drop_hashtag, sub("#.*?# *"))
text_query("strip_mention", T.drop_mention, sub(r"@[0-9a-zA-Z\x{4E00}-\x{9FA5}\-_]+"))
text_query("reply_tag", T.drop_reply_tag, sub("回复 *@.*?: *"), both("'回复 @a b: ' || text"))
text_query("strip_qq", T.drop_qq, sub(r"[qQ]{2,}\p{Nd}{5,12}\P{Nd}", " "), both("text || ' QQ123456 x'"))
text_query("mask_phone", T.mask_phone, sub(r"\P{Nd}\p{Nd}{11}\P{Nd}", "<PHONE>"), both("text || ' 13800138000 '"))
text_query("short_links", T.drop_short_link, sub(r"(?:(?:https?:?//|ftp://|www\p{Nd}{0,3}\.)t\.cn?(?:/[a-zA-Z0-9]{0,8})?)|[网页链接|]"), both("text || ' http://t.cn/abc1 网x|页'"))
text_query("url_strip", T.drop_url, None, of=("pages", "page_id", "url"))
text_query("plain_clean", T.plain_clean, None)
_literals, _without = "".join(P.UTTERANCE_LITERALS), "t"
for _p in P.UTTERANCE_LITERALS:
    _without = f"replace({_without}, '{_p}', '')"
_marked = f"'{_literals}' || text || '{_literals}'"
text_query("drop_literals", T.drop_literals, _without, (_marked.replace("\\", "\\\\"), _marked))
text_query("collapse_blanks", T.collapse_blanks, sub(" +", " "), both("replace(text, ' ', '   ')"))
text_query("unicode_strip", T.ustrip, sub(_STRIP), both("'　 ' || text || NL || '　'"))
text_query("gb2312_filter", T.drop_unprintable, sub(T._class(T.gb2312_lacks()), t=sub(r"\\u.{4}")))
text_query("drop_emoji", T.drop_emoji, sub(r"\A\s+|\s+\z", t=sub(r"[\x{10000}-\x{10FFFF}\x{2500}-\x{2BEF}\x{200d}\x{23cf}\x{23e9}\x{231a}\x{fe0f}\x{3030}*\x{20e3}#]+")), both("text || '☀*😀#x '"))
text_query("html_simple_tags", T.drop_simple_tags, sub("<br>|<b>|<li>|<ol>|<blockquote>"), of=PAGES)
text_query("html_comments", T.drop_comments, sub("(?is)<[ ]*!--.*?--[ ]*>"), of=PAGES)
text_query("dot_runs", T.drop_dot_runs, sub(r"\.{6,}"), both("replace(text, NL, '.......' || NL) || '.....'"))
text_query("repeat_collapse", collapse_repeats, None)
text_query("unicode_repair", repair, None)
text_query("normalize_utterance", lambda c: T.normalize(c), sub(r"\A\s+|\s+\z", t=sub(" +", " ", t=sub(r"\p{C}", t="replace(t, chr(9), ' ')"))), both("replace(text, ' ', TAB || ' ')"))
text_query("clean_utterance", lambda c: T.clean_utterance(c, script="[a-z]"), None)
text_query("clean_line", lambda c: T.clean_line(c, collapse=collapse_repeats), None)
_ESC = {"char(92)": "char(92) || char(92)", "char(34)": "char(92) || char(34)", "char(10)": "char(92) || 'n'", "'e'": "char(92) || 'u0065'"}
_escaped = "text"
for _p, _q in _ESC.items():
    _escaped = f"replace({_escaped}, {_p}, {_q})"
text_query("decode_escapes", T.decode_escapes, "t", (_escaped, "text"))
text_query("text_hash", T.text_hash, "substring(sha1(t), 1, 16)")
_CONVERT = {"万": "萬", "与": "與", "e": "E", "the": "THE", "ou": "OU", "á": "à"}
text_query("phrase_conversion", converter({"the": "T", "he": "H", "en": "N", "e": "E", "a": "á"}), None)
text_query("phrase_conversion_native", native_converter({"a": "á", "e": "é", "the": "the", "an": "en"}), "replace(replace(translate(replace(replace(t, 'the', chr(983040)), 'an', chr(983041)), 'ae', 'áé'), chr(983040), 'the'), chr(983041), 'en')")


# --- web documents


@query()
def web_document_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length, codes, repeats, line ends, character-set dedup; counts by language."""
    docs = documents(spark, sf_dir).filter(webdoc.long_enough(F.col("cont")))
    lines = webdoc.remove_codes_by_line(F.col("text"), collapse_repeats)
    return _kept_by_language(docs, F.transform(lines, lambda x: T.ustrip(T.collapse_newlines(T.strip_trailing(x)))))


def _kept_by_language(docs: DataFrame, lines: Column) -> DataFrame:
    """Character-set dedup of the cleaned lines.  Each document is cleaned once and then is a row of counts and a key."""
    counts = lambda cont: F.struct(F.size(cont).alias("n_lines"), T.joined_length(cont).cast("long").alias("n_chars"), F.sha2(dedup.charset_key(cont), 256).alias("key"))
    rows = docs.select("lang", "file", "line_no", T.bind(F.filter(lines, lambda x: F.length(x) > 1), counts).alias("x")).select("lang", "file", "line_no", "x.*")
    kept = dedup.first_rows(rows, "key", "line_no", ["lang", "n_lines", "n_chars"]).filter("n_lines > 0")
    return kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_lines").alias("n_lines"), F.sum("n_chars").alias("n_chars"))


_CONT = "string_split(text, chr(10))"


@query(
    f"""
WITH d AS (SELECT doc_id, lang, source, list_filter(list_transform(list_transform({_CONT}, lambda x: regexp_replace(regexp_replace(x, '<br>|<b>|<li>|<ol>|<blockquote>', '', 'g'), '\\.{{6,}}', '', 'g')), lambda x: trim(regexp_replace(x, '[ \\t]+$', '', 'g'))), lambda x: length(x) > 1) AS cont
  FROM documents WHERE length(array_to_string({_CONT}, ' ')) >= 10),
k AS (SELECT *, row_number() OVER (PARTITION BY source, list_sort(list_distinct(string_split(array_to_string(cont, ''), ''))) ORDER BY doc_id) AS rn FROM d WHERE len(cont) > 0)
SELECT lang, count(*) AS n_docs, CAST(sum(len(cont)) AS BIGINT) AS n_lines, CAST(sum(length(array_to_string(cont, ''))) AS BIGINT) AS n_chars FROM k WHERE rn = 1 GROUP BY lang
"""
)
def web_document_slice_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slice without the repeat rule, which the oracle cannot express."""
    docs = documents(spark, sf_dir).filter(webdoc.long_enough(F.col("cont")))
    return _kept_by_language(docs, F.transform(T.lines(T.drop_dot_runs(T.drop_simple_tags(F.col("text")))), lambda x: T.ustrip(T.strip_trailing(x))))


@query(f"SELECT doc_id, CAST(length(array_to_string({_CONT}, '')) AS BIGINT) AS n FROM documents WHERE length(array_to_string({_CONT}, '')) BETWEEN 10 AND 20000")
def doc_len_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return webdoc.by_length(documents(spark, sf_dir)).select("doc_id", T.joined_length(F.col("cont")).cast("long").alias("n"))


@query(f"SELECT doc_id FROM documents WHERE length(array_to_string({_CONT}, ' ')) >= 10")
def doc_min_len(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).filter(webdoc.long_enough(F.col("cont"))).select("doc_id")


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY source, list_sort(list_distinct(string_split(replace(text, chr(10), ''), ''))) ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")
def charset_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.charset_dedup(documents(spark, sf_dir)).select("doc_id")


_LABEL = "CASE WHEN toxic = 1 THEN 1 WHEN quality = 0 THEN 4 ELSE 0 END"


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One label a document stands for the content model: the first line gets it, the others are benign."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.expr(_LABEL).alias("label"))
    docs = documents(spark, sf_dir).join(labels, "doc_id", "left").withColumn("label", F.coalesce("label", F.lit(0)))
    return docs.withColumn("labels", F.transform("cont", lambda _, i: F.when(i == 0, F.col("label")).otherwise(0)))


_GATED = f"""
WITH d AS (SELECT d.doc_id, d.source, {_CONT.replace('text', 'd.text')} AS cont, coalesce({_LABEL}, 0) AS label FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
g AS (SELECT *, CASE WHEN label = 1 THEN CAST([] AS VARCHAR[]) ELSE list_filter(cont, lambda x, i: length(x) > 4 AND NOT (i = 1 AND label = 4)) END AS kept FROM d)
"""


@query(_GATED + "SELECT doc_id, CAST(len(kept) AS BIGINT) AS n_lines, md5(array_to_string(kept, chr(10))) AS digest FROM g WHERE len(kept) > 0")
def label_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _labelled(spark, sf_dir).withColumn("kept", webdoc.gate_lines(F.col("cont"), F.col("labels"))).filter(F.size("kept") > 0)
    return docs.select("doc_id", F.size("kept").cast("long").alias("n_lines"), F.md5(F.array_join("kept", "\n")).alias("digest"))


@query(_GATED + "SELECT count(*) AS docs_before, count(*) FILTER (len(kept) > 0) AS docs_after, CAST(sum(len(cont)) AS BIGINT) AS lines_before, CAST(sum(len(kept)) AS BIGINT) AS lines_after FROM g")
def filter_line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.line_counts(_labelled(spark, sf_dir), "cont", webdoc.gate_lines(F.col("cont"), F.col("labels")))


_WORDS = ["idiot", "moron", "scum", "the casino", "盖楼"]
_BLACK = r"(?i)(?:^|[^A-Za-z0-9_])(?:idiot|moron|scum|the casino)(?:$|[^A-Za-z0-9_])|盖楼"


@query(f"SELECT doc_id, regexp_matches(array_to_string({_CONT}, ' '), '{_BLACK}') AS hit FROM documents")
def blacklist_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", has_keyword(_WORDS)(F.array_join("cont", " ")).alias("hit"))


_MANY = [f"word{i}" for i in range(600)]
_BLACK_LARGE = _BLACK.replace("idiot|", "idiot|" + "|".join(_MANY) + "|")


@query(f"SELECT doc_id, regexp_matches(array_to_string({_CONT}, ' '), '{_BLACK_LARGE}') AS hit FROM documents")
def blacklist_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list that is long enough for the automaton."""
    return documents(spark, sf_dir).select("doc_id", has_keyword(_WORDS + _MANY)(F.array_join("cont", " ")).alias("hit"))


@query(
    _GATED
    + f"""SELECT CASE WHEN length(array_to_string(cont, ' ')) < 10 THEN 'short' WHEN regexp_matches(array_to_string(cont, ' '), '{_BLACK}') THEN 'blacklist'
 WHEN label = 1 THEN 'label' WHEN len(kept) = 0 THEN 'no_line' END AS reject_reason, count(*) AS n FROM g GROUP BY 1"""
)
def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    reason = webdoc.reject_reason(F.col("cont"), F.col("labels"), has_keyword(_WORDS)(F.array_join("cont", " ")))
    return _labelled(spark, sf_dir).groupBy(reason.alias("reject_reason")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, toxic = 0 AND quality = 0 AND doc_id % 10 >= 5 OR toxic = 1 AS keep FROM labels")
def model_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.expr("CASE WHEN toxic = 1 THEN 2 WHEN quality = 0 THEN 4 ELSE 1 END")
    return table(spark, sf_dir, "labels").select("doc_id", webdoc.vote(F.lit(0), label, (F.col("doc_id") % 10) / 10.0).alias("keep"))


@query("SELECT page_id, CAST(i AS BIGINT) AS part, regexp_matches(part, '<\\s*[script|html|style|div][^>]*>.*?<\\s*/\\s*[script|html|style|div]\\s*>') AS blank FROM (SELECT page_id, unnest(string_split(html, '</p>')) AS part, generate_subscripts(string_split(html, '</p>'), 1) - 1 AS i FROM pages)")
def html_blank_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "pages").select("page_id", F.posexplode(F.split("html", "</p>", -1)).alias("part", "x"))
    return parts.select("page_id", F.col("part").cast("long").alias("part"), ((T.blank_markup(F.col("x")) == "") & (F.col("x") != "")).alias("blank"))


@query("SELECT doc_id, md5(string_agg(l, chr(10) ORDER BY i)) AS digest FROM (SELECT doc_id, l, i, lag(l) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM (SELECT doc_id, replace(text, chr(10), chr(10) || 'c' || chr(10) || 'c' || chr(10)) AS t FROM documents))) WHERE p IS NULL OR p <> l GROUP BY doc_id")
def consecutive_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(T.drop_repeated_lines(F.replace("text", F.lit("\n"), F.lit("\nc\nc\n")))).alias("digest"))


@query("SELECT source AS file, count(*) AS n_rows FROM documents GROUP BY source")
def month_union_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.writers import union_all

    docs = documents(spark, sf_dir)
    return stats.rows_by(union_all(docs.filter("lang = 'en'"), docs.filter("lang <> 'en' or lang is null")), "file")


@query("SELECT doc_id, CAST(length(text) AS BIGINT) AS n FROM documents WHERE doc_id BETWEEN 10 AND 40")
def lines_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.readers import lines_between as between

    return between(documents(spark, sf_dir), 10, 40).select("doc_id", F.length("text").cast("long").alias("n"))


@query("SELECT c AS trigram, count(*) AS n_texts FROM (SELECT DISTINCT doc_id, unnest(list_transform(range(1, CAST(length(text) AS BIGINT) - 1), lambda i: substring(text, i, 3))) AS c FROM documents WHERE length(text) >= 3) GROUP BY c HAVING count(*) > 100")
def trigram_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.document_frequency(table(spark, sf_dir, "documents"), more_than=100)


@query(
    """
WITH c AS (SELECT ch, count(*) AS n FROM (SELECT unnest(string_split(string_split(trim(text), chr(9))[1], '')) AS ch FROM documents) WHERE ch <> '' GROUP BY ch),
r AS (SELECT ch, CAST(row_number() OVER (ORDER BY n DESC, ch) - 1 AS INTEGER) AS id FROM c), t AS (SELECT * FROM r WHERE id < 50)
SELECT ch AS char, id FROM t UNION ALL SELECT '<UNK>', CAST(count(*) AS INTEGER) FROM t UNION ALL SELECT '<PAD>', CAST(count(*) + 1 AS INTEGER) FROM t
"""
)
def char_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.char_vocabulary(table(spark, sf_dir, "documents"), most=50)


@query()
def trigram_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plug-in scorer with the stand-in model, learnt from all of the benchmark's texts."""
    model = CharTrigrams.of_column(table(spark, sf_dir, "benchmark"))
    return table(spark, sf_dir, "documents").select("doc_id", F.round(perplexity(model)(F.col("text")), 6).alias("perplexity"))


_EVEN = "CASE WHEN doc_id % 2 = 0 THEN CAST(doc_id AS VARCHAR(20)) ELSE source END"


@query(f"SELECT doc_id, regexp_matches({_EVEN}, '^[+-]?[0-9]+$') AS number, doc_id % 3 > 0 AS ordered, source || '.' || (doc_id % 7) || '_filter.txt' AS out_name FROM documents")
def small_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second document has its id for a number; times go back by 61 seconds, stay and go on, by turns."""
    at = F.col("doc_id") * 61
    t = F.date_format(F.timestamp_seconds(at), "yyyy-M-d-H-m-s")
    other = F.date_format(F.timestamp_seconds(at + (F.col("doc_id") % 3 - 1) * 61), "yyyy-MM-dd-HH-mm-ss")
    file = F.concat(F.lit("/a/"), F.col("source"), F.lit("."), (F.col("doc_id") % 7).cast("string"), F.lit(".txt"))
    return table(spark, sf_dir, "documents").select("doc_id", T.is_number(F.expr(_EVEN)).alias("number"), T.not_after(t, other).alias("ordered"), output_name(file, "filtered").alias("out_name"))


# --- dialogues


_PIVOT = "SELECT conv_id AS seq, list(role ORDER BY turn) AS senders, list(text ORDER BY turn) AS texts FROM conversations GROUP BY conv_id"


@query(f"SELECT seq, array_to_string(senders, '|') AS senders, md5(array_to_string(texts, '|')) AS texts FROM ({_PIVOT})")
def conv_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogues(spark, sf_dir).select("seq", F.array_join("senders", "|").alias("senders"), F.md5(F.array_join("texts", "|")).alias("texts"))


@query(
    f"""WITH d AS (SELECT len(list_distinct(senders)) AS n, len(senders) AS turns FROM ({_PIVOT})), s AS (SELECT count(*) FILTER (n = 2) AS two, count(*) FILTER (n = 2 AND turns > 2) AS suitable, count(*) FILTER (n <> 2) AS multi FROM d)
SELECT two, suitable, multi, CASE WHEN two <> 0 THEN suitable / CAST(two AS DOUBLE) ELSE CAST(suitable AS DOUBLE) END AS ratio FROM s"""
)
def dialogue_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.statistics(dialogues(spark, sf_dir))


@query(f"SELECT seq FROM (SELECT seq, row_number() OVER (PARTITION BY sha1(array_to_string(texts, ' ')) ORDER BY seq) AS rn FROM ({_PIVOT})) WHERE rn = 1")
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_dedup(dialogues(spark, sf_dir)).select("seq")


@query(f"SELECT seq FROM ({_PIVOT}) WHERE len(texts) > 1 AND NOT (len(texts) = 2 AND texts[1] = texts[2]) AND len(list_filter(texts, lambda t: contains(t, '盖楼') OR contains(t, '图片评论') OR contains(t, '分享图片') OR contains(t, '直播回放') OR regexp_matches(t, '{_BLACK}'))) = 0")
def conversation_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = dialogue.enough_turns(F.col("texts")) & dialogue.conversation_ok(F.col("texts"), has_keyword(_WORDS))
    return dialogues(spark, sf_dir).filter(ok).select("seq")


_TWO = "SELECT a.text AS before, b.text AS text FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 JOIN (SELECT conv_id FROM conversations GROUP BY conv_id HAVING count(*) = 2) c ON a.conv_id = c.conv_id"
_ADS = f"SELECT text FROM ({_TWO}) WHERE length(replace(text, ' ', '')) > 5 GROUP BY text HAVING count(DISTINCT before) > 0"


@query(f"SELECT 'all' AS file, text FROM ({_ADS})")
def ad_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.advertisements(dialogues(spark, sf_dir), 5, 0)


@query(f"SELECT conv_id AS seq, CAST(turn AS BIGINT) AS turn FROM conversations WHERE text NOT IN (SELECT text FROM ({_ADS}))")
def ad_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ads = dialogue.advertisements(dialogues(spark, sf_dir), 5, 0)
    each = table(spark, sf_dir, "conversations").select(F.lit("all").alias("file"), F.col("conv_id").alias("seq"), F.col("turn").cast("long").alias("turn"), "text")
    return dialogue.drop_advertisements(each, ads).select("seq", "turn")


_THE = "repeat('the', CAST(length(text) * (2 + turn % 4) + 1 AS INT)) || text"


@query(f"SELECT conv_id, CAST(turn AS BIGINT) AS turn, (length(t) - length(replace(t, 'the', ''))) / length(t) > 0.9 AS bland FROM (SELECT conv_id, turn, {_THE} AS t FROM conversations)")
def bland_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole utterances, after so many words more that some are bland and some are not."""
    return table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), dialogue.is_bland(F.expr(_THE), F.array(F.lit("the"))).alias("bland"))


@query("SELECT conv_id AS seq, CAST(count(*) // 3 + count(*) % 3 AS INTEGER) AS n_kept FROM conversations GROUP BY conv_id")
def bland_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third utterance is bland and takes the one before it along, so each full three leave one."""
    df = dialogues(spark, sf_dir).withColumn("own", F.transform("texts", lambda t, i: F.struct(t.alias("text"), (i % 3 == 2).alias("bland"))))
    return df.select("seq", F.size(dialogue.fold_bland(F.col("own"))).alias("n_kept"))


@query()
def dialogue_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job, with the letters of the tables as script and low thresholds."""
    bland = spark.range(1).select(F.lit("the").alias("trigram"))
    done = dialogue.clean_dialogues(dialogues(spark, sf_dir), has_keyword(_WORDS), bland, lambda c: T.clean_utterance(c, script="[a-z]"), 5, 30)
    return done.select("seq", F.size("texts").alias("n_turns"), F.md5(F.array_join("texts", "|")).alias("digest"))


@query(
    """
WITH f AS (SELECT conv_id, role, min(turn) AS first FROM conversations GROUP BY conv_id, role), k AS (SELECT conv_id, role, dense_rank() OVER (PARTITION BY conv_id ORDER BY first) AS k FROM f)
SELECT conv_id, CAST(turn AS BIGINT) AS turn, 'Person ' || k AS sender FROM conversations JOIN k USING (conv_id, role)
"""
)
def speaker_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.array_sort(F.collect_list(F.struct("turn", F.col("text").alias("text"), F.lit("").alias("time"), F.col("role").alias("person_id"), F.col("role").alias("person"))))
    df = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(conv.alias("conv"))
    each = F.arrays_zip(threads.label_speakers(F.col("conv")).alias("x"), F.transform("conv", lambda c: c["turn"]).alias("turn"))
    return df.select("conv_id", F.explode(each).alias("e")).select("conv_id", F.col("e.turn").cast("long").alias("turn"), "e.x.sender")


def _blogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A thread from each conversation: the first turn is the root, a later one answers one of the turns before it."""
    c = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("int").alias("turn"), "text")
    first = c.withColumn("at", F.row_number().over(W.partitionBy("conv_id").orderBy("turn")) - 1)
    own = first.select("conv_id", "at", F.concat(F.lit("p"), (F.col("at") % 3).cast("string")).alias("name"), F.concat(F.lit("t"), F.col("at").cast("string")).alias("tid"), "text", F.concat(F.lit("2022-1-1-0-0-"), (F.col("at") % 60).cast("string")).alias("time"))
    item = F.struct(F.col("at"), F.col("tid").alias("text"), F.col("time"), F.col("name"), F.when(F.col("at") % 2 == 0, F.array(F.concat(F.lit("n"), ((F.col("at") + 1) % 3).cast("string")))).otherwise(F.array().cast("array<string>")).alias("@"))
    g = own.groupBy("conv_id").agg(F.array_sort(F.collect_list(item)).alias("own"), F.map_from_entries(F.collect_list(F.struct("tid", "text"))).alias("contents_map"))
    comment = lambda x: F.struct(x["text"].alias("text"), x["time"].alias("time"), x["name"].alias("name"), x["@"].alias("@"))
    root = F.struct(F.col("own")[0]["text"].alias("text"), F.col("own")[0]["time"].alias("time"), F.col("own")[0]["name"].alias("name"))
    names = F.create_map(*[F.lit(x) for i in range(3) for x in (f"p{i}", f"n{i}")])
    thread = F.array(F.struct(root.alias("root_info"), F.transform(F.slice("own", 2, F.greatest(F.size("own") - 1, F.lit(0))), comment).alias("child_info")))
    return g.select(F.col("conv_id").alias("seq"), names.alias("names_map"), "contents_map", thread.alias("relations_map"))


@query()
def thread_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = threads.conversations(_blogs(spark, sf_dir))
    return done.select("seq", F.array_join(F.transform("conv", lambda x: F.concat(x["sender"], F.lit(":"), x["person"])), ",").alias("path"), F.md5(F.array_join(F.transform("conv", lambda x: x["text"]), "|")).alias("digest"))


@query("SELECT conv_id AS seq, CAST(count(*) - 1 AS BIGINT) AS n_children FROM conversations GROUP BY conv_id HAVING count(*) > 1")
def star_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    blogs = _blogs(spark, sf_dir).withColumn("names_map", F.map_concat("names_map", F.create_map(F.lit("seq"), F.col("seq").cast("string"))))
    stars = threads.stars(blogs.withColumn("contents_map", F.map_from_entries(F.transform(F.map_entries("contents_map"), lambda e: F.struct(e["key"], F.when(e["key"] == "t0", F.col("seq").cast("string")).otherwise(e["value"]))))))
    return stars.select(F.col("text").cast("long").alias("seq"), F.size("children").cast("long").alias("n_children"))


@query("SELECT conv_id, role AS name, max(turn) || '.' || role AS id FROM conversations GROUP BY conv_id, role")
def mention_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names to ids, of a map for each conversation; of the ids with one name the last wins."""
    turn = F.struct("turn", F.concat(F.col("turn").cast("string"), F.lit("."), F.col("role")).alias("id"), "role")
    each = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_set(turn)).alias("turns"))
    names = F.map_from_entries(F.transform("turns", lambda x: F.struct(x["id"], x["role"])))
    return each.select("conv_id", F.explode(threads.ids_by_name(names)).alias("name", "id"))
