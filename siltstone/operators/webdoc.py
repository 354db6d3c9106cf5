"""Web documents: ``url, lang, cont ARRAY<STRING>, file, line_no``, one row each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

#: Labels of the content model.
BENIGN, CLEARED, ADVERT = (0, 3, 4, 5), 2, 4


def long_enough(cont: Column, least: int = 10) -> Column:
    return T.joined_length(cont, " ") >= least


def length_band(cont: Column, least: int = 10, most: int = 20_000) -> Column:
    return T.joined_length(cont).between(least, most)


def gate_lines(cont: Column, labels: Column, least: int = 5) -> Column:
    """Lines that pass: none if any label is not benign (even of a short line); else those of `least` characters that are no adverts."""
    both = F.zip_with(F.slice(cont, 1, F.least(F.size(cont), F.size(labels))), F.slice(labels, 1, F.least(F.size(cont), F.size(labels))), lambda c, n: F.struct(c.alias("line"), n.alias("label")))
    bad = F.exists(both, lambda x: ~F.coalesce(x["label"].isin(*BENIGN), F.lit(False)))
    good = F.filter(both, lambda x: (F.length(x["line"]) >= least) & (x["label"] != ADVERT))
    return F.when(bad, F.array().cast("array<string>")).otherwise(F.transform(good, lambda x: x["line"]))


def vote(label_1: Column, label_2: Column, prob_2: Column, compat: bool = True) -> Column:
    """Whether two models keep a line.

    With `compat` the first model has no say: the second's cleared label keeps a line, a benign one if it is likely enough.
    """
    second = F.when(label_2.isin(*BENIGN), prob_2 >= 0.5).otherwise(F.lit(False))
    if compat:
        return F.when(label_2 == CLEARED, True).otherwise(second)
    return F.when(label_1 == label_2, label_1 == 0).when((label_2 == CLEARED) & (label_1 != CLEARED), True).otherwise(second)


def gate_lines_by_vote(cont: Column, first: Column, second: Column, blacklisted: Column) -> Column:
    """The variant with two models: a blacklisted line or a kept advert drops the document, a line voted out only itself.

    `first`: labels; `second`: structs of label and prob; `blacklisted`: booleans; all by line.
    """
    rows = F.arrays_zip(cont.alias("line"), first.alias("a"), second.alias("b"), blacklisted.alias("black"))
    keep = lambda x: vote(x["a"], x["b"]["label"], x["b"]["prob"])
    bad = F.exists(rows, lambda x: x["black"] | (keep(x) & (x["b"]["label"] == ADVERT)))
    return F.when(bad, F.array().cast("array<string>")).otherwise(F.transform(F.filter(rows, keep), lambda x: x["line"]))


def reject_reason(cont: Column, labels: Column, blacklisted: Column) -> Column:
    """Why a document would go: too short, blacklisted, a bad label, no line left; null if it stays."""
    return (
        F.when(~long_enough(cont), "short")
        .when(blacklisted, "blacklist")
        .when(F.exists(labels, lambda n: ~F.coalesce(n.isin(*BENIGN), F.lit(False))), "label")
        .when(F.size(gate_lines(cont, labels)) == 0, "no_line")
    )


def clean_lines(cont: Column, file: Column, clean: Callable[[Column], Column] = T.clean_line, repair=None) -> Column:
    """Clean each line, then fix it up as its file asks; lines of one character or none go."""
    return F.filter(F.transform(cont, lambda x: T.fix_document(clean(x), file, repair)), lambda x: F.length(x) > 1)


def clean_documents(
    docs: DataFrame,
    blacklisted: Callable[[Column], Column] | None = None,
    labels: Callable[[Column], Column] | None = None,
    clean: Callable[[Column], Column] = T.clean_line,
) -> DataFrame:
    """The web filter: length, blacklist, labels, cleaning, empty documents.  Cheap filters come first; no shuffle.

    `labels` gives an array of labels for an array of lines; without it all lines are benign.
    """
    docs = docs.filter(long_enough(F.col("cont")))
    if blacklisted:
        docs = docs.filter(~blacklisted(F.array_join("cont", " ")))
    own = labels(F.col("cont")) if labels else F.transform("cont", lambda _: F.lit(0))
    docs = docs.withColumn("cont", gate_lines(F.col("cont"), own)).filter(F.size("cont") > 0)
    return docs.withColumn("cont", clean_lines(F.col("cont"), F.col("file"), clean)).filter(F.size("cont") > 0)


def by_length(docs: DataFrame) -> DataFrame:
    """All documents in the length band, shortest first; ties by file and line."""
    return docs.filter(length_band(F.col("cont"))).orderBy(T.joined_length(F.col("cont")), "file", "line_no")


def remove_codes_by_line(text: Column, collapse: Callable[[Column], Column] | None = None) -> Column:
    """The lines of a text without codes.  Steps that cannot cross a line feed run on the whole text, so repeats need one call a document."""
    text = T.drop_dot_runs(T.drop_simple_tags(text))
    text = collapse(text) if collapse else text
    return F.transform(T.lines(text), lambda x: T.drop_comments(T.blank_markup(x)))


def remove_codes_from_lines(cont: Column) -> Column:
    """The code rules on each line of an array, with the pattern for repeats."""
    return F.transform(cont, lambda x: T.remove_codes(x))
