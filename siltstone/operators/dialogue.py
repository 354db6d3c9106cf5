"""Dialogues: ``file, seq, senders ARRAY<STRING>, texts ARRAY<STRING>``, one row each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T
from .dedup import exact_dedup


def from_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", file: Column | None = None) -> DataFrame:
    """Gather turns into dialogues, in the order of `turn`."""
    own = F.array_sort(F.collect_list(F.struct(F.col(turn).alias("turn"), F.col(role).alias("sender"), F.col(text).alias("text"))))
    df = turns.groupBy(F.col(conv).alias("seq")).agg(own.alias("own"))
    return df.select((F.lit("all") if file is None else file).alias("file"), "seq", F.transform("own", lambda x: x["sender"]).alias("senders"), F.transform("own", lambda x: x["text"]).alias("texts"))


def from_utterances(convs: DataFrame, column: str = "conv") -> DataFrame:
    """Sort each conversation (an array of structs with time, sender and text) by time, stably, and turn it into parallel arrays."""
    timed = F.transform(column, lambda x, i: F.struct(F.to_timestamp(x["time"], T.TIME_FORMAT).alias("at"), i.alias("i"), x["sender"].alias("sender"), x["text"].alias("text")))
    df = convs.withColumn("_own", F.array_sort(timed))
    return df.withColumn("senders", F.transform("_own", lambda x: x["sender"])).withColumn("texts", F.transform("_own", lambda x: x["text"])).drop("_own", column)


# --- predicates


def conversation_ok(texts: Column, blacklisted: Callable[[Column], Column] | None = None) -> Column:
    """No text has a blacklisted keyword, the floor-building word or an interface word.  Evaluated on raw text; null reads "None"."""

    def ok(t: Column) -> Column:
        t = F.coalesce(t, F.lit("None"))
        return ~F.contains(t, F.lit(P.FLOOR_WORD)) & T.no_interface_words(t)

    return F.forall(texts, ok) & (~blacklisted(F.array_join(F.transform(texts, lambda t: F.coalesce(t, F.lit("None"))), "\n")) if blacklisted else F.lit(True))


def bland_trigrams(text: Column) -> Column:
    """The trigrams that cover more than nine tenths of the text, each occurrence counted for three characters.

    Such a trigram fills over three tenths of the sorted trigrams, so it stands at one of a few places there, and only
    those have to be counted.
    """

    def often(t: Column, own: Column) -> Column:
        step = F.greatest(F.lit(1), F.floor(F.size(own) * 0.3).cast("int"))
        places = F.when(F.size(own) > 0, F.sequence(step, F.greatest(F.size(own), step), step)).otherwise(F.array().cast("array<int>"))
        some = F.array_distinct(F.transform(places, lambda i: F.get(own, i - 1)))
        return F.filter(some, lambda g: F.size(F.filter(own, lambda x: x == g)) * 3 / F.length(t) > 0.9)

    return T.bind(text, lambda t: T.bind(F.array_sort(T.ngrams(t, 3)), lambda own: often(t, own)))


def is_bland(text: Column, bland: Column) -> Column:
    """`bland` is an array column or literal of bland trigrams."""
    return F.exists(bland_trigrams(text), lambda g: F.array_contains(bland, g))


def enough_turns(texts: Column) -> Column:
    """At least two utterances, and not just one said twice."""
    return (F.size(texts) > 1) & ~((F.size(texts) == 2) & (F.get(texts, F.lit(0)) == F.get(texts, F.lit(1))))


# --- the fold


def fold_bland(utterances: Column) -> Column:
    """An array of structs with a flag ``bland``: a bland one goes, and the one kept before it; the first stays even if bland."""
    element = F.slice(utterances, 1, 0)

    def step(kept: Column, x: Column) -> Column:
        return F.when(x["bland"] & (F.size(kept) > 0), F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))).otherwise(F.concat(kept, F.array(x)))

    return F.aggregate(utterances, element, step)


# --- advertisements


def advertisements(dialogues: DataFrame, least_length: int = 20, least_before: int = 30) -> DataFrame:
    """``file, text``: long responses in conversations of at most two turns that follow more than `least_before` different utterances."""
    pairs = dialogues.filter(F.size("texts") == 2).select("file", F.coalesce(F.get("texts", F.lit(1)), F.lit("None")).alias("text"), F.get("texts", F.lit(0)).alias("before"))
    long_ = pairs.filter(F.length(F.replace("text", F.lit(" "), F.lit(""))) > least_length)
    # distinct predecessors are combined before the shuffle; null counts as one
    distinct = long_.select("file", "text", F.coalesce(F.sha2("before", 256), F.lit("-")).alias("before")).distinct()
    return distinct.groupBy("file", "text").agg(F.count(F.lit(1)).alias("n_before")).filter(F.col("n_before") > least_before).select("file", "text")


def drop_advertisements(utterances: DataFrame, ads: DataFrame) -> DataFrame:
    """Rows ``file, text, ...`` without those that are advertisements of their file; Spark broadcasts `ads` only if they are small."""
    return utterances.join(ads, ["file", "text"], "left_anti")


# --- statistics


def statistics(dialogues: DataFrame, by: list[str] | None = None, speakers: str = "senders") -> DataFrame:
    """Dialogues of two, those of more than two turns, all others, and the share of the second among the first."""
    n, turns = F.size(F.array_distinct(speakers)), F.size(speakers)
    two, suitable, multi = (F.count_if(x) for x in (n == 2, (n == 2) & (turns > 2), n != 2))
    out = dialogues.groupBy(*(by or [])).agg(two.alias("two"), suitable.alias("suitable"), multi.alias("multi"))
    return out.withColumn("ratio", F.when(F.col("two") != 0, F.col("suitable") / F.col("two")).otherwise(F.col("suitable").cast("double")))


# --- the whole filter


def clean_dialogues(
    dialogues: DataFrame,
    blacklisted: Callable[[Column], Column] | None = None,
    bland: DataFrame | None = None,
    clean: Callable[[Column], Column] = T.clean_utterance,
    ad_length: int = 20,
    ad_before: int = 30,
) -> DataFrame:
    """Blacklist, cleaning, advertisements, blandness, length and exact dedup, in this order.

    Advertisements come from all dialogues.  They and bland trigrams are joined to exploded utterances, so
    neither has to be small.
    """
    ads = advertisements(dialogues, ad_length, ad_before)
    kept = dialogues.filter(conversation_ok(F.col("texts"), blacklisted))
    each = kept.select("file", "seq", F.posexplode(F.arrays_zip("senders", "texts")).alias("place", "x")).select("file", "seq", "place", F.col("x.senders").alias("sender"), F.coalesce("x.texts", F.lit("None")).alias("text"))
    each = drop_advertisements(each, ads).withColumn("clean", clean(F.col("text"))).filter(F.length("clean") > 1)
    if bland is not None:
        hits = each.select("file", "seq", "place", F.explode(bland_trigrams(F.col("clean"))).alias("trigram")).join(bland.select("trigram"), "trigram", "left_semi")
        hits = hits.select("file", "seq", "place", F.lit(True).alias("bland")).distinct()
        each = each.join(hits, ["file", "seq", "place"], "left").withColumn("bland", F.coalesce("bland", F.lit(False)))
    else:
        each = each.withColumn("bland", F.lit(False))
    own = F.array_sort(F.collect_list(F.struct("place", "sender", "clean", "bland")))
    folded = each.groupBy("file", "seq").agg(own.alias("own")).select("file", "seq", fold_bland(F.col("own")).alias("own"))
    done = folded.select("file", "seq", F.transform("own", lambda x: x["sender"]).alias("senders"), F.transform("own", lambda x: x["clean"]).alias("texts"))
    return exact_dedup(done.filter(enough_turns(F.col("texts"))))


def text_only(dialogues: DataFrame) -> DataFrame:
    return dialogues.select("texts")
