"""Comment threads to root-to-leaf conversations.

A thread is a root and its comments; a comment answers the person it mentions first.  Comments are attached by
name, depth first in order of time, so which branch a comment hangs on depends on the order.  One thread is a
bounded piece of work (2,000 comments, 32 levels), done in one Arrow-batched function; all else is Column
expressions.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import TIME_FORMAT

MOST_COMMENTS, MOST_DEPTH = 2000, 30

COMMENT = "struct<text:string,time:string,name:string,`@`:array<string>>"
BLOG = f"names_map map<string,string>, contents_map map<string,string>, relations_map array<struct<root_info:struct<text:string,time:string,name:string>,child_info:array<{COMMENT}>>>"
PATHS = "array<array<struct<text:string,time:string,name:string>>>"


def has_other_speaker(thread: Column) -> Column:
    """There are comments, and one is by another person than the root's."""
    root = thread["root_info"]["name"]
    return thread["child_info"].isNotNull() & F.exists(thread["child_info"], lambda c: ~c["name"].eqNullSafe(root))


def ids_by_name(names: Column) -> Column:
    """name -> id from id -> name.  Of ids with one name the last wins."""
    entries = F.map_entries(names)
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda x: x["value"] == e["value"]))
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["value"], e["key"])))


def resolve_mentions(threads: Column, names: Column) -> Column:
    """Put ids for mentioned names; unknown names stay."""
    ids = ids_by_name(names)

    def comment(c: Column) -> Column:
        return F.struct(c["text"].alias("text"), c["time"].alias("time"), c["name"].alias("name"), F.transform(c["@"], lambda m: F.coalesce(F.try_element_at(ids, m), m)).alias("@"))

    return F.transform(threads, lambda t: F.struct(t["root_info"].alias("root_info"), F.transform(t["child_info"], comment).alias("child_info")))


def ordered_comments(thread: Column, most: int = MOST_COMMENTS) -> Column:
    """Comments by time (stably), the first `most`; one that mentions nobody mentions the root's person."""
    root = thread["root_info"]["name"]
    keyed = F.transform(thread["child_info"], lambda c, i: F.struct(F.to_timestamp(c["time"], TIME_FORMAT).alias("at"), i.alias("i"), c.alias("c")))
    first = F.transform(F.slice(F.array_sort(keyed), 1, most), lambda x: x["c"])
    return F.transform(first, lambda c: F.struct(c["text"].alias("text"), c["time"].alias("time"), c["name"].alias("name"), F.when(F.coalesce(F.size(c["@"]), F.lit(0)) > 0, c["@"]).otherwise(F.array(root)).alias("@")))


def thread_paths(root: dict, comments: list[dict], most_depth: int = MOST_DEPTH) -> list[list[dict]]:
    """All root-to-leaf paths of one thread.

    A comment waits under the name that it mentions.  Attaching is a walk with a stack of open persons: each takes
    the next waiting comment that nobody took.  A copy of a comment whose own answers are still being attached
    waits until they are.
    """
    content = [(c["text"], c["time"], c["name"], tuple(c["@"])) for c in comments]
    waiting: dict[str, list[int]] = {}
    for i, c in enumerate(comments):
        if len(c["@"]) and c["@"][0] != c["name"]:
            waiting.setdefault(c["@"][0], []).append(i)
    taken, open_ = set(), {}
    answers: dict[int, list[int]] = {-1: []}
    stack = [(-1, iter(waiting.get(root["name"], ())))]
    while stack:
        node, rest = stack[-1]
        for i in rest:
            if i in taken or open_.get(content[i]):
                continue
            taken.add(i)
            answers[node].append(i)
            answers[i] = []
            open_[content[i]] = open_.get(content[i], 0) + 1
            # the root's comments are at depth 0; deeper than most_depth nothing is attached
            stack.append((i, iter(waiting.get(comments[i]["name"], ()) if len(stack) <= most_depth else ())))
            break
        else:
            stack.pop()
            if node >= 0:
                open_[content[node]] -= 1
    if not answers[-1]:
        return [[root]]

    shown = lambda i: {k: (root if i < 0 else comments[i])[k] for k in ("text", "time", "name")}
    same = lambda i: (str((root if i < 0 else comments[i])["text"]), (root if i < 0 else comments[i])["time"], str((root if i < 0 else comments[i])["name"]))
    paths, path, on = [], [-1], {same(-1)}
    walk = [iter(answers[-1])]
    while walk:
        i = next(walk[-1], None)
        if i is None:
            walk.pop()
            on.discard(same(path.pop()))
        elif same(i) not in on:
            if answers[i]:
                path.append(i)
                on.add(same(i))
                walk.append(iter(answers[i]))
            else:
                paths.append([shown(j) for j in path] + [shown(i)])
    return paths


def _paths(roots: pd.DataFrame, comments: pd.Series) -> pd.Series:
    return pd.Series([thread_paths(r, [] if c is None else list(c)) for r, c in zip(roots.to_dict("records"), comments)])


def conversations(blogs: DataFrame, strict: bool = True) -> DataFrame:
    """Raw blogs (`BLOG` columns) to ``conv``: an array of ``id, sender, text, time, person_id, person``, one row a path.

    Paths of one person only are dropped.  A text or name id that is missing raises an error if `strict`, else is null.
    """
    thread = blogs.withColumn("_threads", resolve_mentions(F.col("relations_map"), F.col("names_map"))).select("names_map", "contents_map", F.explode("_threads").alias("t"), *[c for c in blogs.columns if c not in ("names_map", "contents_map", "relations_map")])
    rest = [c for c in thread.columns if c not in ("names_map", "contents_map", "t")]
    thread = thread.filter(has_other_speaker(F.col("t"))).withColumn("_own", ordered_comments(F.col("t")))
    path = thread.select(*rest, "names_map", "contents_map", F.explode(F.pandas_udf(_paths, PATHS)("t.root_info", "_own")).alias("path"))
    path = path.filter(F.size(F.array_distinct(F.transform("path", lambda x: x["name"]))) > 1)

    def find(m: str, key: Column) -> Column:
        return F.coalesce(F.try_element_at(F.col(m), key), F.raise_error(F.concat(F.lit(f"{m} has no "), key)).cast("string")) if strict else F.try_element_at(F.col(m), key)

    named = path.withColumn("conv", F.transform("path", lambda x: F.struct(find("contents_map", x["text"]).alias("text"), x["time"].alias("time"), x["name"].alias("person_id"), find("names_map", x["name"]).alias("person"))))
    return named.select(*rest, label_speakers(F.col("conv")).alias("conv"))


def label_speakers(conv: Column) -> Column:
    """Add ``id`` (the place) and ``sender``: "Person k", numbered by first appearance of the person."""
    persons = F.array_distinct(F.transform(conv, lambda x: x["person"]))
    return F.transform(conv, lambda x, i: F.struct(i.cast("int").alias("id"), F.concat(F.lit("Person "), F.array_position(persons, x["person"]).cast("string")).alias("sender"), x["text"].alias("text"), x["time"].alias("time"), x["person_id"].alias("person_id"), x["person"].alias("person")))


def stars(blogs: DataFrame, fix_person_id: bool = False) -> DataFrame:
    """Each thread as its root with all comments as direct children.  Children carry the root's person id unless `fix_person_id`."""
    t = blogs.select("names_map", "contents_map", F.explode(resolve_mentions(F.col("relations_map"), F.col("names_map"))).alias("t")).filter("t.child_info is not null and size(t.child_info) > 0")

    def one(x: Column, person_id: Column) -> Column:
        return F.struct(x["text"].alias("text_id"), F.element_at("contents_map", x["text"]).alias("text"), x["time"].alias("time"), person_id.alias("person_id"), F.element_at("names_map", x["name"]).alias("person"))

    root = F.col("t.root_info")
    children = F.transform("t.child_info", lambda c: one(c, c["name"] if fix_person_id else root["name"]))
    return t.select(one(root, root["name"]).alias("x"), children.alias("children")).select("x.*", "children")
