import random
import re

import pytest
from pyspark.sql import functions as F

from siltstone.llm import mixing
from siltstone.llm.queries import URL_RULES
from siltstone.llm.simhash import simhash_components
from siltstone.llm.url_filter import judge_urls, template_purity, templates


def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(r), a, r) for a, r in URL_RULES for h, _, p in [r.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return host, path, max(fits)[1:] if fits else None


URLS = [None, "", "no scheme", "http://", "http://Org/x", "https://example.org/es/1", "http://a.example.org/en/12?q", "http://example.org/en/2", "http://x.com/fr/1#a", "http://x.com/de/", "http://com/de", "http://notexample.org/es/", "http://x.org?y", "a://b://c/d", "http://x.net/en/3", "http://x.net/en/3", "http://ex.com/" + "a/" * 2000, "http://x.org/é\n/z?w"]


def test_urls(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id int, url string").withColumns({c: F.lit("clash") for c in ("host", "path", "rule", "node", "shape", "salt", "seg", "at")})
    got = {r["page_id"]: r for r in judge_urls(df, URL_RULES).collect()}
    for i, url in enumerate(URLS):
        host, path, rule = brute_url(url)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule and rule[1]), url
        assert got[i]["verdict"] in ("allow", "block") and (rule is None or got[i]["verdict"] == rule[0])
    assert judge_urls(df.limit(0), URL_RULES).count() == 0
    assert {r["verdict"] for r in judge_urls(df, []).collect()} == {"allow"}


def test_templates_learn(spark):
    rng = random.Random(1)
    rows = [(i, f"http://h.net/{'spam' if i % 3 == 0 else 'news'}/{rng.randrange(10**6)}-{rng.choice('abcdefghijklmnopqrstuvwxyz')}{rng.randrange(99)}x{i}.html") for i in range(600)]
    df = spark.createDataFrame(rows, "page_id int, url string")
    known = F.when(F.col("page_id") % 2 == 0, F.col("url").contains("spam"))
    got = judge_urls(df, [], label=known, branches=8).collect()
    assert all(r["verdict"] == ("block" if "/spam/" in r["path"] else "allow") for r in got)
    assert {r["template"] for r in got} <= {"h.net/spam/*", "h.net/news/*"} | {r["template"] for r in got if "#" in r["template"]}
    counts = spark.createDataFrame([("h", "/a/#", 5, 5, 0), ("h", "/b/#", 5, 5, 0), ("h", "/c/#", 50, 0, 50)], "host string, shape string, n long, bad long, good long")
    purity = {r["node"]: r["purity"] for r in template_purity(templates(counts)).collect()}
    a, b, c = (purity[f"h\u0001{x}"] for x in "abc")
    assert a == b > 0.5 > c  # a and b are merged


def test_templates_of_deep_paths(spark):
    rows = [(i, f"http://h.net/a/b/c/d/{'x/' * (i % 5)}{'ads' if i % 2 else 'news'}/{i}.html") for i in range(400)]
    rows += [(400 + i, f"http://h.net/a/b/c/d/{'y/' * 40}{i}.html") for i in range(40)]
    df = spark.createDataFrame(rows, "page_id int, url string")
    known = F.when(F.col("page_id") % 4 < 2, F.col("url").contains("/ads/"))
    got = judge_urls(df, [], label=known).collect()
    assert len(got) == 440 and all(r["verdict"] == ("block" if "/ads/" in r["path"] else "allow") for r in got)
    assert not any("y/y/y" in r["template"] for r in got)  # a pure branch is not followed


def test_water_filling():
    assert mixing.water_fill([10, 10], [1, 1], 30, 2) == [15, 15]
    assert mixing.water_fill([1, 100], [5, 1], 60, 2) == [2, 58]
    assert mixing.water_fill([0, 0], [1, 1], 0, 2) == [0, 0]
    assert mixing.water_fill([], [], 0, 2) == []


def test_mix(docs_of, edge):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randint(0, 30)), "en", rng.choice(["b", "a", None, "é"])) for i in range(800)]
    rows += [(1000 + i, t[:100] if t else t, "en", "tiny") for i, t in enumerate(edge)]
    df = docs_of(rows)
    got = {r["doc_id"]: r for r in mixing.mix(df, bins=16).collect()}
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _, _ in rows}
    by = {}
    for i, _, _, s in rows:
        by[s] = by.get(s, 0) + size[i]
    names = sorted(s for s in by if s is not None) + [None]
    want = dict(zip(names, mixing.water_fill([by[s] for s in names], [(5, 2, 1)[k % 3] for k in range(len(names))], 1.5 * sum(by.values()), 2)))
    for i, _, _, s in rows:
        r = got[i]
        assert (r["size"], r["source_size"]) == (size[i], by[s]) and r["target"] == pytest.approx(want[s])
        assert r["taken"] in (0, size[i], 2 * size[i]) and r["taken"] <= 2 * size[i]
    for s in names:
        assert abs(sum(got[i]["taken"] for i, _, _, x in rows if x == s) - want[s]) <= 15
    assert {(r["doc_id"], r["taken"]) for r in mixing.mix(df.repartition(7), bins=4096).collect()} == {(i, r["taken"]) for i, r in got.items()}
    assert mixing.mix(df.limit(0)).count() == 0
    assert mixing.mix(docs_of([None, ""])).agg(F.sum("taken")).first()[0] == 0


def test_unequal_probabilities(docs_of):
    """Documents with twice the weight are taken twice as often."""
    df = docs_of([(i, "a b c", "en", "s") for i in range(6000)])
    got = mixing.mix(df, share=0.3, weight=F.when(F.col("doc_id") % 2 == 0, 1.0).otherwise(0.5)).collect()
    even = sum(r["copies"] for r in got if r["doc_id"] % 2 == 0)
    odd = sum(r["copies"] for r in got if r["doc_id"] % 2)
    assert even == pytest.approx(900, rel=0.1) and odd == pytest.approx(450, rel=0.15)


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as C

    rng = random.Random(5)
    en = [" ".join(rng.choice("the and thing over water house with from shed wind".split()) + rng.choice("abcdefgh") * rng.randint(0, 4) for _ in range(60)) for _ in range(40)]
    passage = " ".join(f"bench{i}" for i in range(20))
    long_ = " ".join("".join(rng.choice("the and house with water".split())) + rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(2000))
    texts = [*en, en[0], en[1] + "  ", en[2] + " .", "123 ---", None, "", en[3] + " " + passage, long_[:5000] + " " + passage[: len(" ".join(passage.split()[:13]))] + " " + long_[5000:]]
    rows = [(i, t, "en", None if i % 3 == 2 else f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, rows[5]], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({c: F.lit("clash") for c in ("digest", "_digest", "kept_id", "bad_id", "mix_id", "copies", "taken", "size", "salt", "fp")})
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, passage)], "item_id long, text string").coalesce(1).write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for k, (name, stage) in enumerate(C.STAGES[:-1]):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        kept.append({r["doc_id"] for r in docs.collect()})
        assert docs.count() == len(kept[-1]) + (k == 0)  # row 5 is there twice
    ids = set(range(len(texts)))
    assert kept[0] == ids - {43, 44, 45}
    # of equal texts the longest stays: 41 has two blanks more than 1
    assert kept[1] == kept[0] - {40, 1}
    groups = {}
    for r in simhash_components(spark.read.parquet(str(tmp_path / "1"))).collect():
        groups.setdefault(r["component_id"], set()).add(r["doc_id"])
    assert kept[2] <= kept[1] and all(len(kept[2] & g) == 1 for g in groups.values())
    assert 46 in kept[2] and 47 in kept[2]
    assert kept[3] == kept[2] - {46, 47}  # 47: a long text with one window of a benchmark passage
    mixed = C.run(spark, str(tmp_path))
    assert mixed.columns == [c for c in docs.columns if c not in ("copies", "taken")] + ["copies", "taken"]
    mixed = mixed.collect()
    assert {r["doc_id"] for r in mixed} <= kept[3] and all(0 < r["copies"] <= 2 and r["digest"] == r["mix_id"] == "clash" for r in mixed)
    want = {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect() if r["copies"]}
    assert {r["doc_id"]: r["taken"] for r in mixed} == want
