import json

import pytest
from pyspark.sql import functions as F

from siltstone.functions import conversion, repair, scoring
from siltstone.operators import dedup, dialogue, stats, threads, webdoc
from siltstone.plans import pipelines
from siltstone.sources import readers, writers


def comment(text, name, at, mention=None):
    return {"text": text, "name": name, "time": at, "@": [mention] if mention else []}


def paths(root, comments):
    filled = [c | {"@": c["@"] or [root["name"]]} for c in sorted(comments, key=lambda c: c["time"])[:2000]]
    return threads.thread_paths(root, filled)


ROOT = {"text": "1", "name": "1", "time": "0"}
DEMO = [comment("2", "2", "1"), comment("3", "3", "2", "2"), comment("4", "4", "3"), comment("5", "5", "4", "2"), comment("6", "6", "5", "3"), comment("7", "7", "6", "1"), comment("8", "1", "7", "7")]


def test_paths():
    assert [[x["text"] for x in p] for p in paths(ROOT, DEMO)] == [["1", "2", "3", "6"], ["1", "2", "5"], ["1", "4"], ["1", "7", "8"]]
    root = {"text": "a", "name": "A", "time": "0"}
    got = paths(root, [comment("b", "B", "1"), comment("c", "C", "2"), comment("r", "A", "3", "B")])
    assert [[x["name"] for x in p] for p in got] == [["A", "B", "A", "C"]]
    assert paths(root, [comment("x", "B", "1", "B"), comment("y", "B", "1", "nobody")]) == [[root]]
    chain = [comment(str(i), f"p{i}", f"{i:03}", f"p{i - 1}" if i else "A") for i in range(50)]
    assert [len(p) for p in paths(root, chain)] == [32]
    twice = [comment("b", "B", "1"), comment("b", "B", "1"), comment("c", "C", "2", "B")]
    assert [[x["text"] for x in p] for p in paths(root, twice)] == [["a", "b", "c"], ["a", "b"]]


def blog():
    names = {"1": "ann", "2": "bob", "3": "cy"}
    texts = {"10": "root", "11": "hi", "12": "oh"}
    kids = [{"text": "12", "time": "2022-1-1-0-0-9", "name": "1", "@": ["bob"]}, {"text": "11", "time": "2022-01-01-00-00-02", "name": "2", "@": []}]
    root = {"text": "10", "time": "2022-1-1-0-0-0", "name": "1"}
    return {"names_map": names, "contents_map": texts, "relations_map": [{"root_info": root, "child_info": kids}, {"root_info": root}, {"root_info": root, "child_info": [kids[0]]}]}


def test_threads_from_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([blog()]))
    blogs = readers.read_blogs(spark, str(tmp_path / "a.json"))
    got = pipelines.format_threads(blogs).collect()
    assert [[(x["id"], x["sender"], x["text"], x["person"]) for x in r["conv"]] for r in got] == [[(0, "Person 1", "root", "ann"), (1, "Person 2", "hi", "bob"), (2, "Person 1", "oh", "ann")]]
    stars = threads.stars(blogs).collect()
    assert [(r["text"], [c["person_id"] for c in r["children"]]) for r in stars] == [("root", ["1", "1"]), ("root", ["1"])]
    assert [c["person_id"] for c in threads.stars(blogs, fix_person_id=True).first()["children"]] == ["1", "2"]
    bad = blog()
    bad["contents_map"].pop("11")
    df = spark.createDataFrame([(bad["names_map"], bad["contents_map"], [x | {"child_info": x.get("child_info")} for x in bad["relations_map"]])], threads.BLOG)
    with pytest.raises(Exception, match="contents_map"):
        threads.conversations(df).collect()
    assert threads.conversations(df, strict=False).first()["conv"][1]["text"] is None


def dialogue_rows(spark, *texts, senders=None):
    return spark.createDataFrame([("f", i, senders or [f"s{j % 2}" for j in range(len(t))], list(t)) for i, t in enumerate(texts)], "file string, seq long, senders array<string>, texts array<string>")


def test_dialogue_predicates(spark):
    df = dialogue_rows(spark, ["x", "x"], ["x", "x", "x"], ["x"], [], ["a盖楼", "b"], ["分享图片", None])
    assert [r[0] for r in df.select(dialogue.enough_turns(F.col("texts"))).collect()][:4] == [False, True, False, False]
    assert [r[0] for r in df.select(dialogue.conversation_ok(F.col("texts"))).collect()] == [True, True, True, True, False, False]
    flags = spark.createDataFrame([("哈哈哈哈", "哈哈哈"), ("abcabc", "abc"), ("abcabcd", "abc"), ("哈哈哈好的", "哈哈哈"), ("ab", "ab"), ("", "")], "t string, b string")
    assert [r[0] for r in flags.select(dialogue.is_bland(F.col("t"), F.array("b"))).collect()] == [True, True, False, False, False, False]


def test_fold(spark):
    def fold(*own):
        df = spark.createDataFrame([([(t, b) for t, b in own],)], "own array<struct<t:string,bland:boolean>>")
        return [x["t"] for x in df.select(dialogue.fold_bland(F.col("own")).alias("o")).first()["o"]]

    a, b = (lambda t: (t, False)), (lambda t: (t, True))
    assert fold(a("a"), b("B"), a("c")) == ["c"]
    assert fold(b("B"), a("a")) == ["B", "a"]
    assert fold(a("a"), b("B"), b("C"), a("c"), b("D")) == ["C"]


def test_advertisements(spark):
    ad, short = "x" * 21, "y" * 20
    rows = [[f"q{i}", ad] for i in range(31)] + [[f"q{i}", short] for i in range(31)] + [["q", "z" * 30]] * 40
    df = dialogue_rows(spark, *rows)
    assert [r["text"] for r in dialogue.advertisements(df).collect()] == [ad]
    assert dialogue.advertisements(dialogue_rows(spark, *rows[1:])).count() == 0


def test_statistics_and_dedup(spark):
    rows = [("f", 0, ["a", "b"], ["1", "2"]), ("f", 1, ["a", "b", "a"], ["1", "2", "3"]), ("f", 2, ["a", "b", "c"], ["1", "2", "3"]), ("g", 3, ["a", "a"], ["1", "2"])]
    df = spark.createDataFrame(rows, "file string, seq long, senders array<string>, texts array<string>")
    got = dialogue.statistics(df).first()
    assert (got["two"], got["suitable"], got["multi"], got["ratio"]) == (2, 1, 2, 0.5)
    assert dialogue.statistics(df.limit(0)).first()["ratio"] == 0.0
    assert sorted(r["seq"] for r in dedup.exact_dedup(df).collect()) == [0, 1, 3]
    for n in (1, 7):
        assert sorted(r["seq"] for r in dedup.exact_dedup(df.repartition(n)).collect()) == [0, 1, 3]
    docs = spark.createDataFrame([("f", 1, ["abc"]), ("f", 2, ["cab", "b"]), ("f", 3, ["abd"]), ("g", 1, ["abc"])], "file string, line_no long, cont array<string>")
    assert sorted((r["file"], r["line_no"]) for r in dedup.charset_dedup(docs).collect()) == [("f", 1), ("f", 3), ("g", 1)]


def test_whole_dialogue_filter(spark):
    df = dialogue_rows(spark, ["今天天气", "很好啊"], ["今天天气", "很好啊"], ["盖楼了", "很好啊"], ["哈哈哈哈哈", "今天天气"], ["今天天气", "哈哈哈哈哈", "很好啊吧", "嗯嗯好的"])
    bland = spark.createDataFrame([("哈哈哈",)], "trigram string")
    got = {r["seq"]: r["texts"] for r in dialogue.clean_dialogues(df, bland=bland).collect()}
    assert got == {0: ["今天天气", "很好啊"], 3: ["哈哈哈哈哈", "今天天气"], 4: ["很好啊吧", "嗯嗯好的"]}


def test_label_gate(spark):
    rows = [(["aaaaa", "bbbbb", "ccccc"], [0, 3, 5]), (["aaaaa", "bbbbb"], [0, 4]), (["aaaaa", "bbbbb"], [0, 1]), (["aaaaa", "b"], [0, 2]), (["aaaa"], [0]), ([], [])]
    df = spark.createDataFrame(rows, "c array<string>, l array<int>")
    assert [r[0] for r in df.select(webdoc.gate_lines(F.col("c"), F.col("l"))).collect()] == [["aaaaa", "bbbbb", "ccccc"], ["aaaaa"], [], [], [], []]
    assert [r[0] for r in df.select(webdoc.reject_reason(F.col("c"), F.col("l"), F.lit(False))).collect()] == [None, None, "label", "short", "short", "short"]
    votes = spark.createDataFrame([(0, 2, 0.1), (1, 0, 0.5), (0, 0, 0.4), (0, 1, 0.9)], "a int, b int, p double")
    assert [r[0] for r in votes.select(webdoc.vote(F.col("a"), F.col("b"), F.col("p"))).collect()] == [True, True, False, False]
    two = spark.createDataFrame([(["x", "y"], [0, 0], [(2, 0.0), (1, 0.0)], [False, False])], "c array<string>, a array<int>, b array<struct<label:int,prob:double>>, k array<boolean>")
    assert two.select(webdoc.gate_lines_by_vote(F.col("c"), F.col("a"), F.col("b"), F.col("k"))).first()[0] == ["x"]


def test_bands(spark):
    df = spark.createDataFrame([(["a" * 9],), (["a" * 10],), (["a" * 10_000] * 2,), (["a" * 20_001],)], "c array<string>")
    assert [r[0] for r in df.select(webdoc.length_band(F.col("c"))).collect()] == [False, True, True, False]
    assert [r[0] for r in df.select(webdoc.long_enough(F.col("c"))).collect()][:2] == [False, True]


def test_vocabulary_and_frequency(spark):
    df = spark.createDataFrame([(0, "bba\tzz"), (1, "ab"), (2, None), (3, "")], "i int, text string")
    assert [(r["char"], r["id"]) for r in stats.char_vocabulary(df, order="i").orderBy("id").collect()] == [("b", 0), ("a", 1), ("<UNK>", 2), ("<PAD>", 3)]
    assert stats.char_vocabulary(df, most=1).orderBy("id").first()["char"] == "b"
    texts = spark.createDataFrame([("aaaa",), ("aaab",), ("ab",)], "text string")
    assert {r["trigram"]: r["n_texts"] for r in stats.document_frequency(texts, more_than=0).collect()} == {"aaa": 2, "aab": 1}
    logs = spark.createDataFrame([("ratio: 0.50, two: 10, multi: 4",), ("noise",), ("ratio: 0.10, two: 20, multi: 6",)], "value string")
    got = stats.mine_logs(logs).first()
    assert (round(got["mean_ratio"], 6), round(got["suitable"], 6), got["two"], got["multi"]) == (0.3, 7.0, 30, 10)


def test_sources_and_sinks(spark, tmp_path):
    conv = [[{"id": 0, "sender": "a", "text": "late", "time": "2022-1-1-0-0-9"}, {"id": 1, "sender": "b", "text": "early", "time": "2022-1-1-0-0-1"}]]
    (tmp_path / "c.json").write_text(json.dumps(conv))
    got = dialogue.from_utterances(readers.read_conversations(spark, str(tmp_path / "c.json"))).first()
    assert got["texts"] == ["early", "late"] and got["senders"] == ["b", "a"]
    (tmp_path / "p.json").write_text(json.dumps([{"senders": ["a"], "texts": ["x"]}, {"senders": ["a"], "texts": ["y"]}]))
    (tmp_path / "q.json").write_text(json.dumps([{"senders": ["a"], "texts": ["x"]}]))
    assert readers.read_dialogues(spark, str(tmp_path / "[pq].json")).count() == 3
    assert readers.read_dialogues(spark, str(tmp_path / "[pq].json"), compat=True).count() == 2
    (tmp_path / "w.json").write_text(json.dumps([[{"senders": ["a"], "texts": ["x"]}]]))
    assert readers.read_dialogues(spark, str(tmp_path / "w.json"), wrapped=True).first()["texts"] == ["x"]
    (tmp_path / "l.json").write_text(json.dumps([["a", "b"], ["c"]]))
    merged = writers.union_all(dialogue.text_only(readers.read_dialogues(spark, str(tmp_path / "p.json"))), readers.read_text_lists(spark, str(tmp_path / "l.json")))
    assert sorted(r["texts"] for r in merged.collect()) == [["a", "b"], ["c"], ["x"], ["y"]]
    (tmp_path / "d.txt").write_text("".join(json.dumps({"url": str(i), "lang": "zh", "cont": [f"line {i}"]}) + "\n" for i in range(5)))
    docs = readers.read_documents(spark, str(tmp_path / "d.txt"))
    assert [r["url"] for r in docs.orderBy("line_no").collect()] == list("01234")
    assert [r["url"] for r in readers.read_documents(spark, str(tmp_path / "d.txt"), skip=1).orderBy("line_no").collect()] == list("234")
    (tmp_path / "words_gbk.txt").write_bytes("赌博\n\n 菠 \n".encode("gbk"))
    assert readers.read_keywords(spark, str(tmp_path / "words_gbk.txt"), least=2) == ["赌博"]
    (tmp_path / "b.txt").write_text('"哈哈哈"\n\n"abc"\n')
    assert [r["trigram"] for r in readers.read_bland(spark, str(tmp_path / "b.txt")).collect()] == ["哈哈哈", "abc"]
    (tmp_path / "v.txt").write_text("2 3\nthe 0.1\nof 0.2\n")
    assert [r["word"] for r in readers.read_vocab(spark, str(tmp_path / "v.txt")).collect()] == ["the", "of"]
    assert writers.save_documents(docs, str(tmp_path / "out"), by="file") and (tmp_path / "out" / "file=d.txt").is_dir()
    assert not writers.save_documents(docs.limit(0), str(tmp_path / "none")) and not (tmp_path / "none").exists()
    writers.save_text(docs.select("url"), str(tmp_path / "text"), "url")
    assert spark.read.text(str(tmp_path / "text")).count() == 5
    names = spark.range(1).select(writers.output_name(F.lit("/x/a.b.json"), "formatted"), writers.output_name(F.lit("/x/a.b.txt"), "deduplicated")).first()
    assert list(names) == ["a_format.json", "a.b_dedup.txt"]


def test_web_filter_and_stream(spark, tmp_path):
    from siltstone.streaming.documents import clean_stream, document_stream

    src = tmp_path / "in"
    src.mkdir()
    rows = [{"url": "1", "lang": "zh", "cont": ["今天天气很好啊", "短"]}, {"url": "2", "lang": "zh", "cont": ["x"]}, {"url": "3", "lang": "zh", "cont": ["赌博网站来了来了啊啊"]}]
    (src / "a.json").write_text("".join(json.dumps(r) + "\n" for r in rows))
    from siltstone.functions.lexicon import has_keyword

    docs = readers.read_documents(spark, str(src))
    got = pipelines.filter_documents(docs.withColumn("cont", F.concat("cont", F.array(F.lit("第二行的文字也很长")))), has_keyword(["赌博"])).collect()
    assert [r["url"] for r in got if r["url"] != "2"] == ["1"]
    assert pipelines.dedup_and_merge(docs).count() == 1
    assert pipelines.dedup_and_merge(docs, skip="a.").count() == 0
    assert docs.select(webdoc.remove_codes_from_lines(F.array(F.lit("1000"), F.lit("a<b>")))).first()[0] == ["10", "a"]
    query = clean_stream(document_stream(spark, str(src)), blacklisted=has_keyword(["赌博"])).writeStream.format("memory").queryName("cleaned").outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    assert {r["url"] for r in spark.sql("select url from cleaned").collect()} <= {"1"}


def test_scorers(spark):
    class Fixed:
        def predict(self, texts):
            return [(len(t), 0.5) for t in texts]

    df = spark.createDataFrame([(" ab ", ["a", "bcd"]), (None, None)], "t string, c array<string>")
    got = df.select(scoring.labeller(Fixed)(F.col("t")).alias("x"), scoring.line_labeller(Fixed)(F.col("c")).alias("y")).collect()
    assert [r["x"]["label"] for r in got] == [2, 0]
    assert [[e["label"] for e in r["y"]] for r in got] == [[1, 3], []]
    model = scoring.CharTrigrams(["abcabc"])
    assert model.perplexity("abc") < model.perplexity("xyz")
    assert scoring.sliding_perplexity(lambda places, new: 1.0, 2000) == pytest.approx(2.718281828)
    assert scoring.encode_chars("ab?", {"a": 0, "b": 1, "<UNK>": 2, "<PAD>": 3}, 5) == [0, 1, 2, 3, 3]


def test_trigrams_of_the_whole_benchmark(spark, tmp_path):
    from siltstone.plans.queries import trigram_perplexity

    texts = [f"item {i}" for i in range(1000)] + ["zebra zebra é😀"] * 500 + [""]
    spark.createDataFrame(list(enumerate(texts)), "item_id int, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    asked = ["a zebra", "item 7", "é😀?"]
    spark.createDataFrame(list(enumerate(asked)), "doc_id int, text string").write.parquet(f"{tmp_path}/documents.parquet")
    whole = scoring.CharTrigrams(texts)
    got = {r["doc_id"]: r["perplexity"] for r in trigram_perplexity(spark, str(tmp_path)).collect()}
    for i, t in enumerate(asked):
        assert got[i] == pytest.approx(whole.perplexity(t), abs=1e-6)


def test_split_rejects_loses_no_row(spark):
    df = spark.createDataFrame([(1, "short"), (2, None), (3, ""), (4, "label")], "i int, why string")
    stay, gone = writers.split_rejects(df, F.nullif("why", F.lit("")))
    assert stay.columns == ["i", "why"] and sorted(r["i"] for r in stay.collect()) == [2, 3]
    assert sorted((r["i"], r["reject_reason"]) for r in gone.collect()) == [(1, "short"), (4, "label")]
    empty = writers.split_rejects(df.limit(0), F.col("why"))
    assert [x.count() for x in empty] == [0, 0]


def test_conversion_table_from_rows(spark):
    rows = [("tw", "a", "x"), ("tw", "a", "y"), ("tw", "ab", "z"), ("hk", "a", "q")]
    table = conversion.read_table(spark.createDataFrame(rows, "variant string, from string, to string"), "tw")
    assert table == {"a": "y", "ab": "z"}
    df = spark.createDataFrame([("aab",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(conversion.converter(table)(F.col("t"))).collect()] == ["yz", None, ""]


def test_function_of_a_line(spark):
    df = spark.createDataFrame([("ab",), (None,), ("",), ("x",)], "t string")
    upper = scoring.per_line(lambda: lambda t: t.upper() if t != "x" else None)
    assert [r[0] for r in df.select(upper(F.col("t"))).collect()] == ["AB", None, "", None]


def test_repair_keeps_quotes_and_entities(spark):
    df = spark.createDataFrame([("“a” &amp; ﬁ",), (None,)], "t string")
    assert [r[0] for r in df.select(repair.repair_keeping_quotes(F.col("t"))).collect()] == ["“a” &amp; fi", None]
    assert df.select(repair.repair(F.col("t"))).first()[0] == '"a" & fi'
