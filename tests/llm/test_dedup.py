import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from siltstone.llm import simhash as S
from siltstone.llm import substring_dedup as dedup
from siltstone.llm.exact_dedup import exact_dedup
from siltstone.llm.substring_dedup import compact_windows, near_passages, numbered, substring_dedup, tokens


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i))
    keep = {k: (min(v)[1], len(v)) for k, v in groups.items()}
    return sorted((i, *keep[n], i == keep[n][0], hashlib.sha256(n.encode()).hexdigest()) for i, t in rows for n in [re.sub(r"[\x20\x09-\x0D]", "", t or "")])


def test_exact(docs_of, edge):
    rows = list(enumerate([*edge, "thesametexthere", "the  same text here"]))
    got = exact_dedup(docs_of([(i, t, "en", "s") for i, t in rows])).collect()
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["digest"]) for r in got) == brute_exact(rows)


def test_exact_with_colliding_digests(docs_of, edge):
    rows = list(enumerate(edge))
    weak = lambda c: F.substring(F.sha2(c, 256), 1, 1)
    got = exact_dedup(docs_of(edge), salts=3, digest=weak).collect()
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got) == [x[:4] for x in brute_exact(rows)]


def test_exact_of_odd_tables(docs_of):
    assert exact_dedup(docs_of(["x"]).limit(0)).count() == 0
    got = exact_dedup(docs_of([(None, "a", "en", "s"), (-5, "a", "en", "s"), (None, "b", None, None), (7, "c", "en", "s"), (7, "c", "en", "s")])).collect()
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"]) for r in got) == [("-5", "-5", 2, True), ("7", "7", 2, True), ("7", "7", 2, True), ("None", "-5", 2, False), ("None", "None", 1, True)]


def brute_print(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    sh = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    label = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    return label


def test_simhash(docs_of, edge):
    rng = random.Random(1)
    base = [" ".join(rng.choice("abcdefghijklmnop") * rng.randint(1, 3) for _ in range(80)) for _ in range(12)]
    near = [t + " extra" for t in base[:8]] + [t.replace("a", "A") for t in base[:4]]
    texts = [*edge, *base, *near, "One", "one two", "éÉ A b"]
    got = {r["doc_id"]: r for r in S.simhash_components(docs_of(texts), tile=2).collect()}
    prints = [brute_print(t) for t in texts]
    assert [got[i]["fingerprint"] for i in range(len(texts))] == [f"{p:016x}" for p in prints]
    assert [got[i]["component_id"] for i in range(len(texts))] == brute_components(prints)


def test_simhash_pieces():
    text = " ".join(f"W{i % 97}" for i in range(5000))
    whole = S.fingerprints([text])
    for size in (100, 1000):
        words = [w for p in S.word_pieces(text.lower().encode(), size) for w in p]
        assert words == text.lower().encode().split()
    assert int(whole[0]) == brute_print(text)


def test_links_of_hot_groups(spark):
    """Many fingerprints around one: tiles of all sizes give the same components as comparing all pairs."""
    rng = np.random.default_rng(3)
    centre = int(rng.integers(0, 2**63))
    prints = sorted({centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 62, (300, 2))} | {int(x) for x in rng.integers(0, 2**63, 100)})
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    want = brute_components(prints)
    for tile, dense in ((8, 1), (8, 4), (64, 2), (64, 100), (4096, 1)):
        labels = {r["v"]: r["label"] for r in S.connected(S.near_links(df, tile=tile, dense=dense)).collect()}
        assert [labels.get(p, p) for p in prints] == [min(q for q, x in zip(prints, want) if x == want[i]) for i in range(len(prints))]


def test_bands():
    """Any two fingerprints within the radius agree under an outer mask, and under an inner one of it."""
    rng = random.Random(7)
    for radius in (1, 3, 5):
        outer = S._bands(radius)
        assert sum(outer) == 2**64 - 1
        for _ in range(200):
            apart = sum(1 << b for b in rng.sample(range(64), radius))
            same = [m for m in outer if not m & apart]
            assert same and all(any(not x & apart for x in S._bands(radius, m)) for m in same)
            assert all(x & m == m and x != m for m in outer for x in S._bands(radius, m))


def test_simhash_of_odd_tables(docs_of):
    assert S.simhash_components(docs_of(["x"]).limit(0)).count() == 0
    got = S.simhash_components(docs_of([(None, "a b c d", "en", "s"), (3, "a b c d", "en", "s"), (3, "a b c d", "en", "s"), (None, None, "en", "s")])).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in got) == [("3", "3"), ("3", "3"), ("None", "3"), ("None", "None")]


def brute_windows(h, size):
    out = set()

    def cut(lo, hi):
        if hi - lo + 1 >= size:
            c = min(range(lo, hi + 1), key=lambda i: (h[i], i))
            out.add((lo, c, hi))
            cut(lo, c - 1)
            cut(c + 1, hi)

    cut(0, len(h) - 1)
    return out


def test_compact_windows():
    rng = np.random.default_rng(5)
    for n in (0, 3, 7, 8, 60, 400):
        h = rng.integers(0, 2**63, n).astype(np.uint64) << np.uint64(1)
        for size in (3, 8, 20):
            got = compact_windows(h, np.array([0]), np.array([n]), size)
            assert {(int(a), int(b), int(c)) for _, a, b, c in zip(*got)} == brute_windows(h.tolist(), size)
    h = rng.integers(0, 2**63, 100).astype(np.uint64)
    two = compact_windows(h, np.array([0, 40]), np.array([40, 100]), 10)
    assert {int(t) for t in two[0]} == {0, 1} and all((b < 40) == (t == 0) for t, b in zip(two[0], two[3]))


def test_passages(docs_of, edge):
    rng = random.Random(2)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage, filler = words(60), [words(100) for _ in range(6)]
    nearly = passage[:30] + ["changed"] + passage[31:]
    texts = [*edge, " ".join(filler[0] + passage + filler[1]), " ".join(filler[2] + passage), " ".join(passage + filler[3]), " ".join(filler[4] + nearly), " ".join(filler[5]), " ".join(passage[:40] + words(40))]
    n = len(edge)
    got = {r["doc_id"]: r for r in substring_dedup(docs_of(texts)).collect()}
    assert len(got) == len(texts)
    assert got[n]["n_dup_words"] == 0 and got[n + 4]["n_dup_words"] == 0 and got[n + 5]["n_dup_words"] == 0
    assert [(s["start"], s["end"]) for s in got[n + 1]["spans"]] == [(100 - k, 160) for k in (100 - got[n + 1]["spans"][0]["start"],)] and got[n + 1]["n_dup_words"] >= 60
    assert got[n + 2]["n_dup_words"] >= 60 and got[n + 2]["partners"] == [n]
    assert got[n + 3]["n_dup_words"] >= 50
    assert near_passages(numbered(docs_of(["x"]).limit(0), "doc_id", "text")[0]).count() == 0


def test_passages_of_frequent_lines(docs_of):
    rng = np.random.default_rng(5)
    fill = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 10**9, n))
    lines = [fill(20) for _ in range(36)]
    # each line alone, in other company twice, and then threes of lines that only two or three later documents share
    texts = [f"{fill(40)} {x} {fill(40)}" for x in lines for _ in range(2)]
    texts += [f"{fill(45)} {lines[i]} {fill(30)} {lines[i]}" for i in range(12)]
    for i in range(0, 36, 3):
        texts += [f"{fill(30)} {' '.join(lines[i : i + 3])} {fill(35)}" for _ in range(2 + i % 2)]
    seen, want = {}, {}
    for i, t in enumerate(texts):
        w = t.split()
        places = [(p, " ".join(w[p : p + 50])) for p in range(len(w) - 49)]
        want[i] = {p + x for p, s in places if s in seen for x in range(50)}
        for _, s in places:
            seen.setdefault(s, i)
    assert sum(map(len, want.values())) >= 12 * 60
    # one task, so that the lines alone come first in every group
    rows = {r["doc_id"]: r for r in substring_dedup(docs_of(texts).coalesce(1)).collect()}
    for i in want:
        got = {x for s in rows[i]["spans"] for x in range(s["start"], s["end"])}
        assert want[i] <= got and (want[i] or not got), i


def brute_passages(texts, least=50, width=5, similarity=0.8):
    """Per text, the words inside stretches of `least` words of which an earlier text has enough shingles side by side.

    A stretch counts if some stretch of an earlier text, as long, shares `similarity` of the shingles.
    """
    size = least - width + 1
    need = int(np.ceil(similarity * size - 1e-9))
    shingles = [[" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] for w in (t.split() for t in texts)]
    out = []
    for i, own in enumerate(shingles):
        hit = set()
        for there in shingles[:i]:
            places = {}
            for q, s in enumerate(there):
                places.setdefault(s, []).append(q)
            for p in range(len(own) - size + 1):
                at = sorted(q for s in set(own[p : p + size]) for q in places.get(s, ()))
                if len(at) >= need and any(len({there[q] for q in at if lo <= q < lo + size}) >= need for lo in at):
                    hit |= set(range(p, p + least))
        out.append(hit)
    return out


def test_recall_of_near_passages_by_similarity(docs_of):
    """Against brute force, on passages of which 0, 1 or 2 words were changed (52 words have 48 shingles, a word is in five)."""
    rng = random.Random(11)
    fill = lambda n: [f"f{rng.randrange(10**7)}" for _ in range(n)]
    texts, changed = [], []
    for group in range(30):
        passage = fill(56)
        for copy in range(3):
            own, n = list(passage), group % 3 if copy else 0
            for at in rng.sample(range(3, 53), n):
                own[at] = fill(1)[0]
            texts.append(" ".join(fill(20) + own + fill(rng.randint(5, 30))))
            changed.append(n)
    want, caught, total, wrong = brute_passages(texts), {}, {}, 0
    got = {r["doc_id"]: {x for s in r["spans"] for x in range(s["start"], s["end"])} for r in substring_dedup(docs_of(texts)).collect()}
    for i, hit in enumerate(want):
        total[changed[i]] = total.get(changed[i], 0) + bool(hit)
        caught[changed[i]] = caught.get(changed[i], 0) + bool(hit and len(got[i] & hit) >= 0.9 * len(hit))
        wrong += bool(got[i] and not hit)
    assert wrong == 0 and total[0] == 20 and total[1] == 20 and total[2] >= 5, (total, wrong)
    assert caught[0] == total[0] and all(caught[n] >= 0.9 * total[n] for n in total), (caught, total)


def test_near_passages_that_the_first_lacks(docs_of):
    """Passages that only later documents share, and only nearly, where the firsts of their groups have frequent lines of them or other variants."""
    rng = random.Random(7)
    fill = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]

    def changed(own, *places):
        own = list(own)
        for at in places:
            own[at] = fill(1)[0]
        return own

    lines = [fill(20) for _ in range(36)]
    texts = [fill(40) + x + fill(40) for x in lines for _ in range(2)] + [fill(45) + x + fill(30) + x for x in lines[:12]]
    for i in range(0, 36, 3):
        three = sum(lines[i : i + 3], [])
        texts += [fill(30) + changed(three, *at) + fill(35) for at in ([], [29], [31])[: 2 + i % 2]]
    # forty variants that differ from each other by more, and a near copy of each
    passage = fill(56)
    variants = [changed(passage, *rng.sample(range(8, 48), 3)) for _ in range(40)]
    texts += [fill(20) + x + fill(30) for x in variants] + [fill(20) + changed(x, 4) + fill(30) for x in variants]
    texts = [" ".join(x) for x in texts]
    want = brute_passages(texts)
    assert sum(map(bool, want)) >= 12 + 40
    # one task, so that the lines alone come first in every group
    rows = {r["doc_id"]: r for r in substring_dedup(docs_of(texts).coalesce(1)).collect()}
    got = [{x for s in rows[i]["spans"] for x in range(s["start"], s["end"])} for i in range(len(texts))]
    assert [i for i, hit in enumerate(want) if not hit <= got[i]] == []
    assert [i for i, hit in enumerate(want) if got[i] and not hit] == []


def test_passages_that_do_not_match_are_hardly_compared(docs_of, monkeypatch):
    """Texts of one frequent line and three runs of a word, any two with at most one run in common: each has enough known tokens, none has them from one text."""
    raw, pairs, candidates = [], [], dedup._candidates

    def counted(ask, others):
        raw.append(ask.join(others, "token").filter("rep < doc").select("doc", "block", "rep", "there").distinct().count())
        out = candidates(ask, others)
        pairs.append(out.count())
        return out

    monkeypatch.setattr(dedup, "_candidates", counted)
    line = " ".join(f"line{i}" for i in range(14))
    own = lambda n, k: " ".join(f"own{n}{k}{i}" for i in range(50))
    texts = [" ".join([own(n, "x"), line, *[f"a{n % 11}"] * 18, *[f"b{n // 11}"] * 18, *[f"c{(n + n // 11) % 11}"] * 18, own(n, "y")]) for n in range(121)]
    assert {r["n_dup_words"] for r in substring_dedup(docs_of(texts)).collect()} == {0}
    assert sum(raw) > 1000
    assert sum(pairs) < 100


def test_what_passages_ask_for():
    """Any other side of a passage has one of the tokens that it asks for, and by its digest enough of the others."""
    rng, size, need = np.random.default_rng(2), 46, 37
    for _ in range(40):
        token = rng.integers(1, 2**63, 300).astype(np.uint64)[rng.integers(0, rng.choice([20, 60, 300]), 120)]
        cost = {x: rng.integers(0, 9) for x in np.unique(token).tolist()}
        rare = np.array([cost[x] for x in token.tolist()])
        places = np.sort(rng.choice(len(token) - size + 1, 20, replace=False))
        asks = dedup._keys(token, rare, places, size, size - need + 1)
        for p in places.tolist():
            own, known = token[p : p + size], rare[p : p + size] > 0
            lost = set()
            for x in rng.permutation(np.unique(own[known])).tolist():  # the other side loses tokens while enough are left
                if (known & ~np.isin(own, [*lost, x])).sum() >= need:
                    lost.add(x)
            there = np.unique(own[known & ~np.isin(own, list(lost))])
            if (known & np.isin(own, there)).sum() < need:
                continue
            has = dedup._digest(there[None])[0]
            mine = asks[(asks[:, 1] <= p) & (p < asks[:, 1] + dedup.TOGETHER)]
            mine = mine[(mine[:, 2] >> (p - mine[:, 1]) & 1 == 1) & np.isin(token[mine[:, 0]], there)]
            need_, must = mine[:, 4 : 4 + dedup.DIGEST], mine[:, 4 + dedup.DIGEST :]
            assert len(mine) and (np.bitwise_count((need_ & ~has).view(np.uint64)).sum(axis=1) <= mine[:, 3]).all() and not (must & ~has).any()


def test_passages_of_rows_that_share_an_id(docs_of):
    rng = random.Random(3)
    fill = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passage, short = fill(60), fill(10)
    rows = [(1, fill(20) + " " + passage, "en", "s"), (2, short, "en", "s"), (2, passage + " " + fill(30), "en", "s"), (2, short, "en", "s"), (None, fill(80), "en", "s"), (None, passage, "en", "s")]
    got = [(r["doc_id"], r["n_dup_words"], [(s["start"], s["end"]) for s in r["spans"]], r["partners"]) for r in substring_dedup(docs_of(rows)).collect()]
    assert len(got) == 6
    assert sorted(x[1] >= 60 for x in got if x[0] == 2) == [False, False, True] and sorted(x[1] for x in got if x[0] is None) == [0, 60]
    assert all(x[2] == [(0, x[1])] and x[1] < 75 and x[3] and set(x[3]) <= {1, 2} for x in got if x[1])


def test_tokens_are_of_five_words():
    assert len(tokens("a b c d", 5)) == 0 and len(tokens("a b c d e f", 5)) == 2
    assert tokens("A, b. C d e", 5)[0] == tokens("a b c d e", 5)[0]


def test_runs_of_one_word_take_few_windows():
    """Ties are one window for many places; each place is in one window of each function still, by the same value."""
    rng = np.random.default_rng(8)
    size = 46
    own = tokens(" ".join([*(f"a{i}" for i in range(60)), *["word"] * 2000, *(f"b{i}" for i in range(60))]), 5)
    assert len(dedup._windows([1], [own], [0], 8, size)) <= 8 * (2000 // size + 12)
    for _ in range(60):
        h = np.repeat(rng.choice(rng.integers(0, 2**63, 30).astype(np.uint64), 80), rng.integers(1, 12, 80))
        size = int(rng.integers(2, 40))
        all_ = compact_windows(h, np.array([0, 90]), np.array([90, len(h)]), size)
        places = lambda w: sorted((t, s, int(h[c])) for t, l, c, r in zip(*(x.tolist() for x in w)) for s in range(max(l, c - size + 1), min(c, r - size + 1) + 1))  # noqa: B023, E731
        assert places(dedup.without_ties(h, all_, size)) == places(all_)


def test_words_are_hashed_by_array():
    rng = random.Random(9)
    texts = ["", None, "a", "...", *(" ".join("xyzé"[rng.randrange(4)] * rng.randint(1, 90) + str(rng.randrange(99)) for _ in range(300)) for _ in range(9))]
    assert [x.tolist() for x in dedup.tokens_of(texts, 3)] == [tokens(t, 3).tolist() for t in texts]
    raw = " ".join(re.sub(r"[.\s]+", " ", t or "") for t in texts).encode()
    h, start = dedup.word_hashes(raw)
    assert [raw[a:].split(None, 1)[0] for a in start.tolist()] == raw.split()
    assert h.tolist() == [xxhash.xxh64_intdigest(w) for w in raw.split()]


def test_windows_are_dealt_and_regions_joined():
    rng = np.random.default_rng(10)
    rows = dedup._paired(*np.sort(rng.integers(0, 40, (3, 500)), axis=1), own=False)
    out = dedup._dealt(rows, 7)
    told = [tuple(x) for p, n in ((False, 3), (True, 4)) for x in dedup._told(out["data"][out["pairs"] == p], n).T.tolist()]
    assert sorted(told) == sorted((d, a, e, b) if b != dedup.NONE else (s, d, a) for s, d, a, e, b in rows.itertuples(index=False))

    names = [x.split()[0] for x in dedup.LAID.split(", ")]
    laid = sorted((int(d), int(p), int(a), int(a + n), int(a), int(a + n), 1 << int(k)) for d, p, a, n, k in rng.integers(0, [3, 3, 900, 12, 8], (150, 5)))
    want = []
    for d, p, a, b, ra, rb, m in laid:
        if want and want[-1][:2] == [d, p] and want[-1][3] + 5 >= a:
            x = want[-1]
            want[-1] = [d, p, x[2], max(x[3], b), min(x[4], ra), max(x[5], rb), x[6] | m]
        else:
            want.append([d, p, a, b, ra, rb, m])
    for step in (1, 7, 150):
        batches = [pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64() if i < 2 else pa.int32()) for i, c in enumerate(zip(*laid[j : j + step]))], names=names) for j in range(0, 150, step)]
        assert [list(r.values()) for x in dedup.regions(batches, 5) for r in x.to_pylist()] == want
