"""Source mixing, Jaccard join, URL rules, exact top-k."""

import math
import random
import re
import time
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import ngram_join, source_mix
from gridloom.llm.exact_topk import Block, ImpactIndex, exact_top_k
from gridloom.llm.ngram_join import jaccard_components
from gridloom.llm.source_mix import mix_sources
from gridloom.llm.url_rules import judge_urls
from tests.llm.helpers import documents, empty, texts

SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, weights, most):
    """Water-filling, one source stopped at a time."""
    left, free, out = float(sum(sizes.values())), set(sizes), {}
    while free:
        level = left / sum(weights[s] for s in free)
        full = [s for s in free if level * weights[s] >= most * sizes[s]]
        if not full:
            return out | {s: level * weights[s] for s in free}
        s = min(full, key=lambda s: sizes[s] / weights[s])
        out[s] = most * sizes[s]
        left -= out[s]
        free.remove(s)
    return out


def test_mix(spark):
    r = random.Random(4)
    rows = [(k, "w " * r.randint(0, 60), ["b", "a", None, "c", "tiny"][min(4, k % 9)] if k % 9 < 4 or k < 20 else "a") for k in range(900)]
    df = spark.createDataFrame([(k, t, s, "x") for k, t, s in rows], "doc_id long, text string, source string, target string")
    got = mix_sources(df, [1, 2, 3], most=3.0).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mix_sources(df, [1, 2, 3], most=3.0).collect()), key=repr)
    sizes, taken, said = defaultdict(int), defaultdict(int), {}
    for x in got:
        sizes[x["source"]] += x["size"]
        taken[x["source"]] += x["size"] * x["copies"]
        said[x["source"]] = x["target"]
        assert x["copies"] <= 3
    order = sorted(sizes, key=lambda s: (s is None, s))
    want = targets(sizes, {s: [1, 2, 3][i % 3] for i, s in enumerate(order)}, 3)
    for s in order:
        assert said[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= 20


def test_mix_edges(spark):
    got = mix_sources(documents(spark), [1, 2, 3]).collect()
    assert len(got) == documents(spark).count()
    assert mix_sources(empty(spark), [1, 2, 3]).count() == 0
    nothing = documents(spark, [(1, None), (2, ""), (2, "")])
    assert [x["copies"] * x["size"] for x in mix_sources(nothing, [1]).collect()] == [0, 0, 0]


def brute_mix(spark, rows, weights=(1, 2, 3), most=3.0, seed=17):
    """Copies of each row of (id, text, source), in the order of the rows, by the definition: certain copies, then the
    order by random over inclusion odds, from which what still fits is taken until nothing does."""
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k long, doc_id long, text string, source string")
    hashes = df.select("k", F.xxhash64(F.lit(seed), "doc_id", "text").alias("u"), F.xxhash64("text", F.lit(seed)).alias("tie")).collect()
    at = {r["k"]: ((abs(r["u"]) % (1 << 52)) / float(1 << 52), r["tie"]) for r in hashes}
    size = [len(SPACES.findall(t or "")) for _, t, _ in rows]
    total = defaultdict(int)
    for (_, _, s), n in zip(rows, size):
        total[s] += n
    order = sorted(total, key=lambda s: (s is None, s or ""))
    want = targets(dict(total), {s: weights[i % len(weights)] for i, s in enumerate(order)}, most)
    copies = [0] * len(rows)
    for s in order:
        mine = [k for k, r in enumerate(rows) if r[2] == s and size[k]]
        if not mine:
            continue
        ratio = want[s] / total[s]
        ratio = round(ratio) if abs(ratio - round(ratio)) < 1e-9 else ratio
        for k, r in enumerate(rows):
            if r[2] == s and not size[k]:
                copies[k] = math.floor(ratio)  # of no words
        middle = round(sum(size[k] * math.log(size[k]) for k in mine) / total[s], 6)
        reach = max(middle - math.log(min(size[k] for k in mine)), math.log(max(size[k] for k in mine)) - middle)
        queue = []
        for k in mine:
            expected = ratio + 0.5 * min(ratio, most - ratio) * ((middle - math.log(size[k])) / reach if reach > 1e-5 else 0.0)
            expected = round(expected) if abs(expected - round(expected)) < 1e-9 else expected
            copies[k] = math.floor(expected)
            p, (u, tie) = expected - copies[k], at[k]
            if p > 1e-9:
                queue.append(((u / (1 - u)) / (p / (1 - p)), tie, k))
        room = want[s] - sum(copies[k] * size[k] for k in mine)
        queue.sort()
        while queue := [x for x in queue if size[x[2]] <= room]:
            while queue and size[queue[0][2]] <= room:
                k = queue.pop(0)[2]
                copies[k] += 1
                room -= size[k]
    return copies


def mix_rows(n=500, seed=9):
    r = random.Random(seed)
    return [(k, "w%d " % k * int(r.paretovariate(0.8) * 3), r.choice(["hot"] * 5 + ["b", "c", None])) for k in range(n)]


def test_selection_is_brute_force(spark):
    rows = mix_rows() + [(3, None, "b"), (None, "no id", "c"), (None, "no id", "c"), (7, "w " * 9, "one")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix_sources(df.withColumn("t", F.col("text")), [1, 2, 3], keep=["t"]).collect()
    want = brute_mix(spark, rows)
    assert sorted(repr((r["doc_id"], r["t"], r["copies"])) for r in got) == sorted(repr((i, t, c)) for (i, t, _), c in zip(rows, want))


def test_many_sources_are_salted(spark, monkeypatch):
    rows = mix_rows(150)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = sorted(tuple(map(str, r)) for r in mix_sources(df, [1, 2, 3]).collect())
    monkeypatch.setattr(source_mix, "BROADCAST", 0)
    monkeypatch.setattr(source_mix, "SALTS", 3)
    assert sorted(tuple(map(str, r)) for r in mix_sources(df, [1, 2, 3]).collect()) == want


def test_inclusion_follows_its_odds(spark):
    rows = [(k, "w " * (4 if k % 2 else 64), "s") for k in range(1200)] + [(k, "w " * 2000, "t") for k in range(2000, 2003)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix_sources(df, [1, 1]).filter("source = 's'").groupBy("size").agg(F.avg("copies").alias("c"), F.first(F.col("target") / F.col("source_size")).alias("ratio")).collect()
    share = {r["size"]: r["c"] for r in got}
    ratio = got[0]["ratio"]
    assert 0.2 < ratio < 2.8
    middle = (4 * math.log(4) + 64 * math.log(64)) / 68
    for n in (4, 64):
        lean = (middle - math.log(n)) / max(middle - math.log(4), math.log(64) - middle)
        assert share[n] == pytest.approx(ratio + 0.5 * min(ratio, 3 - ratio) * lean, abs=0.06)


def brute_components(rows):
    sets = []
    for _, t in rows:
        w = SPACES.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), i), i)
    return sorted((i, len(sets[k]), least[find(k)]) for k, (i, _) in enumerate(rows))


def test_jaccard_is_brute_force(spark):
    r = random.Random(8)
    words = [f"w{k}" for k in range(400)]
    passage = [r.choice(words) for _ in range(30)]
    rows = []
    for k in range(40):
        base = [r.choice(words) for _ in range(r.choice([1, 3, 4, 5, 6, 20, 60, 120]))] + (passage if k % 2 else [])
        rows.append(base)
        for _ in range(r.randint(0, 6)):
            copy = list(base)
            for _ in range(r.randint(0, max(1, len(copy) // 40))):
                copy[r.randrange(len(copy))] = r.choice(words)
            rows.append(copy[r.randint(0, 2) :] if len(copy) > 9 else copy)
    rows = [(k, " ".join(w)) for k, w in enumerate(rows)] + [(k + 1000, t) for k, t in enumerate(texts(20))]
    r.shuffle(rows)
    got = sorted(tuple(x) for x in jaccard_components(documents(spark, rows)).collect())
    assert got == brute_components(rows)


def test_large_groups_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LARGE_MEMBERS", 2)
    monkeypatch.setattr(ngram_join, "PARTS", 3)
    r = random.Random(3)
    base = [[f"{c}{k}" for k in range(60)] for c in "abc"]
    rows = []
    for k in range(60):
        copy = list(base[k % 3])
        for _ in range(k % 5):
            copy[r.randrange(60)] = f"x{r.randrange(20)}"
        rows.append((k, " ".join(copy[: 60 - k % 7])))
    got = sorted(tuple(x) for x in jaccard_components(documents(spark, rows)).collect())
    assert got == brute_components(rows)


def test_long_texts_are_hashed_in_stretches(monkeypatch):
    r = random.Random(1)
    texts = [" ".join(r.choice(["a", "bb", "x" * 70, "\n"]) for _ in range(300)), "one two", None, "z" * 500, "z" * 500 + " end of it all now"]
    whole = [x.tolist() for x in ngram_join.Shingler().sets(texts)]
    monkeypatch.setattr(ngram_join, "STRETCH", 40)
    assert [x.tolist() for x in ngram_join.Shingler().sets(texts)] == whole


def test_jaccard_edges(spark):
    got = jaccard_components(documents(spark)).collect()
    assert len(got) == documents(spark).count()
    assert all(x["component_id"] is None for x in got if x["doc_id"] is None)
    assert jaccard_components(empty(spark)).count() == 0


RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("example.com", "", "block"), ("b.example.com", "/", "allow")]


def brute_rule(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.sub("[A-Z]", lambda m: m[0].lower(), re.match(r"[^/?#]*", rest)[0])
    path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in RULES if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = min(fits, key=lambda x: (-x[0], -x[1], x[2])) if fits else None
    return host, path, best and best[2], best[3] if best else "allow"


def test_urls(spark):
    urls = [
        None, "", "nothing", "http://", "http://X.Com/en/1", "https://a.b.EXAMPLE.com/en/7?q=/en/#x", "ftp://example.com", "http://example.com?x#y", "http://example.com#/en/7",
        "http://notexample.com/en/7", "x://b.example.com//", "http://a..com/en/", "http://example.com./en/7", "http://a://b.com/en/", "http://example.com:80/en/7", "http://example.com/en/7\nz", "http://com/en/",
    ]
    urls += ["http://" + "a." * 50_000 + "example.com/en/7" + "x" * 100_000, "http://example.com/" + "en/" * 100_000, "x" * 200_000]
    pages = spark.createDataFrame([(k, u, "p", "r") for k, u in enumerate(urls)] + [(4, urls[4], "p", "r")], "page_id long, url string, path string, rule string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = sorted(map(repr, map(tuple, judge_urls(pages, rules).collect())))
    assert got == sorted(repr((k, *brute_rule(u))) for k, u in [*enumerate(urls), (4, urls[4])])
    assert judge_urls(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in judge_urls(pages, rules.limit(0)).collect()} == {"allow"}


def test_top_k(spark):
    g = np.random.default_rng(6)
    rows = [(k, [float(x) for x in g.normal(size=8)]) for k in range(300)]
    rows += [(300 + k, [0.5] * 8) for k in range(40)]  # ties
    rows += [(400, None), (401, [None] * 8), (402, [float("nan")] + [0.0] * 7), (403, [float("inf")] * 8), (404, [1.0] * 3), (450, [2.0] * 3), (None, [1.0] * 8), (7, rows[7][1])]
    df = spark.createDataFrame([(i, v, "s") for i, v in rows], "vec_id long, embedding array<float>, score string")
    got = sorted(tuple(x) for x in exact_top_k(df, F.col("vec_id") % 50 == 0, 5).collect())
    ints = [(i, np.floor(np.float64(np.float32(v)) * 256).astype(int)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    want = []
    for i, q in {i: v for i, v in ints if i % 50 == 0}.items():
        scored = sorted((-int(q @ v), j) for j, v in ints if j != i and len(v) == len(q))[:5]
        want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(scored)]
    assert got == sorted(want)
    assert exact_top_k(df.limit(0), F.col("vec_id") % 50 == 0, 5).count() == 0


def test_top_k_beyond_64_bits(spark):
    rows = [(0, [1e8] * 4), (1, [1e8] * 4), (2, [-1e8] * 4), (3, [3.0, 1.0, 0.0, 2.0]), (50, [1.0, 2.0, 3.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(x) for x in exact_top_k(df, F.col("vec_id") % 50 == 0, 2).collect())
    held = {i: [int(256 * x) for x in v] for i, v in rows}
    score = lambda a, b: max(-(1 << 63), min((1 << 63) - 1, sum(x * y for x, y in zip(held[a], held[b]))))
    assert score(0, 1) == (1 << 63) - 1
    assert got == [(0, 1, 1, score(0, 1)), (0, 2, 50, score(0, 50)), (50, 1, 0, score(50, 0)), (50, 2, 1, score(50, 1))]


def test_equal_rows_are_rows_of_their_own(spark):
    df = spark.createDataFrame([(0, [1.0, 1.0])] * 3 + [(7, [2.0, 2.0])] * 9 + [(8, [1.0, 0.0])], "vec_id long, embedding array<double>")
    got = [tuple(x) for x in exact_top_k(df, F.col("vec_id") % 50 == 0, 5).orderBy("rank").collect()]
    assert got == [(0, k, 7, 2 * 2 * 65536) for k in range(1, 6)]


def test_index_stops_only_on_proof():
    g = np.random.default_rng(2)
    for spread in (1, 300):
        vectors = g.integers(-spread, spread + 1, size=(500, 16))
        index = ImpactIndex(vectors)
        for query in g.integers(-spread, spread + 1, size=(20, 16)):
            found = index.possible(query, 5, np.array([3]))
            scores = vectors @ query
            scores[3] = -(10**9)
            fifth = np.sort(scores)[-5]
            assert set(np.flatnonzero(scores >= fifth)) <= set(found)


def test_index_shares_its_rounds_among_queries():
    """A query costs about what scoring and sorting its block does; one by one over 2048 segments it took some twenty times that."""
    g = np.random.default_rng(7)
    vectors, queries = (np.floor(32 * g.normal(size=(n, 64))) for n in (8192, 128))
    ids, own = np.arange(8192), np.arange(128) - 100  # some are candidates themselves
    block, times = Block(), []
    block.add(ids, vectors)
    list(block.answer(own[:1], queries[:1], 5))  # the index is built once
    for answer in (lambda: sorted(block.answer(own, queries, 5)), lambda: [np.lexsort((ids, -(vectors @ q)))[:6] for q in queries]):
        start = time.process_time()
        got = answer()
        times.append(time.process_time() - start)
        if len(times) == 1:
            found = got
    want = [(int(o), int(i), int(vectors[i] @ q)) for o, q, best in zip(own, queries, got) for i in best[best != o][:5]]
    assert found == sorted(want)
    assert times[0] < 4 * times[1]


def test_index_of_odd_vectors():
    g = np.random.default_rng(8)
    blocks = [np.zeros((20, 4)), np.where(g.random((300, 6)) < 0.9, 0, g.integers(-9, 9, (300, 6))), np.full((1, 3), 7.0), g.integers(0, 2, (700, 1)).astype(float)]
    for vectors in blocks:
        ids, queries = np.arange(len(vectors)) // 2, np.r_[vectors[:5], -vectors[:5], np.zeros((1, vectors.shape[1]))]
        block = Block()
        block.add(ids, vectors)
        got = sorted(block.answer(np.arange(len(queries)), queries, 5))
        scores = [sorted((-int(v @ q), int(i)) for i, v in zip(ids, vectors) if i != o)[:5] for o, q in enumerate(queries)]
        assert got == sorted((o, i, -s) for o, best in enumerate(scores) for s, i in best)
