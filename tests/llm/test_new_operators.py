"""Yinyang clustering, SimHash links and ranked search against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from gridloom.llm import simhash_join
from gridloom.llm.lexical_search import postings, ranked
from gridloom.llm.simhash_join import Tree, fingerprint, linked, simhash_components
from gridloom.llm.yinyang import Round, cluster_digest, grouped, yinyang
from tests.llm.helpers import documents, empty, texts

LONG = (1 << 63) - 1


# Yinyang


def lloyd(rows, k, rounds, scale=256, seed="2:"):
    """(assignments, distances, centroids) with Python's integers; rows are (id, whole components)."""
    order = sorted((hashlib.sha256(f"{seed}{i}".encode()).hexdigest(), v) for i, v in rows if i is not None)
    centres = [list(v) for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in rows]
        for j in set(at):
            mine = [v for (_, v), a in zip(rows, at) if a == j]
            centres[j] = [sum(x) // len(mine) for x in zip(*mine)]
    return [nearest(v) for _, v in rows], centres


def compare(spark, data, k, rounds, dims=3, scale=1.0):
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, cluster int, v string")
    whole = lambda x: max(-(1 << 53), min(1 << 53, math.floor(x * scale)))
    kept = [(i, [whole(x) for x in v]) for i, v, *_ in data if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    found, centres = lloyd(kept, k, rounds)
    got = cluster_digest(yinyang(df, k=k, rounds=rounds, dims=dims, scale=scale)).collect()
    want = sorted(((i, c, min(d, LONG)) for (i, _), (d, c) in zip(kept, found)), key=repr)
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in got), key=repr) == want
    inertia = Counter()
    for d, c in found:
        inertia[c] += d
    for r in got:
        assert r["cluster_inertia"] == min(inertia[r["cluster"]], LONG) and r["inertia"] == min(sum(inertia.values()), LONG)
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centres[r["cluster"]])).encode()).hexdigest()


def test_yinyang_is_lloyd(spark):
    r = random.Random(1)
    heads = [[r.uniform(-90, 90) for _ in range(3)] for _ in range(25)]
    data = [(k, [x + r.gauss(0, 4) for x in heads[k % 25]], 7, "x") for k in range(400)]
    compare(spark, data, 24, 5)


def test_yinyang_ties_and_awkward_rows(spark):
    data = [(k % 50, [float(k % 3), float(k % 2), 0.0], 0, "") for k in range(120)]  # repeated ids, ties everywhere
    data += [(900, None, 0, ""), (901, [], 0, ""), (902, [1.0, None, 2.0], 0, ""), (903, [1.0, math.nan, 2.0], 0, ""), (904, [math.inf, 1.0, 2.0], 0, ""), (905, [1.0, 2.0], 0, ""), (None, [5.0, 5.0, 5.0], 0, "")]
    compare(spark, data, 6, 5)
    compare(spark, data[:4], 40, 2)


@pytest.mark.parametrize("size", [1e7, 1e9, 1e12, 1e300])
def test_yinyang_large_components(spark, size):
    r = random.Random(2)
    compare(spark, [(k, [r.choice([-1, 0, 1]) * size * r.choice([1, 1, 0.5]) + r.randint(-9, 9) for _ in range(3)], 0, "") for k in range(60)], 5, 3)


def test_yinyang_empty(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert cluster_digest(yinyang(none)).count() == 0
    assert cluster_digest(yinyang(none)).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_yinyang_bounds_spare_distances():
    r = np.random.default_rng(3)
    heads = r.integers(-500, 500, (40, 8)).astype(float)
    x = np.floor(heads[r.integers(0, 40, 3000)] + r.normal(0, 20, (3000, 8)))
    groups = grouped(heads)
    assert sorted(np.concatenate(groups)) == list(range(40)) and len(groups) > 1
    cluster, upper, lower = Round(heads, groups, np.zeros(40)).first(x)
    moved = heads + r.integers(-2, 3, heads.shape)
    step = Round(moved, groups, np.sqrt(((moved - heads) ** 2).sum(1)))
    cluster, *_ = step.assign(x, cluster, upper, lower)
    assert (cluster == ((x[:, None] - moved[None]) ** 2).sum(2).argmin(1)).all()
    assert step.scanned < 3000 * 40 / 10


# SimHash


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, bits):
    """Component by position, of (id, fingerprint)."""
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if (a ^ rows[j][1]).bit_count() <= bits:
                up[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[root(i)] = min(least.get(root(i), k), k)
    return [None if k is None else least[root(i)] for i, (k, _) in enumerate(rows)]


def test_fingerprint(monkeypatch):
    cases = [*texts(), "a b", "A\tB\x0bc d", " x y  z\n", "no\xa0break here now", "é É é x"]
    for size in (1 << 20, 7):  # texts are cut into stretches between words
        monkeypatch.setattr(simhash_join, "STRETCH", size)
        assert [fingerprint(t) for t in cases] == [plain_fingerprint(t) for t in cases]


def near(r, n, heads, flips):
    out = []
    for _ in range(n):
        p = r.choice(heads)
        for _ in range(r.randint(0, flips)):
            p ^= 1 << r.randrange(64)
        out.append(p)
    return out


@pytest.mark.parametrize("bits", [0, 1, 2, 5])
def test_trees_lose_no_link(bits):
    """Shards with their visitors, and the trees inside them, against all pairs."""
    r = random.Random(bits)
    points = np.array(sorted({*near(r, 900, [r.getrandbits(64) for _ in range(40)], 6), *[r.getrandbits(64) for _ in range(600)]}), np.uint64)
    tree = Tree(points[::4], 12, bits)
    assert tree.leaves > 10
    up = simhash_join.Forest(len(points))
    homes, met = 0, 0
    for _, home, visitors in tree.places(points):
        a, b = linked(points[home], points[visitors], bits)
        up.join(np.searchsorted(points, a), np.searchsorted(points, b))
        homes, met = homes + len(home), met + len(a)
        assert len(a) < len(home) + len(visitors)
    assert homes == len(points)
    want = brute_components([(k, int(p)) for k, p in enumerate(points)], bits)
    assert up.roots(np.arange(len(points))).tolist() == want


def test_simhash_components(spark, monkeypatch):
    monkeypatch.setattr(simhash_join, "SHARD", 32)
    r = random.Random(9)
    words = [f"w{k}" for k in range(200)]
    rows = [(k, t) for k, t in enumerate(texts())]
    for k in range(40):
        base = [r.choice(words) for _ in range(120)]
        for j in range(r.randint(1, 6)):
            some = list(base)
            for _ in range(r.choice([0, 0, 1, 2])):
                some[r.randrange(120)] = r.choice(words)
            rows.append((1000 + 10 * k + j, " ".join(some)))
    rows += [(None, rows[-1][1]), (None, None), (3, "another text of the id three"), (rows[5][0], rows[5][1])]
    got = simhash_components(documents(spark, rows)).collect()
    prints = [(k, plain_fingerprint(t)) for k, t in rows]
    want = sorted(((k, f"{p:016x}", c) for (k, p), c in zip(prints, brute_components(prints, 2))), key=repr)
    assert sorted(map(tuple, got), key=repr) == want
    assert len({c for *_, c in want}) < len(want) - 30


def test_simhash_edges(spark):
    assert simhash_components(empty(spark)).count() == 0
    got = simhash_components(documents(spark, [(5, None), (2, ""), (None, " "), (9, "one two three four")])).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(5, 2), (2, 2), (None, None), (9, 9)}


def test_simhash_hot_fingerprint(spark, monkeypatch):
    monkeypatch.setattr(simhash_join, "LARGE_CLASS", 8)
    rows = [(k, "the same words in each of these") for k in range(300, 340)] + [(k, f"own text number {k} of it all") for k in range(40)]
    got = {r["doc_id"]: r["component_id"] for r in simhash_components(documents(spark, rows)).collect()}
    assert len(got) == 80 and all(got[k] == 300 for k in range(300, 340))


# Ranked search


def plain_search(docs, items, k):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    held = [(i, Counter(find(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, total = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked = {}
    for i, t in set(items):
        asked.setdefault(i, Counter()).update(find(t))
    out = []
    for i, terms in asked.items():
        scores = []
        for d, c, n in held:
            m = 75 + 25 * n * n_docs // total
            s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t, q in terms.items() if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(i, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def test_search(spark, monkeypatch):
    from gridloom.llm import lexical_search

    monkeypatch.setattr(lexical_search, "BLOCK", 16)
    rows = [(k, t) for k, t in enumerate(texts(200, 5))] + [(None, "alpha omega omega"), (7, "alpha"), (7, "alpha"), (400, "!?"), (401, "Ünd ünd_x-ray")]
    items = [(1, "alpha BETA beta"), (1, "alpha BETA beta"), (1, "omega"), (2, ""), (3, None), (4, "nothing here matches zzz"), (None, "moon 42"), (6, "delta délta DÉLTA ünd"), (7, "x")]
    asked = spark.createDataFrame([(i, t, 1, "b") for i, t in items], "item_id long, text string, block int, term string")
    got = ranked(postings(documents(spark, rows)), asked, k=20)
    assert sorted(map(tuple, got.select("item_id", "rank", "doc_id", "score").collect()), key=repr) == plain_search(rows, items, 20)


def test_search_long_texts(spark, monkeypatch):
    from gridloom.llm import lexical_search

    monkeypatch.setattr(lexical_search, "STRETCH", 11)
    assert [lexical_search.term_counts(t) for t in ("Ab ab,c" * 30, "x" * 50 + " y", "", None)] == [
        (Counter(re.findall(rb"[a-z]+", b"ab ab,c" * 30)), len(re.findall(rb"[a-z]+", b"ab ab,c" * 30))),
        (Counter({b"x" * 50: 1, b"y": 1}), 2), (Counter(), 0), (Counter(), 0),
    ]


def test_search_empty(spark):
    items = spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    assert ranked(postings(empty(spark)), items).count() == 0
    assert ranked(postings(documents(spark)), items.limit(0)).count() == 0


def test_search_buckets_are_bounded_by_blocks(spark, monkeypatch):
    from gridloom.llm import lexical_search

    monkeypatch.setattr(lexical_search, "BLOCK", 10)
    index = postings(documents(spark, [(k, "hot words here") for k in range(95)]).coalesce(1))
    sizes = [(r["block"], len(r["at"])) for r in index.filter("term = 'hot'").collect()]
    assert len(sizes) == 10 and max(n for _, n in sizes) == 10 and sum(n for _, n in sizes) == 95
