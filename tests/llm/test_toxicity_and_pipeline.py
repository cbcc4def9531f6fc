import hashlib
import itertools
import math
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from gridloom.llm import toxicity
from gridloom.llm.byte_bpe import ranks_of
from gridloom.llm.toxicity import PATTERNS, LabelModel, Voters, fit_label_model, forest, held_out, score_toxicity
from tests.llm.helpers import documents, empty
from tests.llm.test_set_operators import brute_components, brute_mix

STEMS = ["zorga", "plimu"]  # unknown to the lexicons: must be learned from labels


def corpus(n=400):
    r = random.Random(11)
    rows, labels = [], []
    for k in range(n):
        words = ["".join(r.choice("aeioubdgklmnr") for _ in range(r.randint(3, 8))) for _ in range(r.randint(30, 80))]
        toxic = k % 5 == 0
        if toxic:
            for _ in range(4):
                words[r.randrange(len(words))] = r.choice(["idiot", "scum", "worthless"]) if k % 2 else r.choice(STEMS) + r.choice(["ta", "lin", "mo", "res"])
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def scored(spark):
    rows, labels = corpus()
    known = spark.createDataFrame([*labels, (3, None), (None, 1), (5, 0)], "doc_id long, toxic int")
    docs = documents(spark, rows + [(900, None), (901, ""), (None, "no id"), (0, rows[0][1]), (902, "long " * 30_000)])
    return docs, known, score_toxicity(docs, known).collect()


def test_held_out_rows_are_told_apart(scored):
    docs, _, got = scored
    truth = dict(corpus()[1])
    rest = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got if r["doc_id"] is not None)
    right = sum(r["predicted"] == truth[r["doc_id"]] for r in rest) / len(rest)
    assert len(rest) > 40 and right >= 0.95
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (900, 901)}) == 1


def test_no_labels_and_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = score_toxicity(documents(spark), none).collect()
    assert len(got) == documents(spark).count() and all(0 <= r["score"] <= 1 for r in got)
    assert score_toxicity(empty(spark), none).count() == 0


def test_voters():
    v = Voters(["=zap", "zor+"])
    assert v.vote(None) == v.vote("") == v.vote("plain words") == 0
    assert v.vote("ZAP it") & 1 and not v.vote("zorx once in a text " + "of many words " * 99) & 2 and v.vote("zorx zory") & 2
    assert [bool(p("you are an idiot! drop dead!!! @#$%")) for p in PATTERNS] == [True] * 4


def test_held_out_of_null(spark):
    assert spark.range(1).select(held_out(F.lit(None).cast("long"))).first()[0] is True


def test_forest_joins_what_says_the_same():
    r = np.random.default_rng(5)
    toxic = r.random(4000) < 0.3
    a = np.where(toxic, r.random(4000) < 0.6, r.random(4000) < 0.05)
    votes = np.stack([a, a, np.where(toxic, r.random(4000) < 0.5, r.random(4000) < 0.05)], 1).astype(float)
    joint = np.stack([votes[toxic == c].T @ votes[toxic == c] for c in (0, 1)])
    counts = np.array([(~toxic).sum(), toxic.sum()], float)
    parent = forest(joint, counts)
    assert {parent[0], parent[1]} <= {-1, 0, 1} and (parent[1] == 0 or parent[0] == 1)
    assert forest(joint[:, 2:, 2:], counts).tolist() == [-1]


def test_posterior_is_the_products(spark):
    model = LabelModel(0.2, np.array([-1, 0, 0]), np.log(np.random.default_rng(1).dirichlet([1, 1], size=(2, 2, 3))))
    for votes in itertools.product((0, 1), repeat=3):
        weight = [0.8, 0.2]
        for c in (0, 1):
            for k, v in enumerate(votes):
                above = votes[model.parent[k]] if model.parent[k] >= 0 else 0
                weight[c] *= math.exp(model.logs[c, above, k, v])
        assert model.posterior(np.array([votes]))[0] == pytest.approx(weight[1] / sum(weight))


def test_a_voter_heard_twice_counts_once(spark, monkeypatch):
    """Over votes of which two are the same the label model stays near the posteriors of the model without the copy;
    one in which all voters are taken as independent goes away from them."""
    r = np.random.default_rng(8)
    toxic = r.random(3000) < 0.3
    one = [np.where(toxic, r.random(3000) < t, r.random(3000) < f) for t, f in ((0.7, 0.1), (0.6, 0.1), (0.6, 0.05))]

    def fitted(columns):
        votes = np.stack(columns, 1)
        bits = [bytes(np.packbits(v, bitorder="little")) for v in votes]
        rows = [(b, int(t) if k % 4 == 0 else None) for k, (b, t) in enumerate(zip(bits, toxic))]
        return fit_label_model(spark.createDataFrame(rows, "bits binary, known int"), len(columns)).posterior(votes.astype(int))

    alone, twice = fitted(one), fitted([one[0], *one])
    assert ((alone >= 0.5) == toxic).mean() > 0.85
    monkeypatch.setattr(toxicity, "forest", lambda joint, counts: np.full(joint.shape[1], -1))
    apart = fitted([one[0], *one])
    assert np.abs(alone - twice).mean() < 0.5 * np.abs(alone - apart).mean()


def test_posteriors_teach_words_that_labels_lack(spark):
    """Ablation: words that only unlabelled documents hold raise a score, and without the rows of the label model hardly do."""
    r = random.Random(2)
    plain = lambda: ["".join(r.choice("aeioubdgklmnr") for _ in range(r.randint(3, 8))) for _ in range(40)]
    rows, labels = [], []
    for k in range(600):
        words = plain()
        if k % 3 == 0:
            words[3], words[9], words[20] = r.sample(["idiot", "stupid", "scum", "worthless", "vile", "clown", "hateful", "freak"], 3)
            if k >= 120:  # not labelled
                words[5], words[30] = "zorgata", "zorgamo"
        rows.append((k, " ".join(words)))
        if k < 120:
            labels.append((k, int(k % 3 == 0)))
    probes = [(1000, " ".join([*plain(), "zorgata", "zorgamo"])), (1001, " ".join(plain()))]
    docs, known = documents(spark, rows + probes), spark.createDataFrame(labels, "doc_id long, toxic int")
    score = lambda: {x["doc_id"]: x["score"] for x in score_toxicity(docs, known).collect()}
    with_rows = score()
    assert with_rows[1000] > 2 * with_rows[1001]
    sampled = toxicity.sampled
    toxicity.sampled = lambda slim, votes: sampled(slim, votes).limit(0)
    try:
        without = score()
    finally:
        toxicity.sampled = sampled
    assert without[1000] < 1.5 * without[1001]


def test_copies_count_once_in_the_sample(spark):
    docs = documents(spark, [(k, "the same text") for k in range(300)] + [(k, f"text {k}") for k in range(300, 340)])
    slim = docs.select(F.col("doc_id").alias("id"), "text")
    votes = slim.select(F.xxhash64("text", F.lit(5)).alias("pick"))
    assert toxicity.sampled(slim, votes).count() == 41


CLASHES = "doc_id long, text string, source string, lang string, predicted int, score string, held_out string, Row int, KEY string, __text string, __rows int, __head string, __copy int, rows string, copies string, id string, digest string, weight double, component_id string"


def test_clashing_columns_pass_through(spark, tmp_path):
    rows, labels = corpus(60)
    sf = write_labels(spark, tmp_path, labels)
    more = lambda i: ("s" if i % 2 else None, "en", 7, "a", None, i, "k", "t", 3, None, i, "r", "c", "i", "d", 0.5, "x")
    data = {i: (i, t, *more(i)) for i, t in rows}
    docs = spark.createDataFrame([*data.values(), data[7]], CLASHES)
    for name in ("toxicity", "n-gram", "mixing"):
        out = stage(name)(spark, docs, sf)
        got = [tuple(r) for r in out.collect()]
        assert out.columns == docs.columns and got and all(r == data[r[0]] for r in got), name
    assert stage("byte")(spark, docs, sf).count() == len(rows) + 1


def test_run_is_the_plain_stages(spark, tmp_path):
    rows, labels = corpus(90)
    rows += [(300, rows[2][1]), (301, rows[2][1] + " tail"), (302, None), (303, "short text"), (304, "short text")]
    table = spark.createDataFrame([(i, t, ["a", "b", None][i % 3]) for i, t in rows], "doc_id long, text string, source string")
    table.write.parquet(str(tmp_path / "documents.parquet"))
    sf = write_labels(spark, tmp_path, labels)
    got = sorted(repr(tuple(r)) for r in corpus_pipeline.run(spark, sf).collect())
    bad = {r["doc_id"] for r in score_toxicity(table, spark.read.parquet(f"{sf}/labels.parquet")).collect() if r["predicted"]}
    clean = [(i, t) for i, t in rows if i not in bad]
    heads = {c for _, _, c in brute_components(clean)}
    kept = [(i, t, ["a", "b", None][i % 3]) for i, t in clean if i in heads]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks_of(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    want = []
    for (i, t, _), copies in zip(kept, brute_mix(spark, kept)):
        ids = library.encode_ordinary(t or "")
        want += [repr((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))] * copies
    assert bad and len(kept) < len(clean) and got == sorted(want)


def stage(name):
    return next(f for n, f in corpus_pipeline.STAGES if n.startswith(name))


def write_labels(spark, tmp_path, labels):
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_stages(spark, tmp_path):
    rows, labels = corpus(120)
    copy = rows[1][1]
    docs = documents(spark, rows + [(500, copy), (501, copy), (502, copy + " more"), (None, "some text without an id"), (7, rows[7][1])])
    sf = write_labels(spark, tmp_path, labels)
    clean = stage("toxicity")(spark, docs, sf).cache()
    assert clean.columns == docs.columns
    ids = {r["doc_id"] for r in clean.collect()}
    truth = dict(labels)
    assert sum(truth[k] for k in ids if k in truth) <= 2 and {k for k, t in truth.items() if not t} <= ids
    heads = stage("n-gram")(spark, clean, sf).cache()
    got = [r["doc_id"] for r in heads.collect()]
    assert heads.columns == docs.columns and len(got) == len(set(got)) and not {500, 501, 502} & set(got) and 1 in got and None in got
    mixed = stage("mixing")(spark, heads, sf).cache()
    assert mixed.columns == docs.columns and {r["doc_id"] for r in mixed.collect()} <= set(got)
    assert mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    assert stage("byte")(spark, mixed, sf).count() == mixed.count()


def test_stages_bear_empty_tables(spark, tmp_path):
    sf = write_labels(spark, tmp_path, [(1, 0)])
    for _, f in corpus_pipeline.STAGES:
        assert f(spark, empty(spark), sf).count() == 0


def test_one_row_of_each_component(spark, tmp_path):
    a, b, c, d = (" ".join(f"{w}{k}" for k in range(30)) for w in "abcd")
    rows = [(5, a), (5, b), (3, b), (None, c), (None, c), (None, c + " more"), (6, d), (None, d), (6, d), (8, a + " " + c), (None, None), (None, None), (None, d[::-1])]
    got = stage("n-gram")(spark, documents(spark, rows), str(tmp_path)).select("doc_id", "text").collect()
    want = [(5, a), (3, b), (6, d), (8, a + " " + c), (None, None), (None, None), (None, d[::-1])]
    left = [tuple(r) for r in got]
    assert all(w in left for w in want)
    rest = [x for x in left if x not in want]
    assert len(left) == len(want) + 1 and len(rest) == 1 and rest[0] in ((None, c), (None, c + " more"))


def test_long_texts_of_distinct_words_are_linear():
    """Words that share a mined beginning are counted once each, not once for each other word."""
    voters = toxicity.Voters(["zed", "zed+"])
    votes = []
    for n in (2_000, 200_000):
        text = " ".join(f"zed{k:x}" for k in range(n))
        began = time.perf_counter()
        votes.append(voters.vote(text))
        took = time.perf_counter() - began
    assert votes[0] == votes[1] and took < 10
