"""Toxicity by weak supervision.

1. Voters. Fixed lexicon and pattern voters, and lexicon voters mined from labelled
   training rows: words and word beginnings that mark toxic rows and no others.
2. Label model. Every document's votes, over all documents, are summed to one row per vote
   pattern. The model is generative: a class, and in each class a forest of voters in which a
   voter depends on the class and on the voter that it correlates with most. Expectation
   maximisation over the patterns estimates the class balance, each voter's accuracy and these
   correlations, so voters that say the same count once. This gives each document a posterior.
3. Classifier. A linear classifier over words and word beginnings (a word counts once, a
   beginning by its share of the words; L1-regularised) is trained on the posterior labels of a
   bounded sample of distinct texts (``TRAIN_ROWS``) and of the labelled rows, whose posterior is
   their label. Its features are those that tell most about these posteriors, of both classes
   (at most ``VOCABULARY``), and the lexicons; then it scores every whole text.

What passes the driver is bounded by parameters: the mined features, the sums of the label
model (voters squared), and the classifier's weights. Labels are read of training rows only
(at most ``LABELLED_ROWS``, chosen by hash); language, source, labels and the id's value are
no inputs of a score.

Defined results: null counts as empty; empty texts get the classifier's score of no words;
without labelled toxic rows only the fixed voters vote, and without any posterior label of
one class the score is the class balance; a null id is held out; repeated rows each give a
row; rows of ``labels`` without a label are ignored, and of conflicting ones 1 wins; other
columns are ignored, or carried as one struct, whatever their names; an empty table stays empty.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import cut, map_texts, release

#: Bounds of the labelled rows that voters are mined from and of the classifier's training rows.
LABELLED_ROWS, TRAIN_ROWS = 12_000, 4_000
#: Mined voters and features of the classifier at most; the share of toxic rows among those that a mined voter
#: marks; the share of a voter's evidence that a feature of the classifier needs.
MINED, VOCABULARY, PURE, LOOSE = 178, 4096, 0.8, 0.4
#: Rows that a voter's rate without its parent counts for, where its rate with it is estimated.
PRIOR = 4.0
#: Tasks over vote patterns, over the bounded training rows (as many as shuffle partitions, up to this), and in the
#: classifier's many short rounds.
TASKS, SAMPLE_TASKS, FIT_TASKS = 16, 32, 3
#: Share of a text's words from which on a beginning is dense.
SHARE = 0.01
#: Lengths of word beginnings that are features.
BEGINNINGS = range(3, 7)
SHORTEST = BEGINNINGS[0]

# Lexicon voters.
LEXICONS = (
    frozenset("idiot idiots idiotic moron morons moronic imbecile cretin dunce halfwit dimwit nitwit".split()),
    frozenset("stupid dumb brainless mindless clueless foolish fool fools".split()),
    frozenset("trash garbage filth filthy scum vermin parasite parasites".split()),
    frozenset("loser losers pathetic worthless useless failure nobody".split()),
    frozenset("disgusting revolting repulsive vile sickening gross".split()),
    frozenset("clown clowns joke laughable ridiculous pitiful".split()),
    frozenset("hate hates hateful despise loathe".split()),
    frozenset("kill die drown hang strangle murder".split()),
    frozenset("ugly fat freak creep pervert weirdo".split()),
    frozenset("bitch bastard asshole shit fuck fucking cunt whore slut".split()),
)
# Phrases of a lexicon voter of their own.
PHRASES = ("shut up", "get lost", "go away", "drop dead", "screw you")
YOU_ARE = re.compile(r"(?:you are|you're)(?: such)?(?: an?| the| all)? [a-z]{3,12}[!.]")
SYMBOLS = re.compile(r"[@#$%&*]{4,}")
#: Pattern voters, each over the lower-cased text.
PATTERNS: tuple[Callable[[str], bool], ...] = (
    lambda low: bool(YOU_ARE.search(low)) if "you are" in low or "you're" in low else False,
    lambda low: any(p in low for p in PHRASES),
    lambda low: "!!!" in low,
    lambda low: bool(SYMBOLS.search(low)),
)


class Known(dict):
    """What is made of a word, kept for words met before, emptied when full."""

    def __init__(self, make: Callable[[str], tuple], features: Iterable[str], most: int = 50_000) -> None:
        self.make, self.most = make, most
        #: How words begin that can say something: most words are told apart by this alone, and are not kept.
        self.begins = {f.strip("=+")[:SHORTEST] for f in features}

    def telling(self, words: Iterable[str]) -> list[str]:
        """The words that say something."""
        return [w for w in words if w[:SHORTEST] in self.begins and self[w]]

    def __missing__(self, word: str) -> tuple:
        if len(self) >= self.most:
            self.clear()
        found = self[word] = self.make(word)
        return found


words_of = re.compile(r"[^\W\d_]+").findall


def features_of(word: str) -> list[str]:
    """The word, and its beginnings."""
    return [f"={word}", *[word[:k] for k in BEGINNINGS if k <= len(word)]]


def counted(text: str | None) -> tuple[Counter, int]:
    """Distinct words with their counts, and all words."""
    words = words_of((text or "").lower())
    return Counter(words), len(words)


def by_feature(words: Counter) -> Counter:
    counts: Counter = Counter()
    for word, n in words.items():
        for feature in features_of(word):
            counts[feature] += n
    return counts


def dense(n: int, total: int) -> bool:
    """Whether a beginning makes a noticeable share of a text's words."""
    return n >= 2 and n >= SHARE * total


def votes_of(text: str | None) -> set[str]:
    """What a mined voter can vote on: features that occur, and those (marked +) that are dense."""
    words, total = counted(text)
    counts = by_feature(words)
    return {*counts, *[f"{f}+" for f, n in counts.items() if dense(n, total)]}


def values_of(text: str | None, vocabulary: dict[str, int]) -> dict[int, float]:
    """A text as the classifier sees it: 1 for a word, and for a beginning its share of the words, up to 1."""
    words, total = counted(text)
    counts: Counter = Counter()
    for word, n in words.items():
        for feature in features_of(word):
            if feature in vocabulary:
                counts[feature] += n
    return {vocabulary[f]: 1.0 if f[0] == "=" else min(1.0, n / (2 * SHARE * total)) for f, n in counts.items()}


def held_out(id_col: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


class Voters:
    """Which voters call a text toxic, as bits."""

    def __init__(self, mined: list[str]) -> None:
        self.mined = {feature: 1 << k for k, feature in enumerate(mined)}
        self.n = len(mined) + len(LEXICONS) + len(PATTERNS)
        self.words = Known(self.of_word, [*mined, *[w for lexicon in LEXICONS for w in lexicon]])

    def of_word(self, word: str) -> tuple:
        """The bits that a word sets alone and its features that want a share; empty where it says nothing."""
        bits = sum(1 << len(self.mined) + k for k, lexicon in enumerate(LEXICONS) if word in lexicon)
        features = features_of(word)
        for feature in features:
            bits |= self.mined.get(feature, 0)
        more = tuple(f for f in features if f"{f}+" in self.mined)
        return (bits, more) if bits or more else ()

    def vote(self, text: str | None) -> int:
        if not text:
            return 0
        low = text.lower()
        words = words_of(low)
        times = Counter(words)
        bits, several = 0, Counter()
        for word in self.words.telling(set(times)):
            alone, more = self.words[word]
            bits |= alone
            for feature in more:
                several[feature] += times[word]
        for feature, n in several.items():
            if dense(n, len(words)):
                bits |= self.mined[f"{feature}+"]
        for k, pattern in enumerate(PATTERNS):
            if pattern(low):
                bits |= 1 << len(self.mined) + len(LEXICONS) + k
        return bits

    def votes(self, texts: list[str | None]) -> list[bytes]:
        """Each text's votes as a bitmap."""
        return [self.vote(t).to_bytes(-(-self.n // 8), "little") for t in texts]


@dataclass
class LabelModel:
    """P(toxic), the voter that each voter depends on (or -1), and by class, parent's vote, voter and
    own vote the logarithm of how likely that vote is."""

    balance: float
    parent: np.ndarray
    logs: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """votes: rows of 0 and 1."""
        above = np.c_[votes, np.zeros(len(votes), votes.dtype)][:, self.parent]
        tell = (self.logs[1] - self.logs[0])[above, np.arange(votes.shape[1]), votes]
        logit = math.log(self.balance / (1 - self.balance)) + tell.sum(1)
        return 1 / (1 + np.exp(-np.clip(logit, -50, 50)))


def forest(joint: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The parent of each voter (or -1) in the forest of greatest mutual information, the classes counting alike.

    joint: by class, how often two voters vote together (how often one does on the diagonal)."""
    n = joint.shape[1]
    shared = np.zeros((n, n))
    for m, total in zip(joint, np.maximum(counts, 1.0)):
        p = np.clip(np.diag(m) / total, 1e-9, 1 - 1e-9)
        both = np.clip(m / total, 0, 1)
        for q, a, b in ((both, p[:, None], p[None]), (p[:, None] - both, p[:, None], 1 - p[None]), (p[None] - both, 1 - p[:, None], p[None]), (1 - p[:, None] - p[None] + both, 1 - p[:, None], 1 - p[None])):
            q = np.clip(q, 0, 1)
            shared += np.where(q > 1e-12, q * np.log(np.maximum(q, 1e-12) / (a * b)), 0.0)
    np.fill_diagonal(shared, 0)
    parent, gain, done = np.full(n, -1), np.zeros(n), np.zeros(n, bool)
    for _ in range(n):  # the next voter is the one that shares most with a voter already there
        k = int(np.argmax(np.where(done, -1.0, gain)))
        done[k] = True
        better = ~done & (shared[k] > gain) & (shared[k] > 1e-3)
        parent[better], gain[better] = k, shared[k][better]
    return parent


def unpacked(bitmaps: list[bytes], n: int) -> np.ndarray:
    """Rows of 0 and 1 from bitmaps of n votes."""
    rows = np.frombuffer(b"".join(bitmaps), np.uint8).reshape(len(bitmaps), -1)
    return np.unpackbits(rows, axis=1, bitorder="little")[:, :n].astype(np.int64)


def feature_sums(rows: DataFrame, features: Callable[[str | None], Iterable[str]]) -> DataFrame:
    """From (text, weight): per feature the weights of the rows that have it, as ``toxic``, and what they leave
    of 1, as ``clean``. Each task counts its own rows, and the counts meet in one aggregate."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = Counter(), Counter()
        for batch in batches:
            for text, weight in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for feature in features(text):
                    seen[0][feature] += 1
                    if weight:
                        seen[1][feature] += weight
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen[0]), pa.string()), pa.array([seen[1][f] for f in seen[0]], pa.float64()), pa.array([float(x) for x in seen[0].values()], pa.float64())],
            ["feature", "toxic", "all"],
        )
        release()

    made = rows.select("text", F.col("weight").cast("double")).mapInArrow(count, "feature string, toxic double, all double")
    # To six places, so that the order of the sums tells nothing.
    toxic, total = F.round(F.sum("toxic"), 6), F.sum("all")
    return made.groupBy("feature").agg(toxic.alias("toxic"), F.round(total - toxic, 6).alias("clean"))


def evidence(rows: DataFrame, sums: DataFrame) -> tuple[Column, Column, float]:
    """For a feature's sums: whether it leans to toxic, the evidence that it isn't by chance that its rows are of one
    class rather than the other (a bound of the logarithm of that chance, below 0), and the evidence that is needed
    for less than one feature of all to pass by chance."""
    total = rows.agg(F.coalesce(F.sum("weight"), F.lit(0.0)).alias("toxic"), F.count("*").alias("n")).first()
    base = (total["toxic"] + 0.5) / (total["n"] + 1)
    n = F.col("toxic") + F.col("clean")
    share = F.greatest(F.least(F.col("toxic") / n, F.lit(1 - 1e-9)), F.lit(1e-9))
    found = n * (share * F.log(share / base) + (1 - share) * F.log((1 - share) / (1 - base)))
    return share > base, F.round(found, 6), math.log(max(sums.count(), 1) + 1)


def mine_voters(labelled: DataFrame) -> list[str]:
    """From (text, weight 0 or 1): features that mark toxic rows and hardly any others, the most telling first."""
    sums = cut(feature_sums(labelled, votes_of))
    toxic, found, least = evidence(labelled, sums)
    telling = (
        sums.withColumn("found", found).filter(toxic & (F.col("found") >= least) & (F.col("toxic") >= PURE * (F.col("toxic") + F.col("clean"))))
        .orderBy(F.col("found").desc(), F.length("feature").desc(), "feature")
        .limit(VOCABULARY)
        .collect()
    )
    chosen: list[tuple[str, float]] = []
    features: list[str] = []
    for r in telling:
        # Of a word and its beginnings that mark about the same rows one is enough.
        bare = r["feature"].strip("=+")
        kin = [n for x, n in chosen if bare.startswith(x) or x.startswith(bare)]
        if not any(r["toxic"] <= 1.15 * n for n in kin):
            chosen.append((bare, r["toxic"]))
            features.append(r["feature"])
        if len(features) == MINED:
            break
    return features


def mine_vocabulary(sample: DataFrame) -> list[str]:
    """From (text, weight): the words of the lexicons, and of each class the features that tell most."""
    sums = cut(feature_sums(sample, lambda text: by_feature(counted(text)[0])))
    toxic, found, least = evidence(sample, sums)
    names = [f"={w}" for lexicon in LEXICONS for w in sorted(lexicon)]
    for side in (toxic, ~toxic):
        top = sums.withColumn("found", found).filter(side & (F.col("found") >= least * LOOSE)).orderBy(F.col("found").desc(), F.length("feature").desc(), "feature")
        names += [r[0] for r in top.select("feature").limit(VOCABULARY // 2).collect()]
    return list(dict.fromkeys(names))


def moments(patterns: DataFrame, n: int, posterior: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """By class (clean, toxic) vote-by-vote sums, with the rows in place 0, over all patterns; each task sums its own."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, n + 1, n + 1))
        for batch in batches:
            rows, labelled, marked = (np.asarray(batch.column(i)) for i in range(1, 4))
            found = unpacked(batch.column(0).to_pylist(), n)
            votes = np.c_[np.ones((len(found), 1)), found]
            p = posterior(found, labelled, marked)
            total[1] += votes.T @ (votes * (rows * p)[:, None])
            total[0] += votes.T @ (votes * (rows * (1 - p))[:, None])
        c, i, j = np.nonzero(np.triu(total))
        yield pa.RecordBatch.from_arrays(
            [pa.array((c * (n + 1) + i) * (n + 1) + j, pa.int32()), pa.array(total[c, i, j], pa.float64())], ["cell", "sum"]
        )

    total = np.zeros(2 * (n + 1) ** 2)
    for r in patterns.coalesce(TASKS).mapInArrow(sums, "cell int, sum double").groupBy("cell").agg(F.sum("sum").alias("sum")).collect():
        total[r["cell"]] = r["sum"]
    return np.round(np.stack([m + np.triu(m, 1).T for m in total.reshape(2, n + 1, n + 1)]), 6)


def fit_label_model(votes: DataFrame, n: int, rounds: int = 4) -> LabelModel:
    """From (bits, known) of all documents; known is 0 or 1 for labelled training rows, else null.

    Starts at the labelled rows where there are any, else where two voters agree, and goes on
    over all rows; labelled rows keep their labels.
    """
    patterns = cut(
        votes.groupBy("bits", "known").agg(F.count("*").alias("rows"))
        .select("bits", F.col("rows").cast("double").alias("rows"), F.col("known").isNotNull().alias("l"), F.coalesce("known", F.lit(0)).cast("double").alias("m"))
    )

    def model_of(sums: np.ndarray) -> LabelModel:
        counts, joint = sums[:, 0, 0], sums[:, 1:, 1:]
        parent = forest(joint, counts)
        alone = np.stack([np.clip((np.diag(m) + 0.05) / (k + 1), 1e-5, 1 - 1e-5) for m, k in zip(joint, counts)])
        with_parent = np.stack([np.where(parent >= 0, m[np.arange(n), parent], 0.0) for m in joint])
        above = np.stack([np.where(parent >= 0, np.diag(m)[parent], 0.0) for m in joint])
        own = np.stack([np.diag(m) for m in joint])
        rate = lambda hits, rows: (np.maximum(hits, 0) + PRIOR * alone) / (np.maximum(rows, 0) + PRIOR)
        # By parent's vote and class; a voter without a parent has its own rate.
        yes = np.stack([np.where(parent >= 0, rate(own - with_parent, counts[:, None] - above), alone), np.where(parent >= 0, rate(with_parent, above), alone)])
        yes = np.clip(yes, 1e-5, 1 - 1e-5)
        yes[:, 0] = np.minimum(yes[:, 0], np.maximum(1e-5, yes[:, 1] * 0.999))  # a voter is never a sign of the other class
        logs = np.log(np.stack([1 - yes, yes], axis=-1)).transpose(1, 0, 2, 3)
        return LabelModel(min(0.5, max(1e-4, (counts[1] + 1) / (counts.sum() + 2))), parent, logs)

    def start(found: np.ndarray, labelled: np.ndarray, marked: np.ndarray) -> np.ndarray:
        agree = found.sum(1)
        return np.where(labelled, marked, np.where(agree >= 2, 0.9, np.where(agree == 1, 0.5, 0.02)))

    model = model_of(moments(patterns, n, start))
    for _ in range(rounds):
        current = model
        model = model_of(moments(patterns, n, lambda found, labelled, marked: np.where(labelled, marked, current.posterior(found))))  # noqa: B023
    return model


def fit_classifier(sample: DataFrame, vocabulary: dict[str, int]) -> tuple[dict[str, float], float]:
    """Weights and intercept from (text, weight); each row counts for both classes by its posterior, the weight."""

    @F.udf(VectorUDT())
    def vector(text: str | None) -> SparseVector:
        return SparseVector(len(vocabulary), values_of(text, vocabulary))

    rows = cut(sample.select(vector("text").alias("features"), F.col("weight").alias("posterior")))
    rows = rows.coalesce(FIT_TASKS)
    both = rows.withColumn("label", F.lit(1.0)).withColumn("weight", F.col("posterior")).unionByName(
        rows.withColumn("label", F.lit(0.0)).withColumn("weight", 1 - F.col("posterior"))
    ).filter(F.col("weight") > 1e-3)
    classes = {r["label"]: r["w"] for r in both.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
    if len(classes) < 2 or min(classes.values()) < 0.5:
        share = (classes.get(1.0, 0.0) + 0.01) / (sum(classes.values()) + 1)
        return {}, math.log(share / (1 - share))
    fitted = LogisticRegression(
        maxIter=60, regParam=1e-4, elasticNetParam=1.0, standardization=False, weightCol="weight"
    ).fit(both)
    weights = fitted.coefficients.toArray().tolist()
    return {f: weights[k] for f, k in vocabulary.items() if weights[k]}, fitted.intercept


def score_texts(docs: DataFrame, held: dict[str, float], intercept: float, keep: list[str], text_col: str) -> DataFrame:
    def worker() -> Callable[[list], dict[str, list]]:
        def of_word(word: str) -> tuple:
            first, *rest = features_of(word)
            alone, more = held.get(first, 0.0), tuple(f for f in rest if f in held)
            return (alone, more) if alone or more else ()

        known = Known(of_word, held)

        def score(text: str | None) -> float:
            words = words_of((text or "").lower())
            times = Counter(words)
            logit, shares = intercept, Counter()
            for word in sorted(known.telling(set(times))):  # sorted: sums in one order
                alone, more = known[word]
                logit += alone
                for feature in more:
                    shares[feature] += times[word]
            for feature, n in shares.items():
                logit += held[feature] * min(1.0, n / (2 * SHARE * len(words)))
            return 1 / (1 + math.exp(-max(-50.0, min(50.0, logit))))

        return lambda texts: {"score": [score(t) for t in texts]}

    return map_texts(docs, keep, text_col, {"score": pa.float64()}, worker)


def boundary(scored: DataFrame) -> float:
    """The logit that parts (weight 0 or 1, score) with the fewest errors; 0 without rows of both labels.

    From a histogram of 400 logits, so what comes back is bounded; of equal cuts the middle.
    """
    logit = F.log(F.col("score") + 1e-9) - F.log(1 - F.col("score") + 1e-9)
    bins = np.zeros((2, 401))
    for r in scored.groupBy(F.col("weight").cast("int").alias("toxic"), F.round((F.greatest(F.least(logit, F.lit(10.0)), F.lit(-10.0)) + 10) * 20).cast("int").alias("bin")).count().collect():
        bins[r["toxic"], r["bin"]] += r["count"]
    if not bins.sum(1).all():
        return 0.0
    errors = np.r_[0, np.cumsum(bins[1])] + np.r_[np.cumsum(bins[0][::-1])[::-1], 0]
    best = np.flatnonzero(errors == errors.min())
    return float(np.median(best)) / 20 - 10


def sampled(slim: DataFrame, votes: DataFrame) -> DataFrame:
    """(text) of TRAIN_ROWS distinct texts, those of the smallest hashes: copies count once, and reruns agree."""
    last = votes.select("pick").distinct().orderBy("pick").limit(TRAIN_ROWS).agg(F.max("pick")).first()[0]
    pick = F.xxhash64("text", F.lit(5))
    return slim.filter(pick <= F.lit(last)).groupBy(pick.alias("pick")).agg(F.first("text").alias("text")).select("text")


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    carry: bool = False,
) -> DataFrame:
    """Per row: the id, ``held_out``, ``score`` and ``predicted``; with ``carry`` all columns of the row as a
    struct ``row`` in place of the id."""
    known = (
        labels.filter(~held_out(F.col(id_col)) & F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).alias("label_id")).agg(F.max(F.col(label_col)).cast("int").alias("known"))
    )
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    tasks = min(SAMPLE_TASKS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    chosen = known.orderBy(F.xxhash64("label_id"), "label_id").limit(LABELLED_ROWS)
    labelled = cut(slim.join(chosen, slim["id"] == chosen["label_id"]).select("text", F.col("known").cast("double").alias("weight")).repartition(tasks))
    mined = mine_voters(labelled)
    n = Voters(mined).n

    def worker() -> Callable[[list], dict[str, list]]:
        voters = Voters(mined)
        return lambda texts: {"bits": voters.votes(texts)}

    votes = cut(
        map_texts(slim.withColumn("pick", F.xxhash64("text", F.lit(5))), ["id", "pick"], "text", {"bits": pa.binary()}, worker)
        .join(known, F.col("id") == F.col("label_id"), "left").select("pick", "bits", "known")
    )
    model = fit_label_model(votes, n)

    def posteriors() -> Callable[[list], dict[str, list]]:
        voters = Voters(mined)
        return lambda texts: {"weight": model.posterior(unpacked(voters.votes(texts), n)).tolist()}

    sample = map_texts(sampled(slim, votes), ["text"], "text", {"weight": pa.float64()}, posteriors)
    sample = cut(sample.unionByName(labelled).repartition(tasks))
    weights, intercept = fit_classifier(sample, {f: k for k, f in enumerate(mine_vocabulary(sample))})
    intercept -= boundary(score_texts(labelled, weights, intercept, ["weight"], "text"))
    rows = docs.select(F.struct(*docs.columns).alias("row")) if carry else slim
    scored = score_texts(rows, weights, intercept, ["row" if carry else "id"], f"row.{text_col}" if carry else "text")
    id_of = F.col("row")[id_col] if carry else F.col("id")
    return scored.select(
        "row" if carry else F.col("id").alias(id_col),
        held_out(id_of).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
