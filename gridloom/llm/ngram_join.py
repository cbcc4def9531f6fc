"""N-gram Jaccard self-join with a token-group matrix.

A document is the set of its distinct five-word shingles, hashed to 62 bits. Equal sets are
one class. Two classes are linked when their Jaccard similarity reaches the threshold; the
result is each document's component. The steps:

1. Order. Tokens are ordered by hash, the most frequent ones (``FREQUENT`` at most, counted
   over all documents) behind all others. Of two sets that reach the threshold, each shares
   a token with the other's prefix: the first ``n - ceil(t * n) + 1`` tokens in that order.
   As shared passages come last, they fill the prefix only of sets that are little else.
2. Groups. Every class picks at most ``LEADERS`` leaders, the classes most central in its
   prefix tokens' lists; pairs that pass the overlap bound are verified on the whole sets,
   and what is linked so makes a group. A cluster of thousands needs one pair a member.
3. Token-group matrix. A group's row holds the union of its members' prefix tokens. Joined
   with the members of other groups on the token, it gives each query-group overlap, and a
   bound: where even a full match of the rest can't reach the threshold, the group stays shut.
4. Open groups. Only in qualifying groups are query and members compared, first by their own
   prefix overlap, then exactly on the whole sets. Links between groups join the components.

No step is approximate: the order only has to be the same everywhere, and every bound is a
proof. Lists are never expanded into pairs of documents; the rows of steps 2 and 3 follow
the prefix tokens times leaders or groups. Frequent tokens, whose lists may hold a third of
all documents, are counted by partial aggregates apart from the others. A large group, which
may hold a third of all classes, is dealt over parts in every join on the group. Broadcast or
sent to tasks are the frequent tokens, the ids of the largest groups and a bitmap, all bounded
by parameters; the bitmap only spares work. Whole sets are made again from the texts where they are compared, of classes
that are in a pair alone.

Defined results: null and texts without words have no shingles, are linked with nothing and
are their own component, as is each row of a null id (component null); texts of fewer than
five words are one shingle; repeated rows each give a row; other columns are ignored; an
empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import dropped, pieces, release, stored

#: Frequent tokens, leaders of a class, bits of the bitmap, bytes of text hashed at a time.
FREQUENT, LEADERS, BITMAP, STRETCH = 50_000, 1, 1 << 23, 1 << 18
#: Tokens counted at a time by a task, the fewest counts that it reports, tokens of whole sets sent at a time.
COUNTED, LOCAL, SENT = 4_000_000, 3, 250_000
#: Groups of at least so many classes are dealt over parts where rows meet them; how many groups at most (the
#: largest; every other holds less than a share of 1 / LARGE of all classes), and over how many parts.
LARGE_MEMBERS, LARGE, PARTS = 256, 20_000, 16
HOT = 1 << 62
WORDS = 5

#: A-Z to a-z, white space to spaces.
LOWER = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))
STEP = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(int(STEP), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose bits all depend on all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE = mix(np.arange(1, 257, dtype=np.uint64) * STEP)
PLACE = mix(np.arange(1001, 1001 + WORDS, dtype=np.uint64)) | np.uint64(1)


class Shingler:
    """Sorted distinct shingle hashes of texts, a stretch of text at a time."""

    def __init__(self) -> None:
        self.up, self.down = powers(2 * STRETCH)

    def sets(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        held: list[bytes] = []
        size = 0
        for text in texts:
            raw = (text or "").encode().translate(LOWER)
            if held and size + len(raw) > STRETCH:
                yield from self.shingles(*self.words(held))
                held, size = [], 0
            if len(raw) > STRETCH:  # a long text is hashed in stretches that end between words
                parts = [self.words([p])[0] for p in stretches(raw)]
                words = np.concatenate(parts)
                yield from self.shingles(words, np.array([0, len(words)]))
            else:
                held.append(raw)
                size += len(raw) + 1
        yield from self.shingles(*self.words(held))

    def words(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words of texts whose white space is spaces, and where each text's words begin and end."""
        buffer = np.frombuffer(b" " + b" ".join(raws) + b" ", np.uint8)
        up, down = (self.up, self.down) if len(buffer) < len(self.up) else powers(len(buffer) + 1)
        edges = np.diff((buffer != 32).astype(np.int8))
        starts, ends = np.flatnonzero(edges == 1) + 1, np.flatnonzero(edges == -1) + 1
        sums = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum(BYTE[buffer] * up[: len(buffer)], out=sums[1:])
        words = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        return words, np.searchsorted(starts, np.cumsum([0] + [len(r) + 1 for r in raws]))

    def shingles(self, words: np.ndarray, cuts: np.ndarray) -> Iterator[np.ndarray]:
        rows = np.zeros(max(len(words) - WORDS + 1, 0), np.uint64)
        for j in range(WORDS):
            rows += words[j : j + len(rows)] * PLACE[j]
        rows = mix(rows) >> np.uint64(2)
        for a, b in zip(cuts, cuts[1:]):
            if b - a >= WORDS:
                yield np.unique(rows[a : b - WORDS + 1])
            elif b > a:
                short = (words[a:b] * PLACE[: b - a]).sum(keepdims=True) + np.uint64(b - a)
                yield mix(short) >> np.uint64(2)
            else:
                yield rows[:0]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = (np.cumprod(np.r_[np.uint64(1), np.full(n - 1, b, np.uint64)]) for b in (STEP, BACK))
    return up, down


def stretches(raw: bytes) -> Iterator[bytes]:
    """A text in pieces of about STRETCH bytes, cut at spaces; a longer word stays whole."""
    at = 0
    while at < len(raw):
        end = len(raw) if len(raw) - at <= STRETCH else raw.rfind(b" ", at + 1, at + STRETCH)
        if end < 0:
            end = raw.find(b" ", at + STRETCH)
        end = len(raw) if end < 0 else end
        yield raw[at:end]
        at = end


def texts_of(column: pa.Array) -> Iterator[str | None]:
    """The texts of an Arrow column, some of them as Python strings at a time."""
    for start, end in pieces(column):
        yield from column.slice(start, end - start).to_pylist()


def list_array(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.r_[0, np.cumsum([len(p) for p in parts])].astype(np.int32)
    values = np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def keys_of(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    if not len(tokens):
        return 0, 0
    return tuple(int(mix(tokens + np.uint64(s)).sum().astype(np.int64)) for s in (1, 2))


def repeated(tokens: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The tokens that occur so often, and how often; sorts its input in place."""
    tokens.sort()
    often = np.unique(tokens[: len(tokens) - least + 1][tokens[least - 1 :] == tokens[: len(tokens) - least + 1]])
    return often, np.searchsorted(tokens, often, "right") - np.searchsorted(tokens, often)


def frequent_tokens(texts: DataFrame) -> np.ndarray:
    """At most FREQUENT tokens in the most documents. Each task counts all its documents'
    tokens, a stretch at a time in one buffer, and reports those it met LOCAL times; these counts are summed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, held, size = Shingler(), np.empty(COUNTED, np.uint64), 0

        def report() -> pa.RecordBatch:
            tokens, counts = repeated(held[:size], LOCAL)
            return pa.RecordBatch.from_arrays([pa.array(tokens.astype(np.int64)), pa.array(counts, pa.int64())], ["token", "n"])

        for batch in batches:
            for tokens in shingler.sets(texts_of(batch.column(0))):
                while len(tokens):
                    some = tokens[: COUNTED - size]
                    held[size : size + len(some)] = some
                    size, tokens = size + len(some), tokens[len(some) :]
                    if size == COUNTED:
                        yield report()
                        size = 0
        yield report()
        release()

    sums = texts.mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    top = sums.filter(F.col("n") >= 32).orderBy(F.col("n").desc(), "token").limit(FREQUENT).select("token")
    return np.sort(np.array([r[0] for r in top.collect()], np.uint64))


def prefixes(rows: DataFrame, frequent: np.ndarray, percent: int) -> DataFrame:
    """(uid, id, text) to (uid, id, n, k1, k2, prefix); a frequent token has the HOT bit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            sizes, keys, parts = [], [], []
            for tokens in shingler.sets(texts_of(batch.column(2))):
                n = len(tokens)
                sizes.append(n)
                keys.append(keys_of(tokens))
                if len(frequent) and n:
                    hot = frequent[np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)] == tokens
                    if hot.any():
                        tokens = np.r_[tokens[~hot], tokens[hot] | np.uint64(HOT)]
                parts.append(tokens[: n - -(-n * percent // 100) + 1].copy() if n else tokens)  # a view would keep the whole set
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), list_array(parts)],
                ["uid", "id", "n", "k1", "k2", "prefix"],
            )
        release()

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"uid long, id {id_type}, n long, k1 long, k2 long, prefix array<long>")


def whole_sets(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, tokens) of the classes in ``wanted`` (cls, n, k1, k2), made from the texts again."""
    bucket = F.pmod(F.col("k1"), F.lit(BITMAP))
    bits = np.zeros(BITMAP // 32, np.uint32)
    packed = wanted.groupBy((bucket / 32).cast("int").alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(k1, {BITMAP}) % 32 as int))")).alias("bits"))
    for r in packed.collect():
        bits[r["at"]] = r["bits"]

    def rows_of(keys: list[tuple[int, int, int]], parts: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*[pa.array([k[i] for k in keys], pa.int64()) for i in range(3)], list_array(parts)], ["n", "k1", "k2", "tokens"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, keys, parts, size = Shingler(), [], [], 0
        for batch in batches:
            for tokens in shingler.sets(texts_of(batch.column(0))):
                k = keys_of(tokens)
                at = k[0] % BITMAP
                if len(tokens) and bits[at // 32] >> np.uint32(at % 32) & 1:
                    keys.append((len(tokens), *k))
                    parts.append(tokens)
                    size += len(tokens)
                    if size >= SENT:
                        yield rows_of(keys, parts)
                        keys, parts, size = [], [], 0
        yield rows_of(keys, parts)
        release()

    made = texts.mapInArrow(run, "n long, k1 long, k2 long, tokens array<long>")
    return stored(made.join(wanted, ["n", "k1", "k2"]).groupBy("cls").agg(F.first("tokens").alias("tokens")))


def quotient(x: Column, by: int) -> Column:
    """Integer division: doubles would lose tokens of the largest sets."""
    return F.call_function("div", x, F.lit(by))


def needed(a: str | Column, b: str | Column, percent: int) -> Column:
    """Shared tokens from which on sets of these sizes reach the threshold."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return quotient(percent * (a + b) + 99 + percent, 100 + percent)


def pair_bound(percent: int) -> Column:
    """Whether classes a and b, sharing c prefix tokens, can reach the threshold: all prefix
    tokens of the one whose prefix ends first were compared, so it shares c and its rest at most,
    and none shares more than it has."""
    rest = lambda x: quotient(F.col(f"n_{x}") * percent + 99, 100) - 1
    most = F.least("n_a", "n_b", F.col("c") + F.when(F.col("end_a") <= F.col("end_b"), rest("a")).otherwise(rest("b")))
    return most >= needed("n_a", "n_b", percent)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold."""
    a, b = (sets.select(F.col("cls").alias(x), F.col("tokens").alias(f"set_{x}")) for x in "ab")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - shared
    return pairs.join(a, "a").join(b, "b").filter(shared * 100 >= union * percent).select("a", "b")


def dealt(rows: DataFrame, group: str, large: DataFrame, by: Column) -> DataFrame:
    """Rows with ``part``: those of a large group are dealt over PARTS parts, all others are part 0."""
    known = F.broadcast(large.select(F.col("g").alias(group), F.lit(PARTS).alias("parts")))  # at most LARGE rows
    return rows.join(known, group, "left").withColumn("part", F.pmod(F.xxhash64(by), F.coalesce("parts", F.lit(1)))).drop("parts")


def copied(rows: DataFrame, group: str, large: DataFrame) -> DataFrame:
    """Rows once for each ``part`` that their group is dealt over."""
    known = F.broadcast(large.select(F.col("g").alias(group), F.lit(PARTS).alias("parts")))
    parts = F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)).cast("long") - 1)
    return rows.join(known, group, "left").withColumn("part", F.explode(parts)).drop("parts")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component, for nodes with an edge.

    Each round a node takes the smallest root around it, and roots follow their own roots.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    roots = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")))
    while True:
        near = both.join(roots.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        best = roots.join(near, "node").select("node", F.least("root", "near").alias("mid"), F.col("root").alias("old"))
        ahead = roots.select(F.col("node").alias("mid"), F.col("root").alias("far"))
        moved = stored(best.join(ahead, "mid", "left").select("node", F.least("mid", "far").alias("root"), "old"))
        dropped(roots)
        roots = moved
        if moved.filter(F.col("root") != F.col("old")).isEmpty():
            dropped(both)
            found = moved.select("node", "root")
            found.stored_at = moved.stored_at
            return found


def jaccard_components(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``n_shingles`` and ``component_id``, the smallest id reachable by links."""
    texts = docs.select(F.col(text_col).alias("text"))
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    frequent = frequent_tokens(texts)
    made = stored(prefixes(rows, frequent, percent))
    whole = made.filter("n > 0").groupBy("n", "k1", "k2").agg(F.min("uid").alias("cls"), F.first("prefix").alias("prefix"), F.min("id").alias("least"))
    classes = stored(whole.select("cls", "n", "k1", "k2", F.element_at("prefix", -1).alias("end"), "least"))
    about = classes.select("cls", "n", "end")

    lists = whole.select("cls", F.explode("prefix").alias("token"))
    cold = lists.filter(F.col("token") < HOT).withColumn("size", F.count("*").over(Window.partitionBy("token"))).filter("size > 1")
    hot = lists.filter(F.col("token") >= HOT)
    sizes = hot.groupBy("token").agg(F.count("*").alias("size")).filter("size > 1")
    hot = hot.join(F.broadcast(sizes), "token")  # at most FREQUENT rows
    shared = stored(cold.select("token", "cls", "size").unionByName(hot.select("token", "cls", "size")))

    # 2. Groups: each class beside the most central classes of its lists.
    central = shared.groupBy("cls").agg(F.sum("size").alias("central"))
    leaders = shared.join(central, "cls").groupBy("token").agg(F.max_by("cls", F.struct("central", -F.col("cls"))).alias("b"))
    left = about.select(F.col("cls").alias("a"), F.col("n").alias("n_a"), F.col("end").alias("end_a"))
    right = about.select(F.col("cls").alias("b"), F.col("n").alias("n_b"), F.col("end").alias("end_b"))
    led = (
        shared.join(leaders, "token").filter("cls != b").groupBy(F.col("cls").alias("a"), "b").agg(F.count("*").alias("c"))
        .join(left, "a").join(right, "b").filter(pair_bound(percent))
        .withColumn("k", F.row_number().over(Window.partitionBy("a").orderBy(F.col("c").desc(), "b"))).filter(F.col("k") <= LEADERS)
        .select("a", "b")
    )
    led = stored(led)
    def wanted(pairs: DataFrame) -> DataFrame:
        both = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
        return classes.drop("end", "least").join(both, "cls")

    sets = whole_sets(texts, wanted(led))
    star = stored(verified(led, sets, percent))
    dropped(led, sets)
    grouped = components(star)
    member = stored(
        about.join(grouped.withColumnRenamed("node", "cls"), "cls", "left").withColumn("g", F.coalesce("root", "cls")).drop("root")
    )
    dropped(grouped)

    # 3. The token-group matrix, and the overlap of classes with other groups.
    spans = stored(member.groupBy("g").agg(F.count("*").alias("members"), F.min("n").alias("n_min"), F.max("n").alias("n_max"), F.min("end").alias("end_min"), F.max("end").alias("end_max")))
    large = stored(spans.filter(F.col("members") >= LARGE_MEMBERS).orderBy(F.col("members").desc(), "g").limit(LARGE).select("g"))
    placed = dealt(member, "g", large, F.col("cls")).join(copied(spans.select("g", "members"), "g", large), ["g", "part"]).select("cls", "g", "members")
    inside = stored(shared.select("token", "cls").join(placed, "cls"))
    matrix = inside.groupBy("token", "g", "members").agg(F.count("*").alias("of"))
    several = matrix.groupBy("token").agg(F.count("*").alias("groups")).filter("groups > 1").select("token")
    matrix = matrix.join(several, "token").select("token", F.col("g").alias("other"), F.col("members").alias("others"))
    asked = inside.join(several, "token").select("token", "cls", "g", "members")
    overlap = (
        asked.join(matrix, "token")
        .filter((F.col("members") < F.col("others")) | ((F.col("members") == F.col("others")) & (F.col("g") < F.col("other"))))
        .groupBy("cls", "other").agg(F.count("*").alias("c"))
    )
    n, low, high = F.col("n"), F.greatest("n_min", quotient(F.col("n") * percent + 99, 100)), F.least("n_max", quotient(F.col("n") * 100, percent))
    rest = lambda x: quotient(x * percent + 99, 100) - 1
    qualifies = (low <= high) & (
        ((F.col("end") <= F.col("end_max")) & (F.col("c") + rest(n) >= needed(n, low, percent)))
        | ((F.col("end_min") < F.col("end")) & (F.col("c") + rest(high) + 1 >= needed(n, high, percent)))
    )
    of_other = spans.withColumnRenamed("g", "other").drop("members")
    opened = (
        dealt(overlap.join(about, "cls"), "other", large, F.col("cls")).join(copied(of_other, "other", large), ["other", "part"])
        .filter(qualifies).select(F.col("cls").alias("a"), "other")
    )

    # 4. Members of open groups, by their own prefix overlap, then exactly. A pair is one row
    # with both prefixes, whatever they share.
    opened = stored(opened)
    dropped(inside)
    held = shared.groupBy("cls").agg(F.collect_list("token").alias("tokens"))  # a prefix at most
    with_tokens = lambda c: held.select(F.col("cls").alias(c), F.col("tokens").alias(f"tokens_{c}"))
    asking = opened.select("a").distinct().join(with_tokens("a"), "a").join(left, "a")
    inmates = dealt(member.select(F.col("cls").alias("b"), F.col("g").alias("other")), "other", large, F.col("b"))
    inmates = inmates.join(copied(opened.select("other").distinct(), "other", large), ["other", "part"]).join(with_tokens("b"), "b").join(right, "b")
    asking = copied(opened.join(asking, "a"), "other", large)
    fits = F.least("n_a", "n_b") >= needed("n_a", "n_b", percent)
    close = (
        asking.join(inmates, ["other", "part"]).filter(fits)
        .withColumn("c", F.size(F.array_intersect("tokens_a", "tokens_b"))).filter(pair_bound(percent)).select("a", "b")
    )
    close = stored(close)
    dropped(opened, shared, member, spans, large)
    sets = whole_sets(texts, wanted(close))
    links = stored(verified(close, sets, percent))
    dropped(close, sets)
    roots = components(star.unionByName(links))

    # The smallest id of a component, by its classes; then the documents of each class.
    rooted = stored(classes.join(roots.withColumnRenamed("node", "cls"), "cls", "left").select("n", "k1", "k2", F.coalesce("root", "cls").alias("root"), "least"))
    dropped(star, links, classes, roots)
    smallest = rooted.groupBy("root").agg(F.min("least").alias("smallest"))
    of_class = stored(rooted.drop("least").join(smallest, "root").drop("root"))
    dropped(rooted)
    return made.select("id", "n", "k1", "k2").join(of_class, ["n", "k1", "k2"], "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNull(), F.col("id")).otherwise(F.coalesce("smallest", "id")).alias("component_id"),
    )
