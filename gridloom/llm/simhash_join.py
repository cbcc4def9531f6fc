"""SimHash near-duplicates by vantage-point trees over 64-bit fingerprints.

A document's fingerprint sums its three-word shingles' hashes bit by bit; equal fingerprints are
one class. Two classes are linked when at most ``bits`` bits differ. The steps:

1. Shards. A vantage-point tree over a bounded sample of fingerprints is built on the driver: a
   node has a vantage point and a radius, its children the fingerprints within and beyond. Its
   leaves are the shards, about ``SHARD`` classes each, so their number grows with the input.
   The radius is that near the middle with the fewest sampled fingerprints at its border.
2. Boundaries. Every class lives in the shard it falls into. By the triangle inequality a link
   between the two children of a node needs a fingerprint that is less than ``bits`` above the
   border: so a class within the radius, but nearer to it than ``bits``, visits the other child,
   too. That one of both sides goes is enough, and no link between shards is lost.
3. Inside a shard a tree of its own is walked by all members at once: branches close by the
   same bounds, leaves compare fingerprints exactly. What is linked is joined in the task, and only a
   spanning forest of the shard's links leaves it: fewer rows than members, never all pairs.
4. Components over all shards' forests, and the smallest id of each.

The sample and the tree are bounded by parameters and kept by the driver and the tasks; past
``SAMPLE`` / ``LEAST`` shards these grow instead. A shard is one group, and a region that the sample
shows to be dense gets more of them; fingerprints too alike for any radius to divide stay together.

Defined results: null texts and texts without words have the fingerprint zero and are linked as
any other; texts of fewer than three words are one shingle; each repeated row gives a row; rows
of a null id link as others do and have a null component; other columns are ignored; an empty
table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import dropped, release, stored
from gridloom.llm.ngram_join import LOWER, copied, components, dealt, texts_of

#: Classes of a shard, classes of a leaf inside it, vantage points tried for a node, rows compared at a time.
SHARD, LEAF, TRIED, ROWS = 4096, 64, 12, 1024
#: Sampled fingerprints at most, one of how many at most, and the fewest for a shard.
SAMPLE, ONE_OF, LEAST = 20_000, 8, 8
#: Bytes of text cut into words at a time, bits of a fingerprint, words of a shingle.
STRETCH, BITS, WORDS = 1 << 20, 64, 3
#: Fingerprints of at least so many documents are dealt over parts where documents meet their class; how many at most.
LARGE_CLASS, LARGE = 256, 20_000


def words_of(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, some at a time, A-Z in lower case; a longer word stays whole."""
    raw = (text or "").encode().translate(LOWER)
    at = 0
    while at < len(raw):
        end = len(raw) if len(raw) - at <= STRETCH else raw.rfind(b" ", at + 1, at + STRETCH)
        if end < 0:
            end = raw.find(b" ", at + STRETCH)
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


def fingerprint(text: str | None) -> int:
    counts, n, held = np.zeros(BITS, np.int64), 0, []
    digest = xxhash.xxh64_intdigest

    def add(shingles: list[bytes]) -> None:
        nonlocal counts, n
        hashes = np.array([digest(s, 42) for s in shingles], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        n += len(shingles)

    for words in words_of(text):
        held += words
        if len(held) >= WORDS:
            add([b" ".join(x) for x in zip(held, held[1:], held[2:])])
            held = held[-(WORDS - 1) :]
    if held and not n:
        add([b" ".join(held)])
    return sum(1 << b for b in np.flatnonzero(2 * counts > n).tolist())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) of every row; the 64 bits are those of the long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t) for t in texts_of(batch.column(1))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["id", "fp"])
        release()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


def apart(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int8)


def divided(points: np.ndarray, bits: int) -> tuple[np.uint64, int] | None:
    """A vantage point and a radius: of some points tried, and of the radii that leave a quarter of the points on each
    side, that whose border holds the fewest; None where no radius divides the points."""
    found = None
    for vantage in points[np.linspace(0, len(points) - 1, TRIED).astype(int)]:
        counts = np.bincount(apart(points, vantage), minlength=BITS + 1)
        within = np.cumsum(counts)
        border = within - np.r_[np.zeros(bits, int), within[: len(within) - bits]]
        fair = np.minimum(within, len(points) - within)
        for least in (len(points) // 4, 1):
            radii = np.flatnonzero(fair >= max(least, 1))
            if len(radii):
                r = int(radii[border[radii].argmin()])
                cost = (least == 1, border[r])
                if found is None or cost < found[0]:
                    found = (cost, vantage, r)
                break
    return found and found[1:]


class Tree:
    """Nodes (vantage, radius, within, beyond) in a list; a child below zero is the leaf ~child."""

    def __init__(self, points: np.ndarray, leaf: float, bits: int) -> None:
        self.bits, self.nodes, self.leaves = bits, [], 0
        self.root = self.build(points, leaf)

    def build(self, points: np.ndarray, leaf: float) -> int:
        cut = divided(points, self.bits) if len(points) > leaf else None
        if cut is None:
            self.leaves += 1
            return ~(self.leaves - 1)
        at = len(self.nodes)
        self.nodes.append(None)
        inside = apart(points, cut[0]) <= cut[1]
        self.nodes[at] = (*cut, self.build(points[inside], leaf), self.build(points[~inside], leaf))
        return at

    def places(self, points: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(leaf, points at home there, points that visit it), by positions."""
        todo = [(self.root, np.arange(len(points)), np.zeros(len(points), bool))]
        while todo:
            at, some, visits = todo.pop()
            if not len(some):
                continue
            if at < 0:
                yield ~at, some[~visits], some[visits]
                continue
            vantage, radius, within, beyond = self.nodes[at]
            far = apart(points[some], vantage)
            inside, border = far <= radius, (far <= radius) & (far > radius - self.bits)
            # A point beyond that is in a branch as a visitor still meets those at home within: it goes both ways.
            back = visits & (far > radius) & (far <= radius + self.bits)
            todo.append((within, np.r_[some[inside], some[back]], np.r_[visits[inside], visits[back]]))
            todo.append((beyond, np.r_[some[~inside], some[border]], np.r_[visits[~inside], np.ones(border.sum(), bool)]))


class Forest:
    """Joined sets of positions."""

    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Unites both ends of each pair: the larger root follows the smaller until all pairs agree."""
        while len(a):
            a, b = self.roots(a), self.roots(b)
            differ = a != b
            a, b = np.maximum(a[differ], b[differ]), np.minimum(a[differ], b[differ])
            np.minimum.at(self.up, a, b)

    def roots(self, x: np.ndarray) -> np.ndarray:
        while True:
            up = self.up[x]
            if (up == x).all():
                return x
            self.up[x] = self.up[up]
            x = up


def linked(home: np.ndarray, visitors: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest, as pairs of fingerprints, of the links among a shard's members and of its visitors with them."""
    points = np.r_[home, visitors]
    forest = Forest(len(points))
    # Members alone shape the tree, as visitors may be many times more.
    for _, own, others in Tree(np.sort(home), LEAF, bits).places(points) if len(home) else ():
        everyone = np.r_[own, others]
        for start in range(0, len(own), ROWS):
            some = own[start : start + ROWS]
            for against in range(0, len(everyone), ROWS):
                other = everyone[against : against + ROWS]
                a, b = np.nonzero(np.bitwise_count(points[some][:, None] ^ points[other][None, :]) <= bits)
                a, b = some[a], other[b]
                asks = (a != b) & ((a < len(home)) | (b < len(home)))  # two visitors meet where one of them lives
                forest.join(a[asks], b[asks])
    heads = forest.roots(np.arange(len(points)))
    follows = heads != np.arange(len(points))
    return points[follows], points[heads[follows]]


def simhash_components(docs: DataFrame, bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``fingerprint`` in hexadecimal and ``component_id``, the smallest id reachable by links."""
    made = stored(fingerprints(docs, id_col, text_col))
    classes = stored(made.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("rows")))
    n = classes.count()
    # A sample by hash order, alike on every run; classes are distinct, so no text counts twice.
    share = min(1 / ONE_OF, SAMPLE / max(n, 1))
    sample = classes.filter(F.pmod(F.xxhash64("fp"), F.lit(1 << 20)) < share * (1 << 20)).select("fp")
    points = np.sort(np.array([r[0] for r in sample.collect()], np.int64).view(np.uint64))
    tree = Tree(points, max(LEAST, SHARD * share), bits)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.asarray(batch.column("fp"))
            for leaf, home, visitors in tree.places(own.view(np.uint64)):
                at = np.r_[home, visitors]
                visits = np.r_[np.zeros(len(home), bool), np.ones(len(visitors), bool)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), leaf), pa.int32()), pa.array(own[at]), pa.array(visits)], ["shard", "fp", "visits"])
        release()

    def search(shard: pa.Table) -> pa.Table:
        own, visits = shard.column("fp").to_numpy().view(np.uint64), shard.column("visits").to_numpy()
        a, b = linked(own[~visits], own[visits], bits)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    dealt_rows = classes.select("fp").mapInArrow(deal, "shard int, fp long, visits boolean")
    links = stored(dealt_rows.groupBy("shard").applyInArrow(search, "a long, b long"))
    roots = components(links)
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("smallest"))
    of_class = stored(rooted.join(smallest, "root").select("fp", "smallest", "rows"))
    dropped(links, classes, roots)
    # A third of all documents may have one fingerprint: such are dealt over parts.
    large = of_class.filter(F.col("rows") >= LARGE_CLASS).orderBy(F.col("rows").desc(), "fp").limit(LARGE).select(F.col("fp").alias("g"))
    parted = dealt(made.select("fp", "id"), "fp", large, F.col("id"))
    return parted.join(copied(of_class.select("fp", "smallest"), "fp", large), ["fp", "part"]).select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("id").isNotNull(), F.col("smallest")).alias("component_id"),
    )
