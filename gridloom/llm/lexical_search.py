"""Ranked lexical search: integer scores summed over term-bucketed postings.

1. Postings. Documents are dealt into blocks as they are read. A row of the postings table is a
   bucket: one term in one block, with the documents that hold it, their ids, lengths and
   occurrences side by side. A term that a third of all documents hold has a bucket in every
   block, none larger than a block. A block's row without a term lists all its documents.
2. Items. Their terms are counted the same way and joined with the buckets' document counts,
   which gives each term's weight.
3. Scores. A term's items are joined to its buckets, each bucket once with all that ask for it;
   the buckets of a block are brought into one task, where each match is scored in whole numbers
   and the sums by item and document need no further shuffle. A window by item takes the k best; Spark keeps k rows of each partition before it.

Rows shuffled are buckets, whose number follows the distinct terms of blocks, and k rows for
each item and partition. Nothing but the count and length of all documents reaches the driver;
whether the items' terms are broadcast or shuffled is for Spark to choose by their size.

Defined results: null texts and texts without a term aren't ranked and don't count; each repeated
row is a document; a null doc_id comes behind all others of its score; equal rows of one item are
one, unlike texts of one item_id are one item with the terms of all; a null item_id is an item, and
items without terms have no rows; with empty tables there are none; other columns are ignored.
Long sums stay 64 bits as long as occurrences of a term in a document times 10^9 do.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import release, stored
from gridloom.llm.ngram_join import texts_of

#: Documents and bytes of text of a block, bytes cut into words at a time, items that are held beside one bucket.
BLOCK, BYTES, STRETCH, ITEMS = 2048, 1 << 24, 1 << 20, 1024
#: A-Z to a-z; every other byte of ASCII but digits and letters to a space.
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def term_counts(text: str | None) -> tuple[Counter, int]:
    """Occurrences of each term (as UTF-8), and of all."""
    raw, counts, at, n = (text or "").encode().translate(TERM_BYTES), Counter(), 0, 0
    while at < len(raw):
        end = len(raw) if len(raw) - at <= STRETCH else raw.rfind(b" ", at + 1, at + STRETCH)
        if end < 0:
            end = raw.find(b" ", at + STRETCH)
        end = len(raw) if end < 0 else end
        words = raw[at:end].split()
        counts.update(words)
        n += len(words)
        at = end
    return counts, n


class Inverted:
    """The buckets of one block of documents."""

    def __init__(self) -> None:
        self.ids: list = []
        self.lengths: list[int] = []
        self.lists: dict[bytes, tuple[list[int], list[int]]] = {}
        self.size = 0

    def add(self, own: object, text: str | None) -> None:
        counts, n = term_counts(text)
        at = len(self.ids)
        self.ids.append(own)
        self.lengths.append(n)
        self.size += len(text or "")
        for term, times in counts.items():
            held = self.lists.get(term)
            if held is None:
                held = self.lists[term] = ([], [])
            held[0].append(at)
            held[1].append(times)

    def rows(self, block: int, id_type: pa.DataType) -> pa.RecordBatch:
        every = np.flatnonzero(self.lengths)
        at = [every, *[x[0] for x in self.lists.values()]]
        times = [np.zeros(len(every), int), *[x[1] for x in self.lists.values()]]
        offsets = pa.array(np.r_[0, np.cumsum([len(x) for x in at])], pa.int32())
        places = np.concatenate(at)
        columns = {
            "block": pa.array(np.full(len(at), block), pa.int64()),
            "term": pa.array([None, *[t.decode() for t in self.lists]], pa.string()),
            "at": pa.ListArray.from_arrays(offsets, pa.array(places, pa.int32())),
            "tf": pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(times), pa.int32())),
            "n": pa.ListArray.from_arrays(offsets, pa.array(np.array(self.lengths, np.int32)[places])),
            "ids": pa.ListArray.from_arrays(offsets, pa.array(self.ids, id_type).take(pa.array(places))),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def postings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Buckets (block, term, at, tf, n, ids); the row of a null term lists a block's documents that have terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, Inverted()
        for batch in batches:
            for own, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                held.add(own, text)
                if len(held.ids) >= BLOCK or held.size >= BYTES:
                    yield held.rows(number, batch.column(0).type)
                    number, held = number + 1, Inverted()
        if held.ids:
            yield held.rows(number, batch.column(0).type)
        release()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"block long, term string, at array<int>, tf array<int>, n array<int>, ids array<{kind}>")


def ranked(
    index: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """(item_col, rank, id_col, score) of each item's k best documents in the postings table ``index``."""
    whole = index.filter(F.col("term").isNull()).agg(
        F.coalesce(F.sum(F.size("n")), F.lit(0)).alias("docs"), F.coalesce(F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0)).alias("terms")
    ).first()
    n_docs, n_terms = int(whole["docs"]), max(int(whole["terms"]), 1)
    asked = postings(items.select(item_col, text_col).distinct(), item_col, text_col).filter(F.col("term").isNotNull())
    asked = asked.select("term", F.explode(F.arrays_zip("ids", "tf")).alias("x")).groupBy("term", F.col("x.ids").alias("item")).agg(F.sum("x.tf").alias("times"))
    listed = index.filter(F.col("term").isNotNull())
    wanted = stored(asked)
    chunks = max(1, -(-wanted.select("item").distinct().count() // ITEMS))
    df = listed.select("term", F.size("at").alias("some")).join(wanted.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("some").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2.0) / (2.0 * F.col("df") + 1.0)))
    weighed = wanted.join(df, "term").select("term", "item", (F.col("times") * weight).alias("w"))
    weighed = stored(weighed.groupBy("term", F.pmod(F.xxhash64("item"), F.lit(chunks)).alias("chunk")).agg(F.collect_list(F.struct("item", "w")).alias("asks")))
    # The buckets of a block meet in one task, each with the items that ask for it: what is summed there is whole.
    met = listed.join(weighed, "term").repartition("block")
    pairs = met.select("block", F.explode("asks").alias("a"), "at", "tf", "n", "ids").select("block", F.col("a.item").alias("item"), F.col("a.w").alias("w"), F.explode(F.arrays_zip("at", "tf", "n", "ids")).alias("x"))
    m = 75 + F.call_function("div", 25 * F.col("x.n").cast("long") * n_docs, F.lit(n_terms))
    tf = F.col("x.tf").cast("long")
    score = F.col("w") * F.call_function("div", 1_000_000_000 * tf, 1000 * tf + 12 * m)
    sums = pairs.select("block", "item", F.col("x.at").alias("at"), F.col("x.ids").alias("id"), score.alias("s")).groupBy("block", "item", "at", "id").agg(F.sum("s").alias("score"))
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "block", "at")
    best = sums.filter("score > 0").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")
