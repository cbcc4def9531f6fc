"""Corpus pipeline: toxic documents go, one document of each near-duplicate group stays,
sources are mixed to their weights, and what is left is encoded.

Each stage takes (spark, docs, sf_dir) and works on all rows it gets; all but the last
return the columns of their input. Defined results: rows without an id are documents as
others are, each its own unless their texts are near copies; rows that repeat one id and one
text are one document from the second stage on, unequal texts of one id are as many; an
empty table stays empty; extra columns are carried along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm.byte_bpe import encode_documents, encoding_digest
from gridloom.llm.common import cut, read
from gridloom.llm.ngram_join import jaccard_components
from gridloom.llm.source_mix import mix_sources
from gridloom.llm.toxicity import score_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    scored = score_toxicity(docs, read(spark, sf_dir, "labels"), carry=True)
    return scored.filter(F.col("predicted") == 0).select("row.*")


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component, that with the smallest id; among equal ids that of the smallest digest."""
    # The same for copies of one id and text only; no part is null, and rows without an id come last.
    key = F.struct(
        F.col("doc_id").isNull().alias("no_id"),
        F.coalesce("doc_id", F.lit(0).cast(docs.schema["doc_id"].dataType)).alias("id"),
        F.xxhash64("text").alias("digest"),
    )
    # Rows without an id and without words are linked with nothing: each is a document of its own.
    own = F.col("doc_id").isNull() & ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rest = docs.filter(~own)
    heads = (
        jaccard_components(rest.select(key.alias("key"), "text"), percent=80, id_col="key")
        .filter(F.col("key") == F.col("component_id")).select("key").distinct()
    )
    # Rows of one key are as good as each other: one stays, found by partial aggregates.
    rows = rest.groupBy(key.alias("key")).agg(F.first(F.struct(*docs.columns)).alias("row"))
    return docs.filter(own).unionByName(rows.join(heads, "key", "left_semi").select("row.*"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; equal rows of one id are taken together."""
    digest = F.xxhash64("text").alias("digest")
    mixed = mix_sources(docs.select("doc_id", "text", "source", digest), [1, 2, 3], most=3.0, keep=["digest"])
    copies = mixed.groupBy("doc_id", "digest").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows")).filter("copies > 0")
    taken = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"), digest.alias("at")).join(
        copies, F.col("id").eqNullSafe(F.col("doc_id")) & F.col("at").eqNullSafe(F.col("digest"))
    )
    # Of n equal rows, the k-th takes every n-th copy.
    order = Window.partitionBy("id", "at").orderBy("id")
    repeated = taken.filter(F.col("rows") > 1).withColumn("k", F.row_number().over(order))
    alone = taken.filter(F.col("rows") == 1).withColumn("k", F.lit(1))
    share = F.floor((F.col("copies") + F.col("rows") - F.col("k")) / F.col("rows")).cast("int")
    return alone.unionByName(repeated).withColumn("copy", F.explode(F.array_repeat(F.lit(0), share))).select("row.*")


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: token count and digests of its ids and of the bytes decoded from them."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encoding_digest(encode_documents(docs, ranks, public_tokenizers.PATTERN))


STAGES = [
    ("toxicity", toxicity),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("mixing sources to target weights", source_mixing),
    ("byte-level BPE encoding and decoding", byte_level_bpe),
]

#: No stage but the third is SQL; the stages are tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
