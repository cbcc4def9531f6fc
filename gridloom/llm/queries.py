"""The registered queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.byte_bpe import encode_documents, encoding_digest
from gridloom.llm.common import read, stored
from gridloom.llm.exact_topk import exact_top_k
from gridloom.llm.html_main_text import extract_main_text, text_of_blocks
from gridloom.llm.lexical_search import postings, ranked
from gridloom.llm.license_scan import license_digest, scan_licenses
from gridloom.llm.media_columns import media_columns, media_digest, wrap_payloads
from gridloom.llm.ngram_join import jaccard_components
from gridloom.llm.simhash_join import simhash_components
from gridloom.llm.source_mix import mix_sources
from gridloom.llm.token_counts import count_tokens, over_limit
from gridloom.llm.toxicity import score_toxicity
from gridloom.llm.url_rules import judge_urls
from gridloom.llm.yinyang import cluster_digest, yinyang


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_digest(scan_licenses(read(spark, sf_dir, "documents")))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return over_limit(count_tokens(read(spark, sf_dir, "documents"), model), 4096)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encoding_digest(encode_documents(read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN))


#: Host, path and verdict of the rules of the contract's query.
URL_RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(read(spark, sf_dir, "pages"), rules)


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(read(spark, sf_dir, "documents"), [1, 2, 3], most=3.0)
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = wrap_payloads(read(spark, sf_dir, "documents"))
    return media_digest(media_columns(files, ["doc_id", "n_bytes"]))


def op2_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["page_id", "url"]
    return text_of_blocks(extract_main_text(read(spark, sf_dir, "pages"), keys), keys)


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return exact_top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents"), percent=80)


def op11_yinyang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_digest(yinyang(read(spark, sf_dir, "embeddings"), k=40, rounds=5, dims=64, scale=256.0, seed="2:"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read(spark, sf_dir, "documents"), bits=2)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(stored(postings(read(spark, sf_dir, "documents"))), read(spark, sf_dir, "benchmark"), k=20)


def lloyd_sql(k: int, rounds: int) -> str:
    """Rounds of assignment and means as a chain of tables."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT n, c, d FROM (SELECT v.n, c.c, d, row_number() OVER (PARTITION BY v.n ORDER BY d, c.c) AS k
            FROM (SELECT v.n, c.c, (list_dot_product(v.v, v.v) + list_dot_product(c.v, c.v) - 2 * list_dot_product(v.v, c.v))::BIGINT AS d
                FROM v, c{r} c) x JOIN v USING (n) JOIN c{r} c USING (c)) WHERE k = 1)""")
        if r < rounds:
            steps.append(f"""m{r} AS (SELECT c, list(m ORDER BY i) AS v FROM (SELECT c, i, floor(sum(x) / count(*)) AS m
                FROM (SELECT c, unnest(v.v) AS x, unnest(range(64)) AS i FROM a{r} JOIN v USING (n)) GROUP BY c, i) GROUP BY c),
            c{r + 1} AS MATERIALIZED (SELECT c, coalesce(m.v, c.v)::DOUBLE[] AS v FROM c{r} c LEFT JOIN m{r} m USING (c))""")
    return f"""
        WITH v AS MATERIALIZED (SELECT row_number() OVER () AS n, vec_id, [floor(256 * x::DOUBLE) for x in embedding]::DOUBLE[] AS v FROM embeddings
            WHERE len(embedding) = 64 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
        c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
            FROM (SELECT sha256('2:' || vec_id) AS h, v FROM v WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {k})),
        {", ".join(steps)},
        t AS (SELECT c, sum(d) AS inertia FROM a{rounds} GROUP BY c)
        SELECT vec_id, c::INTEGER AS cluster, d AS distance, t.inertia::BIGINT AS cluster_inertia, (SELECT sum(inertia) FROM t)::BIGINT AS inertia,
            sha256(array_to_string([x::BIGINT for x in c.v], ',')) AS centroid_sha256
        FROM a{rounds} JOIN v USING (n) JOIN t USING (c) JOIN c{rounds} c USING (c)
    """


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_html_main_text": op2_html_main_text,
    "op3_token_counts": op3_token_counts,
    "op4_media_columns": op4_media_columns,
    "op5_source_mix": op5_source_mix,
    "op6_ngram_join": op6_ngram_join,
    "op7_url_rules": op7_url_rules,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_exact_topk": op9_exact_topk,
    "op10_toxicity": op10_toxicity,
    "op11_yinyang": op11_yinyang,
    "op12_simhash": op12_simhash,
    "op13_lexical_search": op13_lexical_search,
}

ORACLE_SQL: dict[str, str] = {
    "op7_url_rules": """
        WITH rules(r_host, r_path, verdict) AS (VALUES
            ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'),
            ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
        cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0
                    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        parsed AS (SELECT page_id, lower(regexp_extract(rest, '^[^/?#]*')) AS host,
                    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS n FROM cut),
        fitting AS (SELECT n, r_host || r_path AS rule, verdict,
                    row_number() OVER (PARTITION BY n ORDER BY length(r_host || r_path) DESC,
                        length(r_host) DESC, r_host || r_path) AS k
            FROM parsed, rules WHERE (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path))
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
        FROM parsed LEFT JOIN (SELECT * FROM fitting WHERE k = 1) f USING (n)
    """,
    "op9_exact_topk": """
        WITH v AS (SELECT vec_id, [floor(256 * x::DOUBLE) for x in embedding]::DOUBLE[] AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
        scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
        ranked AS (SELECT query_id, vec_id, score,
            row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op11_yinyang": lloyd_sql(40, 5),
    "op13_lexical_search": r"""
        WITH terms AS (SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
        docs AS (SELECT n, doc_id, len(t)::BIGINT AS size FROM terms WHERE len(t) > 0),
        whole AS (SELECT count(*) AS docs, sum(size)::BIGINT AS terms FROM docs),
        held AS (SELECT n, term, count(*) AS tf FROM (SELECT n, unnest(t) AS term FROM terms) GROUP BY n, term),
        asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY item_id, term),
        weights AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM held, whole GROUP BY term),
        scored AS (SELECT item_id, n, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * size * docs) // whole.terms))))::BIGINT AS score
            FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN docs USING (n), whole GROUP BY item_id, n)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (SELECT item_id, doc_id, score,
            row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored JOIN docs USING (n) WHERE score > 0) WHERE rank <= 20
    """,
}
