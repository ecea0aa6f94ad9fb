"""Registered queries of the operators, with the SQL they are checked against where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revtrellis.llm import bpe_stream, decontaminate, filter_audit, licenses, minhash, packing, phrase_dedup, pii, quality, spelling, suffix_dedup, token_files, topk
from revtrellis.llm.common import read, ship
from revtrellis.session import ensure_settings

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        _QUERIES[name] = lambda spark, path: fn(ship(ensure_settings(spark)), path)
        if check:
            _CHECKS[name] = check
        return fn

    return register


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def checking_sql() -> dict[str, str]:
    return dict(_CHECKS)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_bpe_stream")
def _(spark, path):
    return bpe_stream.round_trip(read(spark, path, "documents", "doc_id", "text"), tokenizer_path("byte_bpe_50k.json"), digest=True)


@query("op3_token_files")
def _(spark, path):
    files = token_files.write_token_files(read(spark, path, "documents", "doc_id", "text"), tokenizer_path("word_bpe_49k.json"), end_id=1)
    return token_files.read_documents(files, digest=True)


@query(
    "op5_top_k",
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec FROM embeddings
                  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
       s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.vec, c.vec), lambda p: p[1] * p[2])) AS BIGINT) AS score
             FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
       r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
       SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
)
def _(spark, path):
    vectors = topk.integer_vectors(read(spark, path, "embeddings", "vec_id", "embedding"))
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)




@query("op8_pii")
def _(spark, path):
    return pii.digests(read(spark, path, "documents", "doc_id", "text"))


@query("op6_decontaminate")
def _(spark, path):
    return decontaminate.digests(read(spark, path, "documents", "doc_id", "text"), read(spark, path, "benchmark", "item_id", "text"))


@query("op9_licenses")
def _(spark, path):
    return licenses.digests(read(spark, path, "documents", "doc_id", "text"))


@query("op1_phrase_dedup")
def _(spark, path):
    return phrase_dedup.remove_repeats(read(spark, path, "documents", "doc_id", "text"), digest=True).withColumnRenamed("kept", "kept_sha256")


@query("op4_suffix_dedup")
def _(spark, path):
    return suffix_dedup.remove_repeats(read(spark, path, "documents", "doc_id", "text"), digest=True).withColumnRenamed("kept", "kept_sha256")


@query("op7_near_duplicates")
def _(spark, path):
    return minhash.near_duplicates(read(spark, path, "documents", "doc_id", "text"))


@query("op10_quality")
def _(spark, path):
    return quality.classify(read(spark, path, "documents", "doc_id", "text", "lang", "source", "n_chars"), read(spark, path, "labels", "doc_id", "quality", "toxic"), toxic_col="toxic")


@query("op11_spelling_variants")
def _(spark, path):
    return spelling.variants(read(spark, path, "documents", "doc_id", "text"))


@query("op12_filter_audit", filter_audit.SQL)
def _(spark, path):
    return filter_audit.filter_interactions(read(spark, path, "documents", "doc_id", "text", "lang"), read(spark, path, "labels", "doc_id", "quality", "toxic"))


@query("op13_packing")
def _(spark, path):
    return packing.pack(read(spark, path, "documents", "doc_id", "text"), tokenizer_path("byte_bpe_50k.json"), end_id=0)
