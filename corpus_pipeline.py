"""From documents to token ids: quality, near-duplicates, benchmark passages, personal data, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again for the next one. All but
the last return the columns they got; where a stage changes a text, n_chars follows.

Defined results: rows with a null id go through all stages on their own merits and are never taken for copies; of rows
with one id and equal texts one stays, rows with one id and different texts all stay or go; columns beyond those of
documents are carried along.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revtrellis.llm import bpe_stream, decontaminate, minhash, pii, quality
from revtrellis.llm.common import read, ship, written
from revtrellis.llm.queries import tokenizer_path
from revtrellis.session import ensure_settings

ORACLE_SQL = None  # the first stage is a trained model, the last one a tokenizer: SQL can express neither


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, read(spark, sf_dir, "labels", "doc_id", "quality", "toxic"), toxic_col="toxic")


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    copies = written(minhash.near_duplicates(docs).filter(~F.col("kept")).select("doc_id").distinct(), "copies")
    named = docs.filter(F.col("doc_id").isNotNull()).join(copies, "doc_id", "left_anti").select(*docs.columns)
    place = "_place_of_row"
    once = named.withColumn(place, F.row_number().over(Window.partitionBy("doc_id", "text").orderBy("doc_id"))).filter(F.col(place) == 1).drop(place)
    return once.unionByName(docs.filter(F.col("doc_id").isNull()))


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(decontaminate.clean(docs, read(spark, sf_dir, "benchmark", "item_id", "text")))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(pii.redact(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = bpe_stream.round_trip(docs, tokenizer_path("byte_bpe_50k.json"))
    return coded.select("doc_id", "n_tokens", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def _stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    return lambda spark, docs, sf_dir: work(ship(ensure_settings(spark)), docs, sf_dir)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", _stage(keep_good)),
    ("near_dedup", _stage(keep_one_of_each_group)),
    ("decontaminate", _stage(cut_benchmark)),
    ("pii", _stage(redact_personal_data)),
    ("bpe", _stage(tokens)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
