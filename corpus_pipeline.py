"""From raw documents to token ids, one stage a decision:

1. ``quality`` drops documents that the rule ensemble rejects.
2. ``near_duplicates`` leaves one document of each group of near copies (five
   words a shingle, similarity 0.8 or more): the one with the smallest id.
3. ``secrets`` replaces secret spans in the texts; no document goes.
4. ``mix`` repeats documents of small sources up to the target weights; every
   document stays at least once.
5. ``encode`` gives each document its byte-level BPE ids.

Each stage takes (spark, docs, sf_dir); ``run`` writes a stage's rows as Parquet
in the shared checkpoint folder and hands what it reads back to the next one.

Defined results: rows with a null or empty text are judged like any other text;
of repeated rows one is left by stage 2, and different texts under one id are judged
apart; a null id stands for its group only if the group has no other id; an empty
table stays empty, with
the same columns; columns beside those of ``documents`` are handed through up to
the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm import bpe_codec, jaccard_join, quality_rules, secret_scan, source_mix
from zonecast.llm.queries import remainder, table
from zonecast.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rules = quality_rules.train(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0)
    rows = docs.select(F.struct(*docs.columns).alias("__row"), "text")
    return quality_rules.score(rows, rules).where("predicted = 1").select("__row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs, k=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = secret_scan.redact(docs)
    return done.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return source_mix.apply(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256), one row for each row of docs."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe_codec.encode(docs, path, public_tokenizers.PATTERN).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mix", mix),
    ("encode", encode),
]

#: A fitted classifier and byte-pair merges have no SQL form; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
