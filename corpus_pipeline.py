"""From documents to training pieces, in five stages; each one's rows are written as Parquet and read again by the next.

1. language_id: rows whose text has no letter, or takes its best language twice the bits of texts left out of the fit, go.
2. near_dedup: of each group of near duplicates the row with the smallest id stays.
3. decontamination: rows of which a twentieth or more lies in passages of ``benchmark`` go.
4. secret_scan: found secrets are overwritten in the text; ``n_chars`` follows.
5. merge_dropout: pieces of each text, with seeded merge dropout; the only stage that returns other columns.

Stages 1 to 4 return the columns of ``documents``, in their order. Stage 3 judges each row by its own text. In stage 2
rows that repeat an id stay or go together; rows without an id rank behind all others, by a hash of their text, and of
several with the same text one stays. An empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm.blocks import written
from rowtide.llm.decontamination import without_contaminated
from rowtide.llm.language_id import fit_bounded, keep_known
from rowtide.llm.merge_dropout import encode
from rowtide.llm.near_dedup import one_of_each
from rowtide.llm.secret_scan import learn_words, mask_secrets

PIECES = "piece_bpe_32k.model"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_known(docs, fit_bounded(docs.select("doc_id", "text", "lang")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = mask_secrets(docs, words=learn_words(docs))
    return masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def merge_dropout(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode(docs, public_tokenizers.path(PIECES))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("merge_dropout", merge_dropout),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
