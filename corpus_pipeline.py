"""The corpus pipeline: five stages over documents, each written as Parquet and read again by the next.

language: documents whose language can't be told go, the others are labelled with theirs. exact: of equal texts (A-Z folded) the one with the
largest doc_id stays. near: of texts whose five-word shingles are at least 0.8 similar one stays. secrets:
every secret is replaced by its kind in brackets; no document goes. pack: pieces of at most 4096 tokens
are given their sequence and place, those of a language together. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirline.llm._common import release, shared_dir
from weirline.llm.exact_dedup import drop_copies
from weirline.llm.language_id import keep_identified
from weirline.llm.near_dedup import drop_near_copies
from weirline.llm.packing import pack_documents
from weirline.llm.secret_scan import redact_secrets


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter stay; their label becomes the language they are identified as, if it is null or that is sure. Null and empty texts,
    and texts of marks and digits alone, go. Repeated rows are told apart by nothing and share one fate; other columns pass."""
    return keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z folded, null as empty) the row with the largest doc_id stays, a null id only where no other has the
    text; of rows equal in both one, whatever their other columns."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that five-word shingles connect at 0.8 or more the row with the smallest doc_id stays (a null id last);
    texts without words are one group."""
    return drop_near_copies(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row stays; secrets become their kind in brackets and n_chars, where there is such a column, the new length. A null
    text stays null and keeps its n_chars."""
    out = redact_secrets(docs)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every row's text, which is one token at least, with language, sequence and place; repeated ids have their
    pieces each. A sequence holds one language, but for a language's last one where it is half full at most and fits another."""
    return pack_documents(docs, group_col="lang")


STAGES = [("language", language), ("exact", exact), ("near", near), ("secrets", secrets), ("pack", pack)]

#: Language models, fingerprints and tokenizers are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/weirline-stage-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        docs.weirline_path = path
        if before is not None:
            release(before)
        before = docs
    return docs
