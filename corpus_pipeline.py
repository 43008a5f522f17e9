"""Corpus pipeline over ``documents``: language ID, toxicity, near-duplicates,
repeated passages, packing.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
stage's docs.  All but the last return the columns of documents.  Documents
are rows; null texts and ids, empty tables and extra columns pass as the
operators' docstrings say.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelens.llm.bagminhash import near_duplicates
from tracelens.llm.common import held_out, table
from tracelens.llm.crf_langid import predict_language, train_langid
from tracelens.llm.ss_packing import pack_documents, word_bpe_path
from tracelens.llm.suffix_repeats import remove_repeats
from tracelens.llm.zstd_toxicity import score_toxicity, train_toxicity
from tracelens.session import checkpoint_path

#: A text whose words point to no language more than this is rejected.
LEAST_LANGUAGE = 0.3


def free_name(df: DataFrame, name: str) -> str:
    """``name``, longer if a column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter (null, empty) and those whose best
    language has less than LEAST_LANGUAGE of the words.  Learns from the
    documents that hold a language, a quarter of the ids held out."""
    model = train_langid(docs.where(~held_out("doc_id", 4, 2)), "doc_id", "text", "lang")
    name = free_name(docs, "_language")
    out = predict_language(docs, "text", model, name)
    keep = (F.col(f"{name}.lang") != "und") & (F.col(f"{name}.score") >= LEAST_LANGUAGE)
    return out.where(keep).drop(name)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts whose toxicity score is 0.5 or more."""
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id", 5, 0))
    model = train_toxicity(docs, labels, "doc_id", "text", "toxic")
    name = free_name(docs, "_toxicity")
    return score_toxicity(docs, "text", model, name).where(F.col(name) < 0.5).drop(name)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each class of near-duplicates (rows of a
    null doc_id stay)."""
    gone = near_duplicates(docs, "doc_id", "text").where("NOT kept").select(F.col("id").alias("doc_id"))
    return docs.join(gone, "doc_id", "left_anti")


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes from texts the passages that an earlier document holds; the
    other columns stay, n_chars follows the text."""
    cleaned = remove_repeats(docs, "doc_id", "text", carry=True)
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns if c != "text"}
    columns["text"] = F.col("kept_text")
    if "n_chars" in docs.columns:
        columns["n_chars"] = (F.when(F.col("n_removed") > 0, F.length("kept_text").cast(docs.schema["n_chars"].dataType))
                              .otherwise(columns["n_chars"]))
    return cleaned.select(*(columns[c].alias(c) for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 ids, a row for each piece of a document."""
    return pack_documents(docs, "doc_id", "text", word_bpe_path()).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", keep_languages),
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeats),
    ("best_fit_packing", pack),
]

#: SQL cannot train or apply the models; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to and read from the
    session's shared checkpoint folder."""
    base = checkpoint_path(spark, f"corpus-pipeline-{uuid.uuid4().hex}")
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{i}-{name}")
        docs = spark.read.parquet(f"{base}/{i}-{name}")
    return docs
