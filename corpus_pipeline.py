"""From raw documents to encoded ones: the stages of the training-text pipeline.

Each stage takes (spark, docs, sf_dir) and works on what the stage before it kept, written as Parquet
and read again.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, pii, piece_codec, quality_rules, simhash
from tidemark.llm.common import read
from tidemark.llm.queries import MODEL
from tidemark.session import work_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned rules and the base keep."""
    # Under other names, so that a column of the table never meets a statistic of its name.
    names = {c: f"__{n}" for n, c in enumerate(docs.columns)}
    rows = docs.withColumnsRenamed(names)
    labels = read(spark, sf_dir, "labels")
    rows = quality_rules.judge(rows, labels, id_col=names["doc_id"], text=names["text"], label_id="doc_id")
    return rows.filter("kept").select(*[F.col(inner).alias(c) for c, inner in names.items()])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark passage."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    names = docs.columns
    rows = pii.find_personal(docs, base="__base", spans="__spans")
    text = pii.redact(F.col("text"), F.col("__spans"))
    rows = rows.withColumn("text", text).withColumn("n_chars", F.char_length("text").cast("long"))
    return rows.select(*names)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and the text that they decode to."""
    return piece_codec.encode_documents(docs, public_tokenizers.path(MODEL), keep=["doc_id", "lang", "source"])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("PII", personal_data),
    ("SentencePiece encoding and decoding", encode),
]

#: The learned rules, SimHash and merging by rank have no form in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_folder(spark, "pipeline-" + name.split(" ")[0].lower())
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
