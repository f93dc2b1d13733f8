"""Corpus preparation in five stages, each a Spark job over all rows that the stage before it kept.

quality -> near-duplicate groups -> benchmark decontamination -> personal data -> tokens. A stage takes (spark, docs,
sf_dir) and returns a DataFrame; ``run`` writes each stage's rows as Parquet below the checkpoint folder and reads them
again as the next one's documents. The first four return the columns of their input; the last one returns token digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skein.llm import bpe, decontaminate, jaccard_join, pii, quality
from skein.llm.textops import documents, fresh_names, store

#: Words of a shingle and similarity in percent of the near-duplicate stage; op5's query has its own.
NEAR_SHINGLE = 5
NEAR_PERCENT = 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier accepts; it is fitted on this stage's own documents."""
    model, _ = quality.fit(*quality.samples(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return quality.keep_good(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of the n-gram Jaccard join (five words, similarity 0.8) the document with the smallest id;
    documents without words and rows without an id stay. Rows of one id but different texts are judged each by its own
    text; rows of a component that share its smallest id all stay, as do repeated rows of a document that stays."""
    linked = jaccard_join.linked_components(docs, NEAR_SHINGLE, NEAR_PERCENT, text_key=True)
    gone_id, gone_key = fresh_names(docs, "gone_id", "gone_key")
    gone = linked.where("component_id <> doc_id").select("doc_id", "text_key").distinct().toDF(gone_id, gone_key)
    same = (F.col("doc_id") == F.col(gone_id)) & (F.xxhash64("text") == F.col(gone_key))
    return docs.join(gone, same, "left_anti").select(docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and disclosing terms replaced in their texts, and n_chars to match."""
    return pii.sanitise(docs, by_document=True).withColumn("n_chars", F.length("text").cast("bigint"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded bytes of each remaining text."""
    import public_tokenizers
    return bpe.encode_digest(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", personal_data_stage),
    ("tokens", token_stage),
]

#: The fitted classifier and the byte-pair merges cannot be written in SQL; tests/llm compares each stage with a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; returns the last stage's rows."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
