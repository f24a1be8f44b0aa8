"""Training corpus: toxic documents go, near copies go, sources are mixed to target weights, texts are encoded.

STAGES are functions of (spark, docs, sf_dir); each result is written and read again as the next one's docs. All but the last
return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from flowwarden.llm import bpe, jaccard, mixing, toxicity
from flowwarden.llm.common import ready, saved, table
from flowwarden.llm.queries import TOKENIZER, held_out


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels that are not held out."""
    ready(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels").where(~held_out()))
    return toxicity.keep_clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked texts stays."""
    ready(spark)
    return jaccard.one_per_component(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are taken and repeated until every source comes near its target."""
    ready(spark)
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens and ids of every whole text."""
    ready(spark)
    return bpe.encode_texts(docs, public_tokenizers.path(TOKENIZER), keep=("doc_id", "source"))


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard", drop_near_copies), ("source_mixing", mix_sources), ("bpe", encode)]

#: A trained classifier decides in the first stage, so SQL can't give these rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
