"""From documents to token ids: drop toxic documents, keep one of each group of near copies, redact personal data, mix sources to equal weights, encode.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and, but for the
last, returns the columns of documents. Null ids, texts and sources pass through every stage;
see the operators for what each does with them.
"""

from __future__ import annotations

from arborlens.llm import bpe, mixing, ngram_join, pii, toxicity
from arborlens.llm.common import bound_batches, cut, table
from arborlens.llm.queries import toxicity_model, vocabulary
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model, fitted on the labelled ones among them, doesn't find toxic."""
    bound_batches(spark)
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where(~F.col("toxic")).select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links join, the one of least id stays, once; documents without id stay."""
    bound_batches(spark)
    first = ngram_join.join(docs).where("doc_id = component_id").select("doc_id").distinct()
    named = docs.where(F.col("doc_id").isNotNull()).join(first, "doc_id", "left_semi").select(docs.columns)
    return named.dropDuplicates(["doc_id", "text"]).select(docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every span of personal data replaced by its kind; n_chars is that of the new text."""
    bound_batches(spark)
    found = pii.find(docs)
    text = pii.redact(F.col("text"), F.col("pii_spans"))
    return found.withColumn("text", text).withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by Poisson counts so that all sources weigh the same, in shuffled order."""
    bound_batches(spark)
    return mixing.mix(docs).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_chars, n_tokens and token_ids of every document."""
    bound_batches(spark)
    return bpe.encode(docs, vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", one_of_each_group),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: SQL can't express the toxicity model, the bootstrapping or the encoder.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each but the last returns is written to the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
