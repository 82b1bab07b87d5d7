"""Models fitted from the given tables, once per session and state of the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import bpe, language, tokens, toxicity
from corpusloom.session import materialise
from corpusloom.sources import tables

# Merges trained for the registered queries; a whole job trains many more.
BPE_MERGES = 64

_FITTED: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, fit):
    state = tables.version(spark, sf_dir, "documents", "labels")
    key = (spark.sparkContext.applicationId, sf_dir, state, name)
    if key not in _FITTED:
        _FITTED[key] = fit()
    return _FITTED[key]


def labelled_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ord, text, toxic) of the labelled documents."""
    labels = tables.table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("ord"), "toxic"
    )
    return tables.documents(spark, sf_dir).select("ord", "text").join(labels, "ord")


def language_model(spark: SparkSession, sf_dir: str) -> language.LanguageModel:
    docs = tables.documents(spark, sf_dir).select("text", "lang")
    return _once(spark, sf_dir, "language", lambda: language.fit_language(docs))


def toxicity_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    def fit():
        return materialise(toxicity.fit_toxicity(labelled_docs(spark, sf_dir)), "toxicity-model")

    return _once(spark, sf_dir, "toxicity-table", fit)


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.ToxicityModel:
    def fit():
        return toxicity.ToxicityModel.load(
            toxicity.fit_toxicity(labelled_docs(spark, sf_dir))
        )

    return _once(spark, sf_dir, "toxicity", fit)


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.documents(spark, sf_dir).select("text")
    return tokens.fit_vocab(tokens.pretoken_counts(docs))


def merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rank, left, right) trained on the pre-tokens of the documents."""

    def fit():
        docs = tables.documents(spark, sf_dir).select("text")
        return materialise(bpe.train_bpe(tokens.pretoken_counts(docs), BPE_MERGES)[0], "merges")

    return _once(spark, sf_dir, "merges", fit)


def _pairs(spark: SparkSession, sf_dir: str) -> tuple[bpe.Pair, ...]:
    return _once(spark, sf_dir, "pairs", lambda: bpe.load_merges(merges(spark, sf_dir)))


def base_encoder(spark: SparkSession, sf_dir: str) -> tokens.Encoder:
    return tokens.Encoder.base(_pairs(spark, sf_dir))


def encoder(spark: SparkSession, sf_dir: str) -> tokens.Encoder:
    """The extended encoder."""
    return tokens.Encoder.extended(_pairs(spark, sf_dir))
