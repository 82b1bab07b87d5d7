"""A training corpus from `documents`, stage by stage; each stage is written and read again.

Every stage works on all rows that its predecessor kept. Columns of `documents` pass through unchanged,
but for `text` and `n_chars` where substring dedup cut a text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import decontaminate, packing, relative_lz, simhash
from corpusloom.llm import toxicity as toxic_words
from corpusloom.llm.common import materialise, table


def _whole_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text, row): id and text as the operators read them, and the row itself in one struct.

    No name inside the struct can clash with a column that a stage or an operator adds.
    """
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )


def _unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of `docs` again, from their struct."""
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score 0.5 or more; the model sees no held-out label.

    A null or empty text has the score of an average of nothing, and stays unless that is 0.5 or more.
    Repeated rows score alike; documents with a null id train nothing, but are scored. An empty table, or
    one without labels, fits a model without subwords. Columns pass through, whatever their names.
    """
    rows = _whole_rows(docs)
    model = toxic_words.train(rows.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    score = toxic_words.score_column(model, docs)(F.coalesce("text", F.lit("")))
    return _unpacked(rows.withColumn("score", score).filter("score < 0.5"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash component: that of the smallest doc_id, null being the largest.

    Among rows of the same id the smallest hash of the text decides; of rows equal in id and text one
    stays, the smallest as JSON. All texts without words, null ones too, are near each other, so one of
    them stays. An empty table stays empty. Columns pass through, whatever their names and types.
    """
    rows = _whole_rows(docs)
    near = simhash.near_components(rows.select("doc_id", "text"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    first = near.groupBy("root").agg(F.min(order).alias("first"))
    chosen = near.join(first, "root").filter(F.col("text_key") == F.col("first.text_key"))
    chosen = chosen.groupBy(F.col("text_key").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    chosen = materialise(chosen, "representatives")
    keyed = rows.select(F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("key"), "row")
    single = keyed.join(chosen.filter("n = 1"), "key", "left_semi")
    # Parts of a group of equal rows are reduced where they are read.
    repeated = keyed.join(chosen.filter("n > 1"), "key", "left_semi").groupBy("key").agg(
        F.min_by("row", F.to_json("row")).alias("row")
    )
    return _unpacked(single.select("row").unionAll(repeated.select("row")), docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated passages; a document of which nothing is left goes.

    A text that loses nothing stays as it is, null and empty ones too; any other becomes its kept words,
    joined by one space, and its n_chars their length. Repeated rows of 35 words or more are copies of each other
    and go. An empty table stays empty. Other columns pass through, whatever their names.
    """
    cut = relative_lz.remove_repeats(_whole_rows(docs), keep=("row",))
    changed = F.col("n_removed") > 0
    kept = cut.filter(~changed | (F.col("n_removed") < F.col("n_words")))
    new = {"text": F.when(changed, F.col("kept")).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        length = F.length("kept").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(changed, length).otherwise(F.col("row.n_chars"))
    return kept.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which benchmark windows cover at least a twentieth of the words.

    Null and empty texts hold no window and stay, as all documents do where there are no items; repeated
    rows go or stay together. An empty table stays empty. Columns pass through, whatever their names.
    """
    rows = _whole_rows(docs)
    found = decontaminate.contamination(rows.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    bad = found.filter(decontaminate.contaminated()).select(F.col("text_key").alias("key")).distinct()
    keyed = rows.select(F.xxhash64("doc_id", "text").alias("key"), "row")
    return _unpacked(keyed.join(bad, "key", "left_anti"), docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places every document in sequences of at most 4096 tokens; see the packing operator for the columns.

    A null or empty text is its end id alone; repeated rows are packed one by one; a null id stays null.
    An empty table gives an empty result. Only doc_id and text are read.
    """
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(_whole_rows(docs).select("doc_id", "text"), path, end_id=1, capacity=4096)


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", near_duplicates),
    ("substring_dedup", substrings),
    ("decontamination", benchmark_passages),
    ("best_fit_packing", packed_sequences),
]

#: Learned scores, XXH64 fingerprints and public tokenizers are not SQL; tests/llm/test_pipeline.py holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
