"""Cleaning of JSON Lines files as they arrive.

The cleaning cascade is a chain of row-wise columns, so it runs unchanged on a
file stream. Order keys, de-duplication and packing belong to the batch job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators.clean import clean_verdicts
from corpusloom.operators.language import LanguageModel
from corpusloom.sources.jsonl import objects_only, parse_lines


def clean_stream(spark: SparkSession, folder: str, model: LanguageModel) -> DataFrame:
    """Verdicts of every JSON object in the files that appear in `folder`.

    `ord` is the digest of the line: a stream has no line numbers.
    """
    lines = spark.readStream.format("text").load(folder)
    keyed = lines.select(F.sha2("value", 256).alias("ord"), "value")
    return clean_verdicts(objects_only(parse_lines(keyed)), model)


def write_clean_stream(verdicts: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append the kept texts as JSON; stops after all files present are done."""
    kept = verdicts.filter(F.col("verdict") == "KEPT").select("text")
    return (
        kept.writeStream.format("json").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
