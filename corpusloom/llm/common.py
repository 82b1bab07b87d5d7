"""Inputs, stage tables and shared files of the training-data operators."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import materialise, work_dir

__all__ = ["id_text", "materialise", "open_shared", "shared_folder", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) only, so that no other column of the input can clash; null text is empty."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that driver and executors share."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def open_shared(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a file in the shared folder, in a task or on the driver."""
    return fs.FileSystem.from_uri(uri)
