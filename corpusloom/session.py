"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(cpus: int | str = "*", app: str = "corpusloom") -> SparkSession:
    """Local session for tests and benchmarks; on a cluster use spark-submit."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by the session.

    Where none is named, a local session gets a temporary one; a cluster, whose
    machines would not see each other's files, gets an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="corpusloom-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a shared file or folder; a plain relative path is a local one."""
    return fs.FileSystem.from_uri(uri if ":" in uri or uri.startswith("/") else os.path.abspath(uri))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back.

    Cuts the lineage, survives the loss of executors, and gives the optimizer
    the real size of the table.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Rows a small table may have to be shipped to every executor. Model tables and
# hot-key lists are built with explicit limits well below this.
BROADCAST_ROWS = 500_000


def broadcast_if_small(table: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only when a count proves the table small.

    A larger table is returned as it is: the join then shuffles and adaptive
    execution splits skewed partitions.
    """
    seen = table.limit(max_rows + 1).count()
    return F.broadcast(table) if seen <= max_rows else table
