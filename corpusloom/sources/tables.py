"""Parquet inputs and the derived test corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import fixed_values as fx


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# A file of a few row groups is read by as few tasks. Up to this many bytes it is dealt out again; a larger input
# only if the rows lie uneven. A task then gets some TASK_BYTES.
SPREAD_BYTES, TASK_BYTES = 1 << 30, 16 << 20
# The same where each text becomes many times its bytes: a task holds its texts, all that is made of them and no more.
SMALL_TASK_BYTES = 2 << 20


def file_bytes(spark: SparkSession, sf_dir: str, *names: str) -> int:
    """Bytes of the files of some tables, by listing them; no file is opened."""
    paths = [f"{sf_dir}/{name}.parquet" for name in names]
    files = spark.read.format("binaryFile").load(paths).select("length")
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def version(spark: SparkSession, sf_dir: str, *names: str) -> tuple:
    """Number, bytes and latest change of the files of some tables: another one means other rows."""
    paths = [f"{sf_dir}/{name}.parquet" for name in names]
    files = spark.read.format("binaryFile").load(paths)
    changed = F.max(F.col("modificationTime").cast("double"))
    return tuple(files.agg(F.count(F.lit(1)), F.sum("length"), changed).first())


def spread(df: DataFrame, sf_dir: str, *names: str) -> DataFrame:
    """Use every core on an input of a few files or row groups; any other large one is read as it is split.

    The rows are the same either way.
    """
    spark = df.sparkSession
    size, cores = file_bytes(spark, sf_dir, *names), spark.sparkContext.defaultParallelism
    if size > SPREAD_BYTES:
        # Reads the keys only: rows that each task would get.
        by_task = df.select("ord").groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"))
        most, total = by_task.agg(F.max("n"), F.sum("n")).first()
        if total is None or most * cores <= 2 * total:
            return df
    return _dealt(df, size, TASK_BYTES)


def _dealt(df: DataFrame, size: int, task_bytes: int) -> DataFrame:
    # Not by the cores alone: executors may still be starting.
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-size // task_bytes)), "ord")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").alias("ord"), "text", "lang")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ord, text, lang) of the document table; the id is the order key."""
    return spread(_documents(spark, sf_dir), sf_dir, "documents")


# Pages come before the documents: ids -1, -2, ... can never meet a document id.
PAGE_ORD = "-1 - page_id"


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    lang = F.regexp_extract("html", '<html lang="([a-z]+)"', 1)
    return table(spark, sf_dir, "pages").select(
        F.expr(PAGE_ORD).alias("ord"), F.col("html").alias("text"), lang.alias("lang")
    )


def noisy_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents and pages, most documents altered so that detectors fire.

    The tables themselves hold no tags, code or control characters; each eighth
    of the documents gets one kind of noise. Nothing is left out.
    """
    docs, text = _documents(spark, sf_dir), F.col("text")
    n_lines = F.size(F.filter(F.split(text, "\n"), lambda line: F.trim(line) != ""))
    # c code lines among n others: share above 0.40 exactly when 3c > 2n.
    above = (n_lines * 2 / F.lit(3)).cast("int") + 1
    below = F.greatest(above - 1, F.lit(0))
    head = F.lit("def total(items):\n  return sum(items)\n")
    variant = F.pmod("ord", F.lit(8))
    in_tags = F.concat(
        F.lit('<div class="post"><P>'),
        F.replace(text, F.lit(" the "), F.lit(" &lt;the&gt; ")),
        F.lit("</p><!-- note\n --><br/>&amp; &copy; &#169; &#xE9;<SCRIPT>x()</script></div>"),
    )
    odd_chars = F.replace(
        F.replace(text, F.lit(" of "), F.lit("\u200b of\x07\xa0")),
        F.lit(" de "), F.lit("\ufeff\xa0de\x0b "),
    )
    runs = F.replace(
        F.replace(text, F.lit(", "), F.lit(",\t\t ")), F.lit(". "), F.lit(".\n\n\n\n")
    )
    third = F.pmod(F.floor(F.col("ord") / 8), F.lit(3))
    short = (
        F.when(third == 0, F.lit(" \n\t \u2003"))
        .when(third == 1, F.rpad(text, 199, "x"))
        .otherwise(F.rpad(text, 200, "x"))
    )
    noisy = (
        F.when(variant == 1, in_tags)
        .when(variant == 2, F.concat(F.replace(text, F.lit("\n"), F.lit(";\n")), F.lit(";")))
        .when(variant == 3, F.concat(F.repeat(F.lit("x = y;\n"), below), text))
        .when(variant == 4, F.concat(head, text, F.repeat(F.lit("\n{ fn (); }"), above)))
        .when(variant == 5, odd_chars)
        .when(variant == 6, runs)
        .when(variant == 7, short)
        .otherwise(text)
    )
    every = docs.select("ord", noisy.alias("text"), "lang").unionByName(pages(spark, sf_dir))
    return spread(every, sf_dir, "documents", "pages")


def special_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ord, text): every document with the five special tokens put into its text as literals."""
    text = F.col("text")
    for found, literal in zip([", ", ". ", " a", "\n", "e "], [fx.END_OF_TEXT, *fx.SPECIAL_TOKENS], strict=True):
        text = F.replace(text, F.lit(found), F.lit(found[0] + literal + found[1:]))
    docs = _dealt(_documents(spark, sf_dir), file_bytes(spark, sf_dir, "documents"), SMALL_TASK_BYTES)
    return docs.select("ord", F.concat(text, F.lit("".join(fx.SPECIAL_TOKENS) + fx.END_OF_TEXT)).alias("text"))


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ord, value): every document as a JSON line, every tenth one damaged.

    Line endings of a real crawl: bad JSON, blank lines, text of the wrong type,
    missing text; numbers that are none beside deep nesting. All of it is derived from the document table.
    """
    docs = documents(spark, sf_dir)
    line = F.to_json(F.struct(F.col("ord").alias("doc_id"), "text"))
    kind = F.pmod("ord", F.lit(10))
    nested = F.concat(F.repeat(F.lit("["), 2000), F.repeat(F.lit("]"), 2000))
    ident = F.col("ord").cast("string")
    value = (
        F.when(kind == 1, F.concat(line, F.lit(",")))
        .when(kind == 2, F.lit("  "))
        .when(kind == 3, F.concat(F.lit('{"doc_id":'), ident, F.lit("}")))
        .when(kind == 4, F.concat(F.lit('{"doc_id":'), ident, F.lit(',"text":null}')))
        .when(kind == 5, F.concat(F.lit('{"text":'), ident, F.lit("}")))
        .when(kind == 6, F.concat(F.lit("["), ident, F.lit("]")))
        .when(kind == 7, F.concat(F.lit('{"doc_id":'), ident, F.lit(',"text":" \\n"}')))
        .when(kind == 8, F.concat(F.lit('{"score":NaN,"at":['), nested, F.lit("],"), F.substring(line, 2, 1 << 30)))
        .otherwise(line)
    )
    return docs.select("ord", value.alias("value"))
