"""Corpus statistics.

Exact quantiles and histograms work on (length, n): one row per distinct length,
summed up before the shuffle, so their state does not grow with the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import detect as dt
from corpusloom.functions import fixed_values as fx
from corpusloom.functions.text import strip_space
from corpusloom.operators.language import LanguageModel, detect_language
from corpusloom.operators.sample import first_n, sample_n
from corpusloom.session import materialise


def length_counts(lengths: DataFrame) -> DataFrame:
    """(length, n)."""
    return lengths.groupBy("length").agg(F.count(F.lit(1)).alias("n"))


def quantiles(*shares: float) -> list[Column]:
    """Exact, linearly interpolated quantiles over (length, n)."""
    return [F.percentile("length", F.lit(q), F.col("n")) for q in shares]


def length_stats(df: DataFrame, n: int = 20_000) -> DataFrame:
    """One row of text-length statistics over the first n rows.

    Rows with null text (unreadable lines) count as lines but have no length.
    """
    rows = first_n(df.select("ord", "text"), n)
    counts = length_counts(rows.select(F.length("text").alias("length")))
    known = F.col("length").isNotNull()
    docs = F.sum(F.when(known, F.col("n")))
    p10, p50, p90 = quantiles(0.1, 0.5, 0.9)

    def percent(test: Column) -> Column:
        hits = F.sum(F.when(test, F.col("n")).otherwise(0)).cast("double")
        return F.try_divide(hits * 100, docs)

    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("sampled"),
        F.try_divide(F.sum(F.col("length") * F.col("n")).cast("double"), docs).alias("avg_length"),
        p50.alias("median_length"), p10.alias("p10"), p90.alias("p90"),
        F.max("length").cast("bigint").alias("max_length"),
        F.min("length").cast("bigint").alias("min_length"),
        percent(F.col("length") == 0).alias("empty_pct"),
        percent(F.col("length") < fx.SHORT_BELOW).alias("short_pct"),
    )


def length_verdicts(df: DataFrame, n: int = 20_000) -> DataFrame:
    """The same statistics with the three judgements as columns."""
    stats = length_stats(df, n)
    return stats.select(
        "*",
        (
            (F.col("median_length") > fx.LONG_MEDIAN_ABOVE)
            & (F.col("avg_length") > fx.LONG_MEAN_ABOVE)
        ).alias("mostly_long"),
        (F.col("max_length") > fx.VERY_LONG_ABOVE).alias("has_very_long"),
        (F.col("short_pct") < fx.SHORT_PERCENT_BELOW).alias("few_short"),
    )


def input_size_mb(df: DataFrame) -> DataFrame:
    """Size of the files behind a table read from files, in MB."""
    files = df.select("_metadata.file_path", "_metadata.file_size").distinct()
    size = F.coalesce(F.sum("file_size"), F.lit(0)) / (1024 * 1024)
    return files.agg(F.round(size, 3).alias("file_size_mb"))


def top_keys(keys: DataFrame, n: int = 10) -> DataFrame:
    """(key, docs) of the most frequent top-level keys over (keys ARRAY<STRING>)."""
    return (
        keys.select(F.explode("keys").alias("key"))
        .groupBy("key").agg(F.count(F.lit(1)).alias("docs"))
        .orderBy(F.desc("docs"), "key").limit(n)
    )


def histogram(lengths: DataFrame, bins: int = 100) -> DataFrame:
    """(bin, low, high, docs): equal bins from min to max, the last one closed.

    Bins are numbered from 1; empty bins are included. The lengths are worked out once.
    """
    counts = materialise(length_counts(lengths), "length-counts").filter(F.col("length").isNotNull())
    low, high = counts.agg(F.min("length"), F.max("length")).first()
    if low is None:
        low, high = 0, 0
    # All values equal: one unit wide around the value, as NumPy does.
    lo, hi = (float(low), float(high)) if high > low else (low - 0.5, low + 0.5)
    width = (hi - lo) / bins
    bin_no = F.least(
        F.width_bucket(F.col("length").cast("double"), F.lit(lo), F.lit(hi), F.lit(bins)),
        F.lit(bins),
    )
    filled = counts.groupBy(bin_no.alias("bin")).agg(F.sum("n").alias("docs"))
    every = counts.sparkSession.range(1, bins + 1).withColumnRenamed("id", "bin")
    return every.join(filled, "bin", "left").select(
        "bin",
        (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("low"),
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("high"),
        F.coalesce("docs", F.lit(0)).alias("docs"),
    )


def html_examples(df: DataFrame, n: int = 5, shown: int = 1500) -> DataFrame:
    """First n documents that hold HTML."""
    hits = df.filter(dt.has_html(F.col("text")))
    return hits.select("ord", F.substring("text", 1, shown).alias("shown")).orderBy("ord").limit(n)


def code_heavy_share(df: DataFrame, n: int = 5000, seed: int = 7) -> DataFrame:
    """Documents of a random sample with a weak code fraction above 0.40."""
    rows = sample_n(df.select("ord", "text"), n, seed)
    return _share(rows, dt.code_fraction(F.col("text")) > fx.CODE_HEAVY_ABOVE)


def non_ascii_share(df: DataFrame, n: int = 20_000) -> DataFrame:
    """Documents among the first n with a character above U+007F."""
    return _share(first_n(df.select("ord", "text"), n), dt.has_non_ascii(F.col("text")))


def _share(rows: DataFrame, test: Column) -> DataFrame:
    hits = F.count_if(test)
    docs = F.count(F.lit(1))
    return rows.agg(
        docs.alias("docs"), hits.alias("hits"),
        F.try_divide(hits * F.lit(100.0), docs).alias("pct"),
    )


def with_percent(counts: DataFrame) -> DataFrame:
    """Add the share of the sampled documents to (category, docs, sampled)."""
    return counts.select(
        "category", "docs", (F.col("docs") * F.lit(100.0) / F.col("sampled")).alias("pct")
    )


def summarize_exclusive(
    df: DataFrame, model: LanguageModel, n: int = 10_000, seed: int = 7
) -> DataFrame:
    """One category per sampled document: (category, docs, pct)."""
    classified = classify_docs(sample_n(df.select("ord", "text"), n, seed), model)
    counts = classified.groupBy("category").agg(F.count(F.lit(1)).alias("docs"))
    total = F.sum("docs").over(Window.partitionBy())  # at most seven rows
    return with_percent(counts.withColumn("sampled", total))


def classify_docs(df: DataFrame, model: LanguageModel) -> DataFrame:
    """(ord, category) from the raw text; null text is a line that did not parse."""
    stripped = df.select("ord", strip_space(F.col("text")).alias("text"))
    flagged = detect_language(stripped, model).select(
        "ord", "lang", (F.col("text") == "").alias("blank"),
        dt.has_html(F.col("text")).alias("html"),
        dt.code_fraction_strong(F.col("text")).alias("code"),
        F.length("text").alias("n_chars"),
    )
    category = (
        F.when(F.col("n_chars").isNull(), "MALFORMED")
        .when(F.col("blank"), "EMPTY")
        .otherwise(
            dt.exclusive_category(F.col("html"), F.col("code"), F.col("lang"), F.col("n_chars"))
        )
    )
    return flagged.select("ord", category.alias("category"))


def summarize_overlapping(
    df: DataFrame, model: LanguageModel, n: int = 10_000, seed: int = 7
) -> DataFrame:
    """Every category that applies per sampled document: (category, docs, pct)."""
    sampled = sample_n(df.select("ord", "text"), n, seed)
    flagged = detect_language(sampled, model).select(
        "lang", strip_space(F.col("text")).alias("stripped"),
        dt.has_html(F.col("text")).alias("html"),
        dt.code_fraction(F.col("text")).alias("code"),
        F.length("text").alias("n_chars"),
    )
    categories = (
        F.when(F.col("n_chars").isNull(), F.array(F.lit("MALFORMED")))
        .when(F.col("stripped") == "", F.array(F.lit("EMPTY")))
        .otherwise(
            dt.overlapping_categories(
                F.col("html"), F.col("code"), F.col("lang"), F.col("n_chars")
            )
        )
    )
    # An extra entry per document counts the sample in the same pass.
    labels = flagged.select(
        F.explode(F.concat(categories, F.array(F.lit("*")))).alias("category")
    )
    counts = labels.groupBy("category").agg(F.count(F.lit(1)).alias("docs"))
    sampled_n = F.max(F.when(F.col("category") == "*", F.col("docs"))).over(Window.partitionBy())
    return with_percent(
        counts.withColumn("sampled", sampled_n).filter(F.col("category") != "*")
    )
