"""The whole job: raw lines to sharded token blocks, with reports.

Every stage that is read more than once is written as Parquet below the output
folder, so a lost executor never repeats an earlier stage and the next stage
reads only the columns it needs. A ledger marks finished stages: a job that was
killed goes on where it was. Reports that only count are made of what the writes
of the stages collected; no stage is encoded or scanned again for them.
"""

from __future__ import annotations

import argparse
import functools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import fixed_values as fx
from corpusloom.operators import bpe, clean, dedup, packing, quality, sharding, stats, tokens
from corpusloom.operators.language import LanguageModel, fit_language
from corpusloom.operators.perplexity import BigramModel
from corpusloom.operators.toxicity import ToxicityModel, fit_toxicity
from corpusloom.plans.ledger import Ledger
from corpusloom.plans.metadata import run_meta
from corpusloom.session import materialise
from corpusloom.sources.jsonl import STATUSES, objects_only, read_jsonl, write_report

SAMPLE_LINES = 25_000
SAMPLE_QUALITY = 1_500


@dataclass
class Models:
    language: LanguageModel
    toxicity: ToxicityModel | DataFrame  # or its table, which may be of any size
    lm: BigramModel | None = None
    encoder: tokens.Encoder | None = None


@dataclass
class Stages:
    """The stage tables of one run; None where a copy was removed."""

    raw: DataFrame | None
    dedup: DataFrame | None
    verdicts: DataFrame | None
    clean: DataFrame | None
    tokenized: DataFrame | None
    placed: DataFrame | None
    packed: DataFrame | None
    encoder: tokens.Encoder
    total_blocks: int

    @property
    def sharded(self) -> DataFrame:
        return sharding.assign_shards(self.packed, self.total_blocks)


Save = Callable[..., DataFrame | None]  # name, build, metrics=None


def status_metrics() -> dict[str, Column]:
    return {"rows": F.count(F.lit(1))} | {s: F.count_if(F.col("status") == s) for s in STATUSES}


def build_stages(
    raw: Callable[[], DataFrame],
    models: Models,
    save: Save,
    block_size: int = fx.BLOCK_SIZE,
    max_seq_len: int = fx.BLOCK_SIZE,
    merges: int = fx.BASE_MERGES,
    after_verdicts: Callable[[DataFrame | None], None] = lambda verdicts: None,
) -> Stages:
    """Compose the stages; `save(name, build, metrics)` writes a stage, once, and reads it back.

    `raw` gives (ord, text, status), or (ord, text) for a table that needs no parsing.
    Without an encoder in `models`, byte-pair merges are trained on the clean corpus.
    """
    if max_seq_len > block_size:
        raise ValueError("max_seq_len must not exceed block_size")

    def unique() -> DataFrame:
        rows = raw()
        return dedup.dedup_parsed(rows) if "status" in rows.columns else dedup.dedup_exact(rows)

    rows = {"rows": F.count(F.lit(1))}
    deduped = save("dedup", unique, rows)
    verdicts = save("verdicts", lambda: clean.clean_verdicts(deduped, models.language), clean.verdict_metrics())
    cleaned = None if verdicts is None else clean.kept_docs(verdicts)
    after_verdicts(verdicts)
    encoder = models.encoder
    if encoder is None:
        counts = save("pretokens", lambda: tokens.pretoken_counts(cleaned))
        learned = save("merges", lambda: bpe.train_bpe(counts, merges)[0])
        encoder = tokens.Encoder.extended(bpe.load_merges(learned))
    tokenized = save("tokenized", lambda: tokens.tokenize_ext(cleaned, encoder, max_seq_len), tokens.token_metrics())
    plan = functools.cache(lambda: packing.plan_blocks(tokenized, block_size))
    last = {"blocks": F.coalesce(F.max("block_id") + 1, F.lit(0))}
    placed = save("placed", lambda: packing.place_docs(plan()), last)
    packed = save("packed", lambda: packing.pack_fixed(tokenized, plan(), encoder.pad), packing.block_metrics(block_size))
    total = 0 if packed is None else packed.count()
    return Stages(None, deduped, verdicts, cleaned, tokenized, placed, packed, encoder, total)


def stage_counts(stages: Stages) -> DataFrame:
    """(stage, rows)."""

    def rows(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.lit(name).alias("stage"), F.count(F.lit(1)).alias("rows"))

    out = rows(stages.raw, "raw")
    for name in ["dedup", "clean", "tokenized", "packed"]:
        out = out.unionByName(rows(getattr(stages, name), name))
    splits = stages.sharded.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))
    return out.unionByName(splits.select(F.col("split").alias("stage"), "rows"))


def run_pipeline(
    spark: SparkSession,
    raw_path: str,
    out: str,
    models: Models,
    block_size: int = fx.BLOCK_SIZE,
    shard_size: int = fx.SHARD_SIZE,
    merges: int = fx.BASE_MERGES,
    keep_stages: bool = True,
) -> tuple[Stages, Ledger]:
    """Read JSON Lines, write all stages, shards, reports and metadata below `out`.

    Run again after a failure with the same input and parameters, it goes on after the last finished
    stage; finished, it does nothing. The models are taken to be the same. Without `keep_stages`
    the raw and unique copies go once the verdicts and their reports are there, all others at the end.
    """
    files = spark.read.format("binaryFile").load(raw_path)
    state = files.agg(F.count(F.lit(1)), F.sum("length"), F.max("modificationTime").cast("string")).first()
    ledger = Ledger(spark, out, {
        "raw": raw_path, "files": list(state), "block_size": block_size, "shard_size": shard_size, "merges": merges,
    })
    lines = ledger.stage("raw", lambda: read_jsonl(spark, raw_path), status_metrics())
    ledger.report("raw_doc_stats", lambda: stats.length_stats(lines, SAMPLE_LINES))
    ledger.report("raw_top_keys", lambda: stats.top_keys(lines))
    ledger.report("raw_file_size", lambda: spark.createDataFrame(
        [(round((state[1] or 0) / (1024 * 1024), 3),)], "file_size_mb double"
    ))
    ledger.report("raw_length_histogram", lambda: stats.histogram(lines.select(F.length("text").alias("length"))))
    ledger.report("raw_category_pct", lambda: stats.summarize_exclusive(lines, models.language, SAMPLE_LINES))

    def after_verdicts(verdicts: DataFrame | None) -> None:
        ledger.report("dedup_counts", lambda: dedup_report(ledger))
        counted = functools.cache(lambda: clean.counts_of_metrics(spark, ledger.metrics("verdicts")))
        ledger.report("cleaning_summary", lambda: clean.summary_of_counts(counted()))
        ledger.report("cleaning_flow", lambda: clean.flow_of_counts(counted()))
        if not keep_stages:
            ledger.drop("raw", "dedup")

    stages = build_stages(
        lambda: objects_only(lines), models, ledger.stage, block_size, block_size, merges, after_verdicts
    )
    stages.raw = lines
    stages.total_blocks = ledger.metrics("packed")["blocks"]
    ledger.report(
        "clean_category_pct", lambda: stats.summarize_exclusive(stages.clean, models.language, SAMPLE_LINES)
    )
    ledger.report("quality_report", lambda: quality.quality_report(
        stages.clean, models.language, models.toxicity, models.lm, SAMPLE_QUALITY
    ))
    ledger.report("token_length_stats", lambda: tokens.stats_of_metrics(spark, ledger.metrics("tokenized")))
    ledger.report("pack_diagnostics", lambda: packing.diagnosis_of_metrics(
        spark, ledger.metrics("tokenized"), ledger.metrics("packed")
    ))

    def shards() -> None:
        sharded = sharding.assign_shards(stages.packed, stages.total_blocks, shard_size=shard_size)
        sharding.write_shards(sharded, f"{out}/sharded")

    ledger.done("sharded", shards)
    ledger.report("shard_manifest", lambda: sharding.manifest_of_files(spark, f"{out}/sharded"))
    train, val, test = fx.SPLIT_RATIOS
    counted = clean.counts_of_metrics(spark, ledger.metrics("verdicts"))
    ledger.done("meta", lambda: write_report(run_meta(
        clean.summary_of_counts(counted), stages.encoder, stages.total_blocks, block_size,
        shard_info={
            "train_ratio": train, "val_ratio": val, "test_ratio": test,
            "shard_output_dir": f"{out}/sharded",
        },
        cli_args={"raw": raw_path},
    ), f"{out}/meta"))
    ledger.report("timing", lambda: timing(ledger))
    if not keep_stages:
        ledger.drop("verdicts", "pretokens", "tokenized", "placed", "packed")
    return stages, ledger


def dedup_report(ledger: Ledger) -> DataFrame:
    """(kept, dropped): rows after and lost in exact de-duplication, from what the writes collected."""
    raw, kept = ledger.metrics("raw"), ledger.metrics("dedup")["rows"]
    return ledger.spark.createDataFrame([(kept, raw["rows"] - raw["BAD_JSON"] - kept)], "kept bigint, dropped bigint")


def timing(ledger: Ledger) -> DataFrame:
    """(step, seconds) of the stages and of the quality report."""
    steps = ["raw", "dedup", "verdicts", "tokenized", "placed", "packed", "sharded", "report-quality_report"]
    return ledger.spark.createDataFrame([(s, ledger.seconds(s)) for s in steps], "step string, seconds double")


def main() -> None:
    """spark-submit entry: python -m corpusloom.plans.pipeline --raw ... --out ..."""
    parser = argparse.ArgumentParser(description="Corpus preparation on Spark")
    parser.add_argument("--raw", required=True, help="JSON Lines file, folder or pattern")
    parser.add_argument("--out", required=True, help="output folder")
    parser.add_argument("--labelled-lang", required=True, help="Parquet with text, lang")
    parser.add_argument("--labelled-toxic", required=True, help="Parquet with text, toxic")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("corpusloom").getOrCreate()
    models = Models(
        language=fit_language(spark.read.parquet(args.labelled_lang)),
        toxicity=materialise(fit_toxicity(spark.read.parquet(args.labelled_toxic)), "toxicity-model"),
    )
    run_pipeline(spark, args.raw, args.out, models)


if __name__ == "__main__":
    main()
