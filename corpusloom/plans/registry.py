"""Named queries over the given tables: one or more per operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import detect as dt
from corpusloom.functions import fixed_values as fx
from corpusloom.functions import text as tx
from corpusloom.functions.entities import entity_tokens
from corpusloom.functions.hashing import doc_hash
from corpusloom.operators import (
    bpe, clean, dedup, language, packing, perplexity, quality, sample, sharding, stats,
    tokens, toxicity,
)
from corpusloom.plans import metadata, models, pipeline
from corpusloom.session import materialise, work_dir
from corpusloom.sources import jsonl, tables

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

# Block sizes used by the registered queries.
QUERY_SHARD = 100
QUERY_BUCKET = 100_000
NEAR_WIDE = 8


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits: sums of doubles depend on their order."""
    return df.select(
        *[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def as_text(ids: Column) -> Column:
    return F.array_join(ids.cast("array<string>"), " ")


# --- sources and samplers ----------------------------------------------------


@query
def read_jsonl_status(spark, sf):
    parsed = jsonl.parse_lines(tables.json_lines(spark, sf))
    return parsed.select("ord", "status", "text", F.array_join(F.array_sort("keys"), ",").alias("keys"))


@query
def head_docs(spark, sf):
    return sample.first_n(tables.documents(spark, sf).select("ord", "text"), 5)


@query
def sample_docs(spark, sf):
    return sample.sample_n(tables.documents(spark, sf).select("ord", "text"), 20)


# --- text transforms ---------------------------------------------------------


@query
def normalize_docs(spark, sf):
    docs = tables.noisy_docs(spark, sf)
    return docs.select("ord", tx.normalize_text(F.col("text")).alias("text"))


@query
def strip_html_pages(spark, sf):
    docs = tables.noisy_docs(spark, sf)
    return docs.select("ord", tx.strip_html(F.col("text")).alias("text"))


@query
def entity_counts(spark, sf):
    found = tables.noisy_docs(spark, sf).select(
        F.explode(entity_tokens(F.col("text"))).alias("entity")
    )
    return found.groupBy("entity").agg(F.count(F.lit(1)).alias("n"))


@query
def simhash_tokens(spark, sf):
    words = tx.simhash_tokens(F.col("text"))
    return tables.documents(spark, sf).select(
        "ord", F.size(words).cast("bigint").alias("n_tokens"),
        F.array_join(words, " ").alias("tokens"),
    )


@query
def token_chunks(spark, sf):
    words = tables.documents(spark, sf).select(
        "ord", tx.simhash_tokens(F.col("text")).alias("words")
    )
    chunks = words.select("ord", F.posexplode(tx.token_chunks(F.col("words"))).alias("pos", "chunk"))
    return chunks.withColumn("pos", F.col("pos").cast("bigint"))


# --- detectors ---------------------------------------------------------------


@query
def html_flag_pages(spark, sf):
    docs = tables.noisy_docs(spark, sf)
    return docs.select("ord", dt.has_html(F.col("text")).alias("has_html"))


@query
def code_fraction(spark, sf):
    docs = tables.noisy_docs(spark, sf)
    return rounded(docs.select("ord", dt.code_fraction(F.col("text")).alias("fraction")))


@query
def code_fraction_strong(spark, sf):
    docs = tables.noisy_docs(spark, sf)
    return rounded(docs.select("ord", dt.code_fraction_strong(F.col("text")).alias("fraction")))


@query
def code_heavy_docs(spark, sf):
    return tables.noisy_docs(spark, sf).filter(dt.is_code_document(F.col("text"))).select("ord")


@query
def code_heavy_share(spark, sf):
    return rounded(stats.code_heavy_share(tables.noisy_docs(spark, sf)))


@query
def non_ascii_share(spark, sf):
    return rounded(stats.non_ascii_share(tables.noisy_docs(spark, sf)))


@query
def pii_flags(spark, sf):
    docs = tables.noisy_docs(spark, sf)
    return docs.select("ord", F.array_join(dt.pii_labels(F.col("text")), ",").alias("labels"))


@query
def pii_hits(spark, sf):
    labels = tables.noisy_docs(spark, sf).select(
        F.explode(dt.pii_labels(F.col("text"))).alias("label")
    )
    return labels.groupBy("label").agg(F.count(F.lit(1)).alias("docs"))


@query
def doc_hashes(spark, sf):
    return tables.noisy_docs(spark, sf).select("ord", doc_hash(F.col("text")).alias("digest"))


@query
def length_filter(spark, sf):
    docs = tables.noisy_docs(spark, sf).filter(dt.length_ok(F.col("text")))
    return docs.select("ord", F.length("text").cast("bigint").alias("n_chars"))


@query
def classify_docs(spark, sf):
    return stats.classify_docs(tables.noisy_docs(spark, sf), models.language_model(spark, sf))


# --- language ----------------------------------------------------------------


@query
def lang_profile(spark, sf):
    return language.fit_profile(tables.documents(spark, sf).select("text", "lang"))


@query
def lang_detect(spark, sf):
    model = models.language_model(spark, sf)
    docs = tables.noisy_docs(spark, sf).select("ord", "text")
    scored = docs.withColumn("scores", model.scores(F.col("text")))
    return scored.select(
        "ord", model.best(F.col("scores")).alias("lang"),
        F.array_max(F.slice("scores", 1, len(model.langs))).alias("score"),
        F.element_at("scores", len(model.langs) + 1).alias("known"),
    )


@query
def language_distribution(spark, sf):
    model = models.language_model(spark, sf)
    turns = tables.table(spark, sf, "conversations")
    docs = turns.select((F.col("conv_id") * 1000 + F.col("turn")).alias("ord"), "text")
    return rounded(language.language_distribution(docs, model))


# --- toxicity and perplexity -------------------------------------------------


@query
def toxicity_model(spark, sf):
    return toxicity.fit_toxicity(models.labelled_docs(spark, sf))


@query
def toxicity_scores(spark, sf):
    docs = tables.documents(spark, sf).select("ord", "text")
    scored = toxicity.toxicity_by_join(docs, models.toxicity_table(spark, sf))
    return rounded(scored.select("ord", "log_odds", "toxicity"))


@query
def lm_counts(spark, sf):
    return perplexity.fit_lm(tables.documents(spark, sf).select("text"))


@query
def doc_perplexity(spark, sf):
    docs = tables.documents(spark, sf).select("ord", "text")
    scored = perplexity.corpus_perplexity(docs)
    return rounded(scored.select("ord", "perplexity"))


# --- de-duplication ----------------------------------------------------------


@query
def dedup_exact(spark, sf):
    return dedup.dedup_exact(tables.documents(spark, sf))


@query
def dedup_lines(spark, sf):
    """Parsed lines: rows without readable text pass through."""
    parsed = materialise(jsonl.parse_lines(tables.json_lines(spark, sf)), "parsed")
    return dedup.dedup_parsed(parsed).select("ord", "status")


@query
def dedup_counts(spark, sf):
    return dedup.dedup_counts(tables.documents(spark, sf))


@query
def simhash_signature(spark, sf):
    return dedup.simhash(tables.documents(spark, sf))


def _distinct_signatures(spark, sf):
    signatures = dedup.simhash(tables.documents(spark, sf))
    return materialise(dedup.distinct_signatures(signatures), "signatures")


@query
def near_dup_copies(spark, sf):
    """Documents with an equal signature, each with the first of its group."""
    signatures = dedup.simhash(tables.documents(spark, sf))
    first = dedup.distinct_signatures(signatures).filter(F.col("docs") > 1)
    copies = signatures.join(first.select("sig", F.col("ord").alias("first_ord")), "sig")
    return copies.filter(F.col("ord") != F.col("first_ord")).select("ord", "first_ord")


@query
def near_dup_pairs(spark, sf):
    return dedup.near_pairs(_distinct_signatures(spark, sf))


@query
def near_dup_pairs_t8(spark, sf):
    return dedup.near_pairs(_distinct_signatures(spark, sf), NEAR_WIDE)


@query
def dedup_near(spark, sf):
    return dedup.dedup_near(tables.documents(spark, sf)).select("ord")


@query
def dedup_near_t8(spark, sf):
    return dedup.dedup_near(tables.documents(spark, sf), NEAR_WIDE).select("ord")


# --- statistics --------------------------------------------------------------


@query
def length_stats(spark, sf):
    return rounded(stats.length_stats(tables.noisy_docs(spark, sf)))


@query
def length_verdicts(spark, sf):
    return rounded(stats.length_verdicts(tables.documents(spark, sf)))


@query
def top_keys(spark, sf):
    props = tables.table(spark, sf, "events").select("props")
    return stats.top_keys(props.select(F.array_distinct(F.json_object_keys("props")).alias("keys")))


@query
def top_keys_lines(spark, sf):
    return stats.top_keys(jsonl.parse_lines(tables.json_lines(spark, sf)).select("keys"))


@query
def length_histogram(spark, sf):
    lengths = tables.documents(spark, sf).select(F.length("text").alias("length"))
    return rounded(stats.histogram(lengths, 100))


@query
def longest_docs(spark, sf):
    return sample.longest_docs(tables.documents(spark, sf))


@query
def html_examples(spark, sf):
    return stats.html_examples(tables.noisy_docs(spark, sf))


@query
def category_overlap(spark, sf):
    model = models.language_model(spark, sf)
    return rounded(stats.summarize_overlapping(tables.noisy_docs(spark, sf), model))


@query
def category_exclusive(spark, sf):
    model = models.language_model(spark, sf)
    return rounded(stats.summarize_exclusive(tables.noisy_docs(spark, sf), model))


# --- cleaning ----------------------------------------------------------------


def _verdicts(spark, sf):
    return clean.clean_verdicts(tables.noisy_docs(spark, sf), models.language_model(spark, sf))


@query
def clean_verdicts(spark, sf):
    return _verdicts(spark, sf).select("ord", "verdict", "html_stripped")


@query
def clean_verdicts_given_lang(spark, sf):
    """The cascade with the language taken from a column."""
    verdicts = clean.clean_verdicts(tables.noisy_docs(spark, sf), lang_col="lang")
    return verdicts.select("ord", "verdict", "html_stripped")


@query
def clean_docs(spark, sf):
    return clean.kept_docs(materialise(_verdicts(spark, sf), "verdicts"))


@query
def cleaning_summary(spark, sf):
    return rounded(clean.cleaning_summary(_verdicts(spark, sf)))


@query
def cleaning_flow(spark, sf):
    return clean.cleaning_flow(_verdicts(spark, sf))


@query
def quality_report(spark, sf):
    report = quality.quality_report(
        tables.documents(spark, sf), models.language_model(spark, sf),
        models.toxicity_table(spark, sf),
    )
    return rounded(report)


@query
def quality_report_all(spark, sf):
    """The same over every document."""
    report = quality.quality_report(
        tables.documents(spark, sf), models.language_model(spark, sf),
        models.toxicity_table(spark, sf), n=None,
    )
    return rounded(report)


# --- tokens ------------------------------------------------------------------


@query
def pretoken_counts(spark, sf):
    return tokens.pretoken_counts(tables.documents(spark, sf))


@query
def vocab(spark, sf):
    return models.vocabulary(spark, sf).withColumn("id", F.col("id").cast("bigint"))


@query
def special_tokens(spark, sf):
    """Those of both encoders."""
    base = tokens.special_tokens(spark, models.base_encoder(spark, sf))
    return base.unionByName(tokens.special_tokens(spark, models.encoder(spark, sf)))


@query
def bpe_merges(spark, sf):
    return models.merges(spark, sf)


@query
def bpe_vocab(spark, sf):
    return bpe.bpe_vocab(models.merges(spark, sf))


@query
def bpe_encode(spark, sf):
    """Every distinct pre-token of the corpus with its ids."""
    counts = tokens.pretoken_counts(tables.documents(spark, sf))
    encoded = tokens.encode_pretokens(counts, models.base_encoder(spark, sf))
    return encoded.select("token", "n", as_text(F.col("ids")).alias("ids"))


@query
def encode_docs(spark, sf):
    encoded = tokens.encode_docs(tables.documents(spark, sf), models.encoder(spark, sf))
    return encoded.select("ord", as_text(F.col("input_ids")).alias("ids"))


@query
def encode_docs_by_join(spark, sf):
    """The same ids; each distinct pre-token is merged once and joined back."""
    encoded = tokens.encode_docs_by_join(tables.documents(spark, sf), models.encoder(spark, sf))
    return encoded.select("ord", as_text(F.col("input_ids")).alias("ids"))


@query
def special_literals(spark, sf):
    """Texts that hold all five special tokens as literals, by both encoders, and what they decode to."""
    docs = tables.special_docs(spark, sf)
    base, extended = models.base_encoder(spark, sf), models.encoder(spark, sf)
    ids = docs.select(
        "ord", "text", base.encode(F.col("text")).alias("base_ids"), extended.encode(F.col("text")).alias("ids")
    )
    return ids.select(
        "ord", as_text(F.col("base_ids")).alias("base_ids"), as_text(F.col("ids")).alias("ids"),
        ((base.decode(F.col("base_ids")) == F.col("text")) & (extended.decode(F.col("ids")) == F.col("text")))
        .alias("same_text"),
    )


def _tokenized(spark, sf):
    return tokens.tokenize_ext(tables.documents(spark, sf), models.encoder(spark, sf))


def _token_text(df):
    return df.select(
        "ord", as_text(F.col("input_ids")).alias("ids"), F.col("length").cast("bigint").alias("length")
    )


@query
def tokenize_plain(spark, sf):
    return _token_text(tokens.tokenize(tables.documents(spark, sf), models.encoder(spark, sf)))


@query
def tokenize_ext(spark, sf):
    return _token_text(_tokenized(spark, sf))


@query
def decode_roundtrip(spark, sf):
    """Every document comes back from its ids, byte for byte."""
    enc = models.encoder(spark, sf)
    docs = tables.documents(spark, sf).select("ord", tx.strip_space(F.col("text")).alias("text"))
    back = docs.withColumn("ids", enc.encode(F.col("text"))).withColumn("back", enc.decode(F.col("ids")))
    return back.select(
        "ord", F.array_contains("ids", enc.special["<|unk|>"]).alias("has_unknown"),
        (F.col("back") == F.col("text")).alias("same_text"),
        F.octet_length("back").cast("bigint").alias("n_bytes"),
    )


@query
def token_length_stats(spark, sf):
    docs = tables.documents(spark, sf)
    return rounded(tokens.token_length_stats(docs, models.encoder(spark, sf)))


@query
def token_histogram(spark, sf):
    ids = models.encoder(spark, sf).count(F.col("text"))
    lengths = tables.documents(spark, sf).select(ids.alias("length"))
    return rounded(stats.histogram(lengths, 50))


# --- packing and sharding ----------------------------------------------------


def _planned(spark, sf):
    """Small buckets and a low fan-in, so that the tree has several levels."""
    tokenized = materialise(_tokenized(spark, sf), "tokenized")
    return tokenized, packing.plan_blocks(tokenized, bucket_tokens=QUERY_BUCKET, fan_in=8)


def _placed(spark, sf):
    return materialise(packing.place_docs(_planned(spark, sf)[1]), "placed")


@query
def pack_assign(spark, sf):
    return _placed(spark, sf)


def _packed_text(df):
    return df.select(
        "block_id", as_text(F.col("input_ids")).alias("ids"),
        F.col("length").cast("bigint").alias("length"),
    )


@query
def pack_fixed(spark, sf):
    return _packed_text(packing.pack_fixed(*_planned(spark, sf), models.encoder(spark, sf).pad))


@query
def pack_variable(spark, sf):
    return _packed_text(packing.pack_variable(*_planned(spark, sf), models.encoder(spark, sf).pad))


@query
def pack_diagnostics(spark, sf):
    tokenized, plan = _planned(spark, sf)
    packed = packing.pack_fixed(tokenized, plan, models.encoder(spark, sf).pad)
    return rounded(packing.diagnose(tokenized, packed))


@query
def shard_assign(spark, sf):
    placed = _placed(spark, sf)
    blocks = placed.select("block_id").distinct()
    shards = sharding.assign_shards(blocks, sharding.count_blocks(placed), shard_size=QUERY_SHARD)
    return shards.withColumn("shard", F.col("shard").cast("bigint"))


@query
def split_counts(spark, sf):
    return sharding.split_counts(_placed(spark, sf))


@query
def shard_manifest(spark, sf):
    return sharding.shard_manifest(sharding.split_counts(_placed(spark, sf)), QUERY_SHARD)


# --- composed jobs -----------------------------------------------------------


def _fitted(spark, sf):
    return pipeline.Models(
        models.language_model(spark, sf), models.toxicity_table(spark, sf), encoder=models.encoder(spark, sf)
    )


def _stages(spark, sf):
    raw = tables.noisy_docs(spark, sf).select("ord", "text")
    stages = pipeline.build_stages(
        lambda: raw, _fitted(spark, sf), lambda name, build, metrics=None: materialise(build(), name)
    )
    stages.raw = raw
    return stages


def _job(spark, sf):
    """The whole job from a file of partly damaged lines; its stage copies are removed at the end."""
    folder = f"{work_dir(spark)}/job-{uuid.uuid4().hex}"
    lines = tables.json_lines(spark, sf).orderBy("ord").select("value")
    lines.write.text(f"{folder}/lines")
    ledger = pipeline.run_pipeline(
        spark, f"{folder}/lines", f"{folder}/out", _fitted(spark, sf), shard_size=QUERY_SHARD, keep_stages=False
    )[1]
    return ledger, f"{folder}/out"


@query
def pipeline_lines(spark, sf):
    """Rows per stage of that job, from its ledger and its shard files."""
    ledger, out = _job(spark, sf)
    rows = [("raw", ledger.metrics("raw")["rows"]), ("dedup", ledger.metrics("dedup")["rows"])]
    rows += [(f"status {s}", ledger.metrics("raw")[s]) for s in jsonl.STATUSES]
    rows += [("tokenized", ledger.metrics("tokenized")["docs_counted"]), ("packed", ledger.metrics("packed")["blocks"])]
    counted = spark.createDataFrame(rows, "stage string, rows bigint")
    splits = sharding.manifest_of_files(spark, f"{out}/sharded").groupBy(F.concat(F.lit("shards "), "split").alias("stage"))
    return counted.unionByName(splits.agg(F.sum("blocks").alias("rows")))


@query
def reports_roundtrip(spark, sf):
    """Reports of that job as read from their files: (report, name, value)."""
    _, out = _job(spark, sf)

    def rows(report, *columns):
        df = spark.read.json(f"{out}/reports/{report}")
        pairs = [F.struct(name.alias("name"), F.col(value).cast("double").alias("value")) for name, value in columns]
        return df.select(F.lit(report).alias("report"), F.inline(F.array(*pairs)))

    plain = lambda *names: [(F.lit(n), n) for n in names]
    every = [
        rows("cleaning_summary", (F.concat("counter", F.lit(" docs")), "docs"), (F.concat("counter", F.lit(" pct")), "pct_docs")),
        rows("cleaning_flow", (F.concat(F.lit("edge "), F.col("edge").cast("string")), "flow_value")),
        rows("dedup_counts", *plain("kept", "dropped")),
        rows("token_length_stats", *plain("docs_counted", "avg_tokens", "median_tokens", "p95_tokens", "p99_tokens", "max_tokens")),
        rows("pack_diagnostics", *plain("docs", "min_length", "max_length", "avg_length", "blocks", "distinct_lengths", "bad_blocks")),
        rows("shard_manifest", (F.concat_ws(" ", "split", F.col("shard").cast("string")), "blocks")),
    ]
    out = every[0]
    for more in every[1:]:
        out = out.unionByName(more)
    return rounded(out)


@query
def jsonl_roundtrip(spark, sf):
    """Documents written as JSON Lines and read back, statuses and all."""
    folder = f"{work_dir(spark)}/lines-{uuid.uuid4().hex}"
    jsonl.write_jsonl(tables.noisy_docs(spark, sf).select("ord", "text"), folder)
    back = jsonl.read_jsonl(spark, folder)
    return back.select(F.get_json_object("value", "$.ord").cast("bigint").alias("ord"), "text", "status")


@query
def shards_roundtrip(spark, sf):
    """Shards as read from their files, one file each, with a digest of their blocks."""
    tokenized, plan = _planned(spark, sf)
    packed = materialise(packing.pack_fixed(tokenized, plan, models.encoder(spark, sf).pad), "packed")
    folder = f"{work_dir(spark)}/shards-{uuid.uuid4().hex}"
    sharding.write_shards(sharding.assign_shards(packed, packed.count(), shard_size=QUERY_SHARD), folder)
    block = sharding.read_shards(spark, folder).select(
        "split", "shard", "file_name", F.size("input_ids").alias("tokens"), F.md5(as_text(F.col("input_ids"))).alias("block")
    )
    # The files are listed and parsed once: a row per block, without its ids.
    rows = materialise(block, "read-shards")
    digest = F.md5(F.array_join(F.sort_array(F.collect_list("block")), ""))
    content = rows.groupBy("split", "shard").agg(digest.alias("digest"))
    listed = sharding.manifest_of_rows(rows, F.col("tokens")).join(content, ["split", "shard"])
    return listed.withColumn("shard", F.col("shard").cast("bigint"))


@query
def pipeline_counts(spark, sf):
    return pipeline.stage_counts(_stages(spark, sf))


@query
def run_meta(spark, sf):
    stages = _stages(spark, sf)
    train, val, test = fx.SPLIT_RATIOS
    meta = metadata.run_meta(
        clean.cleaning_summary(stages.verdicts), stages.encoder, stages.total_blocks,
        shard_info={"train_ratio": train, "val_ratio": val, "test_ratio": test},
    )
    return metadata.flat_meta(meta)
