"""The whole job, the file stream, and every query against its SQL."""

import glob
import json
import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from corpusloom.plans import models, oracle, pipeline, registry
from corpusloom.sources import tables
from corpusloom.streaming.cleaning import clean_stream, write_clean_stream


def rounded(value):
    return round(value, 5) if isinstance(value, float) and not math.isnan(value) else value


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df = contract.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = [tuple(rounded(r[c]) for c in columns) for r in df.collect()]
    result = con.execute(contract.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = [tuple(rounded(r[i]) for i in at) for r in result.fetchall()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_every_query_has_sql(spark):
    assert set(registry.all_queries()) == set(oracle.all_sql())


@pytest.fixture(scope="module")
def raw_folder(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "lines")
    noisy = tables.noisy_docs(spark, sf_dir).orderBy("ord")
    noisy.select(F.to_json(F.struct("ord", "text")).alias("value")).coalesce(1).write.text(path)
    return path


def test_pipeline_end_to_end(spark, sf_dir, raw_folder, tmp_path):
    out = str(tmp_path / "out")
    fitted = pipeline.Models(
        models.language_model(spark, sf_dir), models.toxicity_model(spark, sf_dir)
    )
    stages, ledger = pipeline.run_pipeline(spark, raw_folder, out, fitted, 256, 20, merges=50)
    table = {r.stage: r["rows"] for r in pipeline.stage_counts(stages).collect()}
    assert table["raw"] == 250 and table["clean"] == table["tokenized"] > 0
    tokens = stages.tokenized.agg(F.sum("length")).first()[0]
    flat = stages.packed.select(F.explode("input_ids").alias("id"))
    pads = flat.filter(F.col("id") == stages.encoder.pad).count()
    assert table["packed"] * 256 == tokens + pads
    shards = spark.read.json(f"{out}/sharded")
    assert shards.count() == table["packed"]
    assert {r[0] for r in shards.select("length").distinct().collect()} == {256}
    for name in ["raw_doc_stats", "raw_category_pct", "cleaning_summary", "quality_report",
                 "token_length_stats", "pack_diagnostics", "shard_manifest", "clean_category_pct",
                 "dedup_counts", "timing"]:
        assert spark.read.json(f"{out}/reports/{name}").count() > 0
    meta = json.loads(spark.read.text(f"{out}/meta").first()[0])
    assert meta["data"]["total_blocks"] == table["packed"]
    assert meta["tokenizer"]["special_tokens"]["<|eos|>"] == stages.encoder.eos


def _files(path):
    found = glob.glob(f"{path}/**/*.parquet", recursive=True)
    return {f: os.stat(f).st_mtime_ns for f in found}


def test_killed_job_goes_on_where_it_was(spark, sf_dir, raw_folder, tmp_path, monkeypatch):
    fitted = pipeline.Models(
        models.language_model(spark, sf_dir), models.toxicity_model(spark, sf_dir), encoder=models.encoder(spark, sf_dir)
    )
    run = lambda out: pipeline.run_pipeline(spark, raw_folder, out, fitted, 256, 20, keep_stages=False)
    whole, broken = str(tmp_path / "whole"), str(tmp_path / "broken")
    _, ledger = run(whole)
    read = lambda out, name: sorted(map(str, spark.read.json(f"{out}/{name}").collect()))

    def dies(*args, **kwargs):
        raise RuntimeError("killed")

    for module, step in [(pipeline.packing, "pack_fixed"), (pipeline.sharding, "write_shards")]:
        with monkeypatch.context() as m:
            m.setattr(module, step, dies)
            with pytest.raises(RuntimeError):
                run(broken)
        # Copies that nothing needs any more are gone; what is finished is not written again.
        assert not os.path.exists(f"{broken}/raw") and not os.path.exists(f"{broken}/dedup")
        before = _files(f"{broken}/tokenized")
        assert before
    _, resumed = run(broken)
    assert not _files(broken), "stage copies left"
    for name in ("sharded", "reports/cleaning_summary", "reports/pack_diagnostics", "reports/quality_report"):
        assert read(whole, name) == read(broken, name)
    assert resumed.metrics("packed") == ledger.metrics("packed")
    # Finished: nothing runs, not even the models.
    again = pipeline.run_pipeline(spark, raw_folder, broken, fitted, 256, 20, keep_stages=False)[1]
    assert again.metrics("dedup") == ledger.metrics("dedup")
    # Other parameters are another job.
    assert pipeline.Ledger(spark, broken, {"raw": "other"}).mark("raw") is None


def test_stream_equals_batch(spark, sf_dir, raw_folder, tmp_path):
    from corpusloom.operators.clean import clean_verdicts

    model = models.language_model(spark, sf_dir)
    out, mark = str(tmp_path / "clean"), str(tmp_path / "mark")
    query = write_clean_stream(clean_stream(spark, raw_folder, model), out, mark)
    query.awaitTermination(120)
    batch = clean_verdicts(tables.noisy_docs(spark, sf_dir), model)
    want = sorted(r.text for r in batch.filter("verdict = 'KEPT'").collect())
    assert sorted(r.text for r in spark.read.json(out).collect()) == want
