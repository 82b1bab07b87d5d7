"""Token counts of documents in flat, unindexed token files, by scanning for the end identifier.

A flat file is nothing but little-endian ids. It is cut into byte blocks; each task searches its block
for the end id with one vectorised comparison and reports the documents that end there, counted from
the block's start, and the ids after the last end. A prefix scan over the blocks then adds what earlier
blocks left open, and numbers the documents.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import id_text, materialise, open_shared, shared_folder
from corpusloom.llm.token_ids import tokenizer

#: Bytes of a block, and blocks whose sums are scanned together before the sums of those groups are.
BLOCK_BYTES, GROUP_BLOCKS = 1 << 20, 1024


def write_flat_files(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """One flat file of 16-bit ids per task; (path, n_bytes, nth, doc_id) for every document.

    The file itself has no index: nth (from 0) only tells which document stands where. Null texts
    are empty. Special tokens in a text are
    ordinary text, as the end id must not occur inside a document.
    """
    folder = shared_folder(docs.sparkSession, "flat-tokens")

    def write(batches):
        tok, stream, ids_of, n_bytes = tokenizer(tokenizer_path, literal_specials=True), None, [], 0
        if tok.dtype.itemsize > 2:
            raise ValueError("flat files hold 16-bit ids")
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                if stream is None:
                    path = f"{folder}/{uuid.uuid4().hex}.bin"
                    system, place = open_shared(path)
                    system.create_dir(place.rsplit("/", 1)[0], recursive=True)
                    stream = system.open_output_stream(place, compression=None)
                ids = tok.array(text.as_py())
                if (ids == end_id).any():
                    raise ValueError(f"document {doc_id} contains the end id {end_id}")
                data = np.append(ids, end_id).astype("<u2").tobytes()
                stream.write(data)
                ids_of.append(doc_id.as_py())
                n_bytes += len(data)
        if stream is not None:
            stream.close()
            n = len(ids_of)
            yield pa.RecordBatch.from_arrays(
                [pa.array([path] * n), pa.array([n_bytes] * n), pa.array(range(n), pa.int64()), pa.array(ids_of, pa.int64())],
                names=["path", "n_bytes", "nth", "doc_id"],
            )

    rows = id_text(docs).mapInArrow(write, "path string, n_bytes long, nth long, doc_id long")
    return materialise(rows, "flat-token-list")


def scan_blocks(files: DataFrame, end_id: int, block_bytes: int = BLOCK_BYTES, width: int = 2) -> DataFrame:
    """(path, block, n_ends, open_ids, lengths): `lengths` counts ids from the block's start or the last end."""
    if block_bytes % width:
        raise ValueError("a block holds whole ids")
    last = F.greatest(F.ceil(F.col("n_bytes") / block_bytes) - 1, F.lit(0))
    blocks = files.select("path", "n_bytes", F.explode(F.sequence(F.lit(0), last)).alias("block"))
    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = blocks.repartition(n, "path", "block")

    def scan(batches):
        for batch in batches:
            rows = []
            for path, n_bytes, block in zip(*(c.to_pylist() for c in batch.columns)):
                system, place = open_shared(path)
                start = block * block_bytes
                with system.open_input_file(place) as source:
                    data = source.read_at(min(block_bytes, n_bytes - start), start)
                ids = np.frombuffer(data, f"<u{width}")
                ends = np.flatnonzero(ids == end_id)
                lengths = np.diff(ends, prepend=-1)
                after = len(ids) - int(ends[-1]) - 1 if len(ends) else len(ids)
                rows.append((path, block, len(ends), after, lengths.tolist()))
            columns = zip(*rows) if rows else ([],) * 5
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            names = ["path", "block", "n_ends", "open_ids", "lengths"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return dealt.mapInArrow(scan, "path string, block long, n_ends long, open_ids long, lengths array<long>")


def stitch(scanned: DataFrame) -> DataFrame:
    """Adds before_docs and carried: documents that ended before the block, ids open at its start.

    A scan in two levels, so that no window holds more than a group of blocks of one file: sums
    within each group, then over the groups. ids since the last end = all ids before - ids up to
    that end; both are running sums or maxima.
    """
    staged = materialise(scanned.withColumn("grp", F.floor(F.col("block") / GROUP_BLOCKS)), "scanned-blocks")
    n_ids = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x) + F.col("open_ids")
    inside = Window.partitionBy("path", "grp").orderBy("block")
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    # Ids of the group up to the last end so far; null where there is none.
    local = staged.withColumn("n_ids", n_ids).withColumn(
        "ids_in", F.coalesce(F.sum("n_ids").over(upto), F.lit(0))
    )
    end_at = F.when(F.col("n_ends") > 0, F.col("ids_in") + F.col("n_ids") - F.col("open_ids"))
    local = local.withColumn("end_at", end_at).select(
        "*",
        F.coalesce(F.sum("n_ends").over(upto), F.lit(0)).alias("docs_in"),
        F.max("end_at").over(upto).alias("end_in"),
    )
    groups = local.groupBy("path", "grp").agg(
        F.sum("n_ends").alias("g_ends"), F.sum("n_ids").alias("g_ids"), F.max("end_at").alias("g_end")
    )
    over = Window.partitionBy("path").orderBy("grp")
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("ids_0", F.coalesce(F.sum("g_ids").over(before), F.lit(0)))
    groups = groups.withColumn("end_g", F.col("ids_0") + F.col("g_end")).select(
        "path", "grp", "ids_0",
        F.coalesce(F.sum("g_ends").over(before), F.lit(0)).alias("docs_0"),
        F.coalesce(F.max("end_g").over(before), F.lit(0)).alias("end_0"),
    )
    last_end = F.greatest("end_0", F.coalesce(F.col("ids_0") + F.col("end_in"), F.lit(0)))
    return local.join(groups, ["path", "grp"]).select(
        "path", "block", "lengths", "open_ids",
        (F.col("docs_0") + F.col("docs_in")).alias("before_docs"),
        (F.col("ids_0") + F.col("ids_in") - last_end).alias("carried"),
    )


def count_tokens(files: DataFrame, end_id: int, block_bytes: int = BLOCK_BYTES, width: int = 2) -> DataFrame:
    """(path, nth, n_tokens) of every document that ends, its end id included.

    `files` has (path, n_bytes). Ids after a file's last end belong to no document and are left out,
    as in a file that was cut short; an empty file has no document.
    """
    stitched = stitch(scan_blocks(files.filter("n_bytes > 0"), end_id, block_bytes, width))
    each = stitched.select("path", "before_docs", "carried", F.posexplode("lengths").alias("i", "n"))
    first = F.when(F.col("i") == 0, F.col("carried")).otherwise(F.lit(0))
    return each.select("path", (F.col("before_docs") + F.col("i")).alias("nth"), (F.col("n") + first).alias("n_tokens"))


def document_token_counts(docs: DataFrame, tokenizer_path: str, end_id: int = 50256) -> DataFrame:
    """(doc_id, n_tokens) of every document, counted in flat files that Spark wrote of them."""
    listed = write_flat_files(docs, tokenizer_path, end_id)
    counts = count_tokens(listed.select("path", "n_bytes").distinct(), end_id)
    return listed.join(counts, ["path", "nth"]).select("doc_id", "n_tokens")
