"""JSON Lines source: statuses, order key, sinks."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.session import broadcast_if_small, materialise

STATUSES = ["OK", "EMPTY", "MALFORMED", "BAD_JSON"]


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw lines with the three parts of their position in the input."""
    return spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_id"),
    )


def with_line_numbers(lines: DataFrame) -> DataFrame:
    """Replace the position parts by one dense BIGINT `ord` in file order.

    `row_id` counts upwards inside one file split; splits are ordered by path and start. The lines are
    counted per split in a first pass; only that table, one row per split, goes through ordered windows,
    and its offsets meet the lines of a second pass by broadcast. The text itself is neither shuffled nor
    copied. Both passes read one listing of the files with the same settings, so they see the same splits;
    a line of a split that was not counted (a file replaced in between) ends the job.
    """
    splits = lines.groupBy("file_path", "block_start").agg(
        F.min("row_id").alias("first_id"), F.count(F.lit(1)).alias("n")
    )
    splits = materialise(splits, "splits")
    # Two levels: within a file, then over files.
    files = splits.groupBy("file_path").agg(F.sum("n").alias("file_n"))
    before_file = F.sum("file_n").over(Window.orderBy("file_path")) - F.col("file_n")
    files = files.select("file_path", before_file.alias("file_offset"))
    within = Window.partitionBy("file_path").orderBy("block_start")
    offsets = splits.withColumn(
        "split_offset", F.sum("n").over(within) - F.col("n")
    ).join(files, "file_path")
    offset = F.col("file_offset") + F.col("split_offset") - F.col("first_id")
    shifts = broadcast_if_small(offsets.select("file_path", "block_start", offset.alias("shift")))
    shift = F.coalesce("shift", F.raise_error(F.lit("the input files changed")).cast("bigint"))
    return lines.join(shifts, ["file_path", "block_start"], "left").select(
        (F.col("row_id") + shift).alias("ord"), "value"
    )


def _parsed(line: str | None) -> tuple[str | None, str, list[str] | None]:
    """Text, status and keys of one line."""
    try:
        found = json.loads((line or "").strip())
    except (ValueError, RecursionError):
        return None, "BAD_JSON", None
    if not isinstance(found, dict):
        return None, "MALFORMED", None
    keys, text = list(found), found.get("text", "")
    if not isinstance(text, str):
        return None, "MALFORMED", keys
    return text, "OK" if text.strip() else "EMPTY", keys


def _clean(text: str | None) -> str | None:
    """Half of a surrogate pair, which JSON can spell and UTF-8 cannot, becomes a question mark."""
    return text.encode("utf-8", "replace").decode() if text and not text.isascii() else text


def _parse(col: Column) -> Column:
    @F.arrow_udf("struct<text string, status string, keys array<string>>")
    def parse(lines: pa.Array) -> pa.Array:
        rows = [_parsed(line) for line in lines.to_pylist()]
        texts, statuses, keys = zip(*rows) if rows else ((), (), ())
        listed = [None if k is None else [_clean(x) for x in k] for k in keys]
        return pa.StructArray.from_arrays(
            [
                pa.array([_clean(t) for t in texts], pa.string()), pa.array(statuses, pa.string()),
                pa.array(listed, pa.list_(pa.string())),
            ],
            ["text", "status", "keys"],
        )

    return parse(col)


def parse_lines(lines: DataFrame) -> DataFrame:
    """Add `text`, `status` and `keys` to (ord, value).

    OK: object with a non-blank string text; EMPTY: text missing or blank;
    MALFORMED: valid JSON that is no object, or text that is no string;
    BAD_JSON: blank line or invalid JSON. Repeated keys: the last one counts.

    Each line is parsed once, by Python's own parser: no bound on the length of a line, NaN and
    infinities are numbers, and nesting may be as deep as that parser goes (thousands of levels).
    """
    parsed = lines.select("ord", "value", _parse(F.col("value")).alias("parsed"))
    return parsed.select("ord", "value", "parsed.text", "parsed.status", "parsed.keys")


def read_jsonl(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(ord, value, text, status, keys) for every line of the input, in order."""
    return parse_lines(with_line_numbers(read_lines(spark, path)))


def objects_only(parsed: DataFrame) -> DataFrame:
    """What a line-by-line JSON reader yields: everything that parses."""
    return parsed.filter(F.col("status") != "BAD_JSON")


def write_jsonl(df: DataFrame, path: str, mode: str = "append") -> None:
    """One JSON object per row; nulls are left out."""
    df.write.mode(mode).json(path)


def write_report(df: DataFrame, path: str) -> None:
    """A report of a few rows as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def serialise(df: DataFrame, *columns: str) -> Column:
    """The JSON text of the given columns, as a line of a JSON Lines file."""
    return F.to_json(F.struct(*[df[c] for c in columns]))
