"""Content hashes and SimHash helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doc_hash(col: Column) -> Column:
    return F.sha2(col, 256)


def low_md5(col: Column) -> Column:
    """Low 64 bits of the MD5 digest as a signed BIGINT."""
    return F.conv(F.substring(F.md5(col), 17, 16), 16, -10).cast("bigint")


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def uniform_key(ord_col: Column, seed: int) -> Column:
    """Pseudo-random 60-bit integer per row: a fixed function of key and seed."""
    digest = F.md5(F.concat_ws(":", ord_col.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
