"""Deterministic pseudo-random order of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 60


def shuffle_digest(key_cols: Sequence[str], seed: int) -> Column:
    """md5 of key and seed in hex: the position of a row in a seeded shuffle.

    A NULL in a composite key is marked, so that (NULL, 'a') and ('a', NULL) differ.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in key_cols]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def digest_prefix(digest: Column) -> Column:
    """First 60 bits of a hex digest as a bigint, in the same order as the digests."""
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")
