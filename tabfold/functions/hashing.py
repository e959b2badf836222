"""Buckets that depend on a row's key only, never on where the row is stored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

HEX_DIGITS = 8


def _key_text(key: str, joined: bool) -> Column:
    text = F.col(key).cast("string")
    if joined:
        text = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("-"), F.lit("\\-"))
    return F.when(F.col(key).isNull(), F.raise_error(F.lit(f"null in key column {key}"))).otherwise(text)


def hash_bucket(keys: Sequence[str], buckets: int, *, draw: int = 0) -> Column:
    """Bucket 0..buckets-1 from eight hex digits of the md5 of the joined keys.

    ``draw`` picks which eight of the 32 digits are used, so that two buckets of
    one row (a split and a fold, say) are independent. md5 keeps the result
    equal in any SQL engine. A separator inside a key is marked, so that different
    keys never join to the same text. A null key fails the query: all rows with it
    would fall into one bucket.
    """
    if not 0 <= draw < 4:
        raise ValueError("draw must be 0, 1, 2 or 3")
    parts = [_key_text(k, joined=len(keys) > 1) for k in keys]
    text = F.concat_ws("-", *parts)
    digits = F.substring(F.md5(text), draw * HEX_DIGITS + 1, HEX_DIGITS)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(buckets)).cast("int")
