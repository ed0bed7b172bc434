"""Small column expressions shared by the jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_FACTOR = 2654435761
HASH_RANGE = 1000003
#: Values of the hash that sampling compares with a share: shares down to 1 / SHARE_RANGE are told apart.
SHARE_RANGE = 2**31


def key_hash(key: Column | str, buckets: int = HASH_RANGE) -> Column:
    """H3: integer hash of a whole-number key, the same in any engine.

    The key is reduced below 2^31 first so that the product stays inside a bigint
    for keys of any size.
    """
    key = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.pmod(key, F.lit(2**31)) * F.lit(HASH_FACTOR), F.lit(buckets))


def hash_share(key: Column | str) -> Column:
    """The key's hash as a share from 0 to below 1, in steps of 1 / ``SHARE_RANGE``."""
    return key_hash(key, SHARE_RANGE) / F.lit(float(SHARE_RANGE))


def unit_interval(key: Column | str) -> Column:
    """A fixed pseudo-uniform number strictly between 0 and 1 for each key."""
    return (key_hash(key) + F.lit(0.5)) / F.lit(float(HASH_RANGE))


def held_out(key: Column | str, share: float) -> Column:
    """True for a fixed share of the keys, independent of ``unit_interval`` of the same key."""
    key = F.col(key) if isinstance(key, str) else key
    return key_hash(F.pmod(key, F.lit(2**31)) * F.lit(48271) + F.lit(11)) < F.lit(share * HASH_RANGE)


def rounded(x: Column, digits: int) -> Column:
    """Round half up by ``floor``, which engines agree on, unlike ``round`` of a double."""
    scale = float(10**digits)
    return F.floor(x * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def money(x: Column | str) -> Column:
    """Exact two-place decimal, so that sums do not depend on the order of addition."""
    x = F.col(x) if isinstance(x, str) else x
    return x.cast("decimal(12,2)")


def seconds_between(later: Column, earlier: Column) -> Column:
    """Seconds from one zone-less timestamp to another, as a double."""
    gap = (later - earlier).cast("interval second")
    return gap.cast("decimal(20,6)").cast("double")


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, free of the session time zone."""
    gap = (ts - F.expr("timestamp_ntz'1970-01-01'")).cast("interval second")
    return (gap.cast("decimal(20,6)") * F.lit(1000000)).cast("bigint")


def rounded_all(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """The same rows with some columns rounded."""
    return df.withColumns({c: rounded(F.col(c), digits) for c in columns})
