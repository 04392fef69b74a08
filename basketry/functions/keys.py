"""Deterministic per-key choices (splits, remove counts) that depend on the
key alone, never on partitioning or row order, and are expressible in plain
SQL integer arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed parameters of the key hash: a multiplicative hash modulo a prime.
KEY_PRIME = 1000003
KEY_MULTIPLIER = 7919


def key_bucket(key: Column | str, buckets: int, seed: int = 42) -> Column:
    """``((key mod 1000003) * 7919 + seed) mod 1000003 mod buckets`` for an
    integer key (non-negative keys give the same value in SQL with ``%``)."""
    k = F.col(key) if isinstance(key, str) else key
    mixed = F.pmod(F.pmod(k.cast("bigint"), F.lit(KEY_PRIME)) * KEY_MULTIPLIER + seed, F.lit(KEY_PRIME))
    return F.pmod(mixed, F.lit(buckets))
