"""Reproducible pseudo-random columns that do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS = 15  # hex digits of the digest that are used: 60 bits


def hashed_long(seed: int, *keys: Column) -> Column:
    """Non-negative 60-bit integer from the MD5 of ``seed:key:...``."""
    text = F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, _DIGITS), 16, 10).cast("bigint")


def hashed_unit(seed: int, *keys: Column) -> Column:
    """Double in [0, 1)."""
    buckets = 1 << 52
    return F.pmod(hashed_long(seed, *keys), F.lit(buckets)).cast("double") / F.lit(float(buckets))
