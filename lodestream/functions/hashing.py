"""Seeded, partition-independent pseudo-random numbers from a row's key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = 1 << 32


def hash32(seed: int | str, *keys: Column | str) -> Column:
    """First 32 bits of md5(seed:key:…) as BIGINT, uniform in [0, 2^32)."""
    cols = [k if isinstance(k, Column) else F.col(k) for k in keys]
    text = F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
