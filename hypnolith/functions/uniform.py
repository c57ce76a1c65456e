"""Seeded uniform numbers that depend on the row's key only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def keyed_uniform(seed: int, field: str, key: Column) -> Column:
    """Uniform in [0, 1) from (seed, field, key), whatever the partitioning."""
    digest = F.md5(F.concat(F.lit(f"{seed}|{field}|"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)
