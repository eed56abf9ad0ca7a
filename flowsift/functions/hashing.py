"""Uniform numbers derived from row keys.

`rand()` depends on the partition layout, so samples drawn from it change when a file is added or a task
is retried on other input. A hash of the key does not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsift.functions.columns import c

_TWO_32 = 4294967296.0
_TWO_53 = 9007199254740992.0


def key_uniform(seed: int, *keys: str | Column) -> Column:
    """Uniform in [0, 1) from the first 32 bits of md5('seed|key|…'); any SQL engine can recompute it."""
    parts = [F.coalesce((c(k) if isinstance(k, str) else k).cast("string"), F.lit("")) for k in keys]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(_TWO_32)


def fast_uniform(seed: int, *keys: str | Column) -> Column:
    """Uniform in [0, 1) from 53 bits of xxhash64: several times cheaper, Spark only."""
    cols = [c(k) if isinstance(k, str) else k for k in keys]
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11).cast("double") / F.lit(_TWO_53)


def row_key(df: DataFrame) -> Column:
    """Stand-in for a missing key: a hash of the whole row. Equal rows share it, so they land together."""
    return F.xxhash64(*[c(n) for n in df.columns])
