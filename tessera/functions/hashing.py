"""Portable, deterministic hash helpers (md5: same hex in every engine)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_key(*cols, seed: int | str | None = None) -> Column:
    """md5 hex of the columns joined by '|' (and the seed, if any)."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) if isinstance(c, str)
             else F.coalesce(c.cast("string"), F.lit("")) for c in cols]
    if seed is not None:
        parts.append(F.lit(str(seed)))
    return F.md5(F.concat_ws("|", *parts))


def hash_uniform(*cols, seed: int | str | None = None) -> Column:
    """A uniform number in [0, 1) from the first 8 hex digits of md5."""
    h = md5_key(*cols, seed=seed)
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def hash_32(*cols, seed: int | str | None = None) -> Column:
    """A uniform whole number in 0 .. 2^32 - 1 from the first 8 hex digits of md5."""
    return F.conv(F.substring(md5_key(*cols, seed=seed), 1, 8), 16, 10).cast("long")


def hash_bucket(*cols, buckets: int = 100, seed: int | str | None = None) -> Column:
    """md5 prefix as an integer modulo ``buckets``."""
    h = md5_key(*cols, seed=seed)
    return (F.conv(F.substring(h, 1, 8), 16, 10).cast("long") % F.lit(buckets)).cast("int")
