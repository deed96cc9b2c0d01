"""Seeded, partitioning-independent pseudo-random choices.

``rand()`` depends on partition layout; an md5 of ``seed:key`` does not, so a
choice replays on any cluster and DuckDB reproduces it exactly
(``md5(seed || ':' || key)`` and ``cast('0x' || substr(h, 1, 8) as bigint)``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def seeded_hex(seed: int | str, *cols) -> Column:
    """``md5('<seed>:<c1>:<c2>...')`` as 32 hex characters."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[_s(c) for c in cols]))


def hex_slice_int(h: Column, offset: int = 1, width: int = 8) -> Column:
    """Unsigned integer read from ``width`` hex digits of ``h`` starting at ``offset`` (1-based)."""
    return F.conv(F.substring(h, offset, width), 16, 10).cast("bigint")


def seeded_bucket(seed: int | str, modulus: int, *cols, offset: int = 1) -> Column:
    """A bucket in ``[0, modulus)`` from 8 hex digits of the seeded md5."""
    return hex_slice_int(seeded_hex(seed, *cols), offset) % F.lit(modulus)
