"""Exact order statistics by distributed selection (no sort of the table).

Sampling and ordered splits only need the order keys found at one or two
ranks.  Each record gets a numeric *proxy* that never decreases along the
exact order (the order key itself when it is a number, or the first 15 hex
digits of a seeded md5).  Rows fall into three classes in that order: without a
proxy (null), with a finite or infinite one, and NaN.

1. One aggregate counts the classes and finds the range of the proxies; the class that
   holds a rank follows from the counts.
2. Radix passes: the range that holds a rank is cut into ``CELLS`` cells of equal width, and one
   aggregate (partial, no shuffle of rows) counts the cells of the ranges of *all* wanted
   ranks; a rank's next range is the span of proxies found in its cell.  A uniform proxy (an md5)
   shrinks by ``CELLS`` each pass, so two passes serve 10**9 rows; any double
   is told apart after six.
3. The rows of all last ranges (at most ``bracket_rows`` each) are read in order at once.

A class or range that cannot shrink (rows that tie in the proxy) is ranked
exactly with :func:`threadline.operators.positions.global_positions`.  The path is
the same at every size.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadline.functions.hashing import seeded_hex
from threadline.operators.positions import global_positions

# A range of so many rows is ordered; larger ones are cut first.
BRACKET_ROWS = 64
CELLS = 4096
FAR = 1.7e308
PROXY = "_tl_proxy"


def hash_proxy(h: Column) -> Column:
    """Non-decreasing numeric proxy of an md5 hex string: its first 15 hex digits."""
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")


def order_stats(df: DataFrame, proxy: Column, exact_cols: Sequence[str], ranks,
                bracket_rows: int = BRACKET_ROWS, accuracy: int = CELLS) -> tuple[int, dict[int, tuple]]:
    """Total rows and the ``exact_cols`` tuple at each wanted 0-based rank.

    ``proxy`` must be numeric and non-decreasing in the order of
    ``exact_cols`` (a unique key; nulls first, NaN last, as Spark orders).
    ``ranks`` is a list of ranks or a function of the total returning one; a pass
    cuts a range into ``accuracy`` cells.  The projected key table is persisted (memory and disk; lost blocks are
    recomputed) for the few passes and released afterwards.
    """
    exact_cols = list(exact_cols)
    base = df.select(proxy.cast("double").alias(PROXY), *exact_cols).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        p = F.col(PROXY)
        real = F.when(~F.isnan(p), p)
        total, nulls, nans, low, high = base.agg(F.count(F.lit(1)), F.count_if(p.isNull()), F.count_if(F.isnan(p)), F.min(real), F.max(real)).first()
        wanted = sorted({int(r) for r in (ranks(total) if callable(ranks) else ranks) if 0 <= int(r) < total})
        found: dict[int, tuple] = {}
        inner = {}
        for k in wanted:
            if k < nulls:
                found[k] = _row_at(base.filter(p.isNull()), exact_cols, k, nulls, bracket_rows)
            elif k >= total - nans:
                found[k] = _row_at(base.filter(F.isnan(p)), exact_cols, k - (total - nans), nans, bracket_rows)
            else:
                inner[k] = _Range(low, high, k - nulls, total - nulls - nans)
        found.update(_select(base.filter(p.isNotNull() & ~F.isnan(p)), exact_cols, inner, bracket_rows, accuracy))
        return total, found
    finally:
        base.unpersist()


class _Range(NamedTuple):
    """Proxies from ``low`` to ``high`` (of ``rows`` rows) that hold the row at rank ``at`` among them."""

    low: float
    high: float
    at: int
    rows: int

    def holds(self) -> Column:
        return (F.col(PROXY) >= F.lit(self.low)) & (F.col(PROXY) <= F.lit(self.high))

    def cell(self, cells: int) -> Column:
        """Cell of a proxy; halves keep the width of the widest range finite."""
        low, high = (max(-FAR, min(FAR, x)) / 2 for x in (self.low, self.high))
        half = F.greatest(F.lit(-FAR), F.least(F.lit(FAR), F.col(PROXY))) / 2
        return F.least(F.lit(cells - 1), F.floor((half - F.lit(low)) / F.lit(high - low) * cells).cast("int"))


def _row_at(rows: DataFrame, exact_cols: list[str], k: int, n: int, bracket_rows: int) -> tuple:
    """The row at rank ``k`` of ``n`` rows that are few, or tie in the proxy."""
    if n <= bracket_rows:
        row = rows.select(*exact_cols).orderBy(*exact_cols).offset(k).limit(1).collect()[0]
        return tuple(row)
    return global_positions(rows.select(*exact_cols), exact_cols, pos_col="_tl_r").rows_at([k])[k]


def _select(base: DataFrame, exact_cols: list[str], ranges: dict[int, _Range], bracket_rows: int, cells: int) -> dict[int, tuple]:
    """The row of each rank, from the range that is known to hold it."""
    while True:
        cut = sorted({(r.low, r.high) for r in ranges.values() if r.rows > bracket_rows and r.low < r.high})
        if not cut:
            break
        # ranges are equal or apart: a row lies in one at most
        where, cell = F.lit(None).cast("int"), F.lit(None).cast("int")
        for i, (low, high) in enumerate(cut):
            r = _Range(low, high, 0, 0)
            where, cell = F.when(r.holds(), i).otherwise(where), F.when(r.holds(), r.cell(cells)).otherwise(cell)
        counts = (base.select(PROXY, where.alias("_tl_i"), cell.alias("_tl_c")).where("_tl_i is not null").groupBy("_tl_i", "_tl_c")
                  .agg(F.count(F.lit(1)).alias("n"), F.min(PROXY).alias("low"), F.max(PROXY).alias("high")).collect())
        counts.sort(key=lambda c: (c["_tl_i"], c["_tl_c"]))
        for k, r in ranges.items():
            if r.rows <= bracket_rows or r.low == r.high:
                continue
            below = 0
            for c in counts:
                if c["_tl_i"] == cut.index((r.low, r.high)):
                    if r.at < below + c["n"]:
                        ranges[k] = _Range(c["low"], c["high"], r.at - below, c["n"])
                        break
                    below += c["n"]
    few = sorted({(r.low, r.high) for r in ranges.values() if r.rows <= bracket_rows})
    found = {}
    if few:
        where = F.lit(None).cast("int")
        for i, (low, high) in enumerate(few):
            where = F.when(_Range(low, high, 0, 0).holds(), i).otherwise(where)
        rows = (base.select(where.alias("_tl_i"), *exact_cols).where("_tl_i is not null").orderBy("_tl_i", *exact_cols).collect())
        for k, r in ranges.items():
            if r.rows <= bracket_rows:
                mine = [x for x in rows if x["_tl_i"] == few.index((r.low, r.high))]
                found[k] = tuple(mine[r.at])[1:]
    for k, r in ranges.items():
        if k not in found:
            found[k] = _row_at(base.filter(r.holds()), exact_cols, r.at, r.rows, bracket_rows)
    return found


def seeded_proxy_stats(df: DataFrame, seed, keys: Sequence[str], ranks: Sequence[int],
                       **kw) -> tuple[int, dict[int, tuple]]:
    """Order statistics of the seeded shuffle ``(md5('<seed>:<keys>'), keys)``.

    Returned tuples are ``(hex, *keys)``.
    """
    keys = list(keys)
    h = seeded_hex(seed, *keys)
    staged = df.select(*keys).withColumn("_tl_h", h)
    return order_stats(staged, hash_proxy(F.col("_tl_h")), ["_tl_h", *keys], ranks, **kw)
