"""Dataset splits.

* :func:`split_prefix` - ordered prefix split by position: the first
  ``int(n * r0)`` records are train, then valid up to ``int(n * (r0 + r1))``
  (``rule="cumulative"``) or ``train_end + int(n * r1)`` (``rule="additive"``),
  the rest test.  Positions come from two order statistics over the record
  table; the label is then a row-local comparison with two literal bounds,
  so turn rows are neither joined nor collected and no single-partition
  exchange appears.
* :func:`split_grouped` - leakage-free split: a seeded hash bucket of the
  *origin* record decides, so every copy, window or augmentation of one
  origin lands in the same split.
* :func:`split_grouped_weighted` - leakage-free split whose shares come as near to the
  ratios as whole groups allow, also with few or heavy groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from threadline.functions.hashing import seeded_bucket
from threadline.operators.positions import global_positions
from threadline.operators.sample import lex_below, shuffle_key
from threadline.operators.select import order_stats, seeded_proxy_stats

NUMERIC = (Ty.ByteType, Ty.ShortType, Ty.IntegerType, Ty.LongType, Ty.FloatType, Ty.DoubleType, Ty.DecimalType)

# The reference's split ratios and names.
SPLIT_RATIOS = (0.8, 0.1, 0.1)
SPLIT_NAMES = ("train", "valid", "test")
# Bucket thresholds of the grouped split (per mille).
GROUP_BUCKETS = 1000
GROUP_THRESHOLDS = (800, 900)


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def split_bounds(n: int, ratios: Sequence[float] = SPLIT_RATIOS, rule: str = "cumulative") -> tuple[int, int]:
    """``(train_end, valid_end)`` with Python float semantics."""
    train_end = int(n * ratios[0])
    if rule == "cumulative":
        valid_end = int(n * (ratios[0] + ratios[1]))
    elif rule == "additive":
        valid_end = train_end + int(n * ratios[1])
    else:
        raise ValueError(f"unknown split rule {rule!r}")
    return train_end, valid_end


class PrefixSplit:
    """Bounds of an ordered split, applied as a row-local label."""

    def __init__(self, order_exprs: list[Column], total: int, train_end: int, valid_end: int,
                 train_bound, valid_bound):
        self.order_exprs = order_exprs
        self.total, self.train_end, self.valid_end = total, train_end, valid_end
        self.train_bound, self.valid_bound = train_bound, valid_bound

    def _below(self, end: int, bound) -> Column:
        if end <= 0:
            return F.lit(False)
        if bound is None:  # end >= total
            return F.lit(True)
        return lex_below(self.order_exprs, bound)

    def label(self) -> Column:
        names = SPLIT_NAMES
        return (F.when(self._below(self.train_end, self.train_bound), F.lit(names[0]))
                .when(self._below(self.valid_end, self.valid_bound), F.lit(names[1]))
                .otherwise(F.lit(names[2])))


def prefix_split(records: DataFrame, keys, seed: int | str | None = None,
                 ratios: Sequence[float] = SPLIT_RATIOS, rule: str = "cumulative") -> PrefixSplit:
    """Compute split bounds over the record table.

    Order is the record key itself (``seed=None``, file order stand-in) or
    a seeded shuffle ``(md5('<seed>:<key>'), key)``.
    """
    keys = _names(keys)
    recs = records.select(*keys).distinct()

    def want(total: int) -> list[int]:
        return list(split_bounds(total, ratios, rule))

    if seed is not None:
        order_exprs = [shuffle_key(seed, keys), *[F.col(k) for k in keys]]
        total, at = seeded_proxy_stats(recs, seed, keys, want)
    elif isinstance(recs.schema[keys[0]].dataType, NUMERIC):
        order_exprs = [F.col(k) for k in keys]
        total, at = order_stats(recs, F.col(keys[0]), keys, want)
    else:  # no numeric proxy for the first key: rank the record table exactly
        order_exprs = [F.col(k) for k in keys]
        ranked = global_positions(recs, keys)
        total = ranked.total
        at = ranked.rows_at(want(total))
    train_end, valid_end = split_bounds(total, ratios, rule)
    return PrefixSplit(order_exprs, total, train_end, valid_end, at.get(train_end), at.get(valid_end))


def split_prefix(df: DataFrame, keys="conv_id", seed: int | str | None = None,
                 ratios: Sequence[float] = SPLIT_RATIOS, rule: str = "cumulative",
                 split_col: str = "split") -> DataFrame:
    """Label every row with the split of its record (records ordered by key or seeded shuffle)."""
    sp = prefix_split(df, keys, seed, ratios, rule)
    return df.withColumn(split_col, sp.label())


def group_bucket(seed: int | str, origin_cols) -> Column:
    """``md5('<seed>:<origin>')`` read as an unsigned 32-bit int, modulo 1000."""
    return seeded_bucket(seed, GROUP_BUCKETS, *_names(origin_cols))


def split_grouped(df: DataFrame, origin_cols="conv_id", seed: int | str = 42,
                  thresholds: Sequence[int] = GROUP_THRESHOLDS, split_col: str = "split") -> DataFrame:
    """Row-local split by the origin's hash bucket (no origin in two splits)."""
    b = group_bucket(seed, origin_cols)
    label = (F.when(b < thresholds[0], F.lit(SPLIT_NAMES[0]))
             .when(b < thresholds[1], F.lit(SPLIT_NAMES[1]))
             .otherwise(F.lit(SPLIT_NAMES[2])))
    return df.withColumn(split_col, label)


def group_cuts(df: DataFrame, origin_cols="conv_id", seed: int | str = 42, ratios: Sequence[float] = SPLIT_RATIOS,
               prefix_chars: int = 4) -> tuple[int, list[tuple | None]]:
    """(rows, [(hash, *origin) of the first group beyond each boundary, or None]).

    Groups lie along a line in seeded hash order, each as long as it has rows.  A group is
    below a boundary at ``t`` rows when its middle is: ``2 * before + rows < 2 * t``.  Weights are summed
    per hash prefix (``16 ** prefix_chars`` sums at most reach the driver); only the groups of the prefixes
    at a boundary are put in order.
    """
    origin = _names(origin_cols)
    groups = (df.groupBy(*origin).agg(F.count(F.lit(1)).alias("_tl_w")).withColumn("_tl_h", shuffle_key(seed, origin))
              .withColumn("_tl_p", F.substring("_tl_h", 1, prefix_chars)).persist())
    try:
        sums = sorted((r[0], r[1]) for r in groups.groupBy("_tl_p").agg(F.sum("_tl_w")).collect())
        total = sum(w for _, w in sums)
        order = ["_tl_h", *origin]
        run = Window.partitionBy("_tl_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        cuts: list[tuple | None] = []
        for t in (total * ratios[0], total * (ratios[0] + ratios[1])):
            base, at = 0, None
            for p, w in sums:  # the first prefix that passes the boundary holds the first group beyond it, or the next one does
                if base + w > t:
                    inside = groups.filter(F.col("_tl_p") == p).withColumn("_tl_end", F.sum("_tl_w").over(run) + F.lit(base))
                    at = inside.filter(2 * F.col("_tl_end") - F.col("_tl_w") >= F.lit(2.0 * t)).orderBy(*order).select(*order).first()
                    if at is not None:
                        break
                base += w
            cuts.append(None if at is None else tuple(at))
        return total, cuts
    finally:
        groups.unpersist()


def split_grouped_weighted(df: DataFrame, origin_cols="conv_id", seed: int | str = 42, ratios: Sequence[float] = SPLIT_RATIOS,
                           split_col: str = "split") -> DataFrame:
    """Row-local split of whole groups by their place along the seeded hash order (see :func:`group_cuts`).

    No origin lies in two splits, and each share differs from its ratio by at most half a group at either end.
    """
    origin = _names(origin_cols)
    _, cuts = group_cuts(df, origin, seed, ratios)
    order = [shuffle_key(seed, origin), *[F.col(c) for c in origin]]
    below = [F.lit(True) if c is None else lex_below(order, c) for c in cuts]
    label = (F.when(below[0], F.lit(SPLIT_NAMES[0])).when(below[1], F.lit(SPLIT_NAMES[1])).otherwise(F.lit(SPLIT_NAMES[2])))
    return df.withColumn(split_col, label)
