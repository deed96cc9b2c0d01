"""Seeded shuffles and exact samples without moving rows.

A record's place in a shuffle is ``(md5('<seed>:<key>'), key)``.  An exact
sample of ``k`` records is "the ``k`` smallest under that order", which is a
row-local predicate once the order key of the ``k``-th record is known.  That
bound comes from :func:`threadline.operators.select.seeded_proxy_stats` (exact
distributed selection over the record-key table, no sort), so the turn rows
are never joined or collected: every turn tests its own record's key against
one literal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadline.functions.hashing import seeded_hex
from threadline.operators.select import seeded_proxy_stats

ORDER_COL = "_tl_order"


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def shuffle_key(seed: int | str, keys) -> Column:
    """The seeded sort key of a record."""
    return seeded_hex(seed, *_names(keys))


def sample_size(n: int, ratio: float) -> int:
    """``min(int(n * ratio), n)``."""
    return min(int(n * ratio), n)


def lex_below(exprs: Sequence[Column], bound: Sequence) -> Column:
    """Lexicographic ``(e1, e2, ..) < bound`` in Spark's order: nulls first, NaN last.

    Never null: a row without a key is below every bound that has one.
    """
    cond = F.lit(False)
    for i in reversed(range(len(exprs))):
        c, v = exprs[i], bound[i]
        if v is None:  # nothing is below a null
            below, same = F.lit(False), c.isNull()
        else:
            below, same = c.isNull() | F.coalesce(c < F.lit(v), F.lit(False)), c.eqNullSafe(F.lit(v))
        cond = below | (same & cond)
    return cond


class ExactSample:
    """The ``k`` first records of a seeded shuffle, as a row-local predicate."""

    def __init__(self, keys: list[str], seed, total: int, k: int, bound: tuple | None):
        self.keys, self.seed, self.total, self.k, self.bound = keys, seed, total, k, bound

    def predicate(self) -> Column:
        """True for rows of selected records (any frame carrying the key columns)."""
        if self.k <= 0:
            return F.lit(False)
        if self.bound is None:  # k >= total: every record
            return F.lit(True)
        exprs = [shuffle_key(self.seed, self.keys), *[F.col(k) for k in self.keys]]
        return lex_below(exprs, self.bound)


def exact_sample(records: DataFrame, keys, seed: int | str = 42, ratio: float | None = None,
                 k: int | None = None) -> ExactSample:
    """Choose exactly ``k`` (or ``min(int(n * ratio), n)``) records without replacement.

    ``records`` holds the record keys (duplicates are removed); only the
    order key of the ``k``-th record reaches the driver.
    """
    keys = _names(keys)
    recs = records.select(*keys).distinct()
    chosen = {}

    def want(total: int) -> list[int]:
        chosen["k"] = sample_size(total, ratio if ratio is not None else 1.0) if k is None else min(int(k), total)
        return [chosen["k"]]

    total, at = seeded_proxy_stats(recs, seed, keys, want)
    return ExactSample(keys, seed, total, chosen["k"], at.get(chosen["k"]))


def first_of_shuffle(records: DataFrame, keys, target: int, seed: int | str = 42) -> ExactSample:
    """Cap by a target count: the first ``min(target // 2, n)`` records of a seeded shuffle."""
    return exact_sample(records, keys, seed, k=target // 2)
