"""Longest run of consecutive same-role turns (gaps and islands).

``island = pos - rank within (conversation, role)`` is constant along a run.
Both ranks come from one block-wise :func:`turn_positions` pass (one
exchange of the rows), so a very long conversation is never handled by one
task; run lengths are partial aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadline.operators.positions import turn_positions

# Fixed value: the reference's limit on consecutive same-role turns.
MAX_SAME_ROLE_RUN = 8


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def role_runs(df: DataFrame, keys="conv_id", order: str = "turn", role_col: str = "role") -> DataFrame:
    """One row per run: ``(keys.., role, island, run_len)``."""
    keys = _names(keys)
    p = turn_positions(df.select(*keys, order, role_col), keys, order, pos_col="_tl_pos", size_col=None,
                       within=[role_col], within_pos_col="_tl_rpos")
    return (p.groupBy(*keys, role_col, (F.col("_tl_pos") - F.col("_tl_rpos")).alias("island"))
            .agg(F.count(F.lit(1)).alias("run_len")))


def max_role_run(df: DataFrame, keys="conv_id", order: str = "turn", role_col: str = "role") -> DataFrame:
    """Per conversation, the longest run of consecutive turns with the same role."""
    keys = _names(keys)
    return role_runs(df, keys, order, role_col).groupBy(*keys).agg(F.max("run_len").alias("max_run"))


def run_violations(df: DataFrame, limit: int = MAX_SAME_ROLE_RUN, **kw) -> DataFrame:
    """Conversations whose longest same-role run exceeds ``limit``."""
    return max_role_run(df, **kw).filter(F.col("max_run") > limit)


def record_max_run(turns, role_field: str = "role"):
    """Longest same-role run inside a bounded record, as a row-local fold over its turns."""
    init = F.struct(F.lit(None).cast("string").alias("p"), F.lit(0).alias("c"), F.lit(0).alias("b"))

    def step(acc, x):
        same = F.coalesce(x[role_field] == acc["p"], F.lit(False))
        c = F.when(same, acc["c"] + 1).otherwise(F.lit(1))
        return F.struct(x[role_field].alias("p"), c.alias("c"), F.greatest(acc["b"], c).alias("b"))

    return F.aggregate(turns, init, step)["b"]
