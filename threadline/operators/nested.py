"""Nested records and their flat views.

A *record* is ``(conv_id, start, turns ARRAY<STRUCT<pos, turn, role, text>>)``
with a bounded array: records are built by :func:`assemble` (consecutive
segments of at most ``max_turns`` turns) or by window chunking, never by
collecting an unbounded conversation into one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadline.functions import roles as R
from threadline.operators.positions import turn_positions

# Segment length used when assembling whole conversations.
DEFAULT_SEGMENT_TURNS = 1024


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def assemble(df: DataFrame, max_turns: int = DEFAULT_SEGMENT_TURNS, keys="conv_id",
             order: str = "turn", positioned: bool = False) -> DataFrame:
    """Flat turns -> ordered nested records, one per segment of ``max_turns`` turns.

    A conversation of up to ``max_turns`` turns becomes one record
    (``start = 0``); longer ones become consecutive segments, so no row and
    no group is unbounded.  Turn order is ``order`` (file order in the
    reference); ``pos`` is the position in the whole conversation.
    """
    keys = _names(keys)
    if not positioned:
        df = turn_positions(df, keys, order)
    seg = int(max_turns)
    t = F.struct(F.col("pos").cast("bigint").alias("pos"), F.col(order).alias("turn"), "role", "text")
    return (df.select(*keys, (F.floor(F.col("pos") / seg) * seg).cast("bigint").alias("start"), t.alias("t"))
            .groupBy(*keys, "start")
            .agg(F.array_sort(F.collect_list("t")).alias("turns")))


def explode_turns(records: DataFrame, keys=("conv_id", "start"), turns_col: str = "turns") -> DataFrame:
    """Records -> one row per turn with ``idx`` (0-based index inside the record)."""
    keys = _names(keys)
    return (records.select(*keys, F.posexplode(turns_col).alias("idx", "t"))
            .select(*keys, F.col("idx").cast("bigint").alias("idx"), "t.*"))


def to_messages(records: DataFrame, turns_col: str = "turns", out_col: str = "messages",
                user_role: str = R.USER, default_role: str = R.ASSISTANT) -> DataFrame:
    """Re-shape turns to ``ARRAY<STRUCT<role, content>>``: the user role stays,
    every other role becomes ``default_role``."""
    return records.withColumn(out_col, F.transform(
        F.col(turns_col),
        lambda t: F.struct(R.map_role_else(t["role"], {user_role: R.USER}, default_role).alias("role"),
                           t["text"].alias("content"))))


def to_interchange(records: DataFrame, turns_col: str = "turns", out_col: str = "conversations") -> DataFrame:
    """Re-shape turns to the JSONL interchange form ``ARRAY<STRUCT<from, value>>``."""
    return records.withColumn(out_col, F.transform(
        F.col(turns_col),
        lambda t: F.struct(R.to_interchange_role(t["role"]).alias("from"), t["text"].alias("value"))))


def block_counts(blocks: DataFrame, blocks_col: str = "blocks", type_col: str = "type",
                 group_cols=()) -> DataFrame:
    """Counts of content blocks per tag (metrics only); non-struct / null blocks are skipped."""
    group_cols = _names(group_cols) if group_cols else []
    return (blocks.select(*group_cols, F.explode(blocks_col).alias("b"))
            .filter(F.col("b").isNotNull())
            .groupBy(*group_cols, F.col(f"b.{type_col}").alias("block_type"))
            .agg(F.count(F.lit(1)).alias("n_blocks")))
