"""Overlapping windows over conversations.

Window starts are ``0, s, 2s, ..`` while ``start < max(1, n - tail)``; each
window holds turns ``[start, start + L)``.  Tails shorter than ``tail + 1``
turns start no window, a conversation of fewer than ``tail + 1`` turns gives
exactly one window, and a late window may lie inside its predecessor.

Plan: after positions (:func:`threadline.operators.positions.turn_positions`)
the turns of a conversation are grouped into *position blocks* of ``P``
consecutive positions (16 strides, fewer for long strides so ``P`` stays near
4096; always a multiple of the stride), each extended by a
halo of the next ``L - s`` turns.  A block's sorted turn array holds every
window that starts inside the block, so windows are sliced out of it
row-locally.  The shuffle carries each turn about ``1 + (L - s) / P`` times,
instead of the ``L / s`` copies that exploding turns into windows would
shuffle; no group exceeds ``P + L - s`` turns, whatever the conversation
length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadline.operators.positions import turn_positions

# The reference's window length and tail margin.
DEFAULT_MAX_TURNS = 40
DEFAULT_TAIL = 4
# Position-block length P: BLOCK_STRIDES strides, fewer for long strides so a
# block stays near BLOCK_TARGET positions (at least one stride).
BLOCK_STRIDES = 16
BLOCK_TARGET = 4096

GROUP = "_tl_g"
ARR = "_tl_arr"


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _geometry(max_turns: int, stride: int | None, block_turns: int | None) -> tuple[int, int, int, int]:
    L = int(max_turns)
    s = int(stride if stride is not None else L // 2)
    if L < 1 or s < 1:
        raise ValueError(f"window length and stride must be >= 1 (got L={L}, stride={s})")
    if block_turns:
        P = s * max(1, -(-int(block_turns) // s))
    else:
        P = s * max(1, min(BLOCK_STRIDES, BLOCK_TARGET // s))
    halo = max(0, L - s)
    return L, s, P, halo


def window_starts(pos: str = "pos", n: str = "n", max_turns: int = DEFAULT_MAX_TURNS,
                  stride: int | None = None, tail: int = DEFAULT_TAIL):
    """Array of the window starts that cover a turn at position ``pos``."""
    L, s, _, _ = _geometry(max_turns, stride, None)
    k_lo = f"CASE WHEN `{pos}` - {L} + 1 <= 0 THEN 0 ELSE (`{pos}` - {L} + 1 + {s - 1}) div {s} END"
    k_hi = f"least(`{pos}` div {s}, (greatest(1, `{n}` - {int(tail)}) - 1) div {s})"
    # a non-descending sequence, emptied by the filter when k_lo > k_hi: the
    # element type stays non-nullable, so ``start`` is a non-null key downstream
    return F.expr(f"transform(filter(sequence(({k_lo}), greatest(({k_lo}), ({k_hi}))), k -> k <= ({k_hi})), "
                  f"k -> k * {s})")


def position_blocks(df: DataFrame, max_turns: int = DEFAULT_MAX_TURNS, stride: int | None = None,
                    keys="conv_id", order: str = "turn", block_turns: int | None = None) -> DataFrame:
    """Positioned turns -> ``(keys.., _tl_g, n, _tl_arr)``: block ``g`` holds positions
    ``[g*P, (g+1)*P + L - s)`` sorted, i.e. every window starting in ``[g*P, (g+1)*P)``."""
    keys = _names(keys)
    _, _, P, halo = _geometry(max_turns, stride, block_turns)
    pos = F.col("pos").cast("bigint")
    # ``div`` is nullable in Spark's type system; pos is not, so coalesce only restates that
    g = F.coalesce(F.expr(f"CAST(pos AS BIGINT) div {P}"), F.lit(0).cast("bigint"))
    in_halo = (pos % P < halo) & (g > 0)
    targets = F.when(in_halo, F.array(g, g - 1)).otherwise(F.array(g))
    # ``n`` rides inside each turn, so every consumer of the blocks runs the same
    # aggregate (one collect_list) and the block shuffle can be shared
    t = F.struct(pos.alias("pos"), F.col(order).alias("turn"), "role", "text", F.col("n").cast("bigint").alias("n"))
    return (df.select(*keys, F.explode(targets).alias(GROUP), t.alias("t"))
            .groupBy(*keys, GROUP)
            .agg(F.array_sort(F.collect_list("t")).alias(ARR))
            .withColumn("n", F.element_at(F.col(ARR), 1)["n"]))


def block_window_starts(max_turns: int = DEFAULT_MAX_TURNS, stride: int | None = None,
                        tail: int = DEFAULT_TAIL, block_turns: int | None = None) -> Column:
    """Window starts inside each position block (requires ``_tl_g`` and ``n``)."""
    _, s, P, _ = _geometry(max_turns, stride, block_turns)
    base = F.col(GROUP) * P
    limit = F.greatest(F.lit(1).cast("bigint"), F.col("n") - int(tail))
    starts = F.sequence(base, base + (P - s), F.lit(s).cast("bigint"))
    return F.filter(starts, lambda st: st < limit)


def window_slice(start: Column, max_turns: int = DEFAULT_MAX_TURNS, stride: int | None = None,
                 block_turns: int | None = None) -> Column:
    """Turns ``[start, start + L)`` of a block's array (positions are dense inside it)."""
    L, _, P, _ = _geometry(max_turns, stride, block_turns)
    part = F.slice(F.col(ARR), (start - F.col(GROUP) * P + 1).cast("int"), L)
    return F.transform(part, lambda t: t.dropFields("n"))


def chunk_overlap(df: DataFrame, max_turns: int = DEFAULT_MAX_TURNS, stride: int | None = None,
                  tail: int = DEFAULT_TAIL, keys="conv_id", order: str = "turn",
                  positioned: bool = False, block_turns: int | None = None) -> DataFrame:
    """Flat turns -> window records ``(keys.., start, turns)``.

    ``turns`` is ``ARRAY<STRUCT<pos, turn, role, text>>`` sorted by position;
    ``pos`` is the position in the whole conversation.  Pass
    ``positioned=True`` when ``df`` already has ``pos`` and ``n``.
    """
    keys = _names(keys)
    if not positioned:
        df = turn_positions(df, keys, order)
    blocks = position_blocks(df, max_turns, stride, keys, order, block_turns)
    starts = block_window_starts(max_turns, stride, tail, block_turns)
    win = F.explode(F.transform(starts, lambda st: F.struct(
        st.alias("start"), window_slice(st, max_turns, stride, block_turns).alias("turns")))).alias("w")
    return blocks.select(*keys, win).select(*keys, "w.start", "w.turns")
