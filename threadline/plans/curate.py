"""Curation flow: role/blank filters -> overlapping windows -> quality gate -> dedup.

Plan (turn rows cross the network about twice):

1. positions - one shuffle of the turns keyed by (conversation, turn block);
2. position blocks - one shuffle of the turns keyed by (conversation, position
   block), each turn once plus a small halo (see :mod:`threadline.operators.chunk`);
3. a light view of every window (gate verdict and first-turn fingerprint) is
   sliced out of the block arrays; keep-first winners per fingerprint are a
   partial aggregate, regrouped per block (small rows);
4. the block arrays are joined with their winners on (conversation, block) -
   both sides already partitioned that way, so the text does not move again -
   and only the winning windows are sliced out.

No group is larger than one turn block or one position block, whatever the
conversation length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadline.functions import roles as R
from threadline.functions import text as T
from threadline.operators import chunk as C
from threadline.operators import filters as FL
from threadline.operators.positions import turn_positions


def clean_turns(turns: DataFrame, roles=(R.USER, R.ASSISTANT), key: str = "conv_id") -> DataFrame:
    """Keep conversation roles and non-blank turns of keyed conversations.

    A turn without a conversation key belongs to no conversation; requiring
    the key also makes it non-nullable downstream, so joins on it are plain
    equi-joins that keep the existing partitioning.
    """
    keyed = turns.filter(F.col(key).isNotNull())
    # the filter makes the key non-null; the coalesce states it in the schema
    keyed = keyed.withColumn(key, F.coalesce(F.col(key), F.lit(0).cast(turns.schema[key].dataType)))
    return FL.nonblank_turns(FL.filter_roles(keyed, roles))


def curate(turns: DataFrame, max_turns: int = C.DEFAULT_MAX_TURNS, stride: int | None = None,
           tail: int = C.DEFAULT_TAIL, fingerprint_chars: int = T.FINGERPRINT_CHARS,
           roles=(R.USER, R.ASSISTANT), block_turns: int | None = None, key: str = "conv_id",
           **gate) -> DataFrame:
    """Flat turns -> deduplicated, gated window records ``(key, start, turns)``.

    ``gate`` takes the parameters of :func:`threadline.operators.filters.quality_conditions`
    (``min_turns``, ``marked_role``, ``marker_a``, ``min_marked``, ``marker_b``, ``min_b``,
    ``first_role``); windows are ordered by ``(key, start)`` for keep-first dedup.
    """
    keys = [key]
    geo = dict(max_turns=max_turns, stride=stride, block_turns=block_turns)
    _, _, P, _ = C._geometry(max_turns, stride, block_turns)
    positioned = turn_positions(clean_turns(turns, roles, key), keys, "turn")
    blocks = C.position_blocks(positioned, keys=keys, order="turn", **geo)
    starts = C.block_window_starts(tail=tail, **geo)

    def light(st):
        w = C.window_slice(st, **geo)
        ok = F.lit(True)
        for _, cond in FL.quality_conditions(w, **gate):
            ok = ok & F.coalesce(cond, F.lit(False))
        fp = T.fingerprint(F.try_element_at(w, F.lit(1))["text"], fingerprint_chars)
        return F.struct(st.alias("start"), ok.alias("ok"), fp.alias("fp"))

    views = (blocks.select(*keys, F.explode(F.transform(starts, light)).alias("v"))
             .select(*keys, "v.*").filter("ok"))
    # min over a non-empty group: the struct and its fields are never null; the
    # coalesce says so, so no IsNotNull filter is inferred into the block branch
    key_type = turns.schema[key].dataType
    winners = (views.groupBy("fp").agg(F.min(F.struct(key, "start")).alias("w"))
               .select(F.coalesce(F.col(f"w.{key}"), F.lit(0).cast(key_type)).alias(key),
                       F.coalesce(F.col("w.start"), F.lit(0).cast("bigint")).alias("start")))
    per_block = (winners.withColumn(C.GROUP, F.expr(f"start div {P}"))
                 .groupBy(*keys, C.GROUP).agg(F.collect_list("start").alias("_tl_win")))
    kept = blocks.join(per_block, on=[*keys, C.GROUP], how="inner")
    win = F.explode(F.transform("_tl_win", lambda st: F.struct(
        st.alias("start"), C.window_slice(st, **geo).alias("turns")))).alias("w")
    return kept.select(*keys, win).select(*keys, "w.start", "w.turns")
