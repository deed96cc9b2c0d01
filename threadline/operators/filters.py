"""Row, record and conversation filters.

Flat input is the turn table ``(conv_id, turn, role, text)``; records are
bounded nested rows ``(conv_id, start, turns ARRAY<STRUCT<pos, turn, role, text>>)``
(see :mod:`threadline.operators.nested`).  Record gates are row-local
higher-order expressions; conversation gates on the flat table are partial
aggregates keyed by conversation, so a hot conversation is combined map-side.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadline.functions import roles as R
from threadline.functions import text as T

# The reference's quality-gate markers and thresholds.
CALL_MARKER = "<tool_call>"
RESPONSE_MARKER = "<tool_response>"
MIN_QUALITY_TURNS = 3
MIN_MARKED_TURNS = 2


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


# -- row filters ------------------------------------------------------------

def filter_roles(df: DataFrame, roles: Iterable[str] = (R.USER, R.ASSISTANT), role_col: str = "role") -> DataFrame:
    """Keep rows whose role is listed (drops e.g. ``system``)."""
    return df.filter(F.col(role_col).isin(list(roles)))


def drop_empty(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Drop rows with a null or empty payload."""
    return df.filter(T.is_nonempty(text_col))


def nonblank_turns(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Drop turns that are blank after stripping Unicode whitespace."""
    return df.filter(T.is_nonblank(text_col))


def first_n(df: DataFrame, n: int, order_cols) -> DataFrame:
    """The first ``n`` rows under ``order_cols`` (top-k per partition, then merged)."""
    return df.orderBy(*_names(order_cols)).limit(n)


# -- record (nested) gates ---------------------------------------------------

def record_drop_empty(records: DataFrame, turns_col: str = "turns") -> DataFrame:
    return records.filter(F.coalesce(F.size(turns_col) > 0, F.lit(False)))


def record_valid_structure(records: DataFrame, min_turns: int = 2, turns_col: str = "turns") -> DataFrame:
    """Keep records that are arrays with at least ``min_turns`` turns."""
    return records.filter(F.coalesce(F.size(turns_col) >= min_turns, F.lit(False)))


def quality_conditions(turns: Column, min_turns: int = MIN_QUALITY_TURNS,
                       marked_role: str | None = R.ASSISTANT, marker_a: str | None = CALL_MARKER,
                       min_marked: int = MIN_MARKED_TURNS, marker_b: str | None = RESPONSE_MARKER,
                       min_b: int = 1, first_role: str | None = R.USER) -> list[tuple[str, Column]]:
    """The gate's checks, in the reference's evaluation order, as (reason, passes) pairs."""
    checks = [("too_short", F.size(turns) >= min_turns)]
    if marker_a is not None:
        marked = F.filter(turns, lambda t: (t["role"] == marked_role if marked_role else F.lit(True))
                          & T.contains(t["text"], marker_a))
        checks.append(("few_marked", F.size(marked) >= min_marked))
    if marker_b is not None:
        checks.append(("no_response", F.size(F.filter(turns, lambda t: T.contains(t["text"], marker_b))) >= min_b))
    if first_role is not None:
        checks.append(("wrong_first_role", F.coalesce(F.try_element_at(turns, F.lit(1))["role"] == first_role, F.lit(False))))
    return checks


def quality_gate(records: DataFrame, turns_col: str = "turns", **params) -> DataFrame:
    """Conversation quality gate on bounded records (all checks must pass)."""
    cond = F.lit(True)
    for _, ok in quality_conditions(F.col(turns_col), **params):
        cond = cond & F.coalesce(ok, F.lit(False))
    return records.filter(cond)


def gate_reason(turns: Column, **params) -> Column:
    """First failing check (reference's early-return order) or ``accepted``."""
    expr = None
    for reason, ok in quality_conditions(turns, **params):
        bad = ~F.coalesce(ok, F.lit(False))
        expr = F.when(bad, F.lit(reason)) if expr is None else expr.when(bad, F.lit(reason))
    return expr.otherwise(F.lit("accepted"))


# -- conversation gates on the flat table -----------------------------------

def conversation_quality(df: DataFrame, keys="conv_id", order: str = "turn", min_turns: int = MIN_QUALITY_TURNS,
                         marked_role: str | None = R.ASSISTANT, marker_a: str | None = CALL_MARKER,
                         min_marked: int = MIN_MARKED_TURNS, marker_b: str | None = RESPONSE_MARKER,
                         min_b: int = 1, first_role: str | None = R.USER) -> DataFrame:
    """Per conversation: turn count, marker counts, first role and the gate verdict.

    Partial aggregation keyed by conversation: a hot conversation is combined
    map-side before the shuffle.
    """
    keys = _names(keys)
    text, role = F.col("text"), F.col("role")
    aggs = [F.count(F.lit(1)).alias("n_turns"),
            F.min_by(role, F.col(order)).alias("first_role")]
    if marker_a is not None:
        cond = T.contains(text, marker_a) & ((role == marked_role) if marked_role else F.lit(True))
        aggs.append(F.count_if(cond).alias("n_marked"))
    if marker_b is not None:
        aggs.append(F.count_if(T.contains(text, marker_b)).alias("n_response"))
    per = df.groupBy(*keys).agg(*aggs)
    ok = F.col("n_turns") >= min_turns
    if marker_a is not None:
        ok = ok & (F.col("n_marked") >= min_marked)
    if marker_b is not None:
        ok = ok & (F.col("n_response") >= min_b)
    if first_role is not None:
        ok = ok & F.coalesce(F.col("first_role") == first_role, F.lit(False))
    return per.withColumn("passes", ok)


def valid_structure(df: DataFrame, keys="conv_id", min_turns: int = 2) -> DataFrame:
    """Conversations (one row each, with ``n_turns``) having at least ``min_turns`` turns."""
    keys = _names(keys)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_turns"))
            .filter(F.col("n_turns") >= min_turns))


def role_set_check(df: DataFrame, keys="conv_id", allowed: Sequence[str] = (R.USER, R.ASSISTANT),
                   required: Sequence[str] = (R.USER, R.ASSISTANT), role_col: str = "role") -> DataFrame:
    """Per conversation: roles are a subset of ``allowed`` and every ``required`` role occurs."""
    keys = _names(keys)
    role = F.col(role_col)
    aggs = [F.count_if(~F.coalesce(role.isin(list(allowed)), F.lit(False))).alias("n_other_roles")]
    aggs += [F.bool_or(F.coalesce(role == r, F.lit(False))).alias(f"has_{r}") for r in required]
    per = df.groupBy(*keys).agg(*aggs)
    ok = F.col("n_other_roles") == 0
    for r in required:
        ok = ok & F.col(f"has_{r}")
    return per.withColumn("roles_ok", ok)


def min_event_gate(events: DataFrame, event_types: Iterable[str], min_events: int,
                   key: str = "user_id", type_col: str = "event_type") -> DataFrame:
    """Keys with at least ``min_events`` events of the given types (counts blocks, not turns)."""
    return (events.groupBy(key)
            .agg(F.count_if(F.col(type_col).isin(list(event_types))).alias("n_matching"))
            .filter(F.col("n_matching") >= min_events))


# Tool names counted by the session gate's default.
AGENT_TOOL_NAMES = ("Bash", "Read", "Write", "Edit", "Glob", "Grep", "Agent", "WebFetch", "WebSearch",
                    "TodoWrite", "mcp__context7__query-docs", "mcp__lossless-recall__recall_grep")


def session_block_gate(messages: DataFrame, min_blocks: int, names: Iterable[str] = AGENT_TOOL_NAMES,
                       key: str = "session", blocks_col: str = "blocks", block_type: str = "tool_use") -> DataFrame:
    """Sessions with at least ``min_blocks`` content blocks of one type whose name is listed.

    One row per message with a (bounded) ``blocks`` array; counts *blocks*,
    not messages.  Per-message counts are summed by a partial aggregate, so a
    hot session is combined map-side.
    """
    names = list(names)
    per_msg = F.size(F.filter(F.col(blocks_col), lambda b: (b["type"] == block_type) & b["name"].isin(names)))
    return (messages.groupBy(key)
            .agg(F.sum(F.coalesce(per_msg, F.lit(0))).cast("bigint").alias("n_blocks"))
            .filter(F.col("n_blocks") >= min_blocks))
