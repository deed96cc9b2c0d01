"""Dataset statistics and quality reports.

All are partial aggregates: per-record values are combined map-side, and the
final global aggregate merges one partial row per partition.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadline.functions import roles as R
from threadline.functions import text as T
from threadline.operators import filters as FL
from threadline.operators.positions import global_positions

# Fixed value: the marker the reference's statistics count.
STATS_MARKER = "<tool_use>"


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _finish_stats(per_record: DataFrame) -> DataFrame:
    tot = per_record.agg(
        F.count(F.lit(1)).alias("total_conversations"),
        F.coalesce(F.sum("n_turns"), F.lit(0)).cast("bigint").alias("total_turns"),
        F.coalesce(F.sum("n_tokens"), F.lit(0)).cast("bigint").alias("total_tokens"),
        F.count_if(F.col("has_marker")).alias("conversations_with_marker"),
    )
    convs = F.col("total_conversations")
    return tot.select(
        "total_conversations", "total_turns",
        F.when(convs > 0, F.col("total_turns") / convs).otherwise(F.lit(0.0)).alias("avg_turns_per_conv"),
        "total_tokens", "conversations_with_marker",
        F.when(convs > 0, F.col("conversations_with_marker") / convs * 100).otherwise(F.lit(0.0))
        .alias("marker_percentage"),
    )


def dataset_stats(df: DataFrame, record_keys="conv_id", marker: str = STATS_MARKER,
                  text_col: str = "text") -> DataFrame:
    """Flat turns: conversations, turns, average turns, whitespace tokens,
    conversations with a marker and their share (zero-safe)."""
    per = df.groupBy(*_names(record_keys)).agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.sum(T.token_count(text_col)).alias("n_tokens"),
        F.bool_or(T.contains(text_col, marker)).alias("has_marker"))
    return _finish_stats(per)


def record_stats(records: DataFrame, marker: str = STATS_MARKER, turns_col: str = "turns") -> DataFrame:
    """Same statistics over nested records (no shuffle before the final merge)."""
    t = F.col(turns_col)
    per = records.select(
        F.coalesce(F.size(t), F.lit(0)).alias("n_turns"),
        F.aggregate(t, F.lit(0).cast("bigint"), lambda acc, x: acc + T.token_count(x["text"])).alias("n_tokens"),
        F.coalesce(F.exists(t, lambda x: T.contains(x["text"], marker)), F.lit(False)).alias("has_marker"))
    return _finish_stats(per)


def split_sizes(df: DataFrame, split_col: str = "split", record_keys=None) -> DataFrame:
    """Records per split and their share of the total (percent)."""
    base = df if record_keys is None else df.select(split_col, *_names(record_keys)).distinct()
    per = base.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_records"))
    # ``per`` has one row per split (three), so the un-partitioned window is tiny
    total = F.sum("n_records").over(Window.partitionBy())
    return per.select(split_col, "n_records", (F.col("n_records") / total * 100).alias("share_pct"))


def distinct_names(df: DataFrame, pattern: str = T.NAME_FIELD_PATTERN, role: str | None = R.ASSISTANT,
                   text_col: str = "text", role_col: str = "role") -> DataFrame:
    """Distinct first-group regex matches over (optionally one role's) turns, one row each."""
    src = df if role is None else df.filter(F.col(role_col) == role)
    return (src.select(F.explode(T.extract_all(text_col, pattern, 1)).alias("name"))
            .distinct())


def sorted_names(df: DataFrame, pattern: str = T.NAME_FIELD_PATTERN, role: str | None = R.ASSISTANT,
                 text_col: str = "text", role_col: str = "role") -> DataFrame:
    """The distinct names in order, ``(pos, name)``: ranked by a range sort, not in one task."""
    names = distinct_names(df, pattern, role, text_col, role_col)
    return global_positions(names, "name", pos_col="pos").frame.select("pos", "name")


def name_overlap(names: DataFrame, expected: Iterable[str], name_col: str = "name") -> DataFrame:
    """Expected names that were observed (set intersection), one row each."""
    return names.filter(F.col(name_col).isin(list(expected))).select(name_col).distinct()


def gate_report(records: DataFrame, turns_col: str = "turns", **params) -> DataFrame:
    """Accept / reject counters: records per first failing check."""
    return (records.select(FL.gate_reason(F.col(turns_col), **params).alias("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("n_records")))


def nonblank_line_count(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Number of non-blank lines in a text scan (the resume counter)."""
    return lines.agg(F.count_if(T.is_nonblank(value_col)).alias("n_lines"))


def quality_report(records: DataFrame, core_names, marker_a: str, marker_b: str,
                   name_pattern: str = T.NAME_FIELD_PATTERN, min_turns: int = 3,
                   first_role: str = R.USER, marked_role: str = R.ASSISTANT,
                   turns_col: str = "turns") -> DataFrame:
    """The reference's dataset-quality assertions over records, as one row of counts.

    Violations are counted (0 means the assertion holds): too few turns, not
    opening with ``first_role``, no ``marked_role`` turn with ``marker_a``, no
    turn with ``marker_b``, blank turns; plus the longest same-role run and
    how many of ``core_names`` occur in ``marked_role`` turns.  One pass: each
    record's names are extracted once and every check is an aggregate of the
    same global aggregation.
    """
    from threadline.operators.runs import record_max_run

    core_names = list(core_names)
    t = F.col(turns_col)
    names = F.flatten(F.transform(F.filter(t, lambda x: x["role"] == marked_role),
                                  lambda x: F.coalesce(T.extract_all(x["text"], name_pattern, 1),
                                                       F.array().cast("array<string>"))))
    per = records.select(
        (F.size(t) < min_turns).alias("short"),
        (~F.coalesce(F.try_element_at(t, F.lit(1))["role"] == first_role, F.lit(False))).alias("bad_first"),
        (~F.coalesce(F.exists(t, lambda x: (x["role"] == marked_role) & T.contains(x["text"], marker_a)),
                     F.lit(False))).alias("no_marker"),
        (~F.coalesce(F.exists(t, lambda x: T.contains(x["text"], marker_b)), F.lit(False))).alias("no_response"),
        F.size(F.filter(t, lambda x: ~T.is_nonblank(x["text"]))).alias("n_blank"),
        record_max_run(t).alias("max_run"),
        *[F.coalesce(F.array_contains(names, c), F.lit(False)).alias(f"_tl_has{i}") for i, c in enumerate(core_names)])
    core_hits = [F.coalesce(F.bool_or(f"_tl_has{i}"), F.lit(False)).cast("bigint") for i in range(len(core_names))]
    n_core = sum(core_hits[1:], core_hits[0]) if core_hits else F.lit(0).cast("bigint")
    return per.agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count_if("short").alias("n_too_short"),
        F.count_if("bad_first").alias("n_wrong_first_role"),
        F.count_if("no_marker").alias("n_without_marker"),
        F.count_if("no_response").alias("n_without_response"),
        F.coalesce(F.sum("n_blank"), F.lit(0)).cast("bigint").alias("n_blank_turns"),
        F.coalesce(F.max("max_run"), F.lit(0)).cast("bigint").alias("max_same_role_run"),
        n_core.alias("n_core_names"))
