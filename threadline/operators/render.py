"""Render records as text: ``User: ..`` / ``Assistant: ..`` joined by blank lines.

Only the two conversation roles are rendered; other roles are dropped.
Records are bounded (windows or segments), so each rendered string is too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadline.functions import roles as R
from threadline.functions import text as T

# Fixed value: separator between rendered turns.
TURN_SEPARATOR = "\n\n"


def render_turns(turns: Column, labels: dict[str, str] | None = None, sep: str = TURN_SEPARATOR) -> Column:
    """``sep.join(f"{label}: {text}")`` over turns whose role has a label."""
    labels = R.RENDER_LABELS if labels is None else labels
    pieces = F.transform(turns, lambda t: F.concat(R.map_role_drop(t["role"], labels), F.lit(": "),
                                                   F.coalesce(t["text"], F.lit(""))))
    return T.join_nonempty(pieces, sep)


def render_text(records: DataFrame, turns_col: str = "turns", out_col: str = "text",
                labels: dict[str, str] | None = None) -> DataFrame:
    return records.withColumn(out_col, render_turns(F.col(turns_col), labels))
