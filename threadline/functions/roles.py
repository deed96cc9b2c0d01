"""Role vocabularies and renames.

The neutral table uses ``user`` / ``assistant`` (plus e.g. ``system``); the
JSONL interchange format uses ``human`` / ``gpt``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Role names of the neutral table and of the JSONL format.
USER = "user"
ASSISTANT = "assistant"
HUMAN = "human"
GPT = "gpt"
# Labels used when rendering a conversation as text.
RENDER_LABELS = {USER: "User", ASSISTANT: "Assistant"}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def map_role_else(role, mapping: dict[str, str] | None = None, default: str = ASSISTANT) -> Column:
    """Rename with an else branch: listed roles are renamed, every other role
    becomes ``default`` (so ``system`` turns into the default role)."""
    mapping = {USER: USER} if mapping is None else mapping
    r = _c(role)
    expr = None
    for src, dst in mapping.items():
        expr = F.when(r == src, F.lit(dst)) if expr is None else expr.when(r == src, F.lit(dst))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def map_role_drop(role, mapping: dict[str, str] | None = None) -> Column:
    """Rename with a drop branch: roles not listed map to null (callers filter them)."""
    mapping = RENDER_LABELS if mapping is None else mapping
    r = _c(role)
    expr = None
    for src, dst in mapping.items():
        expr = F.when(r == src, F.lit(dst)) if expr is None else expr.when(r == src, F.lit(dst))
    return expr if expr is not None else F.lit(None).cast("string")


def to_interchange_role(role) -> Column:
    """Neutral role -> JSONL role (``user`` -> ``human``, ``assistant`` -> ``gpt``, others kept)."""
    r = _c(role)
    return F.when(r == USER, F.lit(HUMAN)).when(r == ASSISTANT, F.lit(GPT)).otherwise(r)


def from_interchange_role(role) -> Column:
    """JSONL role -> neutral role (``human`` -> ``user``, ``gpt`` -> ``assistant``, others kept)."""
    r = _c(role)
    return F.when(r == HUMAN, F.lit(USER)).when(r == GPT, F.lit(ASSISTANT)).otherwise(r)
