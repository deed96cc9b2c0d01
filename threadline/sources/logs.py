"""Session-log lines for observability metrics (block counts, tool-use gates).

A log line is ``{"type": .., "message": {"role": .., "content": ..}}`` where
``content`` is a *union*: a string or a list of tagged blocks
(``text`` / ``thinking`` / ``tool_use`` / ``tool_result``).  There is no
union type in a Spark schema, so ``content`` is first read as a string (the
JSON reader keeps an array's raw JSON text for a string field); a list is
then split into raw entries, and entries that are objects are parsed as
blocks (other entries are skipped, as the reference skips non-dicts).  Only ``user`` and
``assistant`` lines with a non-empty message are kept; malformed lines and
bad bytes are skipped as in the tolerant JSONL scan.

This reader feeds metrics only (``block_counts``, ``session_block_gate``);
it does not turn logs into training conversations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from threadline.functions import text as T
from threadline.sources import jsonl as J

LOG_LINE = Ty.StructType([
    Ty.StructField("type", Ty.StringType()),
    Ty.StructField("sessionId", Ty.StringType()),
    Ty.StructField("message", Ty.StructType([
        Ty.StructField("content", Ty.StringType()),
    ])),
])
BLOCK = Ty.StructType([
    Ty.StructField("type", Ty.StringType()),
    Ty.StructField("name", Ty.StringType()),
])
# Message kinds kept from a log.
MESSAGE_TYPES = ("user", "assistant")


def scan_session_logs(spark: SparkSession, root: str, include_subagents: bool = False,
                      glob: str | None = J.DEFAULT_GLOB) -> DataFrame:
    """Messages ``(session, src_block, src_seq, type, blocks)``.

    ``session`` is the line's ``sessionId`` when present, else the file path.
    A line counts when its type is listed and its ``message`` is a non-empty
    object.  ``blocks`` holds type and name of the content's blocks when it is a list
    (other entries are skipped); no text is kept.
    """
    lines = J.read_lines(spark, root, recursive=True, glob=glob,
                         exclude_fragment=None if include_subagents else J.SUBAGENT_FRAGMENT)
    body = T.trim_ws("line")
    parsed = lines.filter(T.is_nonblank("line")).select(
        "src_file", "src_block", "src_seq", F.from_json(body, LOG_LINE).alias("j"),
        F.from_json(body, "struct<message: map<string,string>>").alias("m"))
    content = F.col("j.message.content")
    is_list = F.coalesce(F.ltrim(content).startswith("["), F.lit(False))
    return (parsed
            .filter(F.col("j.type").isin(list(MESSAGE_TYPES)) & F.coalesce(F.size("m.message") > 0, F.lit(False)))
            .select(F.coalesce(F.col("j.sessionId"), F.col("src_file")).alias("session"), "src_block", "src_seq",
                    F.col("j.type").alias("type"), F.when(is_list, _blocks(content)).alias("blocks")))


def _blocks(content) -> F.Column:
    """Object entries of a content list, each parsed as a block; other entries are skipped."""
    elems = F.from_json(content, Ty.ArrayType(Ty.StringType()))
    objects = F.filter(elems, lambda e: F.coalesce(F.ltrim(e).startswith("{"), F.lit(False)))
    return F.transform(objects, lambda e: F.from_json(e, BLOCK))


def tool_use_counts(messages: DataFrame, names=None, key: str = "session") -> DataFrame:
    """Per session: number of ``tool_use`` blocks (optionally only listed names), per tool name."""
    b = F.explode("blocks").alias("b")
    used = messages.select(key, b).filter(F.col("b.type") == "tool_use")
    if names is not None:
        used = used.filter(F.col("b.name").isin(list(names)))
    return used.groupBy(key, F.col("b.name").alias("tool")).agg(F.count(F.lit(1)).alias("n_calls"))
