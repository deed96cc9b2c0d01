"""Dataset sinks.

Every sink that writes rows takes an allow-list of sources (``source``, ``rights``):
records carry their ``source``, and a left-semi join leaves only data with known
rights.  Rows carry ``origin_conv_id``, the conversation they derive from.

* :func:`write_records` - interchange JSONL (one record per line), optionally
  one folder per split (``split=train/``...); a record that is a segment of a long
  conversation carries its ``start`` (and ``variant``), so readers can put it back.
  Spark writes UTF-8 as is; the parsed values equal those of an ASCII-escaped writer.
* :func:`write_gated` - the same for records that pass the quality gate, with its counters taken during the write.
* :func:`write_text_records` - rendered ``{"text": ..}`` JSONL per split.
* :func:`write_whole_texts` - the same with one line per whole conversation of any length.
* :func:`write_text_document` - one JSON document
  ``{"train": [{"text": ..}, ..], "valid": [..], "test": [..]}`` written as
  ordered part files by many tasks: each record line carries the separators
  it needs, so concatenating ``part-*`` in name order yields the document.
  Nothing passes through the driver or a single task.
* :func:`write_metadata` - a one-row summary (counts, ratios, statistics, formats).
* :func:`export` - format selector over the above: all formats cut by the same
  ``split`` column; with several formats the records are staged once as a
  Parquet table so the upstream plan runs once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from threadline.functions import roles as R
from threadline.operators import filters as FL
from threadline.operators import nested as N
from threadline.operators import render as RD
from threadline.operators.positions import range_partitions
from threadline.operators.sample import shuffle_key
from threadline.operators.split import SPLIT_NAMES, SPLIT_RATIOS, prefix_split

# Format names accepted by :func:`export`.
FORMATS = ("records", "text", "document")


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


ORIGIN_COL = "origin_conv_id"
RECORD_COLS = ("conv_id", "start", "variant", "source", ORIGIN_COL)


def allowed_only(df: DataFrame, allowed_sources: DataFrame, source_col: str = "source") -> DataFrame:
    """Keep rows whose source is on the allow-list (``source``, ``rights``); the list is required."""
    if allowed_sources is None:
        raise ValueError("allowed_sources is required: a table of the sources that may leave (source, rights)")
    if source_col not in df.columns:
        raise ValueError(f"records need a {source_col!r} column to be checked against allowed_sources")
    allow = allowed_sources.select(F.col("source").alias(source_col)).distinct()
    return df.join(allow, on=source_col, how="left_semi")


def _with_origin(records: DataFrame, id_col: str = "conv_id") -> DataFrame:
    if ORIGIN_COL in records.columns or id_col not in records.columns:
        return records
    return records.withColumn(ORIGIN_COL, F.col(id_col))


def write_records(records: DataFrame, path: str, allowed_sources: DataFrame, split_col: str | None = "split",
                  extra_cols=RECORD_COLS, source_col: str = "source",
                  mode: str = "overwrite") -> None:
    """Interchange JSONL; one folder per split when ``split_col`` is present."""
    _write_records(allowed_only(records, allowed_sources, source_col), path, split_col, extra_cols, mode)


def _write_records(records: DataFrame, path: str, split_col: str | None, extra_cols=RECORD_COLS, mode: str = "overwrite") -> None:
    records = _with_origin(records)
    by_split = bool(split_col) and split_col in records.columns
    cols = [c for c in _names(extra_cols) if c in records.columns]
    lines = N.to_interchange(records).select(*cols, "conversations", *([split_col] if by_split else []))
    writer = lines.write.mode(mode)
    if by_split:
        writer = writer.partitionBy(split_col)
    writer.option("ignoreNullFields", "false").json(path)


def write_gated(records: DataFrame, path: str, allowed_sources: DataFrame, split_col: str | None = "split",
                turns_col: str = "turns", source_col: str = "source", **gate) -> dict[str, int]:
    """Interchange JSONL of the records that pass the quality gate; returns records per gate outcome.

    The counters (``accepted`` and each first failing check, of the allowed records) are observed on the plan that
    writes, so the records are scanned once.  They are taken in the stage that writes, where a lost and repeated task
    counts once.
    """
    records = allowed_only(records, allowed_sources, source_col)
    outcomes = [name for name, _ in FL.quality_conditions(F.col(turns_col), **gate)] + ["accepted"]
    seen = Observation()
    judged = (records.withColumn("_outcome", FL.gate_reason(F.col(turns_col), **gate))
              .observe(seen, *[F.count_if(F.col("_outcome") == o).alias(o) for o in outcomes]))
    _write_records(judged.filter(F.col("_outcome") == "accepted").drop("_outcome"), path, split_col)
    return {o: int(seen.get[o]) for o in outcomes}


def write_text_records(records: DataFrame, path: str, allowed_sources: DataFrame, split_col: str | None = "split",
                       source_col: str = "source", mode: str = "overwrite") -> None:
    """Rendered ``{"text": ..}`` JSONL, one folder per split when present."""
    records = _with_origin(allowed_only(records, allowed_sources, source_col))
    out = RD.render_text(records, out_col="text")
    by_split = bool(split_col) and split_col in records.columns
    cols = [c for c in ("text", ORIGIN_COL) if c in out.columns] + ([split_col] if by_split else [])
    writer = out.select(*cols).write.mode(mode)
    if by_split:
        writer = writer.partitionBy(split_col)
    writer.json(path)


def write_whole_texts(records: DataFrame, path: str, allowed_sources: DataFrame, keys="conv_id", split_col: str | None = "split",
                      source_col: str = "source", mode: str = "overwrite") -> None:
    """``{"text": ..}`` lines with one whole conversation each, however long, from records in segments (``start``).

    A line is written turn by turn: turns of a conversation are range-partitioned and sorted side by
    side, and no row holds more than a turn.  The text sink ends rows with a space instead of a line
    end; a row stops where the text has one, behind the label of the next turn, and the last row of a conversation brings
    the line end, so that lines after a file's first begin with a space that JSON readers skip.
    """
    keys = _names(keys)
    records = allowed_only(records, allowed_sources, source_col)
    by = [split_col] if split_col and split_col in records.columns else []
    start = F.col("start") if "start" in records.columns else F.lit(0).cast("bigint")
    turn = F.explode_outer(F.filter("turns", lambda t: t["role"].isin(*R.RENDER_LABELS)))
    flat = records.select(*by, *keys, start.alias("_tl_start"), turn.alias("_tl_t")).select(
        *by, *keys, "_tl_start", F.col("_tl_t.pos").alias("_tl_pos"), F.coalesce("_tl_t.text", F.lit("")).alias("_tl_text"),
        R.map_role_drop(F.col("_tl_t.role")).alias("_tl_label"))
    group = [*by, *keys]
    order = ["_tl_start", "_tl_pos"]
    # segments without a rendered turn add nothing, but a conversation of such segments alone is an empty text
    window = Window.partitionBy(*group)
    flat = (flat.repartitionByRange(range_partitions(flat), *group)
            .withColumn("_tl_some", F.max(F.col("_tl_label").isNotNull()).over(window))
            .withColumn("_tl_k", F.row_number().over(window.orderBy(F.col("_tl_label").isNull(), *order)))
            .filter(F.col("_tl_label").isNotNull() | (~F.col("_tl_some") & (F.col("_tl_k") == 1))))
    ahead = F.lead("_tl_label").over(window.orderBy("_tl_k"))
    body = _json_string(F.col("_tl_text"))
    body = F.substring(body, F.lit(2), F.length(body) - 2)
    first = F.when(F.col("_tl_k") == 1, F.concat(F.lit('{"text": "'), F.when(F.col("_tl_some"), F.concat("_tl_label", F.lit(": "))).otherwise("")))
    last = F.when(ahead.isNotNull(), F.concat(F.lit("\\n\\n"), ahead, F.lit(":"))).otherwise(F.lit('"}\n'))
    lines = flat.select(*by, F.concat(F.coalesce(first, F.lit("")), body, last).alias("value"))
    writer = lines.write.mode(mode).option("lineSep", " ")
    (writer.partitionBy(*by) if by else writer).text(path)


def _json_string(c) -> F.Column:
    """A JSON string literal for ``c`` (``to_json(array(c))`` without the brackets)."""
    arr = F.to_json(F.array(c))
    return F.substring(arr, F.lit(2), F.length(arr) - 2)


def write_text_document(records: DataFrame, path: str, allowed_sources: DataFrame, keys=("conv_id", "start"),
                        seed: int | str | None = 42, ratios: Sequence[float] = SPLIT_RATIOS, rule: str = "cumulative",
                        split_col: str = "split", source_col: str = "source") -> dict:
    """One ``{"train": [...], "valid": [...], "test": [...]}`` document in ordered parts.

    Sections follow the records' ``split_col``, so the document is cut like every
    other format; records without one get the split by position under the same order.
    Inside a section records are ordered by a seeded shuffle of ``keys`` (by key when
    ``seed`` is None).  The first key of each section and the last key overall come from one
    aggregate over the keys; the text moves once, in the range shuffle that orders
    the parts.  Keys must name one record each: a first or last key that several records share
    (null keys, say) is refused, as the document would not be JSON.  Returns the split sizes.
    """
    keys = _names(keys)
    records = allowed_only(records, allowed_sources, source_col)
    if split_col not in records.columns:
        records = records.withColumn(split_col, prefix_split(records, keys, seed, ratios, rule).label())
    sec = F.lit(len(SPLIT_NAMES) - 1)
    for i, name in reversed(list(enumerate(SPLIT_NAMES[:-1]))):
        sec = F.when(F.col(split_col) == name, F.lit(i)).otherwise(sec)
    shuffled = [] if seed is None else ["_tl_order"]
    ordered = RD.render_text(records, out_col="_tl_text").select(
        *keys, sec.alias("_tl_sec"), "_tl_text", *([shuffle_key(seed, keys).alias("_tl_order")] if shuffled else []))
    order_cols = ["_tl_sec", *shuffled, *keys]
    key = F.struct(*order_cols)
    found = {r["_tl_sec"]: r for r in ordered.groupBy("_tl_sec").agg(
        F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high")).collect()}  # three rows at most
    sizes = {name: found[i]["n"] if i in found else 0 for i, name in enumerate(SPLIT_NAMES)}
    tokens = ['{"' + SPLIT_NAMES[0] + '": [', *['], "' + name + '": [' for name in SPLIT_NAMES[1:]]]
    spark: SparkSession = records.sparkSession
    edges = {tuple(r[e]) for r in found.values() for e in ("low", "high")}
    if found:
        def is_row(values) -> F.Column:
            return reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(order_cols, values)))

        at_edges = F.when(is_row(next(iter(edges))), 0)
        for i, values in enumerate(list(edges)[1:], 1):
            at_edges = at_edges.when(is_row(values), i)
        twice = ordered.groupBy(at_edges.alias("_tl_e")).count().where("_tl_e is not null and count > 1")
        if not twice.isEmpty():
            raise ValueError(f"records share a key {tuple(keys)}: a document needs one key per record (see with_record_ids)")
    if not found:
        (spark.createDataFrame([("".join(tokens) + "]}",)], "value string")
         .coalesce(1).write.mode("overwrite").text(path))
        return sizes

    def at(row) -> F.Column:
        cond = F.lit(True)
        for c in order_cols:
            cond = cond & F.col(c).eqNullSafe(F.lit(row[c]))
        return cond

    prefix, opened = F.lit(", "), 0
    for i in sorted(found):  # the first record of a section opens it, and the empty ones before it
        prefix = F.when(at(found[i]["low"]), F.lit("".join(tokens[opened:i + 1]))).otherwise(prefix)
        opened = i + 1
    suffix = F.when(at(found[max(found)]["high"]), F.lit("".join(tokens[opened:]) + "]}")).otherwise(F.lit(""))
    item = F.concat(F.lit('{"text": '), _json_string(F.col("_tl_text")), F.lit("}"))
    (ordered.repartitionByRange(range_partitions(ordered), *order_cols).sortWithinPartitions(*order_cols)
     .select(F.concat(prefix, item, suffix).alias("value")).write.mode("overwrite").text(path))
    return sizes


def write_metadata(spark: SparkSession, path: str, stats: dict, total_lines: int, augmentation_ratio: float,
                   split_ratio: Sequence[float], formats: Sequence[str]) -> None:
    """One-row metadata JSON: totals, ratios, statistics struct and formats.

    ``stats`` is the row of dataset statistics (it holds the number of
    conversations); ``total_lines`` counts the written records, segments included.
    """
    row = spark.createDataFrame([tuple(stats.values())], _stats_schema(stats))
    meta = row.select(F.col("total_conversations").alias("total_conversations"),
                      F.lit(int(total_lines)).cast("bigint").alias("total_lines"),
                      F.lit(float(augmentation_ratio)).alias("augmentation_ratio"),
                      F.array(*[F.lit(float(r)) for r in split_ratio]).alias("split_ratio"),
                      F.struct(*row.columns).alias("statistics"),
                      F.array(*[F.lit(f) for f in formats]).alias("formats"))
    meta.coalesce(1).write.mode("overwrite").json(path)


def _stats_schema(stats: dict) -> str:
    return ", ".join(f"{k} {'double' if isinstance(v, float) else 'bigint'}" for k, v in stats.items())


def export(records: DataFrame, out_dir: str, allowed_sources: DataFrame, formats: Sequence[str] = FORMATS,
           split_col: str = "split", keys=("conv_id", "start"), seed: int | str | None = 42,
           source_col: str = "source", stage: bool = True) -> dict:
    """Write the requested formats below ``out_dir``; returns what was written.

    All formats are cut by ``split_col``.  With several formats and ``stage=True`` the
    records are first written once as a Parquet table (``<out_dir>/records_table``) and
    every format is read from it, so the upstream plan runs once instead of once per format.
    """
    unknown = set(formats) - set(FORMATS)
    if unknown:
        raise ValueError(f"unknown formats: {sorted(unknown)}")
    records = allowed_only(records, allowed_sources, source_col)
    out = out_dir.rstrip("/")
    written = {}
    if stage and len(formats) > 1:
        records.write.mode("overwrite").parquet(f"{out}/records_table")
        records = records.sparkSession.read.parquet(f"{out}/records_table")
        written["records_table"] = f"{out}/records_table"
    if "records" in formats:
        write_records(records, f"{out}/records", allowed_sources, split_col, source_col=source_col)
        written["records"] = f"{out}/records"
    if "text" in formats:
        write_text_records(records, f"{out}/text", allowed_sources, split_col, source_col=source_col)
        written["text"] = f"{out}/text"
    if "document" in formats:
        written["document"] = write_text_document(records, f"{out}/document", allowed_sources, keys, seed,
                                                  split_col=split_col, source_col=source_col)
    return written
