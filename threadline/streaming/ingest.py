"""Incremental, resumable ingest of JSONL conversation files.

A Structured Streaming file source remembers processed files in its
checkpoint, and ``Trigger.AvailableNow`` processes whatever is new and stops,
so a rerun over the same folder adds nothing.  Records are written by the
Parquet file sink, whose commit log makes each batch exactly-once: a batch
replayed after a failure neither loses nor repeats rows.  Equal lines are
equal records and all of them are kept.

All top-level fields of a line are kept (``extra``, as in the batch scans), so ingested records can pass the
sinks' allow-list by their ``source``.  With ``rejects_dir`` a second query, with a checkpoint of its
own, writes the lines that are no records there, each once, with its file and the reason.

``dedup_days`` drops records whose content was ingested within that many days
(``dropDuplicatesWithinWatermark`` on the ingest time), so the state holds the keys
of that period only.  For large key sets use the RocksDB state store
(``spark.sql.streaming.stateStore.providerClass``), which keeps state on
local disk and in the checkpoint instead of the executor heap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadline.functions import roles as R
from threadline.functions import text as T
from threadline.sources import jsonl as J

# Record key: md5 of the trimmed line.
KEY_COL = "record_key"


def _parse_stream(lines: DataFrame) -> DataFrame:
    parsed = J.parse_lines(lines.filter(T.is_nonblank("value")).select(F.make_valid_utf8("value").alias("line")))
    return (parsed.filter(F.coalesce(F.size("rec.conv") > 0, F.lit(False)))
            .select("rec.conv_id", "rec.start", "rec.variant", F.col("rec.conv").alias("conversations"), "rec.extra",
                    F.md5("body").alias(KEY_COL)))


def _rejected(lines: DataFrame) -> DataFrame:
    """(line, reason, src_file) of the lines that are no records; blank lines are no rejects."""
    lines = lines.select(F.make_valid_utf8("value").alias("line"), F.col("_metadata.file_path").alias("src_file"))
    return (J.with_outcome(lines).withColumnRenamed("outcome", "reason").filter(F.col("reason").isin("malformed", "no_records"))
            .select("line", "reason", "src_file"))


def _run(rows: DataFrame, target_dir: str, checkpoint_dir: str) -> int:
    """Append what is new to a Parquet table and stop; the number of micro-batches that read files."""
    q = (rows.writeStream.format("parquet").option("path", target_dir).option("checkpointLocation", checkpoint_dir)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return sum(1 for p in q.recentProgress if p.get("numInputRows", 0) > 0)


def ingest_incremental(spark: SparkSession, source_dir: str, target_dir: str, checkpoint_dir: str,
                       glob: str = J.DEFAULT_GLOB, max_files_per_trigger: int | None = None,
                       dedup_days: int | None = None, rejects_dir: str | None = None) -> int:
    """Append new records from ``source_dir`` to the Parquet table ``target_dir``.

    Returns the number of micro-batches that read new files.  The target
    holds ``(conv_id, start, variant, conversations, extra, record_key)``; read it with
    ``spark.read.parquet`` (which follows the sink's commit log).  ``rejects_dir`` is a
    Parquet table ``(line, reason, src_file)`` beside it.
    """
    reader = spark.readStream.format("text").option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    records = _parse_stream(reader.load(source_dir))
    if dedup_days is not None:
        records = (records.withColumn("_ingested", F.current_timestamp())
                   .withWatermark("_ingested", f"{int(dedup_days)} days")
                   .dropDuplicatesWithinWatermark([KEY_COL]).drop("_ingested"))
    if rejects_dir is not None:
        _run(_rejected(reader.load(source_dir)), rejects_dir, f"{checkpoint_dir.rstrip('/')}_rejects")
    return _run(records, target_dir, checkpoint_dir)


def read_ingested(spark: SparkSession, target_dir: str) -> DataFrame:
    """The ingested table as records ``(conv_id, start, variant, turns, extra, source, record_key)``."""
    df = spark.read.parquet(target_dir)
    if "extra" not in df.columns:  # a table ingested before other fields were kept
        df = df.withColumn("extra", F.lit(None).cast("map<string,string>"))
    start = F.coalesce("start", F.lit(0).cast("bigint"))
    turns = F.transform("conversations", lambda t, i: F.struct(
        (i + start).cast("bigint").alias("pos"), (i + start).cast("bigint").alias("turn"),
        R.from_interchange_role(t["from"]).alias("role"), t["value"].alias("text")))
    return df.select("conv_id", start.alias("start"), "variant", turns.alias("turns"), "extra", F.col("extra")["source"].alias("source"), KEY_COL)
