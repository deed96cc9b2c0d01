"""Hybrid dataset build: exact seeded sample -> augment -> union -> shuffled split -> stats.

Work per stage: positions (one shuffle keyed by conversation block), the
sample bound and the split bounds (distributed selection over the record
keys), statistics (partial aggregates).  Turn rows are only filtered and projected: the sample and the
split are row-local comparisons with literal bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from threadline.functions import roles as R
from threadline.functions import text as T
from threadline.operators import augment as A
from threadline.operators import nested as N
from threadline.operators import split as SP
from threadline.operators import stats as S
from threadline.operators.sample import exact_sample
from threadline.sinks import export as X


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def build_hybrid(turns: DataFrame, keys="conv_id", order: str = "turn", ratio: float = 0.5,
                 seed: int | str = 42, split_ratios: Sequence[float] = SP.SPLIT_RATIOS,
                 rule: str = "cumulative", marker: str = S.STATS_MARKER,
                 user_role: str = R.USER, with_split: bool = True) -> tuple[DataFrame, DataFrame]:
    """Return ``(rows, stats)``: flat hybrid turns with ``variant`` (and ``split``
    unless ``with_split=False``), and one-row statistics over the hybrid records."""
    keys = _names(keys)
    sample = exact_sample(turns, keys, seed, ratio=ratio)
    rows = A.hybrid(turns, keys, order, ratio, seed, user_role, sample=sample)
    rec_keys = [*keys, "variant"]
    if with_split:
        # split bounds need only the record keys, which come from the input directly
        record_keys = A.hybrid_record_keys(turns, sample, keys)
        split = SP.prefix_split(record_keys, rec_keys, seed=seed, ratios=split_ratios, rule=rule)
        rows = rows.withColumn("split", split.label())
    return rows, S.dataset_stats(rows, rec_keys, marker)


def hybrid_splits(turns: DataFrame, keys="conv_id", ratio: float = 0.5, seed: int | str = 42,
                  split_ratios: Sequence[float] = SP.SPLIT_RATIOS, rule: str = "cumulative") -> DataFrame:
    """The split of every hybrid record, ``(keys.., variant, split)``, without building turns:
    the record keys come from the input, and the label is row-local on them."""
    keys = _names(keys)
    sample = exact_sample(turns, keys, seed, ratio=ratio)
    record_keys = A.hybrid_record_keys(turns, sample, keys)
    split = SP.prefix_split(record_keys, [*keys, "variant"], seed=seed, ratios=split_ratios, rule=rule)
    return record_keys.withColumn("split", split.label())


def hybrid_records(rows: DataFrame, keys="conv_id", max_turns: int = N.DEFAULT_SEGMENT_TURNS) -> DataFrame:
    """Flat hybrid turns -> bounded records ``(keys.., variant, split, [source,] start, turns)``."""
    keys = [*_names(keys), "variant", "split", *(["source"] if "source" in rows.columns else [])]
    # hybrid rows already carry dense positions per record (transforms renumber them)
    return N.assemble(rows, max_turns, keys=keys, order="turn", positioned=True)


def records_stats(records: DataFrame, keys=("conv_id", "variant"), marker: str = S.STATS_MARKER) -> DataFrame:
    """Statistics over records stored as bounded segments: segments are folded per
    record (one small row each) before the global merge."""
    t = F.col("turns")
    per_segment = records.select(
        *_names(keys), F.size(t).alias("n_turns"),
        F.aggregate(t, F.lit(0).cast("bigint"), lambda acc, x: acc + T.token_count(x["text"])).alias("n_tokens"),
        F.coalesce(F.exists(t, lambda x: T.contains(x["text"], marker)), F.lit(False)).alias("has_marker"))
    per_record = per_segment.groupBy(*_names(keys)).agg(
        F.sum("n_turns").alias("n_turns"), F.sum("n_tokens").alias("n_tokens"),
        F.bool_or("has_marker").alias("has_marker"))
    return S._finish_stats(per_record)


def write_hybrid(rows: DataFrame, out_dir: str, allowed_sources: DataFrame, ratio: float = 0.5,
                 split_ratios: Sequence[float] = SP.SPLIT_RATIOS, formats: Sequence[str] = X.FORMATS,
                 seed: int | str = 42, keys="conv_id", marker: str = S.STATS_MARKER,
                 max_turns: int = N.DEFAULT_SEGMENT_TURNS) -> dict:
    """Write the hybrid dataset: requested formats, a combined file of all records, and metadata.

    The hybrid records of allowed sources are computed once and written as a Parquet table
    (``<out_dir>/records_table``); every format, the combined file and the
    statistics are then read from that table, so positions and transforms
    are not recomputed per output.  Conversations longer than ``max_turns`` are written as
    several records with their ``start``; all of them lie in the split of the conversation.
    """
    out = out_dir.rstrip("/")
    spark = rows.sparkSession
    seen = Observation()
    (X.allowed_only(hybrid_records(rows, keys, max_turns), allowed_sources).observe(seen, F.count(F.lit(1)).alias("lines"))
     .write.mode("overwrite").parquet(f"{out}/records_table"))
    recs = spark.read.parquet(f"{out}/records_table")
    written = X.export(recs, out, allowed_sources, formats=formats, split_col="split",
                       keys=[*_names(keys), "variant", "start"], seed=seed, stage=False)
    X.write_records(recs, f"{out}/combined", allowed_sources, split_col=None)
    stats = records_stats(recs, [*_names(keys), "variant"], marker).first().asDict()
    lines = int(seen.get["lines"])
    X.write_metadata(spark, f"{out}/metadata", stats, lines, ratio, split_ratios, list(formats))
    written.update(records_table=f"{out}/records_table", combined=f"{out}/combined", metadata=f"{out}/metadata",
                   total_records=stats["total_conversations"], total_lines=lines)
    return written
