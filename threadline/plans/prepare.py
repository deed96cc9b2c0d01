"""Split-only preparation: strict JSONL scan -> file order -> prefix split -> per-split JSONL.

The split uses the additive boundary rule (``valid_end = train_end +
int(n * 0.1)``) over file order.  Kept lines are counted per file split; the order keys of
the two boundary lines are looked up in the file splits that hold them, and every
line tests its own key against them: no line is shuffled or written twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadline.operators import split as SP
from threadline.operators import stats as S
from threadline.operators.positions import keys_at_block_ranks
from threadline.operators.sample import lex_below
from threadline.sinks import export as X
from threadline.sources import jsonl as J


def label_splits(spark: SparkSession, paths, ratios: Sequence[float] = SP.SPLIT_RATIOS,
                 glob: str | None = J.DEFAULT_GLOB) -> DataFrame:
    """Strictly scanned records (with their ``line``) and their ``split`` by file order."""
    records = J.scan_jsonl_strict(spark, paths, glob, keep_line=True)

    def want(total: int) -> list[int]:
        return list(SP.split_bounds(total, ratios, rule="additive"))

    total, at = keys_at_block_ranks(records.select(*J.ORDER_COLS), J.ORDER_COLS[:2], J.ORDER_COLS[2], want)
    order = [F.col(c) for c in J.ORDER_COLS]
    label = F.lit(SP.SPLIT_NAMES[-1])
    for end, name in reversed(list(zip(want(total), SP.SPLIT_NAMES))):
        below = F.lit(end > 0) if end <= 0 or end >= total else lex_below(order, at[end])
        label = F.when(below, F.lit(name)).otherwise(label)
    return records.withColumn("split", label)


def prepare_splits(spark: SparkSession, paths, out_dir: str, allowed_sources: DataFrame,
                   ratios: Sequence[float] = SP.SPLIT_RATIOS, glob: str | None = J.DEFAULT_GLOB) -> DataFrame:
    """Write the lines of allowed sources (their ``source`` field), whole, to ``out_dir/split=<name>/``.

    Returns the split sizes of what was written.
    """
    labelled = label_splits(spark, paths, ratios, glob).withColumn("source", F.col("extra")["source"])
    kept = X.allowed_only(labelled, allowed_sources)
    kept.select(F.col("line").alias("value"), "split").write.mode("overwrite").partitionBy("split").text(out_dir)
    return S.split_sizes(kept)
