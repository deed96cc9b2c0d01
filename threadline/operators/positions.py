"""Exact positions without a single hot task.

Two primitives:

* :func:`turn_positions` - 0-based position of each turn inside its
  conversation, and the conversation size.  A conversation may hold a third
  of all rows, so a plain ``row_number() over (partition by conv_id)`` would
  put it in one task.  Instead turns are cut into blocks of ``block_size``
  consecutive ``turn`` values: block sizes come from a partial aggregate, a
  two-level prefix sum over the (small) block table gives each block's base
  (blocks inside superblocks, then superblocks per conversation), and
  ``row_number`` runs per ``(conv_id, block)`` group.  One shuffle of the rows, keyed by (conv_id, block).

* :func:`global_positions` - rank of each row in a total order over the whole
  table, where every rank is needed (file-order ids; samples and splits use the
  cheaper selection of :mod:`threadline.operators.select`).  The table is range-partitioned and sorted, checkpointed to the shared
  checkpoint folder (fixed partitioning, lineage cut), counted per partition
  (one small row per partition), and each row's rank is base(partition) +
  index in partition.  No ``SinglePartition`` exchange is used.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from threadline.session import ensure_checkpoint_dir

DEFAULT_BLOCK_SIZE = 1024
# Blocks per superblock in the two-level prefix sum of block sizes.
SUPER = 1024
# Stand-in block number of rows without an order value: before every real block.
NULL_BLOCK = -(2**63)


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _default_for(dtype: Ty.DataType):
    if isinstance(dtype, Ty.StringType):
        return ""
    if isinstance(dtype, (Ty.ByteType, Ty.ShortType, Ty.IntegerType, Ty.LongType, Ty.FloatType,
                          Ty.DoubleType, Ty.DecimalType)):
        return 0
    if isinstance(dtype, Ty.BooleanType):
        return False
    return None


def _orderable(dtype: Ty.DataType) -> bool:
    if isinstance(dtype, Ty.MapType):
        return False
    if isinstance(dtype, Ty.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, Ty.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (Ty.NullType, Ty.VariantType))


def surrogate_keys(df: DataFrame, keys: Sequence[str], prefix: str = "_tl_sk") -> tuple[DataFrame, list[str]]:
    """Non-nullable stand-ins for possibly-null key columns.

    Each nullable key ``k`` becomes ``coalesce(k, default)`` plus an
    ``isnull(k)`` flag: plain equality on the pair is null-safe equality on
    ``k``.  Shuffles, windows and joins keyed by the stand-ins line up
    (a null-safe join on ``k`` itself would hash different expressions and
    re-shuffle one side).  Non-nullable keys are used as they are.
    """
    out, cols = df, []
    for i, k in enumerate(keys):
        field = df.schema[k]
        default = _default_for(field.dataType)
        if not field.nullable:
            cols.append(k)
        elif default is None:
            out = out.withColumn(f"{prefix}{i}", F.to_json(F.struct(F.col(k))))  # non-null text form
            cols.append(f"{prefix}{i}")
        else:
            out = (out.withColumn(f"{prefix}{i}", F.coalesce(F.col(k), F.lit(default).cast(field.dataType)))
                   .withColumn(f"{prefix}n{i}", F.isnull(F.col(k))))
            cols += [f"{prefix}{i}", f"{prefix}n{i}"]
    return out, cols


def _floor_div(c: Column, n: int) -> Column:
    """``floor(c / n)`` in integers (``div`` truncates towards zero)."""
    c = c.cast("bigint")
    # the subtraction cannot leave the range of a bigint: it moves c down to a multiple of n,
    # or, next to the smallest bigint, leaves it where it is
    low = F.when(c < F.lit(-(2**63) + n), c).otherwise(c - F.pmod(c, F.lit(n).cast("bigint")))
    return F.call_function("div", low, F.lit(n).cast("bigint"))


def turn_positions(df: DataFrame, keys="conv_id", order="turn", pos_col: str = "pos",
                   size_col: str | None = "n", block_size: int = DEFAULT_BLOCK_SIZE,
                   within=None, within_pos_col: str | None = None) -> DataFrame:
    """Add ``pos`` (0-based rank of ``order`` within ``keys``) and ``n`` (group size).

    ``order`` may be one column or several (the first, an integral column, is
    used for blocking; the rest break ties).  ``(keys, order)`` should be
    unique for positions to be deterministic.  Null keys form their own group.

    All input columns ride along (and break ties in ``order``, so ranks are
    deterministic): select only the columns needed downstream before calling.

    ``within`` (extra columns) also adds ``within_pos_col``: the rank inside
    ``keys + within`` under the same order.  Both rank families share the one
    exchange of the rows: hash partitioning on ``(keys, block)`` already
    clusters ``(keys, within, block)``.

    Negative order values are blocked by floor division and rows without one
    come first (``orderBy`` puts nulls first).  A block holds ``block_size``
    consecutive order values: at most ``block_size`` rows where ``(keys, order)``
    is unique; rows that repeat one order value (or have none) share a block.
    """
    out_names = list(df.columns)
    keys = _names(keys)
    order = _names(order)
    extra = _names(within) if within else []
    lead = order[0]
    blk = "_tl_blk"
    staged, kcols = surrogate_keys(df, keys)
    staged, xcols = surrogate_keys(staged, extra, prefix="_tl_sx") if extra else (staged, [])
    keyed = staged.withColumn(blk, F.coalesce(_floor_div(F.col(lead), int(block_size)), F.lit(NULL_BLOCK)))
    bcols = [blk]

    parted = keyed.repartition(*[F.col(c) for c in [*kcols, *bcols]])
    # ties in ``order`` are broken by the other (orderable) columns: ranks are fully
    # deterministic even when (keys, order) repeats
    taken = set([*kcols, *xcols, *bcols, *order])
    ties = [c for c in parted.columns if c not in taken and _orderable(parted.schema[c].dataType)]
    ranked = parted.withColumn(
        "_tl_r", F.row_number().over(Window.partitionBy(*kcols, *bcols).orderBy(*order, *ties)) - 1)
    if extra:
        ranked = ranked.withColumn(
            "_tl_rr", F.row_number().over(Window.partitionBy(*kcols, *xcols, *bcols).orderBy(*order, *ties)) - 1)

    def offsets_for(group: list[str], base_col: str, with_size: bool) -> DataFrame:
        # Block sizes: an independent partial aggregate over the input (pruned to keys and
        # block, plus what upstream filters read), running beside the row exchange;
        # counting the ranked rows instead would sort and rank every row a second time.
        # Bases: a two-level prefix sum - blocks inside superblocks of SUPER blocks, then
        # superblock totals per group - so no window partition holds more than about SUPER
        # blocks (plus one row per superblock of a group).
        counts = (keyed.groupBy(*group, *bcols).agg(F.count(F.lit(1)).alias("_tl_cnt"))
                  .withColumn("_tl_sup", _floor_div(F.col(blk), SUPER)))
        block_order = [F.col(blk)]
        in_sup = Window.partitionBy(*group, "_tl_sup")
        lvl1 = counts.select(
            *group, *bcols, "_tl_sup",
            (F.sum("_tl_cnt").over(in_sup.orderBy(*block_order)
                                   .rowsBetween(Window.unboundedPreceding, Window.currentRow))
             - F.col("_tl_cnt")).alias("_tl_in_sup"))
        sups = counts.groupBy(*group, "_tl_sup").agg(F.sum("_tl_cnt").alias("_tl_sup_cnt"))
        per_key = Window.partitionBy(*group)
        lvl2 = sups.select(
            *group, "_tl_sup",
            (F.sum("_tl_sup_cnt").over(per_key.orderBy("_tl_sup")
                                       .rowsBetween(Window.unboundedPreceding, Window.currentRow))
             - F.col("_tl_sup_cnt")).alias("_tl_sup_base"),
            *([F.sum("_tl_sup_cnt").over(per_key).alias(size_col)] if with_size else []))
        joined_lvls = lvl1.join(lvl2, on=[*group, "_tl_sup"], how="inner")
        return joined_lvls.select(
            *group, *bcols, (F.col("_tl_sup_base") + F.col("_tl_in_sup")).alias(base_col),
            *([F.col(size_col)] if with_size else []))

    offsets = offsets_for(kcols, "_tl_base", bool(size_col))
    joined = ranked.join(offsets, on=[*kcols, *bcols], how="inner")
    cols = [F.col(c) for c in out_names]
    cols.append((F.col("_tl_base") + F.col("_tl_r")).alias(pos_col))
    if size_col:
        cols.append(F.col(size_col))
    if not extra:
        return joined.select(*cols)
    sub = offsets_for([*kcols, *xcols], "_tl_rbase", False)
    joined2 = joined.join(sub, on=[*kcols, *xcols, *bcols], how="inner")
    return joined2.select(*cols, (F.col("_tl_rbase") + F.col("_tl_rr")).alias(within_pos_col or "within_pos"))



# ---------------------------------------------------------------------------
# Global order
# ---------------------------------------------------------------------------

# Target bytes per range partition when sizing from the optimizer's estimate.
RANGE_PARTITION_BYTES = 128 * 1024 * 1024


def input_bytes(df: DataFrame) -> int:
    """Bytes of the plan's leaves: files by their statistics, checkpoints by what was written.

    The estimate of the whole plan is not used: a join multiplies its inputs' sizes, and the statistics of
    a checkpoint are the estimate of the plan it was made from.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(_leaf_bytes(df, leaves.apply(i)) for i in range(leaves.size()))


def _leaf_bytes(df: DataFrame, leaf) -> int:
    if leaf.nodeName() == "LogicalRDD":
        written = leaf.rdd().getCheckpointFile()
        if written.isDefined():
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(written.get())
            return path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return int(str(leaf.stats().sizeInBytes()))


def range_partitions(df: DataFrame) -> int:
    """Partitions for a range sort: the configured shuffle partitions, or more when the
    inputs' size says the data needs it (AQE can merge range partitions but never split
    them).  Compressed inputs are taken to unpack to three times their size."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(max(n, -(-3 * input_bytes(df) // RANGE_PARTITION_BYTES)), 2**31 - 1)


class RankedTable:
    """A checkpointed, range-sorted table with exact global ranks.

    ``frame`` carries the input columns plus ``pos_col``; ``total`` is the row
    count.  Partition bases are literals (one per partition), so ranks are a
    row-local expression over ``spark_partition_id()``.
    """

    def __init__(self, frame: DataFrame, total: int, order_cols: list[str], pos_col: str):
        self.frame = frame
        self.total = total
        self.order_cols = order_cols
        self.pos_col = pos_col

    def rows_at(self, positions: Sequence[int]) -> dict[int, tuple]:
        """Order-key values of the rows at the given ranks (a few rows to the driver)."""
        wanted = sorted({int(p) for p in positions if 0 <= int(p) < self.total})
        if not wanted:
            return {}
        got = (self.frame.filter(F.col(self.pos_col).isin(wanted))
               .select(self.pos_col, *self.order_cols).collect())
        return {r[0]: tuple(r[1:]) for r in got}


def global_positions(df: DataFrame, order_cols, pos_col: str = "gpos",
                     num_partitions: int | None = None) -> RankedTable:
    """Exact 0-based rank of every row under ``order_cols`` (must be a unique key)."""
    order_cols = _names(order_cols)
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n_parts = num_partitions or range_partitions(df)
    ranged = df.repartitionByRange(n_parts, *order_cols).sortWithinPartitions(*order_cols)
    fixed = ranged.checkpoint(eager=True)

    pid = F.spark_partition_id()
    local_idx = F.monotonically_increasing_id() - F.shiftleft(pid.cast("bigint"), 33)
    counts = {r[0]: r[1] for r in fixed.groupBy(pid.alias("p")).count().collect()}
    # partitions without rows never evaluate their base, so ids up to the largest seen suffice
    n_fixed = max(counts) + 1 if counts else 0
    bases, acc = [], 0
    for p in range(n_fixed):
        bases.append(acc)
        acc += counts.get(p, 0)
    # one literal for all bases (constant-folded), not a call per partition
    table = F.from_json(F.lit(json.dumps(bases)), "array<bigint>")
    base = F.element_at(table, pid + 1) if bases else F.lit(0)
    frame = fixed.withColumn(pos_col, base + local_idx)
    return RankedTable(frame, acc, order_cols, pos_col)


def keys_at_block_ranks(df: DataFrame, block_cols: Sequence[str], seq_col: str, ranks) -> tuple[int, dict[int, tuple]]:
    """Row count and the ``(block_cols.., seq_col)`` keys at the wanted ranks, without moving rows.

    Rows are ordered by ``(block_cols, seq_col)`` and already lie in blocks (file splits).
    The table of block counts is ranged and checkpointed; sums per partition (a row each) tell
    which partition of it holds a rank, a running sum there the block, and one small
    ordered read of that block the key.  ``ranks`` is a function of the row count.
    """
    block_cols = list(block_cols)
    ensure_checkpoint_dir(df.sparkSession)
    counts = df.groupBy(*block_cols).agg(F.count(F.lit(1)).alias("_tl_n"))
    counts = (counts.repartitionByRange(*block_cols).sortWithinPartitions(*block_cols).checkpoint(eager=True)
              .withColumn("_tl_p", F.spark_partition_id()))
    sums = sorted((r[0], r[1]) for r in counts.groupBy("_tl_p").agg(F.sum("_tl_n")).collect())
    total = sum(n for _, n in sums)
    found = {}
    for k in sorted({int(r) for r in ranks(total) if 0 <= int(r) < total}):
        base = 0
        for part, n in sums:
            if base + n > k:
                break
            base += n
        run = Window.partitionBy("_tl_p").orderBy(*block_cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        at = (counts.filter(F.col("_tl_p") == part).withColumn("_tl_end", F.sum("_tl_n").over(run))
              .filter((F.col("_tl_end") > k - base) & (F.col("_tl_end") - F.col("_tl_n") <= k - base)).first())
        block = df
        for c in block_cols:
            block = block.filter(F.col(c).eqNullSafe(F.lit(at[c])))
        row = block.orderBy(seq_col).offset(k - base - at["_tl_end"] + at["_tl_n"]).limit(1).collect()[0]
        found[k] = tuple(row[c] for c in [*block_cols, seq_col])
    return total, found
