"""Exact dedup by a tree-merge of sorted digest runs.

Every row is dealt to one of ``fan_in ** rounds`` runs by a hash of its id and digest, and each run is sorted by digest
once.  In round ``r`` runs that differ in digit ``r`` of their number exchange slices: an entry moves to the run whose
digit ``r`` is digit ``r`` of its digest.  A slice is one binary of entries, cut in order from a sorted run, so it is
sorted; each receiver merges its ``fan_in`` slices with a heap, without sorting again, and keeps the smallest id and the
row count per digest.  A digest that a third of all rows share is at most one entry per run from the start and
``fan_in`` times fewer after each round, and a run never holds much more than ``rows_per_run`` entries.  After the last
round a run holds one digest range, completely merged.  There are two rounds at least.  The result travels back down to
the distinct digests of the first runs and from there to the rows: no join key is hot.

An entry is *verified*: texts count as equal when SHA-256, byte length and an
independent 64-bit hash of the normalised text all agree.

Defined cases: null text is empty text; a null id is larger than every id;
identical (id, text) rows form one group and the first copy of them stays;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
import struct

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threadline.llm.common import SPACE_REGEX, checkpointed, documents, drop_rows

FAN_IN = 16
ROWS_PER_RUN = 4096
MIN_ROUNDS = 2
_NO_ID = 2**63 - 1
#: Key (SHA-256, byte length, second hash), smallest id, rows with an id, rows.
ENTRY = ">48sqqq"


def _eight_bytes(c: Column) -> Column:
    return F.lpad(F.hex(c), 16, "0")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct (id, text): id, key (digest, byte length, second hash) and the number of equal rows."""
    norm = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACE_REGEX, " ")
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), norm.alias("t"))
            .select("doc_id", F.unhex(F.concat(F.sha2("t", 256), _eight_bytes(F.octet_length("t").cast("long")),
                                               _eight_bytes(F.xxhash64("t")))).alias("key"))
            .groupBy("doc_id", "key").agg(F.count("*").alias("copies")))


def merge_slices(slices):
    """Entries of sorted slices in order, one per key: smallest id, sums of the counts."""
    last = None
    for key, keep, known, n in heapq.merge(*(struct.iter_unpack(ENTRY, s) for s in slices)):
        if last is not None and last[0] == key:  # entries of one key come by ascending id
            last[2] += known
            last[3] += n
            continue
        if last is not None:
            yield last
        last = [key, keep, known, n]
    if last is not None:
        yield last


def _deal(run: int, entries, step: int, fan_in: int) -> pa.Table:
    """Slices of a sorted run, by the run that gets them: digit ``step`` becomes that of the digest."""
    out: dict[int, bytearray] = {}
    base = run - run // step % fan_in * step
    for e in entries:
        to = base + int.from_bytes(e[0][:8], "big") // step % fan_in * step
        out.setdefault(to, bytearray()).extend(struct.pack(ENTRY, *e))
    return pa.table({"run": pa.array(list(out), pa.int64()), "slice": pa.array([bytes(x) for x in out.values()], pa.binary())})


def _sorted_run(fan_in: int):
    """The slices of a run of rows for the first round; the only sort."""
    def start(t: pa.Table) -> pa.Table:
        rows = sorted(zip(*(t.column(c).to_pylist() for c in ("key", "keep", "known", "n"))))
        entries = merge_slices([b"".join(struct.pack(ENTRY, *r) for r in rows)])
        return _deal(t.column("run")[0].as_py(), entries, 1, fan_in)
    return start


def _merge_and_deal(step: int, fan_in: int):
    """Merge the slices that a run has got and cut it for the round of ``step``."""
    def merge(t: pa.Table) -> pa.Table:
        return _deal(t.column("run")[0].as_py(), merge_slices(t.column("slice").to_pylist()), step, fan_in)
    return merge


def _merge_last(t: pa.Table) -> pa.Table:
    """The finished entries of a run."""
    rows = list(merge_slices(t.column("slice").to_pylist()))
    return pa.table({"key": pa.array([r[0] for r in rows], pa.binary()),
                     "keep_id": pa.array([r[1] if r[2] else None for r in rows], pa.int64()),
                     "group_size": pa.array([r[3] for r in rows], pa.int64())})


def keepers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            fan_in: int = FAN_IN, rows_per_run: int = ROWS_PER_RUN) -> DataFrame:
    """Per distinct (id, text): doc_id, sha256, copies (equal rows), keep_id, group_size."""
    base = checkpointed(digests(docs, id_col, text_col))
    total = base.count()
    rounds = max(MIN_ROUNDS, math.ceil(math.log(max(total / rows_per_run, 2), fan_in)))
    base = base.withColumn("run", F.pmod(F.xxhash64("doc_id", "key"), F.lit(fan_in**rounds)))

    sliced = "run long, slice binary"
    runs = (base.select("run", "key", F.coalesce("doc_id", F.lit(_NO_ID)).alias("keep"),
                        F.when(F.col("doc_id").isNull(), 0).otherwise(F.col("copies")).cast("long").alias("known"),
                        F.col("copies").alias("n"))
            .groupBy("run").applyInArrow(_sorted_run(fan_in), sliced))
    for r in range(1, rounds):
        runs = runs.groupBy("run").applyInArrow(_merge_and_deal(fan_in**r, fan_in), sliced)
    classes = runs.groupBy("run").applyInArrow(_merge_last, "key binary, keep_id long, group_size long")
    resolved = base.select("run", "key").distinct().join(classes, "key")
    return base.join(resolved, ["run", "key"]).select(
        "doc_id", F.lower(F.hex(F.substring("key", 1, 32))).alias("sha256"), "copies", "keep_id", "group_size")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                fan_in: int = FAN_IN, rows_per_run: int = ROWS_PER_RUN) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    return (keepers(docs, id_col, text_col, fan_in, rows_per_run)
            .select("*", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
            .select("doc_id", "keep_id", "group_size",
                    (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
                    F.col("sha256").alias("text_sha256")))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, columns unchanged; of identical rows one stays."""
    per = checkpointed(keepers(docs, id_col, text_col).withColumn("id", F.coalesce("doc_id", F.lit(_NO_ID))))
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    norm = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACE_REGEX, " ")
    return drop_rows(docs, [F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)), F.sha2(norm, 256)],
                     per.where(~stays).select("id", "sha256"), per.where(stays & (F.col("copies") > 1)).select("id", "sha256"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), s AS (SELECT doc_id, sha256(t) AS text_sha256 FROM d)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM s WINDOW w AS (PARTITION BY text_sha256)
"""
