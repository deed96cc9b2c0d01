"""Variable-capacity best-fit packing of token sequences.

Several sequence lengths are permitted at once.  Documents longer than the
largest one are cut into pieces of that length plus a rest; nothing is dropped.
Pieces are dealt to shards of bounded size by a hash of the document id, and
each shard is packed on its own: pieces go longest first into the open bin with
the least room that still fits (best fit).  When none fits, a bin is opened: of
all permitted sizes the one with the least cost per token it is expected to
hold.  A bin of size ``c`` costs ``c + c * c / ATTENTION + bin_cost``; it is
expected to hold the piece and, as far as there is room, those remaining pieces
that fit beside it.  When the shard is done each bin is downsized to the smallest
permitted size that holds its contents.

A shard loses at most its last open bins, so the loss over one global packing
is a small constant per ``shard_rows`` pieces.

Defined cases: null or blank text has no tokens and still gets a row (piece 0,
length 0, no bin); equal lengths are ordered by (doc_id, piece); identical rows
are packed once each; a null id sorts last; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threadline.llm.common import WORD_REGEX, checkpointed, documents

CAPACITIES = (512, 1024, 2048, 4096)
BIN_COST = 16
ATTENTION = 16_384
SHARD_ROWS = 20_000
EQUAL_RUN = 1024
_SCHEMA = ("doc_id long, piece long, start long, length long, shard long, bin long, offset long, capacity long")


def best_fit(lengths: np.ndarray, capacities=CAPACITIES, bin_cost: int = BIN_COST):
    """Pack lengths (each at most the largest capacity, at least 1).

    Returns bin number and offset per item, and the final capacity per bin.
    """
    caps = sorted(capacities)
    top = caps[-1]
    order = np.argsort(-lengths, kind="stable")
    bin_of = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    used: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(top + 1)]
    open_rooms = 0  # bit r is set while by_room[r] has bins
    falling = lengths[order]
    after = np.append(np.cumsum(falling[::-1])[::-1], 0)  # tokens from each place on

    def cost_per_token(c: int, need: int, place: int) -> float:
        beside = max(place + 1, int(np.searchsorted(-falling, need - c)))
        return (c + c * c / ATTENTION + bin_cost) / (need + min(c - need, int(after[beside])))

    for place, i in enumerate(order):
        need = int(lengths[i])
        fits = open_rooms >> need
        if fits:
            room = need + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                open_rooms &= ~(1 << room)
        else:
            room = min((c for c in caps if c >= need), key=lambda c: (cost_per_token(c, need, place), c))
            b = len(used)
            used.append(0)
        bin_of[i], offset[i] = b, used[b]
        used[b] += need
        room -= need
        if room:
            by_room[room].append(b)
            open_rooms |= 1 << room
    final = np.array([next(c for c in caps if c >= u) for u in used], np.int64)
    return bin_of, offset, final


def pieces(docs: DataFrame, length: Column, id_col: str = "doc_id", capacities=CAPACITIES) -> DataFrame:
    """(doc_id, piece, start, length): documents cut at the largest capacity."""
    top = max(capacities)
    n = docs.select(F.col(id_col).cast("long").alias("doc_id"), length.cast("long").alias("n"))
    last = F.greatest(F.floor((F.col("n") - 1) / top), F.lit(0)).cast("long")
    return (n.select("doc_id", "n", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
            .select("doc_id", "piece", (F.col("piece") * top).alias("start"),
                    F.least(F.col("n") - F.col("piece") * top, F.lit(top)).cast("long").alias("length")))


def pack(cut: DataFrame, capacities=CAPACITIES, bin_cost: int = BIN_COST, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Pack the pieces shard by shard; a row per piece with its bin, offset and capacity."""
    # ids may repeat or be null in any number: equal pieces are counted and dealt in runs of EQUAL_RUN,
    # so a shard is bounded and depends on the pieces alone, not on where they lie
    cut = checkpointed(cut.groupBy("doc_id", "piece", "start", "length").agg(F.count("*").alias("copies")))
    shards = max(1, math.ceil((cut.agg(F.sum("copies")).first()[0] or 0) / shard_rows))
    runs = cut.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / EQUAL_RUN).cast("long"))))
    size = F.least(F.col("copies") - F.col("run") * EQUAL_RUN, F.lit(EQUAL_RUN))
    shard = F.pmod(F.xxhash64("doc_id", "piece", "length", "run"), F.lit(shards))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["known", "doc_id", "piece", "length"], ascending=[False, True, True, True], kind="stable")
        full = pdf[pdf["length"] > 0]
        b, o, caps = best_fit(full["length"].to_numpy(), capacities, bin_cost)
        out = pdf.assign(bin=pd.array([None] * len(pdf), "Int64"), offset=0, capacity=0)
        out.loc[full.index, "bin"] = b
        out.loc[full.index, "offset"] = o
        out.loc[full.index, "capacity"] = caps[b] if len(b) else 0
        out["doc_id"] = out["doc_id"].astype("Int64").where(out["known"])
        return out[["doc_id", "piece", "start", "length", "shard", "bin", "offset", "capacity"]]

    rows = (runs.withColumn("shard", shard).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), size)))
            .select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNotNull().alias("known"),
                    "piece", "start", "length", "shard"))
    return rows.groupBy("shard").applyInPandas(run, _SCHEMA)


def word_count(text: Column) -> Column:
    """Words of a whole text plus one end token; none for null or blank text."""
    n = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_REGEX))
    return F.when(n > 0, n + 1).otherwise(0)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    return pack(pieces(docs, word_count(F.col(text_col)), id_col, options.get("capacities", CAPACITIES)), **options)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))
