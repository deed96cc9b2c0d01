"""Helpers shared by the operators: byte-level tokenizing and hashing with numpy.

A batch of texts is handled as one UTF-8 byte array plus offsets, so every step
is a vector operation over all texts of a slice; slices are bounded in bytes.
"""

from __future__ import annotations

import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threadline.session import ensure_checkpoint_dir, scratch_path

#: The white space of the word rule, [\x20\x09-\x0D].
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD_REGEX = "[^\\x20\\x09-\\x0D]+"
SPACE_REGEX = "[\\x20\\x09-\\x0D]+"

SLICE_BYTES = 1 << 20
_rng = np.random.default_rng(20240501)
BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 2**64)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n (kept, grown by doubling)."""
    have = _powers.get(0)
    if have is None or len(have[0]) < n:
        size = max(n, SLICE_BYTES + (1 << 16))
        pair = []
        for b in (BASE, BASE_INV):
            a = np.full(size, b, np.uint64)
            a[0] = 1
            pair.append(np.multiply.accumulate(a))
        have = _powers[0] = (pair[0], pair[1])
    return have[0][:n], have[1][:n]


def prefix_hash(codes: np.ndarray) -> np.ndarray:
    """Prefix sums of codes[i] * BASE**i; see :func:`range_hash`."""
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * powers(len(codes))[0], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of codes[start:end] for each pair; equal sequences of one length get equal hashes."""
    inv = powers(len(prefix))[1]
    h = (prefix[end] - prefix[start]) * inv[start]
    return mix(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and int64 offsets (nulls are empty texts)."""
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    kind = np.int64 if wide else np.int32
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def slices(offs: np.ndarray, limit: int = SLICE_BYTES):
    """Ranges of texts with about ``limit`` bytes each (one text at least)."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1)
        j = min(j, i + 50_000, n)
        yield i, j
        i = j


def word_spans(data: np.ndarray, offs: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text index of every word; words never cross texts, bytes in ``space`` are in no word."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~space[data]
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    first = offs[:-1]
    before[first[first < n]] = False
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    last = offs[1:]
    after[last[last > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offs, starts, side="right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return range_hash(prefix_hash(BYTE_CODE[data]), starts, ends)


def as_int64(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def held_fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the folder the cluster names."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again (smaller than a checkpoint)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder made by :func:`scratch_path` whose table is read no more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def release(spark: SparkSession) -> None:
    """Let the context cleaner remove broadcasts, shuffle files and checkpoints of finished steps: it acts on what both garbage collectors have dropped.

    Called between steps, it also keeps the driver's heap and Arrow's pool near what is in use."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    spark._jvm.System.gc()


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Bound the rows of an Arrow batch, so that a batch of long texts stays small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sliding(a: np.ndarray, span: int, op) -> np.ndarray:
    """op over every run of ``span`` neighbours (by doubling)."""
    if len(a) < span:
        return a[:0]
    k, out = 1, a
    while 2 * k <= span:
        out = op(out[:len(out) - k], out[k:])
        k *= 2
    rest = span - k
    return op(out[:len(out) - rest], out[rest:]) if rest else out


def window_minima(h: np.ndarray, whole: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Minimum of h over each window of ``span`` places, and which places are the minimum of a whole window.

    ``whole`` tells for each window start whether the window lies in one text.
    Equal windows have equal minima, so equal passages of a window's length
    select the same places in every text.
    """
    low = sliding(h, span, np.minimum)
    if not len(low):
        return low, np.zeros(len(h), bool)
    low = np.where(whole, low, np.uint64(0))
    pad = np.zeros(span - 1, np.uint64)
    return low, (sliding(np.concatenate([pad, low, pad]), span, np.maximum) == h) & (h != 0)


def list_column(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column without nulls."""
    offs = col.offsets.to_numpy().astype(np.int64)
    return col.values.to_numpy(zero_copy_only=False), offs


def to_lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the length of each list."""
    offs = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offs[1:])
    return pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(values, kind))


def sorted_groups(batches, key: str):
    """Tables of whole groups from the batches of a partition sorted by ``key``."""
    rest: list = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(key).to_numpy(zero_copy_only=False)
        if last is not None and k[0] != last:
            yield pa.Table.from_batches(rest)
            rest = []
        if k[-1] != k[0]:
            cut = int(np.flatnonzero(k != k[-1])[-1]) + 1
            rest.append(b.slice(0, cut))
            yield pa.Table.from_batches(rest)
            rest = [b.slice(cut)]
        else:
            rest.append(b)
        last = k[-1]
    if rest:
        yield pa.Table.from_batches(rest)


def when_small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a written table of at most ``rows`` rows; a larger one is shuffled."""
    n = getattr(df, "written_rows", None)  # :func:`compact` has counted it
    return F.broadcast(df) if (df.count() if n is None else n) <= rows else df


def compact(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """A written table in as many partitions as its rows need (narrow tables of ids).

    The count needs no task per shuffle partition: each task is kept by the driver.
    """
    out = checkpointed(df)
    n = out.coalesce(4 * df.sparkSession.sparkContext.defaultParallelism).count()
    out = out.coalesce(max(1, -(-n // rows)))
    out.written_rows = n
    return out


def _contracted(batches):
    """(node, root) of the edges of one partition, by union-find."""
    parent: dict[int, int] = {}

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for b in batches:
        for x, y in zip(b.column("a").to_pylist(), b.column("b").to_pylist()):
            x, y = find(parent.setdefault(x, x)), find(parent.setdefault(y, y))
            if x != y:
                parent[max(x, y)] = min(x, y)
    yield pa.RecordBatch.from_arrays([pa.array(list(parent), pa.int64()), pa.array([find(x) for x in parent], pa.int64())], names=["node", "root"])


def components(edges: DataFrame, rows: int = 500_000) -> DataFrame:
    """(node, root) of the connected components of edges (a, b); root is the smallest node.

    At most ``rows`` edges, one partition, are contracted where they are.  More are
    contracted by alternating large-star and small-star steps; each step sends a node the
    smallest neighbour only.  Every state is checkpointed and kept in as many
    partitions as it needs.
    """
    state = compact(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), rows)
    parts = max(1, -(-state.written_rows // rows))
    if parts == 1:
        return state.mapInArrow(_contracted, "node long, root long")

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")).coalesce(parts)
        near = both.join(low, "u")
        if large:
            out = near.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = (near.where("v < u").select(F.col("v").alias("a"), F.col("m").alias("b"))
                   .union(low.where("m < u").select(F.col("u").alias("a"), F.col("m").alias("b"))))
        return out.where("a <> b").coalesce(parts)

    mark = None
    while True:
        now = state.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if now == mark or now.n == 0:
            break
        mark = now
        state = checkpointed(star(star(state, True), False).distinct().coalesce(parts))
    return state.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def drop_rows(docs: DataFrame, keys: list[Column], lost: DataFrame, again: DataFrame, small: int = 500_000) -> DataFrame:
    """``docs`` without the rows whose keys are in ``lost``; of the rows whose keys are in ``again`` one stays.

    ``lost`` and ``again`` have the key values in their columns, in order.  Both
    are written and counted: a small one is broadcast, a larger one shuffled.
    """
    names = [f"__row_key_{k}" for k in range(len(keys))]
    marked = docs.withColumns(dict(zip(names, keys)))
    again = checkpointed(again.toDF(*names))
    out = checkpointed(lost.toDF(*names).union(again))
    rest = marked.join(when_small(out, small), names, "left_anti")
    if not again.isEmpty():
        rest = rest.unionByName(marked.join(when_small(again, small), names, "left_semi").dropDuplicates(names))
    return rest.drop(*names)
