"""Suffix-array dedup: blockwise suffix sorting with a difference cover.

A byte is removed when a ``WINDOW``-byte string over it also starts in a document
with a smaller id.  Equal texts are one class first (all but the smallest id are
removed whole).  For the rest:

1. *Buckets.*  A window belongs to the bucket of its probe, the ``PROBE``-byte string in
   it with the least hash; equal windows have equal probes.  Sorted probe
   lists are merged by hash ranges in Spark; the probes that occur in two rows set bits of a
   fixed-size filter (a false bit costs work, never a result).
2. *Contexts.*  Each run of windows with one passing probe leaves its document as one
   short byte string.  A task sends the bytes of a context once (and again for a smaller id), so
   copies, or a passage in a third of all documents, are aggregated before they are dealt.
3. *Suffix sort.*  A task holds all contexts of its buckets.  A bucket with a single context
   is sorted as it is.  The contexts of the others are laid out in one text, with the
   probes on multiples of the period.  The suffixes at the places of a difference cover are ranked by
   their prefixes once; then one bucket of window suffixes is sorted at a time (split by leading
   bytes, at most ``BLOCK`` suffixes): by the first 32 bytes, long ties by the cover rank at the
   next place where both suffixes are sampled.  Neighbours that agree in a whole window form a
   group with its smallest id.
4. *Removal.*  The runs of windows that a smaller id holds go back to the documents, where
   they are merged and cut.

Memory is bounded by the size of a task's contexts (``TASK_CONTEXTS``) and ``BLOCK``.

Defined cases: null text is empty; a null id is larger than every id; rows with equal
ids never remove from each other; texts shorter than a window stay; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from threadline.llm.common import (BYTE_CODE, as_int64, checkpointed, documents, list_column, mix, powers, prefix_hash,
                                   range_hash, slices, sliding, small_batches, text_bytes, when_small)

WINDOW = 50
PROBE = 20
#: A difference cover: every residue is a difference of two of its members.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
RANK_WORDS = 7  # sampled suffixes are ranked by 56 bytes
BLOCK = 250_000
TASK_CONTEXTS = 40_000
SEEN = 300_000
FILTER_BITS = 1 << 27
FLUSH = 2_000_000
SHARD_PROBES = 4_000_000
BROADCAST_ROWS = 500_000
SALTS = 16
_NO_ID = 2**63 - 1

_next = np.array([min((c - r) % PERIOD for c in COVER) for r in range(PERIOD)])
_both = np.array([[min((c - r) % PERIOD for c in COVER if (c - r + s) % PERIOD in COVER) for s in range(PERIOD)]
                  for r in range(PERIOD)])


def _probes(data, offs, window, probe):
    """Runs of neighbouring windows with one probe: first window, windows, probe place, probe hash, text, prefix hashes."""
    n = len(data)
    if n < window:
        z = np.zeros(0, np.int64)
        return z, z, z, z.view(np.uint64), z, np.zeros(1, np.uint64)
    prefix = prefix_hash(BYTE_CODE[data])
    d = (prefix[probe:] - prefix[:-probe]) * powers(len(prefix))[1][:n - probe + 1]
    # order of the probes in the upper half, place in the lower: the least key is the leftmost least probe
    key = ((d ^ (d >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) & np.uint64(0xFFFFFFFF00000000)
    key |= np.arange(len(key), dtype=np.uint64)
    place = (sliding(key, window - probe + 1, np.minimum) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    whole = np.ones(len(place), bool)
    edge = np.zeros(len(place) + 1, np.int64)  # windows over the end of a text
    ends = offs[1:-1]
    np.add.at(edge, np.clip(ends - window + 1, 0, len(place)), 1)
    np.add.at(edge, np.clip(ends, 0, len(place)), -1)
    whole = np.cumsum(edge)[:-1] == 0
    start = whole.copy()
    start[1:] &= ~(whole[:-1] & (place[1:] == place[:-1]))
    first = np.flatnonzero(start)
    count = np.bincount((np.cumsum(start) - 1)[whole], minlength=len(first))
    at = place[first]
    return first, count, at, mix(d[at]), np.searchsorted(offs, first, side="right") - 1, prefix


def _split_hash(h: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard (leading bits) and the 32 bits after them."""
    lead = shards.bit_length() - 1
    shard = (h >> np.uint64(64 - lead)).astype(np.int64) if lead else np.zeros(len(h), np.int64)
    return shard, ((h << np.uint64(lead)) >> np.uint64(32)).astype(np.uint32)


def _slots(r: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a 32-bit rest in a shard's run of the filter."""
    shift = np.uint32(32 - (width.bit_length() - 1))
    return (r >> shift).astype(np.int64), ((r * np.uint32(0x9E3779B1)) >> shift).astype(np.int64)


def recurring_filter(rows: DataFrame, window: int, probe: int, bits: int) -> tuple[int, np.ndarray, int]:
    """(shards, bits, n): two bits for each probe that two rows hold (bits / 8 bytes, whatever the
    corpus), and how many list entries such probes have."""
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = 1 << max(0, int(np.ceil(np.log2(max(1, total * 0.08 / SHARD_PROBES)))))
    shards = min(shards, bits // 64)
    width = bits // shards  # a shard owns one run of the bits

    def gather(batches):
        held, count = [], 0

        def flush():
            h = np.sort(np.concatenate(held))
            head = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            many = np.diff(np.append(head, len(h))) > 1
            shard, rest = _split_hash(h[head], shards)
            cut = np.searchsorted(shard, np.arange(shards + 1))
            used = [s for s in range(shards) if cut[s] < cut[s + 1]]
            return pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int64()), pa.array([rest[cut[s]:cut[s + 1]].tobytes() for s in used], pa.binary()),
                 pa.array([np.packbits(many[cut[s]:cut[s + 1]]).tobytes() for s in used], pa.binary())], names=["shard", "h", "many"])

        for b in batches:
            data, offs = text_bytes(b.column("text"))
            for i, j in slices(offs):
                _, _, _, h, doc, _ = _probes(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], window, probe)
                if not len(h):
                    continue
                order = np.argsort(h, kind="stable")  # a text counts once per probe
                order = order[np.argsort(doc[order], kind="stable")]
                h, doc = h[order], doc[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                held.append(h[new])
                count += int(new.sum())
                if count > FLUSH:
                    yield flush()
                    held, count = [], 0
        if count:
            yield flush()

    def mark(key, t):
        lists = [np.frombuffer(x, np.uint32) for x in t.column("h").to_pylist()]
        many = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=len(x)).astype(bool)
                               for x, m in zip(lists, t.column("many").to_pylist())])
        r = np.concatenate(lists)
        order = np.argsort(r, kind="stable")
        r, many = r[order], many[order]
        same = np.zeros(len(r), bool)
        same[1:] = r[1:] == r[:-1]
        out = np.zeros(width, np.uint8)
        for slot in _slots(r[same | many], width):
            out[slot] = 1
        entries = int((same | many).sum() + (same[1:] & ~same[:-1] & ~many[:-1]).sum())
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "n": pa.array([entries], pa.int64()),
                         "bits": pa.array([np.packbits(out).tobytes()], pa.binary())})

    got = (rows.select("text").mapInArrow(gather, "shard long, h binary, many binary")
           .groupBy("shard").applyInArrow(mark, "shard long, n long, bits binary").collect())
    out = np.zeros(bits // 8, np.uint8)
    for r in got:
        out[r.shard * width // 8:(r.shard + 1) * width // 8] = np.frombuffer(r.bits, np.uint8)
    return shards, out, sum(r.n for r in got)


class Runs:
    """Runs of windows whose probe passes the filter, for the texts of a slice."""

    def __init__(self, raw, offs, window, probe, shards, packed):
        first, count, at, h, doc, prefix = _probes(raw, offs, window, probe)
        width = len(packed) * 8 // shards
        shard, rest = _split_hash(h, shards)
        ok = np.ones(len(h), bool)
        for slot in _slots(rest, width):
            bit = shard * width + slot
            ok &= (packed[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1 == 1
        self.start, self.size, self.at, self.h, self.doc = first[ok], count[ok] + window - 1, at[ok], h[ok], doc[ok]
        self.cid = as_int64(range_hash(prefix, self.start, self.start + self.size))


def context_places(rows: DataFrame, window: int, probe: int, shared) -> DataFrame:
    """(cid, k, id, t32, a0): every context of every row; cid and k are 80 bits of hash of its bytes
    and its probe, a0 is its place."""
    def rows_of(batches):
        shards, packed, _ = shared.value
        for b in batches:
            data, offs = text_bytes(b.column("text"))
            ids, ths = b.column("id").to_numpy(), b.column("t32").to_numpy()
            for i, j in slices(offs):
                o = offs[i:j + 1] - offs[i]
                r = Runs(data[offs[i]:offs[j]], o, window, probe, shards, packed)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r.cid), pa.array(_check16(r.h)), pa.array(ids[i + r.doc]), pa.array(ths[i + r.doc]),
                     pa.array((r.start - o[r.doc]).astype(np.int32))], names=["cid", "k", "id", "t32", "a0"])

    return rows.select("id", "t32", "text").mapInArrow(rows_of, "cid long, k short, id long, t32 int, a0 int")


def _check16(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(0xFFFF)).astype(np.uint16).view(np.int16)


def distinct_contexts(rows: DataFrame, window: int, probe: int, shared, tasks: int) -> DataFrame:
    """(task, id, ctx): the bytes of each context once per map task, and again for a smaller id.

    Copies are so aggregated before they are dealt; the task follows from the probe.
    """
    def rows_of(batches):
        shards, packed, _ = shared.value
        least: dict[int, int] = {}
        for b in batches:
            data, offs = text_bytes(b.column("text"))
            ids = b.column("id").to_numpy()
            for i, j in slices(offs):
                raw, o = data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
                r = Runs(raw, o, window, probe, shards, packed)
                own = ids[i + r.doc]
                fresh = np.zeros(len(own), bool)
                for k, (c, x) in enumerate(zip(r.cid.tolist(), own.tolist())):
                    if least.get(c, _NO_ID + 1) > x:
                        least[c] = x
                        fresh[k] = True
                if len(least) > SEEN:
                    least.clear()
                start, size, own = r.start[fresh], r.size[fresh], own[fresh]
                to = np.zeros(len(size) + 1, np.int32)
                np.cumsum(size, out=to[1:])
                take = np.arange(int(to[-1])) - np.repeat(to[:-1], size) + np.repeat(start, size)
                ctx = pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(to), pa.py_buffer(raw[take])])
                task = (mix(r.h[fresh]) % np.uint64(tasks)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(task), pa.array(own), ctx], names=["task", "id", "ctx"])

    return rows.select("id", "text").mapInArrow(rows_of, "task int, id long, ctx binary")


def _words(windows8: np.ndarray, pos: np.ndarray, k: int) -> np.ndarray:
    """Bytes 8k .. 8k+7 after each place, as numbers that sort like the bytes."""
    return np.ascontiguousarray(windows8[pos + 8 * k]).view(">u8").ravel().astype(np.uint64)


def window_groups(text: np.ndarray, starts: np.ndarray, sampled: np.ndarray, window: int = WINDOW, block: int = BLOCK):
    """Sort the suffixes at ``starts`` block by block; yields (places in starts, head flags): equal
    windows are neighbours, a head flag begins each group.

    ``sampled``: where cover places are to be ranked (all places that a suffix in ``starts`` can reach);
    the text ends with at least 128 filler bytes.
    """
    eight = np.lib.stride_tricks.sliding_window_view(text, 8)
    in_cover = np.zeros(PERIOD, bool)
    in_cover[list(COVER)] = True
    place = np.flatnonzero(sampled)
    place = place[in_cover[place % PERIOD]]
    keys = [_words(eight, place, k) for k in range(RANK_WORDS)]
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(place), bool)
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    rank = np.zeros(len(text), np.int32)
    rank[place[order]] = np.cumsum(new)
    del keys, order, new

    first = _words(eight, starts, 0)
    splits = np.unique(np.sort(first)[block::block])
    bucket = np.searchsorted(splits, first, side="right")
    rest, tail = divmod(window, 8)
    for b in range(len(splits) + 1):
        pick = np.flatnonzero(bucket == b)
        if not len(pick):
            continue
        pos = starts[pick]
        head = [first[pick]] + [_words(eight, pos, k) for k in range(1, 4)]
        residue = pos % PERIOD
        order = np.lexsort((rank[pos + _next[residue]], *head[::-1]))
        tied = np.ones(len(pick), bool)  # the same 32 bytes as the suffix before
        tied[0] = False
        for k in head:
            tied[1:] &= k[order][1:] == k[order][:-1]
        odd = np.zeros(len(pick), bool)
        odd[1:] = tied[1:] & (residue[order][1:] != residue[order][:-1])
        group = np.cumsum(~tied) - 1
        for g in np.unique(group[odd]):  # ties between places that are not aligned: compare in pairs
            run = np.flatnonzero(group == g) if len(group) < 1000 else np.arange(*np.searchsorted(group, [g, g + 1]))

            def compare(x, y):
                d = _both[residue[x], residue[y]]
                return int(rank[pos[x] + d]) - int(rank[pos[y] + d])
            order[run] = sorted(order[run].tolist(), key=functools.cmp_to_key(compare))
        pos = pos[order]
        same = np.ones(len(pos), bool)
        same[0] = False
        for k in range(rest):
            w = _words(eight, pos, k)
            same[1:] &= w[1:] == w[:-1]
        if tail:
            w = _words(eight, pos, rest) >> np.uint64(8 * (8 - tail))
            same[1:] &= w[1:] == w[:-1]
        yield pick[order], ~same


def smallest_ids(data: np.ndarray, offs: np.ndarray, at: np.ndarray, ids: np.ndarray, window: int = WINDOW, block: int = BLOCK):
    """(context of each window, place in it, smallest id of an equal window) over contexts data[offs]."""
    size = np.diff(offs)
    room = -(-(size + 64 + PERIOD) // PERIOD) * PERIOD
    base = np.cumsum(room) - room + (-at) % PERIOD
    text = np.zeros(int(room.sum()) + 128, np.uint8)
    to = np.repeat(base, size) + np.arange(len(data)) - np.repeat(offs[:-1], size)
    text[to] = data
    sampled = np.zeros(len(text), bool)
    sampled[to] = True
    n_win = size - window + 1
    ctx = np.repeat(np.arange(len(size)), n_win)
    off = np.arange(len(ctx)) - np.repeat(np.cumsum(n_win) - n_win, n_win)
    least = np.empty(len(ctx), np.int64)
    for pick, head in window_groups(text, base[ctx] + off, sampled, window, block):
        begin = np.flatnonzero(head)
        low = np.minimum.reduceat(ids[ctx[pick]], begin)
        least[pick] = np.repeat(low, np.diff(np.append(begin, len(pick))))
    return ctx, off, least


def removed_spans(rows: DataFrame, window: int = WINDOW, probe: int = PROBE, bits: int = FILTER_BITS) -> DataFrame:
    """(id, t32, spans): byte runs that a smaller id holds, each packed as start * 2**32 + end."""
    found = recurring_filter(rows, window, probe, bits)
    tasks = max(1, -(-found[2] // TASK_CONTEXTS))
    shared = rows.sparkSession.sparkContext.broadcast(found)

    def sort(t):
        data, offs = text_bytes(t.column("ctx").combine_chunks())
        ids = t.column("id").to_numpy()
        # a context is one run of windows with one probe: recomputed from its bytes
        start, _, at, h, _, prefix = _probes(data, offs, window, probe)
        cid = as_int64(range_hash(prefix, offs[:-1], offs[1:]))
        order = np.lexsort((ids, cid, h))
        new = np.ones(len(order), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (cid[order][1:] != cid[order][:-1])
        one = order[new]  # each context once, with its smallest id
        h, cid, ids, at, start, size = h[one], cid[one], ids[one], (at - start)[one], start[one], np.diff(offs)[one]
        head = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        of_bucket = np.diff(np.append(head, len(h)))
        alone = np.repeat(of_bucket, of_bucket) == 1
        # the only context of its bucket: its windows occur in no other
        k = np.flatnonzero(alone)
        parts = [(k, np.zeros(len(k), np.int64), size[k], ids[k])]
        several = np.flatnonzero(~alone)
        if len(several):
            o = np.concatenate([[0], np.cumsum(size[several])])
            take = np.arange(int(o[-1])) - np.repeat(o[:-1], size[several]) + np.repeat(start[several], size[several])
            ctx, off, low = smallest_ids(data[take], o, at[several], ids[several], window)
            first = np.ones(len(ctx), bool)
            first[1:] = (ctx[1:] != ctx[:-1]) | (low[1:] != low[:-1])
            begin = np.flatnonzero(first)
            length = np.diff(np.append(begin, len(ctx)))
            parts.append((several[ctx[begin]], off[begin], off[begin] + length - 1 + window, low[begin]))
        c, s, e, low = (np.concatenate(x) for x in zip(*parts))
        return pa.table({"cid": pa.array(cid[c]), "k": pa.array(_check16(h[c])), "s": pa.array(s.astype(np.int32)),
                         "e": pa.array(e.astype(np.int32)), "low": pa.array(low)})

    owned = (distinct_contexts(rows, window, probe, shared, tasks).groupBy("task")
             .applyInArrow(sort, "cid long, k short, s int, e int, low long"))
    return (context_places(rows, window, probe, shared).join(owned, ["cid", "k"]).where("id > low")
            .groupBy("id", "t32").agg(F.collect_set(F.shiftleft((F.col("a0") + F.col("s")).cast("long"), 32)
                                                    + F.col("a0") + F.col("e")).alias("spans")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   probe: int = PROBE, bits: int = FILTER_BITS) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (flat start, end pairs, merged)."""
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    base = checkpointed(rows.select("id", "th", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")))
    classes = checkpointed(base.where(F.col("n_bytes") >= window).groupBy("sha", "n_bytes")
                           .agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
                           .select("sha", "n_bytes", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    salted = base.withColumn("salt", F.pmod(F.xxhash64("id", "th"), F.lit(SALTS)).cast("int"))
    marked = checkpointed(salted.join(classes, ["sha", "n_bytes", "salt"], "left")
                          .select("id", "th", "n_bytes", "sha", (F.coalesce(F.col("id") > F.col("first"), F.lit(False))).alias("copy")))
    copies = checkpointed(marked.where("copy").select("id", "th").distinct())
    # ids repeat in odd tables only; 32 bits of the text hash tell such rows apart
    low32 = F.col("th").bitwiseAND(F.lit(2**32 - 1)) - F.lit(2**31)
    live = (rows.where(F.octet_length("text") >= window).join(when_small(copies, BROADCAST_ROWS), ["id", "th"], "left_anti")
            .select("id", low32.cast("int").alias("t32"), "text"))
    spans = checkpointed(removed_spans(live, window, probe, bits))

    def cut(batches):
        for b in batches:
            data, offs = text_bytes(b.column("text"))
            flat, soffs = list_column(b.column("spans"))
            removed, shas, runs = [], [], []
            for k in range(len(offs) - 1):
                raw = data[offs[k]:offs[k + 1]]
                mine = flat[soffs[k]:soffs[k + 1]]
                depth = np.zeros(len(raw) + 1, np.int64)
                np.add.at(depth, mine >> 32, 1)
                np.add.at(depth, mine & (2**32 - 1), -1)
                gone = np.cumsum(depth)[:-1] > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                removed.append(int(gone.sum()))
                runs.append(edge.tolist())
                shas.append(hashlib.sha256(raw[~gone].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("th"), pa.array(removed, pa.int64()), pa.array(shas, pa.string()),
                 pa.array(runs, pa.list_(pa.int64()))], names=["id", "th", "n_removed", "kept", "spans"])

    keyed = rows.withColumn("t32", low32.cast("int"))
    touched = keyed.join(when_small(spans.select("id", "t32"), BROADCAST_ROWS), ["id", "t32"], "left_semi")
    done = (touched.dropDuplicates(["id", "t32"]).join(spans, ["id", "t32"]).select("id", "th", "text", "spans")
            .mapInArrow(cut, "id long, th long, n_removed long, kept string, spans array<long>"))
    copy, none = F.col("copy"), F.lit(0).cast("long")
    return (marked.join(done, ["id", "th"], "left")
            .select(F.when(F.col("id") != _NO_ID, F.col("id")).alias("doc_id"), "n_bytes",
                    F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", none)).alias("n_removed"),
                    F.when(copy, F.lit(1).cast("long")).otherwise(F.coalesce(F.expr("size(spans) div 2"), none)).alias("n_spans"),
                    F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
                    F.when(copy, F.array(none, F.col("n_bytes"))).otherwise(F.coalesce("spans", F.array().cast("array<long>"))).alias("spans")))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).drop("spans")
