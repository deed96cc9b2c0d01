"""A bit filter of fixed size of the 64-bit codes that several rows hold, whatever the corpus.

Tasks send the distinct codes of their rows as packed 32-bit lists by shard; a shard's task
marks two bits for each code that came twice.  Codes that share shard and rest by chance only
let more through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

FLUSH = 2_000_000
SHARD_CODES = 4_000_000


def _split(h: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard (leading bits) and the 32 bits after them."""
    lead = shards.bit_length() - 1
    shard = (h >> np.uint64(64 - lead)).astype(np.int64) if lead else np.zeros(len(h), np.int64)
    return shard, ((h << np.uint64(lead)) >> np.uint64(32)).astype(np.uint32)


def _slots(r: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    shift = np.uint32(32 - (width.bit_length() - 1))
    return (r >> shift).astype(np.int64), ((r * np.uint32(0x9E3779B1)) >> shift).astype(np.int64)


def recurring_bits(rows: DataFrame, codes, expected: int, bits: int) -> tuple[int, np.ndarray]:
    """(shards, bits) of the codes that come twice; ``codes`` yields arrays of codes from the batches
    of a task, about ``expected`` codes come in all.  At most bits / 8 bytes reach the driver; few codes need fewer bits."""
    bits = min(bits, 1 << max(20, (32 * max(1, expected)).bit_length()))
    shards = min(1 << max(0, int(np.ceil(np.log2(max(1, expected / SHARD_CODES))))), bits // 64)
    width = bits // shards

    def gather(batches):
        held, count = [], 0

        def flush():
            h = np.sort(np.concatenate(held))
            head = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            many = np.diff(np.append(head, len(h))) > 1
            shard, rest = _split(h[head], shards)
            cut = np.searchsorted(shard, np.arange(shards + 1))
            used = [s for s in range(shards) if cut[s] < cut[s + 1]]
            return pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int64()), pa.array([rest[cut[s]:cut[s + 1]].tobytes() for s in used], pa.binary()),
                 pa.array([np.packbits(many[cut[s]:cut[s + 1]]).tobytes() for s in used], pa.binary())], names=["shard", "h", "many"])

        for h in codes(batches):
            if len(h):
                held.append(h)
                count += len(h)
            if count > FLUSH:
                yield flush()
                held.clear()
                count = 0
        if count:
            yield flush()

    def mark(key, t):
        lists = [np.frombuffer(x, np.uint32) for x in t.column("h").to_pylist()]
        many = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=len(x)).astype(bool)
                               for x, m in zip(lists, t.column("many").to_pylist())])
        r = np.concatenate(lists)
        order = np.argsort(r, kind="stable")
        r, many = r[order], many[order]
        many[1:] |= r[1:] == r[:-1]
        out = np.zeros(width, np.uint8)
        for slot in _slots(r[many], width):
            out[slot] = 1
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([np.packbits(out).tobytes()], pa.binary())})

    got = rows.mapInArrow(gather, "shard long, h binary, many binary").groupBy("shard").applyInArrow(mark, "shard long, bits binary").collect()
    out = np.zeros(bits // 8, np.uint8)
    for r in got:
        out[r.shard * width // 8:(r.shard + 1) * width // 8] = np.frombuffer(r.bits, np.uint8)
    return shards, out


def passes(found: tuple[int, np.ndarray], h: np.ndarray) -> np.ndarray:
    """Whether each code may be one that came twice."""
    shards, packed = found
    width = len(packed) * 8 // shards
    shard, rest = _split(h, shards)
    ok = np.ones(len(h), bool)
    for slot in _slots(rest, width):
        bit = shard * width + slot
        ok &= (packed[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1 == 1
    return ok
