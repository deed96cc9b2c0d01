"""N-gram Jaccard join by T-occurrence search (DivideSkip), linked into components.

A document is the set of its distinct ``SHINGLE``-word shingles (64-bit hashes).
Documents with equal sets are one class; classes are linked when their
Jaccard similarity is at least ``NUM / DEN``.

Routing.  Linked sets of at most ``u`` shingles differ in at most ``H = 2u(DEN-NUM)/(DEN+NUM)``
of them.  Sets are grouped by size, the hash space is cut into ``H + 1`` parts, and a
signature is the hash of what a set has in one part: linked sets agree in a part, so
they meet under a signature.  A signature covers all shingles of its part, so a passage
that many documents share does not bring them together.  Empty parts are left out;
where parts are few, several independent cuts are made, which keeps the chance
that linked sets meet in empty parts only below one in 10**9.

T-occurrence search.  Classes that signatures join, directly or not, are a family; a
family of bounded size is a block.  In larger ones the smallest class under each signature
is its hub, every class joins the block of its smallest hub, and blocks are cut by
their sets and shingles.  Inside a block an inverted index is searched for each set: lists are ordered by length, the
short ones are merged and counted, candidates that can still reach the
required overlap are probed in the long lists by binary search (DivideSkip), and those
reaching it are linked.  Classes already in one component are not compared again, so a
group of near copies costs about one search each, never all pairs.

In ``MERGE_ROUNDS`` further rounds classes join the block of their smallest hub in
another component, which gathers the parts of a large group at linear cost.

Rest.  Signatures that still join different components give the remaining
candidates.  A class that meets a large component is searched in blocks of that
component's sets, so a group of near copies is never spelled out as pairs.  The remaining classes
of small components are routed anew by their rarest shingles: linked sets share one of
the shingles beyond the required overlap, so sets of one template, whose rare
shingles differ, do not meet.  What one rare shingle brings together is a block; a block of more
than ``BLOCK_SETS`` sets becomes pairs of bounded parts; sets without a partner in their block by
size and parity sketch leave it before the search.  No link between components can be
lost, and components are all that is reported.

Signatures are emitted in two passes over the texts: the first fills a bit filter of fixed size with
those that come twice, the second emits just what passes, each with the size and a parity sketch of its
set.  A class that no other one under a signature can be linked with by both leaves it, so sets, families
and blocks are made of likely partners only.

Defined cases: null or blank text has no shingles and links with nothing; fewer than
``SHINGLE`` words are one shingle; repeated rows belong to one class; null ids are larger
than every id; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from threadline.llm.common import (LOWER, as_int64, checkpointed, compact, components, documents, drop_rows, list_column, mix, prefix_hash, range_hash, release, slices,
                                   small_batches, sorted_groups, text_bytes, to_lists, when_small, word_hashes, word_spans)
from threadline.llm.recurring import passes, recurring_bits

SHINGLE = 4
NUM, DEN = 85, 100
GROWTH = 1.4
BLOCK_SHINGLES = 1_500_000
BLOCK_SETS = 1000
LARGE = 1000
MERGE_ROUNDS = 1
MU = 0.01  # DivideSkip's weight of a probe against a merge step
BROADCAST_ROWS = 500_000
FILTER_BITS = 1 << 27
SKETCH_BITS = 512
COPY_BYTES = 128  # of all sketches sent with a set's signatures, per shingle
COPY_POWER = 14
COUNT_SLOTS = 1 << 22
SALTS = 16
_NO_ID = 2**63 - 1


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the sorted distinct shingles of each text."""
    n = len(offs) - 1
    start, end, doc = word_spans(data, offs)
    count = np.bincount(doc, minlength=n)
    h = word_hashes(LOWER[data], start, end)
    prefix = prefix_hash(h)
    first = np.cumsum(count) - count
    made = np.where(count > 0, np.maximum(count - k + 1, 1), 0)
    owner = np.repeat(np.arange(n), made)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(made) - made, made) + first[owner]
    s = range_hash(prefix, at, at + np.minimum(count[owner], k))
    order = np.argsort(s, kind="stable")
    order = order[np.argsort(owner[order], kind="stable")]
    s, owner = s[order], owner[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (owner[1:] != owner[:-1])
    s, owner = s[new], owner[new]
    out = np.zeros(n + 1, np.int64)
    np.cumsum(np.bincount(owner, minlength=n), out=out[1:])
    return s, out


class Bounds:
    """Everything that follows from the similarity num / den."""

    def __init__(self, num: int = NUM, den: int = DEN):
        self.num, self.den = num, den
        tops = [1]
        while tops[-1] < 2**40:
            tops.append(max(tops[-1] + 1, math.floor(tops[-1] * GROWTH)))
        self.tops = np.array(tops, np.int64)

    def overlap(self, a, b):
        """Least common shingles of linked sets of sizes a and b."""
        return -(-self.num * (a + b) // (self.num + self.den))

    def difference(self, total):
        """Most differing shingles of linked sets whose sizes add up to total."""
        return (self.den - self.num) * total // (self.den + self.num)

    def group(self, size):
        return np.searchsorted(self.tops, size)

    def parts(self, group):
        return self.difference(2 * self.tops[group]) + 1

    @staticmethod
    def cuts(parts):
        """Independent cuts of the hash space by the number of parts."""
        return np.select([parts == 1, parts <= 3, parts <= 6, parts <= 12, parts <= 24], [1, 8, 4, 3, 2], 1)


def signatures(s: np.ndarray, offs: np.ndarray, wanted: np.ndarray, bounds: Bounds) -> tuple[np.ndarray, np.ndarray]:
    """(signatures, count per set): for the wanted sets, in their own size group and, where a
    linked set may be in it, in the next one."""
    sig, owner, _ = grouped_signatures(s, offs, wanted, bounds)
    return sig, np.bincount(owner, minlength=len(offs) - 1)


def grouped_signatures(s: np.ndarray, offs: np.ndarray, wanted: np.ndarray, bounds: Bounds) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signatures, set, size group) in the order of the sets, see :func:`signatures`."""
    size = np.diff(offs)
    own = bounds.group(size)
    out, owner, group = [], [], []
    for step in (0, 1):
        g = own + step
        use = wanted & (size > 0)
        if step:
            use &= size * bounds.den // bounds.num > bounds.tops[own]
        parts = bounds.parts(g)
        cuts = bounds.cuts(parts)
        for c in range(8):
            sets = np.flatnonzero(use & (cuts > c))
            if not len(sets):
                break
            n_part = parts[sets]
            base = np.cumsum(n_part) - n_part
            which = np.repeat(np.arange(len(sets)), size[sets])
            take = np.arange(len(which)) - np.repeat(np.cumsum(size[sets]) - size[sets], size[sets]) + offs[sets][which]
            h = mix(s[take] + np.uint64(0x632BE59BD9B4E019 * (c + 1) % 2**64))
            slot = base[which] + ((h >> np.uint64(32)).astype(np.int64) * n_part[which] >> 32)
            code = mix(h ^ np.uint64(0xA0761D6478BD642F))
            total = int(n_part.sum())
            # exact in float64: 32-bit halves, fewer than 2**20 shingles in a part
            lo = np.bincount(slot, (code & np.uint64(0xFFFFFFFF)).astype(np.float64), total).astype(np.uint64)
            hi = np.bincount(slot, (code >> np.uint64(32)).astype(np.float64), total).astype(np.uint64)
            full = np.bincount(slot, minlength=total) > 0
            which_set = np.repeat(np.arange(len(sets)), n_part)
            part = np.arange(total) - base[which_set]
            label = (g[sets][which_set].astype(np.uint64) << np.uint64(40)) + (np.uint64(c) << np.uint64(36)) + part.astype(np.uint64)
            sig = mix(mix(lo + np.uint64(0x8EBC6AF09C88C6E3)) + hi * np.uint64(0x589965CC75374CC3) + mix(label))
            out.append(sig[full])
            owner.append(sets[which_set][full])
            group.append(g[sets][which_set][full])
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    sig, owner, group = np.concatenate(out), np.concatenate(owner), np.concatenate(group)
    order = np.argsort(owner, kind="stable")
    return sig[order], owner[order], group[order]


def set_class(s: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set (0 for empty ones); equal sets have equal names."""
    total = np.zeros(len(s) + 1, np.uint64)
    np.cumsum(mix(s ^ np.uint64(0xE7037ED1A0B428DB)), out=total[1:])
    name = mix(total[offs[1:]] - total[offs[:-1]] + np.diff(offs).astype(np.uint64))
    return np.where(np.diff(offs) > 0, name | np.uint64(1), np.uint64(0))


def sketch(s: np.ndarray, bounds: Bounds) -> bytes:
    """Parities of the shingles in a power of two of hash slots, six per allowed difference at least.

    The Hamming distance of two sketches never exceeds the symmetric difference; a sketch is folded to the width of a narrower one.
    """
    bits = SKETCH_BITS
    while bits < 6 * bounds.difference(2 * len(s)):
        bits *= 2
    slot = (mix(s + np.uint64(0x9FB21C651E98DF25)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(slot, minlength=bits) & 1).astype(np.uint8)).tobytes()


def group_sketches(s: np.ndarray, offs: np.ndarray, sets: np.ndarray, group: np.ndarray, copies: np.ndarray, bounds: Bounds) -> pa.Array:
    """Parities as of :func:`sketch` of the given sets: four slots per allowed difference of the size group.

    A sketch that is sent in many ``copies`` is narrower, so that all of them stay in proportion to the set.
    """
    size = np.diff(offs)[sets]
    wide = np.ceil(np.log2(4 * bounds.difference(2 * bounds.tops[group]) + 1)).astype(np.int64)
    most = np.floor(np.log2(np.maximum(8 * COPY_BYTES * size // copies, 1))).astype(np.int64)
    bits = 2 ** np.clip(np.minimum(wide, most), 6, COPY_POWER)
    out = np.empty(len(sets), object)
    for w in np.unique(bits).tolist():
        at = np.flatnonzero(bits == w)
        row = np.repeat(np.arange(len(at)), size[at])
        take = np.arange(len(row)) - np.repeat(np.cumsum(size[at]) - size[at], size[at]) + np.repeat(offs[sets[at]], size[at])
        slot = (mix(s[take] + np.uint64(0x9FB21C651E98DF25)) & np.uint64(w - 1)).astype(np.int64)
        odd = (np.bincount(row * w + slot, minlength=len(at) * w) & 1).astype(np.uint8)
        packed = np.packbits(odd).tobytes()
        out[at] = [packed[k:k + w // 8] for k in range(0, len(packed), w // 8)]
    return pa.array(out, pa.binary())


def folded(sketches: list[bytes]) -> dict[int, np.ndarray]:
    """Matrices of sketches by width in words, each with the rows that are as wide or wider (others are zero)."""
    width = np.array([len(x) // 8 for x in sketches], np.int64)
    out: dict[int, np.ndarray] = {}
    for w in np.unique(width)[::-1].tolist():
        m = np.zeros((len(sketches), w), np.uint64)
        own = np.flatnonzero(width == w)
        m[own] = np.frombuffer(b"".join(sketches[k] for k in own), np.uint64).reshape(len(own), w)
        for v in np.unique(width[width > w]).tolist():
            wide = np.flatnonzero(width == v)
            m[wide] = np.bitwise_xor.reduce(np.frombuffer(b"".join(sketches[k] for k in wide), np.uint64).reshape(len(wide), v // w, w), axis=1)
        out[w] = m
    return out


def divide_skip(sets: list[np.ndarray], bounds: Bounds, find_all: bool = False, root: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links between sets (sorted distinct hashes) by T-occurrence search over an inverted index.

    By default just links that join components (a spanning forest over ``root``, the
    components so far); sets that are in the anchor's component when their turn comes need no
    search, as a link between two of them joins nothing.  ``find_all`` returns every linked pair.
    """
    n = len(sets)
    size = np.array([len(x) for x in sets], np.int64)
    flat = np.concatenate(sets)
    doc = np.repeat(np.arange(n), size)
    order = np.argsort(flat, kind="stable")  # lists hold documents in ascending order
    flat, doc = flat[order], doc[order]
    head = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    token = flat[head]
    length = np.diff(np.append(head, len(flat)))
    posting = np.repeat(np.arange(len(token)), length) * n + doc  # (list, document), ascending overall
    root = np.arange(n) if root is None else np.unique(root, return_inverse=True)[1]
    members = np.bincount(root, minlength=n)
    # sets without a search of their own are all in the component of the anchor
    anchor = int(np.argmax(root == members.argmax())) if members.max() > 1 else None
    links = []
    for q in range(n):
        if not find_all and anchor is not None and root[q] == root[anchor]:
            if members[root[anchor]] == n:
                break
            continue
        if anchor is None:
            anchor = q
        # the smallest partner needs the least overlap
        need = int(bounds.overlap(size[q], -(-size[q] * bounds.num // bounds.den)))
        lists = np.searchsorted(token, sets[q])
        lists = lists[np.argsort(length[lists], kind="stable")]
        longest = int(length[lists[-1]])
        if longest == 1:
            continue
        n_long = min(need - 1, int(need / (MU * math.log2(longest + 1) + 1)))
        short, long = lists[:len(lists) - n_long], lists[len(lists) - n_long:]
        size_s = length[short]
        at = np.arange(int(size_s.sum())) - np.repeat(np.cumsum(size_s) - size_s, size_s) + np.repeat(head[short], size_s)
        merged = np.bincount(doc[at], minlength=n)  # counting merge of the short lists
        ok = merged >= need - n_long
        ok &= (np.minimum(size, size[q]) * bounds.den >= np.maximum(size, size[q]) * bounds.num)
        ok[q] = False
        if find_all:
            ok[:q] = False
        else:
            ok &= root != root[q]
        cand = np.flatnonzero(ok)
        if not len(cand):
            continue
        probe = (long[None, :] * n + cand[:, None]).ravel()
        place = np.searchsorted(posting, probe)
        place[place == len(posting)] = 0
        hit = (posting[place] == probe).reshape(len(cand), n_long).sum(axis=1) if n_long else 0
        for c in cand[merged[cand] + hit >= bounds.overlap(size[q], size[cand])]:
            if find_all:
                links.append((q, int(c)))
            elif root[c] != root[q]:
                links.append((q, int(c)))
                old, new = sorted((root[q], root[c]), key=lambda r: members[r])
                root[root == old] = new
                members[new] += members[old]
                members[old] = 0
    return links


def _class_sets(batches, shingle: int):
    """(batch, first row, next row, shingles, offsets, class, first of its class in the task) of bounded slices."""
    seen: set[int] = set()
    for b in batches:
        data, offs = text_bytes(b.column("text"))
        for i, j in slices(offs):
            s, o = shingle_sets(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], shingle)
            cls = set_class(s, o)
            new = np.zeros(j - i, bool)
            for k, c in enumerate(cls.tolist()):
                if c and c not in seen:
                    seen.add(c)
                    new[k] = True
            yield b, i, j, s, o, cls, new


def profiles(docs: DataFrame, shingle: int) -> DataFrame:
    """Per row: id, th, n, cls."""
    def rows(batches):
        for b, i, j, _, o, cls, _ in _class_sets(batches, shingle):
            yield pa.RecordBatch.from_arrays([b.column("id").slice(i, j - i), b.column("th").slice(i, j - i),
                                              pa.array(np.diff(o), pa.int64()), pa.array(as_int64(cls))], names=["id", "th", "n", "cls"])

    return docs.mapInArrow(rows, "id long, th long, n long, cls long")


def recurring_signatures(docs: DataFrame, shingle: int, bounds: Bounds, bits: int = FILTER_BITS) -> DataFrame:
    """(sig, cls, n, sketch): signatures of the classes (once a task) that pass the filter of those that come twice."""
    def codes(batches):
        for _, _, _, s, o, _, new in _class_sets(batches, shingle):
            yield signatures(s, o, new, bounds)[0]

    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    found = docs.sparkSession.sparkContext.broadcast(recurring_bits(docs.select("text"), codes, int(total * 0.1), bits))

    def rows(batches):
        known = found.value
        for _, _, _, s, o, cls, new in _class_sets(batches, shingle):
            sig, owner, group = grouped_signatures(s, o, new, bounds)
            ok = passes(known, sig)
            sig, owner, group = sig[ok], owner[ok], group[ok]
            pair, at, copies = np.unique(owner * 256 + group, return_inverse=True, return_counts=True)
            sketches = group_sketches(s, o, pair // 256, pair % 256, copies, bounds)
            yield pa.RecordBatch.from_arrays([pa.array(as_int64(sig)), pa.array(as_int64(cls[owner])), pa.array(np.diff(o)[owner], pa.int64()),
                                              sketches.take(pa.array(at))], names=["sig", "cls", "n", "sketch"])

    return docs.select("text").mapInArrow(rows, "sig long, cls long, n long, sketch binary")


def _partnered(sig: np.ndarray, n: np.ndarray, sketches: list[bytes], bounds: Bounds) -> np.ndarray:
    """Which rows have another one under their signature whose size and sketch allow a link."""
    some = np.zeros(len(sig), bool)
    bits, width = folded(sketches), np.array([len(x) // 8 for x in sketches])
    at, step = np.arange(len(sig)), 0
    while len(at):  # every pair of rows of one signature, by their distance in the order
        step += 1
        at = at[at + step < len(sig)]
        at = at[sig[at + step] == sig[at]]
        i, j = at, at + step
        use = ~(some[i] & some[j]) & (np.minimum(n[i], n[j]) * bounds.den >= np.maximum(n[i], n[j]) * bounds.num)
        i, j = i[use], j[use]
        narrow = np.minimum(width[i], width[j])
        for w in np.unique(narrow).tolist():
            x, y = i[narrow == w], j[narrow == w]
            use = np.bitwise_count(bits[w][x] ^ bits[w][y]).sum(axis=1) <= bounds.difference(n[x] + n[y])
            some[x[use]] = some[y[use]] = True
    return some


def _shared(bounds: Bounds):
    """Signatures with two classes or more: (sig, cls, hub), from rows sorted by sig and cls.

    A class without a partner by size and sketch leaves the signature, so passages that sets
    without a link share bring nobody together.  A signature of more than ``BLOCK_SETS`` classes is passed on whole, batch by batch.
    """
    def made(sig, cls, hub):
        return pa.RecordBatch.from_arrays([pa.array(sig), pa.array(cls), pa.array(hub)], names=["sig", "cls", "hub"])

    def likely(parts):
        t = pa.Table.from_batches(parts)
        sig, cls, n = (t.column(c).to_numpy() for c in ("sig", "cls", "n"))
        some = _partnered(sig, n, t.column("sketch").to_pylist(), bounds)
        sig, cls = sig[some], cls[some]
        head = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])) if len(sig) else np.zeros(0, np.int64)
        return made(sig, cls, np.repeat(cls[head], np.diff(np.append(head, len(sig)))))

    def rows(batches):
        last = hub = None  # the last row; the hub of the last signature once it is a large one
        rest, held = [], 0  # rows of the last signature while it is not
        for b in batches:
            if not b.num_rows:
                continue
            sig, cls = b.column("sig").to_numpy(), b.column("cls").to_numpy()
            new = np.ones(len(sig), bool)
            new[1:] = (sig[1:] != sig[:-1]) | (cls[1:] != cls[:-1])
            if last is not None:
                new[0] = (sig[0], cls[0]) != last
            before, last = last, (sig[-1], cls[-1])
            b = b.filter(pa.array(new))
            if not b.num_rows:
                continue
            sig, cls = sig[new], cls[new]
            more = int(np.searchsorted(sig, before[0], side="right")) if before is not None else 0
            tail = int(np.searchsorted(sig, sig[-1]))
            if more < len(sig):  # the last signature ends here, and others up to the tail
                if hub is not None:
                    yield made(sig[:more], cls[:more], np.full(more, hub))
                    rest = [b.slice(more, tail - more)]
                else:
                    rest.append(b.slice(0, tail))
                yield likely(rest)
                rest, held, hub = [], 0, None
                b, sig, cls = b.slice(tail), sig[tail:], cls[tail:]
            if hub is None:
                rest.append(b)
                held += len(sig)
                if held > BLOCK_SETS:
                    hub = rest[0].column("cls")[0].as_py()
                    for x in rest:
                        yield made(x.column("sig").to_numpy(), x.column("cls").to_numpy(), np.full(x.num_rows, hub))
                    rest = []
            else:
                yield made(sig, cls, np.full(len(sig), hub))
        if rest:
            yield likely(rest)

    return rows


def _asked(rows: DataFrame) -> DataFrame:
    """(hub, cls): classes that meet a large component of another root under a signature (hub: that root).

    Of two large components the smaller one (by size, then name) asks the other.
    """
    large = rows.where(F.col("members") > LARGE).select("sig", F.col("root").alias("hub"), F.col("members").alias("size")).distinct()
    asks = (F.col("members") < F.col("size")) | ((F.col("members") == F.col("size")) & (F.col("root") > F.col("hub")))
    return rows.select("sig", "cls", "root", "members").join(large, "sig").where((F.col("root") != F.col("hub")) & asks).select("hub", "cls").distinct()


def _prefixed(classes: DataFrame, sets: DataFrame, bounds: Bounds) -> DataFrame:
    """(hub, chunk, cls, root, first): blocks of ``classes`` (cls, root) that share a rare shingle.

    A set of n shingles and a linked one share at least T of them, T by the smallest size that may be
    linked, so they share one of the n - T + 1 shingles rarest among these classes.
    """
    own = sets.select("cls", "n", "set").join(when_small(classes, BROADCAST_ROWS), "cls")
    # how often: counts in a table of fixed size, in which a shingle of one class alone may look frequent, never the reverse
    slot = F.pmod(F.col("s"), F.lit(COUNT_SLOTS))
    got = (own.select(F.explode("set").alias("s")).groupBy(slot.cast("int").alias("slot")).agg(F.count("*").alias("n"))
           .where("n > 1").toArrow())
    counts = np.zeros(COUNT_SLOTS, np.int32)
    counts[got.column("slot").to_numpy()] = np.minimum(got.column("n").to_numpy(), 2**31 - 1)
    shared = sets.sparkSession.sparkContext.broadcast(counts)

    def rare(batches):
        often = shared.value
        for b in batches:
            flat, offs = list_column(b.column("set"))
            first, n = offs[:-1] - offs[0], np.diff(offs)
            flat = flat[offs[0]:offs[-1]].view(np.uint64)
            owner = np.repeat(np.arange(len(n)), n)
            f = often[(flat & np.uint64(COUNT_SLOTS - 1)).astype(np.int64)]
            order = np.lexsort((flat, f, owner))
            least = -(-n * bounds.num // bounds.den)
            p = n - bounds.overlap(n, least) + 1
            place = np.arange(len(flat)) - first[owner]
            # shingles of one class alone come first and meet nobody
            use = (place < p[owner]) & (f[order] > 0)
            at = owner[use]
            yield pa.RecordBatch.from_arrays(
                [pa.array(as_int64(flat[order][use])), b.column("cls").take(pa.array(at)), b.column("root").take(pa.array(at)),
                 pa.array(n[at].astype(np.int64))], names=["hub", "cls", "root", "n"])

    rare = own.select("cls", "root", "set").mapInArrow(rare, "hub long, cls long, root long, n long")
    return _parted(checkpointed(rare))


def _parted(rows: DataFrame) -> DataFrame:
    """(hub, chunk, cls, root, first) of (hub, cls, root, n): a block per hub with several roots; parts of a large one meet in pairs of parts."""
    parts = F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("long")
    meet = rows.groupBy("hub").agg(parts.alias("parts"), F.min("root").alias("a"), F.max("root").alias("z"))
    met = rows.join(meet.where("a <> z").select("hub", "parts"), "hub").withColumn("part", F.pmod(F.xxhash64("cls"), F.col("parts")))
    pairs = met.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    chunk = F.least("part", "other") * F.col("parts") + F.greatest("part", "other")
    return pairs.select("hub", chunk.alias("chunk"), "cls", "root", F.lit(False).alias("first"))


def _dealt(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(hub, cls) members with a chunk each, so that a block has a bounded number of sets and shingles."""
    if "n" not in members.columns:
        members = compact(sets.select("cls", "n").join(when_small(members, BROADCAST_ROWS), "cls"))
    load = (members.groupBy("hub")
            .agg(F.greatest(F.ceil(F.sum("n") / BLOCK_SHINGLES), F.ceil(F.count("*") / BLOCK_SETS)).cast("long").alias("chunks")))
    return members.join(load, "hub").select("hub", F.pmod(F.xxhash64("cls"), F.col("chunks")).alias("chunk"), "cls", "chunks")


def _searched(placed: DataFrame, sets: DataFrame, bounds: Bounds) -> DataFrame:
    """Edges found in blocks of (hub, chunk, cls, root, first); what is first is searched first."""
    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("first", ascending=False, kind="stable")
        cls = pdf["cls"].to_numpy()
        links = divide_skip([np.asarray(x, np.int64).view(np.uint64) for x in pdf["set"]], bounds, root=pdf["root"].to_numpy())
        return pd.DataFrame({"a": [cls[x] for x, _ in links], "b": [cls[y] for _, y in links]}, dtype="int64")

    return (sets.select("cls", "set").join(when_small(compact(placed), BROADCAST_ROWS), "cls")
            .groupBy("hub", "chunk").applyInPandas(search, "a long, b long"))


def _linked(members: DataFrame, sets: DataFrame, bounds: Bounds) -> DataFrame:
    """Edges found in the blocks of (hub, cls) rows; big blocks are cut, each part with its hub."""
    dealt = _dealt(compact(members.where("hub <> cls")), sets).select("hub", "chunk", "cls")
    placed = dealt.union(dealt.select("hub", "chunk", F.col("hub").alias("cls")).distinct())
    return _searched(placed.select("*", F.col("cls").alias("root"), (F.col("cls") == F.col("hub")).alias("first")), sets, bounds)


def _open(shared: DataFrame, part: DataFrame) -> DataFrame:
    """(sig, cls, root, members, hub, hub_root) under the signatures that join several components of ``part``."""
    sizes = part.groupBy("root").agg(F.count("*").alias("members"))
    roots = compact(part.join(sizes, "root").select(F.col("node").alias("cls"), "root", "members"))
    # classes are joined, not their signatures
    rows = (shared.groupBy("cls").agg(F.collect_list("sig").alias("sigs")).join(when_small(roots, BROADCAST_ROWS), "cls", "left").select(
        F.explode("sigs").alias("sig"), "cls", F.coalesce("root", "cls").alias("root"), F.coalesce("members", F.lit(1).cast("long")).alias("members")))
    mixed = compact(rows.groupBy("sig").agg(F.min("root").alias("a"), F.max("root").alias("z"), F.min(F.struct("cls", "root")).alias("hub"))
                         .where("a <> z").select("sig", F.col("hub.cls").alias("hub"), F.col("hub.root").alias("hub_root")))
    return compact(rows.join(when_small(mixed, BROADCAST_ROWS), "sig"))


def _likely(bounds: Bounds):
    """Of the classes of each block, those with a partner whose size and sketch allow a link; hub becomes the least of them."""
    def rows(batches):
        for t in sorted_groups(batches, "g"):
            g, root, n = (t.column(c).to_numpy() for c in ("g", "root", "n"))
            sketches = t.column("sketch").to_pylist()
            bits, width = folded(sketches), np.array([len(x) // 8 for x in sketches])
            some = np.zeros(len(g), bool)
            at, step = np.arange(len(g)), 0
            while len(at):  # every pair of rows of one block, by their distance in the order
                step += 1
                at = at[at + step < len(g)]
                at = at[g[at + step] == g[at]]
                i, j = at, at + step
                use = (root[i] != root[j]) & (np.minimum(n[i], n[j]) * bounds.den >= np.maximum(n[i], n[j]) * bounds.num)
                i, j = i[use], j[use]
                narrow = np.minimum(width[i], width[j])
                for w in np.unique(narrow).tolist():
                    x, y = i[narrow == w], j[narrow == w]
                    use = np.bitwise_count(bits[w][x] ^ bits[w][y]).sum(axis=1) <= bounds.difference(n[x] + n[y])
                    some[x[use]] = some[y[use]] = True
            keep = np.flatnonzero(some)
            if len(keep):
                head = np.flatnonzero(np.concatenate([[True], g[keep][1:] != g[keep][:-1]]))
                cls = t.column("cls").to_numpy()[keep]
                hub = np.repeat(np.minimum.reduceat(cls, head), np.diff(np.append(head, len(keep))))
                yield pa.RecordBatch.from_arrays([pa.array(hub), pa.array(cls), pa.array(root[keep]), pa.array(n[keep])],
                                                 names=["hub", "cls", "root", "n"])
    return rows


def _with_partner(blocks: DataFrame, sets: DataFrame, bounds: Bounds) -> DataFrame:
    """(hub, cls, root, n) of the rows of ``blocks`` (hub, chunk, cls, root, first) that :func:`_likely` keeps, each once."""
    # classes are joined, not their places in blocks
    return (blocks.groupBy("cls", "root").agg(F.collect_list(F.xxhash64("hub", "chunk")).alias("gs")).join(sets.select("cls", "n", "sketch"), "cls")
            .select(F.explode("gs").alias("g"), "cls", "root", "n", "sketch").repartition("g").sortWithinPartitions("g")
            .mapInArrow(_likely(bounds), "hub long, cls long, root long, n long").distinct())


def _rest(rows: DataFrame, sets: DataFrame, bounds: Bounds) -> DataFrame:
    """Edges between components that meet under a signature (``rows`` as of :func:`_open`)."""
    ask = compact(_asked(rows))
    found = None
    if not ask.isEmpty():
        asked = compact(ask.select("hub").distinct())
        # the members of the asked components, in chunks; a query goes to each chunk
        own = rows.select(F.col("root").alias("hub"), "cls").distinct().join(asked, "hub")
        dealt = compact(_dealt(compact(own), sets))
        to = dealt.select("hub", "chunk").distinct()
        queries = ask.join(to, "hub").select("hub", "chunk", "cls", F.col("cls").alias("root"), F.lit(True).alias("first"))
        placed = dealt.select("hub", "chunk", "cls", F.col("hub").alias("root"), F.lit(False).alias("first")).union(queries)
        found = _searched(placed, sets, bounds)
    low = rows.where(F.col("members") <= LARGE).select("sig", "cls", "root")
    size = low.groupBy("sig").agg((F.count("*") <= BLOCK_SETS).alias("few"), F.min("root").alias("a"), F.max("root").alias("z")).where("a <> z")
    low = checkpointed(low.join(size.select("sig", "few"), "sig"))
    # signatures of few classes: those with a likely partner; signatures of many classes: all
    block = low.where("few").select(F.col("sig").alias("hub"), F.lit(0).cast("long").alias("chunk"), "cls", "root", F.lit(False).alias("first"))
    left = compact(_with_partner(block, sets, bounds).select("cls", "root").union(low.where("not few").select("cls", "root")).distinct())
    if not left.written_rows:
        return found if found is not None else left.select(F.col("cls").alias("a"), F.col("root").alias("b"))
    # sets that share many rare shingles meet once, under the least class of their blocks
    few = _searched(_parted(compact(_with_partner(compact(_prefixed(left, sets, bounds)), sets, bounds))), sets, bounds)
    return found.union(few) if found is not None else few


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                       num: int = NUM, den: int = DEN) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, th (xxhash64 of the text), stays (the first
    document of its component by id and text hash; always true without shingles)."""
    spark = docs.sparkSession
    small_batches(spark)
    bounds = Bounds(num, den)
    text = F.col(text_col).cast("string")
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    release(spark)
    prof = checkpointed(profiles(rows, shingle))
    shared = checkpointed(recurring_signatures(rows, shingle, bounds).repartition("sig").sortWithinPartitions("sig", "cls")
                          .mapInArrow(_shared(bounds), "sig long, cls long, hub long"))

    release(spark)
    # the sets of the classes that meet another class, from one document of each (copies are one row before the join)
    met = shared.select("cls").distinct()
    one = compact(prof.where("n > 0").groupBy("cls").agg(F.min(F.struct("id", "th")).alias("low")).join(met, "cls").select("cls", "low.id", "low.th"))
    release(spark)

    def as_sets(batches):
        for b in batches:
            data, offs = text_bytes(b.column("text"))
            for i, j in slices(offs):
                s, o = shingle_sets(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], shingle)
                yield pa.RecordBatch.from_arrays(
                    [b.column("cls").slice(i, j - i), pa.array(np.diff(o), pa.int64()), to_lists(as_int64(s), np.diff(o), pa.int64()),
                     pa.array([sketch(s[x:y], bounds) for x, y in zip(o[:-1], o[1:])], pa.binary())], names=["cls", "n", "set", "sketch"])

    picked = rows.join(when_small(one, BROADCAST_ROWS), ["id", "th"])
    again = prof.join(when_small(one, BROADCAST_ROWS), ["id", "th"], "left_semi").groupBy("id", "th").agg(F.count("*").alias("n")).where("n > 1")
    if not again.isEmpty():  # identical rows: one of them
        picked = picked.dropDuplicates(["cls"])
    release(spark)
    sets = checkpointed(picked.select("cls", "text").mapInArrow(as_sets, "cls long, n long, set array<long>, sketch binary"))

    release(spark)
    # families: classes that signatures join at all; small ones are one block each
    family = compact(components(shared.where("cls <> hub").select(F.col("cls").alias("a"), F.col("hub").alias("b"))))
    size = (sets.select("cls", "n").join(when_small(family.withColumnRenamed("node", "cls"), BROADCAST_ROWS), "cls").groupBy("root")
            .agg((F.count("*") <= BLOCK_SETS).alias("few"), (F.sum("n") <= BLOCK_SHINGLES).alias("short")))
    family = compact(family.join(size, "root").select("node", "root", (F.col("few") & F.col("short")).alias("small")))
    blocks = family.where("small").select(F.col("root").alias("hub"), F.lit(0).cast("long").alias("chunk"), F.col("node").alias("cls"),
                                          F.col("node").alias("root"), F.lit(False).alias("first"))
    edges = compact(_searched(blocks, sets, bounds))
    release(spark)
    large = family.where("not small").select(F.col("node").alias("cls"))
    if not large.isEmpty():
        rows_l = checkpointed(shared.groupBy("cls").agg(F.collect_list(F.struct("sig", "hub")).alias("at"))
                              .join(when_small(compact(large), BROADCAST_ROWS), "cls", "left_semi")
                              .select("cls", F.explode("at").alias("at")).select("at.sig", "cls", "at.hub"))
        own = compact(_linked(rows_l.groupBy("cls").agg(F.min("hub").alias("hub")), sets, bounds))
        rows_open = _open(rows_l, compact(components(own)))
        release(spark)
        for _ in range(MERGE_ROUNDS):  # a class joins the block of its smallest hub in another component
            again = compact(rows_open.where("root <> hub_root").groupBy("cls").agg(F.min("hub").alias("hub")))
            if again.isEmpty():
                break
            own = compact(own.union(_linked(again, sets, bounds)))
            rows_open = _open(rows_open, compact(components(own)))
            release(spark)
        edges = edges.union(own).union(_rest(rows_open, sets, bounds))
    part = compact(components(edges))
    release(spark)

    # classes with several rows or links get the first document of their component
    classes = (prof.where("n > 0").groupBy("cls").agg(F.min(F.struct("id", "th")).alias("low"), F.count("*").alias("rows"))
               .join(part.withColumnRenamed("node", "cls"), "cls", "left").where("rows > 1 or root is not null")
               .select("cls", "low", F.coalesce("root", "cls").alias("root")))
    least = classes.groupBy("root").agg(F.min("low").alias("first"))
    named = (classes.join(least, "root").select("cls", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    low = F.coalesce("first.id", "id")
    return (prof.select("id", "th", "n", "cls", F.pmod(F.xxhash64("id", "th"), F.lit(SALTS)).cast("int").alias("salt"))
            .join(named, ["cls", "salt"], "left")
            .select(F.when(F.col("id") != _NO_ID, F.col("id")).alias("doc_id"), F.col("n").alias("n_shingles"),
                    F.when(low != _NO_ID, low).alias("component_id"), "th",
                    F.coalesce((F.col("first.id") == F.col("id")) & (F.col("first.th") == F.col("th")), F.lit(True)).alias("stays")))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                     num: int = 80, den: int = 100) -> DataFrame:
    """One document of each component stays, columns unchanged (five-word shingles, similarity 0.8)."""
    per = checkpointed(jaccard_components(docs, id_col, text_col, shingle, num, den)
                       .select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("id"), "th", "stays", (F.col("n_shingles") > 0).alias("some")))
    release(docs.sparkSession)
    again = per.where("stays and some").groupBy("id", "th").agg(F.count("*").alias("n")).where("n > 1").select("id", "th")
    return drop_rows(docs, [F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)), F.xxhash64(F.col(text_col).cast("string"))],
                     per.where("not stays").select("id", "th").distinct(), again)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir)).drop("th", "stays")


ORACLE_SQL = r"""
WITH RECURSIVE dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
), sh AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[s:s + 3], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS s FROM dw WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
links AS (
  SELECT x.a, x.b FROM (
    SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS i FROM sh p JOIN sh q ON p.g = q.g AND p.doc_id <> q.doc_id GROUP BY ALL
  ) x JOIN sizes s ON x.a = s.doc_id JOIN sizes t ON x.b = t.doc_id WHERE 100 * i >= 85 * (s.n + t.n - i)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM dw UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM dw d LEFT JOIN sizes s USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
"""
