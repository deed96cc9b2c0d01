"""Phrase collocation mining by dynamic itemset counting.

The corpus is dealt to ``SHARDS`` shards, which are scanned in a cycle.  Words are
counted from the first scan on.  A phrase becomes active as soon as both its subphrases
(without the last word, without the first word) have reached the threshold in what was
counted so far, whatever its length, so scans count several lengths at once; an
active phrase is counted for one full cycle, after which its count is that of
the whole corpus.  Scanning ends when no phrase is in its cycle.

What is active travels as two bit filters of fixed size (``FILTER_BITS``, whatever the corpus):
phrases that have reached the threshold, and those that did so within the last cycle.  A phrase
that passes by chance is just counted too soon or again: counts carry the set of
shards they come from, and a shard is added once.  Phrases are named by 96 bits of hash of language
and words while they are counted; each task combines its counts before the shuffle, so a
word or pair of a third of all rows is one entry per task.  After two cycles, when words and pairs are
complete, the shards are cut down to what can still hold longer phrases.  The words of frequent phrases are read
from one part of the corpus after the other, until every phrase has them.

Scores, containment and ranks are joins and aggregates over the frequent phrases; the join keys
that many phrases share (their parts) are salted, the first ``top`` of a language are taken
within salts before they meet.  Arithmetic is exact (decimals of 38 digits).

Defined cases: null text is empty text; a null language counts as ``und``; bytes that are not UTF-8
are read as U+FFFD when a phrase is written; repeated rows count again; a phrase of one text of any
length counts; no frequent phrase or an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from threadline.llm.common import (BYTE_CODE, LOWER, as_int64, documents, mix, prefix_hash, range_hash, remove_folder, slices,
                                   small_batches, stored, text_bytes, when_small, word_spans)
from threadline.session import scratch_path

LONGEST, LEAST, TOP = 5, 100, 2000
SHARDS = 4
FILTER_BITS = 1 << 26
FLUSH = 3_000_000
BUCKETS = 4
SALTS = 16
TOP_SALTS = 64
#: What ends a piece, [.,;:!?\x0A-\x0D], and what separates its words, [\x20\x09].
ENDS = np.zeros(256, bool)
ENDS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
GAPS = ENDS.copy()
GAPS[[0x20, 0x09]] = True
OTHER_CODE = mix(BYTE_CODE + np.uint64(0x5851F42D4C957F2D)) | np.uint64(1)


class Phrases:
    """Words of a slice of texts and the hashes of their phrases, by language."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, salts: np.ndarray):
        self.low = LOWER[data]
        self.start, self.end, self.doc = word_spans(data, offs, GAPS)
        ends = np.cumsum(ENDS[data]) if len(data) else np.zeros(0, np.int64)
        self.piece = ends[self.start] + self.doc
        salt = salts[self.doc]
        self.h = prefix_hash(mix(range_hash(prefix_hash(BYTE_CODE[self.low]), self.start, self.end) + salt))
        # the second hash takes length, first and last letters of each word
        size = self.end - self.start
        ends = mix(salt ^ size.astype(np.uint64))
        for k in range(4):
            within = np.minimum(k, size - 1)
            ends = (ends + OTHER_CODE[self.low[self.start + within]]) * OTHER_CODE[self.low[self.end - 1 - within]]
            ends ^= ends >> np.uint64(29)
        self.g = prefix_hash(mix(ends))

    def __len__(self):
        return len(self.start)

    def names(self, k: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """64 and 32 bits of hash of the ``k`` words from each place."""
        return range_hash(self.h, at, at + k), (range_hash(self.g, at, at + k) >> np.uint64(32)).astype(np.uint32).view(np.int32)

    def within(self, k: int) -> np.ndarray:
        """Whether ``k`` words from each place lie in one piece."""
        n = max(0, len(self) - k + 1)
        return self.piece[:n] == self.piece[k - 1:k - 1 + n]

    def words(self, k: int, at: int) -> str:
        return self.raw(k, at).decode("utf-8", "replace")

    def raw(self, k: int, at: int) -> bytes:
        return b" ".join(self.low[s:e].tobytes() for s, e in zip(self.start[at:at + k], self.end[at:at + k]))


def lang_salt(lang: str) -> int:
    return int.from_bytes(sha256(lang.encode()).digest()[:8], "little")


def _read(batches):
    """Phrases of bounded slices of (lang, text) rows, and the languages of their texts."""
    for b in batches:
        data, offs = text_bytes(b.column("text"))
        lang = b.column("lang").to_pylist()
        known = {x: lang_salt(x) for x in set(lang)}
        salts = np.array([known[x] for x in lang], np.uint64)
        for i, j in slices(offs):
            yield Phrases(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], salts[i:j]), lang[i:j]


def has(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    slot = h & np.uint64(len(bits) * 64 - 1)
    return (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def active(p: Phrases, reached: np.ndarray, recent: np.ndarray, longest: int):
    """(k, places) of the phrases of two words or more whose two subphrases have reached the threshold, one of them recently."""
    at = np.arange(len(p))
    h, _ = p.names(1, at)
    old = has(reached, h)
    new = old & has(recent, h)
    for k in range(2, longest + 1):
        n = len(p) - k + 1
        if n <= 0 or not old.any():
            return
        both = old[:n] & old[1:n + 1] & p.within(k)
        yield k, np.flatnonzero(both & (new[:n] | new[1:n + 1]))
        # the next length: only phrases whose subphrases have reached it can have done so
        at = np.flatnonzero(both)
        h, _ = p.names(k, at)
        old, new = np.zeros(n, bool), np.zeros(n, bool)
        old[at] = has(reached, h)
        new[at] = old[at] & has(recent, h)


def _buckets(h: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in ascending 64-bit hashes, and the end."""
    edge = [-(-(b << 64) // buckets) for b in range(buckets)]
    return np.append(np.searchsorted(h, np.array(edge, np.uint64)), len(h))


def _order(h: np.ndarray, g: np.ndarray) -> np.ndarray:
    order = np.argsort(h)
    hs, gs = h[order], g[order]
    if ((hs[1:] == hs[:-1]) & (gs[1:] != gs[:-1])).any():  # two phrases with equal first hashes
        order = np.lexsort((g, h))
    return order


_PACKED = "bucket int, state boolean, h binary, g binary, k binary, c binary, shards binary, seen binary"


def _counted(shard: DataFrame, filters, first_cycle: bool, longest: int, buckets: int) -> DataFrame:
    """Counts of the active phrases in a shard, combined in each task and packed by bucket (arrays as bytes)."""
    def rows(batches):
        reached, recent = filters.value
        held, n = [], 0

        def flush():
            h, g, k = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order = _order(h, g)
            h, g = h[order], g[order]
            head = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (g[1:] != g[:-1])]))
            count = np.diff(np.append(head, len(h))).astype(np.int64)
            h, g, k = h[head], g[head], k[order[head]]
            cut = _buckets(h, buckets)
            used = np.flatnonzero(np.diff(cut))
            pack = [pa.array([x[cut[b]:cut[b + 1]].tobytes() for b in used], pa.binary()) for x in (h, g, k, count)]
            none = pa.nulls(len(used), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(np.zeros(len(used), bool)), *pack, none, none],
                                              names=["bucket", "state", "h", "g", "k", "c", "shards", "seen"])

        for p, _ in _read(batches):
            found = list(active(p, reached, recent, longest))
            if first_cycle:
                found.append((1, np.arange(len(p))))
            for k, at in found:
                if len(at):
                    held.append((*p.names(k, at), np.full(len(at), k, np.int8)))
                    n += len(at)
            if n > FLUSH:
                yield flush()
                n = 0
        if n:
            yield flush()

    return shard.mapInArrow(rows, _PACKED)


def _added(step: int, cycle: int, least: int):
    """Adds the new counts of a shard to the state of a bucket."""
    bit = np.int64(1 << step % cycle)

    def merge(key, t):
        kinds = {"h": np.uint64, "g": np.int32, "k": np.int8, "c": np.int64, "shards": np.int64, "seen": np.int32}
        old = np.array(t.column("state").to_pylist(), bool)
        col = {n: [np.frombuffer(x or b"", kind) for x in t.column(n).to_pylist()] for n, kind in kinds.items()}
        size = np.array([len(x) for x in col["h"]], np.int64)
        for n in ("shards", "seen"):
            col[n] = [x if o else np.zeros(m, kinds[n]) for x, o, m in zip(col[n], old, size)]
        h, g, k, c, shards, seen = (np.concatenate(col[n]) for n in kinds)
        was = np.repeat(old, size)
        order = _order(h, g)
        h, g = h[order], g[order]
        head = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (g[1:] != g[:-1])]))
        h, g, k = h[head], g[head], k[order[head]]
        total = np.add.reduceat(np.where(was, c, 0)[order], head)
        new = np.add.reduceat(np.where(was, 0, c)[order], head)
        shards, seen = np.maximum.reduceat(shards[order], head), np.maximum.reduceat(seen[order], head)
        # a shard is added once
        after = total + np.where(shards & bit, 0, new)
        shards = np.where(new > 0, shards | bit, shards)
        seen = np.where(new > 0, np.int32(step), seen)
        fresh = h[(after >= least) & (total < least)]
        # below the threshold: gone when all shards are in, when no shard of a cycle has brought it (should it
        # become active later, its own cycle counts all shards anew), and words after their only cycle
        gone = (shards == 2**cycle - 1) | (seen <= step - cycle)
        if step >= cycle - 1:
            gone |= k == 1
        keep = (after >= least) | ~gone
        rows = int(keep.any())  # an empty bucket has no row
        pack = [pa.array([x[keep].tobytes()] * rows, pa.binary()) for x in (h, g, k, after, shards, seen)]
        return pa.table([pa.array([key[0].as_py()] * rows, pa.int32()), pa.array([True] * rows, pa.bool_()), *pack,
                         pa.array([as_int64(fresh).tolist()] * rows, pa.list_(pa.int64()))],
                        names=["bucket", "state", "h", "g", "k", "c", "shards", "seen", "fresh"])

    return merge


def _frequent(least: int):
    """(h, g, k, c) rows of the phrases in packed states that have reached the threshold."""
    def rows(batches):
        for b in batches:
            for h, g, k, c in zip(*(b.column(n).to_pylist() for n in ("h", "g", "k", "c"))):
                c = np.frombuffer(c, np.int64)
                ok = c >= least
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(h, np.int64)[ok]), pa.array(np.frombuffer(g, np.int32)[ok]), pa.array(np.frombuffer(k, np.int8)[ok]),
                     pa.array(c[ok])], names=["h", "g", "k", "c"])
    return rows


def _language_words(rows: DataFrame) -> DataFrame:
    """(lang, n): words of each language."""
    def count(batches):
        total: dict[str, int] = {}
        for b in batches:
            data, offs = text_bytes(b.column("text"))
            lang = b.column("lang").to_pylist()
            for i, j in slices(offs):
                doc = word_spans(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], GAPS)[2]
                for d, n in enumerate(np.bincount(doc, minlength=j - i).tolist()):
                    total[lang[i + d]] = total.get(lang[i + d], 0) + n
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["lang", "n"])

    return rows.mapInArrow(count, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n"))


def count_phrases(spark: SparkSession, shards: list[DataFrame], longest: int, least: int, filter_bits: int,
                  buckets: int) -> tuple[DataFrame, DataFrame]:
    """((h, g, k, c) of all phrases with a count of ``least`` or more, by cyclic scans of the shards; (lang, n)).

    Counts are kept packed, a row per bucket of hashes.  After two cycles words and pairs are complete: the
    shards are cut down to the runs of frequent pairs, which hold all longer frequent phrases.
    """
    cycle = len(shards)
    reached = np.zeros(filter_bits // 64, np.uint64)
    fresh: list[np.ndarray] = []
    schema = f"{_PACKED}, fresh array<long>"
    state, path, step, trimmed = spark.createDataFrame([], schema), None, 0, None
    words = stored(_language_words(reduce(DataFrame.unionByName, shards)))
    while step < cycle or any(x.any() for x in fresh[-cycle:]):
        if step == 2 * cycle:
            known = spark.sparkContext.broadcast(reached)
            trimmed = [scratch_path(spark, "trimmed") for _ in shards]
            for rows, to in zip(shards, trimmed):
                _trimmed(rows, known, longest).write.parquet(to)
            shards = [spark.read.schema("lang string, text binary").parquet(to) for to in trimmed]
        recent = np.bitwise_or.reduce(np.stack(fresh[-cycle:])) if fresh else reached
        filters = spark.sparkContext.broadcast((reached, recent))
        new = _counted(shards[step % cycle], filters, step < cycle, longest, buckets)
        after = state.drop("fresh").unionByName(new).groupBy("bucket").applyInArrow(_added(step, cycle, least), schema)
        before, path = path, scratch_path(spark, "phrases")
        after.write.parquet(path)
        state = spark.read.schema(schema).parquet(path)
        if before:
            remove_folder(spark, before)
        filters.destroy()
        fresh.append(_bits(state.select(F.explode("fresh").alias("h")), filter_bits))
        if len(fresh) > cycle:
            fresh[-cycle - 1] = np.zeros(1, np.uint64)
        reached = reached | fresh[-1]
        step += 1
    for to in trimmed or []:
        remove_folder(spark, to)
    return stored(state.select("h", "g", "k", "c").mapInArrow(_frequent(least), "h long, g int, k byte, c long")), words


def _bits(phrases: DataFrame, bits: int) -> np.ndarray:
    """Bit filter of the column ``h``; at most bits / 64 rows reach the driver."""
    slot = F.pmod(F.col("h"), F.lit(bits))
    got = (phrases.select(F.shiftright(slot, 6).alias("at"), F.expr("shiftleft(1L, cast(pmod(h, 64) as int))").alias("bit"))
           .groupBy("at").agg(F.bit_or("bit").alias("bit")).toArrow())
    out = np.zeros(bits // 64, np.int64)
    out[got.column("at").to_numpy()] = got.column("bit").to_numpy()
    return out.view(np.uint64)


def _trimmed(rows: DataFrame, filters, longest: int) -> DataFrame:
    """(lang, text): what can hold active phrases of three words or more, runs of frequent pairs with an end after each."""
    def trim(batches):
        known = filters.value
        for p, lang in _read(batches):
            n = max(0, len(p) - 1)
            at = np.arange(n)
            pair = p.within(2) & has(known, p.names(2, at)[0]) if n else np.zeros(0, bool)
            first = np.flatnonzero(pair & ~np.concatenate([[False], pair[:-1]])) if n else at
            last = np.flatnonzero(pair & ~np.concatenate([pair[1:], [False]])) + 1 if n else at
            some = last - first >= 2
            parts: dict[int, list[bytes]] = {}
            for i, j in zip(first[some].tolist(), last[some].tolist()):
                parts.setdefault(int(p.doc[i]), []).append(p.raw(j - i + 1, i))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array([lang[d] for d in parts], pa.string()),
                                                  pa.array([b".".join(x) for x in parts.values()], pa.binary())], names=["lang", "text"])

    return rows.mapInArrow(trim, "lang string, text binary")


def _named(rows: DataFrame, filters, longest: int, buckets: int) -> DataFrame:
    """The phrases that pass the filter, each once a task, packed by bucket."""
    def read(batches):
        known = filters.value
        seen: set[int] = set()
        for p, lang in _read(batches):
            out: list[tuple] = []
            for k in range(1, longest + 1):
                if k > len(p):
                    break
                at = np.flatnonzero(p.within(k))
                h, g = p.names(k, at)
                passed = np.flatnonzero(has(known, h))
                _, first = np.unique(h[passed], return_index=True)
                for x in passed[first].tolist():
                    name = int(h[x])
                    if name not in seen:
                        seen.add(name)
                        out.append((name, int(g[x]), lang[p.doc[at[x]]], p.words(k, int(at[x]))))
            if out:
                out.sort()
                h = np.array([x[0] for x in out], np.uint64)
                cut = _buckets(h, buckets)
                used = np.flatnonzero(np.diff(cut))
                pack = [[[x[c] for x in out[cut[b]:cut[b + 1]]] for b in used] for c in (1, 2, 3)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used.astype(np.int32)), pa.array([as_int64(h[cut[b]:cut[b + 1]]).tolist() for b in used], pa.list_(pa.int64())),
                     pa.array(pack[0], pa.list_(pa.int32())), pa.array(pack[1], pa.list_(pa.string())), pa.array(pack[2], pa.list_(pa.string()))],
                    names=["bucket", "h", "g", "lang", "phrase"])

    packed = rows.mapInArrow(read, "bucket int, h array<long>, g array<int>, lang array<string>, phrase array<string>")
    return packed.groupBy("bucket").applyInArrow(_unpack, "h long, g int, lang string, phrase string")


def _unpack(t: pa.Table) -> pa.Table:
    """The distinct phrases of a bucket."""
    flat = pa.table({c: t.column(c).combine_chunks().flatten() for c in ("h", "g", "lang", "phrase")})
    return flat.group_by(["h", "g"]).aggregate([("lang", "min"), ("phrase", "min")]).select(["h", "g", "lang_min", "phrase_min"]).rename_columns(flat.column_names)


def frequent_phrases(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST,
                     least: int = LEAST, n_shards: int = SHARDS, filter_bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, k, f) of the phrases of 1 to ``longest`` words with f >= ``least``, (lang, n) words of each language)."""
    spark = docs.sparkSession
    small_batches(spark)
    path = scratch_path(spark, "shards")
    lang, text = F.coalesce(F.col(lang_col).cast("string"), F.lit("und")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    code = F.pmod(F.xxhash64(F.col(id_col)), F.lit(16 * n_shards))
    # the first shard has a small first part, where most frequent phrases get their words from
    part = F.when(code == 0, 0).when(code % n_shards == 0, 1).otherwise(2)
    (docs.select(lang.alias("lang"), text.cast("binary").alias("text"), (code % n_shards).cast("int").alias("shard"), part.cast("int").alias("part"))
     .write.partitionBy("shard", "part").parquet(path))
    whole = spark.read.schema("lang string, text binary, shard int, part int").parquet(path)
    buckets = BUCKETS * whole.rdd.getNumPartitions()
    shards = [whole.where(F.col("shard") == k).select("lang", "text") for k in range(n_shards)]
    counts, words = count_phrases(spark, shards, longest, least, filter_bits, buckets)
    # words of phrases: from one part of the corpus after the other, until every phrase has them
    todo, names = counts, []
    for k, p in [(0, 0), (0, 1), *((k, 2) for k in range(1, n_shards))]:
        if todo.isEmpty():
            break
        filters = spark.sparkContext.broadcast(_bits(todo, filter_bits))
        rows = whole.where((F.col("shard") == k) & (F.col("part") == p)).select("lang", "text")
        found = _named(rows, filters, longest, buckets)
        names.append(stored(todo.join(found, ["h", "g"])))
        todo = stored(todo.join(names[-1].select("h", "g"), ["h", "g"], "left_anti"))
    phrases = reduce(DataFrame.unionByName, names) if names else counts.select("*", F.lit("").alias("lang"), F.lit("").alias("phrase"))
    phrases = stored(phrases.select("lang", "phrase", F.col("k").cast("int").alias("k"), F.col("c").alias("f")))
    remove_folder(spark, path)
    return phrases, words


def collocations(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST,
                 least: int = LEAST, top: int = TOP, keep_percent: int = 100, n_shards: int = SHARDS, filter_bits: int = FILTER_BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language.

    A phrase goes when a longer one that holds it has ``keep_percent`` per cent of its count or more.
    """
    return ranked(*frequent_phrases(docs, id_col, text_col, lang_col, longest, least, n_shards, filter_bits), top, keep_percent)


def ranked(phrases: DataFrame, words: DataFrame, top: int = TOP, keep_percent: int = 100) -> DataFrame:
    """Scores, containment and ranks of frequent phrases (lang, phrase, k, f), given the words of each language (lang, n)."""
    spelt = phrases.where("k >= 2").withColumn("w", F.split("phrase", " ", -1))
    cuts = (spelt.select("lang", "phrase", "k", "f", "w", F.explode(F.expr("sequence(1, greatest(k - 1, 1))")).alias("cut"))
            .select("lang", "phrase", F.col("f").alias("a"), "cut", F.expr("array_join(slice(w, 1, cut), ' ')").alias("first"),
                    F.expr("array_join(slice(w, cut + 1, k - cut), ' ')").alias("rest"),
                    F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int").alias("salt")))
    part = phrases.select("lang", "phrase", "f", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    left = part.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"), "salt")
    right = part.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"), "salt")
    wide = "decimal(38,0)"
    scored = (cuts.join(left, ["lang", "first", "salt"]).join(right, ["lang", "rest", "salt"])
              .join(when_small(words, 10_000), "lang")
              .withColumn("score", F.expr(f"cast(cast(1000 * cast(a as decimal(19,0)) as decimal(23,0)) * cast(n as decimal(15,0)) as {wide})"
                                          f" div cast(cast(l as decimal(19,0)) * cast(r as decimal(19,0)) as {wide})")))
    lowest = (scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "l", "r", "a", "n")).alias("b"))
              .select("lang", "phrase", "b.a", "b.l", "b.r", "b.n", "b.score"))
    inside = (spelt.where("k >= 3")
              .select("lang", F.col("f").alias("longer"),
                      F.expr("flatten(transform(sequence(2, greatest(k - 1, 2)), m -> transform(sequence(1, greatest(k - m + 1, 1)), s -> array_join(slice(w, s, m), ' '))))").alias("in"))
              .select("lang", "longer", F.explode("in").alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    kept = (lowest.join(inside, ["lang", "phrase"], "left")
            .where(F.expr(f"longer is null or cast(100 as {wide}) * longer < cast({keep_percent} as {wide}) * a")))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    some = (kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(TOP_SALTS)))
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top))
    return (some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


ORACLE_SQL = r"""
WITH p AS (
  SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
), g AS (
  SELECT lang, k, array_to_string(w[s:s + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS s FROM (SELECT lang, w, unnest([1, 2, 3, 4, 5]) AS k FROM p)) GROUP BY ALL
), words AS (SELECT lang, sum(f)::BIGINT AS n FROM g WHERE k = 1 GROUP BY lang),
f AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM g WHERE f >= 100),
cuts AS (
  SELECT lang, phrase, f AS a, c, array_to_string(w[1:c], ' ') AS first, array_to_string(w[c + 1:], ' ') AS rest
  FROM (SELECT *, unnest(generate_series(1, k - 1)) AS c FROM f WHERE k >= 2)
), scored AS (
  SELECT cuts.lang, cuts.phrase, a, c, x.f AS l, y.f AS r, n, ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = cuts.first JOIN f y ON y.lang = cuts.lang AND y.phrase = cuts.rest
  JOIN words ON words.lang = cuts.lang
), lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inside AS (
  SELECT lang, array_to_string(w[s:s + m - 1], ' ') AS phrase, max(f) AS longer
  FROM (SELECT lang, w, f, m, unnest(generate_series(1, k - m + 1)) AS s
        FROM (SELECT lang, w, f, k, unnest(generate_series(2, k - 1)) AS m FROM f WHERE k >= 3)) GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a
QUALIFY rank <= 2000
"""
