"""Substring dedup with repeated-phrase automata (word windows).

A window is ``WINDOW`` consecutive words.  A word is removed when a window over
it also starts in a document with a smaller id.  Steps:

1. *Probes.*  Per document, the ``PROBE``-word phrases that are the hash minimum of
   some window.  Equal windows have equal probes, so a recurring window has a
   probe that recurs in two documents.  Texts equal word by word are one class
   first; only the smallest id of a class goes on (the others are covered whole).
2. *Confirm.*  In documents with recurring probes, the windows around these probes are
   counted by hash; a window in two documents is confirmed and owned by the
   smallest id.  Runs of owned windows in the owner are the recurring passages.
3. *Automata.*  Passages are cut into pieces of half a window (every window inside
   a passage holds a whole piece) and compiled, by shards of owners, into
   Aho-Corasick automata over word numbers.  Every document with windows of a
   shard's owners is streamed through that shard's automaton; from each
   piece found the match is extended word by word along the passage, and runs of a window
   or more are removed.  A shard with many documents is dealt to several tasks, each with
   a copy of the automaton.

Aggregation happens before every shuffle; passages are bounded by their owner's
length, shards by ``SHARD_OWNERS`` owners and ``TASK_WORDS`` words of documents.

Defined cases: null text has no words; a null id is larger than every id; rows
with equal ids never remove words from each other; texts shorter than a window
stay whole; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from threadline.llm.common import (as_int64, checkpointed, documents, list_column, prefix_hash, range_hash, slices,
                                   small_batches, text_bytes, to_lists, when_small, window_minima, word_hashes,
                                   word_spans)

WINDOW = 50
PROBE = 10
SHARD_OWNERS = 200
TASK_WORDS = 300_000
BROADCAST_ROWS = 500_000
_NO_ID = 2**63 - 1


class _Words:
    """Words of a slice of texts with hashes of phrases and windows."""

    def __init__(self, data, offs, window, probe):
        self.data = data
        self.start, self.end, self.doc = word_spans(data, offs)
        self.hash = word_hashes(data, self.start, self.end)
        self.count = np.bincount(self.doc, minlength=len(offs) - 1)
        self.first = np.concatenate([[0], np.cumsum(self.count)])
        n = len(self.hash)
        prefix = prefix_hash(self.hash)
        at = np.arange(max(0, n - probe + 1))
        self.phrase = range_hash(prefix, at, at + probe) | np.uint64(1)
        at = np.arange(max(0, n - window + 1))
        whole = self.doc[at] == self.doc[at + window - 1] if len(at) else np.zeros(0, bool)
        self.whole = whole
        self.prefix = prefix
        self.low, self.chosen = window_minima(self.phrase, whole, window - probe + 1)


def _words_sha(data, start, end, keep=None) -> str:
    """SHA-256 of the (kept) words joined by one space."""
    if keep is not None:
        start, end = start[keep], end[keep]
    if not len(start):
        return hashlib.sha256(b"").hexdigest()
    size = end - start + 1
    to = np.cumsum(size) - size
    out = np.full(int(size.sum()), 32, np.uint8)
    take = np.arange(len(out)) - np.repeat(to, size)
    real = take < np.repeat(size - 1, size)
    out[real] = data[(np.repeat(start, size) + take)[real]]
    return hashlib.sha256(out[:-1].tobytes()).hexdigest()


def profiles(docs: DataFrame, id_col: str, text_col: str, window: int, probe: int) -> DataFrame:
    """Per row: id, text hash, n_words, hash of the word sequence, distinct probes."""
    def rows(batches):
        for b in batches:
            data, offs = text_bytes(b.column("text"))
            for i, j in slices(offs):
                w = _Words(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], window, probe)
                place = np.flatnonzero(w.chosen)
                pair = np.empty((len(place), 2), np.uint64)
                pair[:, 0], pair[:, 1] = w.doc[place], w.phrase[place]
                order = np.lexsort((pair[:, 1], pair[:, 0]))
                pair = pair[order]
                new = np.ones(len(pair), bool)
                new[1:] = (pair[1:] != pair[:-1]).any(axis=1)
                pair = pair[new]
                shas = [_words_sha(w.data, w.start[a:z], w.end[a:z]) for a, z in zip(w.first[:-1], w.first[1:])]
                part = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("th"), pa.array(w.count, pa.int64()), pa.array(shas),
                     to_lists(as_int64(pair[:, 1].copy()), np.bincount(pair[:, 0].astype(np.int64), minlength=j - i), pa.int64())],
                    names=["id", "th", "n_words", "sha", "probes"])

    return _keyed(docs, id_col, text_col).mapInArrow(rows, "id long, th long, n_words long, sha string, probes array<long>")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("id"), F.xxhash64(text).alias("th"),
                       text.alias("text"))


def _windows(window: int, probe: int):
    """Distinct hashes of a document's windows whose probe recurs."""
    def rows(batches):
        for b in batches:
            data, offs = text_bytes(b.column("text"))
            probes, poffs = list_column(b.column("probes"))
            ids = b.column("id").to_numpy()
            for i, j in slices(offs):
                w = _Words(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], window, probe)
                for k in range(i, j):
                    a, z = w.first[k - i], w.first[k - i + 1] - window + 1
                    if z <= a:
                        continue
                    known = probes[poffs[k]:poffs[k + 1]].view(np.uint64)
                    at = a + np.flatnonzero(np.isin(w.low[a:z], known))
                    h = np.unique(range_hash(w.prefix, at, at + window))
                    yield pa.RecordBatch.from_arrays([pa.array(as_int64(h)), pa.array(np.full(len(h), ids[k]))], names=["h", "id"])
    return rows


def _passages(window: int, probe: int):
    """Maximal runs of owned windows: the word hashes of each passage."""
    def rows(batches):
        for b in batches:
            data, offs = text_bytes(b.column("text"))
            own, ooffs = list_column(b.column("own"))
            for i, j in slices(offs):
                w = _Words(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], window, probe)
                owners, lists = [], []
                for k in range(i, j):
                    a, z = w.first[k - i], w.first[k - i + 1] - window + 1
                    if z <= a:
                        continue
                    at = np.arange(a, z)
                    mine = np.isin(range_hash(w.prefix, at, at + window), own[ooffs[k]:ooffs[k + 1]].view(np.uint64))
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], mine.astype(np.int8), [0]])))
                    for s, e in zip(edge[::2], edge[1::2]):
                        owners.append(b.column("id")[k].as_py())
                        lists.append(w.hash[a + s:a + e + window - 1])
                flat = np.concatenate(lists) if lists else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owners, pa.int64()), to_lists(as_int64(flat), np.array([len(x) for x in lists], np.int64), pa.int64())],
                    names=["owner", "words"])
    return rows


def compile_automaton(passages: list[np.ndarray], piece: int):
    """(automaton, sorted words, passages as word numbers); number 0 is every other word."""
    words = np.unique(np.concatenate(passages))
    numbered = [np.searchsorted(words, p) + 1 for p in passages]
    places: dict[tuple, list] = {}
    for q, p in enumerate(numbered):
        for o in range(0, len(p) - piece + 1, piece):
            places.setdefault(tuple(p[o:o + piece].tolist()), []).append((q, o))
    machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for key, where in places.items():
        machine.add_word(key, where)
    machine.make_automaton()
    return machine, words, numbered


def find_passages(text: np.ndarray, machine, words, numbered, allowed, piece: int, window: int) -> list[tuple[int, int]]:
    """Spans of at least a window that occur in an allowed passage (text: word hashes)."""
    at = np.searchsorted(words, text)
    known = at < len(words)
    known[known] = words[at[known]] == text[known]
    seq = np.where(known, at + 1, 0)
    done: dict[tuple[int, int], int] = {}  # (passage, diagonal) -> end of the last run
    spans = []
    for end, where in machine.iter(tuple(seq.tolist())):
        start = end - piece + 1
        for q, o in where:
            if not allowed[q] or done.get((q, start - o), 0) > end:
                continue
            p = numbered[q]
            back, ahead = min(o, start), min(len(p) - o, len(seq) - start)
            left = seq[start - back:start] != p[o - back:o]
            right = seq[start:start + ahead] != p[o:o + ahead]
            a = start - (int(np.argmax(left[::-1])) if left.any() else back)
            z = start + (int(np.argmax(right)) if right.any() else ahead)
            done[(q, start - o)] = z
            if z - a >= window:
                spans.append((a, z))
    return spans


def repeated_spans(docs: DataFrame, found: DataFrame, window: int, probe: int) -> DataFrame:
    """(id, th, spans): word spans of class representatives that recur in a smaller id.

    ``found``: the checkpointed profiles of all rows.
    """
    spark = docs.sparkSession
    piece = window // 2
    reps = found.where(F.col("n_words") >= window).groupBy("sha", "n_words").agg(
        F.min(F.struct("id", "th")).alias("r"), F.first("probes").alias("probes")).select("r.id", "r.th", "probes")
    reps = reps.select("id", "th", F.explode("probes").alias("p"))
    recurring = reps.groupBy("p").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a < z").select("p")
    marked = reps.join(recurring, "p").groupBy("id", "th").agg(F.collect_list("p").alias("probes"))
    marked = checkpointed(marked)
    # the list of rows is small where few texts repeat: then only their texts are shuffled
    some = docs.join(when_small(marked.select("id", "th"), BROADCAST_ROWS), ["id", "th"], "left_semi")
    texts = checkpointed(some.dropDuplicates(["id", "th"]).join(marked, ["id", "th"]))

    wins = texts.mapInArrow(_windows(window, probe), "h long, id long")
    confirmed = wins.groupBy("h").agg(F.min("id").alias("owner"), F.max("id").alias("z")).where("owner < z").select("h", "owner")
    uses = checkpointed(wins.join(confirmed, "h").groupBy("id", "owner").agg(
        F.collect_set(F.when(F.col("id") == F.col("owner"), F.col("h"))).alias("own")))

    owners = uses.where("id = owner").select("id", "own")
    passages = checkpointed(texts.join(owners, "id").mapInArrow(_passages(window, probe), "owner long, words array<long>"))
    n_shards = max(1, -(-owners.count() // SHARD_OWNERS))
    shard = F.pmod(F.xxhash64("owner"), F.lit(n_shards))
    visits = (uses.where("id > owner").select("id", shard.alias("shard")).distinct()
              .join(texts.select("id", "th", "text"), "id"))
    # documents of a shard go to as many tasks as their words need
    size = F.octet_length("text") / 5
    load = visits.groupBy("shard").agg(F.ceil(F.sum(size) / TASK_WORDS).cast("long").alias("tasks"))
    load = checkpointed(load.select("shard", F.greatest("tasks", F.lit(1).cast("long")).alias("tasks")))
    visits = visits.join(load, "shard").withColumn("task", F.pmod(F.xxhash64("id", "th"), F.col("tasks")))
    patterns = (passages.withColumn("shard", shard).join(load, "shard")
                .select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1)).alias("task"), "owner", "words"))

    def locate(pat: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(pat) and len(part):
            machine, words, numbered = compile_automaton([np.asarray(x, np.int64).view(np.uint64) for x in pat["words"]], piece)
            owner = pat["owner"].to_numpy()
            for i, th, text in zip(part["id"], part["th"], part["text"]):
                raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
                s, e, _ = word_spans(raw, np.array([0, len(raw)]))
                spans = find_passages(word_hashes(raw, s, e), machine, words, numbered, owner < i, piece, window)
                if spans:
                    out.append((i, th, [x for p in spans for x in p]))
        return pd.DataFrame(out, columns=["id", "th", "spans"])

    spans = (patterns.groupBy("shard", "task").cogroup(visits.select("shard", "task", "id", "th", "text").groupBy("shard", "task"))
             .applyInPandas(locate, "id long, th long, spans array<long>"))
    spans = spans.groupBy("id", "th").agg(F.flatten(F.collect_list("spans")).alias("spans"))

    def cut(batches):
        for b in batches:
            data, offs = text_bytes(b.column("text"))
            flat, soffs = list_column(b.column("spans"))
            removed, shas = [], []
            for k in range(len(offs) - 1):
                raw = data[offs[k]:offs[k + 1]]
                s, e, _ = word_spans(raw, np.array([0, len(raw)]))
                gone = np.zeros(len(s) + 1, np.int64)
                mine = flat[soffs[k]:soffs[k + 1]]
                np.add.at(gone, mine[::2], 1)
                np.add.at(gone, mine[1::2], -1)
                keep = np.cumsum(gone)[:-1] == 0
                removed.append(int((~keep).sum()))
                shas.append(_words_sha(raw, s, e, keep))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("th"), pa.array(removed, pa.int64()), pa.array(shas, pa.string()),
                                              b.column("spans")], names=["id", "th", "n_removed", "kept_sha256", "spans"])

    return texts.join(spans, ["id", "th"]).select("id", "th", "text", "spans").mapInArrow(
        cut, "id long, th long, n_removed long, kept_sha256 string, spans array<long>")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   probe: int = PROBE) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256, spans (flat start, end pairs of word numbers)."""
    small_batches(docs.sparkSession)
    found = checkpointed(profiles(docs, id_col, text_col, window, probe))
    spans = repeated_spans(_keyed(docs, id_col, text_col), found, window, probe)
    classes = found.where(F.col("n_words") >= window).groupBy("sha", "n_words").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    classes = classes.where("n > 1").select("sha", "n_words", "first", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("salt"))
    base = found.select("id", "th", "n_words", "sha", F.pmod("th", F.lit(16)).cast("int").alias("salt"))
    # the salt spreads the rows of a class of copies; copies of one row share the text hash, so the id takes part too
    base = base.withColumn("salt", F.pmod(F.xxhash64("id", "th"), F.lit(16)).cast("int"))
    copy = F.col("first").isNotNull() & (F.col("id") > F.col("first"))
    return (base.join(classes, ["sha", "n_words", "salt"], "left").join(spans, ["id", "th"], "left")
            .select(F.when(F.col("id") != _NO_ID, F.col("id")).alias("doc_id"), "n_words",
                    F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
                    F.when(copy, F.lit(hashlib.sha256(b"").hexdigest()))
                    .otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
                    F.when(copy, F.array(F.lit(0).cast("long"), F.col("n_words"))).otherwise(F.coalesce("spans", F.array().cast("array<long>")))
                    .alias("spans")))


def op10_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).drop("spans")


ORACLE_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), wins AS (
  SELECT doc_id, s, md5(array_to_string(w[s:s + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS s FROM dw WHERE len(w) >= 50)
), firsts AS (SELECT h, min(doc_id) AS first FROM wins GROUP BY h HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, k FROM (
    SELECT doc_id, unnest(generate_series(s, s + 49)) AS k FROM wins JOIN firsts USING (h) WHERE doc_id > first)
), kept AS (
  SELECT d.doc_id, string_agg(d.word, ' ' ORDER BY d.k) AS t
  FROM (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS k FROM dw) d
  ANTI JOIN gone g ON d.doc_id = g.doc_id AND d.k = g.k GROUP BY d.doc_id
)
SELECT dw.doc_id, CAST(len(dw.w) AS BIGINT) AS n_words, CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM dw LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""
