"""Spelling variant grouping by reduced-alphabet generation.

Vocabulary.  Words are runs of letters; those of a bounded slice of texts are counted in
the task before they are shuffled.

Generation.  Letters are hashed to ``SYMBOLS`` symbols (frequent letters to different
ones), so a word becomes a reduced word.  For every word all reduced words within one
edit are generated: the reduced word itself (an edit may stay inside a symbol), every
deletion, every replacement and every insertion of a symbol.  Words one edit
apart have reduced words at most one edit apart, so this loses nothing.  A bit filter
of the reduced vocabulary, of at most ``FILTER_BITS`` bits whatever the corpus, drops neighbours
that cannot be in it; what passes by chance finds no partner in the join.

Join.  Generated neighbours meet the words of that reduced word, sorted by (length, code); the
words themselves are compared, in numpy blocks of bounded size, and each probe word leaves one
row per reduced word: how many near words, and the best.  A reduced word with many
partners is dealt to several tasks by a salt of the probe word, each with a copy of the
vocabulary words of that reduced word, so no task holds an unbounded number of pairs.

Forms.  A form has at least twice the count of its word, so chains are at most log2 long; they
are followed by pointer doubling, one join per doubling.

Defined cases: null text has no words; a null id counts as empty text before the colon of the
hashed run; repeated rows count again; words of any length; extra columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from threadline.llm.common import BASE, BASE_INV, as_int64, checkpointed, documents, mix, powers, small_batches, sorted_groups

#: Fixed value: the letters of a run, A-Z a-z and U+00C0 to U+00FF (one Latin-1 byte each).
LETTER = bytes(b if 97 <= b < 123 or b >= 0xC0 else b + 32 if 65 <= b < 91 else 32 for b in range(256))
MIN_LENGTH, MIN_COUNT = 5, 3
TYPO_MODULUS = 97
SYMBOLS = 8
FILTER_BITS = 1 << 27
FLUSH = 400_000
PAIR_BYTES = 1 << 24
GROUP_WORDS = 2000
WORD_BATCH = 20_000
_EDGE = np.uint64(0x9E3779B97F4A7C15)
_STEP, _BACK = np.uint64(BASE), np.uint64(BASE_INV)


def text_words(doc_id, text: bytes, typo_modulus: int = TYPO_MODULUS) -> dict[bytes, int]:
    """Counts of the words (Latin-1) of one text (UTF-8), with one letter dropped where the hash of id and run says so."""
    runs = text.decode("utf-8", "replace").encode("latin-1", "replace").translate(LETTER).split()
    count: dict[bytes, int] = {}
    for w in runs:
        count[w] = count.get(w, 0) + 1
    if typo_modulus:
        start = crc32(b"%s:" % ("" if doc_id is None else str(doc_id)).encode())
        hit = []
        for w in count:
            h = crc32(w if w.isascii() else w.decode("latin-1").encode(), start)
            if not h % typo_modulus:
                hit.append((w, h))
        moved = [(w, h, count.pop(w)) for w, h in hit]
        for w, h, n in moved:
            at = h % len(w)
            w = w[:at] + w[at + 1:]
            if w:
                count[w] = count.get(w, 0) + n
    return count


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", typo_modulus: int = TYPO_MODULUS,
               min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): distinct words of at least ``min_length`` letters and ``min_count`` occurrences."""
    def rows(batches):
        total: dict[bytes, int] = {}

        def flush():
            words = [w.decode("latin-1") for w in total]
            out = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for b in batches:
            for doc_id, text in zip(b.column("id").to_pylist(), b.column("text").to_pylist()):
                for w, n in text_words(doc_id, text or b"", typo_modulus).items():
                    if len(w) >= min_length:
                        total[w] = total.get(w, 0) + n
                if len(total) > FLUSH:
                    yield flush()
        if total:
            yield flush()

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
            .mapInArrow(rows, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def letter_symbols(vocab: DataFrame, symbols: int = SYMBOLS) -> np.ndarray:
    """Symbol of each Latin-1 letter: letters by frequency, dealt in turn (256 rows at most reach the driver)."""
    def count(batches):
        total = np.zeros(256, np.int64)
        for b in batches:
            for w in b.column("word"):
                total += np.bincount(np.frombuffer(w.as_py().encode("latin-1"), np.uint8), minlength=256)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["letter", "n"])

    got = vocab.select("word").mapInArrow(count, "letter long, n long").groupBy("letter").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(256, np.uint64)
    for k, r in enumerate(sorted(got, key=lambda r: (-r.n, r.letter))):
        out[r.letter] = k % symbols
    return out


def reduced_codes(symbols: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """64-bit code of each reduced word."""
    h = _prefix(symbols)
    return _finish((h[offs[1:]] - h[offs[:-1]]) * powers(len(h))[1][offs[:-1]], np.diff(offs))


def _prefix(symbols: np.ndarray) -> np.ndarray:
    out = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum((symbols + np.uint64(1)) * powers(len(symbols))[0], out=out[1:])
    return out


def _finish(code: np.ndarray, length: np.ndarray) -> np.ndarray:
    return mix(code + length.astype(np.uint64) * _EDGE)


def neighbourhood(symbols: np.ndarray, offs: np.ndarray, n_symbols: int = SYMBOLS):
    """(word, length, code) arrays of all reduced words within one edit of each reduced word, a kind at a time.

    A word may meet a code more than once (deletions inside a run of one symbol and the like).
    """
    size = np.diff(offs)
    up, down = powers(len(symbols) + 2)
    prefix = _prefix(symbols)
    at = np.arange(len(symbols))
    word = np.repeat(np.arange(len(size)), size)
    head = prefix[at] - prefix[offs[word]]          # left of the place, at its absolute height
    tail = prefix[offs[word + 1]] - prefix[at + 1]   # right of it
    base = down[offs[word]]
    whole = np.arange(len(size))
    yield whole, size, _finish((prefix[offs[1:]] - prefix[offs[:-1]]) * down[offs[:-1]], size)
    yield word, size[word] - 1, _finish((head + tail * _BACK) * base, size[word] - 1)
    for s in range(n_symbols):
        letter = np.uint64(s + 1)
        other = symbols != np.uint64(s)
        yield word[other], size[word[other]], _finish((head + letter * up[at] + tail)[other] * base[other], size[word[other]])
        after = prefix[offs[word + 1]] - prefix[at]   # insertion before the place
        yield word, size[word] + 1, _finish((head + letter * up[at] + after * _STEP) * base, size[word] + 1)
        end = offs[1:]                                # insertion at the end
        yield whole, size + 1, _finish(((prefix[end] - prefix[offs[:-1]]) + letter * up[end]) * down[offs[:-1]], size + 1)


def _flat(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Latin-1 bytes of all words and their offsets."""
    raw = [w.encode("latin-1") for w in words.to_pylist()]
    offs = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(w) for w in raw], out=offs[1:])
    return np.frombuffer(b"".join(raw), np.uint8), offs


def _pieces(offs: np.ndarray, limit: int):
    """Ranges of words with about ``limit`` letters."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1))
        yield i, j
        i = j


def filter_of(codes: DataFrame, bits: int) -> np.ndarray:
    """Bit filter of a column ``code``; at most bits / 64 rows of 64 bits reach the driver."""
    slot = F.pmod(F.col("code"), F.lit(bits))
    got = (codes.select(F.shiftright(slot, 6).alias("at"), F.expr("shiftleft(1L, cast(pmod(code, 64) as int))").alias("bit"))
           .groupBy("at").agg(F.bit_or("bit").alias("bit")).toArrow())
    out = np.zeros(bits // 64, np.int64)
    out[got.column("at").to_numpy()] = got.column("bit").to_numpy()
    return out.view(np.uint64)


def _passes(bits: np.ndarray, codes: np.ndarray) -> np.ndarray:
    slot = codes & np.uint64(len(bits) * 64 - 1)
    return (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def near_pairs(probe: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Whether each probe (rows of letters) is one edit from the word beside it; the two matrices have a width each."""
    a, b = (probe, word) if probe.shape[1] <= word.shape[1] else (word, probe)
    n = a.shape[1]
    if n == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    same = a == b[:, :n]
    front = np.where(same.all(axis=1), n, np.argmin(same, axis=1)) if n else np.zeros(len(a), np.int64)
    same = (a == b[:, 1:])[:, ::-1]
    back = np.where(same.all(axis=1), n, np.argmin(same, axis=1)) if n else front
    return front + back >= n


def _compare(batches):
    """One row per probe word and reduced word: the near words among those of the reduced word.

    Rows come sorted by (length, g), where g names a reduced word and its salt; ``own`` marks the
    words of the reduced word.
    """
    def groups(t):
        """Near words of the probes of complete groups, all of one length."""
        own = t.column("own").to_numpy(zero_copy_only=False)
        key = t.column("g").to_numpy()
        length = int(t.column("length")[0].as_py())
        new = np.ones(len(own), bool)
        new[1:] = key[1:] != key[:-1]
        group = np.cumsum(new) - 1
        words, n = t.column("word").combine_chunks(), t.column("n").to_numpy()
        mine = np.flatnonzero(own)
        members = np.bincount(group[mine], minlength=group[-1] + 1)
        first = np.cumsum(members) - members
        flat, offs = _flat(words.take(pa.array(mine)))
        table = flat.reshape(len(mine), length)
        probes = np.flatnonzero(~own)
        probes = probes[members[group[probes]] > 0]
        if not len(probes):
            return
        raw, cut = _flat(words.take(pa.array(probes)))
        size = np.diff(cut)
        for width in np.unique(size):
            rows = np.flatnonzero(size == width)
            letters = raw[(cut[rows][:, None] + np.arange(width)[None, :])]
            many = members[group[probes[rows]]]
            for i, j in _pieces(np.concatenate([[0], np.cumsum(many * (length + 1))]), PAIR_BYTES):
                # a probe with very many partners takes them in turn
                total = int(many[i:j].sum())
                for lo in range(0, total, max(1, PAIR_BYTES // (length + 1))):
                    hi = min(total, lo + max(1, PAIR_BYTES // (length + 1)))
                    ends = np.cumsum(many[i:j])
                    pair = np.arange(lo, hi)
                    which = np.searchsorted(ends, pair, side="right")
                    partner = first[group[probes[rows[i + which]]]] + pair - (ends - many[i:j])[which]
                    near = near_pairs(letters[i + which], table[partner])
                    if near.any():
                        yield probes[rows[i + which[near]]], mine[partner[near]], words, n

    def emit(t):
        for probe, partner, words, n in groups(t):
            # best partner of each probe: largest n, then smallest word
            best = pa.table({"p": pa.array(probe), "n": pa.array(-n[partner]), "w": words.take(pa.array(partner))})
            best = best.sort_by([("p", "ascending"), ("n", "ascending"), ("w", "ascending")])
            p = best.column("p").to_numpy()
            head = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
            yield pa.RecordBatch.from_arrays(
                [words.take(pa.array(p[head])), pa.array(np.diff(np.append(head, len(p))).astype(np.int64)),
                 pa.array(-best.column("n").to_numpy()[head]), best.column("w").combine_chunks().take(pa.array(head))],
                names=["word", "n_near", "best_n", "best"])

    for t in sorted_groups(batches, "g"):
        length = t.column("length").to_numpy()
        cuts = np.append(np.flatnonzero(np.concatenate([[True], length[1:] != length[:-1]])), len(length))
        for s, e in zip(cuts[:-1], cuts[1:]):
            yield from emit(t.slice(s, e - s))


def near_words(vocab: DataFrame, n_symbols: int = SYMBOLS, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(word, n_near, best, best_n) of the words with near words; ``vocab`` is a written table (word, n)."""
    spark = vocab.sparkSession
    symbol = letter_symbols(vocab, n_symbols)

    def own(batches):
        for b in batches:
            flat, offs = _flat(b.column("word"))
            for i, j in _pieces(offs, 1 << 20):
                o = offs[i:j + 1] - offs[i]
                codes = reduced_codes(symbol[flat[offs[i]:offs[j]]], o)
                yield pa.RecordBatch.from_arrays([b.column("word").slice(i, j - i), b.column("n").slice(i, j - i),
                                                  pa.array(np.diff(o).astype(np.int32)), pa.array(as_int64(codes))],
                                                 names=["word", "n", "length", "code"])

    mine = checkpointed(vocab.select("word", "n").mapInArrow(own, "word string, n long, length int, code long"))
    bits = 1 << 20
    while bits < min(filter_bits, 32 * mine.count()):
        bits *= 2
    shared = spark.sparkContext.broadcast(filter_of(mine.select("code"), bits))

    def probes(batches):
        known = shared.value
        for b in batches:
            flat, offs = _flat(b.column("word"))
            for i, j in _pieces(offs, 1 << 16):
                o = offs[i:j + 1] - offs[i]
                found = []
                for word, length, code in neighbourhood(symbol[flat[offs[i]:offs[j]]], o, n_symbols):
                    ok = _passes(known, code)
                    found.append((word[ok], length[ok], code[ok]))
                word, length, code = (np.concatenate(x) for x in zip(*found))
                order = np.lexsort((code, length, word))
                word, length, code = word[order], length[order], code[order]
                new = np.ones(len(word), bool)
                new[1:] = (word[1:] != word[:-1]) | (length[1:] != length[:-1]) | (code[1:] != code[:-1])
                word, length, code = word[new], length[new], code[new]
                yield pa.RecordBatch.from_arrays(
                    [b.column("word").take(pa.array(i + word)), b.column("n").take(pa.array(i + word)),
                     pa.array(length.astype(np.int32)), pa.array(as_int64(code))], names=["word", "n", "length", "code"])

    asked = vocab.select("word", "n").mapInArrow(probes, "word string, n long, length int, code long")
    # reduced words with very many words are dealt to several tasks, by a salt of the probe
    hot = mine.groupBy("length", "code").agg(F.ceil(F.count("*") / GROUP_WORDS).cast("int").alias("salts")).where("salts > 1")
    hot = checkpointed(hot)
    if hot.isEmpty():
        asked, held = asked.withColumn("salt", F.lit(0)), mine.withColumn("salt", F.lit(0))
    else:
        asked = (asked.join(hot, ["length", "code"], "left")
                 .withColumn("salt", F.pmod(F.xxhash64("word"), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts"))
        held = (mine.join(hot, ["length", "code"], "left")
                .withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts"))
    cols = ["length", F.xxhash64("length", "code", "salt").alias("g"), "word", "n"]
    both = asked.select(*cols, F.lit(False).alias("own")).unionByName(held.select(*cols, F.lit(True).alias("own")))
    found = (both.repartition("g").sortWithinPartitions("length", "g")
             .mapInArrow(_compare, "word string, n_near long, best_n long, best string"))
    least = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), least.alias("b"))
            .select("word", "n_near", F.col("b.w").alias("best"), (-F.col("b.m")).alias("best_n")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each chain of (word, form), by pointer doubling."""
    now = checkpointed(forms.select("word", F.col("form").alias("root")))
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        then = checkpointed(now.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                  F.col("next").isNotNull().alias("moved")))
        if then.where("moved").isEmpty():
            return then.drop("moved")
        now = then.drop("moved")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", typo_modulus: int = TYPO_MODULUS,
             min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, n_symbols: int = SYMBOLS) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    small_batches(docs.sparkSession)
    vocab = checkpointed(vocabulary(docs, id_col, text_col, typo_modulus, min_length, min_count))
    small_batches(docs.sparkSession, WORD_BATCH)
    near = near_words(vocab, n_symbols)
    formed = checkpointed(vocab.join(near, "word", "left").withColumn("up", F.col("best_n") >= 2 * F.col("n"))
                          .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                  F.when(F.col("up"), F.col("best")).alias("form"), F.when(F.col("up"), F.col("best_n")).alias("form_n")))
    ends = roots(formed.where("form is not null"))
    return (formed.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(documents(spark, sf_dir))
