"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks.

A text is split at the added tokens of the vocabulary, the rest into pieces by the
byte-level pattern, and every piece is merged on its own.  The leaves of a piece's
segment tree are its symbols; a leaf holds ``rank * width + place`` of the pair
that its symbol makes with the next living symbol, so the root names the
leftmost pair of the lowest rank.  A merge changes three leaves (the pair, its dead
right half, the pair on the left), each with one update per level, until the
root is empty.  Pieces of a batch are merged together, one numpy row each, by tree width;
a piece above ``ROW_BYTES`` has a tree of its own.  Distinct pieces are
merged once and kept in a table of at most ``CACHE`` pieces per task, which is emptied when full.

Decoding concatenates the bytes of the tokens and reads them as UTF-8, bytes that are not
UTF-8 as U+FFFD.

The vocabulary file is read on the driver and shipped once per executor; its
size does not depend on the data.  Documents stay where they are (no shuffle), a text
is handled in bounded stretches of pieces and ids.

Defined cases: a null text is an empty text and has no ids; null ids of decoding
decode to an empty text; bytes that are not UTF-8 count as U+FFFD; repeated rows
and null row ids are kept as they are; an empty table gives no rows; extra columns are dropped.
"""

from __future__ import annotations

import codecs
import json
from hashlib import sha256
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from threadline.llm.common import documents, small_batches, to_lists

#: Fixed value: the pattern of the byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ROW_BYTES = 256
CACHE = 1_000_000
STRETCH = 200_000


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a vocabulary file: printable bytes stand for
    themselves, the others are numbered from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merge ranks and added tokens of a byte-level BPE vocabulary (JSON text of the public format)."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model, letters = spec["model"], byte_letters()
        kind = (spec.get("pre_tokenizer") or {}).get("type")
        if model.get("type", "BPE") != "BPE" or kind != "ByteLevel" or spec.get("normalizer"):
            raise ValueError("not a plain byte-level BPE vocabulary")
        added = spec.get("added_tokens", [])
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("added tokens that look at their neighbours are not supported")
        vocab = model["vocab"]
        self.size = max([*vocab.values(), *(t["id"] for t in added)]) + 1
        self.bytes = [b""] * self.size
        for token, k in vocab.items():
            self.bytes[k] = bytes(letters[c] for c in token)
        self.first = np.full(256, -1, np.int64)
        for token, k in vocab.items():
            if len(token) == 1:
                self.first[letters[token]] = k
        if (self.first < 0).any():
            raise ValueError("a byte has no token")
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        key = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks = np.append(key[order], np.int64(2**62)), np.append(order, 0)
        self.rank_of = dict(zip(key.tolist(), range(len(pairs))))
        self.added = {}
        for t in added:
            self.added[t["content"]] = t["id"]
            self.bytes[t["id"]] = t["content"].encode()
        #: the longest of several added tokens at one place wins
        names = sorted(self.added, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.pieces = regex.compile(PATTERN)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, -1 where they do not merge."""
        key = left * self.size + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], -1)


def merge_rows(vocab: Vocabulary, symbols: np.ndarray, length: np.ndarray) -> list[np.ndarray]:
    """Token ids of pieces of one tree width: row k of ``symbols`` holds ``length[k]`` symbols."""
    rows, width = symbols.shape
    none = np.int64(2**62)
    place = np.arange(width)
    after = np.broadcast_to(place + 1, (rows, width)).copy()
    before = np.broadcast_to(place - 1, (rows, width)).copy()
    sym = symbols.copy()
    tree = np.full((rows, 2 * width), none)
    if width > 1:
        rank = vocab.pair_ranks(sym[:, :-1], sym[:, 1:])
        real = (rank >= 0) & (place[1:] < length[:, None])
        tree[:, width:2 * width - 1] = np.where(real, rank * width + place[:-1], none)
    for node in range(width - 1, 0, -1):
        np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])

    def put(row, leaf, value):
        node = leaf + width
        tree[row, node] = value
        while width > 1 and node[0] > 1:  # all leaves are on one level
            node = node >> 1
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])

    def pair(row, left, right):
        rank = vocab.pair_ranks(sym[row, left], sym[row, right])
        return np.where(rank >= 0, rank * width + left, none)

    live = np.flatnonzero(tree[:, 1] < none) if width > 1 else np.zeros(0, np.int64)
    while len(live):
        rank, at = np.divmod(tree[live, 1], width)
        dead = after[live, at]
        sym[live, at] = vocab.made[rank]
        then = after[live, dead]
        after[live, at] = then
        put(live, dead, none)
        inner = then < length[live]
        before[live[inner], then[inner]] = at[inner]
        value = np.full(len(live), none)
        value[inner] = pair(live[inner], at[inner], then[inner])
        put(live, at, value)
        left = before[live, at]
        some = left >= 0
        if some.any():
            put(live[some], left[some], pair(live[some], left[some], at[some]))
        live = live[tree[live, 1] < none]
    out = []
    alive = np.zeros((rows, width), bool)
    at = np.zeros(rows, np.int64)
    row = np.flatnonzero(length > 0)
    while len(row):
        alive[row, at[row]] = True
        at[row] = after[row, at[row]]
        row = row[at[row] < length[row]]
    flat, count = sym[alive], alive.sum(axis=1)
    cut = np.cumsum(count) - count
    for k in range(rows):
        out.append(flat[cut[k]:cut[k] + count[k]])
    return out


def merge_one(vocab: Vocabulary, piece: bytes) -> np.ndarray:
    """Token ids of one long piece, by a segment tree in lists."""
    sym = vocab.first[np.frombuffer(piece, np.uint8)]
    n = len(sym)
    width = 1 << max(0, n - 1).bit_length()
    none = 2**62
    rank = vocab.pair_ranks(sym[:-1], sym[1:])
    leaves = np.full(width, none)
    leaves[:n - 1] = np.where(rank >= 0, rank * width + np.arange(n - 1), none)
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append(np.minimum(levels[-1][::2], levels[-1][1::2]))
    tree = [none] + list(chain.from_iterable(x.tolist() for x in reversed(levels)))
    sym, after, before = sym.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
    size, rank_of, made = vocab.size, vocab.rank_of, vocab.made.tolist()

    def put(leaf, value):
        node = leaf + width
        tree[node] = value
        while node > 1:
            low = min(tree[node], tree[node ^ 1])
            node >>= 1
            if tree[node] == low:
                return
            tree[node] = low

    while width > 1 and tree[1] < none:
        rank, at = divmod(tree[1], width)
        dead = after[at]
        then = after[at] = after[dead]
        sym[at], sym[dead] = made[rank], -1
        put(dead, none)
        value = none
        if then < n:
            before[then] = at
            r = rank_of.get(sym[at] * size + sym[then])
            value = none if r is None else r * width + at
        put(at, value)
        left = before[at]
        if left >= 0:
            r = rank_of.get(sym[left] * size + sym[at])
            put(left, none if r is None else r * width + left)
    return np.array([s for s in sym if s >= 0], np.int64)


def merge_pieces(vocab: Vocabulary, pieces: list[bytes]) -> list[np.ndarray]:
    """Token ids of each piece."""
    out: list = [None] * len(pieces)
    by_width: dict[int, list[int]] = {}
    for k, p in enumerate(pieces):
        if len(p) > ROW_BYTES:
            out[k] = merge_one(vocab, p)
        else:
            by_width.setdefault(1 << max(0, len(p) - 1).bit_length(), []).append(k)
    for width, all_rows in by_width.items():
        step = max(1, (1 << 20) // width)
        for at in range(0, len(all_rows), step):
            which = all_rows[at:at + step]
            length = np.array([len(pieces[k]) for k in which], np.int64)
            raw = np.frombuffer(b"".join(pieces[k].ljust(width, b"\0") for k in which), np.uint8)
            for k, ids in zip(which, merge_rows(vocab, vocab.first[raw].reshape(len(which), width), length)):
                out[k] = ids
    return out


class Encoder:
    """Encodes texts; keeps the ids (little-endian unsigned 32-bit bytes) of the pieces it has met."""

    def __init__(self, vocab: Vocabulary, cache: int = CACHE):
        self.vocab, self.limit, self.known = vocab, cache, {}

    def _learn(self, pieces) -> None:
        new = list({p for p in pieces if p not in self.known})
        if len(self.known) + len(new) > self.limit:
            self.known.clear()
            new = list(set(pieces))
        for p, ids in zip(new, merge_pieces(self.vocab, [p.encode() for p in new])):
            self.known[p] = ids.astype("<u4").tobytes()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        vocab = self.vocab
        out = []
        group: list[list] = []

        def done():
            self._learn([p for parts in group for x in parts if not isinstance(x, int) for p in x])
            get = self.known.__getitem__
            for parts in group:
                out.append(b"".join(x.to_bytes(4, "little") if isinstance(x, int) else b"".join(map(get, x)) for x in parts))
            group.clear()

        held = 0
        for text in texts:
            if len(text) > STRETCH:
                if group:
                    done()
                held = 0
                out.append(self._long(text))
                continue
            group.append([vocab.added[x] if k % 2 else vocab.pieces.findall(x)
                          for k, x in enumerate(vocab.split.split(text) if vocab.split else [text])])
            held += len(text)
            if held > 2_000_000:
                done()
                held = 0
        if group:
            done()
        return out

    def _long(self, text: str) -> bytes:
        """A long text, a stretch of pieces at a time."""
        vocab, parts = self.vocab, []
        for k, x in enumerate(vocab.split.split(text) if vocab.split else [text]):
            if k % 2:
                parts.append(vocab.added[x].to_bytes(4, "little"))
                continue
            found = (m.group() for m in vocab.pieces.finditer(x))
            while some := list(islice(found, STRETCH)):
                self._learn(some)
                parts.append(b"".join(map(self.known.__getitem__, some)))
        return b"".join(parts)


def decode_ids(vocab: Vocabulary, ids: np.ndarray) -> str:
    """The text of token ids (unknown ids have no bytes)."""
    reader = codecs.getincrementaldecoder("utf-8")("replace")
    tokens, n = vocab.bytes, vocab.size
    parts = []
    for at in range(0, len(ids), STRETCH):
        parts.append(reader.decode(b"".join([tokens[k] if 0 <= k < n else b"" for k in ids[at:at + STRETCH].tolist()])))
    return "".join(parts) + reader.decode(b"", True)


def _shipped(spark: SparkSession, path: str):
    with open(path, encoding="utf-8") as f:
        source = f.read()
    Vocabulary(source)  # a wrong file fails here
    return spark.sparkContext.broadcast(source)


def encode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids array<int>, ids_sha256 (ids as little-endian unsigned 32-bit integers)."""
    shipped = _shipped(docs.sparkSession, vocab_path)

    def rows(batches):
        encoder = Encoder(Vocabulary(shipped.value))
        for b in batches:
            raw = b.column("text")
            for i, j in _stretches(raw):
                texts = [(x or b"").decode("utf-8", "replace") for x in raw.slice(i, j - i).to_pylist()]
                got = encoder.encode_all(texts)
                count = np.array([len(x) // 4 for x in got], np.int64)
                flat = np.frombuffer(b"".join(got), "<u4").astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, j - i), pa.array(count), to_lists(flat, count, pa.int32()),
                     pa.array([sha256(x).hexdigest() for x in got])], names=["doc_id", "n_tokens", "ids", "ids_sha256"])

    small_batches(docs.sparkSession)
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
            .mapInArrow(rows, f"doc_id {kind}, n_tokens long, ids array<int>, ids_sha256 string"))


def _stretches(raw: pa.Array, limit: int = 8 << 20):
    """Ranges of rows with about ``limit`` bytes each (one row at least)."""
    size = np.cumsum(pc.fill_null(pc.binary_length(raw), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    i, n = 0, len(raw)
    while i < n:
        j = max(i + 1, int(np.searchsorted(size, (size[i - 1] if i else 0) + limit, side="right")))
        yield i, min(j, n)
        i = j


def decode(encoded: DataFrame, vocab_path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``encoded`` with the text of its ids in ``text_col``, in place of the ids."""
    shipped = _shipped(encoded.sparkSession, vocab_path)
    keep = [c for c in encoded.columns if c not in (ids_col, text_col)]
    whole = encoded.select(*keep, F.col(ids_col).alias(ids_col))

    def rows(batches):
        vocab = Vocabulary(shipped.value)
        for b in batches:
            ids = b.column(ids_col)
            texts = []
            for k in range(len(ids)):
                x = ids[k].values
                texts.append("" if x is None else decode_ids(vocab, x.to_numpy(zero_copy_only=False)))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(texts, pa.string())], names=[*keep, text_col])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in whole.select(*keep).schema) + f", `{text_col}` string"
    return whole.mapInArrow(rows, schema)


def op13_bpe(spark: SparkSession, sf_dir: str, vocab_path: str | None = None) -> DataFrame:
    """Encode and decode every document with the public byte-level vocabulary (or the given file)."""
    if vocab_path is None:
        import public_tokenizers

        vocab_path = public_tokenizers.path("byte_bpe_50k.json")
    done = decode(encode(documents(spark, sf_dir), vocab_path), vocab_path)
    return done.select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))
