"""Spelling variants and BPE against brute force and the public tokenizer library."""

import hashlib
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from tokenizers import Tokenizer

import public_tokenizers
from threadline.llm import bpe, spelling

from .conftest import corpus, frame

VOCAB = public_tokenizers.path("byte_bpe_50k.json")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_variants(rows, modulus=97):
    count = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(AZ)
            h = crc32(f"{'' if i is None else i}:{w}".encode())
            if h % modulus == 0:
                at = h % len(w)
                w = w[:at] + w[at + 1:]
            count[w] += 1
    count = {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}
    near = {w: [v for v in count if one_edit(w, v)] for w in count}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda v: (-count[v], v), default=None)
        form[w] = best if best is not None and count[best] >= 2 * count[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n, len(near[w]), count[form[w]] if form[w] else -1) for w, n in count.items())


def misspelt(seed, n=120):
    """Texts of words with many one-letter edits of each other, chains of them and accents."""
    rng = random.Random(seed)
    letters = "aeinorsté÷z"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(25)]
    words = list(base)
    for _ in range(250):
        w = rng.choice(words)
        at = rng.randrange(len(w) + 1)
        words.append(rng.choice([w[:at] + rng.choice(letters) + w[at:], w[:at] + w[at + 1:], w[:at] + rng.choice(letters) + w[at + 1:]]) or "a")
    weights = [rng.choice([1, 1, 2, 5, 40]) for _ in words]
    return [(k, rng.choice([" ", ", ", "-", "1"]).join(
        w.upper() if rng.random() < 0.1 else w for w in rng.choices(words, weights, k=rng.randint(0, 60)))) for k in range(n)]


def variants_of(spark, rows, **kw):
    got = spelling.variants(frame(spark, rows), **kw)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in got.collect())


@pytest.mark.parametrize("n_symbols", [2, 8])
def test_variants(spark, n_symbols):
    rows = misspelt(3) + [(None, "stones stones stones"), (500, None), (501, ""), (502, "x" * 3000 + " " + "x" * 3000 + " " + "x" * 2999),
                          (502, "x" * 3000), (503, "x" * 2999 + " " + "x" * 2999)]
    assert variants_of(spark, rows, n_symbols=n_symbols) == brute_variants(rows)


def test_variants_with_many_typos_and_hot_reduced_words(spark, monkeypatch):
    rows = misspelt(4, 200)
    monkeypatch.setattr(spelling, "GROUP_WORDS", 3)
    monkeypatch.setattr(spelling, "PAIR_BYTES", 64)
    monkeypatch.setattr(spelling, "FLUSH", 20)
    assert variants_of(spark, rows, typo_modulus=3, n_symbols=2) == brute_variants(rows, 3)


def test_variants_of_an_empty_table(spark):
    assert variants_of(spark, []) == []
    assert variants_of(spark, [(1, None), (2, "abc abc")]) == []


def test_reduced_neighbourhood_is_complete():
    rng = np.random.default_rng(5)
    words = [bytes(rng.integers(0, 3, rng.integers(1, 7)).astype(np.uint8)) for _ in range(40)]
    offs = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    flat = np.frombuffer(b"".join(words), np.uint8).astype(np.uint64)
    got = {k: set() for k in range(len(words))}
    for word, length, code in spelling.neighbourhood(flat, offs, 3):
        for k, n, c in zip(word.tolist(), length.tolist(), code.tolist()):
            got[k].add((n, c))
    for k, w in enumerate(words):
        full = {w} | {w[:i] + w[i + 1:] for i in range(len(w))}
        full |= {w[:i] + bytes([s]) + w[j:] for s in range(3) for i in range(len(w) + 1) for j in (i, i + 1) if j <= len(w)}
        want = set()
        for x in full:
            o = np.array([0, len(x)])
            want.add((len(x), int(spelling.reduced_codes(np.frombuffer(x, np.uint8).astype(np.uint64), o)[0])))
        assert got[k] == want


PIECES = ["a", "the", "'s", "'ll", " ", "  ", "\n", "é", "日本", "<|endoftext|>", "<|endo", "1", "23", "!", "...", "'", "\t", " ", "ab" * 200,
          "\U0001f600", "́", "  "]


def test_bpe_equals_the_library(spark):
    rng = random.Random(6)
    rows = [(k, "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 40)))) for k in range(300)]
    rows += corpus(7) + [(9000, None), (9001, ""), (9002, "<|endoftext|>" * 3), (9003, "ab" * 40_000 + " qz\n\n" * 60_000)]
    lib = Tokenizer.from_file(VOCAB)
    enc = bpe.encode(frame(spark, rows), VOCAB)
    assert enc.columns == ["doc_id", "n_tokens", "ids", "ids_sha256"]
    want = [(i, lib.encode(t or "", add_special_tokens=False).ids) for i, t in rows]
    assert sorted([(r.doc_id, r.ids) for r in enc.collect()], key=repr) == sorted(want, key=repr)
    back = bpe.decode(enc, VOCAB).collect()
    assert sorted([(r.doc_id, r.n_tokens, r.ids_sha256, r.text) for r in back], key=repr) == sorted(
        [(i, len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(), lib.decode(x, skip_special_tokens=False)) for i, x in want], key=repr)


def test_bpe_decodes_any_ids(spark):
    rng = random.Random(8)
    lists = [[rng.randrange(50257) for _ in range(rng.randint(0, 30))] for _ in range(50)] + [None, []]
    df = spark.createDataFrame([(k, x, "old") for k, x in enumerate(lists)], "doc_id long, ids array<int>, text string")
    lib = Tokenizer.from_file(VOCAB)
    got = {r.doc_id: r.text for r in bpe.decode(df, VOCAB).collect()}
    assert got == {k: lib.decode(x or [], skip_special_tokens=False) for k, x in enumerate(lists)}


def test_bpe_of_an_empty_table(spark):
    assert bpe.decode(bpe.encode(frame(spark, []), VOCAB), VOCAB).collect() == []


def naive(vocab, piece):
    sym = vocab.first[np.frombuffer(piece, np.uint8)].tolist()
    while True:
        ranks = [vocab.rank_of.get(a * vocab.size + b, 10**9) for a, b in zip(sym, sym[1:])]
        if not ranks or min(ranks) == 10**9:
            return sym
        at = ranks.index(min(ranks))
        sym[at:at + 2] = [int(vocab.made[ranks[at]])]


def test_segment_trees_merge_as_the_naive_rule():
    with open(VOCAB, encoding="utf-8") as f:
        vocab = bpe.Vocabulary(f.read())
    rng = random.Random(9)
    pieces = [bytes(rng.choice(b"abeehinrst \xc3\xa9") for _ in range(rng.randint(1, 70))) for _ in range(300)] + [b"a", b"aa", b"aaaaaaa" * 50]
    for p, ids in zip(pieces, bpe.merge_pieces(vocab, pieces)):
        assert ids.tolist() == naive(vocab, p) == bpe.merge_one(vocab, p).tolist()


def test_bpe_cache_may_be_emptied():
    with open(VOCAB, encoding="utf-8") as f:
        vocab = bpe.Vocabulary(f.read())
    texts = [t or "" for _, t in corpus(10)]
    assert bpe.Encoder(vocab, cache=10).encode_all(texts) == bpe.Encoder(vocab).encode_all(texts)
