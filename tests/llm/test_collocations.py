"""Phrase collocations against brute force."""

import random
import re
from collections import Counter

import pytest

from threadline.llm import collocations

from .conftest import SCHEMA

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=100, top=2000, longest=5):
    f, n = Counter(), Counter()
    for _, t, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (t or "").translate(AZ)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, *w[i:i + k]) for i in range(len(w) - k + 1))
    f = {p: c for p, c in f.items() if c >= least}
    dropped = set()
    for p, c in f.items():
        w = p[1:]
        for m in range(2, len(w)):
            for s in range(len(w) - m + 1):
                q = (p[0], *w[s:s + m])
                if 100 * c >= 100 * f[q]:
                    dropped.add(q)
    out = []
    for lang in n:
        found = []
        for p, a in f.items():
            if p[0] != lang or len(p) < 3 or p in dropped:
                continue
            score, k = min((1000 * a * n[lang] // (f[p[:1 + k]] * f[(lang, *p[1 + k:])]), k) for k in range(1, len(p) - 1))
            found.append((-score, -a, " ".join(p[1:]).encode(), f[p[:1 + k]], f[(lang, *p[1 + k:])]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def phrases(seed, n=80, lang=("en", "fr", None, "und")):
    rng = random.Random(seed)
    common = ["the", "of", "The", "é", "in", "a b", "x-y", "日本"]
    fixed = ["new york city hall", "as well as", "a a a a a a", "one two three four five six", "of the"]
    rows = []
    for k in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice(common) for _ in range(rng.randint(0, 60))]
        rows.append((k, "".join(p + rng.choice([" ", " ", " ", "\t ", ", ", ".", "\n", " \r"]) for p in parts), rng.choice(lang)))
    return rows


def of(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, lang, "s", None, "x", 1, "y", "z") for i, t, lang in rows], SCHEMA)
    got = collocations.collocations(df.repartition(5), **kw)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("least,shards,bits", [(3, 4, 1 << 20), (10, 1, 1 << 20), (2, 3, 64)])
def test_collocations(spark, least, shards, bits):
    # a filter of 64 bits lets nearly everything pass: counts must not change
    rows = phrases(1) + [(900, None, "en"), (901, "", None), (902, "the of " * 300, "fr"), (903, ". , !", "de"), (None, "as well as", "en"), (5, "as well as", "en")]
    want = brute(rows, least)
    assert want and of(spark, rows, least=least, n_shards=shards, filter_bits=bits) == want


def test_top_and_late_phrases(spark, monkeypatch):
    monkeypatch.setattr(collocations, "FLUSH", 50)
    # one long text: whatever is frequent becomes so in one shard only
    rows = [(1, "a b c d e f g " * 40, "en"), *((k, "q", "en") for k in range(2, 40))] + phrases(2, 30)
    assert of(spark, rows, least=30, top=3) == brute(rows, 30, 3)


def test_none(spark):
    assert of(spark, []) == []
    assert of(spark, [(1, "rare words only", "en"), (2, None, None)]) == []


def test_products_beyond_64_bits(spark):
    n, f, g = 4 * 10**14, 3 * 10**12 + 7, 2 * 10**12 + 1
    a = 10**12 + 9
    phrases = spark.createDataFrame([("en", "x", 1, f), ("en", "y", 1, g), ("en", "x y", 2, a)], "lang string, phrase string, k int, f long")
    words = spark.createDataFrame([("en", n)], "lang string, n long")
    got = collocations.ranked(phrases, words).collect()
    assert list(map(tuple, got)) == [("en", 1, "x y", a, f, g, n, 1000 * a * n // (f * g))]
