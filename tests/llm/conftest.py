"""Small tables with every awkward case, and a generator of texts with copies."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, h int, run string, cls string"


def frame(spark, rows, schema=SCHEMA):
    """(doc_id, text) rows as documents, with extra columns whose names operators use inside."""
    return spark.createDataFrame([(i, t, None, "s", None, "x", 1, "y", "z") for i, t in rows], schema)


def corpus(seed, n=60, words=120):
    """Texts with copies, edited copies, shared passages, repeated words and blank texts."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice(["th", "er", "on", "an", "é", "sch"]) for _ in range(rng.randint(1, 4))) + rng.choice(["", "", ".", ","])
             for _ in range(400)]
    passage = [rng.choice(vocab) for _ in range(70)]
    texts = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.4 or not texts:
            w = [rng.choice(vocab) for _ in range(rng.randint(1, words))]
        elif kind < 0.55:
            w = rng.choice(texts).split()
        elif kind < 0.75:
            w = rng.choice(texts).split()
            for _ in range(rng.randint(1, 4)):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(vocab)
        elif kind < 0.9:
            at = rng.randint(0, 20)
            w = [rng.choice(vocab) for _ in range(40)]
            w[at:at] = passage[rng.randint(0, 10):70 - rng.randint(0, 8)]
        else:
            w = [rng.choice(vocab)] * rng.randint(1, 130)
        texts.append(rng.choice([" ", " ", "\n", "  "]).join(w))
    ids = rng.sample(range(1000), n)
    rows = list(zip(ids, texts))
    rows += [(2000, None), (2001, ""), (2002, " \n\t"), (2003, texts[0]), rows[0], rows[0], (None, texts[1]), (None, texts[1]),
             (2004, "x" * 400), (2005, "x" * 300), (2006, "A b C"), (2007, "a B c")]
    rng.shuffle(rows)
    return rows


@pytest.fixture
def docs(spark):
    return lambda rows: frame(spark, rows)
