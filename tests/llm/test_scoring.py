"""Language-model scoring and the quality classifier."""

import math
import re
import zlib

import numpy as np
import pytest

from threadline.llm import lm_score, quality_knn
from threadline.llm.common import LOWER, documents

from .conftest import corpus


def tokens(t):
    return re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().translate(bytes(LOWER))) + [b"\0end"]


@pytest.mark.parametrize("table", [500_000, 20])
def test_base_scores(spark, docs, table, monkeypatch):
    monkeypatch.setattr(lm_score, "TABLE", table)
    monkeypatch.setattr(lm_score, "STEPS", 5)
    rows = corpus(21)
    count = {}
    for i, t in rows:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2:
            for w in tokens(t):
                count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    want = sorted(((repr(i), len(tokens(t)), sum(w in count for w in tokens(t)),
                    sum(math.log10((count.get(w, 0) + 1) / (n + v + 1)) for w in tokens(t))) for i, t in rows))
    got = lm_score.score_documents(docs(rows)).collect()
    assert {r.train_tokens for r in got} == {n}
    have = sorted((repr(r.doc_id), r.n_tokens, r.n_known, r.base_score) for r in got)
    assert [x[:3] for x in have] == [x[:3] for x in want]
    assert [x[3] for x in have] == pytest.approx([x[3] for x in want])
    assert all(r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 7 == 2) for r in got)
    assert all(r.score <= 0 for r in got)


def built_model(words=60, texts=400, seed=0):
    """A model trained on texts in which the word before decides the next one; its vocabulary, shape and word hashes."""
    rng = np.random.default_rng(seed)
    hashes = np.sort(rng.choice(1 << 60, words, replace=False)).astype(np.uint64)
    vocab = lm_score.Vocabulary(hashes, rng.integers(0, 4, words))
    s = vocab.shape
    seqs = []
    for _ in range(texts):
        place = [int(rng.integers(words))]
        for _ in range(30):
            place.append((place[-1] + 7 + int(rng.integers(2))) % words)
        seqs.append(np.array(place))
    return vocab, s, seqs


def trained(vocab, s, seqs):
    pairs = np.zeros((2, s.ctx, s.out), np.float32)
    for place in seqs:
        w = vocab.first_level(place)
        for lag in (1, 2):
            np.add.at(pairs[lag - 1], (np.append(np.full(lag, s.start), w[:-lag]), w), 1)
    first = lm_score.FirstLevel(pairs)
    n_near, n_far = len(first.near_mean), len(first.far)
    triples = np.zeros((n_near, n_far, s.out), np.float32)
    member = np.zeros((s.classes, s.per, s.ctx), np.float32)
    behind = np.zeros((s.classes, s.per, s.out), np.float32)
    for place in seqs:
        w = vocab.first_level(place)
        a1, a2 = np.append(s.start, w[:-1]), np.append([s.start, s.start], w[:-2])
        np.add.at(triples, (first.near_group[a1], first.far_group[a2], w), 1)
        m = place >= s.top
        np.add.at(member, (*np.divmod(place[m] - s.top, s.per), a1[m]), 1)
        m = m[:-1]
        np.add.at(behind, (*np.divmod(place[:-1][m] - s.top, s.per), w[1:][m]), 1)
    first.weigh(triples.ravel())

    class Row:
        pass

    rows = []
    for k in range(s.classes):
        n = min(s.per, s.words - s.top - k * s.per)
        u, d = lm_score.fit_members(member[k][:n].T, first.near_in)
        r = lm_score.fit_contexts(behind[k][:n], first.near[s.top + k], first.q, first.b, first.pn)
        u, r = u.astype(np.float16), r.astype(np.float16)
        x = Row()
        x.block, x.r, x.z1, x.u, x.d = k, r.tobytes(), first.log_z(r).tobytes(), u.tobytes(), d.astype(np.float32).tobytes()
        x.z2 = lm_score.log_sum(first.near_in @ u.astype(np.float32).T + d).astype(np.float32).tobytes()
        rows.append(x)
    return lm_score.Model(s, first, rows)


def every_token(vocab, s):
    """(place, first-level output) of every word of the vocabulary, tail class and the end."""
    place = np.append(np.arange(s.words), np.full(lm_score.TAIL + 1, -1))
    return place, np.append(vocab.first_level(np.arange(s.words)), np.arange(s.tail, s.out))


def test_probabilities_add_up_to_one():
    vocab, s, seqs = built_model()
    m = trained(vocab, s, seqs)
    place, w = every_token(vocab, s)
    rng = np.random.default_rng(1)
    for a2 in rng.integers(0, s.ctx, 5):
        for before in [-1, *rng.integers(0, s.words, 8)]:
            a1 = s.start if before < 0 else vocab.first_level(np.array([before]))[0]
            c1 = s.ctx + before - s.top if before >= s.top else a1
            p = m.log10(place, w, np.full(len(w), c1), np.full(len(w), a1), np.full(len(w), a2))
            assert (10**p).sum() == pytest.approx(1, abs=1e-3)


def test_rare_words_are_outputs_and_contexts_of_their_own():
    # the word before decides the next one: also for words outside the most frequent ones the model must know both
    vocab, s, seqs = built_model()
    assert s.classes > 5
    m = trained(vocab, s, seqs)
    place, w = every_token(vocab, s)
    mass = []
    for before in range(s.top, s.words):
        a1 = vocab.first_level(np.array([before]))[0]
        p = 10 ** m.log10(place, w, np.full(len(w), s.ctx + before - s.top), np.full(len(w), a1), np.full(len(w), s.start))
        mass.append(p[(before + 7) % s.words] + p[(before + 8) % s.words])
    assert np.mean(mass) > 3 * 2 / s.words


def test_vocabulary_grows_with_the_words():
    for n in (0, 1, 5, 1000, 40_000):
        s = lm_score.Layout(n)
        assert s.top + s.classes * s.per >= n > s.top + (s.classes - 1) * s.per - (s.classes == 0)
        assert s.out <= 2 * math.sqrt(n) + lm_score.TAIL + 3
        vocab = lm_score.Vocabulary(np.arange(n, dtype=np.uint64), np.zeros(n, np.int64))
        assert (np.sort(vocab.order) == np.arange(n)).all()


def test_pair_counts_in_spark(spark, docs):
    rows = docs([(i, "a b c a d " * 3 + f"w{i % 3}") for i in range(40)]).selectExpr("true AS train", "text")
    counts = lm_score.word_counts(rows).toPandas()
    counts = counts[counts.h != np.array([lm_score.END_HASH]).view(np.int64)[0]].sort_values(["n", "h"], ascending=[False, True])
    vocab = lm_score.Vocabulary(counts.h.to_numpy().view(np.uint64), counts.cls.to_numpy())
    s = vocab.shape
    table = lm_score.pair_tables(rows, vocab)
    assert table[0].sum() == table[1].sum() == 40 * 17 and table[0, :, s.end].sum() == 40
    groups = np.arange(s.ctx) % 3
    got = lm_score.member_pairs(rows, vocab, groups, groups).toPandas()
    total = {b: sum(np.frombuffer(x, np.int32).sum() for x in g["n"]) for b, g in got.groupby("block")}
    assert total.pop(-1) == 40 * 17
    in_classes = counts.n.to_numpy()[vocab.order[s.top:]].sum()
    assert sum(total.values()) == 2 * in_classes  # every word is followed by something: the end at least


def test_model_beats_unigrams_on_held_out_text(spark, sf_dir):
    got = lm_score.score_documents(documents(spark, sf_dir)).where("held_out").toPandas()
    assert got.score.sum() > 0.95 * got.base_score.sum()
    assert (got.score > got.base_score).mean() > 0.9


def test_lm_empty_tables(spark, docs):
    assert lm_score.score_documents(docs([])).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)  # nothing to learn from
    r = lm_score.score_documents(docs([(held, "a b")])).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0)


def test_vote_against_brute_force():
    rng = np.random.default_rng(1)
    known = quality_knn._unit(rng.normal(size=(50, 8)).astype(np.float32))
    known[10] = known[11]
    labels = (rng.random(50) < 0.6).astype(float)
    v = quality_knn._unit(rng.normal(size=(20, 8)).astype(np.float32))
    got = quality_knn.vote(v, known, labels, 5)
    for k in range(20):
        cos = known @ v[k]
        near = cos >= np.sort(cos)[-5]
        w = np.where(near & (cos > 0), cos, 0).astype(float) ** quality_knn.SHARPNESS
        assert got[k] == pytest.approx((w * labels).sum() / w.sum(), rel=1e-4)
    assert quality_knn.vote(np.zeros((1, 8), np.float32), known, labels)[0] == pytest.approx(labels.mean())
    assert quality_knn.vote(v, known[:0], labels[:0]).tolist() == [0.5] * 20


def test_quality_held_out_accuracy(spark, sf_dir):
    got = quality_knn.op9_quality_knn(spark, sf_dir).join(documents(spark, sf_dir, "labels"), "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.predicted == held.quality).mean() > 0.95
    assert ((got.score >= 0) & (got.score <= 1)).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()


def test_quality_awkward_rows(spark, docs):
    rows = corpus(31)
    d = docs(rows)
    labels = spark.createDataFrame([(i, k % 2, 0, "x") for k, (i, _) in enumerate(rows)] + [(None, 1, 0, "x"), (2000, None, 0, "x"), (2001, 1, 0, "x")],
                                   "doc_id long, quality int, toxic int, text string")
    model = quality_knn.fit(d, labels)
    got = quality_knn.score(d, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    kept = quality_knn.keep_accepted(d, model)
    assert kept.columns == d.columns
    assert kept.count() == sum(r.predicted for r in got)
    empty = quality_knn.fit(docs([]), labels.limit(0))
    assert quality_knn.score(docs([]), empty).count() == 0
    assert [r.score for r in quality_knn.score(docs([(1, "a b c")]), empty).collect()] == [0.5]


def test_quality_very_long_labelled_text(spark, docs):
    rows = [(k, f"some {k} short words of text {k * k}") for k in range(20)] + [(k, "ba la " * (35_000 + k)) for k in range(20, 26)]
    labels = spark.createDataFrame([(k, k % 2) for k, _ in rows], "doc_id long, quality int")
    idf, p, known, lab = quality_knn.fit(docs(rows), labels)
    assert np.isfinite(known).all() and len(known) == len(lab) > 10
    # a labelled text and the same text scored have one vector
    data = [t.encode() for _, t in rows]
    x = quality_knn.features(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0] + [len(t) for t in data]))
    scored = quality_knn._unit(quality_knn.weighted(x, idf) @ p)
    assert np.abs(known[:, None] - scored[None]).max(axis=2).min(axis=1).max() < 1e-5


def test_frequent_from_cuts_at_a_count(spark):
    rng = np.random.default_rng(4)
    n = np.concatenate([rng.integers(1, 50, 3000), rng.integers(1000, 3_000_000, 500)])
    counts = spark.createDataFrame([(int(i), int(x)) for i, x in enumerate(n)], "h long, n long")
    for most in (0, 1, 7, 100, 400, 600, 5000):
        cut = lm_score.frequent_from(counts, most)
        assert (n >= cut).sum() <= most
        assert cut == 1 or (n >= cut - 1).sum() > most


def test_quality_sample_is_the_same_on_any_partitioning_with_repeated_ids(spark):
    from threadline.llm import quality_knn

    rows = [(k % 7, f"word{k} text number {k * k} of {k % 5}") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(7)], "doc_id long, quality int")
    models = [quality_knn.fit(docs.repartition(n), labels, max_labelled=10) for n in (1, 6)]
    assert (models[0][3] == models[1][3]).all() and abs(models[0][2] @ models[0][2].T - models[1][2] @ models[1][2].T).max() < 1e-4
