"""Language-model scoring: a class-factored log-bilinear model trained by noise-contrastive estimation.

Vocabulary.  Words of the training fold are counted in Spark (by 64-bit hash).  Every word seen ``LEAST`` times or
more is an output and a context of its own, most frequent first, up to ``VOCAB`` words (the bound of the broadcast
model).  With V such words and M = ceil(sqrt(V)), the M most frequent ones are outputs of the first level, the others
are members of classes of M words (neighbours in the order of their endings); words outside the vocabulary
belong to one of ``TAIL`` tail classes (by their last letters and punctuation).  So the first level has about
2 M + TAIL outputs and both levels grow with the root of the vocabulary.

Model.  P(w) = P(class of w | two words of context) * P(w | class, word before).  A first-level output scores
``q . (c1 * r_a1 + c2 * f_a2) + b``: ``r`` is a vector of the word before (its own for each word of the vocabulary),
``f`` one of ``GROUPS`` cluster vectors of the word two back.  A member scores ``u . s_a1 + d`` inside its class, where ``s`` is the
vector of the first-level output of the word before.  Matrix products give the exact normaliser of every context.  A word outside the
vocabulary has the probability of its tail class times its share of it (add-one counts, one unit
for unseen words), so probabilities over all words and one unseen word per tail class add up to one.

Training, each step by noise-contrastive estimation in numpy against unigram noise; the tables hold every pair, so the
expectation over the noise is taken exactly by matrix products.  (1) First-level vectors from the pairs at
distance one and two of all training text, counted in Spark.  (2) Vectors of members, as outputs and as contexts: a Spark
group per class holds its pair counts with first-level outputs (bounded by M times their number, more text makes
them denser) and trains against the fixed first level, with a prior that draws rare words to their class.  (3) The
weights c1, c2 and the biases of both distances together, from the counts of (cluster of the word before, cluster
of the word two back, output) over all training text.

Scores of rare words need their corpus count: the ``TABLE`` most frequent words are broadcast,
the rest of the words of each document are joined with the counts by a shuffle.

Defined cases: null text is empty and scores its end token; identical rows get a row each; a null
id counts as empty text for the fold; without training text every word has the base probability
of an unseen word; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from threadline.llm.common import (LOWER, as_int64, checkpointed, documents, held_fold, mix, slices, small_batches, text_bytes,
                                   stored, to_lists, word_hashes, word_spans)

FOLD, HELD = 7, 2
LEAST, VOCAB = 2, 1 << 18
TAIL = 128
RANK = 32
GROUPS = 16
NEAR_GROUPS = 32
NOISE = 10
STEPS = 200
MEMBER_STEPS = 30
PRIOR = 1.0
TABLE = 500_000
FLUSH = 4_000_000
END_HASH = np.uint64(0x1D8E4E27C47D124F)


class Layout:
    """First-level outputs: ``top`` words, ``classes`` of ``per`` words each, TAIL tail classes, the end; then START as a context."""

    def __init__(self, words: int):
        self.words = words
        self.per = max(1, int(np.ceil(np.sqrt(words))))
        self.top = min(words, self.per)
        self.classes = -(-(words - self.top) // self.per)
        self.tail = self.top + self.classes
        self.end = self.tail + TAIL
        self.start = self.out = self.end + 1
        self.ctx = self.out + 1


def word_class(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Class of a word: its last two bytes before closing punctuation, and the punctuation."""
    punct = np.zeros(256, bool)
    punct[33:48] = punct[58:65] = punct[91:97] = punct[123:127] = True
    last = end - 1
    kind = np.where(punct[data[last]], data[last], 0).astype(np.uint64)
    for _ in range(4):
        last = last - (punct[data[last]] & (last > start))
    before = np.maximum(last - 1, start)
    code = data[last].astype(np.uint64) | (data[before].astype(np.uint64) << np.uint64(8)) | (kind << np.uint64(16))
    return (mix(code + np.uint64(1)) % np.uint64(TAIL)).astype(np.int64)


class _Tokens:
    """Words of a slice, with an end token after each text."""

    def __init__(self, data, offs):
        data = LOWER[data]
        n = len(offs) - 1
        s, e, doc = word_spans(data, offs)
        self.n_words = len(s)
        count = np.bincount(doc, minlength=n)
        self.count = count + 1
        self.doc = np.repeat(np.arange(n), self.count)
        self.last = np.cumsum(self.count) - 1
        place = np.arange(len(s)) + doc
        self.hash = np.full(len(s) + n, END_HASH, np.uint64)
        self.hash[place] = word_hashes(data, s, e) if len(s) else 0
        self.cls = np.full(len(s) + n, TAIL, np.int64)
        self.cls[place] = word_class(data, s, e) if len(s) else 0

    def shifted(self, ids: np.ndarray, back: int, start: int) -> np.ndarray:
        """The token ``back`` places before, ``start`` before the text."""
        out = np.full(len(ids), start, np.int64)
        out[back:] = ids[:-back]
        first = np.cumsum(self.count) - self.count
        for k in range(back):
            at = first + k
            out[at[k < self.count]] = start
        return out


def word_counts(rows: DataFrame) -> DataFrame:
    """(h, n, cls) of every distinct token of the training rows."""
    def count(batches):
        held, size = [], 0

        def flush():
            h = np.concatenate([x for x, _ in held])
            u, first, n = np.unique(h, return_index=True, return_counts=True)
            c = np.concatenate([y for _, y in held])[first]
            return pa.RecordBatch.from_arrays([pa.array(as_int64(u)), pa.array(n), pa.array(c)], names=["h", "n", "cls"])

        for b in batches:
            data, offs = text_bytes(b.column("text"))
            for i, j in slices(offs):
                t = _Tokens(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                held.append((t.hash, t.cls))
                size += len(t.hash)
                if size > FLUSH:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return (rows.where("train").select("text").mapInArrow(count, "h long, n long, cls long")
            .groupBy("h").agg(F.sum("n").alias("n"), F.first("cls").alias("cls")))


def frequent_from(counts: DataFrame, most: int) -> int:
    """The least count that at most ``most`` words reach, from a histogram of bounded size (no sort)."""
    low, width = 1, 1
    while True:
        bins = 1000
        place = F.least(F.floor((F.col("n") - low) / width), F.lit(bins))
        got = dict(counts.where(F.col("n") >= low).groupBy(place.cast("long").alias("b")).count().collect())
        above = 0
        for b in range(bins, -1, -1):
            if above + got.get(b, 0) > most:
                break
            above += got.get(b, 0)
        else:
            return low
        if b == bins:  # too many beyond the last bin: look further up, in wider bins
            low, width = low + bins * width, width * 100
        elif width == 1:
            return low + b + 1
        else:  # the cut lies inside bin b
            low, width = low + b * width, max(1, width // 100)


class Vocabulary:
    """Words of their own, by sorted hash: place in the vocabulary and output of the first level.

    Places follow the outputs: the top words first, then class by class, so that
    place ``top + k * per + j`` is member ``j`` of class ``k``.
    """

    def __init__(self, hashes: np.ndarray, cls: np.ndarray):
        """``hashes`` and tail classes of the words, most frequent first."""
        self.shape = shape = Layout(len(hashes))
        rest = np.lexsort((np.arange(shape.top, len(hashes)), cls[shape.top:])) + shape.top
        order = np.concatenate([np.arange(shape.top), rest]).astype(np.int64)
        self.order = order
        placed = hashes[order]
        by_hash = np.argsort(placed)
        self.hash, self.place = placed[by_hash], by_hash

    def first_level(self, place: np.ndarray) -> np.ndarray:
        s = self.shape
        return np.where(place < s.top, place, s.top + (place - s.top) // s.per)

    def of(self, t: _Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Place (-1 outside the vocabulary) and first-level output of each token."""
        place = np.full(len(t.hash), -1, np.int64)
        if len(self.hash):
            at = np.minimum(np.searchsorted(self.hash, t.hash), len(self.hash) - 1)
            place = np.where(self.hash[at] == t.hash, self.place[at], -1)
        return place, np.where(place >= 0, self.first_level(place), self.shape.tail + t.cls)


def tokens_of(batches):
    """Tokens of the texts of all batches, a slice at a time."""
    for b in batches:
        data, offs = text_bytes(b.column("text"))
        for i, j in slices(offs):
            yield _Tokens(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])


def pair_tables(rows: DataFrame, vocab: Vocabulary) -> np.ndarray:
    """Counts of (context, output) of the first level at distance one and two over all training text."""
    shared = rows.sparkSession.sparkContext.broadcast(vocab)
    block = 64
    s = vocab.shape

    def count(batches):
        table = np.zeros((2, s.ctx, s.out), np.int32)
        flat = table.reshape(2, -1)
        for t in tokens_of(batches):
            w = shared.value.of(t)[1]
            for lag in (1, 2):
                at, n = np.unique(t.shifted(w, lag, s.start) * s.out + w, return_counts=True)
                flat[lag - 1, at] += n.astype(np.int32)
        for lag in (0, 1):
            for a in range(0, s.ctx, block):
                part = table[lag, a:a + block].ravel()
                at = np.flatnonzero(part)
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lag * 1000 + a // block]), pa.array([at.astype(np.uint32).tobytes()], pa.binary()),
                         pa.array([part[at].tobytes()], pa.binary())], names=["block", "at", "n"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(block * s.out, np.int64)
        for at, n in zip(pdf["at"], pdf["n"]):
            total[np.frombuffer(at, np.uint32)] += np.frombuffer(n, np.int32)
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "n": [total.astype(np.float32).tobytes()]})

    got = (rows.where("train").select("text").mapInArrow(count, "block long, at binary, n binary")
           .groupBy("block").applyInPandas(add, "block long, n binary").collect())  # at most 2 * ctx * out numbers
    table = np.zeros((2, -(-s.ctx // block) * block, s.out), np.float32)
    for r in got:
        a = r.block % 1000 * block
        table[r.block // 1000, a:a + block] = np.frombuffer(r.n, np.float32).reshape(block, s.out)
    return table[:, :s.ctx]


def member_pairs(rows: DataFrame, vocab: Vocabulary, near_group: np.ndarray, far_group: np.ndarray) -> DataFrame:
    """(block, at, n): pair counts of each class's members, and (block -1) counts of (near cluster, far cluster, output).

    ``at`` of a class: member * ctx + context before it, or per * ctx + member * out + output behind it.
    """
    shared = rows.sparkSession.sparkContext.broadcast((vocab, near_group, far_group))
    s = vocab.shape
    span = s.per * (s.ctx + s.out)

    def count(batches):
        words, near, far = shared.value
        triples = np.zeros((int(near.max()) + 1) * (int(far.max()) + 1) * s.out, np.int32)
        held, size = [], 0

        def merged():
            key = np.concatenate([k for k, _ in held])
            n = np.concatenate([m for _, m in held])
            order = np.argsort(key, kind="stable")
            key, n = key[order], n[order]
            head = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
            return key[head], (np.add.reduceat(n, head) if len(head) else n).astype(np.int32)

        def emit(key, n):
            block = key // span
            head = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(key) else np.zeros(0, np.int64)
            tail = np.append(head[1:], len(key))
            return pa.RecordBatch.from_arrays(
                [pa.array(block[head], pa.int64()), pa.array([(key[i:j] % span).astype(np.uint32).tobytes() for i, j in zip(head, tail)], pa.binary()),
                 pa.array([n[i:j].tobytes() for i, j in zip(head, tail)], pa.binary())], names=["block", "at", "n"])

        for t in tokens_of(batches):
            place, w = words.of(t)
            a1, a2 = t.shifted(w, 1, s.start), t.shifted(w, 2, s.start)
            triples += np.bincount((near[a1] * (int(far.max()) + 1) + far[a2]) * s.out + w, minlength=len(triples)).astype(np.int32)
            own = place >= s.top
            m = place[own] - s.top
            before = t.shifted(place, 1, -1)
            after = before >= s.top
            b = before[after] - s.top
            key, n = np.unique(np.concatenate([m // s.per * span + m % s.per * s.ctx + a1[own],
                                               b // s.per * span + s.per * s.ctx + b % s.per * s.out + w[after]]), return_counts=True)
            held.append((key, n))
            size += len(key)
            if size > FLUSH:
                held = [merged()]
                size = len(held[0][0])
                if size > FLUSH // 2:
                    yield emit(*held[0])
                    held, size = [], 0
        if size:
            yield emit(*merged())
        at = np.flatnonzero(triples)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), pa.array([at.astype(np.uint32).tobytes()], pa.binary()),
                                              pa.array([triples[at].tobytes()], pa.binary())], names=["block", "at", "n"])

    return rows.where("train").select("text").mapInArrow(count, "block long, at binary, n binary")


def added(pdf: pd.DataFrame, size: int) -> np.ndarray:
    """The counts of a block as a dense table."""
    total = np.zeros(size, np.float32)
    for at, n in zip(pdf["at"], pdf["n"]):
        total[np.frombuffer(at, np.uint32)] += np.frombuffer(n, np.int32)
    return total


class Adam:
    """Steps of gradient descent with running moments."""

    def __init__(self, p: dict):
        self.p = p
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}
        self.t = 0

    def step(self, g: dict, rate: float) -> None:
        self.t += 1
        for k, p in self.p.items():
            self.m[k] = 0.9 * self.m[k] + 0.1 * g[k]
            self.v[k] = 0.99 * self.v[k] + 0.01 * g[k] ** 2
            p -= (rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.99**self.t)) + 1e-10)).astype(np.float32)


def nce_slope(score: np.ndarray, data: np.ndarray, drawn: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Slope of the loss by each score (overwritten).

    ``drawn``: data and expected noise counts of each cell, ``shift``: log of noise * unigram.
    """
    x = np.subtract(shift, score, out=score)
    np.minimum(x, 30, out=x)
    np.exp(x, out=x)
    x += 1
    np.divide(drawn, x, out=x)
    x -= data
    return x


def fit_members(table: np.ndarray, ctx: np.ndarray, noise: int = NOISE, steps: int | None = None):
    """(vectors, biases) of a class's members from the counts (context, member), against fixed context vectors."""
    some = table.sum(axis=1) > 0
    table, ctx = table[some], ctx[some]
    unigram = table.sum(axis=0) + 0.5
    pn = (unigram / unigram.sum()).astype(np.float32)
    model = Adam({"u": np.zeros((table.shape[1], ctx.shape[1]), np.float32), "d": np.log(pn)})
    drawn, shift = table + table.sum(axis=1, keepdims=True) * noise * pn, np.log(noise * pn)
    steps = MEMBER_STEPS if steps is None else steps
    for t in range(steps if len(table) else 0):
        p = model.p
        slope = nce_slope(ctx @ p["u"].T + p["d"], table, drawn, shift)
        model.step({"u": slope.T @ ctx + PRIOR * p["u"], "d": slope.sum(axis=0)}, 0.1 * (1 - t / steps) + 0.002)
    return model.p["u"], model.p["d"]


def fit_contexts(table: np.ndarray, prior: np.ndarray, q: np.ndarray, b: np.ndarray, pn: np.ndarray, noise: int = NOISE, steps: int | None = None):
    """Vectors of a class's members as contexts from the counts (member, output), drawn to the class's own vector."""
    model = Adam({"r": np.repeat(prior[None], len(table), axis=0).astype(np.float32)})
    drawn, shift = table + table.sum(axis=1, keepdims=True) * noise * pn, np.log(noise * pn)
    steps = MEMBER_STEPS if steps is None else steps
    for t in range(steps):
        r = model.p["r"]
        slope = nce_slope(r @ q.T + b, table, drawn, shift)
        model.step({"r": slope @ q + PRIOR * (r - prior)}, 0.05 * (1 - t / steps) + 0.002)
    return model.p["r"]


def log_sum(s: np.ndarray) -> np.ndarray:
    top = s.max(axis=1)
    return top + np.log(np.exp(s - top[:, None]).sum(axis=1))


def train_nce(table: np.ndarray, rank: int = RANK, noise: int = NOISE, steps: int | None = None):
    """(context vectors per distance, output vectors, output biases) of the first level by noise-contrastive estimation."""
    rng = np.random.default_rng(11)
    n_ctx, n_out = table.shape[1:]
    unigram = table[0].sum(axis=0) + 0.5
    pn = (unigram / unigram.sum()).astype(np.float32)
    p = {"r": rng.normal(0, 0.1, (n_ctx, rank)), "q": rng.normal(0, 0.1, (n_out, rank)), "b": np.log(pn),
         "c": np.ones((2, rank))}
    model = Adam({k: v.astype(np.float32) for k, v in p.items()})
    p = model.p
    # every context weighs as the root of its frequency, so that rare contexts are learnt as well
    rows = table.sum(axis=2)
    weight = 1 / np.sqrt(np.maximum(rows, 1))
    data = (table * weight[:, :, None] / np.maximum((rows * weight).sum(), 1)).astype(np.float32)
    drawn = data + data.sum(axis=2, keepdims=True) * noise * pn
    shift = np.log(noise * pn)
    steps = STEPS if steps is None else steps
    for t in range(1, steps + 1):
        g = {k: np.zeros_like(v) for k, v in p.items()}
        for lag in (0, 1):
            ctx = p["r"] * p["c"][lag]
            d = nce_slope(ctx @ p["q"].T + p["b"], data[lag], drawn[lag], shift)
            dctx = d @ p["q"]
            g["q"] += d.T @ ctx
            g["b"] += d.sum(axis=0)
            g["r"] += dctx * p["c"][lag]
            g["c"][lag] = (dctx * p["r"]).sum(axis=0)
        model.step(g, 0.05 * (1 - t / (steps + 1)) + 0.002)
    return p["r"] * p["c"][0], p["r"] * p["c"][1], p["q"], p["b"]


def train_joint(table: np.ndarray, near: np.ndarray, far: np.ndarray, q: np.ndarray, b: np.ndarray, noise: int = NOISE, steps: int | None = None):
    """(c1, c2, biases): weights of the dimensions of both distances, learnt together from counts (near cluster, far cluster, output)."""
    table = table.reshape(-1, len(q))
    unigram = table.sum(axis=0) + 0.5
    pn = (unigram / unigram.sum()).astype(np.float32)
    data = table / max(table.sum(), 1)
    drawn, shift = data + data.sum(axis=1, keepdims=True) * noise * pn, np.log(noise * pn)
    x1, x2 = np.repeat(near, len(far), axis=0), np.tile(far, (len(near), 1))
    rank = q.shape[1]
    model = Adam({"c1": np.full(rank, 0.9, np.float32), "c2": np.full(rank, 0.6, np.float32), "b": b.astype(np.float32).copy()})
    p = model.p
    steps = STEPS if steps is None else steps
    for t in range(steps):
        slope = nce_slope((x1 * p["c1"] + x2 * p["c2"]) @ q.T + p["b"], data, drawn, shift)
        back = slope @ q
        model.step({"c1": (back * x1).sum(axis=0), "c2": (back * x2).sum(axis=0), "b": slope.sum(axis=0)}, 0.02 * (1 - t / steps) + 0.001)
    return p["c1"], p["c2"], p["b"]


def clusters(x: np.ndarray, weight: np.ndarray, k: int, rounds: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Weighted k-means; the group of each row and the mean of each group."""
    rng = np.random.default_rng(5)
    centre = x[rng.choice(len(x), min(k, len(x)), replace=False, p=weight / weight.sum())]
    for _ in range(rounds):
        group = ((x**2).sum(1)[:, None] - 2 * x @ centre.T + (centre**2).sum(1)).argmin(axis=1)
        for g in range(len(centre)):
            if (group == g).any():
                centre[g] = np.average(x[group == g], axis=0, weights=weight[group == g])
    group = np.unique(group, return_inverse=True)[1]
    mean = np.stack([np.average(x[group == g], axis=0, weights=weight[group == g]) for g in range(group.max() + 1)])
    return group, mean.astype(np.float32)


class FirstLevel:
    """Vectors of the first level, clusters of both context words, and the learnt weights of the two distances."""

    def __init__(self, table: np.ndarray):
        self.near, far, self.q, self.b = train_nce(table)
        self.near_group, self.near_mean = clusters(self.near, table[0].sum(axis=1) + 0.01, NEAR_GROUPS)
        self.far_group, self.far = clusters(far, table[1].sum(axis=1) + 0.01, GROUPS)
        unigram = table[0].sum(axis=0) + 0.5
        self.pn = (unigram / unigram.sum()).astype(np.float32)
        self.near_in = self.near.astype(np.float32)  # vectors of the word before inside classes

    def weigh(self, triples: np.ndarray) -> None:
        c1, c2, self.b_joint = train_joint(triples, self.near_mean, self.far, self.q, self.b)
        self.c1 = c1
        self.lift = (self.far * c2) @ self.q.T + self.b_joint  # score that each far cluster adds to each output

    def log_z(self, near: np.ndarray) -> np.ndarray:
        """Normaliser of the first level for every (context vector, far cluster)."""
        s = (near.astype(np.float32) * self.c1) @ self.q.T
        return np.stack([log_sum(s + lift) for lift in self.lift], axis=1).astype(np.float32)


def fit_classes(pairs: DataFrame, shape: Layout, first: FirstLevel) -> DataFrame:
    """(block, r, z1, u, d, z2) of every class: vectors of its members as contexts and outputs with their normalisers."""
    shared = pairs.sparkSession.sparkContext.broadcast(first)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        f, k = shared.value, int(pdf["block"].iloc[0])
        n = min(shape.per, shape.words - shape.top - k * shape.per)
        dense = added(pdf, shape.per * (shape.ctx + shape.out))
        before = dense[:shape.per * shape.ctx].reshape(shape.per, shape.ctx)[:n].T
        behind = dense[shape.per * shape.ctx:].reshape(shape.per, shape.out)[:n]
        u, d = fit_members(before, f.near_in)
        r = fit_contexts(behind, f.near[shape.top + k], f.q, f.b, f.pn)
        u, r = u.astype(np.float16), r.astype(np.float16)  # normalisers are those of the rounded vectors
        z2 = log_sum(f.near_in @ u.astype(np.float32).T + d).astype(np.float32)
        return pd.DataFrame({"block": [k], "r": [r.tobytes()], "z1": [f.log_z(r).tobytes()], "u": [u.tobytes()],
                             "d": [d.astype(np.float32).tobytes()], "z2": [z2.tobytes()]})

    # a fixed number of tasks: the training of a class takes long for its few bytes, which would be put into one task
    return (pairs.where("block >= 0").repartition(max(1, shape.classes // 4), "block").groupBy("block")
            .applyInPandas(fit, "block long, r binary, z1 binary, u binary, d binary, z2 binary"))


class Model:
    """All vectors and the log normalisers of every context.

    Contexts of the first level: its ``ctx`` outputs and START, then the members
    of the classes, class by class.
    """

    def __init__(self, shape: Layout, first: FirstLevel, classes):
        """``classes``: rows of :func:`fit_classes`; a class without training pairs keeps its first-level vector."""
        self.shape, self.first = shape, first
        members, rank, far = shape.words - shape.top, first.q.shape[1], len(first.far)
        self.near = np.zeros((shape.ctx + members, rank), np.float16)
        self.near[:shape.ctx] = first.near
        self.z1 = np.zeros((shape.ctx + members, far), np.float32)
        self.z1[:shape.ctx] = first.log_z(self.near[:shape.ctx])
        self.u, self.d = np.zeros((members, rank), np.float16), np.zeros(members, np.float32)
        self.z2 = np.zeros((shape.classes, shape.ctx), np.float32)
        for r in classes:
            lo = r.block * shape.per
            hi = min(lo + shape.per, members)
            self.near[shape.ctx + lo:shape.ctx + hi] = np.frombuffer(r.r, np.float16).reshape(-1, rank)
            self.z1[shape.ctx + lo:shape.ctx + hi] = np.frombuffer(r.z1, np.float32).reshape(-1, far)
            self.u[lo:hi] = np.frombuffer(r.u, np.float16).reshape(-1, rank)
            self.d[lo:hi] = np.frombuffer(r.d, np.float32)
            self.z2[r.block] = np.frombuffer(r.z2, np.float32)

    def log10(self, place: np.ndarray, w: np.ndarray, c1: np.ndarray, a1: np.ndarray, a2: np.ndarray) -> np.ndarray:
        """Normalised log10 probability of each token (of its tail class, for words outside the vocabulary).

        ``place`` and ``w``: place and first-level output of the token; ``c1``: context row of the word
        before, ``a1`` and ``a2``: first-level outputs of the words before.
        """
        f, s = self.first, self.shape
        g = f.far_group[a2]
        p = np.einsum("ij,ij->i", self.near[c1] * f.c1, f.q[w]) + f.lift[g, w] - self.z1[c1, g]
        own = np.flatnonzero(place >= s.top)
        m = place[own] - s.top
        p[own] += np.einsum("ij,ij->i", f.near_in[a1[own]], self.u[m].astype(np.float32)) + self.d[m] - self.z2[m // s.per, a1[own]]
        return p.astype(np.float64) / np.log(10)


def train(rows: DataFrame, vocab: Vocabulary) -> Model:
    """The model of the training rows (train, text)."""
    shape = vocab.shape
    first = FirstLevel(pair_tables(rows, vocab))
    pairs = stored(member_pairs(rows, vocab, first.near_group, first.far_group), "lm_pairs")
    size = len(first.near_mean) * len(first.far) * shape.out
    add = pairs.where("block = -1").groupBy("block").applyInPandas(
        lambda pdf: pd.DataFrame({"n": [added(pdf, size).tobytes()]}), "n binary").first()
    first.weigh(np.frombuffer(add.n, np.float32) if add else np.zeros(size, np.float32))
    classes = stored(fit_classes(pairs, shape, first), "lm_classes")  # trained in parallel, then read class by class
    return Model(shape, first, classes.toLocalIterator())  # VOCAB words at most


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    small_batches(spark)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = F.col(id_col).cast("long")
    rows = docs.select(own.alias("doc_id"), (held_fold(F.col(id_col), FOLD) != HELD).alias("train"),
                       F.xxhash64(own, text, F.octet_length(text)).alias("row"), text.alias("text"))
    counts = checkpointed(word_counts(rows))
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    table = counts.where(F.col("n") >= frequent_from(counts, TABLE)).toArrow()
    hashes = table.column("h").to_numpy().view(np.uint64)
    freq, cls = table.column("n").to_numpy(), table.column("cls").to_numpy()
    order = np.lexsort((hashes, -freq))
    own = order[(hashes[order] != END_HASH) & (freq[order] >= LEAST)][:VOCAB]
    vocab = Vocabulary(hashes[own], cls[own])
    shape = vocab.shape
    # add-one mass of each tail class without the words of the vocabulary, one unit for its unseen words
    mass = np.ones(TAIL)
    for r in counts.groupBy("cls").agg(F.sum(F.col("n") + 1).alias("m")).collect():  # TAIL + 1 rows
        if r.cls < TAIL:
            mass[r.cls] += r.m
    np.subtract.at(mass, cls[own], freq[own] + 1)
    order = np.argsort(hashes)
    hashes, freq = hashes[order], freq[order]
    shared = spark.sparkContext.broadcast((hashes, freq, vocab, np.log10(mass), train(rows, vocab)))

    def scored(batches):
        known, known_n, words, log_mass, lm = shared.value
        log_n = np.log10(known_n + 1)
        for b in batches:
            data, offs = text_bytes(b.column("text"))
            for i, j in slices(offs):
                t = _Tokens(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                n_docs = j - i
                place, w = words.of(t)
                if len(known):
                    at = np.minimum(np.searchsorted(known, t.hash), len(known) - 1)
                    found = known[at] == t.hash
                    log_c = np.where(found, log_n[at], 0.0)
                else:
                    found, log_c = np.zeros(len(w), bool), np.zeros(len(w))
                row = np.where(place >= shape.top, shape.ctx + place - shape.top, w)
                p = lm.log10(place, w, t.shifted(row, 1, shape.start), t.shifted(w, 1, shape.start), t.shifted(w, 2, shape.start))
                in_tail = (w >= shape.tail) & (w < shape.end)
                p = np.where(in_tail, p + log_c - log_mass[np.where(in_tail, w - shape.tail, 0)], p)
                rare_doc, rare = t.doc[~found], t.hash[~found]
                o = np.lexsort((rare, rare_doc))
                rare_doc, rare = rare_doc[o], rare[o]
                new = np.ones(len(rare), bool)
                new[1:] = (rare[1:] != rare[:-1]) | (rare_doc[1:] != rare_doc[:-1])
                head = np.flatnonzero(new)
                per = np.bincount(rare_doc[head], minlength=n_docs)
                part = b.slice(i, n_docs)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("train"), part.column("row"), pa.array(t.count.astype(np.int64)),
                     pa.array(np.bincount(t.doc, found, n_docs).astype(np.int64)), pa.array(np.bincount(t.doc, log_c, n_docs)),
                     pa.array(np.bincount(t.doc, p, n_docs)), to_lists(as_int64(rare[head]), per, pa.int64()),
                     to_lists(np.diff(np.append(head, len(rare))).astype(np.int32), per, pa.int32())],
                    names=["doc_id", "train", "row", "n_tokens", "known", "log_c", "lm", "rare", "times"])

    base = checkpointed(rows.mapInArrow(
        scored, "doc_id long, train boolean, row long, n_tokens long, known long, log_c double, lm double, "
                "rare array<long>, times array<int>"))
    rest = (base.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", "x.rare", "x.times")
            .join(counts.select(F.col("h").alias("rare"), "n"), "rare").groupBy("row")
            .agg(F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more_log")))
    copies = base.groupBy("row").agg(F.count("*").alias("copies"))
    rest = rest.join(copies, "row").select("row", (F.col("more_known") / F.col("copies")).cast("long").alias("more_known"),
                                           (F.col("more_log") / F.col("copies")).alias("more_log"))
    zero = F.lit(0.0)
    return (base.select("doc_id", "train", "row", "n_tokens", "known", "log_c", "lm").join(rest, "row", "left")
            .select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens",
                    (F.col("known") + F.coalesce("more_known", F.lit(0).cast("long"))).alias("n_known"),
                    F.lit(n).cast("long").alias("train_tokens"),
                    (F.col("log_c") + F.coalesce("more_log", zero) - F.col("n_tokens") * F.lit(float(np.log10(n + v + 1)))).alias("base_score"),
                    (F.col("lm") + F.coalesce("more_log", zero)).alias("score")))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir))
