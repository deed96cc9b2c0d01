"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

A text becomes a vector of hashed byte trigrams and word shapes (last byte,
repetition of the word before), weighted by square-root frequency and by an
inverse document frequency counted over all documents.  A truncated SVD of a
bounded sample of labelled rows gives the latent space.  The labelled vectors are
broadcast, and every document is compared with every one of them by exact
blocked cosine products.  The ``K`` nearest rows (ties included) vote with
weight ``cosine ** SHARPNESS``; the score is the weighted share of label 1.

Bounds: ``MAX_LABELLED`` training rows (chosen by a hash of the id, so the choice
does not depend on order or partitions) of ``RANK`` floats are broadcast; the
documents stay where they were read, nothing is shuffled but counts.

Defined cases: null text is empty text; a text without features gets the
share of label 1 among the training rows; ids and labels may be null (such label
rows are not used); a repeated label row counts once per distinct (id, label);
without any training row every score is 0.5; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from threadline.llm.common import (BYTE_CODE, documents, held_fold, mix, slices, small_batches, text_bytes,
                                   word_hashes, word_spans)

GRAMS = 2048
SHAPES = 512
FEATURES = GRAMS + SHAPES
RANK = 64
MAX_LABELLED = 4096
K = 24
SHARPNESS = 8
THRESHOLD = 0.7
FOLD, HELD = 4, 2


def features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A dense count matrix, texts by features."""
    n = len(offs) - 1
    counts = np.zeros(n * FEATURES, np.float32)
    if len(data) >= 3:
        d = data.astype(np.uint64)
        gram = (mix((d[:-2] << np.uint64(16)) | (d[1:-1] << np.uint64(8)) | d[2:]) % np.uint64(GRAMS)).astype(np.int64)
        text = np.repeat(np.arange(n), np.diff(offs))
        whole = text[:-2] == text[2:]
        counts += np.bincount(text[:-2][whole] * FEATURES + gram[whole], minlength=len(counts)).astype(np.float32)
    s, e, text = word_spans(data, offs)
    if len(s):
        h = word_hashes(data, s, e)
        again = np.zeros(len(s), np.int64)
        again[1:] = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
        shape = GRAMS + again * 256 + data[e - 1]
        counts += np.bincount(text * FEATURES + shape, minlength=len(counts)).astype(np.float32)
    return counts.reshape(n, FEATURES)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Square-root frequencies times idf, scaled to length 1 (empty texts stay 0)."""
    x = np.sqrt(counts) * idf
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return (x / np.where(norm > 0, norm, 1)).astype(np.float32)


def _per_text(batches, use):
    for b in batches:
        data, offs = text_bytes(b.column("text"))
        for i, j in slices(offs):
            yield use(b.slice(i, j - i), features(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]))


def inverse_document_frequency(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Smoothed idf of every feature over all documents."""
    def count(batches):
        df, n = np.zeros(FEATURES, np.int64), 0
        for k, d in _per_text(batches, lambda b, x: (len(x), (x > 0).sum(axis=0))):
            n, df = n + k, df + d
        where = np.append(np.flatnonzero(df), FEATURES)
        yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(np.append(df, n)[where])], names=["f", "n"])

    got = (docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "f long, n long")
           .groupBy("f").agg(F.sum("n").alias("n")).collect())  # at most FEATURES + 1 rows
    df = np.zeros(FEATURES + 1)
    for r in got:
        df[r.f] = r.n
    return (np.log((1 + df[-1]) / (1 + df[:-1])) + 1).astype(np.float32)


def latent_space(x: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Right singular vectors by randomised subspace iteration."""
    rank = min(rank, *x.shape)
    q = np.random.default_rng(7).standard_normal((x.shape[1], min(rank + 16, x.shape[1]))).astype(np.float32)
    for _ in range(6):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    return (q @ vt.T)[:, :rank].astype(np.float32)


def vote(v: np.ndarray, known: np.ndarray, labels: np.ndarray, k: int = K) -> np.ndarray:
    """Similarity-weighted share of label 1 among the k nearest known vectors, ties included."""
    prior = float(labels.mean()) if len(labels) else 0.5
    if not len(labels) or not len(v):
        return np.full(len(v), prior)
    cos = v @ known.T
    k = min(k, len(labels))
    edge = np.partition(cos, len(labels) - k, axis=1)[:, len(labels) - k]
    w = np.where((cos >= edge[:, None]) & (cos > 0), cos, 0).astype(np.float64) ** SHARPNESS
    total = w.sum(axis=1)
    return np.where(total > 0, np.clip((w @ labels) / np.where(total > 0, total, 1), 0, 1), prior)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_labelled: int = MAX_LABELLED):
    """(idf, projection, labelled vectors, labels) from the training fold of the labelled rows."""
    small_batches(docs.sparkSession)
    idf = inverse_document_frequency(docs, text_col)
    y = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
         .where("id is not null and y is not null").where(held_fold(F.col("id"), FOLD) != HELD)
         .distinct().orderBy(F.xxhash64("id"), "id", "y").limit(max_labelled))

    def rows(batches):
        for b, x in _per_text(batches, lambda b, x: (b, weighted(x, idf))):
            yield pa.RecordBatch.from_arrays(
                [b.column("y"), b.column("id"), b.column("h"), pa.array([r.tobytes() for r in x], pa.binary())], names=["y", "id", "h", "x"])

    # a bounded table (max_labelled rows of 16 bytes), so it can go to every executor
    sample = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
              .join(F.broadcast(y), "id").select("id", "y", F.xxhash64("text").alias("h"), "text")
              .mapInArrow(rows, "y int, id long, h long, x binary").orderBy("id", "h", "y").limit(max_labelled).toArrow())
    lab = np.array(sample.column("y").to_pylist(), np.float64)
    raw = sample.column("x").to_pylist()
    x = np.stack([np.frombuffer(r, np.float32) for r in raw]) if len(lab) else np.zeros((0, FEATURES), np.float32)
    p = latent_space(x) if len(lab) else np.zeros((FEATURES, 1), np.float32)
    return idf, p, _unit(x @ p), lab


def _unit(v: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return (v / np.where(norm > 1e-12, norm, 1)).astype(np.float32)


def score(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score and predicted for every row of docs."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches):
        idf, p, known, lab = shared.value
        def use(b, x):
            s = vote(_unit(weighted(x, idf) @ p), known, lab)
            return pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s)], names=["doc_id", "score"])
        yield from _per_text(batches, use)

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(rows, "doc_id long, score double")
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def keep_accepted(docs: DataFrame, model, text_col: str = "text") -> DataFrame:
    """The rows whose text scores at least THRESHOLD, all columns as they were (row-local)."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches):
        idf, p, known, lab = shared.value
        for b in batches:
            data, offs = text_bytes(b.column(text_col))
            for i, j in slices(offs):
                x = features(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                keep = vote(_unit(weighted(x, idf) @ p), known, lab) >= THRESHOLD
                yield b.slice(i, j - i).filter(pa.array(keep))

    return docs.mapInArrow(rows, docs.schema)


def op9_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(docs, documents(spark, sf_dir, "labels"))
    return (score(docs, model).withColumn("held_out", held_fold(F.col("doc_id"), FOLD) == HELD)
            .select("doc_id", "held_out", "score", "predicted"))
