"""The pipeline against a brute-force version, stage by stage, and on awkward tables."""

import importlib.util
import re
import sys

import pytest

import corpus_pipeline
from threadline.llm import quality_knn
from threadline.llm.common import documents

from .conftest import corpus, frame
from .test_dedup import brute_components, norm
from .test_text_operators import words

SMOKE = "/root/testdata/sf0.001"


def ids(df):
    return sorted((r.doc_id is None, r.doc_id or 0) for r in df.select("doc_id").collect())


def key(i):
    return (i is None, i or 0)


def expected_exact(rows):
    first = {}
    for i, t in rows:
        first[norm(t)] = min(first.get(norm(t), key(i)), key(i))
    return sorted(first.values())


def expected_near(rows):
    comp = brute_components(rows, 5, 80, 100)
    return sorted([key(c) for c in {c for _, n, c in comp if n}] + [key(i) for i, n, _ in comp if not n])


def expected_clean(rows, items):
    wins = {tuple(w[s:s + 10]) for w in map(words, items) if w for s in range(max(1, len(w) - 9))}
    sizes = {len(w) for w in wins}
    return sorted(key(i) for i, t in rows
                  if not any(tuple(w[p:p + n]) in wins for w in [words(t)] for n in sizes for p in range(len(w) - n + 1)))


def test_stages_against_brute_force(spark):
    docs = documents(spark, SMOKE)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "exact dedup", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing"]
    columns = docs.columns
    items = [r.text for r in documents(spark, SMOKE, "benchmark").collect()]
    for name, stage in corpus_pipeline.STAGES:
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        out = stage(spark, docs, SMOKE).cache()
        if name == "best-fit packing":
            need = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows}
            got = {}
            for r in out.collect():
                got[r.doc_id] = got.get(r.doc_id, 0) + r.length
            assert got == {i: n + 1 if n else 0 for i, n in need.items()}
            break
        assert out.columns == columns and out.schema == docs.schema
        if name == "quality classifier":
            model = quality_knn.fit(docs, documents(spark, SMOKE, "labels"))
            want = sorted(key(r.doc_id) for r in quality_knn.score(docs, model).where("predicted = 1").collect())
            lost = {i for _, i in map(key, (i for i, _ in rows))} - {i for _, i in want}
            bad = {r.doc_id for r in documents(spark, SMOKE, "labels").where("quality = 0").collect()}
            assert lost and sum(i in bad for i in lost if i in {r.doc_id for r in documents(spark, SMOKE, "labels").collect()}) > 0
        elif name == "exact dedup":
            want = expected_exact(rows)
        elif name == "n-gram Jaccard join":
            want = expected_near(rows)
        else:
            want = expected_clean(rows, items)
        assert ids(out) == want, name
        assert all(dict(rows).get(r.doc_id) == r.text for r in out.collect())
        docs = out


def test_run_equals_its_stages(spark):
    docs = documents(spark, SMOKE)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMOKE).cache()
    columns = ["doc_id", "piece", "start", "length"]
    assert sorted(docs.select(columns).collect()) == sorted(corpus_pipeline.run(spark, SMOKE).select(columns).collect())


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[1:])
def test_awkward_rows_and_empty_tables(spark, name, stage):
    rows = corpus(41)
    out = stage(spark, frame(spark, rows), SMOKE)
    assert out.count() > 0
    if name != "best-fit packing":
        assert out.columns == frame(spark, rows).columns
    assert stage(spark, frame(spark, []), SMOKE).count() == 0


def test_quality_stage_on_awkward_rows(spark):
    rows = corpus(42)
    assert corpus_pipeline.quality(spark, frame(spark, rows), SMOKE).columns == frame(spark, rows).columns
    assert corpus_pipeline.quality(spark, frame(spark, []), SMOKE).count() == 0


def test_rest_of_the_library_does_not_import_the_operators():
    import subprocess

    code = ("import sys, threadline, threadline.catalog, threadline.plans.hybrid, threadline.streaming.ingest; "
            "assert not [m for m in sys.modules if m.startswith('threadline.llm')]")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=importlib.util.find_spec("corpus_pipeline").origin.rsplit("/", 1)[0])
