"""Exact dedup, Jaccard join and both substring dedups against brute force."""

import hashlib
import random
import re
import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from threadline.llm import common, exact_dedup, jaccard_join, phrase_automata, suffix_dedup

from .conftest import corpus, frame

BIG = 2**63 - 1
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


@pytest.mark.parametrize("fan_in,per_run", [(2, 4), (8, 4096)])
def test_exact_dedup(spark, docs, fan_in, per_run):
    rows = corpus(1)
    got = exact_dedup.exact_dedup(docs(rows), fan_in=fan_in, rows_per_run=per_run).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    want, seen = [], set()
    for i, t in rows:
        ids = groups[norm(t)]
        known = [x for x in ids if x is not None]
        keep = min(known) if known else None
        first = i == keep and norm(t) not in seen
        if first:
            seen.add(norm(t))
        want.append((i, keep, len(ids), first, hashlib.sha256(norm(t).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    kept = exact_dedup.drop_copies(docs(rows))
    assert kept.columns == docs(rows).columns
    assert sorted((r.doc_id, norm(r.text)) for r in kept.collect()) == sorted((w[1], k) for k, w in
                                                                            ((norm(t), w) for (i, t), w in zip(rows, want)) if w[3])


def test_sorted_slices_are_merged_not_sorted():
    def pack(*entry):
        return struct.pack(exact_dedup.ENTRY, *entry)

    keys = [bytes([k]) * 48 for k in range(5)]
    runs = [[(keys[0], 9, 1, 1), (keys[2], 4, 1, 2), (keys[4], BIG, 0, 1)], [(keys[2], 3, 1, 1), (keys[3], 8, 1, 1)],
            [(keys[0], 2, 1, 5), (keys[4], 7, 1, 1)], []]
    got = list(exact_dedup.merge_slices([b"".join(pack(*e) for e in r) for r in runs]))
    assert got == [[keys[0], 2, 2, 6], [keys[2], 3, 2, 3], [keys[3], 8, 1, 1], [keys[4], 7, 1, 2]]
    # a slice out of order stays so: nothing is sorted behind the merge
    assert [e[0] for e in exact_dedup.merge_slices([pack(keys[3], 1, 1, 1) + pack(keys[1], 2, 1, 1)])] == [keys[3], keys[1]]
    # what a run deals is sorted and goes to runs that differ in one digit
    dealt = exact_dedup._deal(5, got, 4, 4)
    assert sum(len(x.as_py()) for x in dealt.column("slice")) == 4 * struct.calcsize(exact_dedup.ENTRY)
    assert {x.as_py() % 4 for x in dealt.column("run")} == {1}


def test_exact_dedup_without_ids_spreads_over_runs(spark):
    rows = [(None, f"text {i % 300}") for i in range(900)]
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"), fan_in=4, rows_per_run=32).collect()
    assert len(got) == 900 and {(r.keep_id, r.group_size) for r in got} == {(None, 3)} and sum(r.kept for r in got) == 300


def shingles(t, k=4):
    w = [lower(x) for x in WORD.findall(t or "")]
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute_components(rows, k, num, den):
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    out = []
    for a, (i, _) in enumerate(rows):
        ids = [rows[b][0] for b in range(len(rows)) if find(b) == find(a) and rows[b][0] is not None]
        out.append((i, len(sets[a]), min(ids) if ids else None))
    return out


@pytest.mark.parametrize("seed,k,num", [(2, 4, 85), (3, 5, 80), (4, 2, 50)])
def test_jaccard_components(spark, docs, seed, k, num):
    rows = corpus(seed)
    got = jaccard_join.jaccard_components(docs(rows), shingle=k, num=num).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute_components(rows, k, num, 100), key=repr)


def test_jaccard_small_blocks_and_rest(spark, docs, monkeypatch):
    # blocks of a few sets: links between parts of a block must come from the second search
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 300)
    rng = np.random.default_rng(0)
    base = [f"w{x}" for x in rng.integers(0, 10**6, 100)]
    rows = []
    for i in range(80):
        w = list(base)
        for at in rng.integers(0, 100, i % 6):
            w[at] = f"e{i}"
        rows.append((i, " ".join(w)))
    got = jaccard_join.jaccard_components(docs(rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(brute_components(rows, 4, 85, 100))


def test_divide_skip_finds_every_pair():
    rng = np.random.default_rng(3)
    bounds = jaccard_join.Bounds(60, 100)
    sets = []
    for _ in range(40):
        s = set(rng.integers(0, 40, rng.integers(1, 30)).tolist()) if not sets or rng.random() < 0.5 else set(sets[rng.integers(len(sets))])
        s ^= set(rng.integers(0, 40, 2).tolist())
        sets.append(s or {1})
    got = jaccard_join.divide_skip([np.array(sorted(s), np.uint64) for s in sets], bounds, find_all=True)
    want = {(a, b) for a in range(40) for b in range(a + 1, 40) if 100 * len(sets[a] & sets[b]) >= 60 * len(sets[a] | sets[b])}
    assert {tuple(sorted(p)) for p in got} == want


def test_drop_near_copies_keeps_one_of_each(spark, docs):
    rows = corpus(5)
    kept = jaccard_join.drop_near_copies(docs(rows))
    assert kept.columns == docs(rows).columns
    got = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    comp = brute_components(rows, 5, 80, 100)
    want = sorted({(c is None, c or 0) for _, n, c in comp if n}) + [(i is None, i or 0) for i, n, _ in comp if not n]
    assert got == sorted(want)


def brute_words(rows, window=50):
    docs = [((i if i is not None else BIG), WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in docs:
        for a in range(len(w) - window + 1):
            key = tuple(w[a:a + window])
            first[key] = min(first.get(key, BIG), i)
    out = []
    for (raw, _), (i, w) in zip(rows, docs):
        gone = set()
        for a in range(len(w) - window + 1):
            if first[tuple(w[a:a + window])] < i:
                gone.update(range(a, a + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((raw, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("seed", [6, 7])
def test_phrase_automata(spark, docs, seed, monkeypatch):
    monkeypatch.setattr(phrase_automata, "SHARD_OWNERS", 3)
    monkeypatch.setattr(phrase_automata, "TASK_WORDS", 200)
    rows = corpus(seed)
    got = phrase_automata.remove_repeats(docs(rows)).drop("spans").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute_words(rows), key=repr)


def brute_bytes(rows, window=50):
    docs = [((i if i is not None else BIG), (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in docs:
        for a in range(len(b) - window + 1):
            first[b[a:a + window]] = min(first.get(b[a:a + window], BIG), i)
    out = []
    for (raw, _), (i, b) in zip(rows, docs):
        gone = np.zeros(len(b) + 1, bool)
        for a in range(len(b) - window + 1):
            if first[b[a:a + window]] < i:
                gone[a:a + window] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((raw, len(b), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone[:-1]].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize("seed,block", [(8, 250_000), (9, 64)])
def test_suffix_dedup(spark, docs, seed, block, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "TASK_CONTEXTS", 40)
    monkeypatch.setattr(suffix_dedup.smallest_ids, "__defaults__", (50, block))
    rows = corpus(seed)
    got = suffix_dedup.remove_repeats(docs(rows)).drop("spans").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute_bytes(rows), key=repr)


def test_difference_cover_and_suffix_order():
    p, c = suffix_dedup.PERIOD, suffix_dedup.COVER
    assert {(a - b) % p for a in c for b in c} == set(range(p))
    rng = np.random.default_rng(1)
    # a text of long ties: few letters, periodic runs
    text = np.concatenate([rng.integers(97, 99, 300), np.tile([97, 98], 200), np.full(150, 97), rng.integers(97, 99, 300)]).astype(np.uint8)
    body = len(text)
    text = np.concatenate([text, np.zeros(128, np.uint8)])
    starts = np.arange(body - 50 + 1)
    sampled = np.arange(len(text)) < body
    for block in (10**6, 100):
        at, group = [], []
        for pick, head in suffix_dedup.window_groups(text, starts, sampled, 50, block):
            at += starts[pick].tolist()
            group += (np.cumsum(head) + len(group) * 1000).tolist()
        raw = text.tobytes()
        windows = [raw[a:a + 50] for a in at]
        assert sorted(at) == starts.tolist() and windows == sorted(windows)
        for k in range(1, len(at)):
            assert (windows[k] == windows[k - 1]) == (group[k] == group[k - 1])


@pytest.mark.parametrize("op", [
    lambda d: exact_dedup.exact_dedup(d), lambda d: jaccard_join.jaccard_components(d), lambda d: phrase_automata.remove_repeats(d),
    lambda d: suffix_dedup.remove_repeats(d), lambda d: exact_dedup.drop_copies(d), lambda d: jaccard_join.drop_near_copies(d)])
def test_empty_table(spark, docs, op):
    assert op(docs([])).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    got = dict(common.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{k: 0 for k in range(31)}, **{k: 100 for k in range(100, 140)}}


def test_very_long_text(spark):
    rng = np.random.default_rng(5)
    long = " ".join(f"w{x}" for x in rng.integers(0, 5000, 300_000))
    rows = [(1, long), (2, "short " + long[1000:200_000]), (3, "other")]
    d = frame(spark, rows)
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(d).collect()}
    assert got[1].n_removed == 0 and got[2].n_removed >= 198_990
    got = {r.doc_id: r for r in phrase_automata.remove_repeats(d).collect()}
    assert got[1].n_removed == 0 and got[2].n_words - got[2].n_removed <= 3
    assert jaccard_join.jaccard_components(d).where(F.col("doc_id") != F.col("component_id")).count() == 0


def test_divide_skip_forest_joins_all_that_pairs_join():
    rng = np.random.default_rng(8)
    bounds = jaccard_join.Bounds(70, 100)
    for _ in range(60):
        sets = [set(rng.integers(0, 30, 12).tolist()) for _ in range(4)]
        while len(sets) < 30:
            s = set(sets[rng.integers(len(sets))])
            s ^= set(rng.integers(0, 30, rng.integers(1, 4)).tolist())
            sets.append(s or {1})
        order = rng.permutation(len(sets))
        arrays = [np.array(sorted(sets[k]), np.uint64) for k in order]

        def roots(links, root):
            root = list(root)
            for a, b in links:
                old, new = root[a], root[b]
                root = [new if r == old else r for r in root]
            return [root.index(r) for r in root]
        start = np.where(rng.random(30) < 0.3, 0, np.arange(30))
        all_ = jaccard_join.divide_skip(arrays, bounds, find_all=True)
        assert roots(jaccard_join.divide_skip(arrays, bounds), range(30)) == roots(all_, range(30))
        assert roots(jaccard_join.divide_skip(arrays, bounds, root=start), start) == roots(all_, start)


def template_family(n, words=160, own=45, seed=3):
    """Texts of one template whose pairs stay below the threshold, with a few true near copies among them."""
    rng = random.Random(seed)
    template = [f"t{k}" for k in range(words)]
    rows = []
    for k in range(n):
        w = list(template)
        for at in rng.sample(range(words), own // 4):
            w[at] = f"v{k}x{at}"
        rows.append((k, " ".join(w)))
        if k % 50 == 7:
            rows.append((n + k, " ".join(w[:-2] + [f"z{k}"])))
    return rows


def test_jaccard_template_family_meets_by_rare_shingles(spark, docs, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 40)
    monkeypatch.setattr(jaccard_join, "LARGE", 20)
    rows = template_family(300)
    got = jaccard_join.jaccard_components(docs(rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(brute_components(rows, 4, 85, 100))


def test_jaccard_large_groups_of_a_common_shingle(spark, docs, monkeypatch):
    # few words in all: rare shingles are shared by many sets, blocks become pairs of parts
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 10)
    monkeypatch.setattr(jaccard_join, "LARGE", 5)
    rng = random.Random(4)
    rows = [(k, " ".join(["a", "b", "c", "d", "e", "f"][(j * j + (j in spots)) % 6] for j in range(60)))
            for k in range(250) for spots in [set(rng.sample(range(60), rng.randint(0, 6)))]]
    got = jaccard_join.jaccard_components(docs(rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(brute_components(rows, 4, 85, 100))


def test_components_in_one_partition_and_by_stars(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(k, k + 1) for k in range(300, 340)]
    df = spark.createDataFrame(edges, "a long, b long")
    one, many = (sorted(map(tuple, common.components(df, rows).collect())) for rows in (500_000, 40))
    assert one == many and dict(one)[340] == 300


def shared_rows(batches, bounds):
    """(sig, cls, hub) rows of jaccard_join._shared."""
    return [r for b in jaccard_join._shared(bounds)(iter(batches)) for r in zip(*(b.column(c).to_pylist() for c in ("sig", "cls", "hub")))]


def test_signatures_keep_likely_partners_in_any_batches(monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 12)
    rng = np.random.default_rng(6)
    bounds = jaccard_join.Bounds()
    base = [rng.integers(0, 2**63, 100).astype(np.uint64) for _ in range(3)]
    sets = {c: np.unique(np.concatenate([base[c % 3][:97 if c % 2 else 40], rng.integers(0, 2**63, 3 if c % 2 else 60).astype(np.uint64)])) for c in range(40)}
    one = jaccard_join.group_sketches(np.concatenate(list(sets.values())), np.cumsum([0, *map(len, sets.values())]),
                                      np.arange(40), np.full(40, bounds.group(100)), np.where(np.arange(40) % 5, 1, 1600), bounds).to_pylist()
    assert {len(x) for x in one} == {8, 16}  # those sent often are narrower
    rows = sorted((s, int(c)) for s in range(-20, 20) for c in rng.choice(40, rng.choice([1, 2, 5, 11, 30]), replace=False))
    rows = sorted(rows + rows[::7])  # a class comes once a task

    def linked(a, b):
        both = len(np.intersect1d(sets[a], sets[b]))
        return 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both)
    want, large = set(), set()
    for s in range(-20, 20):
        own = {c for k, c in rows if k == s}
        if len(own) > 12:
            large |= {(s, c, min(own)) for c in own}
        want |= {(s, c) for c in own if any(linked(c, d) for d in own - {c})}
    for size in (1, 3, 10, 1000):
        batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.int64()),
                                               pa.array([len(sets[r[1]]) for r in part], pa.int64()), pa.array([one[r[1]] for r in part], pa.binary())],
                                              names=["sig", "cls", "n", "sketch"]) for k in range(0, len(rows), size) for part in [rows[k:k + size]]]
        got = shared_rows(batches, bounds)
        assert len(set(got)) == len(got) and want <= {r[:2] for r in got}
        if size <= 10:
            assert large <= set(got)
        # what is left under the other signatures are the classes of near copies
        assert all(c % 2 for s, c, h in set(got) - large if not any(s == x[0] for x in large))
        assert all(h <= c and (s, h) in {r[:2] for r in got} for s, c, h in got)


def test_passages_alone_bring_no_classes_together(spark, docs):
    rows = template_family(120)
    bounds = jaccard_join.Bounds()
    texts = docs(rows).select("text")
    shared = (jaccard_join.recurring_signatures(texts, 4, bounds).repartition("sig").sortWithinPartitions("sig", "cls")
              .mapInArrow(jaccard_join._shared(bounds), "sig long, cls long, hub long"))
    assert 6 <= shared.select("cls").distinct().count() <= 20  # three pairs of near copies in one template
    got = jaccard_join.jaccard_components(docs(rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(brute_components(rows, 4, 85, 100))


def test_compact_counts_in_few_tasks(spark):
    sc = spark.sparkContext
    sc.setJobGroup("compact", "count of a written table")
    try:
        out = common.compact(spark.range(1000, numPartitions=300))
        status = sc.statusTracker()
        tasks = [status.getStageInfo(s).numTasks for j in status.getJobIdsForGroup("compact") for s in status.getJobInfo(j).stageIds]
    finally:
        sc._jsc.clearJobGroup()
    assert out.written_rows == 1000 and sorted(r.id for r in out.collect()) == list(range(1000))
    assert sorted(tasks)[-1] == 300 and sorted(tasks)[-2] <= 4 * sc.defaultParallelism  # written by 300, counted by few


def test_jaccard_steps_release_what_the_driver_holds(spark, docs, monkeypatch):
    steps = []
    monkeypatch.setattr(jaccard_join, "release", lambda spark: steps.append("release"))
    for name in ("compact", "checkpointed"):
        monkeypatch.setattr(jaccard_join, name, lambda df, *a, f=getattr(jaccard_join, name): (steps.append("write"), f(df, *a))[1])
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 4)  # large families too
    rows = [(k, t) for k, (_, t) in enumerate(corpus(5))]
    got = jaccard_join.jaccard_components(docs(rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(brute_components(rows, 4, 85, 100))
    # signature rows and the documents that sets are made of are released before the next step is planned
    assert steps[:6] == ["release", "write", "write", "release", "write", "release"]
