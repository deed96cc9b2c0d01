"""Transforms, exact sampling and splits against Python models."""

import pytest
from pyspark.sql import functions as F

from conftest import turns_frame
from threadline.operators import augment as A
from threadline.operators import nested as N
from threadline.operators import sample as SA
from threadline.operators import split as SP
from threadline.operators.positions import turn_positions
from threadline.plans import hybrid as HY


def py_reverse(c):
    return c[:2] + list(reversed(c[2:-1])) + [c[-1]] if len(c) >= 4 else c


def py_shorten(c):
    return c[:2] + c[-2:] if len(c) >= 6 else c


CONVS = {n: [("user" if i % 2 == 0 else "assistant", f"{n}:{i}") for i in range(n)] for n in range(1, 9)}


def test_nested_transforms_equal_python_slices(spark):
    recs = N.assemble(turns_frame(spark, CONVS))
    out = recs.select("conv_id", A.reverse_turns(F.col("turns")).alias("r"),
                      A.shorten_turns(F.col("turns")).alias("s")).collect()
    for row in out:
        texts = [t for _, t in CONVS[row.conv_id]]
        assert [t.text for t in row.r] == py_reverse(texts)
        assert [t.text for t in row.s] == py_shorten(texts)


def test_flat_transforms_equal_nested(spark):
    pos = turn_positions(turns_frame(spark, CONVS))
    rev = A.aug_reverse(pos).collect()
    sho = A.aug_shorten(pos).collect()
    for n, turns in CONVS.items():
        texts = [t for _, t in turns]
        got_r = [r.text for r in sorted((r for r in rev if r.conv_id == n), key=lambda r: r.pos)]
        got_s = [r.text for r in sorted((r for r in sho if r.conv_id == n), key=lambda r: r.pos)]
        assert got_r == py_reverse(texts)
        assert got_s == py_shorten(texts)


def test_prefix_is_seeded_and_user_only(spark):
    pos = turn_positions(turns_frame(spark, CONVS))
    a = {(r.conv_id, r.pos): r.text for r in A.aug_prefix(pos, seed=42).collect()}
    b = {(r.conv_id, r.pos): r.text for r in A.aug_prefix(pos.repartition(3), seed=42).collect()}
    assert a == b
    changed = [k for k, t in a.items() if t != f"{k[0]}:{k[1]}"]
    assert changed and all(k[1] % 2 == 0 for k in changed)
    assert all(any(a[k].startswith(p) for p in A.PARAPHRASE_PREFIXES[:3]) for k in changed)


def test_exact_sample_size_and_replay(spark):
    df = spark.createDataFrame([(i,) for i in range(101)], "conv_id bigint")
    s = SA.exact_sample(df, "conv_id", 42, ratio=0.5)
    picked = {r.conv_id for r in df.filter(s.predicate()).collect()}
    assert s.k == 50 and len(picked) == 50
    s2 = SA.exact_sample(df.repartition(5), "conv_id", 42, ratio=0.5)
    assert {r.conv_id for r in df.filter(s2.predicate()).collect()} == picked
    all_ = SA.exact_sample(df, "conv_id", 42, k=1000)
    assert df.filter(all_.predicate()).count() == 101
    none = SA.exact_sample(df, "conv_id", 42, k=0)
    assert df.filter(none.predicate()).count() == 0


@pytest.mark.parametrize("n", range(1, 101))
def test_split_bounds_follow_python(n):
    assert SP.split_bounds(n) == (int(n * 0.8), int(n * (0.8 + 0.1)))
    assert SP.split_bounds(n, rule="additive") == (int(n * 0.8), int(n * 0.8) + int(n * 0.1))


def test_split_rules_differ_at_nine():
    assert SP.split_bounds(9) == (7, 8)
    assert SP.split_bounds(9, rule="additive") == (7, 7)
    assert SP.split_bounds(4747) == (3797, 4272)


@pytest.mark.parametrize("n", [1, 2, 3, 9, 10, 11, 20])
@pytest.mark.parametrize("rule", ["cumulative", "additive"])
def test_prefix_split_counts(spark, n, rule):
    df = spark.createDataFrame([(i,) for i in range(n)], "conv_id bigint")
    out = SP.split_prefix(df, "conv_id", seed=None, rule=rule).collect()
    t, v = SP.split_bounds(n, rule=rule)
    got = {r.conv_id: r.split for r in out}
    assert got == {i: ("train" if i < t else "valid" if i < v else "test") for i in range(n)}


def test_grouped_split_keeps_origins_together(spark):
    rows, _ = HY.build_hybrid(turns_frame(spark, CONVS), ratio=1.0, seed=7)
    grouped = SP.split_grouped(rows, "conv_id", 42)
    per_origin = grouped.groupBy("conv_id").agg(F.countDistinct("split").alias("k")).collect()
    assert all(r.k == 1 for r in per_origin)


def test_hybrid_counts(spark):
    rows, stats = HY.build_hybrid(turns_frame(spark, CONVS), ratio=0.5, seed=42)
    recs = rows.select("conv_id", "variant").distinct().collect()
    assert sum(1 for r in recs if r.variant == 0) == 8
    assert sum(1 for r in recs if r.variant == 1) == 4
    st = stats.collect()[0]
    assert st.total_conversations == 12


def test_selection_narrowing_matches_sort(spark):
    import hashlib

    from threadline.operators.select import seeded_proxy_stats
    n = 20000
    df = spark.createDataFrame([(i,) for i in range(n)], "conv_id bigint")
    ranks = [0, 777, 10000, 15999, n - 1]
    total, at = seeded_proxy_stats(df, 42, ["conv_id"], ranks, bracket_rows=100, accuracy=1000)
    order = sorted((hashlib.md5(f"42:{i}".encode()).hexdigest(), i) for i in range(n))
    assert total == n
    assert at == {k: order[k] for k in ranks}


def test_selection_tie_group_falls_back_to_exact_rank(spark):
    from threadline.operators.select import order_stats
    df = spark.createDataFrame([(i,) for i in range(500)], "conv_id bigint")
    total, at = order_stats(df, F.lit(0).cast("bigint"), ["conv_id"], [5, 123, 499], bracket_rows=10)
    assert (total, at) == (500, {5: (5,), 123: (123,), 499: (499,)})


def test_hybrid_splits_match_row_labels(spark):
    rows, _ = HY.build_hybrid(turns_frame(spark, CONVS), ratio=0.5, seed=42)
    from_rows = sorted(tuple(r) for r in rows.select("conv_id", "variant", "split").distinct().collect())
    direct = sorted(tuple(r) for r in HY.hybrid_splits(turns_frame(spark, CONVS), ratio=0.5, seed=42).collect())
    assert from_rows == direct


def test_selection_splits_and_samples_match_duckdb_when_narrowing(spark):
    import random

    import duckdb

    ids = random.Random(3).sample(range(10**9), 20000)
    df = spark.createDataFrame([(i,) for i in ids], "conv_id bigint")
    con = duckdb.connect()
    con.register("t", df.toPandas())
    for seed in (None, 42):
        got = {r.conv_id: r.split for r in SP.split_prefix(df, "conv_id", seed=seed).collect()}
        order = "conv_id" if seed is None else f"md5('{seed}:' || conv_id), conv_id"
        want = dict(con.sql(f"""SELECT conv_id, CASE WHEN g < floor(n * 0.8::DOUBLE) THEN 'train'
                 WHEN g < floor(n * (0.8::DOUBLE + 0.1::DOUBLE)) THEN 'valid' ELSE 'test' END
                 FROM (SELECT conv_id, row_number() OVER (ORDER BY {order}) - 1 g, count(*) OVER () n FROM t)""").fetchall())
        assert got == want
    smp = SA.exact_sample(df, "conv_id", 7, ratio=0.37)
    got = {r.conv_id for r in df.filter(smp.predicate()).collect()}
    want = {r[0] for r in con.sql("SELECT conv_id FROM (SELECT conv_id, row_number() OVER "
                                  "(ORDER BY md5('7:' || conv_id), conv_id) - 1 g FROM t) WHERE g < 7400").fetchall()}
    assert got == want


@pytest.mark.parametrize("n", [3, 300])
def test_selection_with_null_and_nan_keys(spark, n):
    from threadline.operators.select import order_stats
    keys = [None, None, float("nan"), float("inf"), float("-inf")] + [float(i % 50) for i in range(n)]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k double, i bigint")
    want = [(r.k, r.i) for r in df.orderBy("k", "i").collect()]
    ranks = list(range(0, len(keys), max(1, len(keys) // 20))) + [len(keys) - 1]
    total, at = order_stats(df, F.col("k"), ["k", "i"], ranks, bracket_rows=8)
    assert total == len(keys)
    assert {k: repr(v) for k, v in at.items()} == {k: repr(want[k]) for k in set(ranks)}


def test_ordered_split_puts_null_keys_first(spark):
    df = spark.createDataFrame([(None,), *[(i,) for i in range(9)]], "conv_id bigint")
    got = {r.conv_id: r.split for r in SP.split_prefix(df, "conv_id").collect()}
    assert got == {None: "train", **{i: "train" for i in range(7)}, 7: "valid", 8: "test"}
    nan = float("nan")
    df = spark.createDataFrame([(float(i),) for i in range(9)] + [(nan,)], "conv_id double")
    got = {repr(r.conv_id): r.split for r in SP.split_prefix(df, "conv_id").collect()}
    assert got["nan"] == "test" and got["8.0"] == "valid" and got["7.0"] == "train"


def test_nested_and_flat_augmentation_agree(spark):
    from threadline.operators import augment as A
    from threadline.operators import nested as N
    from threadline.operators.positions import turn_positions
    df = turns_frame(spark, CONVS)
    flat = {}
    for r in A.augment_flat(turn_positions(df), "conv_id", 42).orderBy("conv_id", "pos").collect():
        flat.setdefault((r.conv_id, r.aug_type), []).append((r.role, r.text))
    nested = {(r.conv_id, r.aug_type): [(t.role, t.text) for t in r.turns]
              for r in A.augment_records(N.assemble(df), keys="conv_id", seed=42).collect()}
    assert nested == flat
