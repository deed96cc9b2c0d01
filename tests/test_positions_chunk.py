"""Positions (block-wise and global) and overlapping windows on built frames."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import turns_frame
from threadline.operators import chunk as C
from threadline.operators import nested as N
from threadline.operators.positions import global_positions, turn_positions


def py_windows(n, L=40, tail=4):
    s = L // 2
    return [(i, list(range(i, min(i + L, n)))) for i in range(0, max(1, n - tail), s)]


def test_turn_positions_with_gaps_and_small_blocks(spark):
    rnd = random.Random(7)
    rows, expect = [], {}
    for cid, n in [(1, 500), (2, 3), (3, 1), (4, 37)]:
        turns = sorted(rnd.sample(range(0, 5000), n))
        for p, t in enumerate(turns):
            rows.append((cid, t, "user", f"{cid}-{t}"))
            expect[(cid, t)] = (p, n)
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    out = turn_positions(df, "conv_id", "turn", block_size=16).collect()
    got = {(r.conv_id, r.turn): (r.pos, r.n) for r in out}
    assert got == expect


def test_turn_positions_null_key(spark):
    df = spark.createDataFrame([(None, 3, "user", "a"), (None, 1, "user", "b"), (5, 2, "user", "c")],
                               "conv_id bigint, turn bigint, role string, text string")
    got = {(r.conv_id, r.turn): r.pos for r in turn_positions(df).collect()}
    assert got == {(None, 1): 0, (None, 3): 1, (5, 2): 0}


def test_global_positions_match_sort(spark):
    ids = list(range(1000))
    random.Random(3).shuffle(ids)
    df = spark.createDataFrame([(i, f"k{i % 7}") for i in ids], "id bigint, g string")
    ranked = global_positions(df, ["g", "id"], num_partitions=4)
    expect = {i: r for r, i in enumerate(sorted(ids, key=lambda i: (f"k{i % 7}", i)))}
    got = {r.id: r.gpos for r in ranked.frame.collect()}
    assert ranked.total == 1000
    assert got == expect


SIZES = [1, 3, 4, 5, 6, 24, 25, 40, 44, 45]


@pytest.mark.parametrize("L,tail", [(40, 4), (4, 4), (5, 2), (2, 0)])
def test_window_starts_match_reference_loop(spark, L, tail):
    convs = {n: [("user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(n)] for n in SIZES}
    recs = C.chunk_overlap(turns_frame(spark, convs), max_turns=L, tail=tail).collect()
    got = sorted((r.conv_id, r.start, [t.pos for t in r.turns]) for r in recs)
    expect = sorted((n, s, members) for n in SIZES for s, members in py_windows(n, L, tail))
    assert got == expect


def test_window_stride_zero_raises():
    with pytest.raises(ValueError):
        C.window_starts(max_turns=1)


def test_assemble_segments_are_bounded(spark):
    convs = {1: [("user", str(i)) for i in range(10)], 2: [("user", "x")]}
    recs = N.assemble(turns_frame(spark, convs), max_turns=4).collect()
    got = sorted((r.conv_id, r.start, [t.pos for t in r.turns]) for r in recs)
    assert got == [(1, 0, [0, 1, 2, 3]), (1, 4, [4, 5, 6, 7]), (1, 8, [8, 9]), (2, 0, [0])]
    flat = N.explode_turns(N.assemble(turns_frame(spark, convs), max_turns=4)).filter(F.col("conv_id") == 1)
    assert sorted(r.pos for r in flat.collect()) == list(range(10))


def test_turn_positions_null_turns_rank_first(spark):
    df = spark.createDataFrame([(1, None, "user", "a"), (1, 2000, "user", "b"), (1, 5, "user", "c"),
                                (2, None, "user", "d")],
                               "conv_id bigint, turn bigint, role string, text string")
    got = {r.text: (r.pos, r.n) for r in turn_positions(df, block_size=16).collect()}
    assert got == {"a": (0, 3), "c": (1, 3), "b": (2, 3), "d": (0, 1)}


@pytest.mark.parametrize("L,s,tail,block", [(4, 2, 4, 2), (5, 2, 2, 3), (6, 3, 0, 1), (3, 5, 1, 2), (40, 20, 4, 7)])
def test_small_position_blocks_with_halo(spark, L, s, tail, block):
    sizes = [1, 2, 3, 5, 6, 7, 9, 13, 20, 31, 64]
    convs = {n: [("user", f"t{i}") for i in range(n)] for n in sizes}
    recs = C.chunk_overlap(turns_frame(spark, convs), max_turns=L, stride=s, tail=tail, block_turns=block).collect()
    got = sorted((r.conv_id, r.start, [t.pos for t in r.turns]) for r in recs)
    expect = sorted((n, i, list(range(i, min(i + L, n)))) for n in sizes for i in range(0, max(1, n - tail), s))
    assert got == expect


def test_two_level_offsets_with_many_blocks(spark, monkeypatch):
    from threadline.operators import positions as P
    monkeypatch.setattr(P, "SUPER", 3)
    rows = [(7, t, "user" if t % 3 else "assistant", "x") for t in range(0, 400, 3)]
    rows += [(8, t, "user", "y") for t in (5, 1, 999, 40)] + [(9, None, "user", "z"), (9, 2, "user", "w")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    out = P.turn_positions(df, block_size=4, within=["role"], within_pos_col="rpos").collect()
    got = {(r.conv_id, r.turn): (r.pos, r.n, r.rpos) for r in out}
    for cid in (7, 8, 9):
        mine = sorted((r for r in rows if r[0] == cid), key=lambda r: (r[1] is not None, r[1]))
        for i, r in enumerate(mine):
            same = [x for x in mine if x[2] == r[2]]
            assert got[(cid, r[1])] == (i, len(mine), same.index(r))


def test_negative_null_and_extreme_order_values(spark):
    turns = [None, -(2**63), -5000, -1025, -1024, -1, 0, 3, 1023, 1024, 2**63 - 1]
    rows = [(c, t, "user", f"{c}") for c in (1, 2) for t in turns]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {(r.conv_id, r.turn): (r.pos, r.n) for r in turn_positions(df).collect()}
    assert got == {(c, t): (i, len(turns)) for c in (1, 2) for i, t in enumerate(turns)}
