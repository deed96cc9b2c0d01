"""Gates, dedup, roles, runs and scalar text functions against Python models."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import turns_frame
from threadline.functions import roles as R
from threadline.functions import text as T
from threadline.operators import dedup as D
from threadline.operators import filters as FL
from threadline.operators import nested as N
from threadline.operators import render as RD
from threadline.operators import runs as RU
from threadline.operators import stats as S

CALL, RESP = "<tool_call>", "<tool_response>"
GATE_CONVS = {
    1: [("user", "do x"), ("assistant", f"{CALL} a"), ("user", f"{RESP} r"), ("assistant", f"{CALL} b")],
    2: [("assistant", f"{CALL} a"), ("user", f"{RESP} r"), ("assistant", f"{CALL} b")],
    3: [("user", "hi"), ("assistant", f"{CALL}")],
    4: [("user", "do"), ("assistant", f"{CALL} a"), ("user", f"{RESP} r")],
    5: [("user", "do"), ("assistant", f"{CALL} a"), ("assistant", f"{CALL} b")],
    6: [("user", "do"), ("user", f"{CALL} {RESP}"), ("assistant", f"{CALL} {RESP}"), ("assistant", CALL)],
}


def py_reason(turns, min_tools=2):
    if len(turns) < 3:
        return "too_short"
    if sum(1 for r, t in turns if r == "assistant" and CALL in t) < min_tools:
        return "few_marked"
    if sum(1 for _, t in turns if RESP in t) < 1:
        return "no_response"
    if turns[0][0] != "user":
        return "wrong_first_role"
    return "accepted"


def test_quality_gate_defaults(spark):
    recs = N.assemble(turns_frame(spark, GATE_CONVS))
    got = {r.conv_id: r.reason for r in recs.select("conv_id", FL.gate_reason(F.col("turns")).alias("reason")).collect()}
    assert got == {cid: py_reason(t) for cid, t in GATE_CONVS.items()}
    kept = sorted(r.conv_id for r in FL.quality_gate(recs).collect())
    assert kept == sorted(c for c, t in GATE_CONVS.items() if py_reason(t) == "accepted")
    report = {r.reason: r.n_records for r in S.gate_report(recs).collect()}
    assert sum(report.values()) == len(GATE_CONVS)


def test_conversation_quality_flat_matches_records(spark):
    flat = turns_frame(spark, GATE_CONVS)
    got = {r.conv_id: r.passes for r in FL.conversation_quality(flat).collect()}
    assert got == {cid: py_reason(t) == "accepted" for cid, t in GATE_CONVS.items()}


def test_dedup_keeps_first_on_200_char_prefix(spark):
    base = "x" * 200
    convs = {
        5: [("user", base + "tail-a"), ("assistant", "r")],
        3: [("user", base + "tail-b"), ("assistant", "r")],
        4: [("user", "different"), ("assistant", "r")],
        9: [("user", base[:199] + "y"), ("assistant", "r")],
    }
    recs = N.assemble(turns_frame(spark, convs))
    kept = sorted(r.conv_id for r in D.dedup_prefix(recs).collect())
    assert kept == [3, 4, 9]


def test_role_maps_else_vs_drop(spark):
    df = spark.createDataFrame([("user",), ("assistant",), ("system",), ("tool",)], "role string")
    got = [(r.a, r.b) for r in df.select(R.map_role_else("role").alias("a"),
                                         R.map_role_drop("role").alias("b")).collect()]
    assert got == [("user", "User"), ("assistant", "Assistant"), ("assistant", None), ("assistant", None)]


def test_render_drops_unknown_roles(spark):
    convs = {1: [("system", "s"), ("user", "u"), ("tool", "t"), ("assistant", "a")]}
    txt = RD.render_text(N.assemble(turns_frame(spark, convs))).collect()[0].text
    assert txt == "User: u\n\nAssistant: a"


def test_role_set_check(spark):
    convs = {1: [("user", "a"), ("assistant", "b")], 2: [("system", "s"), ("user", "a"), ("assistant", "b")],
             3: [("user", "a"), ("user", "b")]}
    got = {r.conv_id: r.roles_ok for r in FL.role_set_check(turns_frame(spark, convs)).collect()}
    assert got == {1: True, 2: False, 3: False}


def py_max_run(roles):
    best = cur = 1
    for a, b in zip(roles, roles[1:]):
        cur = cur + 1 if a == b else 1
        best = max(best, cur)
    return best


def test_max_role_run_and_violations(spark):
    convs = {1: [("user", "x")] + [("assistant", str(i)) for i in range(9)] + [("user", "y")],
             2: [("user", "a"), ("assistant", "b")] * 3,
             3: [("user", "a")]}
    df = turns_frame(spark, convs)
    got = {r.conv_id: r.max_run for r in RU.max_role_run(df).collect()}
    assert got == {c: py_max_run([r for r, _ in t]) for c, t in convs.items()}
    assert [r.conv_id for r in RU.run_violations(df).collect()] == [1]


BLANKS = [None, "", "   ", "\t\t", "\xa0", "　x y ", " a ", "a b\x1c", "\x85z"]


def test_whitespace_semantics_match_python(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(BLANKS)], "i int, s string")
    out = df.select("i", T.is_nonblank("s").alias("nb"), T.token_count("s").alias("tok"),
                    T.trim_ws("s").alias("tr")).orderBy("i").collect()
    for r, s in zip(out, BLANKS):
        assert r.nb == bool(s and s.strip())
        assert r.tok == (len(s.split()) if s is not None else 0)
        assert r.tr == (s.strip() if s is not None else None)


def test_truncate_counts_code_points(spark):
    texts = ["a" * 2500, "b" * 3000, "c" * 3001, "\U0001d11e" * 3001, "\U0001d11e" * 2999 + "xy"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.o for r in df.select(T.truncate_long("t").alias("o")).collect()]
    expect = [t if len(t) <= 3000 else t[:2500] + "\n...[truncated]..." for t in texts]
    assert got == expect


def py_embedded(s):
    try:
        json.loads(s)
        return s
    except ValueError:
        pass
    for o, c in (("[", "]"), ("{", "}")):
        i, j = s.find(o), s.rfind(c)
        if i != -1 and j > i:
            try:
                json.loads(s[i:j + 1])
                return s[i:j + 1]
            except ValueError:
                pass
    return None


@pytest.mark.parametrize("s", ['{"a": 1}', "text [1, 2] more", 'x {"a": [1]} y', "no json", "[1, 2",
                               '{"a":1} and [2]', "] [", '12', 'pre [{"k": "v"}] and {"z": 0} post',
                               "[not json] {\"ok\": true}"])
def test_embedded_json_matches_python(spark, s):
    got = spark.createDataFrame([(s,)], "s string").select(T.embedded_json("s").alias("j")).collect()[0].j
    assert got == py_embedded(s)


def test_extract_all_and_names(spark):
    text = 'call {"name": "Bash", "arguments": {}} then {"name":\t"Read"} and "name": "Bash"'
    df = spark.createDataFrame([(1, 0, "assistant", text), (1, 1, "user", '"name": "Write"')],
                               "conv_id bigint, turn bigint, role string, text string")
    names = sorted(r.name for r in S.distinct_names(df).collect())
    assert names == ["Bash", "Read"]
    core = sorted(r.name for r in S.name_overlap(S.distinct_names(df), ["Bash", "Read", "Write", "Edit"]).collect())
    assert len(core) >= 2
    loss = spark.createDataFrame([("step 1 loss: 2.50 Loss 1.25 loss=3.0",)], "t string")
    vals = loss.select(T.extract_all("t", T.LOSS_PATTERN).alias("v")).collect()[0].v
    assert vals == ["2.50", "1.25"]


def test_dataset_stats_zero_safe(spark):
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    r = S.dataset_stats(empty).collect()[0]
    assert (r.total_conversations, r.total_turns, r.avg_turns_per_conv, r.marker_percentage) == (0, 0, 0.0, 0.0)


def test_whitespace_chars_are_pythons_isspace_set():
    assert T.WHITESPACE_CHARS == "".join(c for c in map(chr, range(0x110000)) if c.isspace())


def test_block_counts_and_session_gate(spark):
    schema = "session bigint, blocks array<struct<type:string, name:string, text:string>>"
    rows = [(1, [("text", None, "hi"), ("tool_use", "Bash", None), ("tool_use", "Nope", None)]),
            (1, [("tool_use", "Read", None), ("thinking", None, "x")]),
            (2, [("tool_use", "Bash", None)]), (2, []), (3, None)]
    df = spark.createDataFrame(rows, schema)
    got = {r.session: r.n_blocks for r in FL.session_block_gate(df, 2).collect()}
    assert got == {1: 2}
    counts = {r.block_type: r.n_blocks for r in N.block_counts(df).collect()}
    assert counts == {"text": 1, "tool_use": 4, "thinking": 1}


def test_record_max_run_fold_matches_python(spark):
    convs = {1: [("user", "x")] + [("assistant", str(i)) for i in range(9)] + [("user", "y")],
             2: [("user", "a"), ("assistant", "b")] * 3, 3: [("user", "a")],
             4: [("system", "s"), ("user", "a"), ("user", "b"), ("tool", "t"), ("tool", "u"), ("tool", "v")]}
    recs = N.assemble(turns_frame(spark, convs))
    got = {r.conv_id: r.m for r in recs.select("conv_id", RU.record_max_run(F.col("turns")).alias("m")).collect()}
    assert got == {c: py_max_run([r for r, _ in t]) for c, t in convs.items()}


def test_empty_and_null_records(spark):
    schema = "conv_id bigint, start bigint, turns array<struct<pos:bigint, turn:bigint, role:string, text:string>>"
    recs = spark.createDataFrame([(1, 0, []), (2, 0, None), (3, 0, [(0, 0, "user", "hi")]),
                                  (4, 0, [(0, 0, "user", "a"), (1, 1, "assistant", None)])], schema)
    assert sorted(r.conv_id for r in FL.record_drop_empty(recs).collect()) == [3, 4]
    assert sorted(r.conv_id for r in FL.record_valid_structure(recs).collect()) == [4]
    reasons = {r.conv_id: r.x for r in recs.select("conv_id", FL.gate_reason(F.col("turns")).alias("x")).collect()}
    assert reasons[1] == "too_short" and reasons[2] == "too_short"
    assert sorted(r.conv_id for r in D.dedup_prefix(recs).collect()) == [3, 4]
    txt = {r.conv_id: r.text for r in RD.render_text(recs).collect()}
    assert txt[1] == "" and txt[3] == "User: hi" and txt[4] == "User: a\n\nAssistant: "
    st = S.record_stats(recs).collect()[0]
    assert (st.total_conversations, st.total_turns) == (4, 3)


def test_embedded_json_fuzz_matches_python(spark):
    import random
    rnd = random.Random(7)
    frags = ['NaN', 'Infinity', '-Infinity', '-', '.5', '[', ']', '{', '}', ',', ':', ' ', '"a"', '"k": ', '1',
             '-2.5e3', '01', 'true', 'null', 'x', '"\\u00e9"', '"\\n"', '1e400', '"', '\\', '[]', '{}', '\t']
    cases = sorted({"".join(rnd.choice(frags) for _ in range(rnd.randint(1, 9))) for _ in range(2000)})
    df = spark.createDataFrame([(i, s) for i, s in enumerate(cases)], "i int, s string")
    got = {r.i: r.j for r in df.select("i", T.embedded_json("s").alias("j")).collect()}
    assert [c for i, c in enumerate(cases) if got[i] != py_embedded(c)] == []


def test_whitespace_fuzz_matches_python(spark):
    import random
    rnd = random.Random(11)
    alphabet = list(T.WHITESPACE_CHARS) + ["a", "é", "\U0001d11e", "x y", "​", "﻿", "", "\x00"]
    cases = sorted({"".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 8))) for _ in range(3000)})
    df = spark.createDataFrame([(i, s) for i, s in enumerate(cases)], "i int, s string")
    out = {r.i: r for r in df.select("i", T.is_nonblank("s").alias("nb"), T.trim_ws("s").alias("tr"),
                                     T.token_count("s").alias("tok")).collect()}
    for i, s in enumerate(cases):
        r = out[i]
        assert (r.nb, r.tr, r.tok) == (bool(s.strip()), s.strip(), len(s.split())), repr(s)
