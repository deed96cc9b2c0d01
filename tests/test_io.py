"""JSONL sources, sinks and incremental ingest on built files."""

import glob
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import turns_frame
from threadline.operators import nested as N
from threadline.operators import render as RD
from threadline.operators import split as SP
from threadline.sinks import export as X
from threadline.sources import jsonl as J
from threadline.streaming import ingest as IG

GOOD = {"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yo"}]}
BAD_LINES = [
    json.dumps(GOOD).encode(), b"", b"   ", b"{bad", b"[1,2]", b'"str"',
    b'{"conversations":[{"from":"human","value":"caf\xc3\xa9 \xff"}]}',
    b'{"conversations": []}', b'{"other": 1}',
]


@pytest.fixture()
def tmp():
    return tempfile.mkdtemp(prefix="threadline-io-")


def _allow(spark, *names):
    return spark.createDataFrame([(n, "owned") for n in names or ("s",)], "source string, rights string")


def _records(spark, convs, **kw):
    return N.assemble(turns_frame(spark, convs), **kw).withColumn("source", F.lit("s"))


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(b"\n".join(lines) + b"\n")


def test_tolerant_scan_skips_bad_lines(spark, tmp):
    _write(f"{tmp}/a.jsonl", BAD_LINES)
    recs = J.scan_jsonl(spark, f"{tmp}/a.jsonl").collect()
    assert len(recs) == 2
    assert [t.role for t in recs[0].turns] == ["user", "assistant"]
    assert "�" in recs[1].turns[0].text and "café" in recs[1].turns[0].text
    outcomes = {r.outcome: r.n for r in J.classify_lines(J.read_lines(spark, f"{tmp}/a.jsonl"))
                .groupBy("outcome").agg(F.count("*").alias("n")).collect()}
    assert outcomes == {"kept": 2, "blank": 2, "malformed": 1, "no_records": 4}


def test_strict_scan_fails_on_malformed(spark, tmp):
    _write(f"{tmp}/a.jsonl", [json.dumps(GOOD).encode(), b"", b"{bad"])
    with pytest.raises(Exception):
        J.scan_jsonl_strict(spark, f"{tmp}/a.jsonl").collect()
    _write(f"{tmp}/b.jsonl", [json.dumps(GOOD).encode(), b"", json.dumps(GOOD).encode()])
    assert J.scan_jsonl_strict(spark, f"{tmp}/b.jsonl").count() == 2


def test_recursive_scan_excludes_subagents(spark, tmp):
    for p in ["p1/s.jsonl", "p2/deep/s.jsonl", "p1/subagents/x.jsonl", "p1/notes.txt"]:
        _write(f"{tmp}/{p}", [json.dumps(GOOD).encode()])
    base = J.scan_recursive(spark, tmp).count()
    with_sub = J.scan_recursive(spark, tmp, include_subagents=True).count()
    assert (base, with_sub) == (2, 3)


def test_missing_files_are_skipped(spark, tmp, caplog):
    _write(f"{tmp}/a.jsonl", [json.dumps(GOOD).encode()])
    recs = J.scan_jsonl(spark, [f"{tmp}/a.jsonl", f"{tmp}/missing.jsonl"])
    assert recs.count() == 1
    assert J.scan_jsonl(spark, [f"{tmp}/missing.jsonl"]).count() == 0


def test_number_records_follows_file_order(spark, tmp):
    _write(f"{tmp}/a.jsonl", [json.dumps({"conv_id": 100 - i, **GOOD}).encode() for i in range(50)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        out = J.number_records(J.scan_jsonl(spark, f"{tmp}/a.jsonl")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.rec_id, int(r.conv_id)) for r in out) == [(i, 100 - i) for i in range(50)]


def test_concat_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "conv_id bigint, text string")
    b = spark.createDataFrame([("y", 2, "s")], "text string, conv_id bigint, source string")
    out = J.concat(a, b).orderBy("conv_id").collect()
    assert [(r.conv_id, r.text, r.source) for r in out] == [(1, "x", None), (2, "y", "s")]


def _convs(n):
    return {i: [("user", f"q{i} é"), ("assistant", f"a{i}\n\"quoted\"")] + ([("system", "s")] if i % 3 == 0 else [])
            for i in range(n)}


def test_records_roundtrip_with_splits(spark, tmp):
    recs = SP.split_grouped(_records(spark, _convs(30)), "conv_id", 42)
    X.write_records(recs, f"{tmp}/out", _allow(spark), "split")
    assert {os.path.basename(p) for p in glob.glob(f"{tmp}/out/split=*")} <= {"split=train", "split=valid", "split=test"}
    back = J.scan_jsonl(spark, f"{tmp}/out", recursive=True)
    got = {int(r.conv_id): [(t.role, t.text) for t in r.turns] for r in back.collect()}
    assert got == {k: v for k, v in _convs(30).items()}


@pytest.mark.parametrize("n,ratios", [(30, (0.8, 0.1, 0.1)), (1, (0.8, 0.1, 0.1)), (5, (1.0, 0.0, 0.0)),
                                      (0, (0.8, 0.1, 0.1)), (7, (0.0, 0.5, 0.5))])
def test_text_document_parts_concatenate_to_json(spark, tmp, n, ratios):
    convs = _convs(n)
    frame = turns_frame(spark, convs) if n else spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    recs = N.assemble(frame).withColumn("source", F.lit("s"))
    sizes = X.write_text_document(recs, f"{tmp}/doc", _allow(spark), keys=("conv_id", "start"), seed=42, ratios=ratios)
    text = "".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(f"{tmp}/doc/part-*")))
    doc = json.loads(text)
    rendered = {r.conv_id: r.text for r in RD.render_text(recs).collect()}
    import hashlib
    order = sorted(rendered, key=lambda c: (hashlib.md5(f"42:{c}:0".encode()).hexdigest(), c))
    t = int(n * ratios[0])
    v = int(n * (ratios[0] + ratios[1]))
    assert doc == {"train": [{"text": rendered[c]} for c in order[:t]],
                   "valid": [{"text": rendered[c]} for c in order[t:v]],
                   "test": [{"text": rendered[c]} for c in order[v:]]}
    assert sizes == {"train": t, "valid": v - t, "test": n - v}


def test_metadata_and_export(spark, tmp):
    recs = SP.split_grouped(N.assemble(turns_frame(spark, _convs(12))), "conv_id", 42)
    recs = recs.withColumn("source", F.when(F.col("conv_id") < 6, "src0").otherwise("src1"))
    written = X.export(recs, f"{tmp}/exp", _allow(spark, "src0"))
    assert set(written) == {"records", "text", "document", "records_table"}
    back = J.scan_jsonl(spark, f"{tmp}/exp/records", recursive=True)
    assert sorted(int(r.conv_id) for r in back.collect()) == list(range(6))
    assert {r.extra["origin_conv_id"] for r in back.collect()} == {str(i) for i in range(6)}
    X.write_metadata(spark, f"{tmp}/meta", {"total_conversations": 12, "total_turns": 30, "avg": 2.5}, 13, 0.5,
                     (0.8, 0.1, 0.1), ["records"])
    meta = json.loads(open(glob.glob(f"{tmp}/meta/part-*")[0]).read())
    assert meta["statistics"] == {"total_conversations": 12, "total_turns": 30, "avg": 2.5}
    assert meta["split_ratio"] == [0.8, 0.1, 0.1] and (meta["total_conversations"], meta["total_lines"]) == (12, 13)


def test_sinks_require_an_allow_list(spark, tmp):
    from threadline.plans import hybrid as HY
    recs = SP.split_grouped(_records(spark, _convs(4)), "conv_id", 42)
    for sink in (X.write_records, X.write_text_records, X.write_text_document, X.export):
        with pytest.raises(ValueError):
            sink(recs, f"{tmp}/no", None)
        with pytest.raises(ValueError):
            sink(recs.drop("source"), f"{tmp}/no", _allow(spark))
        with pytest.raises(TypeError):
            sink(recs, f"{tmp}/no")
    rows, _ = HY.build_hybrid(turns_frame(spark, _convs(4)), ratio=0.5, seed=42)
    with pytest.raises(ValueError):
        HY.write_hybrid(rows, f"{tmp}/no", None)
    assert not os.path.exists(f"{tmp}/no")


def test_long_conversations_keep_their_order(spark, tmp):
    convs = {7: [("user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(3000)], **_convs(5)}
    X.write_records(_records(spark, convs), f"{tmp}/long", _allow(spark), None)
    back = J.flatten_records(J.scan_jsonl(spark, f"{tmp}/long"), ["conv_id"])
    got = {}
    for r in back.orderBy("conv_id", "pos").collect():
        got.setdefault(int(r.conv_id), []).append((r.role, r.text))
    assert got == convs


def test_every_segment_lies_in_the_split_of_its_conversation(spark, tmp):
    from threadline.plans import hybrid as HY
    convs = {i: [("user" if k % 2 == 0 else "assistant", f"c{i} t{k}") for k in range(2 + i % 7)] for i in range(30)}
    turns = turns_frame(spark, convs).withColumn("source", F.lit("s"))
    rows, stats = HY.build_hybrid(turns, ratio=0.5, seed=42)
    out = HY.write_hybrid(rows, f"{tmp}/hy", _allow(spark), ratio=0.5, max_turns=3)
    back = J.scan_jsonl(spark, f"{tmp}/hy/records")
    assert back.count() == out["total_lines"] > out["total_records"] == 45
    assert back.groupBy("conv_id", "variant").agg(F.countDistinct("split").alias("n")).filter("n > 1").count() == 0
    want = {(r.conv_id, r.variant): r.split for r in rows.select("conv_id", "variant", "split").distinct().collect()}
    assert {(int(r.conv_id), r.variant): r.split for r in back.collect()} == want
    # the document is cut like the other formats
    doc = json.loads("".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(f"{tmp}/hy/document/part-*"))))
    text = spark.read.json(f"{tmp}/hy/text").collect()
    for name in ("train", "valid", "test"):
        assert sorted(x["text"] for x in doc[name]) == sorted(r.text for r in text if r.split == name)


def test_incremental_ingest_keeps_every_line_and_adds_nothing_on_rerun(spark, tmp):
    src, tgt, ck = f"{tmp}/src", f"{tmp}/tgt", f"{tmp}/ck"
    line = json.dumps(GOOD).encode()
    _write(f"{src}/a.json", [line, line, b"", line, b"{bad"])
    IG.ingest_incremental(spark, src, tgt, ck)
    assert spark.read.parquet(tgt).count() == 3
    IG.ingest_incremental(spark, src, tgt, ck)
    assert spark.read.parquet(tgt).count() == 3
    _write(f"{src}/b.jsonl", [line, json.dumps({"conv_id": "x", **GOOD}).encode()])
    IG.ingest_incremental(spark, src, tgt, ck)
    assert spark.read.parquet(tgt).count() == 5
    once = f"{tmp}/once"
    IG.ingest_incremental(spark, src, once, f"{tmp}/ck2", dedup_days=7)
    assert spark.read.parquet(once).count() == 2


LINES = [  # line, outcome
    (b'{"conversations":[{"from":"human","value":"a"}]}', "kept"),
    (b' {"conv_id":"c-1","conversations":[{"from":"human","value":"a"}],"source":"s1","tags":["x",1]} ', "kept"),
    (b'{"conv_id":5,"conversations":[{"from":"human","value":"a"},"stray",{"from":"gpt","value":"b"}]}', "kept"),
    (b'{"conversations":[{"from":"human","value":"a ][ , b"}]}', "kept"),
    (b'{"conversations":[{"from":"human","value":"x], [y"}],"k":[[1],[2]]}', "kept"),
    (b'{"conversations":[{"from":"human","value":"a"}],"n":NaN}', "kept"),
    (b'{"conversations":[{"from":"human","value":"a"}]} trailing', "malformed"),
    (b'{"conversations":[{"from":"human","value":"a"}]}{"conversations":[]}', "malformed"),
    (b'{"conversations":[{"from":"human","value":"a"}]},{"conversations":[]}', "malformed"),
    (b'{"conversations":[{"from":"human","value":"a"}]}] [{"x":1}', "malformed"),
    (b"{'conversations':[{'from':'human','value':'a'}]}", "malformed"),
    (b'{conversations:[]}', "malformed"), (b"{bad", "malformed"), (b"nope", "malformed"),
    (b'{"conversations":[]}', "no_records"), (b'{"conversations":"text"}', "no_records"), (b'{"other":1}', "no_records"),
    (b"[1,2]", "no_records"), (b'"str"', "no_records"), (b"12", "no_records"), (b"", "blank"), (b" \t", "blank"),
]


def test_lines_are_judged_like_a_strict_json_reader(spark, tmp):
    for line, want in LINES:  # the table itself agrees with json.loads
        if want != "blank":
            try:
                json.loads(line)
                assert want != "malformed", line
            except ValueError:
                assert want == "malformed", line
    _write(f"{tmp}/t/a.jsonl", [x for x, _ in LINES])
    got = [r.outcome for r in J.classify_lines(J.read_lines(spark, f"{tmp}/t")).orderBy("src_seq").collect()]
    assert got[:len(LINES)] == [w for _, w in LINES]
    kept = sum(w == "kept" for _, w in LINES)
    recs = J.scan_jsonl(spark, f"{tmp}/t").orderBy("src_seq").collect()
    assert len(recs) == kept
    assert recs[1].conv_id == "c-1" and recs[1].extra == {"source": "s1", "tags": '["x",1]'}
    assert [t.text for t in recs[2].turns] == ["a", "b"] and recs[2].conv_id == "5"
    _write(f"{tmp}/good/a.jsonl", [x for x, w in LINES if w != "malformed"])
    assert J.scan_jsonl_strict(spark, f"{tmp}/good").count() == kept
    for i, (line, want) in enumerate(LINES):
        if want == "malformed":
            _write(f"{tmp}/bad{i}/a.jsonl", [line])
            with pytest.raises(Exception):
                J.scan_jsonl_strict(spark, f"{tmp}/bad{i}").collect()
    IG.ingest_incremental(spark, f"{tmp}/t", f"{tmp}/tgt", f"{tmp}/ck")
    assert spark.read.parquet(f"{tmp}/tgt").count() == kept


def test_no_silent_empty_reads(spark, tmp, caplog):
    X.write_records(_records(spark, _convs(9)), f"{tmp}/out", _allow(spark), None)
    assert J.scan_jsonl(spark, f"{tmp}/out").count() == 9
    assert J.scan_jsonl(spark, f"{tmp}/out/*.json").count() == 9
    assert J.scan_jsonl(spark, f"{tmp}/o*").count() == 9
    os.makedirs(f"{tmp}/empty")
    with caplog.at_level("WARNING"):
        assert J.scan_jsonl(spark, [f"{tmp}/empty", f"{tmp}/out"]).count() == 9
    assert any("empty" in r.message for r in caplog.records)
    with caplog.at_level("WARNING"):
        assert J.scan_jsonl(spark, f"{tmp}/nothing/*.json").count() == 0
    assert any("not found" in r.message for r in caplog.records)


def test_session_logs_union_content_and_gate(spark, tmp):
    from threadline.operators import filters as FL
    from threadline.sources import logs as LG
    s1 = [
        {"type": "user", "message": {"role": "user", "content": "fix the bug"}},
        {"type": "assistant", "message": {"role": "assistant", "content": [
            {"type": "thinking", "thinking": "hmm"}, {"type": "text", "text": "ok"},
            {"type": "tool_use", "name": "Bash", "input": {"command": "ls"}}]}},
        {"type": "user", "message": {"role": "user", "content": [
            {"type": "tool_result", "content": "a b"}, "not a dict"]}},
        {"type": "assistant", "message": {"role": "assistant", "content": [
            {"type": "tool_use", "name": "Read", "input": {}}, {"type": "tool_use", "name": "Other", "input": {}}]}},
        {"type": "system", "message": {"role": "system", "content": "x"}},
        {"type": "user", "message": {}},
    ]
    s2 = [{"type": "assistant", "message": {"role": "assistant", "content": [
        {"type": "tool_use", "name": "Bash", "input": {}}]}}]
    _write(f"{tmp}/proj/a.jsonl", [json.dumps(x).encode() for x in s1] + [b"{bad", b""])
    _write(f"{tmp}/proj/b.jsonl", [json.dumps(x).encode() for x in s2])
    _write(f"{tmp}/proj/subagents/c.jsonl", [json.dumps(x).encode() for x in s2])
    msgs = LG.scan_session_logs(spark, tmp)
    assert msgs.count() == 4 + 1
    assert "text" not in msgs.schema.simpleString()  # types and names only
    other = tempfile.mkdtemp(prefix="threadline-io-")
    _write(f"{other}/d.jsonl", [b'{"type":"user","message":{"content":"no role"}}'])
    assert LG.scan_session_logs(spark, other).count() == 1
    counts = {r.block_type: r.n_blocks for r in N.block_counts(msgs).collect()}
    assert counts == {"thinking": 1, "text": 1, "tool_use": 4, "tool_result": 1}
    gate = {r.session.rsplit("/", 1)[-1]: r.n_blocks for r in FL.session_block_gate(msgs, 2, key="session").collect()}
    assert gate == {"a.jsonl": 2}
    with_sub = LG.scan_session_logs(spark, tmp, include_subagents=True)
    assert with_sub.count() == 6
    tools = {(r.session.rsplit("/", 1)[-1], r.tool): r.n_calls for r in LG.tool_use_counts(msgs).collect()}
    assert tools == {("a.jsonl", "Bash"): 1, ("a.jsonl", "Read"): 1, ("a.jsonl", "Other"): 1, ("b.jsonl", "Bash"): 1}


def test_write_hybrid_all_formats(spark, tmp):
    from threadline.plans import hybrid as HY
    rows, _ = HY.build_hybrid(turns_frame(spark, _convs(40)).withColumn("source", F.lit("s")), ratio=0.5, seed=42)
    out = HY.write_hybrid(rows, f"{tmp}/hy", _allow(spark), ratio=0.5)
    assert out["total_records"] == out["total_lines"] == 60
    meta = json.loads(open(glob.glob(f"{tmp}/hy/metadata/part-*")[0]).read())
    assert meta["total_conversations"] == 60 and meta["statistics"]["total_conversations"] == 60
    assert meta["formats"] == ["records", "text", "document"]
    doc = json.loads("".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(f"{tmp}/hy/document/part-*"))))
    assert [len(doc[k]) for k in ("train", "valid", "test")] == [48, 6, 6]
    assert J.scan_jsonl(spark, f"{tmp}/hy/combined").count() == 60
    per_split = {r.split: r["count"] for r in spark.read.json(f"{tmp}/hy/text").groupBy("split").count().collect()}
    assert per_split == {"train": 48, "valid": 6, "test": 6}


def test_hybrid_stats_from_written_records_match_flat(spark, tmp):
    from threadline.plans import hybrid as HY
    turns = turns_frame(spark, _convs(40)).withColumn("source", F.lit("s"))
    rows, stats = HY.build_hybrid(turns, ratio=0.5, seed=42, marker="é")
    HY.write_hybrid(rows, f"{tmp}/hy2", _allow(spark), formats=("records",), marker="é")
    recs = spark.read.parquet(f"{tmp}/hy2/records_table")
    assert HY.records_stats(recs, marker="é").collect() == stats.collect()


def test_split_folders_come_back_as_a_column(spark, tmp):
    recs = SP.split_grouped(_records(spark, _convs(30)), "conv_id", 42)
    X.write_records(recs, f"{tmp}/out", _allow(spark), "split")
    back = J.scan_jsonl(spark, f"{tmp}/out")
    got = {int(r.conv_id): r.split for r in back.select("conv_id", "split").collect()}
    assert got == {r.conv_id: r.split for r in recs.select("conv_id", "split").collect()}


def test_session_logs_prefer_session_id(spark, tmp):
    from threadline.operators import filters as FL
    from threadline.sources import logs as LG
    line = {"type": "assistant", "sessionId": "s-1", "message": {"role": "assistant", "content": [
        {"type": "tool_use", "name": "Bash", "input": {}}]}}
    _write(f"{tmp}/a/x.jsonl", [json.dumps(line).encode()])
    _write(f"{tmp}/b/y.jsonl", [json.dumps(line).encode()])  # same session, another file
    gate = FL.session_block_gate(LG.scan_session_logs(spark, tmp), 2).collect()
    assert [(r.session, r.n_blocks) for r in gate] == [("s-1", 2)]


def test_prepare_splits_end_to_end(spark, tmp):
    from threadline.plans import prepare as PR
    lines = [json.dumps({"conv_id": 1000 + i, "source": "s" if i != 3 else "x", "more": {"k": [i]}, **GOOD}).encode()
             for i in range(19)]
    _write(f"{tmp}/data.jsonl", lines[:10] + [b""] + lines[10:])
    for split_bytes in ("512", "134217728"):  # many file splits, and one
        spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
        try:
            sizes = {r.split: r.n_records for r in
                     PR.prepare_splits(spark, f"{tmp}/data.jsonl", f"{tmp}/prep{split_bytes}", _allow(spark)).collect()}
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert sizes == {"train": 14, "valid": 1, "test": 3}  # additive rule: 15 + int(1.9) = 16; one source may not leave
        back = {}
        for p in glob.glob(f"{tmp}/prep{split_bytes}/split=*/part-*"):
            for line in open(p, encoding="utf-8"):
                back[json.loads(line)["conv_id"]] = (p.split("split=")[1].split("/")[0], line.strip().encode())
        assert back == {1000 + i: ("train" if i < 15 else "valid" if i < 16 else "test", lines[i]) for i in range(19) if i != 3}


def test_text_document_key_order_additive(spark, tmp):
    recs = _records(spark, _convs(9))
    sizes = X.write_text_document(recs, f"{tmp}/doc2", _allow(spark), keys=("conv_id", "start"), seed=None, rule="additive")
    doc = json.loads("".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(f"{tmp}/doc2/part-*"))))
    rendered = {r.conv_id: r.text for r in RD.render_text(recs).collect()}
    assert sizes == {"train": 7, "valid": 0, "test": 2}
    assert doc == {"train": [{"text": rendered[c]} for c in range(7)], "valid": [],
                   "test": [{"text": rendered[c]} for c in (7, 8)]}
