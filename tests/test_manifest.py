"""One parse per line, the manifest of files, counters taken during a write."""

import json

import pytest
from conftest import turns_frame
from pyspark.sql import functions as F

from threadline.operators import nested as N
from threadline.operators import stats as S
from threadline.sinks import export as X
from threadline.sources import jsonl as J
from threadline.sources import manifest as MF


def _line(i, **more):
    return json.dumps({"conv_id": f"c{i}", "conversations": [{"from": "human", "value": f"t{i}"}], **more})


def _put(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(x + "\n" for x in lines), encoding="utf-8")


def test_a_line_is_parsed_once(spark, tmp_path):
    _put(tmp_path / "in", "a.jsonl", [_line(1)])
    plan = J.scan_jsonl(spark, str(tmp_path / "in"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("VariantExpressionEvalUtils.parseJson(concat([, body") == 1


def test_fields_of_a_line(spark, tmp_path):
    lines = [
        _line(1, source="s", n=5, tags=["x", {"b": 1, "a": None}], ok=True, none=None),
        '{"conv_id":7,"start":"3","variant":2,"conversations":[null,1,{"from":"gpt","value":5},{"value":{"k":[1, 2]}},{}]}',
        # what no variant can hold is read as text: repeated keys (the last one counts) and NaN
        '{"conv_id":"a","conv_id":"b","conversations":[{"from":"human","value":"x"}],"k":"v"}',
        '{"conv_id":"n","conversations":[{"from":"human","value":"x"}],"z":NaN}',
    ]
    _put(tmp_path / "in", "a.jsonl", lines)
    got = J.scan_jsonl(spark, str(tmp_path / "in")).orderBy("src_seq").collect()
    assert [(r.conv_id, r.start, r.variant) for r in got] == [("c1", 0, None), ("7", 3, 2), ("b", 0, None), ("n", 0, None)]
    assert got[0].extra == {"source": "s", "n": "5", "tags": '["x",{"a":null,"b":1}]', "ok": "true", "none": None}
    assert [(t.pos, t.text) for t in got[1].turns] == [(3, "5"), (4, '{"k":[1,2]}'), (5, None)]
    assert got[2].extra == {"k": "v"}


@pytest.mark.parametrize("tail", [" x", "] x", ', "s"] x', "}", ',{"a":1}', '"', "\\", "/**/"])
def test_content_after_the_value_is_malformed(spark, tmp_path, tail):
    _put(tmp_path / "in", "a.jsonl", [_line(1) + tail])
    assert [r.outcome for r in J.classify_lines(J.read_lines(spark, str(tmp_path / "in"))).collect()] == ["malformed"]


def _rows(m):
    return {r.src_file.rsplit("/", 1)[1]: (r.n_lines, r.n_nonblank, r.version) for r in m.collect()}


@pytest.mark.parametrize("most", [MF.MAX_PATHS, 0])
def test_manifest_counts_only_what_changed(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(MF, "MAX_PATHS", most)  # 0: folders read whole and joined with the changed names
    src, man = tmp_path / "src", str(tmp_path / "man")
    _put(src / "x y", "a [1].jsonl", [_line(1), "", _line(2)])
    _put(src / "z", "b.jsonl", [_line(3)])
    _put(src / "z", "empty.jsonl", [])
    _put(src / "z", "other.txt", ["no"])
    first = _rows(MF.refresh_manifest(spark, str(src), man))
    assert sorted(first.values()) == [(1, 1, 1), (3, 2, 1)]  # the empty file is left out
    assert _rows(MF.refresh_manifest(spark, str(src), man)) == first
    _put(src / "z", "b.jsonl", [_line(3), _line(4)])
    _put(src / "new", "c.jsonl", [_line(5)])
    m = MF.refresh_manifest(spark, str(src), man)
    assert sorted(_rows(m).values()) == [(1, 1, 3), (2, 2, 3), (3, 2, 1)]
    assert sorted(r.conv_id for r in MF.scan_manifest(spark, m, str(src), "version = 3").collect()) == ["c3", "c4", "c5"]
    assert sorted(r.conv_id for r in MF.scan_manifest(spark, m, str(src)).collect()) == ["c1", "c2", "c3", "c4", "c5"]
    assert MF.scan_manifest(spark, m, str(src), "n_lines > 99").collect() == []


def test_a_manifest_run_that_died_is_not_read(spark, tmp_path):
    src, man = tmp_path / "src", tmp_path / "man"
    _put(src, "a.jsonl", [_line(1)])
    assert MF.read_manifest(spark, str(man)).collect() == []
    MF.refresh_manifest(spark, str(src), str(man))
    (man / "v=2").mkdir()  # no _SUCCESS
    assert len(_rows(MF.read_manifest(spark, str(man)))) == 1
    _put(src, "b.jsonl", [_line(2)])
    assert len(_rows(MF.refresh_manifest(spark, str(src), str(man)))) == 2


def test_counters_of_the_write_equal_the_gate_report(spark, tmp_path):
    convs = {i: [("user" if k % 2 == 0 else "assistant", f"a b {'call' * (i % 2)}") for k in range(1 + i % 5)] for i in range(40)}
    recs = N.assemble(turns_frame(spark, convs)).withColumn("source", F.when(F.col("conv_id") < 30, "s").otherwise("t"))
    allow = spark.createDataFrame([("s", "owned")], "source string, rights string")
    gate = dict(marker_a="call", marker_b="b", min_marked=1)
    got = X.write_gated(recs, str(tmp_path / "out"), allow, None, **gate)
    want = {r.reason: r.n_records for r in S.gate_report(recs.filter("source = 's'"), **gate).collect()}
    assert {k: n for k, n in got.items() if n} == want and sum(got.values()) == 30
    assert J.scan_jsonl(spark, str(tmp_path / "out")).count() == got["accepted"] > 0
    empty = X.write_gated(recs.limit(0), str(tmp_path / "none"), allow, None, **gate)
    assert set(empty.values()) == {0}
    with pytest.raises(ValueError):
        X.write_gated(recs, str(tmp_path / "no"), None, None)
