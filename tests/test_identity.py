"""Records without ids, whole texts of any length, weighted group splits, ingest with rejects."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from threadline.operators import nested as N
from threadline.operators import split as SP
from threadline.operators.positions import input_bytes, range_partitions
from threadline.sinks import export as X
from threadline.sources import jsonl as J
from threadline.streaming import ingest as IG

LINE = '{{"conversations": [{{"from": "human", "value": "q{0}"}}, {{"from": "gpt", "value": "a{0}"}}], "source": "mine"}}'


@pytest.fixture
def allowed(spark):
    return spark.createDataFrame([("mine", "own")], "source string, rights string")


def lines_of(path, pattern="part-*"):
    return [x for f in sorted(path.rglob(pattern)) for x in f.read_text().split("\n") if x.strip()]


def write_lines(folder, sizes, start=0):
    folder.mkdir()
    at = start
    for k, n in enumerate(sizes):
        body = [LINE.format(at + i) for i in range(n)]
        (folder / f"f{k:03d}.jsonl").write_text("\n".join(["", "junk", *body, '{"note": 1}']) + "\n")
        at += n
    return at


@pytest.mark.parametrize("split_bytes", ["128m", "500b"])
def test_numbers_follow_file_order_on_any_split_size(spark, tmp_path, split_bytes):
    n = write_lines(tmp_path / "in", [0, 3, 40, 1, 25, 0, 31])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        recs, total = J.number_records(J.scan_jsonl(spark, str(tmp_path / "in")), with_total=True)
        got = {r.rec_id: r.t for r in recs.select("rec_id", F.col("turns")[0]["text"].alias("t")).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert total == n and got == {k: f"q{k}" for k in range(n)}


def test_numbering_moves_no_record(spark, tmp_path):
    write_lines(tmp_path / "in", [5, 6])
    recs = J.number_records(J.scan_jsonl(spark, str(tmp_path / "in")))
    plan = recs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan and "rangepartitioning" not in plan


def test_numbering_adds_little_to_the_estimated_input(spark, tmp_path):
    write_lines(tmp_path / "in", [3000, 3000])
    size = sum(f.stat().st_size for f in (tmp_path / "in").iterdir())
    recs = J.with_record_ids(J.scan_jsonl(spark, str(tmp_path / "in")))
    assert size <= input_bytes(recs) <= size + 10_000  # two file splits, not files times splits
    assert range_partitions(recs) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_range_partitions_of_a_checkpointed_join(spark):
    ids = spark.range(100_000)
    both = ids.join(ids.withColumn("x", F.col("id") + 1), "id").checkpoint()
    assert 100_000 <= input_bytes(both) <= 100 * 100_000
    assert range_partitions(both) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_numbers_of_nothing(spark, tmp_path):
    write_lines(tmp_path / "in", [0])
    recs, total = J.number_records(J.scan_jsonl(spark, str(tmp_path / "in")), with_total=True)
    assert total == 0 and recs.collect() == []


def test_lines_without_ids_split_and_document(spark, tmp_path, allowed):
    write_lines(tmp_path / "in", [4, 6])
    recs = J.with_record_ids(J.scan_jsonl(spark, str(tmp_path / "in"))).withColumn("source", F.col("extra")["source"])
    assert Counter(r.split for r in SP.split_prefix(recs, "conv_id").collect()) == {"train": 8, "valid": 1, "test": 1}
    X.write_text_document(recs, str(tmp_path / "doc"), allowed, keys=("conv_id", "start"), seed=None)
    doc = json.loads("".join(f.read_text() for f in sorted((tmp_path / "doc").glob("part-*"))))
    assert [x["text"] for s in ("train", "valid", "test") for x in doc[s]] == [f"User: q{k}\n\nAssistant: a{k}" for k in range(10)]
    assert len(doc["train"]) == 8


def test_ids_are_kept_unless_all_are_numbered(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text('{"conv_id": "x", "conversations": [{"from": "human", "value": "1"}]}\n' + LINE.format(1) + "\n")
    recs = J.scan_jsonl(spark, str(tmp_path / "in"))
    assert sorted(r.conv_id for r in J.with_record_ids(recs).collect()) == ["line-000000000000001", "x"]
    assert sorted(r.conv_id for r in J.with_record_ids(recs, always=True).collect()) == ["line-000000000000000", "line-000000000000001"]


@pytest.mark.parametrize("ids", [[None, None, None], ["a", "a", "b"], ["a", "b", "b"]])
def test_document_refuses_shared_keys(spark, tmp_path, allowed, ids):
    turns = "array<struct<pos:bigint,turn:bigint,role:string,text:string>>"
    recs = spark.createDataFrame([(i, 0, "mine", [(0, 0, "user", str(k))], "train") for k, i in enumerate(ids)],
                                 f"conv_id string, start bigint, source string, turns {turns}, split string")
    with pytest.raises(ValueError, match="share a key"):
        X.write_text_document(recs, str(tmp_path / "doc"), allowed, seed=None)


def test_whole_texts_of_any_length(spark, tmp_path, allowed):
    roles = ["user", "assistant", "system"]
    rows = [(1, t, roles[t % 2], f'line {t} "q" \\ é\n end ') for t in range(3000)]
    rows += [(2, t, roles[t % 3], None if t == 4 else f" {t} ") for t in range(9)]
    rows += [(3, 0, "system", "only"), (3, 1, "system", "these"), (4, 0, "system", "s"), (4, 1, "user", ""), (5, 0, "user", "one")]
    conv = spark.createDataFrame([(c, t, r, x, "mine") for c, t, r, x in rows], "conv_id long, turn long, role string, text string, source string")
    recs = N.assemble(conv.repartition(7), keys=["conv_id", "source"], max_turns=2).withColumn("split", F.when(F.col("conv_id") < 3, "train").otherwise("test"))
    X.write_whole_texts(recs, str(tmp_path / "out"), allowed)
    want = Counter()
    for c in (1, 2, 3, 4, 5):
        parts = [{"user": "User", "assistant": "Assistant"}[r] + ": " + (x or "") for k, _, r, x in rows if k == c and r != "system"]
        want["train" if c < 3 else "test", "\n\n".join(parts)] += 1
    got = Counter((f.parent.name[6:], json.loads(x)["text"]) for f in (tmp_path / "out").rglob("part-*") for x in f.read_text().split("\n") if x.strip())
    assert got == want


def test_whole_texts_of_nothing(spark, tmp_path, allowed):
    empty = spark.createDataFrame([], "conv_id long, start bigint, source string, turns array<struct<pos:bigint,turn:bigint,role:string,text:string>>")
    X.write_whole_texts(empty, str(tmp_path / "out"), allowed)
    assert lines_of(tmp_path / "out") == []


def test_weighted_split_with_a_heavy_group(spark):
    rows = [("heavy",)] * 300 + [(f"g{k % 100}",) for k in range(700)]
    df = spark.createDataFrame(rows, "conv_id string").repartition(4)
    for seed in range(6):
        got = SP.split_grouped_weighted(df, "conv_id", seed).groupBy("conv_id", "split").count().collect()
        assert len({r.conv_id for r in got}) == len(got) == 101  # no group in two splits
        size = Counter()
        for r in got:
            size[r.split] += r["count"]
        heavy = next(r.split for r in got if r.conv_id == "heavy")
        if heavy == "train":
            assert abs(size["train"] - 800) <= 150 and abs(size["valid"] - 100) <= 150
        ideal = {"train": 800, "valid": 100, "test": 100}
        for name in ideal:  # half a group at either end
            assert abs(size[name] - ideal[name]) <= (300 if name == heavy else 150) + 7


def test_weighted_split_of_few_groups(spark):
    one = spark.createDataFrame([("a",)] * 5, "conv_id string")
    assert {r.split for r in SP.split_grouped_weighted(one, "conv_id", 1).collect()} == {"train"}
    none = spark.createDataFrame([], "conv_id string")
    assert SP.split_grouped_weighted(none, "conv_id", 1).collect() == []


def test_ingest_keeps_fields_and_rejects(spark, tmp_path, allowed):
    src, target, rejects = (str(tmp_path / x) for x in ("in", "table", "rejects"))
    n = write_lines(tmp_path / "in", [3, 4])
    for _ in range(2):
        IG.ingest_incremental(spark, src, target, str(tmp_path / "ckpt"), rejects_dir=rejects)
    kept = X.allowed_only(IG.read_ingested(spark, target), allowed)
    assert kept.count() == n and kept.select("extra").first()[0] == {"source": "mine"}
    (tmp_path / "in" / "late.jsonl").write_text("{broken\n" + LINE.format(99) + "\n")
    IG.ingest_incremental(spark, src, target, str(tmp_path / "ckpt"), rejects_dir=rejects)
    assert IG.read_ingested(spark, target).count() == n + 1
    lost = Counter((r.line, r.reason) for r in spark.read.parquet(rejects).collect())
    assert lost == {("junk", "malformed"): 2, ('{"note": 1}', "no_records"): 2, ("{broken", "malformed"): 1}
