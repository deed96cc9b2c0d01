"""Throughput and skew probe on a larger input that Spark derives from a test table.

The conversations table is replicated K times (new conversation ids), and a
third of all turns are folded into ONE conversation (turn numbers kept
unique), the hot-key case the design must survive.  The probe times the
main operators and, with --stages, prints per-stage task time and shuffle
bytes from Spark's event log (written to the scratch folder).

Usage: python tools/scale_probe.py [--sf-dir DIR] [--k 200] [--cores 8] [--stages]
"""

from __future__ import annotations

import argparse
import glob
import io
import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from threadline.operators import runs as RU  # noqa: E402
from threadline.operators import sample as SA  # noqa: E402
from threadline.operators import split as SP  # noqa: E402
from threadline.operators import stats as S  # noqa: E402
from threadline.plans import curate as CU  # noqa: E402
from threadline.session import local_session  # noqa: E402

GATE = dict(marker_a=" the ", marker_b=" and ", min_marked=1)


def stage_summary(event_dir: str) -> list[str]:
    import zstandard

    tasks: dict[int, dict] = {}
    for path in sorted(glob.glob(f"{event_dir}/eventlog_v2_*/events_*")):
        with open(path, "rb") as fh:
            stream = fh if not path.endswith(".zstd") else zstandard.ZstdDecompressor().stream_reader(fh)
            for line in io.TextIOWrapper(stream, encoding="utf-8"):
                e = json.loads(line)
                if e.get("Event") != "SparkListenerTaskEnd":
                    continue
                m = e.get("Task Metrics") or {}
                st = tasks.setdefault(e["Stage ID"], {"ms": 0, "n": 0, "max": 0, "w": 0, "r": 0})
                rt = m.get("Executor Run Time", 0)
                st["ms"] += rt
                st["n"] += 1
                st["max"] = max(st["max"], rt)
                st["w"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                sr = m.get("Shuffle Read Metrics") or {}
                st["r"] += sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0)
    out = [f"total task ms {sum(v['ms'] for v in tasks.values())}"]
    for sid, v in sorted(tasks.items(), key=lambda x: -x[1]["ms"])[:10]:
        out.append(f"stage {sid}: tasks {v['n']} task_ms {v['ms']} max_task_ms {v['max']} "
                   f"shuffle_write_MB {v['w'] / 1e6:.1f} shuffle_read_MB {v['r'] / 1e6:.1f}")
    return out


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("--k", type=int, default=200)
    ap.add_argument("--cores", type=int, default=8)
    ap.add_argument("--stages", action="store_true")
    a = ap.parse_args()
    scratch = tempfile.mkdtemp(prefix="threadline-probe-")
    extra = {}
    if a.stages:
        os.makedirs(f"{scratch}/events")
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{scratch}/events"}
    spark = local_session(a.cores, 8 * a.cores, app="threadline-probe", extra=extra)
    base = spark.read.parquet(f"{a.sf_dir}/conversations.parquet")
    rep = base.select("*", F.explode(F.sequence(F.lit(0), F.lit(a.k - 1))).alias("k"))
    hot = F.col("k") < a.k // 3
    big = rep.select(
        F.when(hot, F.lit(-1).cast("bigint")).otherwise(F.col("conv_id") * 1000 + F.col("k")).alias("conv_id"),
        F.when(hot, F.col("k") * 100000 + F.col("conv_id") * 10 + F.col("turn")).otherwise(F.col("turn")).alias("turn"),
        "role", "text")
    path = f"{scratch}/turns.parquet"
    big.repartition(8 * a.cores).write.parquet(path)
    df = spark.read.parquet(path)
    print(f"rows {df.count()}  hot conversation rows {df.filter('conv_id = -1').count()}")

    def timed(name, build):
        t0 = time.time()
        build().write.format("noop").mode("overwrite").save()
        print(f"{name}: {time.time() - t0:.1f} s", flush=True)

    timed("curate", lambda: CU.curate(df, **GATE))
    timed("max_role_run", lambda: RU.max_role_run(df))
    timed("dataset_stats", lambda: S.dataset_stats(df, marker=" the "))
    timed("split_prefix", lambda: SP.split_prefix(df, "conv_id", seed=42))
    timed("exact_sample", lambda: df.filter(SA.exact_sample(df, "conv_id", 42, ratio=0.5).predicate()))
    spark.stop()
    if a.stages:
        print("\n".join(stage_summary(f"{scratch}/events")))


if __name__ == "__main__":
    main()
