"""The reference's test assertions, on curated output with the default parameters.

The built frame looks like agent sessions: user requests, assistant turns with
tool calls (``<tool_call>`` + a JSON name), user turns carrying tool responses,
blank turns, system turns and long same-role streaks.
"""

import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import turns_frame
from threadline.functions import text as T
from threadline.operators import nested as N
from threadline.operators import runs as RU
from threadline.operators import stats as S
from threadline.plans import curate as CU

TOOLS = ["Bash", "Read", "Write", "Edit", "Grep", "Glob", "Other"]


def _sessions(seed=1, n=120):
    rnd = random.Random(seed)
    convs = {}
    for cid in range(n):
        turns = [("system", "setup")] if rnd.random() < 0.3 else []
        for step in range(rnd.randint(1, 40)):
            turns.append(("user", rnd.choice(["fix the tests", "add a flag", "  ", "explain this"])))
            for _ in range(rnd.randint(1, 3)):
                name = rnd.choice(TOOLS)
                call = '<tool_call>\n' + json.dumps({"name": name, "arguments": {"x": step}}) + "\n</tool_call>"
                turns.append(("assistant", call))
                turns.append(("user", f"<tool_response>\nok {step}\n</tool_response>"))
            turns.append(("assistant", "done"))
        convs[cid] = turns
    return convs


@pytest.fixture(scope="module")
def curated(spark):
    return CU.curate(turns_frame(spark, _sessions()), max_turns=30).cache()


def test_enough_records(curated):
    assert curated.count() >= 5


def test_min_turns_and_user_first(curated):
    rows = curated.select(F.size("turns").alias("k"), F.element_at("turns", 1)["role"].alias("r")).collect()
    assert all(r.k >= 3 and r.r == "user" for r in rows)


def test_every_record_has_calls_and_responses(curated):
    t = F.col("turns")
    bad = curated.filter(~F.exists(t, lambda x: (x["role"] == "assistant") & x["text"].contains("<tool_call>"))
                         | ~F.exists(t, lambda x: x["text"].contains("<tool_response>")))
    assert bad.count() == 0


def test_no_blank_turns(curated):
    assert curated.filter(F.exists("turns", lambda x: ~T.is_nonblank(x["text"]))).count() == 0


def test_same_role_runs_at_most_eight(curated):
    assert curated.agg(F.max(RU.record_max_run(F.col("turns")))).first()[0] <= 8


def test_core_tool_names_present(curated):
    flat = N.explode_turns(curated).select("role", "text")
    names = {r.name for r in S.distinct_names(flat).collect()}
    assert len(names & {"Bash", "Read", "Write", "Edit", "Grep", "Glob"}) >= 2


def test_same_output_on_two_runs(spark, curated):
    again = CU.curate(turns_frame(spark, _sessions()).repartition(5), max_turns=30)
    key = lambda df: sorted((r.conv_id, r.start) for r in df.select("conv_id", "start").collect())
    assert key(again) == key(curated)


def test_report_agrees(curated):
    r = S.quality_report(curated, ["Bash", "Read", "Write", "Edit", "Grep", "Glob"], "<tool_call>",
                         "<tool_response>").first()
    assert (r.n_too_short, r.n_wrong_first_role, r.n_without_marker, r.n_without_response, r.n_blank_turns) == (0,) * 5
    assert r.max_same_role_run <= 8 and r.n_core_names >= 2
