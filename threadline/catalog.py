"""Registered queries over the test tables, each with its DuckDB oracle SQL.

Every query reads whole tables (no id subsets, no row caps) and returns a
DataFrame; ``ORACLE`` holds the equivalent SQL with the same column names.
Queries whose output is not SQL-expressible have no oracle entry.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadline.functions import roles as R
from threadline.functions import text as T
from threadline.operators import augment as A
from threadline.operators import chunk as C
from threadline.operators import dedup as D
from threadline.operators import filters as FL
from threadline.operators import nested as N
from threadline.operators import render as RD
from threadline.operators import runs as RU
from threadline.operators import sample as SA
from threadline.operators import split as SP
from threadline.operators import stats as S
from threadline.operators.positions import turn_positions
from threadline.plans import curate as CU
from threadline.plans import hybrid as HY
from threadline.plans import prepare as PR
from threadline.session import scratch_path
from threadline.sinks import export as X
from threadline.sources import jsonl as J
from threadline.sources import logs as LG
from threadline.sources import manifest as MF
from threadline.sources import tables as TB
from threadline.streaming import ingest as IG

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# Parameters of the registered queries.  The test conversations have 2-8
# turns and no tool markers, so windows are short and the markers are common
# words; defaults are exercised by the unit tests on built frames.
WINDOW_TURNS = 4
MARKER_A = " the "
MARKER_B = " and "
MIN_MARKED = 1
GATE = dict(marker_a=MARKER_A, marker_b=MARKER_B, min_marked=MIN_MARKED)

WSC = T.WHITESPACE_CLASS

# -- shared SQL fragments -----------------------------------------------------
SQL_CLEAN = f"""
SELECT conv_id, turn, role, text FROM conversations
WHERE role IN ('user', 'assistant') AND regexp_matches(text, '[^{WSC}]')"""

SQL_POS = f"""
SELECT conv_id, turn, role, text,
       row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos,
       count(*) OVER (PARTITION BY conv_id) AS n
FROM ({SQL_CLEAN})"""


def sql_windows(L: int = WINDOW_TURNS, tail: int = C.DEFAULT_TAIL, stride: int | None = None) -> str:
    s = stride or L // 2
    return f"""
p AS ({SQL_POS}),
sz AS (SELECT DISTINCT conv_id, n FROM p),
st AS (SELECT conv_id, unnest(range(0, greatest(1, n - {tail}), {s})) AS start FROM sz),
m AS (SELECT st.conv_id, st.start, p.pos - st.start AS idx, p.pos, p.turn, p.role, p.text
      FROM st JOIN p ON p.conv_id = st.conv_id AND p.pos >= st.start AND p.pos < st.start + {L})"""


SQL_GATE_HAVING = f"""
HAVING count(*) >= 3
   AND count(*) FILTER (WHERE role = 'assistant' AND contains(text, '{MARKER_A}')) >= {MIN_MARKED}
   AND count(*) FILTER (WHERE contains(text, '{MARKER_B}')) >= 1
   AND arg_min(role, pos) = 'user'"""


def _conv(spark: SparkSession, d: str) -> DataFrame:
    return TB.conversations(spark, d)


def _windows(spark: SparkSession, d: str) -> DataFrame:
    return C.chunk_overlap(CU.clean_turns(_conv(spark, d)), WINDOW_TURNS)


N_SOURCES = 3


def _sourced(spark: SparkSession, d: str) -> DataFrame:
    """Conversations with the source each belongs to (sinks check it against an allow-list)."""
    return _conv(spark, d).withColumn("source", F.concat(F.lit("src"), F.pmod(F.col("conv_id"), F.lit(N_SOURCES)).cast("string")))


def _allowed(spark: SparkSession, d: str, n: int = N_SOURCES) -> DataFrame:
    """The allow-list: the first ``n`` sources that occur in the conversations."""
    return (_sourced(spark, d).select("source").distinct()
            .filter(F.col("source").isin([f"src{k}" for k in range(n)])).withColumn("rights", F.lit("owned")))


def _records(spark: SparkSession, d: str, **kw) -> DataFrame:
    return N.assemble(_sourced(spark, d), keys=["conv_id", "source"], **kw)


def _flat(records: DataFrame) -> DataFrame:
    """Records read back -> (conv_id, idx, role, text)."""
    return (J.flatten_records(records, ["conv_id"])
            .select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("pos").alias("idx"), "role", "text"))


# -- 2.2 filters --------------------------------------------------------------

@query("filter_roles", """
SELECT conv_id, turn, role, text FROM conversations WHERE role IN ('user', 'assistant')""")
def q_filter_roles(spark, d):
    return FL.filter_roles(_conv(spark, d)).select("conv_id", "turn", "role", "text")


@query("drop_empty", """
SELECT conv_id, turn, role FROM conversations WHERE length(text) > 0""")
def q_drop_empty(spark, d):
    return FL.drop_empty(_conv(spark, d)).select("conv_id", "turn", "role")


@query("nonblank_turns", f"""
SELECT conv_id, turn, role FROM conversations WHERE regexp_matches(text, '[^{WSC}]')""")
def q_nonblank_turns(spark, d):
    return FL.nonblank_turns(_conv(spark, d)).select("conv_id", "turn", "role")


# -- 2.3 nested / windows -----------------------------------------------------

@query("chunk_overlap", f"""
WITH {sql_windows()}
SELECT conv_id, start, idx, pos, turn, role FROM m""")
def q_chunk_overlap(spark, d):
    return N.explode_turns(_windows(spark, d)).select("conv_id", "start", "idx", "pos", "turn", "role")


@query("quality_gate", f"""
WITH {sql_windows()}
SELECT conv_id, start, count(*) AS n_turns FROM m GROUP BY conv_id, start
{SQL_GATE_HAVING}""")
def q_quality_gate(spark, d):
    return (FL.quality_gate(_windows(spark, d), **GATE)
            .select("conv_id", "start", F.size("turns").cast("bigint").alias("n_turns")))


# -- 2.6 dedup ----------------------------------------------------------------

@query("dedup_prefix", f"""
WITH {sql_windows()},
f AS (SELECT conv_id, start, substr(arg_min(text, pos), 1, 200) AS k FROM m GROUP BY conv_id, start)
SELECT conv_id, start FROM (
  SELECT conv_id, start, row_number() OVER (PARTITION BY k ORDER BY conv_id, start) AS rn FROM f)
WHERE rn = 1""")
def q_dedup_prefix(spark, d):
    return D.dedup_prefix(_windows(spark, d)).select("conv_id", "start")


@query("curate_windows", f"""
WITH {sql_windows()},
g AS (SELECT conv_id, start, count(*) AS n_turns, substr(arg_min(text, pos), 1, 200) AS k
      FROM m GROUP BY conv_id, start {SQL_GATE_HAVING})
SELECT conv_id, start, n_turns FROM (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY conv_id, start) AS rn FROM g)
WHERE rn = 1""")
def q_curate_windows(spark, d):
    recs = CU.curate(_conv(spark, d), max_turns=WINDOW_TURNS, **GATE)
    return recs.select("conv_id", "start", F.size("turns").cast("bigint").alias("n_turns"))


# -- 2.5 aggregations ----------------------------------------------------------

SQL_STATS_TAIL = """
SELECT count(*) AS total_conversations,
       CAST(coalesce(sum(n_turns), 0) AS BIGINT) AS total_turns,
       CASE WHEN count(*) > 0 THEN CAST(sum(n_turns) AS BIGINT) / count(*) ELSE 0.0 END AS avg_turns_per_conv,
       CAST(coalesce(sum(n_tokens), 0) AS BIGINT) AS total_tokens,
       count(*) FILTER (WHERE has_marker) AS conversations_with_marker,
       CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE has_marker) / count(*) * 100 ELSE 0.0 END
         AS marker_percentage
FROM per"""


@query("dataset_stats", f"""
WITH per AS (
  SELECT conv_id, count(*) AS n_turns,
         sum(len(regexp_extract_all(text, '[^{WSC}]+'))) AS n_tokens,
         bool_or(contains(text, '{MARKER_A}')) AS has_marker
  FROM conversations GROUP BY conv_id)
{SQL_STATS_TAIL}""")
def q_dataset_stats(spark, d):
    return S.dataset_stats(_conv(spark, d), marker=MARKER_A)


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Curate the conversations and report statistics of the kept windows."""
    recs = CU.curate(_conv(spark, d), max_turns=WINDOW_TURNS, **GATE)
    return S.record_stats(recs, marker=MARKER_A)


@query("curate_stats", f"""
WITH {sql_windows()},
g AS (SELECT conv_id, start, count(*) AS n_turns, substr(arg_min(text, pos), 1, 200) AS k
      FROM m GROUP BY conv_id, start {SQL_GATE_HAVING}),
kept AS (SELECT conv_id, start, n_turns FROM (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY conv_id, start) AS rn FROM g) WHERE rn = 1),
per AS (
  SELECT m.conv_id, m.start, count(*) AS n_turns,
         sum(len(regexp_extract_all(text, '[^{WSC}]+'))) AS n_tokens,
         bool_or(contains(text, '{MARKER_A}')) AS has_marker
  FROM m JOIN kept USING (conv_id, start) GROUP BY m.conv_id, m.start)
{SQL_STATS_TAIL}""")
def q_curate_stats(spark, d):
    return flagship(spark, d)


# -- more filters ---------------------------------------------------------------

SEED = 42
EVENT_TYPES = ("click", "purchase")
MIN_EVENTS = 8
FIRST_N = 20
# capitalised ASCII words after a space or at the start of a turn
NAME_PATTERN = r"(?:^|[ ])([A-Z][a-z]+)"
EXPECTED_NAMES = ("The", "Les", "Die", "Los", "Und", "Bash", "Read", "Write")
DECIMAL_PATTERN = r"([0-9]+\.[0-9]+)"

SQL_POS_ALL = """
SELECT conv_id, turn, role, text,
       row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos,
       count(*) OVER (PARTITION BY conv_id) AS n
FROM conversations"""


def _pos_all(spark, d, cols=("conv_id", "turn", "role", "text")):
    return turn_positions(_conv(spark, d).select(*cols), "conv_id", "turn")


@query("map_roles", """
SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'user' ELSE 'assistant' END AS role FROM conversations""")
def q_map_roles(spark, d):
    c = _conv(spark, d)
    return c.select("conv_id", "turn", R.map_role_else("role", {R.USER: R.USER}, R.ASSISTANT).alias("role"))


@query("valid_structure", """
SELECT conv_id, count(*) AS n_turns FROM conversations GROUP BY conv_id HAVING count(*) >= 2""")
def q_valid_structure(spark, d):
    return FL.valid_structure(_conv(spark, d), min_turns=2)


@query("role_set_check", """
SELECT conv_id,
       count(*) FILTER (WHERE role IS NULL OR role NOT IN ('user', 'assistant')) AS n_other_roles,
       bool_or(coalesce(role = 'user', false)) AS has_user,
       bool_or(coalesce(role = 'assistant', false)) AS has_assistant,
       count(*) FILTER (WHERE role IS NULL OR role NOT IN ('user', 'assistant')) = 0
         AND bool_or(coalesce(role = 'user', false)) AND bool_or(coalesce(role = 'assistant', false)) AS roles_ok
FROM conversations GROUP BY conv_id""")
def q_role_set_check(spark, d):
    return FL.role_set_check(_conv(spark, d))


@query("min_event_gate", f"""
SELECT user_id, count(*) FILTER (WHERE event_type IN {EVENT_TYPES}) AS n_matching
FROM events GROUP BY user_id HAVING count(*) FILTER (WHERE event_type IN {EVENT_TYPES}) >= {MIN_EVENTS}""")
def q_min_event_gate(spark, d):
    return FL.min_event_gate(TB.table(spark, d, "events"), EVENT_TYPES, MIN_EVENTS)


@query("first_n", f"""
SELECT conv_id, turn, role FROM conversations ORDER BY conv_id, turn LIMIT {FIRST_N}""")
def q_first_n(spark, d):
    return FL.first_n(_conv(spark, d).select("conv_id", "turn", "role"), FIRST_N, ["conv_id", "turn"])


# -- nested -------------------------------------------------------------------------

@query("assemble", """
SELECT conv_id, CAST(0 AS BIGINT) AS start, count(*) AS n_turns,
       string_agg(CAST(turn AS VARCHAR), ',' ORDER BY turn) AS turn_list
FROM conversations GROUP BY conv_id""")
def q_assemble(spark, d):
    recs = N.assemble(_conv(spark, d))
    return recs.select("conv_id", "start", F.size("turns").cast("bigint").alias("n_turns"),
                       F.array_join(F.transform("turns", lambda t: t["turn"].cast("string")), ",").alias("turn_list"))


@query("explode_turns", """
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS idx, turn, role
FROM conversations""")
def q_explode_turns(spark, d):
    return N.explode_turns(N.assemble(_conv(spark, d))).select("conv_id", "idx", "turn", "role")


@query("to_messages", """
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS idx,
       CASE WHEN role = 'user' THEN 'user' ELSE 'assistant' END AS role, text AS content
FROM conversations""")
def q_to_messages(spark, d):
    recs = N.to_messages(N.assemble(_conv(spark, d)))
    return (recs.select("conv_id", F.posexplode("messages").alias("idx", "m"))
            .select("conv_id", F.col("idx").cast("bigint").alias("idx"), "m.role", "m.content"))


@query("render_text", """
SELECT conv_id, CAST(0 AS BIGINT) AS start,
       coalesce(string_agg(CASE role WHEN 'user' THEN 'User' ELSE 'Assistant' END || ': ' || coalesce(text, ''),
                           chr(10) || chr(10) ORDER BY turn) FILTER (WHERE role IN ('user', 'assistant')), '')
         AS text
FROM conversations GROUP BY conv_id""")
def q_render_text(spark, d):
    return RD.render_text(N.assemble(_conv(spark, d))).select("conv_id", "start", "text")


# -- record transforms (flat, positioned) -----------------------------------------------

@query("aug_reverse", f"""
WITH p AS ({SQL_POS_ALL})
SELECT conv_id, turn, role,
       CASE WHEN n >= 4 AND pos >= 2 AND pos <= n - 2 THEN n - pos ELSE pos END AS pos
FROM p""")
def q_aug_reverse(spark, d):
    return A.aug_reverse(_pos_all(spark, d, ("conv_id", "turn", "role"))).select("conv_id", "turn", "role", "pos")


@query("aug_shorten", f"""
WITH p AS ({SQL_POS_ALL})
SELECT conv_id, turn, role, CASE WHEN n >= 6 AND pos >= 2 THEN pos - (n - 4) ELSE pos END AS pos
FROM p WHERE n < 6 OR pos < 2 OR pos >= n - 2""")
def q_aug_shorten(spark, d):
    return A.aug_shorten(_pos_all(spark, d, ("conv_id", "turn", "role"))).select("conv_id", "turn", "role", "pos")


def sql_prefix(seed=SEED) -> str:
    pref = ", ".join("'" + p + "'" for p in A.PARAPHRASE_PREFIXES)
    return f"""
CASE WHEN role = 'user'
      AND CAST('0x' || substr(md5('{seed}:prefix:' || conv_id || ':' || pos), 1, 8) AS BIGINT) % 2 = 1
     THEN [{pref}][CAST('0x' || substr(md5('{seed}:prefix:' || conv_id || ':' || pos), 9, 8) AS BIGINT) % 4 + 1]
          || text
     ELSE text END"""


@query("aug_prefix", f"""
WITH p AS ({SQL_POS_ALL})
SELECT conv_id, turn, role, {sql_prefix()} AS text FROM p""")
def q_aug_prefix(spark, d):
    return A.aug_prefix(_pos_all(spark, d), "conv_id", SEED).select("conv_id", "turn", "role", "text")


SQL_SAMPLE = f"""
sr AS (SELECT conv_id, row_number() OVER (ORDER BY md5('{SEED}:' || conv_id), conv_id) - 1 AS gpos,
              count(*) OVER () AS nrec
       FROM (SELECT DISTINCT conv_id FROM conversations)),
sel AS (SELECT conv_id FROM sr WHERE gpos < least(CAST(floor(nrec * 0.5) AS BIGINT), nrec))"""

SQL_KIND = f"""['reverse', 'shorten', 'paraphrase'][
  CAST('0x' || substr(md5('{SEED}:kind:' || conv_id), 1, 8) AS BIGINT) % 3 + 1]"""

SQL_AUG = f"""
p AS ({SQL_POS_ALL}),
{SQL_SAMPLE},
ak AS (SELECT p.*, {SQL_KIND} AS aug_type FROM p JOIN sel USING (conv_id)),
aug AS (
  SELECT conv_id, turn, role, aug_type,
         CASE aug_type WHEN 'paraphrase' THEN ({sql_prefix()}) ELSE text END AS text,
         CASE aug_type WHEN 'reverse' THEN CASE WHEN n >= 4 AND pos >= 2 AND pos <= n - 2 THEN n - pos ELSE pos END
                       WHEN 'shorten' THEN CASE WHEN n >= 6 AND pos >= 2 THEN pos - (n - 4) ELSE pos END
                       ELSE pos END AS pos
  FROM ak WHERE aug_type <> 'shorten' OR n < 6 OR pos < 2 OR pos >= n - 2)"""


@query("sample_exact", f"""
WITH {SQL_SAMPLE}
SELECT conv_id FROM sel""")
def q_sample_exact(spark, d):
    c = _conv(spark, d)
    smp = SA.exact_sample(c, "conv_id", SEED, ratio=0.5)
    return c.filter(smp.predicate()).select("conv_id").distinct()


@query("augment_mixed", f"""
WITH {SQL_AUG}
SELECT conv_id, aug_type, pos, turn, role, text FROM aug""")
def q_augment_mixed(spark, d):
    h = A.hybrid(_conv(spark, d), "conv_id", "turn", 0.5, SEED)
    return h.filter(F.col("variant") == 1).select("conv_id", "aug_type", "pos", "turn", "role", "text")


@query("hybrid_union", f"""
WITH {SQL_AUG}
SELECT conv_id, 0 AS variant, pos, turn, role, text FROM p
UNION ALL
SELECT conv_id, 1 AS variant, pos, turn, role, text FROM aug""")
def q_hybrid_union(spark, d):
    h = A.hybrid(_conv(spark, d), "conv_id", "turn", 0.5, SEED)
    return h.select("conv_id", "variant", "pos", "turn", "role", "text")


# -- splits --------------------------------------------------------------------------

def sql_split(order: str, rule: str = "cumulative") -> str:
    valid_end = ("floor(nrec * (0.8::DOUBLE + 0.1::DOUBLE))" if rule == "cumulative"
                 else "floor(nrec * 0.8::DOUBLE) + floor(nrec * 0.1::DOUBLE)")
    return f"""
WITH r AS (SELECT conv_id, row_number() OVER (ORDER BY {order}) - 1 AS gpos, count(*) OVER () AS nrec
           FROM (SELECT DISTINCT conv_id FROM conversations))
SELECT conv_id, CASE WHEN gpos < floor(nrec * 0.8::DOUBLE) THEN 'train'
                     WHEN gpos < {valid_end} THEN 'valid' ELSE 'test' END AS split
FROM r"""


def _split_records(spark, d, seed, rule):
    recs = _conv(spark, d).select("conv_id").distinct()
    return SP.split_prefix(recs, "conv_id", seed=seed, rule=rule).select("conv_id", "split")


@query("split_prefix", sql_split(f"md5('{SEED}:' || conv_id), conv_id"))
def q_split_prefix(spark, d):
    return _split_records(spark, d, SEED, "cumulative")


@query("split_prefix_v2", sql_split("conv_id", "additive"))
def q_split_prefix_v2(spark, d):
    return _split_records(spark, d, None, "additive")


@query("split_grouped", f"""
SELECT DISTINCT conv_id,
       CASE WHEN CAST('0x' || substr(md5('{SEED}:' || conv_id), 1, 8) AS BIGINT) % 1000 < 800 THEN 'train'
            WHEN CAST('0x' || substr(md5('{SEED}:' || conv_id), 1, 8) AS BIGINT) % 1000 < 900 THEN 'valid'
            ELSE 'test' END AS split
FROM conversations""")
def q_split_grouped(spark, d):
    return SP.split_grouped(_conv(spark, d).select("conv_id").distinct(), "conv_id", SEED)


@query("split_sizes", f"""
WITH s AS ({sql_split(f"md5('{SEED}:' || conv_id), conv_id")})
SELECT split, count(*) AS n_records, count(*) / sum(count(*)) OVER () * 100 AS share_pct
FROM s GROUP BY split""")
def q_split_sizes(spark, d):
    return S.split_sizes(_split_records(spark, d, SEED, "cumulative"))


# -- runs, names, reports --------------------------------------------------------------

@query("max_role_run", """
WITH p AS (SELECT conv_id, role,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn)
                  - row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS island
           FROM conversations),
r AS (SELECT conv_id, role, island, count(*) AS run_len FROM p GROUP BY conv_id, role, island)
SELECT conv_id, max(run_len) AS max_run FROM r GROUP BY conv_id""")
def q_max_role_run(spark, d):
    return RU.max_role_run(_conv(spark, d))


@query("distinct_names", f"""
SELECT DISTINCT unnest(regexp_extract_all(text, '{NAME_PATTERN}', 1)) AS name
FROM conversations WHERE role = 'assistant'""")
def q_distinct_names(spark, d):
    return S.distinct_names(_conv(spark, d), NAME_PATTERN, R.ASSISTANT)


@query("core_name_overlap", f"""
SELECT DISTINCT name FROM (
  SELECT unnest(regexp_extract_all(text, '{NAME_PATTERN}', 1)) AS name
  FROM conversations WHERE role = 'assistant')
WHERE name IN {EXPECTED_NAMES}""")
def q_core_name_overlap(spark, d):
    return S.name_overlap(S.distinct_names(_conv(spark, d), NAME_PATTERN, R.ASSISTANT), EXPECTED_NAMES)


@query("gate_report", f"""
WITH {sql_windows()},
g AS (SELECT conv_id, start, count(*) AS c,
             count(*) FILTER (WHERE role = 'assistant' AND contains(text, '{MARKER_A}')) AS a,
             count(*) FILTER (WHERE contains(text, '{MARKER_B}')) AS b,
             arg_min(role, pos) AS fr
      FROM m GROUP BY conv_id, start)
SELECT CASE WHEN c < 3 THEN 'too_short' WHEN a < {MIN_MARKED} THEN 'few_marked'
            WHEN b < 1 THEN 'no_response' WHEN fr <> 'user' THEN 'wrong_first_role'
            ELSE 'accepted' END AS reason,
       count(*) AS n_records
FROM g GROUP BY 1""")
def q_gate_report(spark, d):
    return S.gate_report(_windows(spark, d), **GATE)


# -- scalar functions -------------------------------------------------------------------

@query("truncate_long", """
SELECT doc_id, CASE WHEN length(text) > 3000 THEN substr(text, 1, 2500) || chr(10) || '...[truncated]...'
                    ELSE text END AS text
FROM documents""")
def q_truncate_long(spark, d):
    return TB.table(spark, d, "documents").select("doc_id", T.truncate_long("text").alias("text"))


@query("token_counts", f"""
SELECT doc_id, CAST(coalesce(len(regexp_extract_all(text, '[^{WSC}]+')), 0) AS BIGINT) AS n_tokens
FROM documents""")
def q_token_counts(spark, d):
    return TB.table(spark, d, "documents").select("doc_id", T.token_count("text").alias("n_tokens"))


@query("extract_numbers", f"""
SELECT doc_id, CAST(idx - 1 AS BIGINT) AS idx, CAST(v AS DOUBLE) AS value
FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{DECIMAL_PATTERN}', 1)) AS v,
             generate_subscripts(regexp_extract_all(text, '{DECIMAL_PATTERN}', 1), 1) AS idx
      FROM documents)""")
def q_extract_numbers(spark, d):
    docs = TB.table(spark, d, "documents")
    return (docs.select("doc_id", F.posexplode(T.extract_all("text", DECIMAL_PATTERN, 1)).alias("idx", "v"))
            .select("doc_id", F.col("idx").cast("bigint").alias("idx"), F.col("v").cast("double").alias("value")))


def _event_text():
    return F.concat(F.col("event_type"), F.lit(" -> "), F.col("props"))


SQL_EVENT_TEXT = "event_type || ' -> ' || props"


@query("embedded_json", f"""
WITH e AS (SELECT event_id, {SQL_EVENT_TEXT} AS x FROM events),
s AS (SELECT event_id, x,
             CASE WHEN instr(x, '[') > 0 AND length(x) - instr(reverse(x), ']') + 1 > instr(x, '[')
                       AND instr(reverse(x), ']') > 0
                  THEN substr(x, instr(x, '['), length(x) - instr(reverse(x), ']') + 1 - instr(x, '[') + 1) END AS arr,
             CASE WHEN instr(x, '{{') > 0 AND length(x) - instr(reverse(x), '}}') + 1 > instr(x, '{{')
                       AND instr(reverse(x), '}}') > 0
                  THEN substr(x, instr(x, '{{'), length(x) - instr(reverse(x), '}}') + 1 - instr(x, '{{') + 1) END AS obj
      FROM e)
SELECT event_id,
       CASE WHEN json_valid(x) THEN x WHEN json_valid(arr) THEN arr WHEN json_valid(obj) THEN obj END AS json_text,
       CASE WHEN json_valid(x) THEN 'whole' WHEN json_valid(arr) THEN 'array' WHEN json_valid(obj) THEN 'object' END
         AS kind
FROM s""")
def q_embedded_json(spark, d):
    ev = TB.table(spark, d, "events")
    m = ev.select("event_id", T.embedded_json_match(_event_text()).alias("m"))
    return m.select("event_id", F.col("m.json").alias("json_text"), F.col("m.kind").alias("kind"))


@query("trim_ws", f"""
SELECT conv_id, turn, regexp_replace(text, '^[{WSC}]+|[{WSC}]+$', '', 'g') AS text FROM conversations""")
def q_trim_ws(spark, d):
    return _conv(spark, d).select("conv_id", "turn", T.trim_ws("text").alias("text"))


# -- hybrid dataset -----------------------------------------------------------------------


SQL_HYBRID_ROWS = f"""
{SQL_AUG},
hy AS (SELECT conv_id, 0 AS variant, pos, turn, role, text FROM p
       UNION ALL SELECT conv_id, 1 AS variant, pos, turn, role, text FROM aug),
hr AS (SELECT conv_id, variant, row_number() OVER (ORDER BY md5('{SEED}:' || conv_id || ':' || variant), conv_id, variant) - 1 AS gpos,
              count(*) OVER () AS nrec
       FROM (SELECT DISTINCT conv_id, variant FROM hy)),
hs AS (SELECT conv_id, variant,
              CASE WHEN gpos < floor(nrec * 0.8::DOUBLE) THEN 'train'
                   WHEN gpos < floor(nrec * (0.8::DOUBLE + 0.1::DOUBLE)) THEN 'valid' ELSE 'test' END AS split
       FROM hr)"""


@query("hybrid_split", f"""
WITH {SQL_HYBRID_ROWS}
SELECT conv_id, variant, split FROM hs""")
def q_hybrid_split(spark, d):
    return HY.hybrid_splits(_conv(spark, d), ratio=0.5, seed=SEED)


@query("hybrid_stats", f"""
WITH {SQL_HYBRID_ROWS},
per AS (SELECT conv_id, variant, count(*) AS n_turns,
               sum(len(regexp_extract_all(text, '[^{WSC}]+'))) AS n_tokens,
               bool_or(contains(text, '{MARKER_A}')) AS has_marker
        FROM hy GROUP BY conv_id, variant)
{SQL_STATS_TAIL}""")
def q_hybrid_stats(spark, d):
    _, stats = HY.build_hybrid(_conv(spark, d), ratio=0.5, seed=SEED, marker=MARKER_A, with_split=False)
    return stats


# -- sources and sinks (Spark-written JSONL derived from the tables) ----------------------

SQL_FLAT_IDX = """
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS idx, role, text
FROM conversations"""


def _write_conversation_jsonl(spark, d, root: str) -> None:
    """Interchange JSONL of every conversation (grouped split folders), a copy below
    a sub-agent folder, and junk lines (blank, prose, JSON without records)."""
    recs = SP.split_grouped(_records(spark, d), "conv_id", SEED)
    X.write_records(recs, f"{root}/main", _allowed(spark, d), "split")
    X.write_records(recs, f"{root}/subagents/copy", _allowed(spark, d), None)
    c = _conv(spark, d)
    c.select(F.col("text").alias("value")).write.mode("overwrite").text(f"{root}/junk/text")
    c.select("conv_id", F.lit("no records here").alias("note")).write.mode("overwrite").json(f"{root}/junk/json")


@query("jsonl_roundtrip", SQL_FLAT_IDX)
def q_jsonl_roundtrip(spark, d):
    root = scratch_path(spark, "roundtrip")
    _write_conversation_jsonl(spark, d, root)
    return _flat(J.scan_jsonl(spark, root, recursive=True, glob=None, exclude_fragment=J.SUBAGENT_FRAGMENT))


@query("long_conversations_roundtrip", SQL_FLAT_IDX)
def q_long_conversations_roundtrip(spark, d):
    """Conversations longer than a segment (two turns here) come back whole and in order."""
    root = scratch_path(spark, "long")
    X.write_records(_records(spark, d, max_turns=2), root, _allowed(spark, d), None)
    return _flat(J.scan_jsonl(spark, root))


@query("export_allowed", SQL_FLAT_IDX + f"""
WHERE conv_id % {N_SOURCES} < 2""")
def q_export_allowed(spark, d):
    """A list of two sources: only their rows leave."""
    root = scratch_path(spark, "allowed")
    X.export(_records(spark, d), root, _allowed(spark, d, 2), formats=("records",), split_col=None)
    return _flat(J.scan_jsonl(spark, f"{root}/records"))


@query("scan_many", SQL_FLAT_IDX)
def q_scan_many(spark, d):
    """Several inputs: a glob, a folder with the default pattern, and a file that is missing."""
    root = scratch_path(spark, "many")
    recs = _records(spark, d)
    X.write_records(recs.filter("conv_id % 2 = 0"), f"{root}/a", _allowed(spark, d), None)
    X.write_records(recs.filter("conv_id % 2 <> 0"), f"{root}/b", _allowed(spark, d), None)
    return _flat(J.scan_jsonl(spark, [f"{root}/a/*.json", f"{root}/b", f"{root}/missing.jsonl"]))


@query("gated_write", f"""
WITH {sql_windows()},
g AS (SELECT conv_id, start, count(*) AS c,
             count(*) FILTER (WHERE role = 'assistant' AND contains(text, '{MARKER_A}')) AS a,
             count(*) FILTER (WHERE contains(text, '{MARKER_B}')) AS b,
             arg_min(role, pos) AS fr
      FROM m GROUP BY conv_id, start),
o AS (SELECT CASE WHEN c < 3 THEN 'too_short' WHEN a < {MIN_MARKED} THEN 'few_marked'
                  WHEN b < 1 THEN 'no_response' WHEN fr <> 'user' THEN 'wrong_first_role'
                  ELSE 'accepted' END AS outcome FROM g WHERE conv_id % {N_SOURCES} < 2)
SELECT outcome, count(*) AS n_counted, CASE WHEN outcome = 'accepted' THEN count(*) ELSE 0 END AS n_written FROM o GROUP BY 1""")
def q_gated_write(spark, d):
    """Gate counters observed during the write, beside the lines that were written."""
    root = scratch_path(spark, "gated")
    recs = _windows(spark, d).withColumn("source", F.concat(F.lit("src"), (F.col("conv_id") % N_SOURCES).cast("string")))
    counted = X.write_gated(recs, root, _allowed(spark, d, 2), None, **GATE)
    table = spark.createDataFrame([(k, n) for k, n in counted.items() if n], "outcome string, n_counted bigint")
    lines = J.scan_jsonl(spark, root).agg(F.count(F.lit(1)).alias("n_written")).withColumn("outcome", F.lit("accepted"))
    return table.join(lines, "outcome", "left").select(
        "outcome", "n_counted", F.coalesce("n_written", F.lit(0).cast("bigint")).alias("n_written"))


def _manifest_runs(spark, d):
    """Three refreshes of one folder: half of the records, all of them, nothing new."""
    root = scratch_path(spark, "manifest")
    recs, src = _records(spark, d), f"{root}/source"
    X.write_records(recs.filter("conv_id % 2 = 0"), f"{src}/a", _allowed(spark, d), None)
    runs = [MF.refresh_manifest(spark, src, f"{root}/manifest")]
    X.write_records(recs.filter("conv_id % 2 <> 0"), f"{src}/b", _allowed(spark, d), None)
    runs += [MF.refresh_manifest(spark, src, f"{root}/manifest") for _ in range(2)]
    return src, runs


@query("file_manifest", """
SELECT v AS run, count(DISTINCT CASE WHEN v >= 1 + conv_id % 2 THEN conv_id END) AS n_lines,
       count(DISTINCT CASE WHEN v = 1 + conv_id % 2 THEN conv_id END) AS n_new
FROM conversations, (SELECT unnest([1, 2, 3])::INTEGER AS v) GROUP BY v""")
def q_file_manifest(spark, d):
    """Lines in the manifest after each run, and those that the run had to read."""
    out = None
    for k, m in enumerate(_manifest_runs(spark, d)[1], 1):
        new = F.sum(F.when(F.col("version") == k, F.col("n_lines")))
        row = m.agg(F.coalesce(F.sum("n_lines"), F.lit(0)).cast("bigint").alias("n_lines"),
                    F.coalesce(new, F.lit(0)).cast("bigint").alias("n_new")).select(F.lit(k).alias("run"), "*")
        out = row if out is None else out.unionByName(row)
    return out


@query("scan_changed_files", SQL_FLAT_IDX + """
WHERE conv_id % 2 <> 0""")
def q_scan_changed_files(spark, d):
    """Records of the files that the second run found."""
    src, runs = _manifest_runs(spark, d)
    return _flat(MF.scan_manifest(spark, runs[-1], src, "version = 2"))


@query("concat_sources", SQL_FLAT_IDX)
def q_concat_sources(spark, d):
    root = scratch_path(spark, "concat")
    recs = _records(spark, d)
    X.write_records(recs.filter("conv_id % 5 = 0"), f"{root}/a", _allowed(spark, d), None)
    X.write_records(recs.filter("conv_id % 5 <> 0"), f"{root}/b", _allowed(spark, d), None)
    return _flat(J.concat(J.scan_jsonl(spark, f"{root}/a"), J.scan_jsonl(spark, f"{root}/b")))


@query("prepare_split", sql_split("conv_id", "additive"))
def q_prepare_split(spark, d):
    root = scratch_path(spark, "prepare")
    recs = _records(spark, d).orderBy("conv_id")  # range-partitioned: file order = id order
    X.write_records(recs, root, _allowed(spark, d), None)
    return PR.label_splits(spark, root).select(F.col("conv_id").cast("bigint").alias("conv_id"), "split")


@query("ingest_incremental", SQL_FLAT_IDX)
def q_ingest_incremental(spark, d):
    root = scratch_path(spark, "ingest")
    src, target, ckpt = f"{root}/source", f"{root}/target", f"{root}/checkpoint"
    recs = SP.split_grouped(_records(spark, d), "conv_id", SEED)
    X.write_records(recs.filter(F.col("split") == "train"), src, _allowed(spark, d), None)
    IG.ingest_incremental(spark, src, target, ckpt)
    X.write_records(recs.filter(F.col("split") != "train"), src, _allowed(spark, d), None, mode="append")
    IG.ingest_incremental(spark, src, target, ckpt)
    IG.ingest_incremental(spark, src, target, ckpt)  # nothing new: adds 0 rows
    return _flat(IG.read_ingested(spark, target))


SQL_ROLE_TEXT = """coalesce(string_agg(CASE role WHEN 'user' THEN 'User' ELSE 'Assistant' END || ': ' || coalesce(text, ''),
                             chr(10) || chr(10) ORDER BY turn) FILTER (WHERE role IN ('user', 'assistant')), '')"""


def _lines_without_ids(spark, d) -> DataFrame:
    """Records scanned from lines without ``conv_id`` (written in conversation order), with an id from their place."""
    root = scratch_path(spark, "idless")
    X.write_records(_records(spark, d).orderBy("conv_id"), root, _allowed(spark, d), None, extra_cols=("source",))
    recs = J.with_record_ids(J.scan_jsonl(spark, root))
    return recs.withColumn("source", F.col("extra")["source"])


@query("lines_without_ids", """
WITH r AS (SELECT conv_id, count(*) AS n_turns, arg_min(text, turn) AS first_text FROM conversations GROUP BY conv_id),
o AS (SELECT *, row_number() OVER (ORDER BY conv_id) - 1 AS number, count(*) OVER () AS n FROM r)
SELECT number, n_turns, first_text,
       CASE WHEN number < floor(n * 0.8::DOUBLE) THEN 'train'
            WHEN number < floor(n * 0.8::DOUBLE) + floor(n * 0.1::DOUBLE) THEN 'valid' ELSE 'test' END AS split
FROM o""")
def q_lines_without_ids(spark, d):
    """Lines without ids are records of their own: numbered and split by file order."""
    recs = SP.split_prefix(_lines_without_ids(spark, d), "conv_id", rule="additive")
    return recs.select(F.regexp_extract("conv_id", "[0-9]+$", 0).cast("bigint").alias("number"), F.size("turns").cast("bigint").alias("n_turns"),
                       F.col("turns")[0]["text"].alias("first_text"), "split")


@query("document_without_ids", f"""
WITH r AS (SELECT conv_id, {SQL_ROLE_TEXT} AS text FROM conversations GROUP BY conv_id),
o AS (SELECT text, row_number() OVER (ORDER BY conv_id) - 1 AS gpos, count(*) OVER () AS n FROM r)
SELECT gpos, text, CASE WHEN gpos < floor(n * 0.8::DOUBLE) THEN 'train'
                        WHEN gpos < floor(n * (0.8::DOUBLE + 0.1::DOUBLE)) THEN 'valid' ELSE 'test' END AS split
FROM o""")
def q_document_without_ids(spark, d):
    root = scratch_path(spark, "idless_document")
    X.write_text_document(_lines_without_ids(spark, d), root, _allowed(spark, d), keys=("conv_id", "start"), seed=None)
    return _read_document(spark, root)


@query("whole_texts", f"""
SELECT split, text FROM (
  SELECT conv_id, {SQL_ROLE_TEXT} AS text,
         CASE WHEN CAST('0x' || substr(md5('{SEED}:' || conv_id), 1, 8) AS BIGINT) % 1000 < 800 THEN 'train'
              WHEN CAST('0x' || substr(md5('{SEED}:' || conv_id), 1, 8) AS BIGINT) % 1000 < 900 THEN 'valid' ELSE 'test' END AS split
  FROM conversations GROUP BY conv_id)""")
def q_whole_texts(spark, d):
    """One text per conversation, written from segments of two turns each."""
    root = scratch_path(spark, "whole")
    recs = SP.split_grouped(_records(spark, d, max_turns=2), "conv_id", SEED)
    X.write_whole_texts(recs, root, _allowed(spark, d))
    lines = spark.read.text(root).filter(T.is_nonblank("value"))
    return lines.select("split", F.from_json("value", "text string")["text"].alias("text"))


@query("split_grouped_weighted", f"""
WITH g AS (SELECT conv_id, count(*) AS w, md5('{SEED}:' || conv_id) AS h FROM conversations GROUP BY conv_id),
c AS (SELECT *, sum(w) OVER (ORDER BY h, conv_id) AS e, sum(w) OVER () AS t FROM g)
SELECT conv_id, w AS n_turns, CASE WHEN 2 * e - w < 2.0::DOUBLE * (t * 0.8::DOUBLE) THEN 'train'
                    WHEN 2 * e - w < 2.0::DOUBLE * (t * (0.8::DOUBLE + 0.1::DOUBLE)) THEN 'valid' ELSE 'test' END AS split
FROM c""")
def q_split_grouped_weighted(spark, d):
    turns = SP.split_grouped_weighted(_conv(spark, d).select("conv_id"), "conv_id", SEED)
    return turns.groupBy("conv_id", "split").agg(F.count(F.lit(1)).alias("n_turns"))


@query("ingest_rejects", """
SELECT conv_id, count(*) AS n_turns, count(*) AS n_rejected FROM conversations GROUP BY conv_id""")
def q_ingest_rejects(spark, d):
    """Accepted records and rejected lines of two ingest runs, each once; ingested rows pass the allow-list."""
    root = scratch_path(spark, "rejects")
    c = _conv(spark, d)
    X.write_records(_records(spark, d), f"{root}/source", _allowed(spark, d), None)
    c.select("conv_id", F.lit("no records here").alias("note")).write.mode("append").json(f"{root}/source")
    for _ in range(2):
        IG.ingest_incremental(spark, f"{root}/source", f"{root}/target", f"{root}/checkpoint", rejects_dir=f"{root}/rejects")
    kept = X.allowed_only(IG.read_ingested(spark, f"{root}/target"), _allowed(spark, d))
    turns = kept.groupBy(F.col("conv_id").cast("bigint").alias("conv_id")).agg(F.sum(F.size("turns")).alias("n_turns"))
    lost = (spark.read.parquet(f"{root}/rejects").filter("reason = 'no_records'")
            .groupBy(F.from_json("line", "conv_id bigint")["conv_id"].alias("conv_id")).agg(F.count(F.lit(1)).alias("n_rejected")))
    return turns.join(lost, "conv_id")


# -- more gates, dedup and the ordered document ------------------------------------------

@query("conversation_quality", f"""
SELECT conv_id, count(*) AS n_turns, arg_min(role, turn) AS first_role,
       count(*) FILTER (WHERE role = 'assistant' AND contains(text, '{MARKER_A}')) AS n_marked,
       count(*) FILTER (WHERE contains(text, '{MARKER_B}')) AS n_response,
       count(*) >= 3
         AND count(*) FILTER (WHERE role = 'assistant' AND contains(text, '{MARKER_A}')) >= {MIN_MARKED}
         AND count(*) FILTER (WHERE contains(text, '{MARKER_B}')) >= 1
         AND coalesce(arg_min(role, turn) = 'user', false) AS passes
FROM conversations GROUP BY conv_id""")
def q_conversation_quality(spark, d):
    return FL.conversation_quality(_conv(spark, d), **GATE)


@query("dedup_documents", """
SELECT doc_id FROM (
  SELECT doc_id, row_number() OVER (PARTITION BY substr(text, 1, 200) ORDER BY doc_id) AS rn FROM documents)
WHERE rn = 1""")
def q_dedup_documents(spark, d):
    docs = TB.table(spark, d, "documents")
    return D.dedup_text_prefix(docs, "text", order_cols="doc_id").select("doc_id")


@query("text_document", f"""
WITH r AS (
  SELECT conv_id,
         coalesce(string_agg(CASE role WHEN 'user' THEN 'User' ELSE 'Assistant' END || ': ' || coalesce(text, ''),
                             chr(10) || chr(10) ORDER BY turn) FILTER (WHERE role IN ('user', 'assistant')), '')
           AS text
  FROM conversations GROUP BY conv_id),
o AS (SELECT text, row_number() OVER (ORDER BY md5('{SEED}:' || conv_id || ':0'), conv_id) - 1 AS gpos,
             count(*) OVER () AS nrec FROM r)
SELECT gpos, CASE WHEN gpos < floor(nrec * 0.8::DOUBLE) THEN 'train'
                  WHEN gpos < floor(nrec * (0.8::DOUBLE + 0.1::DOUBLE)) THEN 'valid' ELSE 'test' END AS split,
       text
FROM o""")
def q_text_document(spark, d):
    root = scratch_path(spark, "document")
    X.write_text_document(_records(spark, d), root, _allowed(spark, d), keys=("conv_id", "start"), seed=SEED)
    return _read_document(spark, root)


def _read_document(spark, root: str) -> DataFrame:
    """(gpos, split, text) of an ordered document written in parts."""
    lines = J.number_records(J.read_lines(spark, root, glob="part-*"), id_col="gpos")
    item = F.regexp_extract("line", r'\{"text": (".*")\}', 1)
    text = F.from_json(F.concat(F.lit("["), item, F.lit("]")), "array<string>")[0]
    # the separators a line carries tell its section: a section opens where its token appears
    head = F.substring_index("line", '{"text": ', 1)  # separators before the item
    sec = (F.when(head.contains('"test": ['), 2)
           .when(head.contains('"valid": ['), 1)
           .when(head.startswith('{"train": ['), 0))
    staged = lines.select("gpos", text.alias("text"), sec.alias("opens"))
    bounds = staged.filter(F.col("opens").isNotNull()).groupBy("opens").agg(F.min("gpos").alias("b")).collect()
    split = F.lit("train")
    for r in sorted(bounds):
        split = F.when(F.col("gpos") >= F.lit(r.b), F.lit(SP.SPLIT_NAMES[r.opens])).otherwise(split)
    return staged.select("gpos", split.alias("split"), "text")


# -- session-log metrics (derived log lines) ---------------------------------------------

TOOL_NAME = "Read"


def _write_session_logs(spark, d, root: str) -> None:
    """Log lines from the conversations: user turns carry string content, assistant turns a
    block list (a text block, plus a tool_use block when the marker occurs), system turns
    are written too (and skipped by the reader)."""
    c = _conv(spark, d)
    session = F.col("conv_id").cast("string").alias("sessionId")
    plain = c.filter(F.col("role") != "assistant").select(F.to_json(F.struct(
        F.col("role").alias("type"), session,
        F.struct(F.col("role").alias("role"), F.col("text").alias("content")).alias("message"))).alias("value"))
    block = F.struct(F.lit("text").alias("type"), F.lit(None).cast("string").alias("name"), F.col("text").alias("text"))
    tool = F.struct(F.lit("tool_use").alias("type"), F.lit(TOOL_NAME).alias("name"),
                    F.lit(None).cast("string").alias("text"))
    blocks = F.when(T.contains("text", MARKER_A), F.array(block, tool)).otherwise(F.array(block))
    rich = c.filter(F.col("role") == "assistant").select(F.to_json(F.struct(
        F.col("role").alias("type"), session,
        F.struct(F.col("role").alias("role"), blocks.alias("content")).alias("message"))).alias("value"))
    plain.unionByName(rich).write.mode("overwrite").text(root)


@query("log_block_counts", f"""
SELECT 'text' AS block_type, count(*) AS n_blocks FROM conversations WHERE role = 'assistant'
UNION ALL
SELECT 'tool_use' AS block_type, count(*) AS n_blocks FROM conversations
WHERE role = 'assistant' AND contains(text, '{MARKER_A}')""")
def q_log_block_counts(spark, d):
    root = scratch_path(spark, "logs")
    _write_session_logs(spark, d, root)
    return N.block_counts(LG.scan_session_logs(spark, root, glob=None))


@query("session_block_gate", f"""
SELECT CAST(conv_id AS VARCHAR) AS session, count(*) AS n_blocks FROM conversations
WHERE role = 'assistant' AND contains(text, '{MARKER_A}') GROUP BY conv_id HAVING count(*) >= 2""")
def q_session_block_gate(spark, d):
    root = scratch_path(spark, "logs")
    _write_session_logs(spark, d, root)
    return FL.session_block_gate(LG.scan_session_logs(spark, root, glob=None), 2, names=[TOOL_NAME])


@query("sorted_names", f"""
SELECT row_number() OVER (ORDER BY name) - 1 AS pos, name FROM (
  SELECT DISTINCT unnest(regexp_extract_all(text, '{NAME_PATTERN}', 1)) AS name
  FROM conversations WHERE role = 'assistant')""")
def q_sorted_names(spark, d):
    return S.sorted_names(_conv(spark, d), NAME_PATTERN, R.ASSISTANT)


@query("bracket_span", """
WITH e AS (SELECT event_id, event_type || '[' || props || ']] ' AS x FROM events)
SELECT event_id, substr(x, instr(x, '['), length(x) - instr(reverse(x), ']') + 1 - instr(x, '[') + 1) AS span FROM e""")
def q_bracket_span(spark, d):
    x = F.concat(F.col("event_type"), F.lit("["), F.col("props"), F.lit("]] "))
    return TB.table(spark, d, "events").select("event_id", T.bracket_span(x).alias("span"))


# -- the reference's dataset-quality assertions as one report ----------------------------------


@query("quality_report", f"""
WITH {sql_windows()},
g AS (SELECT conv_id, start, count(*) AS n_turns, substr(arg_min(text, pos), 1, 200) AS k
      FROM m GROUP BY conv_id, start {SQL_GATE_HAVING}),
kept AS (SELECT conv_id, start FROM (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY conv_id, start) AS rn FROM g) WHERE rn = 1),
km AS (SELECT m.* FROM m JOIN kept USING (conv_id, start)),
per AS (SELECT conv_id, start, count(*) AS n_turns, arg_min(role, pos) AS fr,
               count(*) FILTER (WHERE role = 'assistant' AND contains(text, '{MARKER_A}')) AS a,
               count(*) FILTER (WHERE contains(text, '{MARKER_B}')) AS b,
               count(*) FILTER (WHERE NOT regexp_matches(text, '[^{WSC}]')) AS blank
        FROM km GROUP BY conv_id, start),
isl AS (SELECT conv_id, start, role,
               row_number() OVER (PARTITION BY conv_id, start ORDER BY pos)
               - row_number() OVER (PARTITION BY conv_id, start, role ORDER BY pos) AS island FROM km),
runs AS (SELECT conv_id, start, role, island, count(*) AS run_len FROM isl GROUP BY ALL),
names AS (SELECT DISTINCT unnest(regexp_extract_all(text, '{NAME_PATTERN}', 1)) AS name
          FROM km WHERE role = 'assistant')
SELECT count(*) AS n_records,
       count(*) FILTER (WHERE n_turns < 3) AS n_too_short,
       count(*) FILTER (WHERE fr <> 'user') AS n_wrong_first_role,
       count(*) FILTER (WHERE a < 1) AS n_without_marker,
       count(*) FILTER (WHERE b < 1) AS n_without_response,
       CAST(coalesce(sum(blank), 0) AS BIGINT) AS n_blank_turns,
       (SELECT coalesce(max(run_len), 0) FROM runs) AS max_same_role_run,
       (SELECT count(*) FROM names WHERE name IN {EXPECTED_NAMES}) AS n_core_names
FROM per""")
def q_quality_report(spark, d):
    recs = CU.curate(_conv(spark, d), max_turns=WINDOW_TURNS, **GATE)
    return S.quality_report(recs, EXPECTED_NAMES, MARKER_A, MARKER_B, name_pattern=NAME_PATTERN)


# -- cap by target count and line counting -------------------------------------------------------

CAP_TARGET = 61


@query("cap_target", f"""
SELECT conv_id FROM (
  SELECT conv_id, row_number() OVER (ORDER BY md5('{SEED}:' || conv_id), conv_id) - 1 AS gpos,
         count(*) OVER () AS nrec
  FROM (SELECT DISTINCT conv_id FROM conversations))
WHERE gpos < least({CAP_TARGET} // 2, nrec)""")
def q_cap_target(spark, d):
    c = _conv(spark, d)
    cap = SA.first_of_shuffle(c, "conv_id", CAP_TARGET, SEED)
    return c.filter(cap.predicate()).select("conv_id").distinct()


@query("line_count", f"""
SELECT CAST((SELECT count(DISTINCT conv_id) FROM conversations)
            + (SELECT count(*) FROM (
                 SELECT unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) AS line FROM conversations)
               WHERE regexp_matches(line, '[^{WSC}]')) AS BIGINT) AS n_lines""")
def q_line_count(spark, d):
    root = scratch_path(spark, "lines")
    X.write_records(_records(spark, d), f"{root}/records", _allowed(spark, d), None)
    _conv(spark, d).select(F.coalesce("text", F.lit("")).alias("value")).write.mode("overwrite").text(f"{root}/junk")
    lines = J.read_lines(spark, root, recursive=True)
    return S.nonblank_line_count(lines, "line")


def _hybrid_rows(spark, d):
    return HY.build_hybrid(_sourced(spark, d), ratio=0.5, seed=SEED, marker=MARKER_A)[0]


@query("hybrid_export", f"""
WITH {SQL_HYBRID_ROWS},
t AS (SELECT hs.split, coalesce(string_agg(CASE role WHEN 'user' THEN 'User' ELSE 'Assistant' END || ': ' || coalesce(text, ''),
                                           chr(10) || chr(10) ORDER BY pos) FILTER (WHERE role IN ('user', 'assistant')), '') AS text
      FROM hy JOIN hs USING (conv_id, variant) GROUP BY conv_id, variant, hs.split)
SELECT format, split, text FROM t CROSS JOIN (VALUES ('records'), ('text'), ('document')) f(format)""")
def q_hybrid_export(spark, d):
    """All three formats of one export: each holds every record, in the same split."""
    root = scratch_path(spark, "hybrid")
    HY.write_hybrid(_hybrid_rows(spark, d), root, _allowed(spark, d), ratio=0.5, seed=SEED, marker=MARKER_A)
    recs = RD.render_text(J.scan_jsonl(spark, f"{root}/records")).select(F.lit("records").alias("format"), "split", "text")
    text = spark.read.schema("text string").json(f"{root}/text").select(F.lit("text").alias("format"), "split", "text")
    doc = _read_document(spark, f"{root}/document").select(F.lit("document").alias("format"), "split", "text")
    return recs.unionByName(text).unionByName(doc)


@query("hybrid_export_splits", f"""
WITH {SQL_HYBRID_ROWS}
SELECT conv_id, variant, split FROM hs""")
def q_hybrid_export_splits(spark, d):
    """Conversations cut into segments of two turns: all segments of a record lie in its split."""
    root = scratch_path(spark, "hybridsplits")
    HY.write_hybrid(_hybrid_rows(spark, d), root, _allowed(spark, d), ratio=0.5, seed=SEED, marker=MARKER_A,
                    formats=("records",), max_turns=2)
    return (J.scan_jsonl(spark, f"{root}/records")
            .select(F.col("conv_id").cast("bigint").alias("conv_id"), "variant", "split").distinct())


@query("metadata_roundtrip", f"""
WITH {SQL_HYBRID_ROWS},
per AS (SELECT conv_id, variant, count(*) AS n_turns,
               sum(len(regexp_extract_all(text, '[^{WSC}]+'))) AS n_tokens,
               bool_or(contains(text, '{MARKER_A}')) AS has_marker
        FROM hy GROUP BY conv_id, variant)
SELECT count(*) AS total_conversations, count(*) AS total_lines, 0.5::DOUBLE AS augmentation_ratio,
       0.8::DOUBLE AS split_train, 0.1::DOUBLE AS split_valid, 0.1::DOUBLE AS split_test,
       'records,text,document' AS formats,
       CAST(sum(n_turns) AS BIGINT) AS total_turns, CAST(sum(n_tokens) AS BIGINT) AS total_tokens,
       CAST(sum(n_turns) AS DOUBLE) / count(*) AS avg_turns_per_conv,
       count(*) FILTER (WHERE has_marker) AS conversations_with_marker,
       CAST(count(*) FILTER (WHERE has_marker) AS DOUBLE) / count(*) * 100 AS marker_percentage
FROM per""")
def q_metadata_roundtrip(spark, d):
    root = scratch_path(spark, "metadata")
    HY.write_hybrid(_hybrid_rows(spark, d), root, _allowed(spark, d), ratio=0.5, seed=SEED, marker=MARKER_A)
    meta = spark.read.json(f"{root}/metadata")
    return meta.select("total_conversations", "total_lines", "augmentation_ratio",
                       F.col("split_ratio")[0].alias("split_train"), F.col("split_ratio")[1].alias("split_valid"),
                       F.col("split_ratio")[2].alias("split_test"), F.array_join("formats", ",").alias("formats"),
                       *[F.col(f"statistics.{c}").alias(c) for c in (
                           "total_turns", "total_tokens", "avg_turns_per_conv", "conversations_with_marker", "marker_percentage")])
