"""Plan properties: no Python in the hot path, pruning and pushdown, no single-partition exchange
on the position-based operators, bounded groups."""

import pytest

import __spark_entry__ as E
from threadline import catalog

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")
# Global aggregates, TakeOrderedAndProject and the 3-row split-share window merge in one
# partition by design; the position-based operators must not.
NO_SINGLE_PARTITION = ["split_prefix", "split_prefix_v2", "sample_exact", "hybrid_split", "augment_mixed",
                       "text_document", "prepare_split", "cap_target", "hybrid_export", "sorted_names", "dedup_documents",
                       "chunk_overlap", "dedup_prefix", "max_role_run", "curate_windows"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_python_in_plans(spark, sf_dir, name):
    plan = _plan(E.queries()[name](spark, sf_dir))
    assert not any(n in plan for n in PY_NODES), name


@pytest.mark.parametrize("name", NO_SINGLE_PARTITION)
def test_no_single_partition_exchange(spark, sf_dir, name):
    df = E.queries()[name](spark, sf_dir)
    df.collect()
    assert "SinglePartition" not in _plan(df), name


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = _plan(E.queries()["filter_roles"](spark, sf_dir))
    assert "PushedFilters: [In(role, [assistant,user])]" in plan
    plan = _plan(E.queries()["valid_structure"](spark, sf_dir))
    assert "ReadSchema: struct<conv_id:bigint>" in plan


def test_windows_group_by_window_key(spark, sf_dir):
    plan = _plan(E.queries()["chunk_overlap"](spark, sf_dir))
    # turn rows are shuffled by (conversation, block) and by (conversation, window start)
    assert "_tl_blk" in plan and "start" in plan


def _final_plan(df):
    df.collect()  # the adaptive plan is final (and shows reused exchanges) only after execution
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["curate_windows", "dedup_prefix", "curate_stats"])
def test_window_shuffle_is_shared(spark, sf_dir, name):
    plan = _final_plan(E.queries()[name](spark, sf_dir))
    assert "isFinalPlan=true" in plan
    assert "ReusedExchange" in plan, name


def test_dedup_semi_join_keeps_window_partitioning(spark, sf_dir):
    plan = _final_plan(E.queries()["dedup_prefix"](spark, sf_dir))
    # a null-safe join would hash coalesce/isnull expressions and re-shuffle the windows
    assert "hashpartitioning(coalesce(conv_id" not in plan


def test_dedup_aggregates_by_hash(spark, sf_dir):
    assert "SortAggregate" not in _final_plan(E.queries()["dedup_documents"](spark, sf_dir))


def test_split_preparation_moves_no_text(spark, sf_dir):
    df = E.queries()["prepare_split"](spark, sf_dir)
    assert "Exchange" not in _final_plan(df)
