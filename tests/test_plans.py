"""Physical-plan properties that matter at scale (checked on the initial physical plans)."""

import os
import re

import pytest

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")
# queries whose result is built from fitted-model rows or written files (their plans are trivial)
SKIP = {"fit_forest", "fit_gbt", "grid_search_trees"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(plan: str) -> list[str]:
    return re.findall(r"Exchange (\w+)", plan)


@pytest.fixture(scope="module")
def entry():
    import __spark_entry__ as E
    return E


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_no_cross_join_no_python_udf(spark, entry):
    from sensorgrid.plans.registry import ORACLE, QUERIES
    for name, fn in QUERIES.items():
        # model queries return score rows built from fitted models; their fits are Spark ML jobs
        if name in SKIP or name not in ORACLE:
            continue
        plan = plan_of(fn(spark, SF))
        for bad in FORBIDDEN:
            assert bad not in plan, f"{name}: {bad}"


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_feature_pack_single_partitioning(spark, entry):
    plan = plan_of(entry.queries()["feature_pack"](spark, SF))
    ex = exchanges(plan)
    # the aggregate's shuffle + one hash partitioning by series key shared by every window
    assert len(ex) <= 2, ex
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert scans and all(set(s.replace(" ", "").split(",")) <= {"ts:timestamp_ntz", "event_type:string",
                                                                  "value:double"} for s in scans), scans


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
@pytest.mark.parametrize("name, most", [("naive_classifier", 5), ("classification_metrics", 4), ("confusion_matrix", 3),
                                        ("class_distribution", 3), ("aligned_xy", 2), ("classification_results_json", 5)])
def test_metrics_and_alignment_run_once(spark, entry, name, most):
    """One scan of the table and no window stage twice: each metric is one pass."""
    from sensorgrid.plans import classification, registry
    df = (classification.naive_class_scores(registry.pack(spark, SF)) if name == "classification_results_json"
          else entry.queries()[name](spark, SF))
    plan = plan_of(df)
    assert len(re.findall(r"FileScan|Scan parquet", plan)) == 1 and len(exchanges(plan)) <= most, plan[:2000]
    assert "Join" not in plan and "Union" not in plan


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_best_row_is_partial_aggregate(spark, entry):
    plan = plan_of(entry.queries()["dedup_keep_best"](spark, SF))
    assert "Window" not in plan
    assert "HashAggregate" in plan or "ObjectHashAggregate" in plan or "SortAggregate" in plan
    assert "partial_min_by" in plan


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_column_pruning_on_scan(spark, entry):
    plan = plan_of(entry.queries()["coerce_numeric"](spark, SF))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert scans == ["event_id:bigint,props:string"], scans
