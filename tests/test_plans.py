"""Plan hygiene of every registered query: no cartesian product, no
nested-loop join (every join is an equi join; ranges go through buckets),
and scans read only the columns they need."""

import re

import pytest

from mise.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
BAD = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cross_or_nested_loop_join(spark, key):
    plan = plan_of(QUERIES[key](spark, SF))
    for bad in BAD:
        assert bad not in plan, f"{key}: {bad}"


def test_range_join_is_bucketed_equi_join(spark):
    plan = plan_of(QUERIES["frame_range_join"](spark, SF))
    assert re.search(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin) \[video_id#\d+, _b#", plan)


def test_scans_are_pruned(spark):
    plan = plan_of(QUERIES["label_encode"](spark, SF))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert schemas and all("o_totalprice" not in s and "o_orderdate" not in s for s in schemas)


def test_mapping_join_is_broadcast_after_size_check(spark):
    plan = plan_of(QUERIES["label_encode"](spark, SF))
    assert "BroadcastHashJoin" in plan


def final_plan(df):
    """The plan after adaptive execution: run it, then ask again."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan_of(df)


def test_final_plans_have_no_nested_loop(spark):
    for key in ("frame_range_join", "label_decode_text", "ablation_table", "fuse_features"):
        plan = final_plan(QUERIES[key](spark, SF))
        assert "isFinalPlan=true" in plan or "AdaptiveSparkPlan" not in plan
        assert not any(bad in plan for bad in BAD)


def test_trained_rows_are_not_shuffled_by_label(spark):
    """On a huge synthetic frame the class weights are broadcast."""
    from pyspark.sql import functions as F

    from mise.operators.labels import class_weights, sized
    from mise.session import cut_lineage
    rows = spark.range(2_000_000_000).select((F.col("id") % 59).alias("y"))
    small = spark.range(5_000).select((F.col("id") % 59).alias("y"))
    w = sized(cut_lineage(class_weights(small, "y", 59)).withColumnRenamed("class_id", "y"))
    plan = plan_of(rows.join(w, "y", "left"))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_evaluation_keys_scan_once_per_table(spark):
    """The scored table is read once for each metric table."""
    for key in ("ablation_table", "best_flags", "metric_gain"):
        plan = plan_of(QUERIES[key](spark, SF))
        assert plan.count("FileScan") == 1  # the modes are slices of one read


def test_bucketed_features_align_without_a_shuffle(spark):
    plan = plan_of(QUERIES["bucketed_align"](spark, SF))
    assert plan.count("SortMergeJoin") + plan.count("HashJoin") == 2 and "Exchange hashpartitioning" not in plan


@pytest.mark.parametrize("key", ["sql_seconds_to_frames", "sql_frame_sample", "sql_frame_parse", "sql_range_join"])
def test_sql_functions_are_put_in_place(spark, key):
    plan = plan_of(QUERIES[key](spark, SF))
    assert not any(x in plan for x in ("Python", "SQLScalarFunction", "NestedLoop"))
