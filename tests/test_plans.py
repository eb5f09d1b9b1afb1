"""What the physical plans may and may not hold."""

import pytest
from pyspark.sql import functions as F

from haulmark import catalog
from haulmark.operators import changes as C

SMOKE = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan(run(spark, SMOKE)) for name, run in catalog.all_queries().items()}


def test_no_product_joins_and_no_python(plans):
    for name, text in plans.items():
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                     "MapInPandas", "FlatMapGroups"):
            assert word not in text, f"{word} in {name}"


def test_no_window_in_a_single_task(plans):
    for name, text in plans.items():
        lines = text.splitlines()
        for i, line in enumerate(lines):
            if "Window [" in line:
                below = "\n".join(lines[i:i + 4])
                assert "SinglePartition" not in below, f"unpartitioned window in {name}"


def test_newest_row_limits_groups_before_the_shuffle(plans):
    for name in ("dedup_keep_last", "upsert_overwrite", "upsert_null_safe", "insert_ignore_dups"):
        assert "WindowGroupLimit" in plans[name] and "Partial" in plans[name], name


def test_upsert_shuffles_each_side_once(spark):
    target = spark.range(100).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    source = spark.range(100).select((F.col("id") % 9).alias("k"), F.col("id").cast("string").alias("v"), "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(C.upsert_overwrite(target, source, ["k"], ["id"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 2


def test_scans_read_only_needed_columns(spark):
    text = plan(catalog.all_queries()["week_lookup"](spark, SMOKE))
    assert "o_totalprice" not in text


def test_every_query_has_equal_sql():
    assert set(catalog.all_queries()) == set(catalog.all_sql())


def test_a_null_safe_upsert_moves_each_side_once(spark):
    left = spark.createDataFrame([(1, "x", 1), (2, None, 2)], "a int, b string, v int")
    right = spark.createDataFrame([(1, "x", 5, 1), (2, None, 6, 1), (2, None, 7, 2), (3, None, 8, 1)], "a int, b string, v int, line int")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        merged = C.upsert_overwrite(left, right, ["a", "b"], ["line"], null_safe=("b",))
        assert plan(merged).count("Exchange hashpartitioning") == 2
        assert sorted(map(tuple, merged.collect()), key=str) == sorted([(1, "x", 5), (2, None, 7), (3, None, 8)], key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_the_expensive_input_is_read_twice_at_most(spark):
    text = plan(catalog.all_queries()["week_ranking"](spark, SMOKE))
    assert text.count("Scan parquet") <= 3 and "RoundRobin" not in text
