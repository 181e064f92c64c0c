"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from lumenlake.operators.keys import first_wins
from lumenlake.operators.ordering import running_total
from lumenlake.operators.skew import join_many
from lumenlake.plans import gold, logs, silver
from lumenlake.registry.queries import _QUERIES
from lumenlake.registry.relations import Relations
from lumenlake.session import settings

SF = "/root/testdata/sf0.001"


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def relations(spark):
    return Relations(spark, SF)


@pytest.mark.parametrize("name", sorted(_QUERIES))
def test_no_python_and_no_cartesian_product(relations, name):
    text = plan(_QUERIES[name](relations))
    assert not re.search("PythonUDF|ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroups", text)
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", text)


@pytest.mark.parametrize("name", ["payments", "addresses", "installations"])
def test_first_wins_reduces_before_the_shuffle(relations, name):
    from lumenlake.registry import relations as module

    text = plan(module._SILVER[name](relations))
    assert re.search(r"WindowGroupLimit .*Final[\s\S]*Exchange hashpartitioning[\s\S]*WindowGroupLimit .*Partial", text)


def test_base_scan_reads_only_what_a_view_needs(relations):
    text = plan(gold.consumption_by_district(relations.base(), F.col("district") == "D"))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert sorted(re.findall(r"(\w+):", schema)) == ["district", "measured_kwh", "month"]
    assert "EqualTo(district,D)" in text


def test_valid_rows_are_filtered_in_the_scan(relations):
    text = plan(silver.bill_status(relations.valid()))
    assert "EqualTo(is_valid,true)" in text and "ReadSchema: struct<bill_status:string,is_valid:boolean>" in text


def test_only_summaries_pass_one_partition(relations):
    """What reaches a single partition is already one row per file split."""
    text = plan(logs.log_landmarks(relations.log_events()))
    below = text.split("Exchange SinglePartition")[1]
    assert re.match(r"[^\n]*\n[\s:+|*()\d-]*(Sort|Object)?(Hash)?Aggregate", below)


@pytest.mark.parametrize(
    "name", ["duration_summary", "recovery_summary", "mann_whitney", "spearman_trend", "connect_failures"]
)
def test_statistics_read_their_input_once(relations, name):
    """What is left after the counts are written reads nothing but the counts."""
    files = _QUERIES[name](relations).inputFiles()
    assert files and all("/steps/value-" in f for f in files)


def test_plans_do_not_grow_with_the_chunks(spark):
    """No bound of a chunk is in the plan: 20 000 shuffle partitions give the plan of 40."""
    rows = spark.range(30000).selectExpr("id * 7 % 30000 as v", "1 as n")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    sizes = {}
    try:
        for parts in ("40", "20000"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            total = running_total(rows, "v", "n", "upto")
            sizes[parts] = len(total._jdf.queryExecution().optimizedPlan().toString())
            assert total.agg(F.count_if(F.col("upto") != F.col("v") + 1), F.count("*")).first()[:] == (0, 30000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert abs(sizes["40"] - sizes["20000"]) < 200


def test_hot_keys_are_spread(spark):
    unique = spark.range(50).selectExpr("id as k", "id * 2 as v")
    many = spark.range(3000).selectExpr("case when id % 3 = 0 then 7 else id % 40 end as k", "id as w")
    expected = sorted(map(tuple, unique.join(many, "k", "left").collect()), key=repr)
    found = join_many(unique, many, "k", hot_rows=500)
    assert sorted(map(tuple, found.select("k", "v", "w").collect()), key=repr) == expected
    assert "Union" in plan(found)


def test_settings_grow_with_the_input():
    assert settings(10, 8)["spark.sql.shuffle.partitions"] == "8"
    assert settings(100 << 40, 4000)["spark.sql.shuffle.partitions"] == "819200"
