from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stopweave.operators.ordered import chunked, first_per_group, large_groups, next_row

SCHEMA = "k string, n int, pos long, id long, v double"


def rows(seed: int) -> list[tuple]:
    """Groups of very different size, one with a third of all rows in one second."""
    rng = random.Random(seed)
    out, ids = [], list(range(5000))
    rng.shuffle(ids)

    def add(key, number, position):
        out.append((key, number, position, ids.pop() - 2500, rng.random()))

    for _ in range(400):
        add("hot", 1, 42)
    for _ in range(300):
        add("wide", 1, rng.randrange(200))
    for _ in range(100):
        add(None, None, rng.choice([None, 1, 2, 3]))
    for key in range(150):
        for _ in range(rng.randrange(1, 4)):
            add(f"k{key}", 2, rng.randrange(10))
    rng.shuffle(out)
    return out


def plain_next(df):
    w = Window.partitionBy("k", "n").orderBy("pos", "id")
    return df.withColumns({"next_id": F.lead("id").over(w), "next_v": F.lead("v").over(w)})


@pytest.mark.parametrize("large_group", [1, 7, 50, 10_000])
def test_next_row_equals_one_window_whatever_the_chunks(spark, large_group):
    df = spark.createDataFrame(rows(large_group), SCHEMA).repartition(5)
    got = next_row(df, ["k", "n"], "pos", "id", {"id": "next_id", "v": "next_v"}, large_group)
    assert got.columns == [*df.columns, "next_id", "next_v"]
    assert set(got.collect()) == set(plain_next(df).collect())
    assert got.count() == df.count()


def test_chunks_are_consecutive_and_of_even_size(spark):
    df = spark.createDataFrame(rows(3), SCHEMA)
    pieces = chunked(df, ["k", "n"], "pos", "id", 20)
    w = Window.partitionBy("k", "n").orderBy("pos", "id")
    falls = pieces.withColumn("before", F.lag("_chunk").over(w)).where("_chunk < before")
    assert falls.count() == 0
    sizes = pieces.groupBy("k", "n", "_chunk").count()
    assert sizes.agg(F.max("count")).first()[0] <= 80
    assert pieces.where("k = 'hot'").select("_chunk").distinct().count() >= 15


def test_large_groups_counts_null_as_a_group(spark):
    df = spark.createDataFrame(rows(3), SCHEMA)
    found = {tuple(r) for r in large_groups(df, ["k", "n"], 99).collect()}
    assert found == {("hot", 1), ("wide", 1), (None, None)}


def test_next_row_of_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert next_row(df, ["k"], "pos", "id", {"v": "w"}).count() == 0


def test_first_per_group_drops_copies_before_the_shuffle(spark):
    df = spark.createDataFrame(rows(5), SCHEMA)
    first = first_per_group(df, ["k", "n"], ["pos", "id"])
    plan = first._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange hashpartitioning", 1)
    assert "min_by" in above and "partial_min_by" in below
    w = Window.partitionBy("k", "n").orderBy("pos", "id")
    expected = df.withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")
    assert first.columns == df.columns
    assert set(first.collect()) == set(expected.collect())


def test_a_small_table_is_not_read_to_plan_its_window(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(rows(4), SCHEMA).write.parquet(path)
    df, tracker = spark.read.parquet(path), spark.sparkContext.statusTracker()

    def planned(group, large_group):
        spark.sparkContext.setJobGroup(group, "counted")
        got = next_row(df, ["k", "n"], "pos", "id", {"id": "next_id", "v": "next_v"}, large_group)
        jobs = len(tracker.getJobIdsForGroup(group))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert set(got.collect()) == set(plain_next(df).collect())
        return jobs, plan

    jobs, plan = planned("small", 5_000_000)
    assert jobs == 0 and plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan") == 1
    jobs, plan = planned("large", 300)
    assert jobs > 0 and plan.count("FileScan") > 1


def test_only_keys_are_read_to_find_large_groups(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(rows(4), SCHEMA).write.parquet(path)
    found = large_groups(spark.read.parquet(path), ["k", "n"], 99)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<k:string,n:int>" in plan and plan.count("FileScan") == 1
