"""The best rows of every key against sorting."""

import random

import pytest
from pyspark.sql import functions as F

from tagwright.operators.topk import top_k_per_key


@pytest.mark.parametrize("largest", [False, True])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_against_sorting(spark, largest, kind):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", "c", None, "hot", "hot", "hot"]), rng.choice([None, round(rng.random(), 1)]), i) for i in range(3000)]
    rows = [(k, v, i if kind == "long" else f"{i:05d}") for k, v, i in rows]
    df = spark.createDataFrame(rows, f"key string, value double, id {kind}").repartition(13)
    got = top_k_per_key(df.withColumn("more", F.lit(1)), "key", 7, "value", largest=largest)
    assert got.columns == ["key", "value", "id", "more"]
    want = []
    for key in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == key]
        own.sort(key=lambda r: (r[1] is None, (-r[1] if largest else r[1]) if r[1] is not None else 0, r[2]))
        want += own[:7]
    assert sorted((tuple(r[:3]) for r in got.collect()), key=str) == sorted(want, key=str)


def test_few_or_no_rows(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("b", 2.0, 2)], "key string, value double, id long")
    assert top_k_per_key(df, "key", 5, "value").count() == 2
    assert top_k_per_key(df, "key", 0, "value").count() == 0
    assert top_k_per_key(df.where("false"), "key", 5, "value").count() == 0


def test_the_table_is_not_sorted(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("key"), F.rand(1).alias("value"), "id")
    plan = top_k_per_key(df, "key", 5, "value")._jdf.queryExecution().executedPlan().toString()
    before_merge = plan[plan.index("MapInArrow") :]
    assert "Sort" not in before_merge and "Exchange" not in before_merge
