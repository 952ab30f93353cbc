import random

import pytest
from pyspark.sql import functions as F

from tidebars.operators.asof import as_of_join


def brute(left, right, exclusive, within):
    out = []
    for i, k, t in left:
        fits = [(u, v) for j, u, v in right if j is not None and u is not None and j == k and t is not None and (u < t or (u == t and not exclusive))]
        best = max(fits, key=lambda x: (x[0], x[1] is not None, x[1]), default=(None, None))
        if best[0] is not None and within is not None and best[0] < t - within:
            best = (None, None)
        out.append((i, k, t, *best))
    return sorted(out, key=str)


@pytest.mark.parametrize("exclusive", [False, True])
@pytest.mark.parametrize("within", [None, 30])
def test_as_of_against_brute_force(spark, exclusive, within):
    rng = random.Random(3)
    keys = ["hot"] * 8 + ["b", "c", None]
    left = [(i, rng.choice(keys), rng.choice([None, *range(300)]) if i % 9 == 0 else rng.randrange(300)) for i in range(900)]
    right = [(rng.choice([*keys, "d"]), rng.choice([None, *range(0, 300, 7)]), rng.choice([None, *range(50)])) for _ in range(400)]
    rows = spark.createDataFrame(left, "id int, k string, t int").select("id", "k", (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("t"))).alias("t"))
    others = spark.createDataFrame(right, "k string, u int, v int").select("k", (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("u"))).alias("u"), "v")
    got = as_of_join(rows, others, ["k"], "t", "u", exclusive, None if within is None else f"{within} seconds")
    assert got.columns == ["id", "k", "t", "u", "v"]
    seconds = [F.date_diff(c, F.lit("2024-01-01")) * 86_400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c).cast("int") for c in ("t", "u")]
    found = got.select("id", "k", seconds[0].alias("t"), seconds[1].alias("u"), "v").collect()
    assert sorted(map(tuple, found), key=str) == brute(left, right, exclusive, within)


def test_as_of_with_clashing_names_and_empty_sides(spark):
    a = spark.createDataFrame([("x", 1, 5, 9), ("x", 2, 7, 9)], "a string, b int, at int, _seen int")
    b = spark.createDataFrame([("x", 2, 6, 3), ("x", 1, 4, 2)], "a string, b int, at int, _part int")
    got = as_of_join(a, b, ["a", "b"], "at")
    assert got.columns == ["a", "b", "at", "_seen", "at_asof", "_part"]
    assert sorted(map(tuple, got.collect())) == [("x", 1, 5, 9, 4, 2), ("x", 2, 7, 9, 6, 3)]
    assert sorted(map(tuple, as_of_join(a, b.limit(0), ["a"], "at").collect())) == [("x", 1, 5, 9, None, None, None), ("x", 2, 7, 9, None, None, None)]
    assert as_of_join(a.limit(0), b, ["a"], "at").collect() == []


def test_a_hot_key_lies_in_many_partitions(spark):
    rows = spark.range(20_000).selectExpr("'hot' AS k", "id AS t")
    others = spark.range(0, 20_000, 1999).selectExpr("'hot' AS k", "id AS u")
    got = as_of_join(rows, others, ["k"], "t", "u")
    assert got.filter("u <> t - t % 1999").count() == 0 and got.count() == 20_000
