import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loadlake.functions.numeric import round_half_even, value_bucket
from loadlake.operators.quantiles import exact_quantiles

QUANTILES = {"p05": 0.05, "p50": 0.5, "p95": 0.95}


def nearest(values, q):
    s = sorted(values)
    return s[math.floor((len(s) - 1) * q + 0.5)]


def median(values):
    s = sorted(values)
    return (s[(len(s) - 1) // 2] + s[len(s) // 2]) / 2


def expected(groups):
    return {g: (*[nearest(v, q) for q in QUANTILES.values()], median(v)) for g, v in groups.items() if v}


def run(spark, data):
    df = spark.createDataFrame(data, "g string, v double")
    found = exact_quantiles(df, ["g"], "v", QUANTILES, "median").collect()
    return {r.g: (r.p05, r.p50, r.p95, r.median) for r in found}


def test_moments_and_empty_groups(spark):
    import statistics

    groups = {"a": [1e9 + x for x in (1.0, 2.0, 4.0, 4.0)], "b": [5.0], None: [0.5, -0.5] * 50}
    data = [(g, v) for g, vs in groups.items() for v in vs] + [("nulls", None), ("a", None)]
    df = spark.createDataFrame(data, "g string, v double")
    found = {r.g: r for r in exact_quantiles(df, ["g"], "v", median="m", count="n", mean="mean", std="std").collect()}
    for g, vs in groups.items():
        assert (found[g].n, found[g].m) == (len(vs), median(vs)) and found[g]["mean"] == pytest.approx(statistics.mean(vs), rel=1e-15)
        assert found[g]["std"] == (pytest.approx(statistics.stdev(vs)) if len(vs) > 1 else None)
    assert tuple(found["nulls"]) == ("nulls", None, 0, None, None)


def test_one_scan(spark):
    df = spark.range(1000).selectExpr("id % 7 AS g", "CAST(id AS DOUBLE) AS v")
    plan = exact_quantiles(df, ["g"], "v", QUANTILES, "median", count="n")
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.split("Initial Plan")[0].count("Range (") == 1


def test_against_sorting_with_a_hot_group_and_a_null_key(spark):
    rng = random.Random(7)
    groups = {"hot": [], "tiny": [3.5], None: [], "signs": []}
    groups["hot"] = [round(rng.lognormvariate(8, 2), 2) for _ in range(4000)]
    groups[None] = [float(rng.randint(0, 5)) for _ in range(300)]
    groups["signs"] = [rng.uniform(-1, 1) * 10 ** rng.randint(-12, 12) for _ in range(500)] + [0.0, -0.0]
    data = [(g, v) for g, vs in groups.items() for v in vs] + [("hot", None), ("only nulls", None)]
    rng.shuffle(data)
    assert run(spark, data) == expected(groups)


def test_one_value_repeated(spark):
    data = [("a", 5.0)] * 1000 + [("a", 7.0)]
    assert run(spark, data) == {"a": (5.0, 5.0, 5.0, 5.0)}


def test_extreme_doubles_keep_their_order(spark):
    values = [1e308, -1e308, 1e-320, 0.0, float("inf"), float("-inf"), 1e295, 2e295, -5e-324]
    data = [("a", v) for v in values]
    assert run(spark, data) == expected({"a": values})


def test_same_result_for_any_number_of_partitions(spark):
    rng = random.Random(3)
    data = [(rng.choice("ab"), rng.gauss(0, 1)) for _ in range(2000)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for n in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append(run(spark, data))
        assert results[0] == results[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, width=64), min_size=2, max_size=200))
def test_buckets_keep_order(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = df.select("v", value_bucket(F.col("v")).alias("b")).orderBy("v").collect()
    buckets = [r.b for r in found]
    assert buckets == sorted(buckets)


@pytest.mark.parametrize("digits", [0, 1, 2, 4, 5])
def test_rounding_is_that_of_python(spark, digits):
    rng = random.Random(digits)
    values = [rng.uniform(-1e6, 1e6) for _ in range(300)] + [2.5, 3.5, -2.5, 0.125, 0.375, 0.066125, 0.059625, 2.675, 1e300, 0.0]
    values += [(2 * rng.randint(-(10**7), 10**7) + 1) / (2 * 10**digits) for _ in range(700)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = df.select("v", round_half_even(F.col("v"), digits).alias("r")).collect()
    assert [(r.v, r.r) for r in found if r.r != round(r.v, digits)] == []
