import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.functions import exact_percentiles, places, running_shares

PERCENTILES = {"lo": 0.0, "q1": 0.25, "median": 0.5, "p90": 0.9, "hi": 1.0}


@pytest.mark.parametrize(
    "values",
    [
        [7],
        [1, 2],
        [5] * 900 + list(range(100)),
        list(range(-50, 51)),
        [-(2**40), -3, 0, 2**20 - 1, 2**20, 2**45],
        [int(x) for x in np.random.default_rng(3).integers(-(2**30), 2**30, 501)],
    ],
)
def test_percentiles_match_linear_interpolation(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v bigint")
    got = exact_percentiles(df, "v", PERCENTILES).first().asDict()
    for name, p in PERCENTILES.items():
        assert got[name] == pytest.approx(np.percentile(values, p * 100), rel=1e-12)


def test_percentiles_by_group(spark):
    rng = np.random.default_rng(5)
    rows = [(g, int(v)) for g in (1, 2, 3) for v in rng.integers(0, 5_000_000, 40 * g)]
    df = spark.createDataFrame(rows, "g int, v bigint")
    for r in exact_percentiles(df, "v", {"q1": 0.25, "q3": 0.75}, by=["g"]).collect():
        values = [v for g, v in rows if g == r.g]
        assert (r.q1, r.q3) == pytest.approx(tuple(np.percentile(values, [25, 75])))


def test_percentile_of_no_rows_is_no_row(spark):
    df = spark.createDataFrame([], "v bigint")
    assert exact_percentiles(df, "v", {"m": 0.5}).first().m is None


def test_running_shares_of_far_apart_values(spark):
    values = [0, 1, 1, 2**20 - 1, 2**20, 2**21, 2**33]
    df = spark.createDataFrame([(v, i % 2 == 0) for i, v in enumerate(values)], "v bigint, even boolean")
    got = running_shares(df, "v", {"even": F.col("even"), "odd": ~F.col("even")}).collect()
    for r in got:
        even = [v for i, v in enumerate(values) if i % 2 == 0]
        assert r.even == pytest.approx(sum(v <= r.v for v in even) / len(even))
        assert r.even_rows == 4 and r.odd_rows == 3


@pytest.mark.parametrize("values", [[0.2, 0.4, 0.9], [float(x) for x in np.random.default_rng(4).normal(size=300)]])
def test_percentiles_of_doubles(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    got = exact_percentiles(df, "v", PERCENTILES).first().asDict()
    for name, p in PERCENTILES.items():
        assert got[name] == pytest.approx(np.percentile(values, p * 100), rel=1e-12)


def test_shares_of_doubles_inside_one_unit(spark):
    df = spark.createDataFrame([(0.1, True), (0.2, True), (0.8, False), (0.9, False)], "v double, old boolean")
    rows = {r.v: (r.a, r.b) for r in running_shares(df, "v", {"a": F.col("old"), "b": ~F.col("old")}).collect()}
    assert rows == {0.1: (0.5, 0.0), 0.2: (1.0, 0.0), 0.8: (1.0, 0.5), 0.9: (1.0, 1.0)}


def test_places_with_a_common_prefix(spark):
    """Text that differs late, in falling and rising order, over several ranges."""
    rows = [(f"SKU{i:05d}", i % 3) for i in range(3000)]
    df = spark.createDataFrame(rows, "name string, n int").repartition(6)
    got = [r.name for r in places(df, F.desc("n"), F.col("name")).orderBy("place").collect()]
    assert got == [name for name, _ in sorted(rows, key=lambda r: (-r[1], r[0]))]
    assert [r.place for r in places(df, F.desc("n"), F.col("name")).orderBy("place").collect()] == list(range(3000))
