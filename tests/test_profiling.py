from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
import pytest

from tripmart.operators import profiling, quantiles

NAN, INF = float("nan"), float("inf")


def frame(spark, values):
    rows = [(None if v is None else float(v),) for v in values]
    return spark.createDataFrame(rows, "v double")


def test_describe_equals_pandas(spark):
    rng = random.Random(7)
    rows = [
        (rng.gauss(10, 3), float(rng.randrange(5)), None if rng.random() < 0.2 else rng.random(), 7)
        for _ in range(501)
    ]
    df = spark.createDataFrame(rows, "a double, b double, c double, d int")
    ours = {r["column"]: r for r in profiling.describe(df, ("a", "b", "c", "d")).collect()}
    expected = pd.DataFrame(rows, columns=list("abcd")).describe()
    for name in "abcd":
        row = ours[name]
        got = [row[x] for x in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")]
        assert got == pytest.approx(expected[name].tolist(), rel=1e-12)


@pytest.mark.parametrize(
    "values",
    [
        [1.0, 2.0, 3.0, 4.0],
        [5.0] * 100,
        [0.0] * 300 + [1.0],
        [1e300, -1e300, 0.0, 1.0, 2.0, 1.5e308, -1.7e308],
        [5e-324, 0.0, 1e-323, 1.5e-323],
        list(np.exp(np.random.default_rng(1).normal(0, 30, 700))),
        [1e9, *np.random.default_rng(2).random(900)],
        [float(i) for i in range(5000)],
    ],
)
def test_quantiles_equal_sorted_positions(spark, values):
    probabilities = (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)
    found = quantiles.exact_quantiles(frame(spark, values), ["v"], probabilities)["v"]
    ordered = sorted(values)
    for p, got in zip(probabilities, found):
        place = p * (len(ordered) - 1)
        low, high = ordered[math.floor(place)], ordered[math.ceil(place)]
        share = place - math.floor(place)
        assert got == (low if low == high else low * (1 - share) + high * share)


def test_quantiles_with_infinities_nan_and_null(spark):
    df = frame(spark, [-INF, 1.0, 2.0, 3.0, INF, NAN, None])
    found = quantiles.exact_quantiles(df, ["v"], (0.0, 0.25, 0.5, 0.75, 1.0))["v"]
    assert found == [-INF, 1.0, 2.0, 3.0, INF]


def test_quantiles_of_nothing(spark):
    assert quantiles.exact_quantiles(frame(spark, [None, NAN]), ["v"], (0.5,)) == {"v": [None]}
    row = profiling.describe(frame(spark, [None]), ("v",)).first()
    assert (row["count"], row["mean"], row["p50"]) == (0, None, None)


def test_approximate_quartiles_are_close(spark):
    df = frame(spark, [float(i) for i in range(1001)])
    row = profiling.approximate_describe(df, ("v",)).first()
    assert row["count"] == 1001
    assert [row["p25"], row["p50"], row["p75"]] == pytest.approx([250, 500, 750], abs=2)


def test_histogram_equals_numpy(spark):
    values = list(np.random.default_rng(3).normal(0, 1, 2000))
    rows = profiling.histogram(frame(spark, values), "v").orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=60)
    assert [r["nb_trips"] for r in rows] == counts.tolist()
    assert [r["bin_start"] for r in rows] == pytest.approx(edges[:-1].tolist())


def test_histogram_of_equal_values_and_of_nothing(spark):
    rows = profiling.histogram(frame(spark, [4.0, 4.0, None]), "v").collect()
    assert len(rows) == 60 and sum(r["nb_trips"] for r in rows) == 2
    assert profiling.histogram(frame(spark, [None]), "v").count() == 0


def test_largest_value_is_in_the_last_bin(spark):
    rows = profiling.histogram(frame(spark, [0.0, 1.0, 60.0]), "v").orderBy("bin").collect()
    assert rows[59]["nb_trips"] == 1 and rows[1]["nb_trips"] == 1


def test_density_is_close_to_the_direct_sum(spark):
    values = np.random.default_rng(4).normal(50, 9, 800)
    rows = profiling.density(frame(spark, values.tolist()), "v").orderBy("point").collect()
    h = values.std(ddof=1) * len(values) ** -0.2
    grid = np.linspace(values.min(), values.max(), 200)
    direct = np.exp(-0.5 * ((grid[:, None] - values) / h) ** 2).sum(axis=1)
    direct *= (values.max() - values.min()) / 60 / (h * math.sqrt(2 * math.pi))
    assert [r["x"] for r in rows] == pytest.approx(grid.tolist())
    assert [r["density"] for r in rows] == pytest.approx(direct.tolist(), abs=1e-2)
    assert profiling.density(frame(spark, [3.0, 3.0]), "v").count() == 0


def test_exact_density_is_the_direct_sum(spark):
    # two values in one bin of a sixteenth of the bandwidth, which a bin at their mean does not keep apart
    values = np.array([0.0, 0.01, 0.01, 5.0, 40.0, 40.02, 41.0, 100.0])
    rows = profiling.exact_density(frame(spark, [*values.tolist(), None]), "v").orderBy("point").collect()
    h = values.std(ddof=1) * len(values) ** -0.2
    grid = np.linspace(0.0, 100.0, 200)
    direct = np.exp(-0.5 * ((grid[:, None] - values) / h) ** 2).sum(1) * (100.0 / 60) / (h * np.sqrt(2 * np.pi))
    assert [r["density"] for r in rows] == pytest.approx(direct.tolist(), rel=1e-9)
    assert profiling.exact_density(frame(spark, [3.0, 3.0]), "v").count() == 0


def test_box_statistics(spark):
    df = frame(spark, [1.0, 2.0, 3.0, 4.0, 5.0, 100.0, -90.0, None])
    row = profiling.box_statistics(df, ("v",)).first()
    assert (row["q1"], row["median"], row["q3"]) == (1.5, 3.0, 4.5)
    assert (row["whisker_low"], row["whisker_high"], row["nb_outliers"]) == (1.0, 5.0, 2)


def test_box_statistics_of_nothing(spark):
    row = profiling.box_statistics(frame(spark, [None]), ("v",)).first()
    assert (row["q1"], row["whisker_low"], row["nb_outliers"]) == (None, None, 0)


def test_correlations_equal_pandas(spark):
    rng = np.random.default_rng(5)
    data = pd.DataFrame(rng.normal(size=(300, 3)), columns=list("abc"))
    data["b"] += data["a"]
    data.loc[::7, "c"] = None
    data["k"] = 1.0
    rows = [tuple(None if pd.isna(v) else float(v) for v in r) for r in data.to_numpy()]
    df = spark.createDataFrame(rows, "a double, b double, c double, k double")
    expected = data.corr()
    cells = profiling.correlation_matrix(df, list("abck")).collect()
    assert len(cells) == 16
    for cell in cells:
        wanted = expected.loc[cell["x"], cell["y"]]
        if "k" in (cell["x"], cell["y"]):
            assert cell["r"] is None
        else:
            assert cell["r"] == pytest.approx(wanted, rel=1e-9)


def test_correlations_of_nothing_are_null(spark):
    empty = spark.createDataFrame([], "a double, b double")
    assert [r["r"] for r in profiling.correlation_matrix(empty, ["a", "b"]).collect()] == [None] * 4


def test_counts_leave_out_nulls(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "PULocationID bigint")
    assert [tuple(r) for r in profiling.counts_by(df, "PULocationID").collect()] == [(1, 2), (2, 1)]
    assert [tuple(r) for r in profiling.top_values(df, "PULocationID", 1).collect()] == [(1, 2)]


def test_weekdays_without_trips_show_zero(spark):
    df = spark.createDataFrame([(2,), (2,), (1,)], "pickup_dayofweek int")
    rows = profiling.counts_by_weekday(df).collect()
    assert [r["day_label"] for r in rows] == ["Lun", "Mar", "Mer", "Jeu", "Ven", "Sam", "Dim"]
    assert [r["nb_trips"] for r in rows] == [2, 0, 0, 0, 0, 0, 1]


def test_missing_values_count_nan_and_skip_full_columns(spark):
    df = spark.createDataFrame(
        [(1, NAN, None), (2, None, None), (3, 1.0, "x")], "a int, b double, c string"
    )
    rows = [tuple(r) for r in profiling.missing_values(df).collect()]
    assert rows == [("b", 2), ("c", 2)]


def test_column_info(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    rows = profiling.column_info(df).orderBy("position").collect()
    assert [(r["nb_rows"], r["column"], r["dtype"], r["non_null"]) for r in rows] == [
        (2, "a", "int", 2),
        (2, "b", "string", 1),
    ]
