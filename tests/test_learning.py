from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from plans import plan_of
from tripmart.operators import learning
from tripmart.operators.cleaning import clean
from tripmart.plans.full_run import run_all
from tripmart.plans.training import run_training
from tripmart.sinks.tables import write_silver


def many(trips, n=600, zones=300):
    """Trips whose price is a line in the distance."""
    start = datetime(2024, 3, 4)
    rows = []
    for i in range(n):
        pickup = start + timedelta(minutes=37 * i)
        distance = 1.0 + i % 90
        rows.append(
            {
                "pickup_datetime": pickup,
                "dropoff_datetime": pickup + timedelta(minutes=10),
                "trip_distance": distance,
                "total_amount": 3.0 + 2.5 * distance,
                "PULocationID": i % zones,
                "DOLocationID": i % 7,
                "payment_type": i % 3,
                "passenger_count": float(1 + i % 4),
            }
        )
    return clean(trips(*rows))


def test_training_rows(trips):
    silver = clean(trips({}, {"PULocationID": None}, {"payment_type": None}, {"tip_amount": None}))
    rows = learning.training_rows(silver)
    assert rows.count() == 2
    assert rows.schema["is_weekend"].dataType.simpleString() == "int"


def test_split_depends_on_content_only(trips):
    rows = learning.training_rows(many(trips))
    train, test = learning.content_split(rows)
    assert train.count() + test.count() == 600
    assert 0.75 < train.count() / 600 < 0.85
    moved = learning.content_split(rows.repartition(7).orderBy(F.desc("total_amount")))[0]
    assert sorted(moved.collect()) == sorted(train.collect())
    random_train, random_test = learning.random_split(rows)
    assert random_train.count() + random_test.count() == 600


def test_unseen_zone_has_its_own_index(trips):
    rows = learning.training_rows(many(trips, zones=5))
    features = learning.fit_features(rows)
    unseen = features.transform(rows.withColumn("PULocationID", F.lit(999).cast("bigint")))
    assert {r[0] for r in unseen.select("PULocationID_idx").collect()} == {5.0}
    assert learning.forest_bins(features) == 32


def test_too_many_labels_are_refused(trips):
    rows = learning.training_rows(many(trips))
    with pytest.raises(learning.TooManyLabels, match="PULocationID"):
        learning.check_label_counts(rows, limit=100)
    with pytest.raises(learning.TooManyLabels):
        learning.fit_features(rows, max_labels=100)
    learning.fit_features(rows)


def test_one_hot_is_optional(trips):
    rows = learning.training_rows(many(trips, n=60, zones=4))
    plain = learning.fit_features(rows).transform(rows).first()["features"]
    wide = learning.fit_features(rows, one_hot=True).transform(rows).first()["features"]
    assert len(plain) == 8 and len(wide) > 8


def test_metrics_equal_the_evaluator(spark):
    df = spark.createDataFrame(
        [(1.0, 1.5), (2.0, 1.0), (4.0, 4.5), (8.0, 7.0)], "total_amount double, p double"
    )
    row = learning.regression_metrics(df, {"m": "p"}).first()
    for name in ("mae", "rmse", "r2"):
        evaluator = RegressionEvaluator(
            labelCol="total_amount", predictionCol="p", metricName=name
        )
        assert row[name] == pytest.approx(evaluator.evaluate(df), rel=1e-12)


def test_metrics_of_a_constant_target(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "total_amount double, p double")
    assert learning.regression_metrics(df, {"m": "p"}).first()["r2"] is None


def test_linear_price_is_learnt_and_saved(spark, trips, tmp_path):
    silver = many(trips)
    write_silver(silver, str(tmp_path / "s"))
    training = run_training(spark, str(tmp_path / "s"), str(tmp_path / "m"))
    assert training.best == learning.LINEAR
    best = training.comparison.first()
    assert best["model"] == learning.LINEAR
    assert best["r2"] == pytest.approx(1.0) and best["rmse"] < 1e-6
    forest = training.pipelines[learning.FOREST].stages[-1]
    assert forest.getNumTrees == 50 and forest.getOrDefault("maxDepth") == 8
    assert forest.getOrDefault("maxBins") > 250
    rows = learning.training_rows(silver)
    reloaded = learning.load_model(str(tmp_path / "m")).transform(rows)
    kept = training.best_pipeline.transform(rows)
    assert sorted(reloaded.select("prediction").collect()) == sorted(
        kept.select("prediction").collect()
    )


def test_all_jobs_from_raw_files_to_model(spark, trips, tmp_path):
    raw = many(trips, n=120, zones=4).select(*trips({}).columns)
    raw.write.parquet(str(tmp_path / "raw" / "taxi"))
    result = run_all(spark, str(tmp_path / "raw"), str(tmp_path / "lake"))
    assert result.landed["taxi"] > 0 and result.landed["news"] == 0
    assert result.silver.rows_in == result.silver.rows_out == 120
    assert result.kpis["kpi_global_summary"] == 1
    assert (tmp_path / "lake" / "models" / "taxi_price" / "stages").exists()
    runs = spark.read.parquet(str(tmp_path / "lake" / "run_metrics")).collect()
    assert {r["job"]: r["rows_out"] for r in runs} == {
        "land taxi": result.landed["taxi"], "land weather": 0, "land news": 0, "silver": 120,
        "gold": sum(result.kpis.values()), "training": 120,
    }
    compared = spark.read.parquet(str(tmp_path / "lake" / "models" / "taxi_price_comparison"))
    assert {r["model"] for r in compared.collect()} == {learning.LINEAR, learning.FOREST}


# target encoding


def test_codes_say_nothing_about_their_own_fold(trips):
    train, _ = learning.content_split(learning.training_rows(many(trips, n=400, zones=9)))
    coded = learning.with_out_of_fold(train, learning.out_of_fold_encodings(learning.target_statistics(train), 3.0))
    assert sorted(coded.columns) == sorted([*train.columns, *[f"{c}_enc" for c in learning.CATEGORICAL]])
    rows = coded.withColumn("fold", learning.fold_of(coded)).collect()
    assert len(rows) == train.count()
    for name in learning.CATEGORICAL:
        for row in rows[::37]:
            others = [r["total_amount"] for r in rows if r["fold"] != row["fold"]]
            same = [r["total_amount"] for r in rows if r["fold"] != row["fold"] and r[name] == row[name]]
            prior = sum(others) / len(others)
            assert row[f"{name}_enc"] == pytest.approx((sum(same) + 3 * prior) / (len(same) + 3))


def test_codes_of_one_fold_and_unseen_codes(trips):
    rows = learning.training_rows(many(trips, n=200, zones=200))
    train, test = learning.content_split(rows)
    features, assembled = learning.fit_target_features(train)
    assert assembled.count() == train.count()  # a code that only one fold has is coded by the mean
    mean = train.agg(F.avg("total_amount")).first()[0]
    coded = features.transform(test).select("PULocationID_enc").collect()
    assert {round(r[0], 6) for r in coded} == {round(mean, 6)} and len(coded) == test.count()


def test_target_coded_training_is_saved_and_read(spark, trips, tmp_path):
    silver = many(trips)
    write_silver(silver, str(tmp_path / "s"))
    training = run_training(spark, str(tmp_path / "s"), str(tmp_path / "m"), target_coded=True)
    assert training.best == learning.LINEAR and training.comparison.first()["r2"] == pytest.approx(1.0)
    forest = training.pipelines[learning.FOREST].stages[-1]
    assert forest.getOrDefault("maxBins") == learning.DEFAULT_BINS
    rows = learning.training_rows(silver)
    reloaded = learning.load_model(str(tmp_path / "m")).transform(rows)
    kept = training.best_pipeline.transform(rows)
    assert sorted(reloaded.select("prediction").collect()) == sorted(kept.select("prediction").collect())
    assert training.sizes["train"] + training.sizes["test"] == 600


def test_codes_travel_to_the_rows_and_are_computed_once(trips):
    train, _ = learning.content_split(learning.training_rows(many(trips, n=200, zones=9)))
    coded = learning.with_out_of_fold(train, learning.out_of_fold_encodings(learning.target_statistics(train)))
    plan = plan_of(coded, "simple")
    assert plan.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in plan
    # the rows alone, no statistics
    assert plan.count("HashAggregate") == plan_of(train, "simple").count("HashAggregate")
    assert coded.count() == train.count()
    none = train.limit(0)
    assert learning.with_out_of_fold(none, learning.out_of_fold_encodings(learning.target_statistics(none))).count() == 0


def test_statistics_of_codes_are_counted_once(trips):
    train, _ = learning.content_split(learning.training_rows(many(trips, n=200, zones=9)))
    plan = plan_of(learning.out_of_fold_encodings(learning.target_statistics(train)), "simple")
    assert "FileScan" in plan and "explode" not in plan


def test_rows_keep_their_nodes_and_the_forest_is_the_same(trips):
    """Also over many passes, after which the kept nodes are checkpointed."""
    train = learning.training_rows(many(trips, zones=40))
    features = learning.fit_features(train)
    rows = features.transform(train).select("features", learning.TARGET).persist()
    forest = learning.estimators(learning.forest_bins(features))[learning.FOREST]
    assert forest.getCacheNodeIds()
    forest = forest.copy({forest.numTrees: 4, forest.checkpointInterval: 2, forest.maxMemoryInMB: 1, forest.maxDepth: 6})
    kept = forest.fit(rows).toDebugString
    assert kept.count("\n") > 50
    assert kept.split("\n")[1:] == forest.copy({forest.cacheNodeIds: False}).fit(rows).toDebugString.split("\n")[1:]
    rows.unpersist()
