"""Price prediction."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from checks import inputs
from checks.registry import check
from checks.sql import SILVER
from tripmart.config import scratch_path
from tripmart.operators import learning

FEATURES = (*learning.NUMERIC, *learning.CATEGORICAL)
_TRAINING = f"""{SILVER},
training AS (
  SELECT * REPLACE (CAST(is_weekend AS INTEGER) AS is_weekend) FROM silver
  WHERE {' AND '.join(f'{c} IS NOT NULL' for c in (*FEATURES, learning.TARGET))}
)"""
_KEYS = " || '|' || ".join(
    f"CAST(epoch_us({k}) AS VARCHAR)" if k.endswith("datetime") else f"CAST({k} AS VARCHAR)"
    for k in learning.SPLIT_KEYS
)
_BUCKET = f"CAST('0x' || substr(md5({_KEYS}), 1, 8) AS BIGINT) % 100"


def _rows(spark, sf_dir):
    return learning.training_rows(inputs.stored_silver(spark, sf_dir))


@check("ml_training_rows", f"WITH {_TRAINING} SELECT * FROM training")
def ml_training_rows(spark, sf_dir):
    return _rows(spark, sf_dir)


@check(
    "ml_content_split",
    f"""WITH {_TRAINING}
    SELECT CASE WHEN {_BUCKET} < 80 THEN 'train' ELSE 'test' END AS part, count(*) AS nb_rows,
      sum(total_amount) AS total, sum(DOLocationID)::BIGINT AS zones
    FROM training GROUP BY 1""",
)
def ml_content_split(spark, sf_dir):
    train, test = learning.content_split(_rows(spark, sf_dir))
    parts = train.withColumn("part", F.lit("train")).unionAll(
        test.withColumn("part", F.lit("test"))
    )
    return parts.groupBy("part").agg(
        F.count("*").alias("nb_rows"),
        F.sum("total_amount").alias("total"),
        F.sum("DOLocationID").alias("zones"),
    )


_INDEXED = _TRAINING + "".join(
    f""",
index_{c} AS (
  SELECT {c}, count(*) AS nb_rows, CAST(row_number() OVER (
    ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) - 1 AS DOUBLE) AS idx
  FROM training GROUP BY {c}
)"""
    for c in learning.CATEGORICAL
)


@check(
    "ml_label_indexes",
    f"WITH {_INDEXED} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column, CAST({c} AS VARCHAR) AS label, idx, nb_rows FROM index_{c}"
        for c in learning.CATEGORICAL
    ),
)
def ml_label_indexes(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    indexed = learning.label_indexer().fit(rows).transform(rows)
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(c).cast("string").alias("label"),
                F.col(f"{c}_idx").alias("idx"),
            )
            for c in learning.CATEGORICAL
        ]
    )
    listed = indexed.select(F.inline(entries))
    return listed.groupBy("column", "label", "idx").agg(F.count("*").alias("nb_rows"))


@check(
    "ml_feature_vectors",
    f"""WITH {_INDEXED}
    SELECT payment_type, count(*) AS nb_rows, """
    + ", ".join(
        f"CAST(sum({c}) AS DOUBLE) AS f{i}"
        for i, c in enumerate(
            [*learning.NUMERIC, *(f"index_{c}.idx" for c in learning.CATEGORICAL)]
        )
    )
    + " FROM training "
    + " ".join(f"JOIN index_{c} USING ({c})" for c in learning.CATEGORICAL)
    + " GROUP BY payment_type",
)
def ml_feature_vectors(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    vectors = learning.fit_features(rows).transform(rows)
    values = vectors.select("payment_type", vector_to_array("features").alias("v"))
    sums = [F.sum(F.col("v")[i]).alias(f"f{i}") for i in range(len(FEATURES))]
    return values.groupBy("payment_type").agg(F.count("*").alias("nb_rows"), *sums)


@check(
    "ml_linear_one_feature",
    f"""WITH {_TRAINING}
    SELECT round(regr_slope(total_amount, fare_amount), 6) AS slope,
      round(regr_intercept(total_amount, fare_amount), 6) AS intercept FROM training""",
)
def ml_linear_one_feature(spark, sf_dir):
    """The linear estimator on a single feature, where a closed form exists."""
    rows = _rows(spark, sf_dir)
    assembled = VectorAssembler(inputCols=["fare_amount"], outputCol="features").transform(rows)
    model = learning.estimators()[learning.LINEAR].fit(assembled)
    line = [(float(model.coefficients[0]), float(model.intercept))]
    fitted = spark.createDataFrame(line, "slope double, intercept double")
    return fitted.select(*[F.round(c, 6).alias(c) for c in fitted.columns])


# fixed predictors whose errors SQL can compute as well
_PREDICTORS = {
    "fare": "fare_amount",
    "fare_and_tip": "fare_amount + coalesce(tip_amount, 0)",
    "distance": "3 + 2.5e0 * trip_distance",
}
_METRICS = f"""{_TRAINING}, metrics AS (""" + " UNION ALL ".join(
    f"""SELECT '{name}' AS model, avg(abs(total_amount - ({sql}))) AS mae,
      sqrt(avg(pow(total_amount - ({sql}), 2))) AS rmse,
      1 - sum(pow(total_amount - ({sql}), 2)) / (var_pop(total_amount) * count(*)) AS r2
    FROM training"""
    for name, sql in _PREDICTORS.items()
) + ")"


def _metrics(spark, sf_dir):
    columns = {name: f"by_{name}" for name in _PREDICTORS}
    scored = _rows(spark, sf_dir).withColumns(
        {columns[name]: F.expr(sql) for name, sql in _PREDICTORS.items()}
    )
    return learning.regression_metrics(scored, columns)


@check(
    "ml_regression_metrics",
    f"WITH {_METRICS} SELECT model, round(mae, 6) AS mae, round(rmse, 6) AS rmse, "
    "round(r2, 6) AS r2 FROM metrics",
)
def ml_regression_metrics(spark, sf_dir):
    metrics = _metrics(spark, sf_dir)
    return metrics.select("model", *[F.round(c, 6).alias(c) for c in ("mae", "rmse", "r2")])


@check(
    "ml_best_model", f"WITH {_METRICS} SELECT model FROM metrics ORDER BY rmse, model LIMIT 1"
)
def ml_best_model(spark, sf_dir):
    return learning.best_model(_metrics(spark, sf_dir)).select("model")


# a price that is an exact linear combination of features, so that SQL knows every prediction
_EXACT = "2.5e0 + 3.0e0 * trip_distance - 1.5e0 * passenger_count + 0.25e0 * pickup_hour + 4.0e0 * is_weekend"


@check(
    "ml_linear_predictions",
    f"""WITH {_TRAINING}
    SELECT pickup_datetime, DOLocationID, round({_EXACT}, 4) AS prediction
    FROM training WHERE {_BUCKET} >= 80""",
)
def ml_linear_predictions(spark, sf_dir):
    """The whole pipeline of eight features on a price that it can learn exactly."""
    exact = F.expr(_EXACT.replace("e0", "D"))
    rows = _rows(spark, sf_dir).withColumn(learning.TARGET, exact)
    train, test = learning.content_split(rows)
    features = learning.fit_features(train)
    model = learning.estimators()[learning.LINEAR].fit(features.transform(train))
    scored = model.transform(features.transform(test))
    # no negative zero, which SQL would print otherwise
    prediction = F.round("prediction", 4) + F.lit(0.0)
    return scored.select("pickup_datetime", "DOLocationID", prediction.alias("prediction"))


@check(
    "ml_model_comparison",
    f"""WITH {_TRAINING}, sizes AS (
      SELECT count(CASE WHEN {_BUCKET} < 80 THEN 1 END) AS nb_train,
        count(CASE WHEN {_BUCKET} >= 80 THEN 1 END) AS nb_test FROM training)
    SELECT model, nb_train, nb_test, nb_test AS nb_scored, true AS within_range, 0 AS nb_changed
    FROM sizes, (SELECT unnest(['{learning.LINEAR}', '{learning.FOREST}']) AS model)""",
)
def ml_model_comparison(spark, sf_dir):
    """Both models fitted, compared, saved and reloaded.

    A forest averages prices that it has seen, so its predictions lie within their range; the
    linear model is held to finite numbers. A reloaded model may not change any prediction.
    """
    trips = inputs.stored_silver(spark, sf_dir)
    training = learning.train_and_compare(trips)
    train, test = learning.content_split(learning.training_rows(trips))
    low, high = train.agg(F.min(learning.TARGET), F.max(learning.TARGET)).first()
    parts = []
    for name, pipeline in training.pipelines.items():
        path = scratch_path(spark, "model")
        learning.save_model(pipeline, path)
        once = pipeline.transform(test).withColumnRenamed("prediction", "before")
        both = learning.load_model(path).transform(once.drop("features", *[f"{c}_idx" for c in learning.CATEGORICAL]))
        known = F.col("prediction").isNotNull() & ~F.isnan("prediction")
        if name == learning.FOREST:
            known = F.col("prediction").between(low, high)
        parts.append(
            both.agg(
                F.count("*").alias("nb_scored"),
                F.bool_and(known).alias("within_range"),
                F.sum(F.when(F.col("prediction") == F.col("before"), 0).otherwise(1)).cast("int").alias("nb_changed"),
            ).select(
                F.lit(name).alias("model"),
                F.lit(training.sizes["train"]).cast("bigint").alias("nb_train"),
                F.lit(training.sizes["test"]).cast("bigint").alias("nb_test"),
                "nb_scored", "within_range", "nb_changed",
            )
        )
    ranked = [row["model"] for row in training.comparison.collect()]
    assert sorted(ranked) == sorted(training.pipelines) and ranked[0] == training.best
    return parts[0].unionByName(parts[1])


_ENCODED = f"""{_TRAINING},
train AS (SELECT *, {_BUCKET} AS bucket FROM training WHERE {_BUCKET} < 80),
codes AS ({" UNION ALL ".join(
    f"SELECT '{c}' AS name, CAST({c} AS DOUBLE) AS code, bucket % 5 AS fold, total_amount FROM train"
    for c in learning.CATEGORICAL)}),
cells AS (SELECT DISTINCT name, code, fold FROM codes),
others AS (
  SELECT c.name, c.code, c.fold, count(o.code) AS n, coalesce(sum(o.total_amount), 0) AS total
  FROM cells c LEFT JOIN codes o ON o.name = c.name AND o.code = c.code AND o.fold <> c.fold GROUP BY ALL),
priors AS (
  SELECT f.fold, avg(total_amount) AS prior FROM (SELECT DISTINCT fold FROM cells) f
  JOIN train ON train.bucket % 5 <> f.fold GROUP BY ALL)"""


@check(
    "ml_target_encoding",
    f"""WITH {_ENCODED}
    SELECT name AS "column", code, fold, round((total + 20 * prior) / (n + 20), 6) AS encoded
    FROM others JOIN priors USING (fold)""",
)
def ml_target_encoding(spark, sf_dir):
    """The mean price of a code in the other folds, for each code and fold."""
    train, _ = learning.content_split(_rows(spark, sf_dir))
    encodings = learning.out_of_fold_encodings(learning.target_statistics(train))
    return encodings.withColumn("encoded", F.round("encoded", 6))


@check(
    "ml_target_coded_rows",
    f"""WITH {_ENCODED}
    SELECT t.bucket % 5 AS fold, count(*) AS nb_rows, {", ".join(
        f"round(sum((e_{c}.total + 20 * prior) / (e_{c}.n + 20)), 3) AS {c}" for c in learning.CATEGORICAL)}
    FROM train t JOIN priors ON priors.fold = t.bucket % 5 {" ".join(
        f"JOIN others e_{c} ON e_{c}.name = '{c}' AND e_{c}.code = t.{c} AND e_{c}.fold = t.bucket % 5"
        for c in learning.CATEGORICAL)}
    GROUP BY 1""",
)
def ml_target_coded_rows(spark, sf_dir):
    """All train rows with their codes from the other folds, summed by fold."""
    train, _ = learning.content_split(_rows(spark, sf_dir))
    coded = learning.with_out_of_fold(train, learning.out_of_fold_encodings(learning.target_statistics(train)))
    return coded.groupBy(learning.fold_of(coded).alias("fold")).agg(
        F.count("*").alias("nb_rows"),
        *[F.round(F.sum(f"{c}_enc"), 3).alias(c) for c in learning.CATEGORICAL],
    )
