"""Price prediction: training rows, split, features, two regressors, comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import (
    OneHotEncoder,
    SQLTransformer,
    StringIndexer,
    StringIndexerModel,
    TargetEncoder,
    VectorAssembler,
)
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tripmart.config import scratch_path
from tripmart.functions.columns import free_name

# fixed values: what the models learn from, and how
TARGET = "total_amount"
CATEGORICAL = ("PULocationID", "DOLocationID", "payment_type")
NUMERIC = ("trip_distance", "passenger_count", "pickup_hour", "pickup_dayofweek", "is_weekend")
TRAIN_PERCENT = 80
SEED = 42
TREES, DEPTH = 50, 8
LINEAR, FOREST = "Régression linéaire", "Random Forest Regressor"

# what identifies a trip for the split: times and codes, no floating-point columns
SPLIT_KEYS = (
    "pickup_datetime",
    "dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "passenger_count",
    "payment_type",
)
DEFAULT_BINS = 32
# folds of the train rows for target encoding, and how many rows the mean of all codes weighs
FOLDS, SMOOTHING = 5, 20.0
# split statistics a task may hold; more of it means fewer passes over the rows per tree level
FOREST_MEMORY_MB = 512


def training_rows(trips: DataFrame) -> DataFrame:
    """Trips with the weekend flag as a number and without nulls in features and target."""
    numbers = trips.withColumn("is_weekend", F.col("is_weekend").cast("int"))
    return numbers.dropna(subset=[*CATEGORICAL, *NUMERIC, TARGET])


def split_bucket(df: DataFrame, keys: Sequence[str] = SPLIT_KEYS) -> Column:
    """A number from 0 to 99 that depends on the content of the keys only."""

    def text(name: str) -> Column:
        value = F.col(name)
        if df.schema[name].dataType.typeName() in ("timestamp", "timestamp_ntz"):
            value = F.unix_micros(value.cast("timestamp"))
        return F.coalesce(value.cast("string"), F.lit(""))

    digest = F.md5(F.concat_ws("|", *[text(name) for name in keys]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100


def content_split(
    df: DataFrame, percent: int = TRAIN_PERCENT, keys: Sequence[str] = SPLIT_KEYS
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of their content.

    Unlike a random split, a row is on the same side in every run, on every cluster and after
    the loss of an executor, and equal rows never lie on both sides.
    """
    bucket = split_bucket(df, keys)
    return df.where(bucket < percent), df.where(bucket >= percent)


def random_split(
    df: DataFrame, percent: int = TRAIN_PERCENT, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Spark's random split; which rows it picks depends on the partitioning."""
    train, test = df.randomSplit([percent / 100, 1 - percent / 100], seed=seed)
    return train, test


class TooManyLabels(ValueError):
    """A column has too many distinct values to be indexed."""


def check_label_counts(
    df: DataFrame, limit: int, columns: Sequence[str] = CATEGORICAL
) -> None:
    """Fail early where a column has more labels than the caller allows, by an exact count."""
    row = df.agg(*[F.count_distinct(c).alias(c) for c in columns]).first()
    excess = [f"{c} ({row[c]})" for c in columns if row[c] > limit]
    if excess:
        raise TooManyLabels(f"more than {limit} labels in {', '.join(excess)}")


def label_indexer(columns: Sequence[str] = CATEGORICAL) -> StringIndexer:
    """Most frequent label first, ties in text order; labels unseen in training come last."""
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{c}_idx" for c in columns],
        handleInvalid="keep",
    )


def feature_stages(one_hot: bool = False) -> list:
    """Index the codes and assemble all features; indexes count as numbers unless ``one_hot``."""
    stages: list = [label_indexer()]
    coded = [f"{c}_idx" for c in CATEGORICAL]
    if one_hot:
        vectors = [f"{c}_vec" for c in CATEGORICAL]
        stages.append(OneHotEncoder(inputCols=coded, outputCols=vectors, handleInvalid="keep"))
        coded = vectors
    stages.append(
        VectorAssembler(
            inputCols=[*NUMERIC, *coded], outputCol="features", handleInvalid="skip"
        )
    )
    return stages


def fit_features(
    train: DataFrame, one_hot: bool = False, max_labels: int | None = None
) -> PipelineModel:
    """The feature pipeline, fitted once and shared by all estimators.

    The indexes live on the driver and in every task; ``max_labels`` refuses columns with more
    labels than that, by default there is no limit.
    """
    if max_labels is not None:
        check_label_counts(train, max_labels)
    return Pipeline(stages=feature_stages(one_hot)).fit(train)


def fold_of(df: DataFrame, folds: int = FOLDS) -> Column:
    """The fold of a train row: like the split, it depends on the content only."""
    return split_bucket(df) % folds


def target_statistics(train: DataFrame, columns: Sequence[str] = CATEGORICAL) -> DataFrame:
    """column, code, fold, nb_rows, total: what each fold says of each code, in one scan.

    The groups are combined before the shuffle, so a code with most of the rows sends one row a task.
    """
    codes = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("code")) for c in columns])
    entries = train.select(fold_of(train).alias("fold"), TARGET, F.explode(codes).alias("e"))
    return entries.groupBy("e.column", "e.code", "fold").agg(
        F.count("*").alias("nb_rows"), F.sum(TARGET).alias("total")
    )


def out_of_fold_encodings(statistics: DataFrame, smoothing: float = SMOOTHING, folds: int = FOLDS) -> DataFrame:
    """column, code, fold, encoded: the mean target of a code in all other folds.

    Means of few rows are drawn to that of all codes, which weighs as much as ``smoothing`` rows;
    it leaves the fold out too. A code that only its own fold has gets that mean. So no row says
    anything about its own target. A table of codes times folds, which never is on the driver.
    The statistics are read four times, so they are written once, below the scratch folder.
    """
    folder = scratch_path(statistics.sparkSession, "statistics")
    statistics.write.parquet(folder)
    statistics = statistics.sparkSession.read.schema(statistics.schema).parquet(folder)
    by_code = statistics.groupBy("column", "code").agg(F.sum("nb_rows").alias("rows"), F.sum("total").alias("sum"))
    by_fold = statistics.groupBy("column", "fold").agg(F.sum("nb_rows").alias("fold_rows"), F.sum("total").alias("fold_sum"))
    whole = by_fold.groupBy("column").agg(F.sum("fold_rows").alias("all_rows"), F.sum("fold_sum").alias("all_sum"))
    own = (
        statistics.join(by_code, ["column", "code"])
        .join(F.broadcast(by_fold), ["column", "fold"])  # a row a column and fold
        .join(F.broadcast(whole), "column")  # a row a column
    )
    prior = F.try_divide(F.col("all_sum") - F.col("fold_sum"), F.col("all_rows") - F.col("fold_rows"))
    prior = F.coalesce(prior, F.lit(0.0))
    rows, total = F.col("rows") - F.col("nb_rows"), F.col("sum") - F.col("total")
    encoded = F.try_divide(total + prior * smoothing, rows + F.lit(smoothing))
    return own.select("column", "code", "fold", F.coalesce(encoded, prior).alias("encoded"))


def _stored_by_column(encodings: DataFrame, columns: Sequence[str]) -> list[DataFrame]:
    """The encodings of each column, from a file table written in one run, so that their sizes are known."""
    spark = encodings.sparkSession
    number = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("column"))
    folder = scratch_path(spark, "encodings")
    parts = encodings.select("code", "fold", "encoded", number.alias("part")).where("part > 0")
    parts.write.partitionBy("part").parquet(folder)
    whole = spark.read.schema(parts.schema).parquet(folder)
    known = {row["part"] for row in whole.select("part").distinct().collect()}
    bare = whole.drop("part").schema
    return [
        spark.read.schema(bare).parquet(f"{folder}/part={n}") if n in known else whole.drop("part").limit(0)
        for n in range(1, len(columns) + 1)
    ]


def with_out_of_fold(train: DataFrame, encodings: DataFrame, columns: Sequence[str] = CATEGORICAL) -> DataFrame:
    """Train rows with ``<column>_enc`` from the other folds.

    The encodings are computed once. Those of few codes travel to the rows; only for a column of
    very many codes are rows shuffled, and adaptive execution splits its frequent codes.
    """
    fold = free_name("_fold", train.columns)
    rows = train.withColumn(fold, fold_of(train))
    for name, stored in zip(columns, _stored_by_column(encodings, columns)):
        own = stored.toDF(f"{name}_code", f"{name}_fold", f"{name}_enc")
        same = (F.col(name).cast("double") == F.col(f"{name}_code")) & (F.col(fold) == F.col(f"{name}_fold"))
        rows = rows.join(own, same).drop(f"{name}_code", f"{name}_fold")
    return rows.drop(fold)


def target_encoder(smoothing: float = SMOOTHING, columns: Sequence[str] = CATEGORICAL) -> TargetEncoder:
    """The stage that codes new rows: by the means of all train rows, unseen codes by that of all."""
    return TargetEncoder(
        inputCols=[f"{c}_num" for c in columns],
        outputCols=[f"{c}_enc" for c in columns],
        labelCol=TARGET,
        targetType="continuous",
        handleInvalid="keep",
        smoothing=smoothing,
    )


def fit_target_features(train: DataFrame, smoothing: float = SMOOTHING) -> tuple[PipelineModel, DataFrame]:
    """The feature pipeline for new rows, and the assembled train rows with out-of-fold codes."""
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}_num" for c in CATEGORICAL)
    numbers = SQLTransformer(statement=f"SELECT *, {casts} FROM __THIS__")
    coded = [f"{c}_enc" for c in CATEGORICAL]
    assemble = VectorAssembler(inputCols=[*NUMERIC, *coded], outputCol="features", handleInvalid="skip")
    features = Pipeline(stages=[numbers, target_encoder(smoothing), assemble]).fit(train)
    encodings = out_of_fold_encodings(target_statistics(train), smoothing)
    return features, assemble.transform(with_out_of_fold(train, encodings))


def forest_bins(features: PipelineModel) -> int:
    """Enough bins for the largest categorical feature with its index for unseen labels.

    Target-coded features are numbers, which the default bins are enough for.
    """
    if not isinstance(features.stages[0], StringIndexerModel):
        return DEFAULT_BINS
    labels = features.stages[0].labelsArray
    return max(DEFAULT_BINS, *[len(known) + 1 for known in labels])


def estimators(bins: int = DEFAULT_BINS) -> dict[str, object]:
    return {
        LINEAR: LinearRegression(labelCol=TARGET, featuresCol="features"),
        FOREST: RandomForestRegressor(
            labelCol=TARGET,
            featuresCol="features",
            numTrees=TREES,
            maxDepth=DEPTH,
            seed=SEED,
            maxBins=bins,
            maxMemoryInMB=FOREST_MEMORY_MB,
            cacheNodeIds=True,  # a row keeps its node of each tree: no tree is sent or walked down again
        ),
    }


def regression_metrics(
    predictions: DataFrame, models: Mapping[str, str], label: str = TARGET
) -> DataFrame:
    """MAE, RMSE and R² of several prediction columns, ``(model, mae, rmse, r2)``, in one scan."""
    target = F.col(label)
    per_model = []
    for name, column in models.items():
        error = target - F.col(column)
        spread = F.var_pop(target) * F.count(target)
        per_model.append(
            F.struct(
                F.lit(name).alias("model"),
                F.avg(F.abs(error)).alias("mae"),
                F.sqrt(F.avg(error * error)).alias("rmse"),
                (F.lit(1.0) - F.try_divide(F.sum(error * error), spread)).alias("r2"),
            )
        )
    metrics = predictions.agg(F.array(*per_model).alias("models"))
    return metrics.select(F.inline("models"))


def ranked(metrics: DataFrame) -> DataFrame:
    """Models by error, best first."""
    return metrics.orderBy("rmse", "model")


def best_model(metrics: DataFrame) -> DataFrame:
    return ranked(metrics).limit(1)


def predict_all(test: DataFrame, models: Mapping[str, Transformer]) -> tuple[DataFrame, dict]:
    """Add a prediction column per model and return its names."""
    columns = {}
    for number, (name, model) in enumerate(models.items()):
        columns[name] = f"prediction_{number}"
        test = model.copy({model.predictionCol: columns[name]}).transform(test)
    return test, columns


@dataclass
class Training:
    """Fitted pipelines by model name, and how they compare on the test rows."""

    pipelines: dict[str, PipelineModel]
    comparison: DataFrame
    best: str
    sizes: dict[str, int] = field(default_factory=dict)

    @property
    def best_pipeline(self) -> PipelineModel:
        return self.pipelines[self.best]


def train_and_compare(
    trips: DataFrame, one_hot: bool = False, target_coded: bool = False
) -> Training:
    """Fit both models on the train rows and compare them on the test rows.

    The features are fitted once. Codes are indexes, vectors with ``one_hot``, or means of the
    target in other folds with ``target_coded``, which serves any number of codes. The assembled train rows are kept (memory, then disk) for the
    passes of the linear model only; lost blocks are recomputed from the trips. Both models are
    scored in one scan of the test rows.
    """
    rows = training_rows(trips)
    train, test = content_split(rows)
    if target_coded:
        features, assembled = fit_target_features(train)
    else:
        features = fit_features(train, one_hot)
        assembled = features.transform(train)
    assembled = assembled.select("features", TARGET)
    fitted = {}
    for name, estimator in estimators(forest_bins(features)).items():
        # the forest keeps a binned copy of its own, so only the linear model needs the rows kept
        kept = name != FOREST
        if kept:
            assembled.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            fitted[name] = estimator.fit(assembled)
        finally:
            if kept:
                assembled.unpersist()
    scored, columns = predict_all(features.transform(test), fitted)
    metrics = regression_metrics(scored, columns).collect()
    is_train = split_bucket(rows) < TRAIN_PERCENT
    sizes = rows.agg(F.count_if(is_train).alias("train"), F.count_if(~is_train).alias("test")).first().asDict()
    comparison = ranked(trips.sparkSession.createDataFrame(metrics))
    best = min(metrics, key=lambda row: (row["rmse"], row["model"]))["model"]
    pipelines = {
        name: PipelineModel(stages=[*features.stages, model]) for name, model in fitted.items()
    }
    return Training(pipelines, comparison, best, sizes)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
