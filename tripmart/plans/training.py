"""The clean table to a saved price model."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tripmart.operators.learning import Training, save_model, train_and_compare
from tripmart.sources.trips import read_silver


def run_training(
    spark: SparkSession, silver: str, model: str, target_coded: bool = False
) -> Training:
    """Fit and compare the models, save the better one with its feature stages, and the comparison.

    The comparison lies next to the model, in ``<model>_comparison``.
    """
    training = train_and_compare(read_silver(spark, silver), target_coded=target_coded)
    save_model(training.best_pipeline, model)
    training.comparison.coalesce(1).write.mode("overwrite").parquet(f"{model.rstrip('/')}_comparison")
    return training
