"""What the operators of this subpackage share: stored tables, empty cases, connected components."""

from __future__ import annotations

import gc
import os
from collections.abc import Iterator
from contextlib import AbstractContextManager
from dataclasses import dataclass
from pathlib import Path

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tripmart.config import scratch_path, session_settings

ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df`` as a table in the shared scratch folder: lineage ends here.

    A lost executor costs no recomputation of what lies before, and later plans see real sizes.
    """
    spark, schema = df.sparkSession, df.schema
    path = scratch_path(spark, label)
    df.write.parquet(path)
    free_shuffles(spark)
    return spark.read.schema(schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let the session drop shuffle files of finished work now.

    They go when the driver collects the plans that wrote them, which may be long after.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def release(df: DataFrame) -> None:
    """Delete a table that :func:`stored` wrote and nothing will read again."""
    files = df.inputFiles()
    if files:
        jvm = df.sparkSession.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def ready(spark: SparkSession) -> SparkSession:
    """Python workers import this package from where the driver has it, unless it is installed.

    A cluster without that folder gets the package by ``--py-files``.
    """
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    return spark


@dataclass(frozen=True)
class IdFilter:
    """A bitmap of fixed size that holds every wanted id and, the fuller it is, more of others.

    It saves work before an exact join and never decides on a row.
    """

    words: Broadcast

    BITS = 1 << 23

    @staticmethod
    def place(column: str, direct: bool = False) -> Column:
        """Where an id is; a column that is a hash already is taken ``direct``."""
        value = F.col(column) if direct else F.xxhash64(column)
        return F.pmod(value, F.lit(IdFilter.BITS))

    @classmethod
    def of(cls, ids: DataFrame, column: str, direct: bool = False) -> IdFilter:
        rows = (
            ids.select(cls.place(column, direct).alias("at"))
            .groupBy(F.expr("at div 64").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits"))
            .toPandas()
        )
        words = np.zeros(cls.BITS // 64, dtype=np.int64)
        words[rows["word"].to_numpy(dtype=np.int64)] = rows["bits"]
        return cls(ids.sparkSession.sparkContext.broadcast(words.view(np.uint64)))

    def may_hold(self, places: np.ndarray) -> np.ndarray:
        words = self.words.value[places // 64]
        return (words >> (places % 64).astype(np.uint64)) & np.uint64(1) == 1


def id_as_text(column: str, kind: str) -> Column:
    """An id as text, for jobs that go through pandas: there a whole number beside a null becomes a
    fraction, and large ones change."""
    return F.hex(column) if kind == "binary" else F.col(column).cast("string")


def id_from_text(column: str, kind: str) -> Column:
    """The id again, of its own type."""
    return F.unhex(column) if kind == "binary" else F.col(column).cast(kind)


def small_batches(spark: SparkSession) -> AbstractContextManager[None]:
    """Settings for jobs whose tasks read whole texts in Python: few megabytes of them at once."""
    return session_settings(
        spark,
        spark__sql__execution__arrow__maxRecordsPerBatch=1000,
        spark__sql__execution__arrow__maxBytesPerBatch=4 << 20,
    )


def is_held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """Whether a row is kept away from training: a fixed remainder of the id's checksum."""
    checksum = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    return (checksum % modulus) == remainder


def slices(frames: Iterator, size: int) -> Iterator:
    """Pandas frames cut to at most ``size`` rows, so that work on one has a bounded footprint."""
    for frame in frames:
        for at in range(0, len(frame), size):
            yield frame.iloc[at : at + size].reset_index(drop=True)


def connected_components(links: DataFrame, label: str, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); component is the smallest node reached.

    Alternates large-star and small-star steps, each a grouping with map-side combination of the
    minimum, until a step changes nothing. A node with a third of all links is safe: neighbours are
    never gathered, only their minimum is, and the join with it is split by adaptive execution.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v")
        .distinct(),
        label,
    )

    def state(edges: DataFrame) -> Row:
        return edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()

    before = state(edges)
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("v"), F.col("u"))).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: larger neighbours join the least one
        large = (
            both.where("v > u")
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        # small star: a node and its smaller neighbours join the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), "m")
            .toDF("u", "v")
            .where("u <> v")
            .distinct()
        )
        previous, edges = edges, stored(small, label)
        release(previous)
        now = state(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.union(roots)
