"""Landing of raw files into the first layer, without changing them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.config import SourceSpec
from tripmart.sources.trips import LANDED_FILE, trips_by_file


class NothingLanded(RuntimeError):
    """No source had a single file."""


def source_files(spark: SparkSession, source: SourceSpec) -> DataFrame | None:
    """The files of a source as rows; ``None`` when its folder is missing.

    The content column is only read when a query asks for it.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", source.pattern)
    try:
        return reader.load(source.folder)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def land_rows(rows: DataFrame, target: str, name: str) -> None:
    """Write rows with their :data:`LANDED_FILE`; files that are there already are replaced."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(LANDED_FILE).parquet(f"{target.rstrip('/')}/{name}")


def land_documents(files: DataFrame, target: str, name: str) -> None:
    """Write small files as rows, byte for byte."""
    named = files.withColumn(LANDED_FILE, F.element_at(F.split("path", "/"), -1))
    land_rows(named, target, name)


def land_source(spark: SparkSession, source: SourceSpec, target: str) -> int:
    """Copy a source below ``target`` and return its number of files; 0 if there is none."""
    files = source_files(spark, source)
    n_files = 0 if files is None else files.select("path").count()
    if n_files and source.layout == "rows":
        land_rows(trips_by_file(spark, source.folder, source.pattern), target, source.name)
    elif n_files:
        land_documents(files, target, source.name)
    return n_files


def land(spark: SparkSession, sources: Iterable[SourceSpec], target: str) -> dict[str, int]:
    """Copy every source below ``target`` and return its number of files.

    A missing or empty source is skipped and counts 0; landing nothing at all is an error.
    Documents become rows ``(path, modificationTime, length, content)``, since each is small.
    Columnar files are copied as rows by splits, since one of them may exceed what a task can
    hold; trips come under their plain column names. The landed table has a partition for each
    file name: landing a file again replaces it and leaves the others, as copying into a folder
    would.
    """
    landed = {source.name: land_source(spark, source, target) for source in sources}
    if not sum(landed.values()):
        raise NothingLanded("no file was found for any source")
    return landed
