"""Landing of just the files that no run before has landed."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.config import SourceSpec
from tripmart.sinks.snapshots import has_files
from tripmart.sources.landing import land_documents, land_rows, source_files
from tripmart.sources.trips import trips_of_files

FILES_PER_BATCH = 1000
# a file is new when its name is, however old its time of change is
ANY_AGE = "36500d"

_FILE = "path string, modificationTime timestamp, length bigint, content binary"
_LISTED = "path string, modificationTime timestamp, length bigint, source string, batch string"


def new_files(spark: SparkSession, source: SourceSpec, files_per_batch: int) -> DataFrame | None:
    """The files of a source as a stream; ``None`` when its folder is missing."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema(_FILE)
        .option("pathGlobFilter", source.pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", ANY_AGE)
    )
    try:
        files = reader.load(source.folder)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    # the rows of columnar files are read by splits later, so only their names are listed here
    return files.drop("content") if source.layout == "rows" else files


def land_batch(batch: DataFrame, name: str, source: SourceSpec, target: str) -> int:
    """Land the files of one batch and enter them in the list of landed files.

    The landed table has a partition for each file name, the list one for each batch, and both are
    replaced. So a batch that is run again after a failure adds nothing.
    """
    spark, target = batch.sparkSession, target.rstrip("/")
    names = batch.drop("content")
    if source.layout == "rows":
        paths = sorted(r["path"] for r in names.select("path").collect())  # at most files_per_batch
        if paths:
            land_rows(trips_of_files(spark, paths), target, source.name)
    else:
        land_documents(batch, target, source.name)
    listed = f"{target}/landed_files/source={source.name}/batch={name}"
    names.write.mode("overwrite").parquet(listed)
    return spark.read.schema(names.schema).parquet(listed).count()


def changed_files(spark: SparkSession, source: SourceSpec, target: str) -> DataFrame | None:
    """Landed files that have another time of change now; the stream knows files by their names only."""
    present = source_files(spark, source)
    if present is None or not has_files(spark, f"{target.rstrip('/')}/landed_files"):
        return None
    listed = landed_files(spark, target).where(F.col("source") == source.name)
    known = listed.groupBy("path").agg(F.max("modificationTime").alias("known"))
    return present.join(known, "path").where("modificationTime > known").drop("known")


def land_new(
    spark: SparkSession,
    sources: Iterable[SourceSpec],
    target: str,
    checkpoint: str,
    files_per_batch: int = FILES_PER_BATCH,
) -> dict[str, int]:
    """Land what has come since the last run with this ``checkpoint``, and count the files.

    The checkpoint keeps which files are landed. A file that was changed since is landed again and
    replaces itself. A run ends when nothing new is left. A missing or empty source counts 0. Files have
    to be moved into the folder whole, as any reader of it needs.
    """
    landed: dict[str, int] = {}
    for source in sources:
        files = new_files(spark, source, files_per_batch)
        counts: dict[str, int] = {}

        def land(batch: DataFrame, number: int | str, source=source, counts=counts) -> None:
            counts[str(number)] = land_batch(batch, str(number), source, target)

        changed = changed_files(spark, source, target)
        if changed is not None and not changed.isEmpty():
            land(changed, f"changed-{uuid.uuid4().hex}")
        if files is not None:
            writer = files.writeStream.foreachBatch(land).queryName(f"land-{source.name}")
            writer = writer.option("checkpointLocation", f"{checkpoint.rstrip('/')}/{source.name}")
            writer.trigger(availableNow=True).start().awaitTermination()
        landed[source.name] = sum(counts.values())
    return landed


def landed_files(spark: SparkSession, target: str) -> DataFrame:
    """The list of landed files: source, batch, path, modificationTime, length.

    A file that was landed again is listed again, under a batch of its own.
    """
    return spark.read.schema(_LISTED).parquet(f"{target.rstrip('/')}/landed_files").select(
        "source", "batch", "path", "modificationTime", "length"
    )
