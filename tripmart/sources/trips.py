"""Readers of trip tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.config import use_utc
from tripmart.operators.cleaning import rename_present
from tripmart.schema import BRONZE, SILVER
from tripmart.sinks.snapshots import NoSuchVersion, is_published, part_name, read_version

# the column that says from which landed file a row came
LANDED_FILE = "landed_file"

_DECLARED = {field.name: field.dataType for field in BRONZE}


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate by column name; a column that a part lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _merged_schema(reader: DataFrameReader, *paths: str) -> T.StructType | None:
    """Common schema from the footers of all files, or ``None`` where types contradict."""
    try:
        return reader.option("mergeSchema", "true").parquet(*paths).schema
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE" in str(error):
            return None
        raise


def _schema_groups(
    spark: SparkSession, root: str, files: list[str]
) -> list[tuple[T.StructType, list[str]]]:
    """Files that can be read together, with their common schema.

    The footers of a run of files are merged in one Spark job. Only where types contradict each
    other is the run halved, so a few changes of type over the years cost a few dozen jobs.
    """
    merged = _merged_schema(spark.read.option("basePath", root), *files)
    if merged is not None:
        return [(merged, files)]
    half = len(files) // 2
    return _schema_groups(spark, root, files[:half]) + _schema_groups(spark, root, files[half:])


def _common_type(name: str, kinds: set[T.DataType]) -> T.DataType:
    """A type that holds the values of all kinds; declared types come later, in the cleaning.

    Large whole numbers next to fractions have no common number type without loss, so an unknown
    column becomes text then. Of a declared column it is known that a double holds its values.
    """
    if len(kinds) == 1:
        return next(iter(kinds))
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if all(isinstance(kind, whole) for kind in kinds):
        return T.LongType()
    if all(isinstance(kind, (*whole, T.FloatType, T.DoubleType)) for kind in kinds):
        exact = not any(isinstance(kind, T.LongType) for kind in kinds)
        return T.DoubleType() if exact or name in _DECLARED else T.StringType()
    times = (T.TimestampType, T.TimestampNTZType, T.DateType)
    if name in _DECLARED and all(isinstance(kind, times) for kind in kinds):
        return _DECLARED[name]
    return T.StringType()


def read_bronze(
    spark: SparkSession,
    path: str,
    pattern: str = "*.parquet",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Raw trips of a folder, under their plain column names.

    Monthly files differ in columns and, over the years, in types. Files with agreeing types
    are read as one scan; a column whose type differs between scans is cast to a type that holds
    the values of all. Without such a difference, rows stay exactly as they are in the files. With a
    ``schema`` that fits all files, their footers need not be compared.
    """
    return rename_present(_read_drifting(spark, path, pattern, schema)).drop(LANDED_FILE)


def trips_by_file(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """``read_bronze`` with the name of the file that each row came from."""
    return rename_present(_read_drifting(spark, path, pattern, by_file=True))


def _read_drifting(
    spark: SparkSession,
    path: str,
    pattern: str,
    schema: T.StructType | None = None,
    by_file: bool = False,
) -> DataFrame:
    use_utc(spark)
    merged = schema or _merged_schema(spark.read.option("pathGlobFilter", pattern), path)
    if merged is not None:
        scan = spark.read.option("pathGlobFilter", pattern).schema(merged).parquet(path)
        return _with_file_name(scan) if by_file else scan
    scan = spark.read.option("pathGlobFilter", pattern).parquet(path)
    files = sorted(unquote(name) for name in scan.inputFiles())  # names come as parts of a URI
    return _conformed_files(spark, path, files, by_file)


def _with_file_name(scan: DataFrame) -> DataFrame:
    return scan.withColumn(LANDED_FILE, F.col("_metadata.file_name"))


def trips_of_files(spark: SparkSession, files: list[str]) -> DataFrame:
    """The rows of some raw files, with the name of the file that each came from."""
    use_utc(spark)
    return _conformed_files(spark, files[0].rsplit("/", 1)[0], files, by_file=True)


def _conformed_files(spark: SparkSession, root: str, files: list[str], by_file: bool) -> DataFrame:
    by_types: dict[tuple, tuple[T.StructType, list[str]]] = {}
    for schema, members in _schema_groups(spark, root, files):
        key = tuple(sorted((field.name, field.dataType.json()) for field in schema))
        by_types.setdefault(key, (schema, []))[1].extend(members)
    scans = []
    for schema, members in by_types.values():
        scan = spark.read.option("basePath", root).schema(schema).parquet(*members)
        scans.append(rename_present(_with_file_name(scan) if by_file else scan))
    return conformed(scans)


def conformed(scans: Sequence[DataFrame]) -> DataFrame:
    """Concatenate by name; a column whose type differs is cast to one that holds the values of all."""
    kinds: dict[str, set[T.DataType]] = {}
    for scan in scans:
        for field in scan.schema:
            kinds.setdefault(field.name, set()).add(field.dataType)
    casts = {name: _common_type(name, seen) for name, seen in kinds.items() if len(seen) > 1}
    return union_by_name(
        [
            scan.withColumns(
                {n: F.col(n).try_cast(kind) for n, kind in casts.items() if n in scan.columns}
            )
            for scan in scans
        ]
    )


def read_silver(
    spark: SparkSession,
    path: str,
    months: Sequence[tuple[int, int]] | None = None,
    version: int | None = None,
    within: Mapping[str, tuple[int, int]] | None = None,
) -> DataFrame:
    """Clean trips; ``months`` as ``(year, month)`` limits the scan to those partitions.

    Months written on different days may have different source columns: all of them are there,
    null where a month lacks them. The declared columns come first and the others after them.
    Of a published table the newest version is read, or the one asked for, and a reader keeps to
    it. ``within`` limits whole-number columns to closed ranges; files of a published table whose
    bounds lie outside are not opened.
    """
    if is_published(spark, path):
        use_utc(spark)
        parts = None if months is None else [part_name(year=y, month=m) for y, m in months]
        stored = conformed(read_version(spark, path, version, parts, within))
    elif version is not None:
        raise NoSuchVersion(f"{path} has no versions")
    else:
        stored = _read_drifting(spark, path, "*.parquet")
    declared = [name for name in SILVER.names if name in stored.columns]
    others = [name for name in stored.columns if name not in SILVER.names]
    silver = stored.select(*declared, *others)
    for name, (low, high) in (within or {}).items():
        silver = silver.where(F.col(name).between(low, high))
    if months is None:
        return silver
    wanted = [(F.col("year") == year) & (F.col("month") == month) for year, month in months]
    return silver.where(reduce(lambda a, b: a | b, wanted, F.lit(False)))
