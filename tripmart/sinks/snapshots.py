"""Published versions of a table.

Below the table's path, ``data/run=<id>`` holds what one run wrote and is never changed, and
``versions/<n>`` is the manifest of a version: the files that make it up, with rows, bytes and bounds of
some columns. A run writes its files where no reader looks, then its manifest, and one rename publishes
all of it. Until then readers see the version before, whole, also when the run fails half-way.

The rename fails where the version exists already, so of two runs that started from the same
version one is refused. That holds for file systems with an atomic rename, as HDFS has.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = (
    "part string, run string, file string, nb_rows bigint, nb_bytes bigint, columns string, "
    "bounds map<string, struct<low: bigint, high: bigint, nulls: bigint>>"
)


class SnapshotConflict(RuntimeError):
    """Another run has published since this one started."""


class NoSuchVersion(LookupError):
    """The version was never published, or it has expired."""


@dataclass(frozen=True)
class Run:
    """What a run writes, on top of the version it started from."""

    table: str
    base: int
    name: str

    @property
    def folder(self) -> str:
        return f"{self.table}/data/run={self.name}"


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there and holds anything."""
    system, place = _file_system(spark, path)
    return system.exists(place) and len(system.listStatus(place)) > 0


def mean_file_bytes(spark: SparkSession, path: str) -> float:
    """Bytes of the files below a folder, or below all that a pattern matches, divided by their number."""
    system, place = _file_system(spark, path)
    found = [system.getContentSummary(status.getPath()) for status in system.globStatus(place) or []]
    return sum(f.getLength() for f in found) / max(sum(f.getFileCount() for f in found), 1)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it; a missing one is no error."""
    system, place = _file_system(spark, path)
    system.delete(place, True)


def _rename_once(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; an existing target is refused and not moved into."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    system, source = _file_system(spark, source)
    source = system.makeQualified(source)
    none = getattr(hadoop, "Options$Rename").NONE
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    options[0] = none
    context = hadoop.FileContext.getFileContext(source.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(source, system.makeQualified(hadoop.Path(target)), options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in str(error.java_exception):
            raise SnapshotConflict(f"{target} has been published by another run") from None
        raise


def versions(spark: SparkSession, table: str) -> list[int]:
    """The published versions that have not expired, oldest first."""
    system, place = _file_system(spark, f"{table.rstrip('/')}/versions")
    if not system.exists(place):
        return []
    names = [status.getPath().getName() for status in system.listStatus(place)]
    return sorted(int(name) for name in names if name.isdigit())


def latest(spark: SparkSession, table: str) -> int:
    """The newest version; 0 before the first one."""
    return max(versions(spark, table), default=0)


def start_run(spark: SparkSession, table: str) -> Run:
    run = Run(table.rstrip("/"), latest(spark, table), f"r{uuid.uuid4().hex}")
    system, place = _file_system(spark, run.folder)
    system.mkdirs(place)
    return run


def manifest(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """The files of a version, by default the newest one, a row each."""
    return _manifest(spark, table, version).where(F.col("file").isNotNull()).drop("columns")


def _manifest(spark: SparkSession, table: str, version: int | None) -> DataFrame:
    known = versions(spark, table)
    number = max(known, default=0) if version is None else version
    if number not in known:
        raise NoSuchVersion(f"{table} has no version {number or 'yet'}")
    return spark.read.schema(MANIFEST).parquet(f"{table.rstrip('/')}/versions/{number}")


def _as_whole(df: DataFrame, name: str) -> Column:
    """A whole number or a time as a bigint, in microseconds for times."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(F.col(name).cast("timestamp"))
    if isinstance(kind, T.IntegralType):
        return F.col(name).cast("bigint")
    raise ValueError(f"no bounds are kept of {name}: it is neither a whole number nor a time")


def written_files(
    spark: SparkSession, run: Run, schema: T.StructType, bounds: Iterable[str] = ()
) -> DataFrame:
    """The files that a run wrote, with their rows and the bounds of some columns.

    One scan of these columns, aggregated by file.
    """
    rows = spark.read.schema(schema).parquet(run.folder)
    names = [name for name in bounds if name in schema.names]
    spans = [
        F.struct(
            F.min(value).alias("low"), F.max(value).alias("high"), F.count_if(value.isNull()).alias("nulls")
        )
        for value in (_as_whole(rows, name) for name in names)
    ]
    path = F.col("_metadata.file_path")
    files = rows.groupBy(path.alias("path"), F.col("_metadata.file_size").alias("nb_bytes")).agg(
        F.count("*").alias("nb_rows"),
        (F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*spans)) if names else F.lit(None)).alias("bounds"),
    )
    return files.select(
        F.regexp_extract("path", f"run={run.name}/(?:(.*)/)?([^/]+)$", 1).alias("part"),
        F.lit(run.name).alias("run"),
        F.regexp_extract("path", "([^/]+)$", 1).alias("file"),
        "nb_rows",
        "nb_bytes",
        F.lit(None).cast("string").alias("columns"),
        "bounds",
    )


def publish(
    spark: SparkSession,
    run: Run,
    files: DataFrame,
    schemas: Mapping[str, T.StructType],
    replaced: Iterable[str] | None = None,
) -> int:
    """Make what a run wrote the next version, and return its number.

    ``replaced`` names the parts that the run stands for: those of the version before go, and all its
    others are kept as they are. ``None`` stands for all parts. ``schemas`` has the columns that the
    run wrote, under the part they belong to or under '' for all. If another version has been
    published since the run started, nothing is changed and the run is refused.
    """
    described = spark.createDataFrame(
        [(part, run.name, None, 0, 0, schema.json(), None) for part, schema in schemas.items()], MANIFEST
    )
    rows = described.union(files.select(*described.columns))
    if run.base and replaced is not None:
        before = _manifest(spark, run.table, run.base)
        kept = before.where(F.col("file").isNull() | ~F.col("part").isin(list(replaced)))
        # descriptions of runs that have no file left go
        used = kept.where(F.col("file").isNotNull()).select("run").distinct()
        rows = rows.union(kept.join(used, "run", "left_semi").select(*rows.columns))
    staged = f"{run.table}/versions/.{run.name}"
    rows.coalesce(1).write.parquet(staged)  # a row a file, so one task is enough
    try:
        _rename_once(spark, staged, f"{run.table}/versions/{run.base + 1}")
    except SnapshotConflict:
        delete_folder(spark, staged)
        raise
    return run.base + 1


def written_parts(spark: SparkSession, run: Run, rows: Mapping[str, int]) -> DataFrame:
    """Whole folders as files of a manifest, for parts whose rows were counted when written."""

    def size(part: str) -> int:
        system, place = _file_system(spark, f"{run.folder}/{part}")
        return system.getContentSummary(place).getLength()

    found = [(part, run.name, "", n, size(part), None, None) for part, n in rows.items()]
    return spark.createDataFrame(found, MANIFEST)


def part_folder(spark: SparkSession, table: str, part: str, version: int | None = None) -> str:
    """Where a part of a version lies."""
    found = manifest(spark, table, version).where(F.col("part") == part).select("run").first()
    if found is None:
        raise NoSuchVersion(f"{part} is no part of that version of {table}")
    return f"{table.rstrip('/')}/data/run={found['run']}/{part}"


def part_name(**columns: object) -> str:
    """The part that a partitioned write gives to these values."""
    return "/".join(f"{name}={value}" for name, value in columns.items())


def read_version(
    spark: SparkSession,
    table: str,
    version: int | None = None,
    parts: Iterable[str] | None = None,
    within: Mapping[str, tuple[int, int]] | None = None,
) -> list[DataFrame]:
    """The rows of a version, a frame for each set of files with the same columns.

    The columns come from the manifest, so no footer is read to find them. ``parts`` limits the
    read to these folders. ``within`` leaves out files whose bounds show that none of their rows has
    the column in the range; it does not filter the rows of the others. Folders never change
    after they were published, so a frame stays what it is while newer versions are published.
    """
    table = table.rstrip("/")
    rows = _manifest(spark, table, version)
    described = {(r["run"], r["part"]): r["columns"] for r in rows.where("file is null").collect()}
    files = rows.where(F.col("file").isNotNull())
    if parts is not None:
        files = files.where(F.col("part").isin(list(parts)))
    if within:
        tests = [_may_hold(name, *span) for name, span in within.items()]
        files = files.where(reduce(lambda a, b: a & b, tests))
        found = files.select("run", "part", "file").collect()
    else:
        found = files.select("run", "part", F.lit(None).alias("file")).distinct().collect()
    by_columns: dict[str, list[str]] = {}
    for row in found:
        columns = described.get((row["run"], row["part"])) or described[row["run"], ""]
        place = "/".join(p for p in (f"{table}/data/run={row['run']}", row["part"], row["file"]) if p)
        by_columns.setdefault(columns, []).append(place)
    if not by_columns:
        return [spark.createDataFrame([], T.StructType.fromJson(json.loads(c))) for c in set(described.values())]
    return [
        spark.read.schema(T.StructType.fromJson(json.loads(columns)))
        .option("basePath", f"{table}/data")
        .parquet(*sorted(places))
        .drop("run")
        for columns, places in sorted(by_columns.items())
    ]


def _may_hold(name: str, low: int, high: int) -> Column:
    span = F.try_element_at("bounds", F.lit(name))
    known = span.isNotNull()
    return ~known | ((span["low"] <= high) & (span["high"] >= low))


def changed_parts(spark: SparkSession, table: str, older: int, newer: int) -> DataFrame:
    """Parts that two versions do not share: part, change, rows_before, rows_after.

    A part that a run has written again counts as replaced, whatever its rows are.
    """

    def summed(version: int, rows: str, run: str) -> DataFrame:
        files = manifest(spark, table, version)
        return files.groupBy("part").agg(F.sum("nb_rows").alias(rows), F.sort_array(F.collect_set("run")).alias(run))

    both = summed(older, "rows_before", "old").join(summed(newer, "rows_after", "new"), "part", "full")
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").otherwise("replaced")
    return both.where(~F.col("old").eqNullSafe(F.col("new"))).select(
        "part", change.alias("change"),
        F.coalesce("rows_before", F.lit(0)).alias("rows_before"), F.coalesce("rows_after", F.lit(0)).alias("rows_after"),
    )


def expire(spark: SparkSession, table: str, keep: int = 2) -> list[int]:
    """Delete all but the newest ``keep`` versions, and the folders that only they name.

    A version that is still being read needs to be kept. What runs wrote without publishing it is
    not touched, since such a run may be going on; :func:`abandon` deletes what a failed one left.
    """
    if keep < 1:
        raise ValueError("the newest version has to be kept")
    table = table.rstrip("/")
    known = versions(spark, table)
    old, kept = known[:-keep], known[-keep:]
    if not old:
        return []

    def folders(numbers: list[int]) -> DataFrame:
        frames = [_manifest(spark, table, n).select("run", "part", "file") for n in numbers]
        rows = reduce(DataFrame.union, frames)
        return rows.where(F.col("file").isNotNull()).select("run", "part").distinct()

    unused = folders(old).exceptAll(folders(kept)).collect()  # a folder each, not a row each
    for number in old:
        delete_folder(spark, f"{table}/versions/{number}")
    for row in unused:
        delete_folder(spark, "/".join(p for p in (f"{table}/data/run={row['run']}", row["part"]) if p))
    return old


def abandon(spark: SparkSession, run: Run) -> None:
    """Delete what a run wrote that will not be published."""
    delete_folder(spark, run.folder)
    delete_folder(spark, f"{run.table}/versions/.{run.name}")


def is_published(spark: SparkSession, table: str) -> bool:
    """Whether the table has versions; a table that was written plainly has none."""
    return has_files(spark, f"{table.rstrip('/')}/versions")
