"""Readers of the semi-structured raw files and of exported KPI documents."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.config import use_utc
from tripmart.functions.temporal import feed_timestamp, file_stamp, iso_timestamp
from tripmart.functions.text import kibibytes, tag_openings
from tripmart.schema import NEWS_ITEM, WEATHER
from tripmart.sources.trips import union_by_name


_FEED = T.StructType(
    [
        T.StructField(
            "channel", T.StructType([T.StructField("item", T.ArrayType(NEWS_ITEM))])
        )
    ]
)


def _file_name(path: str = "_metadata.file_name") -> Column:
    return F.element_at(F.split(F.col(path), "/"), -1).alias("file_name")


def _fetched_at(file_name: str = "_metadata.file_name") -> Column:
    return file_stamp(F.col(file_name)).alias("fetched_at")


def _landed_text() -> Column:
    return F.decode("content", "UTF-8")


def read_weather(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """Weather files, one row each, with the time of retrieval from the file name."""
    use_utc(spark)
    files = spark.read.schema(WEATHER).option("pathGlobFilter", pattern)
    return files.json(path, multiLine=True).select("*", _fetched_at(), _file_name())


def read_news(spark: SparkSession, path: str, pattern: str = "*.xml") -> DataFrame:
    """News items of feed files: title, link, time of publication, source.

    The XML source splits files at the items, so a feed is not read as one piece.
    """
    use_utc(spark)
    items = (
        spark.read.format("xml")
        .option("rowTag", "item")
        .option("pathGlobFilter", pattern)
        .schema(NEWS_ITEM)
        .load(path)
    )
    return _news_columns(items.select("*", _fetched_at()))


def _news_columns(items: DataFrame) -> DataFrame:
    return items.select(
        "title",
        "link",
        feed_timestamp(F.col("pubDate")).alias("published_at"),
        F.col("source._VALUE").alias("source"),
        F.col("source._url").alias("source_url"),
        "fetched_at",
    )


CORRUPT = "_corrupt_record"


def split_weather(spark: SparkSession, path: str, pattern: str = "*.json") -> tuple[DataFrame, DataFrame]:
    """Weather files that can be read, as :func:`read_weather` gives them, and the others.

    The others come as file_name, rule, raw: ``unreadable`` files, which are no JSON or are
    cut short, with their text, files with ``no_hours`` and ``empty`` ones, which a scan has no row
    for but the listing has. Each file is in one of the two.
    """
    use_utc(spark)
    schema = T.StructType([*WEATHER.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT)
    files = reader.option("pathGlobFilter", pattern).json(path, multiLine=True)
    named = files.select("*", _fetched_at(), _file_name())
    kept, rejected = _split_weather(named)
    empty = _listed_names(spark, files).join(named.select("file_name"), "file_name", "left_anti")
    return kept, rejected.union(empty.select("file_name", F.lit("empty"), F.lit("")))


def _listed_names(spark: SparkSession, scan: DataFrame) -> DataFrame:
    """The names of all files of a scan, empty ones included."""
    names = {unquote(name.rsplit("/", 1)[1]) for name in scan.inputFiles()}
    return spark.createDataFrame([(name,) for name in sorted(names)], "file_name string")


def split_landed_weather(landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``split_weather`` over weather files that were landed as rows."""
    use_utc(landed.sparkSession)
    schema = T.StructType([*WEATHER.fields, T.StructField(CORRUPT, T.StringType())])
    text = _landed_text()
    document = F.from_json(text, schema, {"columnNameOfCorruptRecord": CORRUPT}).alias("document")
    files = landed.select(document, text.alias("text"), _fetched_at("path"), _file_name("path"))
    empty = F.col("document").isNull() & F.col(f"document.{CORRUPT}").isNull()
    corrupt = F.coalesce(f"document.{CORRUPT}", F.when(empty, F.coalesce("text", F.lit(""))))
    fields = [F.col(f"document.{name}").alias(name) for name in WEATHER.names]
    return _split_weather(files.select(*fields, corrupt.alias(CORRUPT), "fetched_at", "file_name"))


def _split_weather(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    hours = F.coalesce(F.size("hourly.time") > 0, F.lit(False))
    rule = F.when(F.col(CORRUPT).isNotNull(), "unreadable").when(~hours, "no_hours")
    judged = files.withColumn("rule", rule)
    kept = judged.where(F.col("rule").isNull()).select(*WEATHER.names, "fetched_at", "file_name")
    rejected = judged.where(F.col("rule").isNotNull()).select(
        "file_name", "rule", F.coalesce(CORRUPT, F.to_json(F.struct(*WEATHER.names))).alias("raw")
    )
    return kept, rejected


def rejected_news(spark: SparkSession, path: str, pattern: str = "*.xml") -> DataFrame:
    """file_name, rule, raw of feed items that :func:`read_news` cannot read in full.

    ``unreadable`` items are no XML, ``unreadable_time`` ones have a publication time of another
    form and are kept without it. What is opened and never closed has no end to cut it at: such
    items are counted by file as ``unclosed``, with their number.
    """
    use_utc(spark)
    schema = T.StructType([*NEWS_ITEM.fields, T.StructField(CORRUPT, T.StringType())])
    items = (
        spark.read.format("xml")
        .option("rowTag", "item")
        .option("pathGlobFilter", pattern)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(schema)
        .load(path)
        .select("*", F.col("_metadata.file_name").alias("file_name"))
    )
    untimed = F.col("pubDate").isNotNull() & feed_timestamp(F.col("pubDate")).isNull()
    rule = F.when(F.col(CORRUPT).isNotNull(), "unreadable").when(untimed, "unreadable_time")
    named = items.withColumn("rule", rule)
    broken = named.where(F.col("rule").isNotNull()).select(
        "file_name", "rule", F.coalesce(CORRUPT, F.to_json(F.struct(*NEWS_ITEM.names))).alias("raw")
    )
    read = items.groupBy("file_name").agg(F.count(F.lit(1)).alias("read"))
    opened = item_counts(spark, path, "item", pattern)
    missing = F.col("nb_items") - F.coalesce("read", F.lit(0))
    unclosed = opened.join(read, "file_name", "left").where(missing > 0)
    return broken.union(unclosed.select("file_name", F.lit("unclosed"), missing.cast("string")))


def landed_weather(landed: DataFrame) -> DataFrame:
    """``read_weather`` over weather files that were landed as rows."""
    use_utc(landed.sparkSession)
    document = F.from_json(_landed_text(), WEATHER).alias("document")
    return landed.select(document, _fetched_at("path"), _file_name("path")).select(
        "document.*", "fetched_at", "file_name"
    )


def landed_news(landed: DataFrame) -> DataFrame:
    """``read_news`` over feed files that were landed as rows."""
    use_utc(landed.sparkSession)
    feed = F.from_xml(_landed_text(), _FEED).alias("feed")
    feeds = landed.select(feed, _fetched_at("path"))
    return _news_columns(feeds.select("fetched_at", F.inline("feed.channel.item")))


def file_inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Name, size and age of raw files; their content is not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("nb_bytes"),
        kibibytes(F.col("length")).alias("size_kib"),
        "modificationTime",
    )


def item_counts(
    spark: SparkSession, path: str, tag: str = "item", pattern: str = "*.xml"
) -> DataFrame:
    """Openings of a tag per file, 0 for an empty one.

    Such an opening never spans lines, so lines are counted.
    """
    lines = spark.read.option("pathGlobFilter", pattern).text(path)
    counted = lines.select(
        F.col("_metadata.file_name").alias("file_name"),
        tag_openings(F.col("value"), tag).alias("openings"),
    )
    found = counted.groupBy("file_name").agg(F.sum("openings").alias("nb_items"))
    # a scan has no row for a file without bytes
    return _listed_names(spark, lines).join(found, "file_name", "left").select(
        "file_name", F.coalesce("nb_items", F.lit(0)).cast("bigint").alias("nb_items")
    )


def flatten(df: DataFrame) -> DataFrame:
    """Nested fields as columns with dotted names."""

    def leaves(fields: T.StructType, path: tuple[str, ...] = ()):
        for field in fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, here)
            else:
                source = ".".join(f"`{part}`" for part in here)
                yield F.col(source).alias(".".join(here))

    return df.select(*leaves(df.schema))


def _export_files(spark: SparkSession, path: str) -> list[tuple[bool, list[str]]]:
    """Files that hold an array of documents, and files with a document per line.

    The names of the files, few in an export, come to the driver.
    """
    lines = spark.read.text(path).select(F.ltrim("value").alias("v"), F.col("_metadata.file_path").alias("file"))
    starts = F.col("v").startswith("[")  # no line of a document begins so, unless it is an array
    files = lines.where("v <> ''").groupBy("file").agg(F.max(starts).alias("is_array")).collect()
    return [(kind, sorted(r["file"] for r in files if r["is_array"] == kind)) for kind in (True, False)]


def export_documents(spark: SparkSession, path: str) -> DataFrame:
    """Exported documents as (file_name, document), whatever their fields are; no schema is inferred.

    Documents that are no JSON object are null, so that none vanishes.
    """
    parts = []
    for is_array, files in _export_files(spark, path):
        if not files:
            continue
        reader = spark.read.option("singleVariantColumn", "document").option("multiLine", is_array)
        rows = reader.json(files).select(_file_name(), "document")
        if is_array:
            element = F.explode_outer(F.try_variant_get("document", "$", "array<variant>")).alias("document")
            rows = rows.select("file_name", element)
        parts.append(rows)
    if not parts:
        raise ValueError(f"no document below {path}")
    documents = union_by_name(parts)
    is_object = F.try_variant_get("document", "$", "map<string,variant>").isNotNull()
    return documents.select("file_name", F.when(is_object, F.col("document")).alias("document"))


# fixed values: how extended documents wrap a value
WRAPPERS = ("$date", "$numberInt", "$numberLong", "$numberDouble", "$numberDecimal", "$oid")


def typed_documents(documents: DataFrame, schema: T.StructType) -> DataFrame:
    """Fields of documents as columns of declared types, and ``unread``: the fields that did not fit.

    A field may change its form from document to document: a number, its text, or either wrapped as
    extended documents have it. A missing or null field is null and fits.
    """
    columns, unread = [], []
    for field in schema:
        paths = [f"$['{field.name}']"] + [f"$['{field.name}'][\"{w}\"]" for w in WRAPPERS]
        value = F.coalesce(*[_as_type("document", path, field.dataType) for path in paths])
        given = F.try_variant_get("document", paths[0], "variant")
        there = given.isNotNull() & ~F.is_variant_null(given)
        columns.append(value.alias(field.name))
        unread.append(F.when(there & value.isNull(), F.lit(field.name)))
    whole = F.when(F.col("document").isNull(), F.array(F.lit("document")))
    return documents.select(
        "file_name", *columns, F.coalesce(whole, F.array_compact(F.array(*unread))).alias("unread")
    )


def _as_type(document: str, path: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.DateType):
        return iso_timestamp(F.try_variant_get(document, path, "string")).cast("date")
    if isinstance(kind, T.TimestampType):
        return iso_timestamp(F.try_variant_get(document, path, "string"))
    return F.try_variant_get(document, path, kind.simpleString())


def read_kpi_export(spark: SparkSession, path: str) -> DataFrame:
    """An exported KPI: files with a JSON array of documents, or with one document per line.

    A file is an array when a line of it begins one. Document ids are dropped, whether plain or
    nested. Extended dates stay as dotted columns (``pickup_date.$date``).
    """
    parts = [
        spark.read.json(files, multiLine=is_array) for is_array, files in _export_files(spark, path) if files
    ]
    if not parts:
        raise ValueError(f"no document below {path}")
    return flatten(union_by_name(parts).drop("_id"))
