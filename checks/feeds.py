"""Weather, news, raw documents and text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs
from checks.registry import check
from checks.sql import SILVER, WEATHER
from tripmart.config import SourceSpec, scratch_path
from tripmart.functions.temporal import feed_timestamp, file_stamp, iso_timestamp
from tripmart.functions.text import (
    array_length,
    comma_list,
    kibibytes,
    tag_openings,
    url_slug,
)
from tripmart.operators import weather
from tripmart.sources.documents import (
    file_inventory,
    item_counts,
    landed_weather,
    read_news,
    read_weather,
)
from tripmart.sources.landing import land


@check(
    "url_slugs",
    r"""SELECT page_id, url, coalesce(nullif(lower(trim(regexp_replace(
        coalesce(nullif(regexp_extract(url, '\?([^#]*)', 1), ''),
                 regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)),
        '[^a-zA-Z0-9]+', '-', 'g'), '-')), ''), 'feed') AS slug
    FROM pages""",
)
def url_slugs(spark, sf_dir):
    pages = inputs.table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", url_slug(F.col("url")).alias("slug"))


@check(
    "tag_counts",
    """SELECT page_id, CAST(len(regexp_extract_all(html, '(?i)<p[ >]')) AS INTEGER) AS nb_tags
    FROM pages""",
)
def tag_counts(spark, sf_dir):
    pages = inputs.table(spark, sf_dir, "pages")
    return pages.select("page_id", tag_openings(F.col("html"), "p").alias("nb_tags"))


# white space of Unicode and the separators before the blank, as the SQL spells them
_BLANKS = " || ".join(
    f"chr({code})"
    for code in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
)


@check(
    "comma_lists",
    f"""SELECT doc_id, len(parts) AS nb_parts, md5(array_to_string(parts, '|')) AS digest
    FROM (SELECT doc_id, list_filter(list_transform(string_split(listed, ','),
      lambda p: trim(p, {_BLANKS})), lambda p: p <> '') AS parts
      FROM (SELECT doc_id, replace(text, ' a', chr(160) || ',' || chr(133) || ' a') AS listed FROM documents))""",
)
def comma_lists(spark, sf_dir):
    """Some blanks are made no-break spaces and line ends of Unicode beside commas."""
    parts = comma_list(F.replace(F.col("text"), F.lit(" a"), F.lit("\xa0,\x85 a")))
    return inputs.table(spark, sf_dir, "documents").select(
        "doc_id",
        F.size(parts).cast("bigint").alias("nb_parts"),
        F.md5(F.array_join(parts, "|")).alias("digest"),
    )


@check(
    "array_lengths",
    """SELECT vec_id, CASE WHEN label % 2 = 0 THEN CAST(len(embedding) AS INTEGER) ELSE 0 END
      AS nb_values FROM embeddings""",
)
def array_lengths(spark, sf_dir):
    """Some arrays are made missing; those have no values."""
    values = F.when(F.col("label") % 2 == 0, F.col("embedding"))
    return inputs.table(spark, sf_dir, "embeddings").select(
        "vec_id", array_length(values).alias("nb_values")
    )


@check(
    "file_stamps",
    """SELECT event_id, date_trunc('second', ts) AS fetched_at,
      CAST(ts AS DATE) AS day, event_id / 1024.0e0 AS size_kib FROM events""",
)
def file_stamps(spark, sf_dir):
    stamp = F.date_format(F.col("ts").cast("timestamp"), "yyyyMMdd'T'HHmmss'Z'")
    iso = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    name = F.concat(F.lit("rss_"), F.col("event_type"), F.lit("_"), stamp, F.lit(".xml"))
    return inputs.table(spark, sf_dir, "events").select(
        "event_id",
        file_stamp(name).alias("fetched_at"),
        F.to_date(iso_timestamp(iso)).alias("day"),
        kibibytes(F.col("event_id")).alias("size_kib"),
    )


@check(
    "feed_timestamps", "SELECT event_id, date_trunc('second', ts) AS published_at FROM events"
)
def feed_timestamps(spark, sf_dir):
    text = F.date_format(F.col("ts").cast("timestamp"), "EEE, d MMM yyyy HH:mm:ss")
    zone = F.when(F.col("event_id") % 2 == 0, " GMT").otherwise(" +0000")
    return inputs.table(spark, sf_dir, "events").select(
        "event_id", feed_timestamp(F.concat(text, zone)).alias("published_at")
    )


@check(
    "unzipped_arrays",
    """SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS position,
      unnest(embedding) AS value, unnest(list_reverse(embedding)) AS mirrored FROM embeddings""",
)
def unzipped_arrays(spark, sf_dir):
    arrays = {"value": F.col("embedding"), "mirrored": F.reverse("embedding")}
    vectors = inputs.table(spark, sf_dir, "embeddings")
    return weather.unzip_arrays(vectors, arrays, "vec_id")


def _written_weather(spark, sf_dir) -> str:
    path = scratch_path(spark, "weather")
    documents = inputs.weather_documents(spark, sf_dir)
    documents.write.option("maxRecordsPerFile", 1).json(path)
    return path


@check("weather_hours", f"WITH {WEATHER} SELECT * FROM weather")
def weather_hours(spark, sf_dir):
    return weather.hourly_weather(inputs.weather_documents(spark, sf_dir))


@check("weather_files", f"WITH {WEATHER} SELECT * FROM weather")
def weather_files(spark, sf_dir):
    """The same, written as one file per month and read back."""
    return weather.hourly_weather(read_weather(spark, _written_weather(spark, sf_dir)))


_ENRICHED = f"""{SILVER}, {WEATHER},
enriched AS (
  SELECT silver.*, date_trunc('hour', pickup_datetime) AS weather_hour, temperature_2m,
    precipitation, relative_humidity_2m, wind_speed_10m
  FROM silver LEFT JOIN weather ON weather.weather_hour = date_trunc('hour', pickup_datetime)
)"""


@check("trips_with_weather", f"WITH {_ENRICHED} SELECT * FROM enriched")
def trips_with_weather(spark, sf_dir):
    hours = weather.hourly_weather(inputs.weather_documents(spark, sf_dir))
    return weather.with_weather(inputs.silver_trips(spark, sf_dir), hours)


_READINGS = """
readings AS (
  SELECT o_orderdate + to_minutes(CAST(o_orderkey * 7 % 1440 AS INTEGER)) AS weather_time,
         CAST(max(floor(o_totalprice / 10000.0e0)) AS DOUBLE) AS temperature_2m,
         count(*) / 4.0e0 AS precipitation
  FROM orders GROUP BY 1
)"""


@check(
    "trips_with_latest_weather",
    f"""WITH {SILVER}, {_READINGS}, latest AS (
      SELECT silver.*, w.weather_time, w.temperature_2m, w.precipitation,
        w.weather_time >= pickup_datetime - INTERVAL 3 HOUR AS valid
      FROM silver ASOF LEFT JOIN readings w ON silver.pickup_datetime >= w.weather_time)
    SELECT * EXCLUDE (valid) REPLACE (CASE WHEN valid THEN weather_time END AS weather_time,
      CASE WHEN valid THEN temperature_2m END AS temperature_2m,
      CASE WHEN valid THEN precipitation END AS precipitation) FROM latest""",
)
def trips_with_latest_weather(spark, sf_dir):
    """Readings at any minute; a trip has the last one of three hours."""
    minute = F.make_dt_interval(mins=(F.col("o_orderkey") * 7 % 1440).cast("int"))
    at = (F.col("o_orderdate") + minute).cast("timestamp")
    readings = inputs.table(spark, sf_dir, "orders").groupBy(at.alias("weather_time")).agg(
        F.max(F.floor(F.col("o_totalprice") / 10000.0)).cast("double").alias("temperature_2m"),
        (F.count("*") / 4.0).alias("precipitation"),
    )
    return weather.with_latest_weather(
        inputs.silver_trips(spark, sf_dir),
        readings,
        variables=("temperature_2m", "precipitation"),
        time_col="weather_time",
    )


@check(
    "weather_price_correlations",
    f"WITH {_ENRICHED} "
    + " UNION ALL ".join(
        f"SELECT 'total_amount' AS x, '{y}' AS y, "
        f"round(nullif(corr(total_amount, {y}), 'nan'::DOUBLE), 6) AS r "
        "FROM enriched"
        for y in ("precipitation", "temperature_2m")
    ),
)
def weather_price_correlations(spark, sf_dir):
    hours = weather.hourly_weather(inputs.weather_documents(spark, sf_dir))
    pairs = weather.weather_correlations(inputs.silver_trips(spark, sf_dir), hours)
    return pairs.withColumn("r", F.round("r", 6))


def _written_news(spark, sf_dir) -> str:
    path = scratch_path(spark, "news")
    feed = inputs.news_items(spark, sf_dir).write.format("xml")
    feed.option("rootTag", "rss").option("rowTag", "item").save(path)
    return path


@check(
    "news_items",
    """SELECT 'Page ' || page_id AS title, url AS link,
      TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(page_id AS INTEGER)) AS published_at,
      'Source ' || (page_id % 7) AS source, 'http://example.com/' || (page_id % 7) AS source_url
    FROM pages""",
)
def news_items(spark, sf_dir):
    return read_news(spark, _written_news(spark, sf_dir)).drop("fetched_at")


@check(
    "news_item_counts",
    "SELECT 'source-' || (page_id % 7) AS folder, count(*) AS nb_items FROM pages GROUP BY 1 "
    "UNION ALL SELECT 'none', 0",
)
def news_item_counts(spark, sf_dir):
    """Items of feed files, a folder for each source, and a file without a line."""
    path = scratch_path(spark, "news")
    items = inputs.news_items(spark, sf_dir)
    counted = None
    for n in range(7):
        feed = items.where(F.col("source._VALUE") == f"Source {n}").write.format("xml")
        feed.option("rootTag", "rss").option("rowTag", "item").save(f"{path}/source-{n}")
    spark.createDataFrame([], "value string").coalesce(1).write.text(f"{path}/none")
    for name in [*(f"source-{n}" for n in range(7)), "none"]:
        total = item_counts(spark, f"{path}/{name}", pattern="part-*").agg(F.sum("nb_items").alias("nb_items"))
        total = total.select(F.lit(name).alias("folder"), F.coalesce("nb_items", F.lit(0)).alias("nb_items"))
        counted = total if counted is None else counted.union(total)
    return counted


@check("landed_weather_hours", f"WITH {WEATHER} SELECT * FROM weather")
def landed_weather_hours(spark, sf_dir):
    """The weather once more, from files that were landed as rows."""
    source = SourceSpec("weather", _written_weather(spark, sf_dir), "*.json")
    target = scratch_path(spark, "landed")
    land(spark, [source], target)
    return weather.hourly_weather(landed_weather(spark.read.parquet(f"{target}/weather")))


@check(
    "landed_documents",
    f"WITH {WEATHER} SELECT count(DISTINCT date_trunc('month', weather_hour)) AS nb_files, "
    "true AS all_sized FROM weather",
)
def landed_documents(spark, sf_dir):
    """Weather files landed byte for byte, with their sizes compared to the originals."""
    source = SourceSpec("weather", _written_weather(spark, sf_dir), "*.json")
    target = scratch_path(spark, "landed")
    land(spark, [source], target)
    landed = spark.read.parquet(f"{target}/weather")
    originals = file_inventory(spark, source.folder, source.pattern)
    name = F.element_at(F.split("path", "/"), -1)
    return (
        landed.select(name.alias("file_name"), F.length("content").alias("nb_landed"))
        .join(originals, "file_name", "left")
        .agg(
            F.count("*").alias("nb_files"),
            F.bool_and(F.col("nb_landed") == F.col("nb_bytes")).alias("all_sized"),
        )
    )
