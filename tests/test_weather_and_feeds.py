from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plans import plan_of
from tripmart.config import CleaningRules, SourceSpec, default_sources
from tripmart.functions.temporal import feed_timestamp, file_stamp
from tripmart.functions.text import array_length, comma_list, tag_openings, url_slug
from tripmart.operators.cleaning import clean
from tripmart.operators.rejects import rejected_trips, tried_again, unreadable_values
from tripmart.operators.weather import (
    hourly_weather,
    weather_correlations,
    with_latest_weather,
    with_weather,
)
from tripmart.sources.documents import (
    export_documents,
    file_inventory,
    flatten,
    item_counts,
    landed_news,
    landed_weather,
    read_kpi_export,
    read_news,
    read_weather,
    rejected_news,
    split_landed_weather,
    split_weather,
    typed_documents,
)
from tripmart.sources.landing import NothingLanded, land, source_files


def weather_file(folder, stamp, times, temperatures, **other):
    hourly = {
        "time": times,
        "temperature_2m": temperatures,
        "precipitation": [0.0] * len(times),
        "relative_humidity_2m": [70] * len(times),
        "wind_speed_10m": [3.5] * len(times),
    }
    document = {"timezone": "America/New_York", "elevation": 32.0, "hourly": hourly} | other
    path = folder / f"weather_2024-01-01_2024-01-02_{stamp}.json"
    path.write_text(json.dumps(document, indent=1))


@pytest.fixture
def weather_folder(tmp_path):
    folder = tmp_path / "weather"
    folder.mkdir()
    hours = ["2024-03-06T09:00", "2024-03-06T10:00", "2024-03-06T10:00"]
    weather_file(folder, "20240301T000000Z", hours, [1.0, None, 5.0])
    weather_file(folder, "20240401T000000Z", hours[:1], [9.0])
    (folder / "weather_x_20240501T000000Z.json").write_text('{"error": true}')
    (folder / "notes.txt").write_text("{}")
    return folder


def test_weather_hours(spark, weather_folder):
    raw = read_weather(spark, str(weather_folder))
    assert raw.count() == 3
    assert raw.select(F.sum(array_length(F.col("hourly.time")))).first()[0] == 4
    rows = hourly_weather(raw).orderBy("weather_hour").collect()
    # the later file counts for nine, the first entry for ten o'clock
    assert [(r["weather_hour"].hour, r["temperature_2m"]) for r in rows] == [(9, 9.0), (10, None)]


def test_join_keeps_every_trip_once(spark, trips, weather_folder):
    late = {"pickup_datetime": "2024-03-07 10:00:00", "dropoff_datetime": "2024-03-07 10:20:00"}
    early = {"pickup_datetime": "2024-03-06 09:59:59"}
    silver = clean(trips({}, early, late))
    hours = hourly_weather(read_weather(spark, str(weather_folder)))
    joined = with_weather(silver, hours)
    rows = joined.orderBy("pickup_datetime").collect()
    assert [r["temperature_2m"] for r in rows] == [9.0, None, None]
    assert [r["wind_speed_10m"] for r in rows] == [3.5, 3.5, None]


def test_weather_correlation_of_constant_is_null(spark, trips, weather_folder):
    silver = clean(trips({}, {"total_amount": 9.0}))
    hours = hourly_weather(read_weather(spark, str(weather_folder)))
    rows = weather_correlations(silver, hours).collect()
    assert {(r["x"], r["y"], r["r"]) for r in rows} == {
        ("total_amount", "precipitation", None),
        ("total_amount", "temperature_2m", None),
    }


FEED = """<?xml version="1.0"?>
<rss version="2.0"><channel><title>c</title>
<item><title>A</title><link>http://x</link><pubDate>Mon, 06 Sep 2021 16:45:00 GMT</pubDate>
<source url="http://s">S</source></item>
<item><title>B</title><link>http://y</link></item><items/></channel></rss>
"""


@pytest.fixture
def news_folder(tmp_path):
    folder = tmp_path / "news"
    folder.mkdir()
    (folder / "rss_q-nyc_20240102T030405Z.xml").write_text(FEED)
    return folder


def test_news_items(spark, news_folder):
    first, second = read_news(spark, str(news_folder)).orderBy("title").collect()
    assert (first["title"], first["source"], first["source_url"]) == ("A", "S", "http://s")
    assert first["published_at"].isoformat() == "2021-09-06T16:45:00"
    assert first["fetched_at"].isoformat() == "2024-01-02T03:04:05"
    assert (second["link"], second["published_at"], second["source"]) == ("http://y", None, None)


def test_item_counts_and_inventory(spark, news_folder):
    (news_folder / "other.xml").write_text("<ITEM >\n<item>x</item><items>\n<item\n>")
    (news_folder / "empty.xml").write_text("")
    counts = {r["file_name"]: r["nb_items"] for r in item_counts(spark, str(news_folder)).collect()}
    assert counts == {"rss_q-nyc_20240102T030405Z.xml": 2, "other.xml": 2, "empty.xml": 0}
    listed = file_inventory(spark, str(news_folder), "rss*").first()
    assert listed["size_kib"] == len(FEED) / 1024


@pytest.mark.parametrize(
    ("url", "slug"),
    [
        ("https://news.example.com/rss/search?q=NYC+taxi&hl=en-US", "q-nyc-taxi-hl-en-us"),
        ("https://example.com/feeds/City_News.xml", "feeds-city-news-xml"),
        ("https://example.com/a;v=1", "a"),
        ("https://example.com/?", "feed"),
        ("https://example.com?---", "feed"),
        ("https://example.com/x#frag?no", "x"),
        ("not a url [", "not-a-url"),
        ("", "feed"),
        (None, "feed"),
    ],
)
def test_slugs(spark, url, slug):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(url_slug(F.col("u"))).first()[0] == slug


def test_text_functions(spark):
    df = spark.createDataFrame([(" a, ,b\t,,c ", "<p><P class='x'><pre></p>", None)], "l string, m string, n array<int>")
    row = df.select(
        comma_list(F.col("l")), tag_openings(F.col("m"), "p"), array_length(F.col("n"))
    ).first()
    assert tuple(row) == (["a", "b", "c"], 2, 0)


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Mon, 06 Sep 2021 16:45:00 GMT", "2021-09-06T16:45:00"),
        ("Mon, 6 Sep 2021 16:45:00 -0400", "2021-09-06T20:45:00"),
        ("06 Sep 2021 16:45:00 +0000", "2021-09-06T16:45:00"),
        ("yesterday", None),
        (None, None),
    ],
)
def test_feed_dates(spark, text, expected):
    found = spark.createDataFrame([(text,)], "t string").select(feed_timestamp(F.col("t"))).first()
    assert (found[0] and found[0].isoformat()) == expected


def test_file_stamps(spark):
    names = spark.createDataFrame([("a_20240102T030405Z.json",), ("a.json",)], "n string")
    stamps = [r[0] for r in names.select(file_stamp(F.col("n"))).collect()]
    assert stamps[0].isoformat() == "2024-01-02T03:04:05" and stamps[1] is None


def test_kpi_export(spark, tmp_path):
    path = tmp_path / "kpi_daily_revenue.json"
    path.write_text(
        '[{"_id": {"$oid": "1"}, "pickup_date": {"$date": "2024-01-01T00:00:00Z"},\n'
        ' "daily_revenue": 10.5, "nb_trips": 2}]'
    )
    df = read_kpi_export(spark, str(path))
    assert sorted(df.columns) == ["daily_revenue", "nb_trips", "pickup_date.$date"]
    assert df.first()["pickup_date.$date"] == "2024-01-01T00:00:00Z"


def test_flatten_goes_all_the_way_down(spark):
    df = spark.sql("SELECT named_struct('b', named_struct('c', 1, 'd', array(2))) AS a, 3 AS e")
    assert flatten(df).columns == ["a.b.c", "a.b.d", "e"]


def test_landing(spark, trips, tmp_path, weather_folder):
    trips({}, {"note": "b"}).coalesce(1).write.parquet(str(tmp_path / "taxi"))
    (tmp_path / "news").mkdir()
    landed = land(spark, default_sources(str(tmp_path)), str(tmp_path / "bronze"))
    assert landed == {"taxi": 1, "weather": 3, "news": 0}
    assert spark.read.parquet(str(tmp_path / "bronze" / "taxi")).count() == 2
    stored = spark.read.parquet(str(tmp_path / "bronze" / "weather"))
    names = {f.name: f.read_bytes() for f in weather_folder.glob("*.json")}
    assert {r["path"].rsplit("/", 1)[1]: bytes(r["content"]) for r in stored.collect()} == names
    again = land(spark, default_sources(str(tmp_path)), str(tmp_path / "bronze"))
    assert again == landed
    assert spark.read.parquet(str(tmp_path / "bronze" / "taxi")).count() == 2


def test_landed_documents_read_like_files(spark, tmp_path, weather_folder, news_folder):
    land(spark, default_sources(str(tmp_path)), str(tmp_path / "bronze"))
    landed = spark.read.parquet(str(tmp_path / "bronze" / "weather"))
    files = read_weather(spark, str(weather_folder))
    key = "fetched_at"
    assert landed_weather(landed).orderBy(key).collect() == files.orderBy(key).collect()
    feeds = spark.read.parquet(str(tmp_path / "bronze" / "news"))
    found = landed_news(feeds).orderBy("title").collect()
    assert found == read_news(spark, str(news_folder)).orderBy("title").collect()
    assert [r["title"] for r in found] == ["A", "B"]


def test_landing_nothing_is_an_error(spark, tmp_path):
    with pytest.raises(NothingLanded):
        land(spark, default_sources(str(tmp_path / "missing")), str(tmp_path / "bronze"))


def test_missing_folder_is_told_from_an_empty_one(spark, tmp_path):
    assert source_files(spark, SourceSpec("x", str(tmp_path / "missing"), "*")) is None
    assert source_files(spark, SourceSpec("x", str(tmp_path), "*.none")).count() == 0


# latest readings


def readings(spark, *rows):
    data = [(datetime.fromisoformat(at) if at else None, float(t)) for at, t in rows]
    return spark.createDataFrame(data, "at timestamp_ntz, temperature_2m double")


def with_temperature(trips, found, **options):
    options = {"variables": ("temperature_2m",), "time_col": "at"} | options
    rows = with_latest_weather(trips, found, **options).orderBy("pickup_datetime").collect()
    return [r["temperature_2m"] for r in rows]


def test_latest_reading_within_the_tolerance(spark, trips):
    found = readings(spark, ("2024-03-06 09:59:59", 1), ("2024-03-06 10:00:00", 2), ("2024-03-06 10:00:01", 3),
                     ("2024-03-06 10:00:00", 1), (None, 9), ("2024-03-05 23:30:00", 4))
    days = ["2024-03-05 20:00:00", "2024-03-06 02:29:59", "2024-03-06 02:30:00", "2024-03-06 02:30:01", "2024-03-06 10:00:00", "2024-03-06 11:00:00"]
    rows = trips(*[{"pickup_datetime": d} for d in days])
    assert with_temperature(rows, found) == [None, 4.0, 4.0, None, 2.0, 3.0]
    assert with_temperature(rows, found, bucket=60) == [None, 4.0, 4.0, None, 2.0, 3.0]
    assert with_temperature(rows, readings(spark)) == [None] * 6


def test_each_trip_is_kept_once_and_clashing_names_stay(spark, trips):
    found = readings(spark, ("2024-03-06 09:00:00", 1), ("2024-03-06 09:30:00", 2))
    rows = trips({}, {}, {"pickup_datetime": None}).withColumnsRenamed({"note": "_bucket", "tip_amount": "_found"})
    joined = with_latest_weather(rows, found, variables=("temperature_2m",), time_col="at")
    assert joined.columns == [*rows.columns, "weather_time", "temperature_2m"]
    assert sorted(map(str, joined.select(rows.columns).collect())) == sorted(map(str, rows.collect()))


def test_latest_reading_needs_no_nested_loop_and_no_window(spark, trips):
    plan = plan_of(with_latest_weather(trips({}), readings(spark, ("2024-03-06 09:00:00", 1)), variables=("temperature_2m",), time_col="at"), "simple")
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Window" not in plan


def test_a_trip_is_not_compared_with_all_readings_of_its_bucket(spark, trips):
    found = readings(spark, *[(f"2024-03-06 0{s // 3600}:{s // 60 % 60:02d}:{s % 60:02d}", s) for s in range(0, 4 * 3600, 37)])
    days = [f"2024-03-06 0{s // 3600}:{s // 60 % 60:02d}:{s % 60:02d}" for s in range(0, 7 * 3600, 411)]
    rows = trips(*[{"pickup_datetime": d} for d in days])
    direct = [37.0 * min(s // 37, (4 * 3600 - 1) // 37) for s in range(0, 7 * 3600, 411)]
    expected = [t if s - t <= 3 * 3600 else None for s, t in zip(range(0, 7 * 3600, 411), direct)]
    assert with_temperature(rows, found) == expected
    plan = plan_of(with_latest_weather(rows, found, variables=("temperature_2m",), time_col="at"), "simple")
    assert "filter(" not in plan and "aggregate(" in plan


# rejects


def test_every_weather_file_is_kept_or_rejected(spark, weather_folder):
    (weather_folder / "weather_cut_20240601T000000Z.json").write_text('{"timezone": "x", "hourly": {"time": ["2024-03-06T09:00"')
    (weather_folder / "weather_empty_20240601T000000Z.json").write_text("")
    kept, rejected = split_weather(spark, str(weather_folder))
    assert kept.count() == 2 and kept.columns == read_weather(spark, str(weather_folder)).columns
    rows = {r["file_name"]: (r["rule"], r["raw"]) for r in rejected.collect()}
    assert rows["weather_cut_20240601T000000Z.json"][0] == "unreadable"
    assert '"hourly": {"time": ["2024' in rows["weather_cut_20240601T000000Z.json"][1]
    assert rows["weather_x_20240501T000000Z.json"][0] == "no_hours" and len(rows) == 3
    assert rows["weather_empty_20240601T000000Z.json"] == ("empty", "")


def test_landed_weather_files_are_split_the_same(spark, weather_folder):
    (weather_folder / "weather_cut_20240601T000000Z.json").write_text('{"timezone": "x", "hourly": {"ti')
    landed = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(str(weather_folder))
    kept, rejected = split_landed_weather(landed)
    assert kept.count() == 2
    assert {r["file_name"].split("_")[1]: r["rule"] for r in rejected.collect()} == {
        "cut": "unreadable", "x": "no_hours"
    }


def test_broken_feed_items_are_reported(spark, tmp_path):
    good = "<item><title>a</title><pubDate>Mon, 01 Jan 2024 10:00:00 GMT</pubDate></item>"
    untimed = "<item><title>b</title><pubDate>yesterday</pubDate></item>"
    cut = "<item><title>c</title><pub"
    broken = "<item><title>d</titel></item>"
    (tmp_path / "x_1.xml").write_text(f"<rss><channel>{good}{untimed}{broken}{cut}")
    (tmp_path / "x_2.xml").write_text(f"<rss><channel>{good}</channel></rss>")
    rows = [(r["file_name"], r["rule"]) for r in rejected_news(spark, str(tmp_path)).collect()]
    assert sorted(rows) == [("x_1.xml", "unclosed"), ("x_1.xml", "unreadable"), ("x_1.xml", "unreadable_time")]


def test_rejected_trips_run_no_method_that_stays_interpreted(spark, trips):
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    try:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", 65535)
        rejected_trips(trips({}))
        assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", before)


def test_rejected_trips_can_be_tried_again(spark, trips):
    rows = trips({}, {"fare_amount": -5.0}, {"fare_amount": -5.0}, {"fare_amount": None}, {"fare_amount": 700.0, "note": "x"},
                 {"dropoff_datetime": "2024-03-06 09:00:00", "fare_amount": 900.0})
    text = rows.withColumn("fare_amount", F.col("fare_amount").cast("string")).unionByName(
        trips({}).withColumn("fare_amount", F.lit("twenty"))
    ).withColumnsRenamed({"note": "rule", "tip_amount": "_raw"})
    text = text.withColumn("tip_amount", F.lit(1.0))
    rejected = rejected_trips(text)
    found = sorted((r[-2], r[-1]) for r in rejected.collect())
    assert found == [("fare_out_of_range", 1), ("fare_out_of_range", 2), ("missing_value", 1), ("not_in_time_order", 1),
                     ("unreadable_fare_amount", 1)]
    assert clean(text).count() + sum(n for _, n in found) == text.count()


def test_higher_bounds_let_rejected_rows_in(spark, trips):
    rows = trips({}, {"fare_amount": 700.0}, {"fare_amount": 700.0}, {"fare_amount": -1.0})
    again = tried_again(rejected_trips(rows), CleaningRules(max_fare=800.0))
    assert [r["fare_amount"] for r in again.collect()] == [700.0]
    assert rejected_trips(trips({}, {})).count() == 0


def test_unreadable_values_by_column(spark, trips):
    rows = trips({}, {}, {}).withColumns({"tip_amount": F.lit("2,50"), "tolls_amount": F.lit("1.5")})
    assert [tuple(r) for r in unreadable_values(rows).collect()] == [("tip_amount", "2,50", 3)]
    assert unreadable_values(rows.select("note")).count() == 0


# exported documents


def test_documents_of_any_shape_are_kept(spark, tmp_path):
    (tmp_path / "lines.json").write_text('{"n": 1, "d": "2024-01-02"}\nno json\n{"n": {"$numberLong": "7"}, "x": [1]}\n')
    (tmp_path / "array.json").write_text('[{"n": "3", "d": {"$date": "2024-01-02T10:00:00Z"}},\n {"n": {"a": 1}}, {}, 5, {"n": null}]')
    documents = export_documents(spark, str(tmp_path))
    assert documents.count() == 8 and documents.where("document is null").count() == 2
    typed = typed_documents(documents, T.StructType.fromDDL("n bigint, d date, `odd name` string"))
    rows = sorted((r["file_name"], r["n"] or 0, str(r["d"]), tuple(r["unread"])) for r in typed.collect())
    assert rows == [
        ("array.json", 0, "None", ()), ("array.json", 0, "None", ()), ("array.json", 0, "None", ("document",)),
        ("array.json", 0, "None", ("n",)), ("array.json", 3, "2024-01-02", ()),
        ("lines.json", 0, "None", ("document",)), ("lines.json", 1, "2024-01-02", ()), ("lines.json", 7, "None", ()),
    ]
    empty = tmp_path / "none"
    empty.mkdir()
    (empty / "x.json").write_text("")
    with pytest.raises(ValueError, match="no document"):
        export_documents(spark, str(empty))
