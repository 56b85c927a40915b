from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tripmart.operators import counters
from tripmart.schema import METRIC_SAMPLES

START = datetime(2024, 1, 1, 11, 58, tzinfo=timezone.utc)


def samples(spark, *rows):
    """Rows ``(seconds, metric, labels, value)``."""
    data = [(START + timedelta(seconds=s), m, labels, float(v)) for s, m, labels, v in rows]
    return spark.createDataFrame(data, METRIC_SAMPLES)


def counter(spark, *points, metric="c", **labels):
    return samples(spark, *[(s, metric, {"instance": "i"} | labels, v) for s, v in points])


def rates(df):
    return [r["rate"] for r in df.orderBy("ts").collect()]


def test_reset_counts_from_zero(spark):
    df = counter(spark, (0, 5), (10, 9), (20, 2))
    assert rates(counters.counter_rate(df, ("instance",))) == [None, 0.4, 0.3]


def test_growth_into_the_window_does_not_count(spark):
    df = counter(spark, (0, 0), (200, 1000), (400, 1100))
    assert rates(counters.counter_rate(df, ("instance",))) == [None, 5.0, 0.5]


def test_samples_of_one_second(spark):
    df = counter(spark, (0.1, 1), (0.5, 4), (0.9, 2), (10, 12))
    assert rates(counters.counter_rate(df, ("instance",))) == [None, (3 + 2 + 10) / 10]


def test_copies_change_nothing(spark):
    df = counter(spark, (0, 5), (10, 9), (20, 2))
    once = rates(counters.counter_rate(df, ("instance",)))
    assert rates(counters.counter_rate(df.unionAll(df).unionAll(df), ("instance",))) == once


def test_rates_equal_a_direct_computation_across_chunks(spark):
    rng = random.Random(3)
    points, now = [], 0
    for _ in range(400):
        now += rng.choice((1, 15, 60, 200, 301, 900))
        points.append((now, rng.randrange(100)))
    df = counter(spark, *points)
    expected = []
    for i, (at, _) in enumerate(points):
        window = [p for p in points[: i + 1] if p[0] >= at - 300]
        grown = sum(b[1] - a[1] if b[1] >= a[1] else b[1] for a, b in zip(window, window[1:]))
        expected.append(grown / (at - window[0][0]) if len(window) > 1 else None)
    assert points[-1][0] > 3 * counters.CHUNK
    assert rates(counters.counter_rate(df, ("instance",))) == expected


def test_series_are_kept_apart(spark):
    df = counter(spark, (0, 1), (10, 2), device="a").unionAll(
        counter(spark, (5, 100), (10, 50), device="b")
    )
    rows = counters.counter_rate(df, ("instance", "device")).collect()
    assert {(r["device"], r["rate"]) for r in rows} == {
        ("a", None), ("a", 0.1), ("b", None), ("b", 10.0)
    }


def test_cpu_busy_is_averaged_over_processors(spark):
    name = "node_cpu_seconds_total"
    df = (
        counter(spark, (0, 0), (100, 50), metric=name, cpu="0", mode="idle")
        .unionAll(counter(spark, (0, 0), (100, 100), metric=name, cpu="1", mode="idle"))
        .unionAll(counter(spark, (0, 0), (100, 40), metric=name, cpu="0", mode="user"))
    )
    rows = counters.cpu_busy_percent(df).orderBy("ts").collect()
    assert [r["cpu_busy_percent"] for r in rows] == [None, 25.0]


def test_excluded_devices_match_as_a_whole(spark):
    df = samples(
        spark,
        (0, "m", {"device": "lo"}, 1),
        (0, "m", {"device": "lo0"}, 1),
        (0, "m", {"device": "eth0"}, 1),
        (0, "m", {}, 1),
    )
    left = counters.without_label(df, "device", "lo").select(counters.label("device"))
    assert {r[0] for r in left.collect()} == {"lo0", "eth0", None}


def test_gauge_ratios(spark):
    df = samples(
        spark,
        (0, "node_memory_MemAvailable_bytes", {"instance": "i"}, 25),
        (0, "node_memory_MemTotal_bytes", {"instance": "i"}, 100),
        (5, "node_memory_MemAvailable_bytes", {"instance": "i"}, 25),
        (5, "node_memory_MemTotal_bytes", {"instance": "i"}, 0),
    )
    rows = counters.memory_used_percent(df).orderBy("ts").collect()
    assert [r["memory_used_percent"] for r in rows] == [75.0, None]


def test_disk_use_leaves_out_a_type(spark):
    disk = {"instance": "i", "mountpoint": "/", "fstype": "ext4"}
    memory = {"instance": "i", "mountpoint": "/run", "fstype": "tmpfs"}
    rows = [
        (0, f"node_filesystem_{what}_bytes", labels, value)
        for labels in (disk, memory)
        for what, value in (("avail", 30), ("size", 120))
    ]
    found = counters.disk_used_percent(samples(spark, *rows)).collect()
    assert [(r["mountpoint"], r["disk_used_percent"]) for r in found] == [("/", 75.0)]


def test_load_and_time_range(spark):
    df = samples(
        spark,
        (0, "node_load1", {"instance": "i"}, 1),
        (0, "node_load5", {"instance": "i"}, 2),
        (3601, "node_load1", {"instance": "i"}, 3),
    )
    first, second = counters.load_averages(df).orderBy("ts").collect()
    assert (first["load_1m"], first["load_5m"], first["load_15m"]) == (1.0, 2.0, None)
    end = F.lit(START + timedelta(seconds=3601))
    assert counters.latest(df, end).count() == 1
    assert second["load_1m"] == 3.0


def test_no_window_spans_a_whole_series(spark):
    from plans import plan_of

    df = counter(spark, (0, 5), (10, 9))
    windows = [
        line
        for line in plan_of(counters.counter_rate(df, ("instance",)), "simple").splitlines()
        if "+- Window" in line
    ]
    assert windows
    for line in windows:
        partition = line.rsplit("], [", 2)[-2]
        assert "chunk" in partition or "at#" in partition


@pytest.mark.parametrize("window", [60, 300, 7200])
def test_any_window_length(spark, window):
    df = counter(spark, *[(i * 30, i) for i in range(400)])
    found = rates(counters.counter_rate(df, ("instance",), window))
    assert found[0] is None and set(found[1:]) == {1 / 30}


def test_samples_are_shuffled_once(spark):
    from plans import plan_of

    df = counter(spark, (0, 5), (10, 9))
    for rated in (
        counters.counter_rate(df, ("instance",)),
        counters.rate_on_grid(df, ("instance",)),
        counters.latest_on_grid(df, ("instance",)),
    ):
        plan = plan_of(rated, "simple").split("Initial Plan")[0]
        assert plan.count("Exchange hashpartitioning") == 1


# regular times


def seconds_of(df, *columns):
    return sorted((int(r["ts"].timestamp() - START.timestamp()), *[r[c] for c in columns]) for r in df.collect())


def test_last_sample_until_it_is_stale_or_replaced(spark):
    df = counter(spark, (7, 1), (31.5, 2), (45, 3), (45, 4), (400, 5), metric="g")
    found = seconds_of(counters.latest_on_grid(df, ("instance",), 15, 60), "value")
    # 11:58 is a multiple of 15 s
    assert found == [(15, 1.0), (30, 1.0), (45, 4.0), (60, 4.0), (75, 4.0), (90, 4.0), (405, 5.0), (420, 5.0), (435, 5.0), (450, 5.0)]


def test_grid_equals_a_direct_computation_across_chunks(spark):
    rng = random.Random(5)
    points, now = [], 0.0
    for _ in range(300):
        now += rng.choice((0.3, 1, 14, 15, 61, 200, 299, 300, 301, 900))
        points.append((round(now, 1), float(rng.randrange(100))))
    assert now > 3 * counters.CHUNK
    df = counter(spark, *points, device="a").unionAll(counter(spark, *points[::2], device="b"))
    own = [(points, "a"), (points[::2], "b")]
    steps = range(0, int(now) + 400, 15)
    gauges, rated = [], []
    for ps, device in own:
        for t in steps:
            valid = [v for s, v in ps if t - 300 < s <= t]
            if valid:
                gauges.append((t, device, valid[-1]))
            inside = [(int(s), v) for s, v in ps if t - 300 <= int(s) <= t]
            if inside:
                grown = sum(b - a if b >= a else b for (_, a), (_, b) in zip(inside, inside[1:]))
                elapsed = inside[-1][0] - inside[0][0]
                rated.append((t, device, round(grown / elapsed, 9) if elapsed else -1.0))
    labels = ("instance", "device")
    assert seconds_of(counters.latest_on_grid(df, labels), "device", "value") == sorted(gauges)
    found = counters.rate_on_grid(df, labels).withColumn("rate", F.coalesce(F.round("rate", 9), F.lit(-1.0)))
    assert seconds_of(found, "device", "rate") == sorted(rated)


def test_panels_at_regular_times(spark):
    name = "node_cpu_seconds_total"
    df = counter(spark, (0, 0), (30, 15), metric=name, cpu="0", mode="idle")
    busy = seconds_of(counters.cpu_busy_percent(df, step=30), "cpu_busy_percent")
    assert busy[:3] == [(0, None), (30, 50.0), (60, 50.0)]
    load = counter(spark, (0, 1), metric="node_load1").unionAll(counter(spark, (20, 2), metric="node_load5"))
    assert seconds_of(counters.load_averages(load, step=60), "load_1m", "load_5m")[:2] == [(0, 1.0, None), (60, 1.0, 2.0)]


def test_nothing_on_a_grid(spark):
    empty = counter(spark)
    assert counters.rate_on_grid(empty, ("instance",)).count() == 0
    assert counters.latest_on_grid(empty, ("instance",)).count() == 0
    nulls = spark.createDataFrame([(None, "m", None, 1.0), (START, "m", None, None), (START, "m", None, 2.0)], METRIC_SAMPLES)
    assert counters.latest_on_grid(nulls, ("instance",), 60, 60).count() == 1
