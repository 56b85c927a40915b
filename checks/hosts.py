"""Roll-ups of host metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs
from checks.registry import check
from checks.sql import SAMPLES, gauges, gauges_on_grid, rates, rates_on_grid
from tripmart.operators import counters


@check(
    "host_counter_rates",
    f"""WITH {rates("metric = 'node_cpu_seconds_total'", "metric, instance, cpu, mode")}
    SELECT * FROM rates""",
)
def host_counter_rates(spark, sf_dir):
    samples = inputs.metric_samples(spark, sf_dir)
    cpu = counters.samples_of(samples, "node_cpu_seconds_total")
    return counters.counter_rate(cpu, ("instance", "cpu", "mode"))


@check(
    "host_cpu_busy",
    f"""WITH {rates("metric = 'node_cpu_seconds_total' AND mode = 'idle'", "metric, instance, cpu")}
    SELECT instance, ts, 100 - avg(rate) * 100 AS cpu_busy_percent FROM rates GROUP BY 1, 2""",
)
def host_cpu_busy(spark, sf_dir):
    return counters.cpu_busy_percent(inputs.metric_samples(spark, sf_dir))


_MEMORY = gauges(
    "true",
    "instance",
    available="node_memory_MemAvailable_bytes",
    total="node_memory_MemTotal_bytes",
)


@check(
    "host_memory_used",
    f"WITH {_MEMORY} SELECT instance, ts, (1 - available / total) * 100 AS memory_used_percent "
    "FROM wide",
)
def host_memory_used(spark, sf_dir):
    return counters.memory_used_percent(inputs.metric_samples(spark, sf_dir))


_DISK = gauges(
    "fstype <> 'tmpfs'",
    "instance, mountpoint, fstype",
    available="node_filesystem_avail_bytes",
    size="node_filesystem_size_bytes",
)


@check(
    "host_disk_used",
    f"""WITH {_DISK} SELECT instance, mountpoint, fstype, ts,
      100 - available * 100 / size AS disk_used_percent FROM wide""",
)
def host_disk_used(spark, sf_dir):
    return counters.disk_used_percent(inputs.metric_samples(spark, sf_dir))


@check(
    "host_disk_rates",
    f"""WITH {rates("metric LIKE 'node_disk%'", "metric, instance, device")}
    SELECT * FROM rates""",
)
def host_disk_rates(spark, sf_dir):
    return counters.disk_rates(inputs.metric_samples(spark, sf_dir))


@check(
    "host_network_rates",
    f"""WITH {rates("metric LIKE 'node_network%' AND device <> 'lo'", "metric, instance, device")}
    SELECT * FROM rates""",
)
def host_network_rates(spark, sf_dir):
    return counters.network_rates(inputs.metric_samples(spark, sf_dir))


_LOAD = gauges(
    "true", "instance", load_1m="node_load1", load_5m="node_load5", load_15m="node_load15"
)


@check("host_load_averages", f"WITH {_LOAD} SELECT * FROM wide")
def host_load_averages(spark, sf_dir):
    return counters.load_averages(inputs.metric_samples(spark, sf_dir))


@check(
    "host_last_hour",
    f"""WITH {SAMPLES} SELECT metric, instance, device, ts, value FROM samples
    WHERE ts BETWEEN (SELECT max(ts) FROM samples) - INTERVAL 1 HOUR
                 AND (SELECT max(ts) FROM samples)""",
)
def host_last_hour(spark, sf_dir):
    samples = inputs.metric_samples(spark, sf_dir)
    newest = inputs.table(spark, sf_dir, "events").agg(F.max("ts").cast("timestamp")).scalar()
    return counters.latest(samples, newest).select(
        "metric",
        counters.label("instance").alias("instance"),
        counters.label("device").alias("device"),
        "ts",
        "value",
    )


# evaluated at regular times, as panels are

STEP = 60  # seconds
_IDLE = "metric = 'node_cpu_seconds_total' AND mode = 'idle'"


@check(
    "host_cpu_busy_on_grid",
    f"""WITH {rates_on_grid(_IDLE, "metric, instance, cpu", STEP)}
    SELECT instance, ts, 100 - avg(rate) * 100 AS cpu_busy_percent FROM rates GROUP BY 1, 2""",
)
def host_cpu_busy_on_grid(spark, sf_dir):
    return counters.cpu_busy_percent(inputs.metric_samples(spark, sf_dir), step=STEP)


@check(
    "host_disk_rates_on_grid",
    f"""WITH {rates_on_grid("metric LIKE 'node_disk%'", "metric, instance, device", STEP)}
    SELECT * FROM rates""",
)
def host_disk_rates_on_grid(spark, sf_dir):
    return counters.disk_rates(inputs.metric_samples(spark, sf_dir), step=STEP)


@check(
    "host_network_rates_on_grid",
    f"""WITH {rates_on_grid("metric LIKE 'node_network%' AND device <> 'lo'", "metric, instance, device", STEP)}
    SELECT * FROM rates""",
)
def host_network_rates_on_grid(spark, sf_dir):
    return counters.network_rates(inputs.metric_samples(spark, sf_dir), step=STEP)


_MEMORY_ON_GRID = gauges_on_grid(
    "true",
    "instance",
    STEP,
    available="node_memory_MemAvailable_bytes",
    total="node_memory_MemTotal_bytes",
)


@check(
    "host_memory_used_on_grid",
    f"WITH {_MEMORY_ON_GRID} SELECT instance, ts, (1 - available / total) * 100 AS memory_used_percent "
    "FROM wide",
)
def host_memory_used_on_grid(spark, sf_dir):
    return counters.memory_used_percent(inputs.metric_samples(spark, sf_dir), step=STEP)


_DISK_ON_GRID = gauges_on_grid(
    "fstype <> 'tmpfs'",
    "instance, mountpoint, fstype",
    STEP,
    available="node_filesystem_avail_bytes",
    size="node_filesystem_size_bytes",
)


@check(
    "host_disk_used_on_grid",
    f"""WITH {_DISK_ON_GRID} SELECT instance, mountpoint, fstype, ts,
      100 - available * 100 / size AS disk_used_percent FROM wide""",
)
def host_disk_used_on_grid(spark, sf_dir):
    return counters.disk_used_percent(inputs.metric_samples(spark, sf_dir), step=STEP)


_LOAD_ON_GRID = gauges_on_grid(
    "true", "instance", STEP, load_1m="node_load1", load_5m="node_load5", load_15m="node_load15"
)


@check("host_load_averages_on_grid", f"WITH {_LOAD_ON_GRID} SELECT * FROM wide")
def host_load_averages_on_grid(spark, sf_dir):
    return counters.load_averages(inputs.metric_samples(spark, sf_dir), step=STEP)
