"""Roll-ups of labelled metric samples: counter rates and ratios of gauges.

Samples are rows ``(ts, metric, labels, value)``. A series is a metric with one set of labels.
One series may hold a large part of all samples, so nothing here puts a whole series into one
task. Rates are computed in chunks of an hour that overlap by the window: samples are dealt by series
and chunk, once, and all steps follow in that order in place. A chunk with very many samples is
sorted and streamed with spilling, never gathered. Only the steps by second hold
``CHUNK + window`` rows at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.functions.temporal import epoch_seconds

# all in seconds
RATE_WINDOW = 300
CHUNK = 3600
GRID_STEP = 15
LOOKBACK = 300


def label(name: str) -> Column:
    """Value of a label; null where a sample does not carry it."""
    return F.try_element_at("labels", F.lit(name))


def samples_of(samples: DataFrame, *metrics: str) -> DataFrame:
    return samples.where(F.col("metric").isin(*metrics))


def without_label(samples: DataFrame, name: str, pattern: str) -> DataFrame:
    """Samples whose label does not match a pattern as a whole; a missing label counts as ''."""
    value = F.coalesce(label(name), F.lit(""))
    return samples.where(~F.rlike(value, F.lit(f"^(?:{pattern})$")))


def latest(samples: DataFrame, end: Column, seconds: int = 3600) -> DataFrame:
    """Samples from ``seconds`` before ``end`` up to it."""
    span = F.make_interval(secs=F.lit(seconds))
    return samples.where(F.col("ts").between(end - span, end))


def _growth(value: Column, before: Column) -> Column:
    """Growth of a counter between two samples; after a reset it has grown from zero."""
    return F.when(value < before, value).otherwise(value - before)


def _in_chunks(at: Column, chunk: int, reach: int) -> Column:
    """The chunks that need a sample: its own, and the next one where that begins within ``reach``."""
    own = F.floor(at / chunk).cast("bigint")
    return F.when(F.pmod(at, F.lit(chunk)) >= chunk - reach, F.array(own, own + 1)).otherwise(F.array(own))


def per_second(samples: DataFrame, labels: tuple[str, ...], reach: int, chunk: int = CHUNK) -> DataFrame:
    """Each counter by chunk and second: growth that leads into the second and growth inside it.

    A chunk is dealt to one task, with the samples of the ``reach`` seconds before it; all that
    follows is computed there, so samples are shuffled once. What leads into the first second of
    a chunk is unknown and counts 0. A metric store holds one sample per series and time stamp;
    should there be more, they are taken in ascending order of their values.
    """
    series = ["metric", *labels]
    at = epoch_seconds(F.col("ts"))
    chunked = samples.where(F.col("value").isNotNull() & F.col("ts").isNotNull()).select(
        "metric",
        *[label(name).alias(name) for name in labels],
        "ts",
        "value",
        at.alias("at"),
        F.explode(_in_chunks(at, chunk, reach)).alias("chunk"),
    )
    in_order = Window.partitionBy(*series, "chunk").orderBy("ts", "value")
    linked = chunked.withColumns(
        {
            "growth": _growth(F.col("value"), F.lag("value").over(in_order)),
            "before": F.lag("at").over(in_order),
        }
    )

    def grown(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("growth"))), F.lit(0.0))

    return linked.groupBy(*series, "chunk", "at").agg(
        grown(F.col("before") < F.col("at")).alias("entering"),
        grown(F.col("before") == F.col("at")).alias("within"),
    )


def counter_rate(
    samples: DataFrame, labels: tuple[str, ...], window: int = RATE_WINDOW
) -> DataFrame:
    """Growth per second over a trailing window, at each second with a sample.

    This is the growth between the samples in the window over the time from the first of them;
    null where they all lie in one second. Since growth that leads into the window does not
    count, a chunk with the ``window`` seconds before it has all that its rows need.
    """
    series, chunk = ["metric", *labels], max(CHUNK, window)
    seconds = per_second(samples, labels, window, chunk)
    in_chunk = Window.partitionBy(*series, "chunk").orderBy("at")
    trailing = in_chunk.rangeBetween(-window, Window.currentRow)
    grown = F.sum(F.col("entering") + F.col("within")).over(trailing) - F.first(
        "entering"
    ).over(trailing)
    elapsed = F.col("at") - F.min("at").over(trailing)
    rated = seconds.withColumn("rate", F.when(elapsed > 0, grown / elapsed))
    return rated.where(F.col("chunk") == F.floor(F.col("at") / chunk)).select(
        *series, F.timestamp_seconds("at").alias("ts"), "rate"
    )


def _steps(first: Column, last: Column, step: int) -> Column:
    """The multiples of ``step`` from ``first`` to ``last``, both included; none if there is none."""
    size = F.lit(step).cast("bigint")
    low, high = first + F.pmod(-first, size), last - F.pmod(last, size)
    return F.when(low <= high, F.sequence(low, high, size)).otherwise(F.array().cast("array<bigint>"))


def latest_on_grid(
    samples: DataFrame, labels: tuple[str, ...], step: int = GRID_STEP, lookback: int = LOOKBACK
) -> DataFrame:
    """Each series at regular times: its last sample, if that is younger than ``lookback`` seconds.

    The times are the multiples of ``step`` seconds. A sample stands for the times from its own
    to that of the next one. It is dealt to its own chunk of time and to the next one if it is still
    valid there, so a chunk knows what to begin with and no window spans a series. Of samples
    with one time stamp the highest value counts.
    """
    series, chunk = ["metric", *labels], max(CHUNK, lookback)
    at = epoch_seconds(F.col("ts"))
    chunked = samples.where(F.col("value").isNotNull() & F.col("ts").isNotNull()).select(
        "metric",
        *[label(name).alias(name) for name in labels],
        F.unix_micros("ts").alias("micros"),
        "value",
        F.explode(_in_chunks(at, chunk, lookback)).alias("chunk"),
    )
    in_order = Window.partitionBy(*series, "chunk").orderBy("micros", "value")
    following = F.lead("micros").over(in_order)
    begin, end = F.col("chunk") * chunk * 1_000_000, (F.col("chunk") + 1) * chunk * 1_000_000
    # half-open in microseconds: until the next sample, the end of its validity or of the chunk
    until = F.least(following, F.col("micros") + lookback * 1_000_000, end)
    points = _steps(F.greatest("micros", begin), until - 1, step * 1_000_000)
    served = chunked.select(*series, "value", points.alias("points"))
    return served.select(*series, F.explode("points").alias("at"), "value").select(
        *series, F.timestamp_micros("at").alias("ts"), "value"
    )


def rate_on_grid(
    samples: DataFrame,
    labels: tuple[str, ...],
    step: int = GRID_STEP,
    window: int = RATE_WINDOW,
) -> DataFrame:
    """Growth of each counter per second over the ``window`` before regular times.

    As :func:`counter_rate`, but at the multiples of ``step`` seconds, wherever a sample lies in
    the window; null where they all lie in one second. A second is the last one in the window of the times
    up to the next second, and the first one in that of the times until the second before it has left,
    so the two ends of each window are found without looking at what lies between.
    """
    series, chunk = ["metric", *labels], max(CHUNK, window)
    seconds = per_second(samples, labels, window, chunk)
    in_chunk = Window.partitionBy(*series, "chunk").orderBy("at")
    so_far = F.sum(F.col("entering") + F.col("within")).over(
        in_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    begin, end = F.col("chunk") * chunk, (F.col("chunk") + 1) * chunk - 1
    at = F.col("at")
    as_last = _steps(
        F.greatest(at, begin), F.least(F.lead("at").over(in_chunk) - 1, at + window, end), step
    )
    as_first = _steps(
        F.greatest(at, F.lag("at").over(in_chunk) + window + 1, begin), F.least(at + window, end), step
    )
    ends = seconds.select(
        *series, "chunk", "at", "within", so_far.alias("grown"), as_last.alias("as_last"), as_first.alias("as_first")
    )
    tagged = F.concat(
        F.transform("as_last", lambda t: F.struct(t.alias("t"), F.lit(True).alias("last"))),
        F.transform("as_first", lambda t: F.struct(t.alias("t"), F.lit(False).alias("last"))),
    )
    points = ends.select(*series, "chunk", "at", "within", "grown", F.explode(tagged).alias("p"))
    last = F.col("p.last")
    joined = points.groupBy(*series, "chunk", F.col("p.t").alias("t")).agg(
        F.max(F.when(last, F.col("grown"))).alias("high"),
        F.max(F.when(~last, F.col("grown") - F.col("within"))).alias("low"),
        F.max(F.when(last, at)).alias("to"),
        F.max(F.when(~last, at)).alias("from"),
    )
    elapsed = F.col("to") - F.col("from")
    rate = F.when(elapsed > 0, (F.col("high") - F.col("low")) / elapsed)
    return joined.select(*series, F.timestamp_seconds("t").alias("ts"), rate.alias("rate"))


def cpu_busy_percent(samples: DataFrame, step: int | None = None) -> DataFrame:
    """100 minus the idle share in percent, averaged over the processors of an instance.

    With a ``step`` this is evaluated at regular times, else where samples are.
    """
    idle = samples_of(samples, "node_cpu_seconds_total").where(label("mode") == "idle")
    rates = _rates(idle, ("instance", "cpu"), step)
    busy = F.lit(100.0) - F.avg("rate") * 100.0
    return rates.groupBy("instance", "ts").agg(busy.alias("cpu_busy_percent"))


def _rates(samples: DataFrame, labels: tuple[str, ...], step: int | None) -> DataFrame:
    return counter_rate(samples, labels) if step is None else rate_on_grid(samples, labels, step)


def side_by_side(
    samples: DataFrame, metrics: dict[str, str], labels: tuple[str, ...], step: int | None = None
) -> DataFrame:
    """Gauges with equal labels and time in one row: metric name -> column name.

    With a ``step`` the times are regular ones, and each gauge has its last value there.
    """
    columns = [
        F.max(F.when(F.col("metric") == metric, F.col("value"))).alias(name)
        for metric, name in metrics.items()
    ]
    own = samples_of(samples, *metrics)
    if step is not None:
        return latest_on_grid(own, labels, step).groupBy(*labels, "ts").agg(*columns)
    keys = [label(name).alias(name) for name in labels]
    return own.groupBy(*keys, "ts").agg(*columns)


def memory_used_percent(samples: DataFrame, step: int | None = None) -> DataFrame:
    gauges = {
        "node_memory_MemAvailable_bytes": "available",
        "node_memory_MemTotal_bytes": "total",
    }
    used = (F.lit(1.0) - F.try_divide("available", "total")) * 100.0
    return side_by_side(samples, gauges, ("instance",), step).select(
        "instance", "ts", used.alias("memory_used_percent")
    )


def disk_used_percent(
    samples: DataFrame, excluded: str = "tmpfs", step: int | None = None
) -> DataFrame:
    """Used share of each file system in percent, leaving out one type."""
    gauges = {"node_filesystem_avail_bytes": "available", "node_filesystem_size_bytes": "size"}
    kept = samples.where(F.coalesce(label("fstype"), F.lit("")) != excluded)
    used = F.lit(100.0) - F.try_divide(F.col("available") * 100.0, F.col("size"))
    keys = ("instance", "mountpoint", "fstype")
    return side_by_side(kept, gauges, keys, step).select(*keys, "ts", used.alias("disk_used_percent"))


def disk_rates(samples: DataFrame, step: int | None = None) -> DataFrame:
    """Bytes read and written per second, by device."""
    counters = samples_of(samples, "node_disk_read_bytes_total", "node_disk_written_bytes_total")
    return _rates(counters, ("instance", "device"), step)


def network_rates(
    samples: DataFrame, excluded: str = "lo", step: int | None = None
) -> DataFrame:
    """Bytes received and sent per second, by device, leaving out some devices."""
    counters = samples_of(
        samples, "node_network_receive_bytes_total", "node_network_transmit_bytes_total"
    )
    return _rates(without_label(counters, "device", excluded), ("instance", "device"), step)


def load_averages(samples: DataFrame, step: int | None = None) -> DataFrame:
    """Load over 1, 5 and 15 minutes in one row."""
    gauges = {"node_load1": "load_1m", "node_load5": "load_5m", "node_load15": "load_15m"}
    return side_by_side(samples, gauges, ("instance",), step)
