"""The inputs once more, as common table expressions in SQL."""

from __future__ import annotations

BRONZE = """
bronze AS (
  SELECT l_shipdate + to_minutes(CAST((l_orderkey*37 + l_linenumber*11) % 1440 AS INTEGER))
           AS pickup_datetime,
         l_shipdate + to_minutes(CAST((l_orderkey*37 + l_linenumber*11) % 1440
                                      + (l_partkey % 200) - 5 AS INTEGER)) AS dropoff_datetime,
         l_quantity / 4.0e0 AS trip_distance,
         l_linenumber AS passenger_count,
         floor((l_extendedprice/200.0e0)*64.0e0)/64.0e0 - 10.0e0 AS fare_amount,
         CASE WHEN l_partkey % 89 <> 0
              THEN floor((l_extendedprice/200.0e0)*l_discount*64.0e0)/64.0e0 END AS tip_amount,
         floor(l_tax*100.0e0 + 0.5e0) AS tolls_amount,
         CASE WHEN l_partkey % 97 <> 0
              THEN floor((l_extendedprice/200.0e0)*(l_tax+1.0e0)*64.0e0)/64.0e0
              END AS total_amount,
         CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS BIGINT)
           AS payment_type,
         CASE WHEN l_partkey % 101 <> 0 THEN l_suppkey END AS PULocationID,
         l_partkey % 265 AS DOLocationID
  FROM (SELECT *, unnest(range(CASE WHEN l_orderkey % 50 = 0 THEN 2 ELSE 1 END)) FROM lineitem)
)"""

COMPLETE = "pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL" + "".join(
    f" AND {c} IS NOT NULL"
    for c in ("trip_distance", "fare_amount", "total_amount", "passenger_count")
)
MINUTES = "((floor(epoch(dropoff_datetime)) - floor(epoch(pickup_datetime))) / 60.0e0)"
BOUNDS = {
    "fare_out_of_range": "fare_amount BETWEEN 0 AND 500",
    "distance_out_of_range": "trip_distance BETWEEN 0.1e0 AND 100",
    "passengers_out_of_range": "passenger_count BETWEEN 1 AND 6",
    "duration_out_of_range": f"{MINUTES} > 0 AND {MINUTES} <= 180",
}
MEASURES = f"""
  CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
  CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS pickup_dayofweek,
  dayofweek(pickup_datetime) IN (0, 6) AS is_weekend,
  {MINUTES} AS trip_duration_minutes,
  CASE WHEN trip_distance > 0 THEN total_amount / trip_distance END AS price_per_mile"""
MONTH = """
  CAST(year(pickup_datetime) AS INTEGER) AS year,
  CAST(month(pickup_datetime) AS INTEGER) AS month"""

SILVER = f"""{BRONZE},
silver AS (
  SELECT *, {MEASURES}, {MONTH}
  FROM (SELECT DISTINCT * FROM bronze)
  WHERE {COMPLETE} AND dropoff_datetime > pickup_datetime
    AND {' AND '.join(BOUNDS.values())}
)"""

WEATHER = """
weather AS (
  SELECT o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS weather_hour,
         CAST(max(floor(o_totalprice / 10000.0e0)) AS DOUBLE) AS temperature_2m,
         count(*) / 4.0e0 AS precipitation,
         CAST(min(o_custkey % 100) AS DOUBLE) AS relative_humidity_2m,
         CAST(max(o_custkey % 30) AS DOUBLE) AS wind_speed_10m
  FROM orders GROUP BY 1
)"""


def _sample(metric: str, value: str, **labels: str) -> str:
    columns = ", ".join(
        f"'{labels[n]}' AS {n}" if n in labels else f"CAST(NULL AS VARCHAR) AS {n}"
        for n in ("cpu", "mode", "device", "mountpoint", "fstype")
    )
    return (
        f"SELECT ts, '{metric}' AS metric, 'host-' || (user_id % 2) AS instance, {columns}, "
        f"CAST({value} AS DOUBLE) AS value FROM events"
    )


_GAUGE = "floor(value*64.0e0)/64.0e0"
SAMPLES = "samples AS (" + " UNION ALL ".join(
    [
        _sample("node_cpu_seconds_total", "event_id % 500 * 0.75e0", cpu="0", mode="idle"),
        _sample("node_cpu_seconds_total", "event_id % 300 * 0.5e0", cpu="1", mode="idle"),
        _sample("node_cpu_seconds_total", _GAUGE, cpu="0", mode="user"),
        _sample("node_memory_MemAvailable_bytes", _GAUGE),
        _sample("node_memory_MemTotal_bytes", "512"),
        _sample("node_filesystem_avail_bytes", _GAUGE, mountpoint="/", fstype="ext4"),
        _sample("node_filesystem_size_bytes", "1024", mountpoint="/", fstype="ext4"),
        _sample("node_filesystem_avail_bytes", _GAUGE, mountpoint="/run", fstype="tmpfs"),
        _sample("node_filesystem_size_bytes", "512", mountpoint="/run", fstype="tmpfs"),
        _sample("node_disk_read_bytes_total", "event_id*3 % 1000 * 512", device="sda"),
        _sample("node_disk_written_bytes_total", "event_id*7 % 1000 * 512", device="sda"),
        _sample("node_network_receive_bytes_total", "event_id*5 % 2000 * 64", device="eth0"),
        _sample("node_network_transmit_bytes_total", "event_id*9 % 2000 * 64", device="eth0"),
        _sample("node_network_receive_bytes_total", "event_id*5 % 2000 * 32", device="lo"),
        _sample("node_network_transmit_bytes_total", "event_id*9 % 2000 * 32", device="lo"),
        _sample("node_load1", f"{_GAUGE}/64.0e0"),
        _sample("node_load5", f"{_GAUGE}/128.0e0"),
        _sample("node_load15", f"{_GAUGE}/256.0e0"),
    ]
) + ")"


def rates(condition: str, series: str) -> str:
    """Counter rates over the whole history of each series, without any chunking."""
    return f"""{SAMPLES},
linked AS (
  SELECT {series}, CAST(floor(epoch(ts)) AS BIGINT) AS second, value,
         lag(value) OVER s AS before,
         lag(CAST(floor(epoch(ts)) AS BIGINT)) OVER s AS before_at
  FROM samples WHERE {condition}
  WINDOW s AS (PARTITION BY {series} ORDER BY ts, value)
),
seconds AS (
  SELECT {series}, second,
         coalesce(sum(CASE WHEN before_at < second THEN
           CASE WHEN value < before THEN value ELSE value - before END END), 0) AS entering,
         coalesce(sum(CASE WHEN before_at = second THEN
           CASE WHEN value < before THEN value ELSE value - before END END), 0) AS inside
  FROM linked GROUP BY {series}, second
),
rates AS (
  SELECT {series}, CAST(make_timestamp(second * 1000000) AS TIMESTAMP) AS ts,
         CASE WHEN second > min(second) OVER w
              THEN (sum(entering + inside) OVER w - first_value(entering) OVER w)
                   / (second - min(second) OVER w) END AS rate
  FROM seconds
  WINDOW w AS (PARTITION BY {series} ORDER BY second RANGE BETWEEN 300 PRECEDING AND CURRENT ROW)
)"""


def rates_on_grid(condition: str, series: str, step: int) -> str:
    """Counter rates at regular times, from sums over the whole history of each series."""
    on = " AND ".join(f"g.{name} = s.{name}" for name in series.split(", "))
    return f"""{rates(condition, series).rsplit("rates AS (", 1)[0]}
totals AS (
  SELECT {series}, second, inside,
         sum(entering + inside) OVER (PARTITION BY {series} ORDER BY second) AS grown FROM seconds
),
grid AS (
  SELECT DISTINCT {series}, unnest(range(CAST(ceil(second / {step}.0e0) AS BIGINT) * {step},
                                         second + 301, {step})) AS t
  FROM seconds
),
ends AS (
  SELECT g.*, s.second AS to_second, s.grown AS high FROM grid g ASOF JOIN totals s ON {on} AND g.t >= s.second
),
both_ends AS (
  SELECT g.*, s.second AS from_second, s.grown - s.inside AS low
  FROM ends g ASOF JOIN totals s ON {on} AND g.t - 300 <= s.second
),
rates AS (
  SELECT {series}, CAST(make_timestamp(t * 1000000) AS TIMESTAMP) AS ts,
         CASE WHEN to_second > from_second THEN (high - low) / (to_second - from_second) END AS rate
  FROM both_ends WHERE to_second >= t - 300 AND from_second <= t
)"""


def gauges_on_grid(condition: str, keys: str, step: int, **columns: str) -> str:
    """Gauges side by side at regular times, each with its last sample of five minutes."""
    picked = ", ".join(
        f"max(CASE WHEN metric = '{metric}' THEN value END) AS {name}"
        for name, metric in columns.items()
    )
    names = ", ".join(f"'{metric}'" for metric in columns.values())
    on = " AND ".join(f"g.{name} = s.{name}" for name in ["metric", *keys.split(", ")])
    return f"""{SAMPLES},
own AS (
  SELECT metric, {keys}, ts, max(value) AS value FROM samples
  WHERE metric IN ({names}) AND {condition} GROUP BY metric, {keys}, ts
),
grid AS (
  SELECT DISTINCT metric, {keys}, make_timestamp(unnest(range(CAST(ceil(epoch(ts) / {step}.0e0) AS BIGINT) * {step},
    CAST(floor(epoch(ts)) AS BIGINT) + 301, {step})) * 1000000) AS t
  FROM own
),
valued AS (
  SELECT g.*, s.value, s.ts AS sampled FROM grid g ASOF JOIN own s ON {on} AND g.t >= s.ts
),
wide AS (
  SELECT {keys}, CAST(t AS TIMESTAMP) AS ts, {picked} FROM valued
  WHERE sampled > t - INTERVAL 300 SECOND GROUP BY {keys}, t
)"""


def gauges(condition: str, keys: str, **columns: str) -> str:
    """Gauges side by side."""
    picked = ", ".join(
        f"max(CASE WHEN metric = '{metric}' THEN value END) AS {name}"
        for name, metric in columns.items()
    )
    names = ", ".join(f"'{metric}'" for metric in columns.values())
    return f"""{SAMPLES},
wide AS (
  SELECT {keys}, ts, {picked} FROM samples
  WHERE metric IN ({names}) AND {condition} GROUP BY {keys}, ts
)"""
