"""Shards of near-equal size over contiguous runs of whole groups."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import stored

COARSE_BITS, FINE_BITS = 16, 10  # resolution of the order: runs of groups, and runs inside a cut run
ROW_OVERHEAD = 16
BLOCK_ROWS = 20_000


def shards_needed(ends: np.ndarray, capacity: int, most: int) -> list[int]:
    """Where each shard starts when filled in order up to ``capacity``; more than ``most``: give up.

    ``ends`` are running totals of the ordered sizes.
    """
    starts, at, filled = [], 0, 0
    while at < len(ends) and len(starts) <= most:
        starts.append(at)
        at = int(np.searchsorted(ends, filled + capacity, side="right"))
        filled = int(ends[at - 1]) if at else 0
        if at == starts[-1]:  # a size beyond the capacity
            return [*starts, *range(most + 1)]
    return starts


def minimax_starts(sizes: Sequence[int], n_shards: int) -> list[int]:
    """Starts of at most ``n_shards`` contiguous runs whose largest total is as small as possible."""
    sizes = np.asarray(sizes, dtype=np.int64)
    if not len(sizes):
        return []
    ends = np.cumsum(sizes)
    low = max(int(sizes.max()), -(-int(ends[-1]) // n_shards))
    high = max(low, int(ends[-1]))
    while low < high:
        middle = (low + high) // 2
        if len(shards_needed(ends, middle, n_shards)) <= n_shards:
            high = middle
        else:
            low = middle + 1
    return _evened(ends, low, n_shards)


def _evened(ends: np.ndarray, capacity: int, n_shards: int) -> list[int]:
    """Cuts within ``capacity``, each as near to an equal share of the rest as that allows.

    Filling every shard to the brim would leave the difference to the last one.
    """
    latest = [len(ends)]  # where the last k shards may begin at the earliest
    for _ in range(n_shards - 1):
        end = int(ends[latest[-1] - 1]) if latest[-1] else 0
        latest.append(int(np.searchsorted(ends, end - capacity, side="left")) + 1 if end > capacity else 0)
    starts, at, filled = [], 0, 0
    for left in range(n_shards, 0, -1):
        if at >= len(ends):
            break
        starts.append(at)
        most = int(np.searchsorted(ends, filled + capacity, side="right"))
        share = filled + (int(ends[-1]) - filled) / left
        near = int(np.searchsorted(ends, share, side="left")) + 1
        if near - 1 > at and share - ends[near - 2] < ends[min(near, len(ends)) - 1] - share:
            near -= 1
        at = min(max(near, latest[left - 1], at + 1), most)
        filled = int(ends[at - 1])
    return starts


def cut(prefixes: Sequence[int], sizes: Sequence[int], n_shards: int) -> tuple[dict, list[int]]:
    """Own shards of runs too large to share one, and the prefixes at which the others are cut.

    A run of at least an equal share takes a shard of its own and leaves the order; otherwise the
    least capacity would be that run's size and most shards would stay empty.
    """
    order = np.argsort(np.asarray(prefixes, dtype=np.int64), kind="stable")
    prefixes = np.asarray(prefixes, dtype=np.int64)[order]
    sizes = np.asarray(sizes, dtype=np.int64)[order]
    own: dict[int, int] = {}
    rest = np.ones(len(sizes), dtype=bool)
    for i in np.argsort(-sizes, kind="stable"):
        left = n_shards - len(own)
        if left <= 1 or sizes[i] * left <= int(sizes[rest].sum()) or rest.sum() <= 1:
            break
        own[int(prefixes[i])] = len(own)
        rest[i] = False
    starts = minimax_starts(sizes[rest], n_shards - len(own))
    return own, [int(prefixes[rest][i]) for i in starts]


def shard_documents(
    docs: DataFrame,
    n_shards: int = 40,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)`` for every row; equal texts share a shard.

    Groups of equal texts are ordered by the hash of the text. Their sizes are added up over 65,536
    runs of that order, a vector of fixed length, on which the smallest feasible capacity of a shard
    is found by binary search with a greedy check. The runs in which a cut falls, and runs with
    a large group, are looked at once more, 1,024 times finer, before the final cuts. A shard is
    then a function of the text's hash, so no row is joined to find it.

    Slots count gaplessly from 0 in each shard: rows of a shard are dealt, whatever their ids, into blocks of
    about ``block_rows``, numbered inside the block and shifted by the rows in earlier blocks, so a
    shard with a third of all rows is no single task.

    A null text has no bytes and checksum 0, as an empty one, but is a group of its own. Repeated
    rows each get a slot. A null id is an id like others. An empty table gives no rows. Only the
    two named columns are read.
    """
    fine = 64 - COARSE_BITS - FINE_BITS
    rows = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.coalesce(F.octet_length(text_col), F.lit(0)) + ROW_OVERHEAD).cast("long").alias("size"),
            F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"),
            F.shiftrightunsigned(F.xxhash64(text_col), fine).alias("run"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shards",
    )
    coarse = F.shiftright("run", FINE_BITS)
    totals = rows.groupBy(coarse.alias("run")).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    runs = totals.toPandas()
    wide = runs.run.to_numpy(dtype="int64") << FINE_BITS
    own, starts = cut(wide, runs["size"], n_shards)
    again = {p >> FINE_BITS for p in [*own, *starts]}
    again |= {p - 1 for p in again}  # a cut may move to either side of the start of a run
    inner = (
        rows.where(coarse.isin([int(x) for x in again] or [-1]))
        .groupBy("run")
        .agg(F.sum("size").alias("size"))
        .toPandas()
    )
    keep = ~runs.run.isin(again).to_numpy(dtype=bool)
    own, starts = cut(
        [*wide[keep], *inner.run.to_numpy(dtype="int64")],
        [*runs["size"][keep], *inner["size"]],
        n_shards,
    )
    shard: Column = F.lit(len(own) - 1)
    for start in starts:
        shard = shard + (F.col("run") >= start).cast("int")
    for run, number in own.items():
        shard = F.when(F.col("run") == run, number).otherwise(shard)
    total = int(runs["n"].sum()) if len(runs) else 0
    blocks = max(1, -(-total // block_rows))
    placed = rows.select(
        "doc_id", "size", "text_crc32", shard.cast("int").alias("shard"),
        F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"),
    )
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("shard", "block").agg(F.count("*").alias("n")).select(
        "shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy("shard", "block").orderBy("doc_id", "text_crc32", "size")
    return (
        placed.join(offsets, ["shard", "block"])
        .withColumn("slot", (F.row_number().over(inside) - 1 + F.col("offset")).cast("long"))
        .select("doc_id", "size", "text_crc32", "shard", "slot")
    )
