"""Benchmark passages in documents, by greedy string tiling over Karp-Rabin seeds."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import IdFilter, id_as_text, id_from_text, release, slices, stored
from tripmart.llm.shingles import PLAIN, mix, words

TILE_WORDS = 5
COVERAGE = 0.5
STOCK_ITEMS = 20  # a window of more items than these is a stock phrase
_BASE = 0x2545F4914F6CDD1D  # odd, so that it has an inverse modulo 2**64


class RollingHash:
    """Karp-Rabin hashes of every window of a sequence of word hashes, for any window length."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        powers = np.full(n + 1, _BASE, dtype=np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers, dtype=np.uint64)
        back = np.full(n + 1, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
        back[0] = 1
        self.back = np.cumprod(back, dtype=np.uint64)
        self.sums = np.concatenate(
            [np.zeros(1, np.uint64), np.cumsum(hashes * powers[:n], dtype=np.uint64)]
        )

    def windows(self, width: int) -> np.ndarray:
        """One hash per start: equal windows have equal hashes wherever they are."""
        if len(self.sums) <= width:
            return np.zeros(0, np.uint64)
        return mix((self.sums[width:] - self.sums[:-width]) * self.back[: len(self.sums) - width])


def seeds(texts: list[bytes], widths: Iterable[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per width: (width, text number, hash) and place of each window of words, text by text."""
    hashes, _, counts = words(texts, PLAIN)
    rolling = RollingHash(hashes)
    owner = np.repeat(np.arange(len(texts)), counts)
    first = np.repeat(np.cumsum(counts) - counts, counts)
    place = np.arange(len(hashes)) - first
    for width in widths:
        window = rolling.windows(width)
        whole = owner[: len(window)] == owner[width - 1 : width - 1 + len(window)]
        yield width, owner[: len(window)][whole], place[: len(window)][whole], window[whole]


def matches(d: np.ndarray, i: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """Longest common runs (length, document word, item word) that the seed pairs make up."""
    order = np.lexsort((d, d - i))
    d, i = d[order], i[order]
    ends = np.nonzero((np.diff(d) != 1) | (np.diff(d - i) != 0))[0] + 1
    starts = np.concatenate([[0], ends]).astype(np.int64)
    lengths = np.diff(np.append(starts, len(d))) + width - 1
    return list(zip(lengths.tolist(), d[starts].tolist(), i[starts].tolist()))


def tile(d: np.ndarray, i: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (document word, item word, length): longest first, no word used twice.

    A match that earlier tiles have eaten into is cut to what is left of it, as long as that is
    a seed long, and takes its turn again at its new length.
    """
    heap = [(-n, a, b) for n, a, b in matches(d, i, width)]
    heapq.heapify(heap)
    used_d: set[int] = set()
    used_i: set[int] = set()
    tiles = []
    while heap:
        n, a, b = heapq.heappop(heap)
        n = -n
        free = [a + k not in used_d and b + k not in used_i for k in range(n)]
        if all(free):
            tiles.append((a, b, n))
            used_d.update(range(a, a + n))
            used_i.update(range(b, b + n))
            continue
        start = None
        for k, is_free in enumerate([*free, False]):
            if is_free and start is None:
                start = k
            elif not is_free and start is not None:
                if k - start >= width:
                    heapq.heappush(heap, (start - k, a + start, b + start))
                start = None
    return sorted(tiles)


def find_passages(
    docs: DataFrame,
    items: DataFrame,
    coverage: float = COVERAGE,
    tile_words: int = TILE_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``(doc_id, item_id, item_words, matched_words, coverage, tiles)`` of contaminated documents.

    A document holds an item when tiles of at least ``tile_words`` words cover at least
    ``coverage`` of the item's words, in whatever order they stand in the document. Words are
    compared without ASCII punctuation and case. ``tiles`` lists (doc_word, item_word, words).

    Windows of every document are held against a bitmap of fixed size of the items' windows; what
    passes is joined with the items by hash, so neither table has to be small. Windows that more than
    ``STOCK_ITEMS`` items share do not make a pair by themselves, unless they alone could cover
    enough of the item: else a document needs another window of the item in any case. Of the pairs
    found, those go on whose shared windows together reach ``coverage`` of the item's words, which no
    tiling can exceed. A pair of document and item is tiled in one task, from its shared windows alone.

    Items of fewer words than a tile have to occur as a whole. Null and empty texts match nothing.
    Rows that repeat an id with another text are looked at one by one; equal rows count once; null
    ids are kept as null. Empty tables give no rows. Only the named columns are read.
    """
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    item_type = items.select(item_col).schema[0].dataType.simpleString()

    def item_seeds(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames, 1_000):
            texts = [(t or "").encode() for t in frame["text"]]
            counts = words(texts, PLAIN)[2]
            for width, owner, place, window in seeds(texts, range(1, tile_words + 1)):
                own = np.minimum(counts[owner], tile_words) == width
                yield pd.DataFrame(
                    {
                        "item_id": frame["item_id"].to_numpy()[owner[own]],
                        "item_key": frame["item_key"].to_numpy()[owner[own]],
                        "item_words": counts[owner[own]],
                        "width": np.full(own.sum(), width, np.int32),
                        "item_at": place[own],
                        "seed": window[own].astype(np.int64),
                    }
                )

    item_rows = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).distinct()
    known = _with_stock(
        stored(
            item_rows.select(
                id_as_text("item_id", item_type).alias("item_id"), F.xxhash64("item_id", "text").alias("item_key"), "text"
            ).mapInPandas(
                item_seeds,
                "item_id string, item_key long, item_words long, width int, item_at long, seed long",
            ),
            "item-seeds",
        ),
        coverage,
    )
    widths = sorted(r["width"] for r in known.select("width").distinct().collect())
    wanted = IdFilter.of(known, "seed", direct=True)

    def hits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames, 500):
            texts = [(t or "").encode() for t in frame["text"]]
            for width, owner, place, window in seeds(texts, widths):
                hit = wanted.may_hold((window % np.uint64(IdFilter.BITS)).astype(np.int64))
                yield pd.DataFrame(
                    {
                        "doc_id": frame["doc_id"].to_numpy()[owner[hit]],
                        "text_key": frame["text_key"].to_numpy()[owner[hit]],
                        "width": np.full(hit.sum(), width, np.int32),
                        "doc_at": place[hit],
                        "seed": window[hit].astype(np.int64),
                    }
                )

    rows = docs.select(
        id_as_text(id_col, id_type).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text")
    )
    found = stored(
        rows.mapInPandas(hits, "doc_id string, text_key long, width int, doc_at long, seed long").distinct(), "hits"
    )
    pairs = stored(_seed_pairs(found, known), "seed-pairs")
    release(found)
    pair = ("doc_id", "text_key", "item_key")
    # equal by nulls too, so that documents without an id are not lost
    able = _reaching(pairs, pair, coverage).toDF("doc", "text", "item")
    same = F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("text_key") == F.col("text")) & (F.col("item_key") == F.col("item"))

    def tiled(frame: pd.DataFrame) -> pd.DataFrame:
        first = frame.iloc[0]
        tiles = tile(frame["doc_at"].to_numpy(), frame["item_at"].to_numpy(), int(first["width"]))
        matched = sum(n for _, _, n in tiles)
        return pd.DataFrame(
            {
                "doc_id": frame["doc_id"].iloc[:1],
                "item_id": frame["item_id"].iloc[:1],
                "item_words": [int(first["item_words"])],
                "matched_words": [matched],
                "coverage": [matched / int(first["item_words"])],
                "tiles": [tiles],
            }
        )

    tiles = stored(
        pairs.join(able, same, "left_semi")
        .groupBy(*pair)
        .applyInPandas(
            tiled,
            "doc_id string, item_id string, item_words long, matched_words long, "
            "coverage double, tiles array<struct<doc_word:long,item_word:long,words:long>>",
        )
        .where(F.col("coverage") >= coverage),
        "tiles",
    )
    release(pairs)
    return tiles.withColumns(
        {"doc_id": id_from_text("doc_id", id_type), "item_id": id_from_text("item_id", item_type)}
    )


def _covered(places: Column, width: Column) -> Column:
    """How many words windows of one width at these places cover together."""
    sorted_places = F.array_sort(places)
    after = F.slice(sorted_places, 2, F.greatest(F.size(sorted_places) - 1, F.lit(0)))
    gaps = F.zip_with(F.slice(sorted_places, 1, F.size(after)), after, lambda a, b: F.least(b - a, width))
    return F.aggregate(gaps, width.cast("long"), lambda total, gap: total + gap)


def _reaching(rows: DataFrame, keys: Iterable[str], coverage: float) -> DataFrame:
    """The keys whose windows together cover enough of the item to be worth tiling."""
    gathered = rows.groupBy(*keys).agg(
        F.collect_set("item_at").alias("places"),  # no more than the item has words
        F.first("width").alias("width"),
        F.first("item_words").alias("item_words"),
    )
    enough = _covered(F.col("places"), F.col("width")) >= F.col("item_words") * coverage
    return gathered.where(enough).select(*keys)


def _with_stock(known: DataFrame, coverage: float) -> DataFrame:
    """Item windows with ``lone``: whether a document that has this window may be held against the item.

    Windows of many items are not, unless these alone can cover enough of the item.
    """
    shared = known.groupBy("seed", "width").agg(F.count_distinct("item_key").alias("n"))
    stock = stored(
        known.join(shared, ["seed", "width"]).withColumn("stock", F.col("n") > STOCK_ITEMS).drop("n"), "stock"
    )
    by_stock = _reaching(stock.where("stock"), ["item_key"], coverage).withColumn("by_stock", F.lit(True))
    flagged = stock.join(by_stock, "item_key", "left")
    return stored(
        flagged.withColumn("lone", ~F.col("stock") | F.coalesce("by_stock", F.lit(False))).drop("stock", "by_stock"),
        "known",
    )


def _seed_pairs(found: DataFrame, known: DataFrame) -> DataFrame:
    """Windows that a document and an item share, for the pairs that need to be looked at."""
    direct = stored(found.join(known.where("lone").drop("lone"), ["seed", "width"]), "direct")
    stock = known.where("not lone").drop("lone")
    in_stock = stock.select("seed", "width").distinct()
    pairs = direct.select("doc_id", "text_key", "item_key").distinct()
    candidates = pairs.join(stock.select("item_key").distinct(), "item_key", "left_semi").select(
        F.col("doc_id").alias("doc"), F.col("text_key").alias("text"), "item_key"
    )
    same = F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("text_key") == F.col("text"))
    more = (
        found.join(in_stock, ["seed", "width"], "left_semi")
        .join(candidates, same)
        .drop("doc", "text")
        .join(stock, ["item_key", "seed", "width"])
    )
    return direct.unionByName(more).drop("seed")
