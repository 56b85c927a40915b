"""Token sequences of a fixed length, packed by best fit and a swap-based local search."""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions.columns import free_name
from tripmart.llm.common import stored
from tripmart.llm.tokens import RANKS, VOCABULARY, encoder, vocabulary_path

END = 2  # fixed value: the id after every document
GROUP_ROWS = 8_192


def piece_bounds(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece: whole pieces at the end, a shorter one first."""
    if length <= capacity:
        return [(0, length)]
    first = length % capacity
    starts = [0] * bool(first) + list(range(first, length, capacity))
    return list(zip(starts, np.diff([*starts, length]).tolist()))


def token_pieces(
    docs: DataFrame,
    capacity: int = 1024,
    vocabulary: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, piece, start, length, ids)``: every document's ids and the end id, cut in pieces.

    ``ids`` are little-endian unsigned 32-bit numbers. Null and empty texts are one piece that
    holds only the end id. Repeated rows give repeated pieces. Only the two named columns are read.
    """
    import pyarrow as pa

    vocabulary = vocabulary or vocabulary_path(VOCABULARY)
    ranks = vocabulary_path(RANKS)
    id_type = docs.select(id_col).schema[0].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, ranks)
        end = np.array([END], dtype="<u4")
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                rows, piece, start, length, ids = [], [], [], [], []
                for row, text in enumerate(part.column(1).to_pylist()):
                    tokens = np.concatenate([encode(text), end])
                    for number, (begin, size) in enumerate(piece_bounds(len(tokens), capacity)):
                        rows.append(row)
                        piece.append(number)
                        start.append(begin)
                        length.append(size)
                        ids.append(tokens[begin : begin + size].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(rows, pa.int64())),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids"],
                )

    schema = f"doc_id {id_type}, piece int, start long, length long, ids binary"
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        cut, schema
    )


class Bins:
    """Items in bins of one capacity; lengths are whole numbers from 1 to the capacity."""

    def __init__(self, lengths, capacity: int):
        self.lengths = [int(x) for x in lengths]
        self.capacity = capacity
        self.items: list[list[int]] = []
        self.fill: list[int] = []

    def best_fit(self) -> None:
        """Longest first, each into the bin that it fills best; open gaps are bits of one number."""
        by_gap: dict[int, list[int]] = defaultdict(list)
        gaps = 0
        for item in sorted(range(len(self.lengths)), key=lambda i: -self.lengths[i]):
            length = self.lengths[item]
            able = gaps >> length
            if able:
                gap = length + (able & -able).bit_length() - 1
                where = by_gap[gap].pop()
                if not by_gap[gap]:
                    gaps &= ~(1 << gap)
                self.items[where].append(item)
                self.fill[where] += length
            else:
                where, gap = len(self.items), self.capacity
                self.items.append([item])
                self.fill.append(length)
            gap -= length
            if gap:
                by_gap[gap].append(where)
                gaps |= 1 << gap

    def fewest(self) -> int:
        return -(-sum(self.lengths) // self.capacity)

    def open_bins(self) -> int:
        return sum(1 for items in self.items if items)

    def search(self) -> None:
        """Empty the least filled bin again and again, until the others take no more.

        What leaves it is a single item (a move), an item for a shorter one, or two items for
        a shorter one. Each step moves length from a less filled bin to a fuller one, so the sum
        of squared fill rises and the search ends: when a round over all bins changes nothing.
        """
        before = None
        while self.open_bins() > self.fewest() and before != (now := sum(f * f for f in self.fill)):
            before = now
            self._round()

    def _round(self) -> None:
        room = Room(self)
        free = sum(self.capacity - f for f, items in zip(self.fill, self.items) if items)
        waiting = [(f, i) for i, f in enumerate(self.fill) if self.items[i] and f < self.capacity]
        for _, where in waiting:
            room.enter(where)
        heapq.heapify(waiting)
        while waiting:
            fill, source = heapq.heappop(waiting)
            if fill != self.fill[source]:  # it has taken something meanwhile
                if self.fill[source] < self.capacity:
                    heapq.heappush(waiting, (self.fill[source], source))
                continue
            if free - (self.capacity - fill) < fill:
                return  # all the room elsewhere could not hold what is in it
            room.leave(source)  # for the rest of the round, so that what takes is never less filled
            self._drain(source, room)
            if not self.items[source]:
                free -= self.capacity

    def _drain(self, source: int, room: Room) -> None:
        """Steps out of one bin until none of the three kinds is left, whatever bin it leads to."""
        while self.items[source]:
            best = None
            own = sorted(self.items[source], key=lambda i: -self.lengths[i])
            offers = {self.lengths[a]: (a,) for a in own}
            for i, a in enumerate(own):
                for b in own[i + 1 :]:
                    offers.setdefault(self.lengths[a] + self.lengths[b], (a, b))
            for total, leaving in offers.items():
                size = room.tightest(total)
                if size is None:
                    continue
                gain = total - room.least[size]
                # a perfect fit first, then the most length moved
                rank = (size == total, gain if size != total else 1, gain)
                if best is None or rank > best[0]:
                    best = (rank, leaving, size)
            if best is None:
                return
            _, leaving, size = best
            where, back = room.first(size)
            room.leave(where)
            moved = sum(self.lengths[i] for i in leaving)
            for item in leaving:
                self.items[source].remove(item)
                self.items[where].append(item)
            if back >= 0:
                self.items[where].remove(back)
                self.items[source].append(back)
                moved -= self.lengths[back]
            self.fill[source] -= moved
            self.fill[where] += moved
            room.enter(where)


class Room:
    """What bins can take: by size, the bins with that gap once they gave back one item or none."""

    def __init__(self, bins: Bins):
        self.bins = bins
        # (length given back, bin, item given back, changes the bin had seen), the least first
        self.held: list[list[tuple[int, int, int, int]]] = [[] for _ in range(bins.capacity + 1)]
        self.changes: dict[int, int] = defaultdict(int)
        # the length given back by the first of each size, which always holds
        self.least = np.full(bins.capacity + 1, bins.capacity + 1, dtype=np.int64)

    def _entries(self, where: int) -> Iterator[tuple[int, int, int]]:
        gap = self.bins.capacity - self.bins.fill[where]
        yield gap, 0, -1
        for item in self.bins.items[where]:
            yield gap + self.bins.lengths[item], self.bins.lengths[item], item

    def enter(self, where: int) -> None:
        if self.bins.fill[where] == self.bins.capacity:
            return
        for size, back, item in self._entries(where):
            heapq.heappush(self.held[size], (back, where, item, self.changes[where]))
            self.least[size] = self.held[size][0][0]

    def leave(self, where: int) -> None:
        """To be called before the bin changes; its entries are dropped when they come first."""
        self.changes[where] += 1
        for size in {size for size, _, _ in self._entries(where)}:
            held = self.held[size]
            while held and held[0][3] != self.changes[held[0][1]]:
                heapq.heappop(held)
            self.least[size] = held[0][0] if held else self.bins.capacity + 1

    def tightest(self, total: int) -> int | None:
        """The least size that takes so much and gives back less."""
        useful = self.least[total:] < total
        at = int(useful.argmax())
        return total + at if useful[at] else None

    def first(self, size: int) -> tuple[int, int]:
        return self.held[size][0][1:3]


def pack_group(lengths, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin number, offset in the bin, and the bin's fill, for each length."""
    bins = Bins(lengths, capacity)
    bins.best_fit()
    bins.search()
    number = np.zeros(len(bins.lengths), dtype=np.int64)
    offset = np.zeros(len(bins.lengths), dtype=np.int64)
    fill = np.zeros(len(bins.lengths), dtype=np.int64)
    for where, items in enumerate(b for b in bins.items if b):
        total = 0
        for item in items:
            number[item], offset[item] = where, total
            total += bins.lengths[item]
        fill[items] = total
    return number, offset, fill


def _packer(capacity: int, level: int, group: str, fill: str):
    def packed(table: pa.Table) -> pa.Table:
        numbers, offsets, fills = pack_group(table.column("length").to_numpy(), capacity)
        base = (level << 56) + (table.column(group)[0].as_py() << 24)
        columns = {"sequence_id": base + numbers, "offset": offsets, fill: fills}
        kept = table.drop_columns([group])
        for name, values in columns.items():
            kept = kept.append_column(name, pa.array(values, pa.int64()))
        return kept

    return packed


def pack(pieces: DataFrame, capacity: int = 1024, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; every other column is kept as it is.

    Pieces are dealt evenly, whatever their ids, into groups of about ``group_rows``, each packed in
    one task by best fit and local search. Sequences with a gap over a 64th of the capacity are
    dissolved, and their pieces packed again in fewer groups; the others stay as they are. That ends
    when one group holds the rest, or with several groups as they are when a level had more than half
    of the pieces of the one before. So what is wasted grows with the input: the gaps of the sequences
    that stay and, in the second case, underfull ones in each group. Lengths have to lie between 1 and
    ``capacity``.

    Repeated rows are packed as often as they come. An empty table gives no rows. Columns named
    ``sequence_id`` or ``offset`` in the input are replaced; all others may have any name.
    """
    # rows are dealt by a number of their own: ids may be null or repeated
    given = pieces.drop("sequence_id", "offset")
    row, group, fill = (free_name(name, given.columns) for name in ("__row", "__group", "__fill"))
    kept = given.withColumn(row, F.monotonically_increasing_id())
    names, types = kept.columns, [f.dataType.simpleString() for f in kept.schema]
    schema = ", ".join(
        f"`{n}` {t}" for n, t in zip([*names, "sequence_id", "offset", fill], [*types, "long", "long", "long"])
    )
    waiting, done, level, before = stored(kept, "pieces"), [], 0, None
    while True:
        count = waiting.count()
        groups = max(1, -(-count // group_rows))
        spread = waiting.withColumn(group, F.pmod(F.xxhash64(row, F.lit(level)), F.lit(groups)))
        packer = _packer(capacity, level, group, fill)
        result = stored(spread.groupBy(group).applyInArrow(packer, schema), "packed")
        if groups == 1 or (before is not None and count > before / 2):  # packing again gains little
            done.append(result)
            break
        full = F.col(fill) >= capacity - capacity // 64
        done.append(result.where(full))
        again = result.where(~full).drop("sequence_id", "offset", fill)
        waiting, level, before = again, level + 1, count
    out = done[0]
    for part in done[1:]:
        out = out.union(part)
    return out.drop(fill, row)
