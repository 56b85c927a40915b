"""Ranked lexical search by upper bounds from hashed sketches of term impacts."""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import ready, stored
from tripmart.llm.words import term_counts

SKETCH = 4096  # coordinates of a document's sketch
DOCUMENTS = 256  # documents whose bounds are looked up at once
MOST_COUNTS = 200_000  # counts that a task holds before it passes them on
# a block of items: what is broadcast at once
ITEMS_PER_BLOCK = 1000
BLOCK_BYTES = 8 << 20


def impact(tf, m):
    """What a term adds to a score for each unit of its weight; grows with ``tf``."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


@dataclass
class Corpus:
    """Statistics of all documents: how many have a term, how many terms, documents by term."""

    n_docs: int
    n_terms: int
    df: dict[bytes, int]

    def weight(self, term: bytes) -> int:
        return math.floor(1000 * math.log((2 * self.n_docs + 2) / (2 * self.df.get(term, 0) + 1)))

    def length_part(self, n: int) -> int:
        return 100 - 75 + (75 * n * self.n_docs) // self.n_terms


@dataclass
class Queries:
    """Items as weighted terms, and the sketch coordinates that they look up."""

    corpus: Corpus
    terms: list[list[tuple[bytes, int]]]  # of each item: (term, repeats times weight)
    sketch: int = SKETCH
    column: np.ndarray = field(init=False)  # of a coordinate in ``lookup``, -1 where no item looks
    lookup: np.ndarray = field(init=False)  # coordinates by items

    def __post_init__(self):
        at = [[(zlib.crc32(term) % self.sketch, w) for term, w in item] for item in self.terms]
        used = sorted({c for item in at for c, _ in item})
        self.column = np.full(self.sketch, -1, dtype=np.int64)
        self.column[used] = np.arange(len(used))
        self.lookup = np.zeros((len(used), len(self.terms)))
        for i, item in enumerate(at):
            for c, w in item:
                self.lookup[self.column[c], i] += w

    def bounds(self, docs: list[Counter], length_parts: np.ndarray) -> np.ndarray:
        """Upper bounds of all scores, documents by items.

        A document's impacts fold into the maxima of their coordinates. The impact grows with the
        count, so the counts are folded and turned into impacts once.
        """
        maxima = np.zeros((len(docs), self.lookup.shape[0]), dtype=np.int64)
        for row, counts in zip(maxima, docs):
            places = self.column[np.fromiter((zlib.crc32(t) % self.sketch for t in counts), np.int64, len(counts))]
            tf = np.fromiter(counts.values(), np.int64, len(counts))
            np.maximum.at(row, places[places >= 0], tf[places >= 0])
        folded = impact(maxima, length_parts[:, None]).astype(np.float64)
        # exact below 2 ** 53; the slack covers sums beyond it
        return np.ceil((folded @ self.lookup) * (1 + 1e-12))

    def score(self, item: int, counts: Counter, length_part: int) -> int:
        return sum(
            w * impact(counts[term], length_part) for term, w in self.terms[item] if term in counts
        )


def _counted(docs: DataFrame, text_col: str) -> DataFrame:
    """(term, df, terms): documents by term; a null term has all documents with terms, and all terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(df: Counter, n_docs: int, n_terms: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([None, *df], pa.binary()),
                    pa.array([n_docs, *df.values()], pa.int64()),
                    pa.array([n_terms] + [0] * len(df), pa.int64()),
                ],
                names=["term", "df", "terms"],
            )

        df: Counter = Counter()
        n_docs = n_terms = 0
        for batch in batches:
            for text in batch.column(0):
                counts = term_counts(text.as_py() or b"")
                df.update(counts.keys())
                n_docs += bool(counts)
                n_terms += counts.total()
                if len(df) >= MOST_COUNTS:
                    yield rows(df, n_docs, n_terms)
                    df, n_docs, n_terms = Counter(), 0, 0
        yield rows(df, n_docs, n_terms)

    counted = docs.select(F.col(text_col).cast("string").cast("binary").alias("text"))
    partial = counted.mapInArrow(count, "term binary, df bigint, terms bigint")
    return partial.groupBy("term").agg(F.sum("df").alias("df"), F.sum("terms").alias("terms"))


def _item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, item_id, terms, repeats) of each distinct item that has a term."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [term_counts(t.as_py() or b"") for t in batch.column("text")]
            keep = pa.array([i for i, c in enumerate(counts) if c], pa.int64())
            counts = [c for c in counts if c]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item").take(keep),
                    batch.column("item_id").take(keep),
                    pa.array([list(c) for c in counts], pa.list_(pa.binary())),
                    pa.array([list(c.values()) for c in counts], pa.list_(pa.int64())),
                ],
                names=["item", "item_id", "terms", "repeats"],
            )

    distinct = items.select(
        F.col(item_col).alias("item_id"), F.col(text_col).cast("string").cast("binary").alias("text")
    ).distinct()
    numbered = distinct.select(F.monotonically_increasing_id().alias("item"), "item_id", "text")
    kind = distinct.schema["item_id"].dataType.simpleString()
    schema = f"item bigint, item_id {kind}, terms array<binary>, repeats array<bigint>"
    return stored(numbered.mapInArrow(split, schema), "items")


def _best(docs: DataFrame, queries: Queries, numbers: list[int], id_col: str, text_col: str, k: int) -> DataFrame:
    """(item, doc_id, score): the best ``k`` of each task, from which the best of all are taken."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus = queries.corpus
        # of each item a heap of (score, reversed order of the id, id): least first
        best: list[list[tuple]] = [[] for _ in queries.terms]

        def look(docs: list[tuple]) -> None:
            counted = [counts for _, counts in docs]
            parts = np.array([corpus.length_part(c.total()) for c in counted], dtype=np.int64)
            bounds = queries.bounds(counted, parts)
            for item, heap in enumerate(best):
                bound = bounds[:, item]
                full = len(heap) >= k
                at = np.nonzero(bound >= (heap[0][0] if full else 1))[0]
                for i in at[np.argsort(-bound[at], kind="stable")]:
                    if len(heap) >= k and bound[i] < heap[0][0]:
                        break  # no document below can be among the best
                    doc_id = docs[i][0]
                    score = queries.score(item, counted[i], int(parts[i]))
                    entry = (score, doc_id is not None, -doc_id if doc_id is not None else 0)
                    if score > 0 and len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif score > 0 and entry > heap[0]:
                        heapq.heapreplace(heap, entry)

        for batch in batches:
            waiting = []
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                counts = term_counts(text.as_py() or b"")
                if counts:
                    waiting.append((doc_id.as_py(), counts))
                if len(waiting) == DOCUMENTS:
                    look(waiting)
                    waiting = []
            if waiting:
                look(waiting)
        found = [(number, -i if known else None, s) for number, heap in zip(numbers, best) for s, known, i in heap]
        columns = zip(*found) if found else ([], [], [])
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["item", "doc_id", "score"]
        )

    read = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return read.mapInArrow(search, "item bigint, doc_id bigint, score bigint")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    sketch: int = SKETCH,
) -> DataFrame:
    """The ``k`` documents with the highest scores above 0 for each item: item_id, rank, doc_id, score.

    Weights come from the statistics of all documents. Documents are taken in batches: each one's
    impacts fold into a sketch of maxima by hashed coordinate, the sketches of the batch are looked up for all
    items in one product of matrices, and that gives an upper bound of every score. By item the
    documents are scored exactly in descending order of their bounds, until the next bound is below
    the ``k``-th score so far. So the result is exact, a task keeps ``k`` documents an item, and no
    posting is shuffled: only counts of terms are, and the best of each task. Items are broadcast in
    blocks of about ``ITEMS_PER_BLOCK`` items and ``BLOCK_BYTES`` of terms; each block reads the documents twice.

    Of equal scores the smallest doc_id comes first, a null one last. Rows that repeat an id are
    documents of their own. Null and empty texts have no terms: such documents are found by nothing, and
    such items have no rows. An item repeated with the same text counts once; with another text it is
    ranked again. Without documents there are no rows. Other columns are not read.
    """
    spark = ready(docs.sparkSession)
    wanted = _item_terms(items, item_col, item_text_col)
    size = wanted.select(
        F.count("*").alias("n"), F.sum(F.expr("aggregate(terms, 0L, (n, t) -> n + octet_length(t) + 16)")).alias("bytes")
    ).first()
    n_blocks = max(1, -(-size["n"] // ITEMS_PER_BLOCK), -(-(size["bytes"] or 0) // BLOCK_BYTES))
    counted = stored(_counted(docs, text_col), "terms")
    total = counted.where("term is null").first()
    found = []
    for block in range(n_blocks):
        own = wanted.where(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == block)
        rows = own.select("item", "terms", "repeats").collect()
        terms = own.select(F.explode("terms").alias("term")).distinct()
        known = {bytes(r["term"]): r["df"] for r in counted.join(terms, "term", "left_semi").collect()}
        if not rows or not total["df"]:
            continue
        corpus = Corpus(total["df"], total["terms"], known)
        weighted = [
            [(bytes(t), n * corpus.weight(bytes(t))) for t, n in zip(r["terms"], r["repeats"])] for r in rows
        ]
        queries = Queries(corpus, weighted, sketch)
        found.append(stored(_best(docs, queries, [r["item"] for r in rows], id_col, text_col, k), "best"))
    best = found[0] if found else spark.createDataFrame([], "item bigint, doc_id bigint, score bigint")
    for more in found[1:]:
        best = best.union(more)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(wanted.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
