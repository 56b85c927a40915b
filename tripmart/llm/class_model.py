"""Scores of texts under a class-based bigram model, with classes found by exchange clustering.

A word is a unit of its own if it is among the most frequent of training, else it stands under
a unit for its ending. Units are clustered into classes; a word's probability is the transition
from the class before it times its emission from its own class.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import ready, small_batches, stored
from tripmart.llm.words import words

HEAD_WORDS = 1000  # words that are units of their own
ENDINGS = 128  # units of the other words
CLASSES = 64
SWEEPS = 8  # of the exchange, at most
KNOWN_WORDS = 100_000  # words whose counts are broadcast, at most; those of all others are joined
MOST_COUNTS = 200_000  # counts that a task holds before it passes them on
MOST_KEYS = 1_000_000  # pairs that a task holds before it counts them

END = 0  # unit and class of the end of a text, which is also what comes before its first word


@dataclass(frozen=True)
class Units:
    """The unit of each word: a number from 1, the end of a text is 0."""

    head: dict[bytes, int]
    endings: int = ENDINGS

    def __len__(self) -> int:
        return 1 + len(self.head) + self.endings

    def of(self, word: bytes) -> int:
        return self.head.get(word) or 1 + len(self.head) + zlib.crc32(word[-3:]) % self.endings


class Lookup:
    """Places of frequent words and their units, found for a list of words at once."""

    def __init__(self, units: Units, known: Iterable[bytes]):
        self.units = units
        self.place = {word: i for i, word in enumerate(known)}
        self.unit = np.fromiter(map(units.of, self.place), np.int64, len(self.place))

    def __call__(self, piece: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of each word, -1 for a rare one; unit of each word; where the rare ones are."""
        places = np.fromiter(map(self.place.get, piece, repeat(-1)), np.int64, len(piece))
        rare = np.nonzero(places < 0)[0]
        units = self.unit[places] if len(self.unit) else np.zeros(len(piece), dtype=np.int64)
        units[rare] = [self.units.of(piece[i]) for i in rare]
        return places, units, rare


@dataclass(frozen=True)
class ClassModel:
    """Everything that scoring needs. The counts of rare words stay in the table ``counts``."""

    units: Units
    classes: np.ndarray  # class of each unit; the end is alone in its class
    transition: np.ndarray  # log10 of class given the class before
    tokens: np.ndarray  # training tokens of each class
    distinct: np.ndarray  # distinct training words of each class
    n_tokens: int
    n_words: int
    end_count: int
    known: dict[bytes, int]
    counts: DataFrame  # (word, n)


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts."""

    def emitted(counts: Counter) -> pa.RecordBatch:
        columns = [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                for piece in words(text.as_py() or b""):
                    counts.update(piece)
                    if len(counts) >= MOST_COUNTS:
                        yield emitted(counts)
                        counts = Counter()
        yield emitted(counts)

    return texts.mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _texts(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select(F.col(text_col).cast("string").cast("binary").alias("text"))


def unit_pairs(docs: DataFrame, lookup: Lookup, text_col: str = "text") -> np.ndarray:
    """How often each unit follows each other one in the texts, ends included.

    The matrix has a fixed number of units on either side, so it is bounded for any corpus.
    """
    size = len(lookup.units)
    shared = docs.sparkSession.sparkContext.broadcast(lookup)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size * size, dtype=np.int64)
        waiting: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for text in batch.column(0):
                before = END
                for piece in [*words(text.as_py() or b""), None]:
                    units = shared.value(piece)[1] if piece is not None else np.array([END])
                    path = np.concatenate(([before], units))
                    before = int(path[-1])
                    waiting.append(path[:-1] * size + path[1:])
                    held += len(units)
                if held >= MOST_KEYS:
                    counts += np.bincount(np.concatenate(waiting), minlength=size * size)
                    waiting, held = [], 0
        if waiting:
            counts += np.bincount(np.concatenate(waiting), minlength=size * size)
        found = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], names=["pair", "n"])

    partial = _texts(docs, text_col).mapInArrow(count, "pair bigint, n bigint")
    rows = partial.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(size * size)
    counts[rows.column("pair").to_numpy()] = rows.column("n").to_numpy()
    return counts.reshape(size, size)


def most_frequent(counts: DataFrame, most: int) -> dict[bytes, int]:
    """The most frequent words with their counts, in this order, no more than ``most``.

    Words of one count are taken all or none, so only the number of words by count is gathered
    before, and then just the words themselves.
    """
    sizes = counts.groupBy("n").agg(F.count("*").alias("words")).toArrow()
    by_count = sorted(zip(sizes.column("n").to_pylist(), sizes.column("words").to_pylist()), reverse=True)
    taken, least = 0, None
    for n, words_of_count in by_count:
        taken += words_of_count
        if taken > most:
            break
        least = n
    if least is None:
        return {}
    rows = counts.where(F.col("n") >= least).toArrow()
    pairs = zip(rows.column("word").to_pylist(), rows.column("n").to_pylist())
    return dict(sorted(pairs, key=lambda pair: (-pair[1], pair[0])))


def head_of(counts: DataFrame, most: int) -> list[bytes]:
    """The ``most`` most frequent words, of equal counts those that come first in the alphabet."""
    return [bytes(row["word"]) for row in counts.orderBy(F.desc("n"), "word").limit(most).collect()]


def _phi(x: np.ndarray) -> np.ndarray:
    """x log x, 0 at 0."""
    return x * np.log(np.maximum(x, 1.0))


def likelihood(pairs: np.ndarray, classes: np.ndarray, n_classes: int) -> float:
    """What the exchange maximises: the part of the log likelihood that depends on the classes."""
    member = np.eye(n_classes)[classes]
    table = member.T @ pairs @ member
    return float(_phi(table).sum() - _phi(table.sum(0)).sum() - _phi(table.sum(1)).sum())


def exchange(pairs: np.ndarray, n_classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Classes of units by exchange: each unit moves to the class that gains most, until none does.

    Unit 0 keeps class 0 for itself. Units start in the other classes in turn, by frequency.
    A move changes one row and one column of the table of class pairs, so all classes are tried in
    one evaluation of the table.
    """
    size = len(pairs)
    often = np.argsort(-pairs.sum(1)[1:], kind="stable") + 1
    classes = np.zeros(size, dtype=np.int64)
    if n_classes < 2:
        return classes
    classes[often] = 1 + np.arange(size - 1) % (n_classes - 1)
    member = np.eye(n_classes)[classes]
    table = member.T @ pairs @ member
    moving = [u for u in often if pairs[u].any() or pairs[:, u].any()]
    for _ in range(sweeps):
        moved = False
        after, before = pairs @ member, pairs.T @ member  # of each unit, by class of its neighbours
        for unit in moving:
            own, itself = classes[unit], pairs[unit, unit]
            row, column = after[unit].copy(), before[unit].copy()
            row[own] -= itself
            column[own] -= itself
            # the table without the unit
            table[own] -= row
            table[:, own] -= column
            table[own, own] -= itself
            with_row, with_column = table + row, table + column[:, None]
            gain = (_phi(with_row) - _phi(table)).sum(1) + (_phi(with_column) - _phi(table)).sum(0)
            diagonal = np.arange(n_classes)
            alone, both = table[diagonal, diagonal], row + column + itself
            gain += _phi(alone + both) - _phi(alone + row) - _phi(alone + column) + _phi(alone)
            out, into = table.sum(1), table.sum(0)
            gain -= _phi(out + row.sum() + itself) - _phi(out) + _phi(into + column.sum() + itself) - _phi(into)
            gain[0] = -np.inf
            best = int(np.argmax(gain))
            best = best if gain[best] > gain[own] + 1e-6 else own
            table[best] += row
            table[:, best] += column
            table[best, best] += itself
            if best != own:
                moved = True
                classes[unit] = best
                member[unit] = np.eye(n_classes)[best]
                for sums, others in ((after, pairs[:, unit]), (before, pairs[unit])):
                    sums[:, own] -= others
                    sums[:, best] += others
        if not moved:
            break
    return classes


def transitions(pairs: np.ndarray, classes: np.ndarray, n_classes: int = CLASSES) -> np.ndarray:
    """log10 probabilities of a class after each class.

    Counts are mixed with the share of the class among all tokens, which weighs as much as there are
    classes; the share itself has one added to each count. So no probability is 0.
    """
    member = np.eye(n_classes)[classes]
    table = member.T @ pairs @ member
    share = (table.sum(0) + 1) / (table.sum() + n_classes)
    return np.log10((table + n_classes * share) / (table.sum(1, keepdims=True) + n_classes))


def _class_sizes(counts: DataFrame, units: Units, classes: np.ndarray, n_classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Training tokens and distinct training words of each class, over all words."""

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, distinct = np.zeros(n_classes, dtype=np.int64), np.zeros(n_classes, dtype=np.int64)
        for batch in batches:
            own = classes[np.fromiter(map(units.of, batch.column("word").to_pylist()), np.int64, batch.num_rows)]
            np.add.at(tokens, own, batch.column("n").to_numpy())
            np.add.at(distinct, own, 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(n_classes), pa.int64()), pa.array(tokens), pa.array(distinct)], names=["class", "tokens", "words"]
        )

    tokens, distinct = np.zeros(n_classes, dtype=np.int64), np.zeros(n_classes, dtype=np.int64)
    found = counts.mapInArrow(sizes, "class bigint, tokens bigint, words bigint")
    for row in found.groupBy("class").agg(F.sum("tokens"), F.sum("words")).collect():
        tokens[row[0]], distinct[row[0]] = row[1], row[2]
    return tokens, distinct


def train(
    docs: DataFrame,
    text_col: str = "text",
    head_words: int = HEAD_WORDS,
    endings: int = ENDINGS,
    n_classes: int = CLASSES,
    known_words: int = KNOWN_WORDS,
) -> ClassModel:
    """A model of all given texts: counts of all their words and of all neighbours.

    ``head_words``, ``endings`` and ``n_classes`` set the size of the model. What reaches the driver
    is bounded by them and by ``known_words``: the head words, the counts of so many most frequent
    words, and the table of neighbouring units, on which the exchange runs. No word is left out: those that are
    no head words are clustered by their ending, and every word has its exact count in a table. Null texts are empty; each text has one end.
    """
    ready(docs.sparkSession)
    texts = _texts(docs, text_col)
    with small_batches(docs.sparkSession):
        counts = stored(word_counts(texts), "words")
    whole = counts.agg(F.count("*").alias("words"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    known = most_frequent(counts, known_words)
    units = Units({word: 1 + i for i, word in enumerate(head_of(counts, head_words))}, endings)
    with small_batches(docs.sparkSession):
        pairs = unit_pairs(docs, Lookup(units, known), text_col)
    end_count = int(pairs[:, END].sum())
    classes = exchange(pairs, n_classes)
    tokens, distinct = _class_sizes(counts, units, classes, n_classes)
    tokens[classes[END]] += end_count
    distinct[classes[END]] += end_count > 0
    return ClassModel(
        units, classes, transitions(pairs, classes, n_classes), tokens, distinct,
        whole["n"] + end_count, whole["words"] + (end_count > 0), end_count, known, counts,
    )


class _Scorer:
    """The part of a text's score that is known without the counts of rare words."""

    def __init__(self, model: ClassModel):
        self.lookup, self.classes, self.transition = Lookup(model.units, model.known), model.classes, model.transition
        self.class_total = model.tokens + model.distinct + 1
        counts = np.fromiter(model.known.values(), np.int64, len(model.known)) + 1
        # one added to the count of each word
        self.base = np.log10(counts / (model.n_tokens + model.n_words + 1))
        self.emission = np.log10(counts / self.class_total[self.classes[self.lookup.unit]])
        self.end_known = int(model.end_count > 0)
        self.end_base = math.log10((model.end_count + 1) / (model.n_tokens + model.n_words + 1))
        self.end_emission = math.log10((model.end_count + 1) / int(self.class_total[self.classes[END]]))

    def __call__(self, data: bytes) -> tuple[int, int, float, float, Counter]:
        """Tokens, known tokens, base score, score, and the words whose counts are not here."""
        n, known, before = 1, self.end_known, END
        base, score = self.end_base, self.end_emission
        rest: Counter = Counter()
        for piece in words(data):
            if not piece:
                continue
            places, units, rare = self.lookup(piece)
            path = self.classes[np.concatenate(([before], units))]
            before = int(units[-1])
            score += float(self.transition[path[:-1], path[1:]].sum())
            held = places[places >= 0]
            base += float(self.base[held].sum())
            score += float(self.emission[held].sum())
            rest.update([piece[i] for i in rare])
            n += len(piece)
            known += len(held)
        score += float(self.transition[self.classes[before], self.classes[END]])
        return n, known, base, score, rest


def _scanned(docs: DataFrame, scorer: Broadcast, id_col: str, text_col: str) -> DataFrame:
    """A row for each document with what its known words give, and a row for each other word of it."""
    kind = docs.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list, ids: pa.Array) -> pa.RecordBatch:
            row, at, word, times, total, n, known, base, score = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(row, pa.int64()), ids.take(pa.array(at, pa.int64())), pa.array(word, pa.binary()),
                    pa.array(times, pa.int64()), pa.array(total, pa.int64()), pa.array(n, pa.int64()),
                    pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64()),
                ],
                names=["row", "id", "word", "times", "class_total", "n_tokens", "n_known", "base", "score"],
            )

        model = scorer.value
        for batch in batches:
            rows, ids = [], batch.column("id")
            for at, (row, text) in enumerate(zip(batch.column("row").to_pylist(), batch.column("text"))):
                n, known, base, score, rest = model(text.as_py() or b"")
                rows.append((row, at, None, 0, 0, n, known, base, score))
                for word, times in rest.items():
                    total = int(model.class_total[model.classes[model.lookup.units.of(word)]])
                    rows.append((row, None, word, times, total, 0, 0, 0.0, 0.0))
                    if len(rows) >= MOST_COUNTS:
                        yield batch_of(rows, ids)
                        rows = []
            if rows:
                yield batch_of(rows, ids)

    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.col(text_col).cast("string").cast("binary").alias("text"),
    ).mapInArrow(
        scan,
        f"row bigint, id {kind}, word binary, times bigint, class_total bigint, n_tokens bigint, "
        "n_known bigint, base double, score double",
    )


def score(docs: DataFrame, model: ClassModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity of every document.

    ``base_score`` is the log10 probability under single words with one added to each count,
    ``score`` that under the class model, whose emission has one added to the count of each word
    of a class and one place for unknown words. Transitions and frequent words are scored while a text is
    read; only rarer words, once a document, are joined with their counts, and their parts are summed
    by document with what was known.

    A null or empty text is its end alone. Each row is scored by itself, also when ids repeat or
    are null. Words are split at ASCII blanks and A-Z lower-cased; other columns are not read. With no training
    text all counts are 0 and ``base_score`` is 0.
    """
    spark = ready(docs.sparkSession)
    scorer = spark.sparkContext.broadcast(_Scorer(model))
    with small_batches(spark):
        scanned = stored(_scanned(docs, scorer, id_col, text_col), "scanned")
    rare = scanned.where("word is not null").join(model.counts, "word", "left")
    count = F.coalesce(F.col("n"), F.lit(0))
    base_total = F.lit(float(model.n_tokens + model.n_words + 1))
    joined = rare.select(
        "row",
        F.lit(0).cast("bigint").alias("n_tokens"),
        F.when(count > 0, F.col("times")).otherwise(0).alias("n_known"),
        (F.col("times") * F.log10((count + 1) / base_total)).alias("base"),
        (F.col("times") * F.log10((count + 1) / F.col("class_total"))).alias("score"),
    )
    sums = [F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "score")]
    own = scanned.where("word is null")
    parts = own.select("row", *joined.columns[1:]).union(joined).groupBy("row").agg(*sums)
    return own.select("row", "id").join(parts, "row").select(
        F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(model.n_tokens).cast("bigint").alias("train_tokens"),
        F.col("base").alias("base_score"), "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
