"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import id_as_text, id_from_text, is_held_out, slices, stored

MAX_TRAINING_DOCUMENTS = 12_000
MIN_DOCUMENTS = 5
MAX_FEATURES = 3_000
STEMS = (4, 5)
L2 = 2e-5
SENTENCE_END = re.compile(r"[.!?\n]+")
WORD = re.compile(r"[^\W_]+")


def sentences(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of each stretch between sentence ends that holds more than blanks."""
    found, start = [], 0
    text = text or ""
    for end in SENTENCE_END.finditer(text):
        if text[start : end.start()].strip():
            found.append((start, end.start()))
        start = end.end()
    if text[start:].strip():
        found.append((start, len(text)))
    return found


def features(sentence: str) -> list[str]:
    """Lower-case words, and the stems of each word that is longer than them."""
    words = WORD.findall(sentence.lower())
    return words + [w[:n] + "*" for n in STEMS for w in words if len(w) > n]


@dataclass(frozen=True)
class SentenceModel:
    """A linear score per sentence; a document is toxic unless every sentence is clean."""

    weights: Mapping[str, float]
    bias: float

    def sentence_probabilities(self, parts: Iterable[str]) -> np.ndarray:
        get, zero = self.weights.get, repeat(0.0)
        scores = [self.bias + sum(map(get, features(part), zero)) for part in parts]
        return 1.0 / (1.0 + np.exp(-np.clip(np.array(scores, dtype=np.float64), -40, 40)))

    def document(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """Noisy-or of the sentences, and (start, end, probability) of each."""
        where = sentences(text)
        p = self.sentence_probabilities(text[a:b] for a, b in where) if where else np.zeros(0)
        score = float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum()))
        return score, [(a, b, float(x)) for (a, b), x in zip(where, p)]


def contrast(n_clean: int, n_toxic: int, clean: Column, toxic: Column) -> Column:
    """How differently a feature is spread over clean and toxic documents, against its spread."""
    return F.abs(toxic / n_toxic - clean / n_clean) / F.sqrt(clean + toxic)


def fit(
    names: list[str],
    docs: np.ndarray,
    rows: np.ndarray,
    columns: np.ndarray,
    y: np.ndarray,
    epochs: int = 60,
) -> SentenceModel:
    """Weights that maximise the likelihood of document labels ``y`` under noisy-or.

    ``docs`` has the document of each sentence; ``rows`` and ``columns`` say which sentence holds
    which feature. Without both labels present the model has only a bias.
    """
    y = np.asarray(y, dtype=np.float64)
    if not len(y) or y.min() == y.max():
        return SentenceModel({}, 40.0 if len(y) and y.max() else -40.0)
    w = np.zeros(len(names) + 1)
    w[-1] = -6.0
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, epochs + 1):
        z = np.bincount(rows, w[columns], minlength=len(docs)) + w[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        clean = np.exp(np.bincount(docs, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(y)))
        toxic = np.maximum(1 - clean, 1e-9)
        # d(log likelihood)/dz of a sentence is p times clean/toxic in toxic documents, else -p
        g = p * np.where(y[docs] == 1, clean[docs] / toxic[docs], -1.0)
        gradient = np.append(np.bincount(columns, g[rows], minlength=len(names)), g.sum()) / len(y)
        gradient[:-1] -= L2 * w[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        w += 0.3 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    kept = {f: float(x) for f, x in zip(names, w) if abs(x) > 1e-3}
    return SentenceModel(kept, float(w[-1]))


def train(
    docs: DataFrame,
    labels: DataFrame,
    max_documents: int = MAX_TRAINING_DOCUMENTS,
    min_documents: int = MIN_DOCUMENTS,
    max_features: int = MAX_FEATURES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> SentenceModel:
    """A model from labelled documents that are not held out, at most about ``max_documents`` of them.

    The sample takes ids in the order of their hash, so it is the same in every run. Features are
    those in at least ``min_documents`` of its documents, the ``max_features`` that differ most
    between labels, and of these the ones whose weight is above a thousandth; they are counted on the executors, and the driver gets only their numbers for
    each sentence. Rows without a label are not used. Of repeated labels the largest counts.
    """
    known = (
        labels.select(F.col("doc_id").alias("__id"), F.col("toxic").cast("int").alias("__label"))
        .where("__label is not null and __id is not null")
        .groupBy("__id")
        .agg(F.max("__label").alias("__label"))
        .where(~is_held_out("__id", 5, 0))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(max_documents)
    )
    sample = stored(
        docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
        .where("__text is not null")
        .join(F.broadcast(known), "__id")  # at most max_documents ids and labels
        .select(
            F.col("__id").cast("string").alias("id"), F.col("__label").alias("label"), F.col("__text").alias("text")
        ),
        "toxicity",
    )
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return fit([], np.zeros(0, int), np.zeros(0, int), np.zeros(0, int), np.array(list(sizes)))

    def spread(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames, 1_000):
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for text, label in zip(frame["text"], frame["label"]):
                seen[label > 0].update(set(features(text)))
            names = sorted(seen[0].keys() | seen[1].keys())
            yield pd.DataFrame(
                {"f": names, "clean": [seen[0][f] for f in names], "toxic": [seen[1][f] for f in names]}
            )

    counted = sample.mapInPandas(spread, "f string, clean long, toxic long").groupBy("f").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    )
    n_clean = sizes.get(0, 0)
    rank = contrast(n_clean, sum(sizes.values()) - n_clean, F.col("clean"), F.col("toxic"))
    names = [
        r["f"]
        for r in counted.where(F.col("clean") + F.col("toxic") >= min_documents)
        .orderBy(rank.desc(), "f")
        .limit(max_features)
        .collect()
    ]
    number = {f: i for i, f in enumerate(names)}

    def hits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames, 1_000):
            found = [
                [
                    [number[f] for f in sorted(set(features(text[a:b]))) if f in number]
                    for a, b in sentences(text)
                ]
                for text in frame["text"]
            ]
            yield pd.DataFrame(
                {
                    "id": frame["id"],
                    "label": frame["label"],
                    "sizes": [np.array([len(s) for s in bag], dtype=np.int32) for bag in found],
                    "hits": [np.array([i for s in bag for i in s], dtype=np.int32) for bag in found],
                }
            )

    bags = sample.mapInPandas(
        hits, "id string, label int, sizes array<int>, hits array<int>"
    ).toPandas()
    bags = bags.iloc[sorted(range(len(bags)), key=lambda i: (bags["id"][i], len(bags["hits"][i])))]
    per_document = [len(s) for s in bags["sizes"]]
    per_sentence = np.concatenate([*bags["sizes"], np.zeros(0, np.int32)]).astype(np.int64)
    return fit(
        names,
        np.repeat(np.arange(len(bags)), per_document),
        np.repeat(np.arange(len(per_sentence)), per_sentence),
        np.concatenate([*bags["hits"], np.zeros(0, np.int32)]).astype(np.int64),
        bags["label"].to_numpy() > 0,
    )


def score_column(spark: SparkSession, model: SentenceModel):
    """A column function from a text to its score, to filter documents in place."""
    shared = spark.sparkContext.broadcast((dict(model.weights), model.bias))

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        here = SentenceModel(*shared.value)
        return pd.Series([here.document(text)[0] for text in texts], dtype="float64")

    return scored


def score(
    docs: DataFrame,
    model: SentenceModel,
    id_col: str = "doc_id",
    text_col: str = "text",
    offending: float = 0.5,
) -> DataFrame:
    """``(doc_id, score, predicted, offending)``: every whole text scored.

    ``offending`` lists (start, end, probability) of the sentences at or above that probability, in
    code points. Null and empty texts have no sentence and score 0. Repeated rows each get
    a row. Only the two named columns are read.
    """
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((dict(model.weights), model.bias))

    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here = SentenceModel(*shared.value)
        for frame in slices(frames, 2_000):
            results = [here.document(text) for text in frame["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "score": [s for s, _ in results],
                    "predicted": np.array([s >= 0.5 for s, _ in results], dtype=np.int32),
                    "offending": [
                        [(a, b, p) for a, b, p in where if p >= offending] for _, where in results
                    ],
                }
            )

    schema = (
        "doc_id string, score double, predicted int, "
        "offending array<struct<start:long,end:long,probability:double>>"
    )
    texts = docs.select(id_as_text(id_col, id_type).alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInPandas(scored, schema).withColumn("doc_id", id_from_text("doc_id", id_type))
