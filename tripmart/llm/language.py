"""Language of every byte by a bidirectional gated recurrent network, pooled over documents."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import id_as_text, id_from_text, is_held_out, slices

WINDOW = 64  # bytes that the network sees together
HIDDEN = 8
TRAINING_DOCUMENTS = 1_500  # about as many of each language
WINDOWS_PER_DOCUMENT = 3
BATCH = 2_048
LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"


def _step(x: np.ndarray, h: np.ndarray, u: np.ndarray, size: int):
    """One step for a batch: gates, candidate and new state. Columns are windows."""
    a = u @ h
    gates = np.tanh((x[: 2 * size] + a[: 2 * size]) * np.float32(0.5))
    gates *= np.float32(0.5)
    gates += np.float32(0.5)
    z, r = gates[:size], gates[size:]
    candidate = np.tanh(x[2 * size :] + r * a[2 * size :])
    return z, r, a[2 * size :], candidate, candidate + z * (h - candidate)


@dataclass
class ByteNetwork:
    """Per direction: input weights of each byte (with bias) and recurrent weights; output weights."""

    languages: tuple[str, ...]
    inputs: list[np.ndarray]  # two of (3 hidden, 256)
    recurrent: list[np.ndarray]  # two of (3 hidden, hidden)
    output: np.ndarray  # (languages, 2 hidden)
    bias: np.ndarray  # (languages, 1)

    @classmethod
    def start(cls, languages, hidden: int = HIDDEN, seed: int = 7) -> ByteNetwork:
        rng = np.random.default_rng(seed)

        def draw(*shape, scale):
            return (rng.normal(size=shape) * scale).astype(np.float32)

        return cls(
            tuple(languages),
            [draw(3 * hidden, 256, scale=0.3) for _ in range(2)],
            [draw(3 * hidden, hidden, scale=0.3) for _ in range(2)],
            draw(len(languages), 2 * hidden, scale=0.3),
            np.zeros((len(languages), 1), np.float32),
        )

    def _states(self, windows: np.ndarray, direction: int, keep: bool):
        """States after each position, (position, hidden, window), and what training needs."""
        length, size = windows.shape[1], self.recurrent[direction].shape[1]
        h = np.zeros((size, len(windows)), np.float32)
        states = np.empty((length, size, len(windows)), np.float32)
        trace = []
        columns = np.ascontiguousarray(windows.T)
        for t in range(length) if direction == 0 else range(length - 1, -1, -1):
            x = np.take(self.inputs[direction], columns[t], axis=1)
            z, r, a, n, new = _step(x, h, self.recurrent[direction], size)
            if keep:
                trace.append((t, h, z, r, a, n))
            states[t] = h = new
        return states, trace

    def positions(self, windows: np.ndarray) -> np.ndarray:
        """Language probabilities (language, position, window) of windows (window, position)."""
        size = self.recurrent[0].shape[1]
        logits = None
        for direction in range(2):
            states, _ = self._states(windows, direction, keep=False)
            part = np.matmul(self.output[:, direction * size : (direction + 1) * size], states)
            logits = part if logits is None else logits + part
        logits = logits.transpose(1, 0, 2) + self.bias[:, :, None]
        logits -= logits.max(0)
        p = np.exp(logits)
        p /= p.sum(0)
        return p

    def gradients(self, windows: np.ndarray, labels: np.ndarray):
        """Mean cross-entropy of all positions that hold text, and its gradients through time."""
        size, k = self.recurrent[0].shape[1], len(self.languages)
        states, traces = zip(*(self._states(windows, d, keep=True) for d in range(2)))
        both = np.concatenate(states, axis=1)
        logits = np.matmul(self.output, both) + self.bias
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        mask = (windows.T != 0).astype(np.float32)[:, None, :]
        total = max(1.0, float(mask.sum()))
        truth = np.eye(k, dtype=np.float32)[labels].T[None]
        loss = float(-(np.log(np.maximum(p, 1e-9)) * truth * mask).sum() / total)
        d_logits = (p - truth) * mask / np.float32(total)
        d_output = np.einsum("tkb,thb->kh", d_logits, both, optimize=True)
        d_bias = d_logits.sum((0, 2))[:, None]
        d_states = np.matmul(self.output.T, d_logits)
        d_inputs = [np.zeros_like(w) for w in self.inputs]
        d_recurrent = [np.zeros_like(u) for u in self.recurrent]
        for direction in range(2):
            u = self.recurrent[direction]
            carried = np.zeros((size, len(windows)), np.float32)
            by_byte = np.zeros((256, 3 * size), np.float32)
            for t, h, z, r, a, n in reversed(traces[direction]):
                d = carried + d_states[t, direction * size : (direction + 1) * size]
                d_n = d * (1 - z) * (1 - n * n)
                d_z = d * (h - n) * z * (1 - z)
                d_r = d_n * a * r * (1 - r)
                d_a = np.concatenate([d_z, d_r, d_n * r])
                np.add.at(by_byte, windows[:, t], np.concatenate([d_z, d_r, d_n]).T)
                d_recurrent[direction] += d_a @ h.T
                carried = d * z + u.T @ d_a
            d_inputs[direction] = by_byte.T
        return loss, [*d_inputs, *d_recurrent, d_output, d_bias]

    def parameters(self) -> list[np.ndarray]:
        return [*self.inputs, *self.recurrent, self.output, self.bias]


def fit(windows: np.ndarray, labels: np.ndarray, languages, epochs: int = 6, batch: int = 192) -> ByteNetwork:
    """A network trained by backpropagation through time with adaptive steps."""
    network = ByteNetwork.start(languages)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in network.parameters()]
    rng, step = np.random.default_rng(11), 0
    steps = max(1, epochs * -(-len(windows) // batch))
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            take = order[at : at + batch]
            _, gradients = network.gradients(windows[take], labels[take])
            step += 1
            rate = 0.03 * (1 - step / (steps + 1)) + 0.0005
            for p, g, (m, v) in zip(network.parameters(), gradients, moments):
                m += np.float32(0.1) * (g - m)
                v += np.float32(0.01) * (g * g - v)
                p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)).astype(
                    np.float32
                )
    return network


def windows_of(texts: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of all texts in rows of ``window``, zeros at the end of a text; rows per text."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    rows = -(-sizes // window)
    out = np.zeros(int(rows.sum()) * window, dtype=np.uint8)
    flat = np.frombuffer(b"".join(texts), dtype=np.uint8)
    starts = (np.cumsum(rows) - rows) * window
    shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    out[np.arange(len(flat)) + shift] = flat
    return out.reshape(-1, window), rows


def train(
    docs: DataFrame,
    documents_per_language: int = TRAINING_DOCUMENTS,
    windows_per_document: int = WINDOWS_PER_DOCUMENT,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> ByteNetwork | None:
    """A network from text and language of rows that are not held out.

    Of each language about ``documents_per_language`` documents are taken, by the hash of their
    id, and from each ``windows_per_document`` windows spread over the whole text; those two bound
    what the driver holds. ``None`` without any such row.
    """
    known = docs.select(
        F.col(id_col).alias("__id"), F.col(text_col).alias("__text"), F.col(lang_col).alias("__lang")
    ).where((F.col("__lang").isNotNull()) & (F.col("__text") != "") & ~is_held_out("__id", 3, 1))
    counts = {r["__lang"]: r["n"] for r in known.groupBy("__lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    share = F.lit(0.0)
    for language, n in sorted(counts.items()):
        share = F.when(F.col("__lang") == language, documents_per_language / n).otherwise(share)
    chance = F.pmod(F.xxhash64("__id", F.lit(17)), F.lit(1_000_003)) / 1_000_003

    def spread(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames, 2_000):
            bits, langs, order = [], [], []
            for i, text, lang in zip(frame["__id"], frame["__text"], frame["__lang"]):
                data = text.encode()
                for k in range(windows_per_document):
                    at = max(0, len(data) - WINDOW) * k // max(1, windows_per_document - 1)
                    bits.append(data[at : at + WINDOW])
                    langs.append(lang)
                    order.append(f"{i}:{k}")
            yield pd.DataFrame({"bits": bits, "lang": langs, "at": order})

    sample = (
        known.where(chance < share).mapInPandas(spread, "bits binary, lang string, at string").toPandas()
    )
    sample = sample.sort_values(["at", "lang"], kind="stable")
    if sample.empty:
        return None
    languages = sorted(sample["lang"].unique())
    windows, _ = windows_of([bytes(b) for b in sample["bits"]])
    labels = sample["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy()
    return fit(windows, labels, languages)


def label(
    docs: DataFrame,
    network: ByteNetwork | None,
    id_col: str = "doc_id",
    text_col: str = "text",
    runs: bool = False,
) -> DataFrame:
    """``(doc_id, lang_pred, score)``, with ``runs`` also the stretches of bytes of one language.

    Every byte of every text is labelled with the probabilities of the languages, in the context
    of its window; a document's probabilities are their mean, its language the most probable, its
    score that probability. ``runs`` has (start, end, lang) in bytes, end exclusive.

    A null or empty text, or one without a letter, is ``und`` with score 0; so is every text when
    there was nothing to learn from. Repeated rows each get a row. An empty table gives no rows.
    Only the two named columns are read.
    """
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def of(texts: list[str | None]):
        here = shared.value
        able = [i for i, t in enumerate(texts) if here is not None and t and LETTER.search(t)]
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        stretches: list[list] = [[] for _ in texts]
        if able:
            windows, rows = windows_of([texts[i].encode() for i in able])
            k = len(here.languages)
            sums = np.empty((k, len(windows)), np.float64)
            tops = []
            for at in range(0, len(windows), BATCH):
                part = windows[at : at + BATCH]
                p = here.positions(part)
                mask = (part.T != 0)[None]
                sums[:, at : at + BATCH] = np.where(mask, p, 0).sum(1)
                if runs:
                    tops.append(p.argmax(0).T)
            starts = np.cumsum(rows) - rows
            pooled = np.add.reduceat(sums, starts, axis=1)
            pooled /= np.maximum(pooled.sum(0), 1e-9)
            best = pooled.argmax(0)
            for i, row in enumerate(able):
                langs[row], scores[row] = here.languages[best[i]], min(1.0, float(pooled[best[i], i]))
            if runs:
                top = np.concatenate(tops)
                for i, row in enumerate(able):
                    flat = top[starts[i] : starts[i] + rows[i]].ravel()[: len(texts[row].encode())]
                    cuts = [0, *(np.nonzero(np.diff(flat))[0] + 1).tolist(), len(flat)]
                    stretches[row] = [
                        (a, b, here.languages[flat[a]]) for a, b in zip(cuts, cuts[1:])
                    ]
        return langs, scores, stretches

    def labelled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames, 500):
            langs, scores, stretches = of(list(frame["text"]))
            out = pd.DataFrame({"doc_id": frame["doc_id"], "lang_pred": langs, "score": scores})
            yield out.assign(runs=stretches) if runs else out

    schema = "doc_id string, lang_pred string, score double"
    if runs:
        schema += ", runs array<struct<start:long,end:long,lang:string>>"
    rows = docs.select(id_as_text(id_col, id_type).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(labelled, schema).withColumn("doc_id", id_from_text("doc_id", id_type))
