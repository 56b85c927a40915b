"""Tokens of whole documents, attributed to the sections that they come from."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.tokens import RANKS, VOCABULARY, encoder, vocabulary_path


def token_spans(text: str, ids: np.ndarray, byte_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last-plus-one code point that each token touches.

    The tokens' bytes follow each other without gaps, so their lengths give their places. Tokens
    that share a character of several bytes both touch it.
    """
    ends = np.cumsum(byte_lengths[ids])
    starts = ends - byte_lengths[ids]
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    if len(data) == len(text):
        return starts, ends
    character = np.cumsum((data & 0xC0) != 0x80) - 1
    return character[starts], character[ends - 1] + 1


def line_bounds(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Lines with their line ends, as code points."""
    cuts = [0]
    at = text.find("\n")
    while at >= 0:
        cuts.append(at + 1)
        at = text.find("\n", at + 1)
    if cuts[-1] != len(text):
        cuts.append(len(text))
    return np.array(cuts[:-1], dtype=np.int64), np.array(cuts[1:], dtype=np.int64)


def attribute(starts, ends, first, last) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, crossing tokens and fractional tokens of each section.

    ``first`` and ``last`` bound the sections, in order and without overlap. A token inside
    one section belongs to it. One that crosses a border belongs to the section that has most
    of its characters, the earlier of equals, and counts as crossing there; its fractional count
    goes to each section by the share of its characters. What lies in no section counts nowhere.
    """
    n = len(first)
    tokens = np.zeros(n, dtype=np.int64)
    crossing = np.zeros(n, dtype=np.int64)
    share = np.zeros(n, dtype=np.float64)
    if not n or not len(starts):
        return tokens, crossing, share
    low = np.searchsorted(last, starts, side="right")  # the first section that ends after the start
    inside = (low < n) & (first[np.minimum(low, n - 1)] <= starts) & (ends <= last[np.minimum(low, n - 1)])
    whole = np.bincount(low[inside], minlength=n)
    tokens += whole
    share += whole
    for t in np.nonzero(~inside)[0]:
        best, most = -1, 0
        section = int(low[t])
        while section < n and first[section] < ends[t]:
            overlap = int(min(ends[t], last[section]) - max(starts[t], first[section]))
            if overlap > 0:
                share[section] += overlap / int(ends[t] - starts[t])
                if overlap > most:
                    best, most = section, overlap
            section += 1
        if best >= 0:
            tokens[best] += 1
            crossing[best] += 1
    return tokens, crossing, share


def section_tokens(
    docs: DataFrame,
    sections_col: str | None = None,
    vocabulary: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, section, start, end, n_tokens, n_crossing, token_share)``, a row per section.

    Each document is encoded once, as a whole, so a word at a border gets the tokens that it has
    in its context; tokens are then joined to sections by their character intervals, see
    :func:`attribute`. ``sections_col`` is an array of (start, end) in code points, in order and
    without overlap; without it the sections are the lines. The counts of a document's lines add up
    to its tokens.

    A null or empty text, or one without sections, is one section 0 from 0 to 0 with no tokens.
    Repeated rows give repeated sections. An empty table gives no rows. Only the named columns
    are read.
    """
    import pyarrow as pa

    vocabulary, ranks = vocabulary or vocabulary_path(VOCABULARY), vocabulary_path(RANKS)
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    columns = [F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")]
    if sections_col:
        columns.append(F.col(sections_col).alias("sections"))

    def bounds(text: str, sections) -> tuple[np.ndarray, np.ndarray]:
        if not sections_col:
            return line_bounds(text)
        spans = [tuple(s.values()) for s in sections or []]
        return tuple(np.array([s[k] for s in spans], dtype=np.int64) for k in range(2))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, ranks)
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                texts = part.column(1).to_pylist()
                given = part.column(2).to_pylist() if sections_col else [None] * len(texts)
                rows, columns = [], [[] for _ in range(6)]
                for row, (text, sections) in enumerate(zip(texts, given)):
                    text = text or ""
                    first, last = bounds(text, sections)
                    if not len(first):
                        first, last = np.zeros(1, np.int64), np.zeros(1, np.int64)
                    spans = token_spans(text, encode(text), encode.byte_lengths)
                    rows.append(np.full(len(first), row))
                    values = (np.arange(len(first)), first, last, *attribute(*spans, first, last))
                    for column, value in zip(columns, values):
                        column.append(value)
                made = [np.concatenate(c) for c in columns]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(np.concatenate(rows)))]
                    + [pa.array(m.astype(np.int32)) for m in made[:1]]
                    + [pa.array(m.astype(np.int64)) for m in made[1:5]]
                    + [pa.array(made[5])],
                    names=["doc_id", "section", "start", "end", "n_tokens", "n_crossing", "token_share"],
                )

    schema = (
        f"doc_id {id_type}, section int, start long, end long, n_tokens long, n_crossing long, "
        "token_share double"
    )
    return docs.select(*columns).mapInArrow(count, schema)
