"""Trie of the beginnings that conversations share, found from its deepest level upwards."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import stored

MOST_TURNS = 8  # turns that a conversation takes over from the first one of its group
GROUP = 5  # conversations that share a first one

# Levels up to this depth are peeled one a job. Deeper ones are peeled several a job, as many as have
# this many turn keys together, so that a few very long conversations need no job for each turn.
SINGLE_LEVELS = 32
BLOCK_KEYS = 2_000_000

_NODE = "depth int, ka bigint, kb bigint, pa bigint, pb bigint, conv_id bigint, n_convs bigint, " \
    "n_children bigint, n_leaves bigint, saved_tokens bigint"
_PATH = "a array<bigint>, b array<bigint>, nb array<bigint>"
_SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens")


def rebuilt_paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, ka, kb, a, b, nb): each rebuilt conversation as a path of turn keys.

    A conversation is its turns in order, a null turn first, equal turns by the checksum of role and
    text; null role and text are empty. It takes the first ``h`` turns of the first conversation of its
    group of five and then its own turns after the first ``h``; ``h`` is the checksum of its id
    modulo 9. ``a`` and ``b`` hold two 64-bit keys of each turn at its place, ``nb`` the bytes of its text, and
    ``ka``, ``kb`` the keys of the whole path: the exclusive or of its turn keys, so that stripping
    a turn takes its key out again. Only keys are gathered by conversation, 24 bytes a turn.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.struct(
        F.col("turn"),
        F.unhex(F.md5(F.concat(F.md5(role), F.md5(text)))).alias("key"),
        F.octet_length(text).cast("bigint").alias("nb"),
    )
    own = stored(
        conversations.where(F.col("conv_id").isNotNull())
        .groupBy(F.col("conv_id").cast("bigint").alias("conv_id"))
        .agg(F.sort_array(F.collect_list(turn)).alias("turns")),
        "conversations",
    )
    firsts = own.select(F.col("conv_id").alias("first_id"), F.slice("turns", 1, MOST_TURNS).alias("head"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_TURNS + 1)).cast("int")
    head = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), taken)
    tail = F.slice("turns", taken + 1, F.greatest(F.size("turns"), F.lit(1)))
    joined = own.join(firsts, F.col("first_id") == F.col("conv_id") - F.col("conv_id") % GROUP, "left")
    turns = joined.select("conv_id", F.concat(head, tail).alias("turns"))

    def keys(salt: int) -> Column:
        return F.transform("turns", lambda t, i: F.xxhash64(F.lit(salt), i, t["key"]))

    paths = turns.select(
        "conv_id",
        F.size("turns").alias("n_turns"),
        keys(0).alias("a"),
        keys(1).alias("b"),
        F.transform("turns", lambda t: t["nb"]).alias("nb"),
    )
    whole = paths.select("conv_id", "n_turns", _xor("a").alias("ka"), _xor("b").alias("kb"), "a", "b", "nb")
    return stored(whole.sortWithinPartitions("n_turns"), "paths")


def _xor(keys: str | Column) -> Column:
    return F.aggregate(keys, F.lit(0).cast("bigint"), lambda x, y: x.bitwiseXOR(y))


def _last(name: str) -> Column:
    return F.coalesce(F.try_element_at(name, F.lit(-1)), F.lit(0).cast("bigint"))


def _stripped(nodes: DataFrame) -> DataFrame:
    """Nodes without their last turn: what their parents are made of."""
    cut = [F.slice(c, F.lit(1), F.size(c) - 1).alias(c) for c in ("a", "b", "nb")]
    return nodes.select(
        F.col("pa").alias("ka"), F.col("pb").alias("kb"), "conv_id", "n_convs",
        F.lit(1).cast("bigint").alias("n_children"), "n_leaves", "saved_tokens", *cut,
    )


def _ended(paths: DataFrame, low: int, high: int) -> DataFrame:
    """Conversations whose last turn is at these depths."""
    zero = F.lit(0).cast("bigint")
    return paths.where(F.col("n_turns").between(low, high)).select(
        "ka", "kb", "conv_id", F.lit(1).cast("bigint").alias("n_convs"), zero.alias("n_children"),
        zero.alias("n_leaves"), zero.alias("saved_tokens"), "a", "b", "nb",
    )


def _level(rows: DataFrame, depth: int) -> DataFrame:
    """The nodes of one depth, merged from stripped and newly ended paths in one grouping.

    Sums and a minimum are combined before the shuffle: a beginning that a third of all
    conversations share reaches it once for each task.
    """
    merged = rows.groupBy("ka", "kb").agg(
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in _SUMS],
        *[F.first(c).alias(c) for c in ("a", "b", "nb")],
    )
    leaves = F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("bigint")
    saved = F.col("saved_tokens") + (F.col("n_convs") - 1) * _last("nb")
    return merged.select(
        F.lit(depth).alias("depth"), "ka", "kb",
        F.col("ka").bitwiseXOR(_last("a")).alias("pa"), F.col("kb").bitwiseXOR(_last("b")).alias("pb"),
        "conv_id", "n_convs", "n_children", leaves.alias("n_leaves"), saved.alias("saved_tokens"),
        "a", "b", "nb",
    )


def _block(rows: DataFrame, low: int, high: int) -> DataFrame:
    """The nodes of the depths from ``high`` up to ``low``, of paths that share what lies above."""

    def peel(frame: pd.DataFrame) -> pd.DataFrame:
        waiting: dict[int, list] = {}
        for row in frame.itertuples(index=False):
            waiting.setdefault(len(row.a), []).append(
                (row.ka, row.kb, row.conv_id, row.n_convs, row.n_children, row.n_leaves, row.saved_tokens, row.a, row.b, row.nb)
            )
        out = []
        for depth in range(high, low - 1, -1):
            nodes: dict[tuple[int, int], list] = {}
            for ka, kb, conv, *sums, a, b, nb in waiting.pop(depth, ()):
                node = nodes.setdefault((ka, kb), [conv, 0, 0, 0, 0, a, b, nb])
                node[0] = min(node[0], conv)
                for at, value in enumerate(sums, 1):
                    node[at] += value
            for (ka, kb), (conv, convs, children, leaves, saved, a, b, nb) in nodes.items():
                leaves, saved = leaves if children else 1, saved + (convs - 1) * int(nb[depth - 1])
                above = ka ^ int(a[depth - 1]), kb ^ int(b[depth - 1])
                path = (a[:depth], b[:depth], nb[:depth]) if depth == low else (None, None, None)
                out.append((depth, ka, kb, *above, conv, convs, children, leaves, saved, *path))
                waiting.setdefault(depth - 1, []).append((*above, conv, convs, 1, leaves, saved, a, b, nb))
        names = [f.split()[0] for f in f"{_NODE}, {_PATH}".split(", ")]
        return pd.DataFrame(out, columns=names)

    beginning = [_xor(F.slice(c, 1, low - 1)).alias(f"g{c}") for c in ("a", "b")]
    return rows.select("*", *beginning).groupBy("ga", "gb").applyInPandas(peel, f"{_NODE}, {_PATH}")


def _depths(lengths: dict[int, int]) -> Iterator[tuple[int, int]]:
    """Which depths are peeled together, from the deepest to the root: (lowest, highest).

    ``lengths`` counts conversations by turns; no depth has more nodes than conversations reach it.
    """
    high, reaching = max(lengths, default=-1), 0
    while high >= 0:
        low = high
        reaching += lengths.get(high, 0)
        while low - 1 > SINGLE_LEVELS and (reaching + lengths.get(low - 1, 0)) * high <= BLOCK_KEYS:
            low -= 1
            reaching += lengths.get(low, 0)
        yield low, high
        high = low - 1


def _digests(paths: DataFrame) -> DataFrame:
    """(depth, ka, kb, ends_sha256): digest of the ids of the conversations that end at a node.

    Ids are sorted and joined by runs of 4,096 possible ids, then a node's runs stream in order
    through its digest, which is one after the other by its nature but holds no list of them.
    """
    by_run = paths.groupBy(
        F.col("n_turns").alias("depth"), "ka", "kb", F.shiftright("conv_id", 12).alias("run")
    ).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    nodes = ("depth", "ka", "kb")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, done = None, None, []

        def rows(found: list) -> pa.RecordBatch:
            columns = list(zip(*found))
            types = (pa.int32(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=[*nodes, "ends_sha256"]
            )

        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in nodes))
            for key, ids in zip(keys, batch.column("ids")):
                if key != current:
                    if current is not None:
                        done.append((*current, state.hexdigest()))
                    current, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.as_py().encode())
            if len(done) >= 10_000:
                yield rows(done)
                done = []
        if current is not None:
            yield rows([*done, (*current, state.hexdigest())])

    ordered = by_run.repartition(*nodes).sortWithinPartitions(*nodes, "run")
    return ordered.mapInArrow(digest, "depth int, ka bigint, kb bigint, ends_sha256 string")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """A row for each distinct sequence of first turns of the rebuilt conversations.

    Levels are peeled from the deepest one: conversations that end there join the nodes that
    survive from below, equal paths are merged, counts, leaves and savings of whole subtrees go
    along, and the last turn is stripped for the next level. So a node is found and finished in
    one grouping and no subtree is ever walked. ``ends_sha256`` is the digest of the ids that end
    at the node.

    Rows with a null ``conv_id`` belong to no conversation and are left out. Repeated rows are turns
    of their own. Without any conversation there is no node, not even a root. Other columns are not
    read. A conversation's turn keys are one row, 24 bytes a turn, however long its texts are.
    """
    paths = rebuilt_paths(conversations)
    counted = paths.groupBy("n_turns").count().collect()  # as many rows as there are lengths
    levels, above = [], None
    for low, high in _depths({r["n_turns"]: r["count"] for r in counted}):
        rows = _ended(paths, low, high)
        if above is not None:
            rows = rows.unionByName(_stripped(above))
        level = stored(_level(rows, high) if low == high else _block(rows, low, high), "level")
        above = level.where(F.col("depth") == low)
        levels.append(level.drop("a", "b", "nb"))
    spark = conversations.sparkSession
    nodes = reduce(DataFrame.union, levels) if levels else spark.createDataFrame([], _NODE)
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("ka").alias("pa"), F.col("kb").alias("pb"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    named = nodes.join(parents, ["depth", "pa", "pb"], "left").join(_digests(paths), ["depth", "ka", "kb"], "left")
    return named.select(
        "conv_id", F.col("depth").cast("bigint").alias("depth"), "parent_conv_id", "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
