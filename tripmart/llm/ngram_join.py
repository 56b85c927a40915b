"""Near copies by word shingles: an exact Jaccard join whose candidates come from signature trees."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import (
    IdFilter,
    connected_components,
    id_as_text,
    id_from_text,
    release,
    slices,
    small_batches,
    stored,
)
from tripmart.llm.shingles import mix, shingle_sets

LEAST_BITS, BITS_PER_SHINGLE = 512, 1
FANOUT = 8
BLOCK = 2_048
FIRSTS = 2  # first sets that a set is held against before the trees are traversed


def signature(shingles: np.ndarray) -> np.ndarray:
    """The bitmap of a set as 64-bit words: whether an odd number of its shingles falls on a place.

    A shingle of both sets leaves the bits of both as they differ, so two bitmaps differ in no more
    places than the sets do in shingles, and in almost as many where the sets are near. The number of
    bits is a power of two in proportion to the set. Bitmaps of different lengths are comparable once
    the longer is folded.
    """
    width = LEAST_BITS
    while width < BITS_PER_SHINGLE * len(shingles):
        width *= 2
    places = (shingles & np.uint64(width - 1)).astype(np.int64)
    bits = (np.bincount(places, minlength=width) & 1).astype(np.uint8)
    return np.packbits(bits, bitorder="little").view("<i8")


def folded(bitmaps: list[np.ndarray], length: int | None = None) -> np.ndarray:
    """The bitmaps that the same sets have at one smaller length in words; by default the least."""
    lengths = np.array([len(b) for b in bitmaps])
    length = int(lengths.min()) if length is None else length
    out = np.empty((len(bitmaps), length), dtype=np.uint64)
    for own in np.unique(lengths):
        rows = np.nonzero(lengths == own)[0]
        wide = np.stack([bitmaps[r] for r in rows]).view(np.uint64)
        out[rows] = np.bitwise_xor.reduce(wide.reshape(len(rows), own // length, length), axis=1)
    return out


def kept_for_prefix(n: int, num: int, den: int) -> int:
    """How many of a set's smallest shingles a partner with the wanted overlap can't all miss."""
    return n - -(-num * n // den) + 1 if n else 0


def kept_for_index(n: int, num: int, den: int) -> int:
    """The same against partners that are not smaller: the overlap has to be larger then."""
    return n - -(-2 * num * n // (num + den)) + 1 if n else 0


class SignatureTree:
    """Levels of nodes over sets: the bits that all sets below have and that any has, and their sizes.

    ``levels[0]`` are the sets themselves, in order of component and size so that nodes are alike;
    each node of a level covers ``FANOUT`` of the level below.
    """

    def __init__(self, bitmaps: np.ndarray, sizes: np.ndarray, components: np.ndarray):
        order = np.lexsort((sizes, components))
        self.rows = order
        bits = bitmaps[order]
        n = sizes[order].astype(np.int64)
        level = (bits, bits, n, n, components[order])
        self.levels = [level]
        while len(level[0]) > FANOUT:
            at = np.arange(0, len(level[0]), FANOUT)
            same = np.minimum.reduceat(level[4], at)
            mixed = same != np.maximum.reduceat(level[4], at)
            level = (
                np.bitwise_and.reduceat(level[0], at, axis=0),
                np.bitwise_or.reduceat(level[1], at, axis=0),
                np.minimum.reduceat(level[2], at),
                np.maximum.reduceat(level[3], at),
                np.where(mixed, -1, same),
            )
            self.levels.append(level)


def _few_enough(differ: np.ndarray, sizes: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether two sets of ``sizes`` together, that differ in so many shingles, are linked."""
    return differ * (num + den) <= (den - num) * sizes


def _possible(x, i, y, j, num: int, den: int) -> np.ndarray:
    """Which node pairs may hold a linked pair: the least they differ against what a link allows."""
    (all_x, any_x, low_x, high_x, comp_x), (all_y, any_y, low_y, high_y, comp_y) = x, y
    fits = (high_x[i] * den >= num * low_y[j]) & (high_y[j] * den >= num * low_x[i])
    fits &= (comp_x[i] != comp_y[j]) | (comp_x[i] < 0)
    i, j = i[fits], j[fits]
    apart = (all_x[i] & ~any_y[j]) | (all_y[j] & ~any_x[i])
    differ = np.bitwise_count(apart).sum(1).astype(np.int64)
    fits[fits] = _few_enough(differ, high_x[i] + high_y[j], num, den)
    return fits


def dual_traversal(
    a: SignatureTree, b: SignatureTree, num: int, den: int, step: int = 200_000
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of two trees that no level rules out, and that are not in one component.

    Goes down both trees together, the deeper one first, pruning node pairs on the way;
    ``step`` pairs are looked at together, whatever their number.
    """
    top_a, top_b = len(a.levels) - 1, len(b.levels) - 1
    n_a, n_b = len(a.levels[top_a][0]), len(b.levels[top_b][0])
    open_pairs = [(top_a, top_b, np.repeat(np.arange(n_a), n_b), np.tile(np.arange(n_b), n_a))]
    while open_pairs:
        la, lb, i, j = open_pairs.pop()
        if len(i) > step:
            open_pairs.append((la, lb, i[step:], j[step:]))
            i, j = i[:step], j[:step]
        keep = _possible(a.levels[la], i, b.levels[lb], j, num, den)
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        if la == lb == 0:
            yield a.rows[i], b.rows[j]
            continue
        child = np.arange(FANOUT)
        if la >= lb:
            down = (i[:, None] * FANOUT + child).ravel()
            j = np.repeat(j, FANOUT)
            inside = down < len(a.levels[la - 1][0])
            open_pairs.append((la - 1, lb, down[inside], j[inside]))
        else:
            down = (j[:, None] * FANOUT + child).ravel()
            i = np.repeat(i, FANOUT)
            inside = down < len(b.levels[lb - 1][0])
            open_pairs.append((la, lb - 1, i[inside], down[inside]))


def _merged(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The labels once those of ``x`` and ``y`` are one; each is the least place of its group."""
    while True:
        least = np.minimum(label[x], label[y])
        before = label.copy()
        np.minimum.at(label, before[x], least)
        np.minimum.at(label, before[y], least)
        label = label[label]
        if np.array_equal(label, before):
            return label


def spanning_pairs(x: np.ndarray, y: np.ndarray, share: np.ndarray, count: int) -> np.ndarray:
    """Which of the pairs of numbers below ``count`` join all that the pairs join, nearest first."""
    order = np.lexsort((y, x, share))
    label, taken = np.arange(count), []
    while len(order):
        order = order[label[x[order]] != label[y[order]]]
        if not len(order):
            break
        # each group takes its nearest pair; places in one order for all make no circle
        rank, best = np.arange(len(order)), np.full(count, len(order))
        np.minimum.at(best, label[x[order]], rank)
        np.minimum.at(best, label[y[order]], rank)
        new = order[np.unique(best[best < len(order)])]
        taken.append(new)
        label = _merged(label, x[new], y[new])
    return np.sort(np.concatenate(taken)) if taken else np.zeros(0, dtype=np.int64)


def _sets(frame: pd.DataFrame, width: int) -> list[np.ndarray]:
    return shingle_sets([(t or "").encode() for t in frame["text"]], width)


def _node(shingles: np.ndarray) -> int:
    """A 64-bit name of a set, the same for equal sets."""
    if not len(shingles):
        return 0
    return int(mix(mix(shingles).sum(dtype=np.uint64, keepdims=True))[0].astype(np.int64))


def _slim(docs: DataFrame, width: int, num: int, den: int, id_type: str) -> DataFrame:
    def make(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames, 500):
            sets = _sets(frame, width)
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "n": [len(s) for s in sets],
                    "node": [_node(s) for s in sets],
                    "prefix": [s[: kept_for_prefix(len(s), num, den)].astype(np.int64) for s in sets],
                    "n_index": [kept_for_index(len(s), num, den) for s in sets],
                    "bits": [signature(s) for s in sets],
                }
            )

    schema = "doc_id string, n long, node long, prefix array<long>, n_index int, bits array<long>"
    made = docs.select(id_as_text("doc_id", id_type).alias("doc_id"), "text").mapInPandas(make, schema)
    return made.withColumn("doc_id", id_from_text("doc_id", id_type))


def _whole_sets(docs: DataFrame, wanted: IdFilter, width: int) -> DataFrame:
    """(node, shingles) of the documents whose id may be wanted; a node may come twice."""

    def make(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            some = frame[wanted.may_hold(frame["place"].to_numpy())]
            for part in slices([some], 500):
                sets = _sets(part, width)
                yield pd.DataFrame(
                    {"node": [_node(s) for s in sets], "shingles": [s.astype(np.int64) for s in sets]}
                )

    placed = docs.select("text", IdFilter.place("doc_id").alias("place"))
    return placed.mapInPandas(make, "node long, shingles array<long>")


def _overlap_is_enough(num: int, den: int) -> Column:
    shared = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - shared
    return den * shared.cast("long") >= num * union.cast("long")


def _signatures_allow(pairs: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b) of the pairs that their bitmaps leave possible: the bound of two leaves of a tree."""

    def make(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames, 5_000):
            length = np.minimum(frame["bits_a"].map(len), frame["bits_b"].map(len)).to_numpy()
            for own in np.unique(length):
                part = frame[length == own]
                n_a, n_b = part["n_a"].to_numpy(), part["n_b"].to_numpy()
                x, y = (folded(list(part[c]), int(own)) for c in ("bits_a", "bits_b"))
                differ = np.bitwise_count(x ^ y).sum(1).astype(np.int64)
                yield part.loc[_few_enough(differ, n_a + n_b, num, den), ["a", "b"]]

    return pairs.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInPandas(make, "a long, b long")


class _Bucket:
    """The sets of trees with one first set, each held once, and the pairs found among them so far.

    Near copies share many trees and most of their pairs are linked, so a few pairs tell as much as
    all of them. With ``spanning`` a tree passes on as many pairs as join what its pairs join, the
    nearest ones, and what they join counts as one component from then on: nothing is lost if every
    pair passed on turns out to be linked. Without it every pair is passed on, once.
    """

    MOST_FOUND = 1_000_000  # then what was passed on is forgotten, and a pair may come twice

    def __init__(self, key: tuple[int, int, int], spanning: bool):
        self.key = key
        self.spanning = spanning
        self.place: dict[int, int] = {}
        self.n: list[int] = []
        self.component: list[int] = []
        self.bits: list[np.ndarray] = []
        self.label: np.ndarray | None = None
        self.found: set[tuple[int, int]] = set()

    def add(self, frame: pd.DataFrame) -> None:
        for node, n, component, bits in zip(frame["node"], frame["n"], frame["component"], frame["bits"]):
            self.place[node] = len(self.n)
            self.n.append(n)
            self.component.append(component)
            self.bits.append(bits)

    def candidates(self, frame: pd.DataFrame, num: int, den: int) -> Iterator[pd.DataFrame]:
        """Candidates (a, b) of one tree, or block of trees, that were not found before."""
        home, member, is_home = (frame[c].to_numpy(dtype=bool) for c in ("home", "member", "is_home"))
        node = frame["node"].to_numpy()
        ours, theirs = np.nonzero(home)[0], np.nonzero(member)[0]
        if not len(ours) or not len(theirs):
            return
        if self.label is None:  # all sets are known before the first tree comes
            self.label = np.unique(self.component, return_inverse=True)[1].astype(np.int64)
        at = [self.place[x] for x in node.tolist()]
        own, component = np.unique(self.label[at], return_inverse=True)
        if len(own) == 1:
            return
        n = np.array([self.n[x] for x in at], dtype=np.int64)
        bitmaps = folded([self.bits[x] for x in at])
        trees = [SignatureTree(bitmaps[r], n[r], component[r]) for r in (ours, theirs)]
        x = y = np.zeros(0, dtype=np.int64)
        new = []
        for i, j in dual_traversal(*trees, num, den):
            i, j = ours[i], theirs[j]
            once = (node[i] < node[j]) | ~is_home[j]
            if self.spanning:
                x, y = np.append(x, i[once]), np.append(y, j[once])
                share = np.bitwise_count(bitmaps[x] ^ bitmaps[y]).sum(1) / (n[x] + n[y])
                few = spanning_pairs(component[x], component[y], share, len(own))
                x, y = x[few], y[few]
                continue
            low, high = self._ordered(node, i[once], j[once])
            for pair in zip(low.tolist(), high.tolist()):
                if pair not in self.found:
                    self.found.add(pair)
                    new.append(pair)
        if len(self.found) > self.MOST_FOUND:
            self.found.clear()
        if len(x):
            new = zip(*self._ordered(node, x, y))
            groups = _merged(np.arange(len(own)), component[x], component[y])
            same = np.arange(int(self.label.max()) + 1)
            same[own] = own[groups]
            self.label = same[self.label]
        if new:
            found = pd.DataFrame(new, columns=["a", "b"])
            yield found.assign(**dict(zip(("first", "i", "j"), self.key)))

    @staticmethod
    def _ordered(node: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.minimum(node[x], node[y]), np.maximum(node[x], node[y])


_TREE = ["first", "i", "j", "is_tree", "shingle", "tree"]


def _traverse(
    frames: Iterator[pd.DataFrame], num: int, den: int, spanning: bool
) -> Iterator[pd.DataFrame]:
    """Candidates of sorted rows: of each bucket its sets first, and then its trees one by one."""
    bucket, rest = None, None
    for frame in itertools.chain(frames, [None]):
        if frame is None:
            if rest is None:  # a partition without rows, or none left over
                return
            frame, cuts = rest, [0, len(rest)]
        elif frame.empty:
            continue
        else:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            keys = frame[_TREE].to_numpy(dtype=np.int64)
            cuts = [0, *(np.nonzero((keys[1:] != keys[:-1]).any(1))[0] + 1).tolist()]
            if not frame["is_tree"].iloc[-1]:
                cuts.append(len(frame))  # sets need not wait for the others of their bucket
        for start, end in zip(cuts, cuts[1:]):
            part = frame.iloc[start:end]
            if not len(part):
                continue
            head = part.iloc[0]
            key = (int(head["first"]), int(head["i"]), int(head["j"]))
            if bucket is None or bucket.key != key:
                bucket = _Bucket(key, spanning)
            if head["is_tree"]:
                yield from bucket.candidates(part, num, den)
            else:
                bucket.add(part)
        rest = frame.iloc[cuts[-1] :].reset_index(drop=True)
        rest = rest if len(rest) else None


def ngram_components(
    docs: DataFrame,
    width: int = 5,
    num: int = 80,
    den: int = 100,
    id_col: str = "doc_id",
    text_col: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row; links are Jaccard >= ``num / den``.

    Equal sets are one node. A forest of signature trees finds the candidates: a tree covers the sets
    of a size band that share one of their smallest shingles, as any two linked sets do, and those of
    the next band; the smaller of two has it among its first half already. First every set is held
    against the least first sets of its trees, ``FIRSTS`` at most, which joins a large group of near
    copies by a few pairs a member. Then each tree of more than two with sets in different components
    is traversed against itself; node pairs are pruned by the least they differ, by size ranges, and
    where all below is one component already. Of the candidates a traversal passes on as many as span
    them. Every candidate passed on is checked on whole sets; only where one of them is no link the
    trees are traversed again, with the components known by then, and all candidates are checked. So a
    large group of near copies costs a few pairs a member and tree, not all pairs.
    Trees over ``block`` sets are traversed in blocks, so none is gathered in a task.

    Words are runs of other than ASCII blanks, A-Z in lower case; a text of fewer words than
    ``width`` is one shingle of all of them. Null, empty and blank texts have no shingle and link
    with nothing. Rows that repeat a text are one node; rows that repeat an id are listed as
    often as they come; a component without any id is null. An empty table gives no rows. Only
    the two named columns are read.
    """
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    spark = docs.sparkSession
    with small_batches(spark):
        slim = stored(_slim(texts, width, num, den, id_type), "shingles")
    # a linked pair shares a shingle of the shorter prefix of the smaller and the prefix of the other
    shingles = slim.where("n > 0").select(
        "node", "n", "n_index", F.posexplode("prefix").alias("at", "shingle")
    ).select("node", "n", (F.col("at") < F.col("n_index")).alias("indexed"), "shingle")
    band = F.floor(F.log(F.col("n").cast("double")) / (math.log(den / num) * (1 + 1e-9))).cast("int")
    # equal sets become one member here, before anything is counted; one shuffle serves both steps
    alike = Window.partitionBy("shingle")
    shared = (
        shingles.repartition("shingle")
        .distinct()
        .withColumn("low", F.min("node").over(alike))
        .withColumn("high", F.max("node").over(alike))
        .withColumn("any_indexed", F.max("indexed").over(alike))
        .where("low <> high and any_indexed")
    )
    members = stored(shared.select("shingle", "node", "n", "indexed"), "members")
    # trees: (shingle, band) with the sets of the band, and of the next one as a second role
    roles = F.explode(
        F.array(
            F.struct(band.alias("tree"), F.lit(True).alias("own"), F.col("indexed").alias("home")),
            F.struct((band - 1).alias("tree"), F.lit(False).alias("own"), F.lit(False).alias("home")),
        )
    )
    in_roles = members.select("shingle", "node", "n", roles.alias("r")).select(
        "shingle", "node", "n", "r.tree", "r.own", "r.home"
    )
    trees = (
        in_roles.groupBy("shingle", "tree")
        .agg(
            F.count("*").alias("k"),
            F.min(F.when(F.col("home"), F.col("node"))).alias("first"),
            F.bit_xor(F.xxhash64("node", "own", "home")).alias("x1"),
            F.bit_xor(F.xxhash64("home", "own", "node", F.lit(1))).alias("x2"),
        )
        .where("k > 1 and first is not null")
        # trees over the same sets are one tree
        .groupBy("k", "first", "x1", "x2")
        .agg(F.min(F.struct("shingle", "tree")).alias("t"))
        .select("t.shingle", "t.tree", "k", "first")
    )
    forest = stored(in_roles.join(trees, ["shingle", "tree"]), "trees")
    release(members)
    # what the rest needs of each set in some tree, and of every row
    in_forest = forest.select("node").distinct()
    bits = stored(
        slim.join(in_forest, "node", "left_semi")
        .groupBy("node", "n")
        .agg(F.min("doc_id").alias("rep"), F.first("bits").alias("bits")),
        "signatures",
    )
    rows_of = stored(slim.select("doc_id", "n", "node"), "nodes")
    release(slim)

    def checked(pairs: DataFrame, label: str) -> DataFrame:
        """The pairs (a, b) that are linked, by their whole sets."""
        pairs = stored(pairs.select("a", "b").distinct(), f"{label}-pairs")
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        wanted = IdFilter.of(nodes.join(bits.select("node", "rep"), "node"), "rep")
        with small_batches(spark):
            sets = stored(_whole_sets(texts, wanted, width), f"{label}-sets")
        joined = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
        linked = stored(joined.where(_overlap_is_enough(num, den)).select("a", "b"), f"{label}-links")
        release(sets)
        release(pairs)
        return linked

    # trees of two have no other pair; of the others a set is held against a few of its first sets
    with_first = forest.where("node <> first").select("node", "first", "k")
    several = with_first.where("k > 2").groupBy("node").agg(F.collect_set("first").alias("firsts"))
    few = several.select("node", F.explode(F.slice(F.array_sort("firsts"), 1, FIRSTS)).alias("first"))
    held = with_first.where("k = 2").select("node", "first").union(few)
    pairs = held.select(F.least("node", "first").alias("a"), F.greatest("node", "first").alias("b")).distinct()
    for side in ("a", "b"):
        pairs = pairs.join(bits.select("node", "n", "bits").toDF(side, f"n_{side}", f"bits_{side}"), side)
    fits = (F.col("n_a") * den >= F.col("n_b") * num) & (F.col("n_b") * den >= F.col("n_a") * num)
    links = checked(_signatures_allow(pairs.where(fits), num, den), "first")
    joined = connected_components(links, "first-components")

    placed = stored(
        forest.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node")),
        "placed",
    )
    release(forest)
    release(links)
    apart = (
        placed.groupBy("shingle", "tree")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select("shingle", "tree")
    )
    # a tree of two has no pair left
    in_blocks = placed.where("k > 2").join(apart, ["shingle", "tree"]).withColumn(
        "blocks", F.ceil(F.col("k") / block).cast("int")
    ).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    others = F.explode(F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: x != F.col("block")))
    rows = ("first", "shingle", "tree", "node", "component", F.col("home").alias("is_home"))
    own_block, yes, no = F.col("block"), F.lit(True), F.lit(False)
    members = stored(
        in_blocks.select(
            *rows, F.col("home"), yes.alias("member"), own_block.alias("i"), own_block.alias("j")
        )
        .union(in_blocks.where("home").select(*rows, yes, no, own_block, others))
        .union(in_blocks.select(*rows, no, yes, others, own_block)),
        "in-trees",
    )
    release(placed)
    flags = [F.lit(False).alias(c) for c in ("is_tree", "home", "member", "is_home")]
    none = F.lit(0).cast("bigint")

    def candidates(members: DataFrame, spanning: bool) -> DataFrame:
        """(a, b) and the bucket that they are of."""
        # a bucket has the trees of one first set; what is known of a set travels to it once, not by tree
        in_buckets = members.select("first", "i", "j", "node", "component").distinct()
        sets = in_buckets.join(bits.select("node", "n", "bits"), "node").select(
            "first", "i", "j", "node", "n", "component", "bits", none.alias("shingle"), F.lit(0).alias("tree"), *flags
        )
        tasks = members.select(
            "first", "i", "j", "node", none.alias("n"), none.alias("component"), F.lit(None).cast("array<bigint>").alias("bits"),
            "shingle", "tree", F.lit(True).alias("is_tree"), "home", "member", "is_home",
        ).union(sets)
        return (
            tasks.repartition("first", "i", "j")
            .sortWithinPartitions(*_TREE)
            .mapInPandas(
                lambda frames: _traverse(frames, num, den, spanning),
                "a long, b long, first long, i int, j int",
            )
        )

    spanning = stored(candidates(members, True), "spanning")
    more = checked(spanning, "tree")
    # what the passes joined so far is known by its components
    known = joined.where("node <> component").toDF("a", "b")
    components = connected_components(known.union(more), "components")
    release(joined)
    unsure = stored(
        spanning.join(more, ["a", "b"], "left_anti").select("first", "i", "j").distinct(), "unsure"
    )
    release(spanning)
    release(more)
    if not unsure.isEmpty():
        again = stored(
            members.join(unsure, ["first", "i", "j"])
            .drop("component")
            .join(components, "node", "left")
            .withColumn("component", F.coalesce("component", "node")),
            "again",
        )
        rest = checked(candidates(again, False), "rest")
        release(again)
        settled = components
        known = settled.where("node <> component").toDF("a", "b")
        components = connected_components(known.union(rest), "components")
        release(settled)
        release(rest)
    release(unsure)
    release(members)
    release(bits)
    classes = rows_of.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("rep"))
    named = classes.join(components, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_node = stored(named.join(least, "component").select("node", "component_id"), "classes")
    release(components)
    return rows_of.join(of_node, "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
