"""Near copies among vectors: E8 lattice cells in several tables, exact cosine in the cells."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import connected_components, slices, stored

TABLES, LATTICES, SCALE, SEED = 16, 3, 3.0, 2024
BLOCK = 512


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """The nearest whole-number points with an even sum (the lattice D8)."""
    near = np.rint(x)
    odd = (near.sum(-1).astype(np.int64) & 1).astype(bool)
    error = x - near
    worst = np.abs(error).argmax(-1)[..., None]
    step = np.where(np.take_along_axis(error, worst, -1) >= 0, 1.0, -1.0)
    moved = near.copy()
    np.put_along_axis(moved, worst, np.take_along_axis(near, worst, -1) + step, -1)
    return np.where(odd[..., None], moved, near)


def decode_e8(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest E8 points along the last axis, and the nearest of the other coset.

    E8 is D8 and D8 shifted by a half. The nearest point of the coset that lost is a close
    neighbouring cell: where a vector would fall if it moved a little.
    """
    whole = _nearest_even(x)
    half = _nearest_even(x - 0.5) + 0.5
    is_whole = (((x - whole) ** 2).sum(-1) <= ((x - half) ** 2).sum(-1))[..., None]
    return np.where(is_whole, whole, half), np.where(is_whole, half, whole)


class Lattices:
    """Cells of unit vectors: per table, random orthogonal projections onto several lattices."""

    def __init__(self, dimension: int, tables=TABLES, lattices=LATTICES, scale=SCALE, seed=SEED):
        rng = np.random.default_rng([seed, dimension])
        wide = 8 * lattices
        self.tables, self.lattices = tables, lattices
        planes = []
        for _ in range(tables):
            if wide <= dimension:
                basis = np.linalg.qr(rng.normal(size=(dimension, wide)))[0]
            else:
                basis = rng.normal(size=(dimension, wide)) / np.sqrt(wide)
            planes.append(basis)
        # distances shrink to sqrt(8 / dimension) on eight axes; undo that for any dimension
        self.planes = np.hstack(planes) * scale * np.sqrt(max(dimension, 8) / 64)
        self.mix = rng.integers(1, 2**62, (tables, lattices, 8), dtype=np.int64)

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """(vector, table, look) cell numbers: look 0 is home, each other changes one lattice."""
        x = (unit @ self.planes).reshape(len(unit), self.tables, self.lattices, 8)
        near, other = decode_e8(x)
        near = ((2 * near).astype(np.int64) * self.mix).sum(-1)
        other = ((2 * other).astype(np.int64) * self.mix).sum(-1)
        home = near.sum(-1) * self.tables + np.arange(self.tables)
        looks = [home] + [home + (other - near)[..., i] * self.tables for i in range(self.lattices)]
        return np.stack(looks, axis=-1)


def _unit(vectors) -> np.ndarray:
    x = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    # by the largest component first, so that no square overflows or vanishes
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _pairs_in_cell(
    unit: np.ndarray,
    ids: np.ndarray,
    homes: np.ndarray,
    members: np.ndarray,
    cell: int,
    lattices: Lattices,
    cosine: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (member, home) of rows of a cell, unless they were found earlier."""
    a, b = np.nonzero(unit[members] @ unit[homes].T >= cosine - 1e-9)
    a, b = members[a], homes[b]
    different = ids[a] != ids[b]
    a, b = a[different], b[different]
    if not len(a):
        return a, b
    # cosine once more as a plain sum, so that a pair's value does not depend on its block
    exact = np.einsum("ij,ij->i", unit[a], unit[b]) >= cosine
    a, b = a[exact], b[exact]
    used, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    looks = lattices.cells(unit[used])
    of_a, of_b = looks[place[: len(a)]], looks[place[len(a) :]]
    first = np.ones(len(a), dtype=bool)
    for t in range(lattices.tables):
        back = (of_b[:, t] == of_a[:, t, :1]).any(1)  # the home's own looks reach the member
        if (of_b[:, t, 0] == cell).all():  # homes of a cell have it in its own table
            first &= ~back | (ids[a] < ids[b])
            break
        first &= ~((of_a[:, t] == of_b[:, t, :1]).any(1) | back)
    return a[first], b[first]


def _roots(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """The smallest row reachable from each row."""
    root = np.arange(size)
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            return root


def near_vectors(
    vectors: DataFrame,
    cosine: float = 0.9,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    tables: int = TABLES,
    block: int = BLOCK,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors``.

    Two vectors are linked when some table has one in a cell that the other looks into and their
    cosine, in double precision, is at least ``cosine``. Equal vectors are one representative with
    a number of copies. Cells go to tasks in blocks of about ``block`` vectors against ``block``
    vectors, so no cell is gathered whole; a pair found in several tables counts only where it is
    found first, and of each block only counts and a spanning forest leave the task.

    Vectors that are null, empty, zero or hold null or non-finite components have no links and are
    kept. Vectors of different lengths are never linked. Rows that repeat an id with
    another vector are one node and share its links; a null id gets a row without links. An empty table gives no rows. Only the
    two named columns are read.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"))
    rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    bad = F.exists(
        "vector",
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")),
    )
    usable = (
        F.col("vec_id").isNotNull()
        & F.col("vector").isNotNull()
        & ~F.coalesce(bad, F.lit(True))
        & F.exists("vector", lambda x: x != 0)
    )
    usable = F.coalesce(usable, F.lit(False))
    id_type = rows.schema["vec_id"].dataType.simpleString()
    classes = stored(
        rows.where(usable)
        .groupBy("vector")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")),
        "vectors",
    )

    def looks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made: dict[int, Lattices] = {}
        for frame in slices(frames, 2_000):
            for size, part in frame.groupby(frame["vector"].map(len)):
                lattices = made.setdefault(size, Lattices(size, tables))
                cells = lattices.cells(_unit(part["vector"]))
                n, per = len(part), cells.shape[1] * cells.shape[2]
                yield pd.DataFrame(
                    {
                        "cell": cells.reshape(-1),
                        "rep": np.repeat(part["rep"].to_numpy(), per),
                        "home": np.tile(np.arange(cells.shape[2]) == 0, n * cells.shape[1]),
                    }
                )

    postings = stored(
        classes.select("rep", "vector").mapInPandas(looks, f"cell long, rep {id_type}, home boolean"),
        "cells",
    )
    busy = (
        postings.groupBy("cell")
        .agg(F.count("*").alias("n"), F.sum(F.col("home").cast("int")).alias("homes"))
        .where("n > 1 and homes > 0")
        .select("cell", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    )
    placed = postings.join(busy, "cell").withColumn(
        "own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    )
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    as_member = placed.select(
        "cell", "rep", every.alias("i"), F.col("own").alias("j"),
        F.lit(False).alias("home"), F.lit(True).alias("member"),
    )
    as_home = placed.where("home").select(
        "cell", "rep", F.col("own").alias("i"), every.alias("j"),
        F.lit(True).alias("home"), F.lit(False).alias("member"),
    )
    tasks = (
        as_member.union(as_home)
        .groupBy("cell", "i", "j", "rep")
        .agg(F.max("home").alias("home"), F.max("member").alias("member"))
        .join(classes, "rep")
    )

    def linked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made: dict[int, Lattices] = {}

        def of(frame: pd.DataFrame, cuts: list[int]) -> pd.DataFrame | None:
            """Links of the cells between the cuts; vectors of one length at a time."""
            ids, copies = frame["rep"].to_numpy(), frame["copies"].to_numpy()
            home, member, cell = (frame[c].to_numpy() for c in ("home", "member", "cell"))
            lengths = frame["vector"].map(len).to_numpy()
            parts = []
            for size in np.unique(lengths):
                rows = np.nonzero(lengths == size)[0]
                lattices = made.setdefault(int(size), Lattices(int(size), tables))
                unit = np.zeros((len(frame), size))
                unit[rows] = _unit(frame["vector"].iloc[rows])
                for start, end in zip(cuts, cuts[1:]):
                    own = rows[np.searchsorted(rows, start) : np.searchsorted(rows, end)]
                    homes, members = own[home[own]], own[member[own]]
                    if not len(homes) or len(own) < 2:
                        continue
                    a, b = _pairs_in_cell(unit, ids, homes, members, int(cell[start]), lattices, cosine)
                    if not len(a):
                        continue
                    a, b, n = a - start, b - start, end - start
                    links = np.bincount(a, copies[b + start], n) + np.bincount(b, copies[a + start], n)
                    got = np.nonzero(links)[0]
                    root = _roots(a, b, n)[got]
                    parts.append((ids[got + start], links[got].astype(np.int64), ids[root + start]))
            if not parts:
                return None
            return pd.DataFrame(dict(zip(("rep", "links", "other"), map(np.concatenate, zip(*parts)))))

        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            key = frame[["cell", "i", "j"]].to_numpy()
            cuts = [0, *(np.nonzero((key[1:] != key[:-1]).any(1))[0] + 1).tolist()]
            if (found := of(frame.iloc[: cuts[-1]], cuts)) is not None:
                yield found
            rest = frame.iloc[cuts[-1] :].reset_index(drop=True)
        if rest is not None and len(rest) and (found := of(rest, [0, len(rest)])) is not None:
            yield found

    found = stored(
        tasks.repartition("cell", "i", "j")
        .sortWithinPartitions("cell", "i", "j")
        .mapInPandas(linked, f"rep {id_type}, links long, other {id_type}"),
        "links",
    )
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    components = connected_components(
        found.select(F.col("rep").alias("a"), F.col("other").alias("b")), "vector-components"
    ).select(F.col("node").alias("rep"), "component")
    reps = classes.join(counts, "rep", "left").join(components, "rep", "left").select(
        F.col("vector").alias("__vector"), "rep", "copies", "links", "component"
    )
    keyed = rows.withColumn("__vector", F.when(usable, F.col("vector")))
    result = keyed.join(reps, "__vector", "left").select(
        "vec_id",
        (F.coalesce(F.col("copies"), F.lit(1)) - 1 + F.coalesce("links", F.lit(0)))
        .cast("long")
        .alias("n_links"),
        F.coalesce("component", "rep", "vec_id").alias("component_id"),
    )
    return result.withColumn("kept", F.col("vec_id") == F.col("component_id"))
