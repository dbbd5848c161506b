"""Near copies among vectors: exact cosine in tiles, leading principal axes first."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outagelens.llm.components import components
from outagelens.llm.shared import stored
from outagelens.llm.text_arrays import slices
from outagelens.llm.tiles import each_tile


@dataclass(frozen=True)
class Near:
    """``sample``: vectors from which the principal axes are taken, by hash; the axes only
    decide the order in which products are added. ``block``: vectors on a side of a tile."""

    cosine: float = 0.93
    sample: int = 20_000
    block: int = 1_024
    first_axes: int = 16


#: what rounding may move a sum of products by; pairs this close are counted anew
_MARGIN = 1e-9


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    rows = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    # scaled first, so that squares neither overflow nor vanish
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def principal_axes(vectors: np.ndarray) -> np.ndarray:
    """Orthonormal axes of the unit vectors as columns, the widest first."""
    unit = _unit(vectors)
    return np.ascontiguousarray(np.linalg.eigh(unit.T @ unit)[1][:, ::-1])


def close_pairs(a: np.ndarray, b: np.ndarray, axes: np.ndarray, near: Near, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i in a, j in b) with at least the cosine; i < j if both are the same.

    Products are added along the axes in steps that double. After each step the rest of a
    product is at most the product of the vectors' remaining lengths; pairs that cannot
    reach the cosine any more are left out of the next step.
    """
    unit_a, unit_b = _unit(a), _unit(b)
    turned_a, turned_b = unit_a @ axes, unit_b @ axes
    size = axes.shape[0]

    def rest(turned: np.ndarray, done: int) -> np.ndarray:
        return np.sqrt((turned[:, done:] ** 2).sum(axis=1))

    done = min(near.first_axes, size)
    sums = turned_a[:, :done] @ turned_b[:, :done].T
    possible = sums + rest(turned_a, done)[:, None] * rest(turned_b, done)[None, :] >= near.cosine - _MARGIN
    if same:
        possible = np.triu(possible, 1)
    i, j = np.nonzero(possible)
    part = sums[i, j]
    while done < size and len(i):
        step = min(done, size - done)
        part = part + np.einsum("ij,ij->i", turned_a[i, done : done + step], turned_b[j, done : done + step])
        done += step
        keep = part + rest(turned_a, done)[i] * rest(turned_b, done)[j] >= near.cosine - _MARGIN
        i, j, part = i[keep], j[keep], part[keep]
    edge = np.abs(part - near.cosine) <= _MARGIN
    part[edge] = np.einsum("ij,ij->i", unit_a[i[edge]], unit_b[j[edge]])
    sure = part >= near.cosine
    return i[sure], j[sure]


def _least_labels(size: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest position that each position reaches by the pairs."""
    labels = np.arange(size)
    while len(i):
        low = np.minimum(labels[i], labels[j])
        before = labels.copy()
        np.minimum.at(labels, i, low)
        np.minimum.at(labels, j, low)
        labels = labels[labels]
        if (labels == before).all():
            break
    return labels


def _tile_work(bases: dict[int, np.ndarray], near: Near):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in each_tile(batches):
            ids = table.column("id").to_numpy()
            copies = table.column("copies").to_numpy()
            side = table.column("side").to_numpy()
            vectors = _matrix(table.column("vector"))
            axes = bases[vectors.shape[1]]
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            linked = np.zeros(len(ids), dtype=np.int64)
            pairs_i, pairs_j = [], []
            same = not len(right)
            other = left if same else right
            for low in range(0, len(left), near.block):
                rows = left[low : low + near.block]
                for at in range(low if same else 0, len(other), near.block):
                    cols = other[at : at + near.block]
                    i, j = close_pairs(vectors[rows], vectors[cols], axes, near, same and at == low)
                    i, j = rows[i], cols[j]
                    np.add.at(linked, i, copies[j])
                    np.add.at(linked, j, copies[i])
                    labels = _least_labels(len(ids), i, j)  # a tile's pairs shrink to a tree
                    moved = np.flatnonzero(labels != np.arange(len(ids)))
                    pairs_i.append(moved)
                    pairs_j.append(labels[moved])
            i, j = np.concatenate([*pairs_i, left[:0]]), np.concatenate([*pairs_j, left[:0]])
            labels = _least_labels(len(ids), i, j)
            found = np.flatnonzero(linked > 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[found]), pa.array(linked[found]), pa.array(ids[labels[found]])],
                names=["id", "linked", "other"])
    return work


def _valid(vector: Column) -> Column:
    wide = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(wide, lambda x: x != 0.0)
    return F.coalesce(vector.isNotNull() & ~bad & some, F.lit(False))


def _bases(classes: DataFrame, near: Near) -> dict[int, np.ndarray]:
    """Principal axes for each length of vectors, from a sample of bounded size."""
    counts = {r["dim"]: r["n"] for r in classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0)
    for dim, n in counts.items():
        share = F.when(F.col("dim") == dim, max(1, min(2**20, near.sample * 2**20 // n))).otherwise(share)

    def axes(table: pa.Table) -> pa.Table:
        found = principal_axes(_matrix(table.column("vector")))
        return pa.table({"dim": table.column("dim").slice(0, 1), "axes": [found.ravel().tolist()]})

    sample = classes.filter(F.pmod(F.xxhash64("id"), F.lit(2**20)) < share).select("dim", "vector")
    bases = {d: np.eye(d) for d in counts}  # when chance leaves a sample empty
    for row in sample.groupBy("dim").applyInArrow(axes, "dim int, axes array<double>").collect():
        bases[row["dim"]] = np.array(row["axes"]).reshape(row["dim"], row["dim"])
    return bases


#: axes along which vectors are dealt into cells
_GRID = 3
#: cells that may hold links of a cell: itself and half of those around it
_AROUND = [(x, y, z) for x in (0, 1) for y in (-1, 0, 1) for z in (-1, 0, 1) if (x, y, z) >= (0, 0, 0)]


def _cells(classes: DataFrame, bases: dict[int, np.ndarray], width: float) -> DataFrame:
    """Adds x, y, z: the cell of each vector in a grid along its three widest axes."""
    shared = classes.sparkSession.sparkContext.broadcast({d: axes[:, :_GRID] for d, axes in bases.items()})

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            dims, cell = batch.column("dim").to_numpy(), np.zeros((batch.num_rows, _GRID), dtype=np.int32)
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                axes = shared.value[int(dim)]
                vectors = _matrix(pa.chunked_array([batch.column("vector").take(pa.array(rows))]))
                cell[rows, : axes.shape[1]] = np.floor(_unit(vectors) @ axes / width)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(cell[:, k]) for k in range(_GRID)]], names=[*batch.schema.names, "x", "y", "z"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in classes.schema)
    return stored(classes.mapInArrow(work, f"{fields}, x int, y int, z int"))


def _tiles(classes: DataFrame, bases: dict[int, np.ndarray], near: Near) -> DataFrame:
    """Rows dealt into tiles that hold every pair of blocks that may link.

    Vectors of one label lie in cells as wide as the distance of the farthest linked pair, so
    links join equal or neighbouring cells only; large cells are cut into blocks by hash.
    """
    cell = ["label", "dim", "x", "y", "z"]
    cut = _cells(classes, bases, math.sqrt(2 - 2 * near.cosine) + 1e-6)
    sizes = cut.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / near.block).alias("blocks"))
    rows = cut.join(sizes, cell).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks"))).drop("blocks")
    blocks = sizes.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    step = F.explode(F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip("ijk", s, strict=True)]) for s in _AROUND]))
    left = blocks.withColumn("step", step).select(
        "label", "dim", *[F.col(c).alias(f"{c}0") for c in "xyz"], F.col("block").alias("b0"),
        *[(F.col(c) + F.col(f"step.{k}")).alias(c) for c, k in zip("xyz", "ijk", strict=True)])
    same = functools.reduce(lambda p, q: p & q, [F.col(c) == F.col(f"{c}0") for c in "xyz"])
    pairs = (
        left.join(blocks.withColumnRenamed("block", "b1"), cell).filter(~same | (F.col("b1") >= F.col("b0")))
        .withColumn("tile", F.concat_ws("/", "label", "dim", "x0", "y0", "z0", "b0", "x", "y", "z", "b1"))
    )
    near_side = pairs.select(
        "label", "dim", *[F.col(f"{c}0").alias(c) for c in "xyz"], F.col("b0").alias("block"), "tile", F.lit(0).alias("side"))
    far_side = pairs.filter(~same | (F.col("b1") != F.col("b0"))).select(
        *cell, F.col("b1").alias("block"), "tile", F.lit(1).alias("side"))
    return rows.join(near_side.union(far_side), [*cell, "block"])


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label", near: Near = Near()) -> DataFrame:
    """One row per vector: its links, its component's smallest id, whether it is that one.

    Vectors link when their labels are equal and their cosine, in double precision, is at
    least ``near.cosine``. Equal vectors count once, with the number of their copies, so
    they cost no comparisons. Others meet in tiles of two blocks; a tile returns a count
    for each vector and a tree of links, never its pairs.

    Defined results: a null label, and a vector that is null, empty, all zero or holds a
    null, NaN or infinite value, links with nothing and is its own component. So does a row
    with a null id, whose component is null and which is not kept. Vectors of different
    lengths never link. Repeated rows are other vectors and count as links; rows that share
    an id are one node. Other columns are ignored.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), F.col(label_col).alias("label"))
    able = rows.filter(_valid(F.col("vector")) & F.col("label").isNotNull() & F.col("id").isNotNull())
    classes = stored(
        able.groupBy("label", "vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("dim", F.size("vector"))
    )
    bases = _bases(classes, near)
    found = stored(
        _tiles(classes, bases, near).select("tile", "id", "copies", "side", "vector")
        .repartition(F.xxhash64("tile")).sortWithinPartitions("tile")
        .mapInArrow(_tile_work(bases, near), "id long, linked long, other long")
    )
    linked = found.groupBy("id").agg(F.sum("linked").alias("linked"))
    label = components(found.select(F.col("id").alias("a"), F.col("other").alias("b")))
    named = (
        classes.join(linked, "id", "left").join(label, F.col("id") == F.col("node"), "left")
        .select(F.col("label").alias("l"), F.col("vector").alias("v"),
                (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n"),
                F.coalesce("component", "id").alias("c"))
    )
    component = F.coalesce("c", "id")
    return rows.join(named, (F.col("label") == F.col("l")) & (F.col("vector") == F.col("v")) & F.col("id").isNotNull(), "left").select(
        F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
