"""Near duplicates of embeddings by tiled comparison in the order of principal axes.

Equal vectors of a label become one, with a number of copies. Unit vectors are rotated
to the principal axes of all vectors (a second moment per pair of components, summed on
Spark), so the first axes hold most of every product. Vectors are sorted by label and
their angle to the first axis and cut into tiles. Two tiles of a label meet only if their
ranges of angles come within the greatest angle of a link; that is exact, since angles on
the sphere obey the triangle inequality. Within a pair of tiles the leading axes are
multiplied first; what the remaining ones can add is bounded by the product of the norms
of the remainders, and pairs that cannot reach the threshold are left out, block by
block. What is left is compared by its cosine in double precision.

A pair of tiles is a task's unit of work, bounded by ``TILE``, whatever a label's size.
It reports per vector the number of links and one link of a spanning forest, never all
pairs.

Nulls and odd cases: vectors whose label is null, that are null, empty, zero or hold null
or non-finite components, link with nothing; vectors of different length do not link;
rows without vec_id or with a repeated one are vectors of their own; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..runtime import materialize
from .common import fields, record
from .components import components
from .unions import Unions

THRESHOLD = 0.93
TILE = 1024
#: axes after which pairs are dropped
STEPS = (8, 16, 32)
SLACK = 1e-9
CHUNK = 1 << 16

_TILES = fields(
    "group long, tile long, low double, high double, dim int, keys binary, copies binary, vectors binary"
)
_FOUND = fields("a long, b long, n long")


def _arrays(batch: pa.RecordBatch, name: str) -> list[np.ndarray]:
    return [np.asarray(v, float) for v in batch.column(name).to_pylist()]


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1, also where squares would overflow."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _axes(unique: DataFrame) -> dict[int, np.ndarray]:
    """Principal axes as columns, per length of vector, the strongest first."""
    schema = fields("dim int, i int, j int, s double")
    arrow = to_arrow_schema(schema)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            by_dim: dict[int, list] = {}
            for x in _arrays(batch, "vector"):
                by_dim.setdefault(len(x), []).append(x)
            for dim, x in by_dim.items():
                u = _unit(np.stack(x))
                sums[dim] = sums.get(dim, 0) + u.T @ u
        for dim, s in sums.items():
            i, j = np.indices(s.shape).reshape(2, -1)
            yield record([np.full(len(i), dim), i, j, s.ravel()], arrow)

    total = unique.select("vector").mapInArrow(moments, schema).groupBy("dim", "i", "j").agg(F.sum("s").alias("s"))
    matrices: dict[int, np.ndarray] = {}
    for dim, i, j, s in total.collect():  # as many rows as a vector has squared components
        matrices.setdefault(dim, np.zeros((dim, dim)))[i, j] = s
    return {dim: np.linalg.eigh((m + m.T) / 2)[1][:, ::-1] for dim, m in matrices.items()}


def _tiles(unique: DataFrame, axes) -> DataFrame:
    """Vectors in the order of their angles, packed."""
    angled = T.StructType([*unique.schema.fields, T.StructField("angle", T.DoubleType())])

    def angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(angled)
        for batch in batches:
            lead = [float(_unit(x[None])[0] @ axes.value[len(x)][:, 0]) for x in _arrays(batch, "vector")]
            angle = pa.array(np.arccos(np.clip(np.array(lead, float), -1, 1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, angle], schema=arrow)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(_TILES)
        part, number, rows = TaskContext.get().partitionId(), 0, []

        def tile():
            dim = len(rows[0][3])
            keys, copies = (np.array([r[c] for r in rows], "<i8").tobytes() for c in (1, 2))
            vectors = np.array([r[3] for r in rows], "<f8").tobytes()
            row = [rows[0][0], part << 32 | number, rows[0][4], rows[-1][4], dim, keys, copies, vectors]
            return record([[c] for c in row], arrow)

        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in ("group", "key", "copies", "vector", "angle"))):
                if rows and (len(rows) == TILE or rows[0][0] != row[0]):
                    yield tile()
                    number, rows = number + 1, []
                rows.append(row)
        if rows:
            yield tile()

    ordered = unique.mapInArrow(angles, angled).repartitionByRange("group", "angle", "key")
    return ordered.sortWithinPartitions("group", "angle", "key").mapInArrow(pack, _TILES)


def surviving_pairs(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rotated unit vectors whose product may reach ``threshold``."""
    dim = a.shape[1]
    steps = [*(s for s in STEPS if s < dim), dim]

    def remainder(x: np.ndarray, s: int) -> np.ndarray:
        return np.sqrt((x[:, s:] * x[:, s:]).sum(1))

    first = steps[0]
    partial = a[:, :first] @ b[:, :first].T
    i, j = np.nonzero(partial + np.outer(remainder(a, first), remainder(b, first)) >= threshold - SLACK)
    partial = partial[i, j]
    for last, step in zip(steps, steps[1:]):
        ra, rb = remainder(a, step), remainder(b, step)
        keep = np.zeros(len(i), bool)
        for at in range(0, len(i), CHUNK):
            p = slice(at, at + CHUNK)
            partial[p] += np.einsum("ij,ij->i", a[i[p], last:step], b[j[p], last:step])
            keep[p] = partial[p] + ra[i[p]] * rb[j[p]] >= threshold - SLACK
        i, j, partial = i[keep], j[keep], partial[keep]
    return i, j


def linked_pairs(x: np.ndarray, y: np.ndarray, axes: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of ``x`` and ``y`` with a cosine of ``threshold`` or more."""
    ux, uy = _unit(x), _unit(y)
    i, j = surviving_pairs(ux @ axes, uy @ axes, threshold)
    keep = np.zeros(len(i), bool)
    for at in range(0, len(i), CHUNK):
        p = slice(at, at + CHUNK)
        keep[p] = np.einsum("ij,ij->i", ux[i[p]], uy[j[p]]) >= threshold
    return i[keep], j[keep]


def _compare(pairs: DataFrame, axes, threshold: float) -> DataFrame:
    arrow = to_arrow_schema(_FOUND)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                same = row["tile"] == row["tile2"]
                x, y = (np.frombuffer(row[n], "<f8").reshape(-1, dim) for n in ("vectors", "vectors2"))
                keys = np.frombuffer(row["keys"] + (b"" if same else row["keys2"]), "<i8")
                copies = np.frombuffer(row["copies"] + (b"" if same else row["copies2"]), "<i8")
                i, j = linked_pairs(x, y, axes.value[dim], threshold)
                if same:
                    i, j = i[i < j], j[i < j]
                else:
                    j = j + len(x)
                if not len(i):
                    continue
                n = np.bincount(i, copies[j], len(keys)) + np.bincount(j, copies[i], len(keys))
                sets = Unions(len(keys))
                sets.join_all(zip(i.tolist(), j.tolist()))
                linked = np.flatnonzero(n)
                roots = keys[[sets.root(k) for k in linked.tolist()]]
                yield record([keys[linked], roots, n[linked].astype(np.int64)], arrow)

    return pairs.mapInArrow(compare, _FOUND)


def near_vectors(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Every row of (vec_id, embedding, label) with n_links, component_id and kept."""
    spark = rows.sparkSession
    picked = rows.select(
        F.col("vec_id").cast("long"), F.col("label"), F.col("embedding").cast("array<double>").alias("vector")
    )
    usable = (
        F.col("label").isNotNull()
        & F.col("vector").isNotNull()
        & ~F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
        & F.exists("vector", lambda v: v != 0)
    )
    usable = F.coalesce(usable, F.lit(False))
    group = F.xxhash64("label", F.size("vector")).alias("group")
    unique = (
        picked.filter(usable)
        .groupBy(group, "label", "vector")
        .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    )
    unique = materialize(unique.withColumn("key", F.monotonically_increasing_id()), "vectors")
    axes = spark.sparkContext.broadcast(_axes(unique))
    tiles = materialize(_tiles(unique.select("group", "key", "copies", "vector"), axes), "tiles")

    # pairs are found on the tiles' ranges alone, then their vectors are fetched
    widest = math.acos(threshold) + SLACK
    left, right = tiles.select("group", "tile", "low", "high"), tiles.select(
        "group", F.col("tile").alias("tile2"), F.col("low").alias("low2"), F.col("high").alias("high2")
    )
    near = (F.col("low2") - F.col("high") <= widest) & (F.col("low") - F.col("high2") <= widest)
    pairs = left.join(right, "group").filter((F.col("tile") <= F.col("tile2")) & near).select("tile", "tile2")
    blobs = ["keys", "copies", "vectors"]
    pairs = pairs.join(tiles.select("tile", "dim", *blobs), "tile").join(
        tiles.select(F.col("tile").alias("tile2"), *(F.col(b).alias(f"{b}2") for b in blobs)), "tile2"
    )
    found = materialize(_compare(pairs, axes, threshold), "near")

    links = found.groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("n"))
    sets = components(found.select("a", "b")).withColumnRenamed("node", "key")
    known = unique.join(links, "key", "left").join(sets, "key", "left")
    known = known.withColumn("component", F.coalesce("component", "key"))
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(least, "component").select(
        "group", "label", "vector", "component_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    met = picked.filter(usable).withColumn("group", group).join(known, ["group", "label", "vector"])
    alone = picked.filter(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    both = met.select("vec_id", "n_links", "component_id").unionByName(alone)
    return both.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
