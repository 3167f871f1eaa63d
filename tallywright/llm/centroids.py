"""Centroid clustering of integer vectors: ball trees of each partition give whole balls to a centroid where the triangle inequality allows it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Vectors of a tree and of a leaf at most.
TREE, LEAF = 4096, 32
#: Greatest magnitude of a component: squared distances of 64 components then fit a long. Below EXACT double products are exact.
MOST, EXACT = 1 << 27, 1 << 22
NODES = "vectors binary, sums binary, radii binary"


def quantized(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, as longs."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def usable(vector: Column, dims: int) -> Column:
    """Exactly dims components, none null, NaN or infinite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(vector) == dims) & finite, F.lit(False))


def edges(n: int, level: int) -> np.ndarray:
    """Where the balls of a level start, and n: ball i is split into balls 2i and 2i + 1."""
    return np.arange((1 << level) + 1) * n >> level


def depth(n: int) -> int:
    return max(0, -(-n // LEAF) - 1).bit_length()


@dataclass
class Tree:
    """Vectors in the order of the leaves; for each ball, level by level, the integer sum of its vectors and its radius."""

    vectors: np.ndarray
    sums: np.ndarray
    radii: np.ndarray

    @staticmethod
    def grown(vectors: np.ndarray) -> tuple[Tree, np.ndarray]:
        """A tree of the rows and their order in it. Balls are halved by place along the line between two far members, so
        copies and ties cannot make it deep."""
        n, order, floats = len(vectors), np.arange(len(vectors)), vectors.astype(np.float64)
        for level in range(depth(n)):
            starts, halves = edges(n, level), edges(n, level + 1)
            for i in range(1 << level):
                part = order[starts[i] : starts[i + 1]]
                points = floats[part]
                far = points[((points - points.mean(axis=0)) ** 2).sum(axis=1).argmax()]
                other = points[((points - far) ** 2).sum(axis=1).argmax()]
                along = (points - far) @ (other - far)
                order[starts[i] : starts[i + 1]] = part[np.argpartition(along, halves[2 * i + 1] - starts[i])]
        vectors, floats = vectors[order], floats[order]
        sums, radii = [], []
        for level in range(depth(n) + 1):
            starts = edges(n, level)
            counts = np.diff(starts)
            sums.append(np.add.reduceat(vectors.astype(np.int64), starts[:-1]))
            centers = np.repeat(sums[-1] / counts[:, None], counts, axis=0)
            radii.append(np.sqrt(np.maximum.reduceat(((floats - centers) ** 2).sum(axis=1), starts[:-1])))
        return Tree(vectors, np.concatenate(sums), np.concatenate(radii)), order

    def packed(self) -> tuple[bytes, bytes, bytes]:
        return self.vectors.astype("<i4").tobytes(), self.sums.astype("<i8").tobytes(), self.radii.astype("<f8").tobytes()

    @staticmethod
    def unpacked(vectors: bytes, sums: bytes, radii: bytes, dims: int) -> Tree:
        return Tree(np.frombuffer(vectors, "<i4").reshape(-1, dims), np.frombuffer(sums, "<i8").reshape(-1, dims), np.frombuffer(radii, "<f8"))

    def assigned(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(the nearest centroid of each vector, vectors of each centroid, their sums, balls given whole).

        A centroid is out for a ball if even its nearest possible member is farther from it than the farthest possible
        member is from another; the slack is well above the rounding of doubles, so ties are left to the leaves, where
        distances are integers and the smaller number wins.
        """
        n, k = len(self.vectors), len(centroids)
        labels, counts, sums = np.empty(n, np.int64), np.zeros(k, np.int64), np.zeros((k, centroids.shape[1]), np.int64)
        balls, near, whole = np.zeros(1, np.int64), np.ones((1, k), bool), 0
        for level in range(depth(n) + 1):
            starts, first = edges(n, level), (1 << level) - 1
            size = (starts[balls + 1] - starts[balls])[:, None]
            centers, radii = self.sums[first + balls] / size, self.radii[first + balls][:, None]
            away = np.sqrt(((centers[:, None, :] - centroids) ** 2).sum(axis=2))
            reach = np.where(near, away, np.inf).min(axis=1, keepdims=True) + radii
            near &= away - radii <= reach + 1e-6 * (1 + reach)
            alone = near.sum(axis=1) == 1
            for ball, c in zip(balls[alone].tolist(), near[alone].argmax(axis=1).tolist()):
                labels[starts[ball] : starts[ball + 1]] = c
                counts[c] += starts[ball + 1] - starts[ball]
                sums[c] += self.sums[first + ball]
                whole += 1
            balls, near = balls[~alone], near[~alone]
            if level < depth(n):
                balls, near = (2 * balls[:, None] + [0, 1]).ravel(), np.repeat(near, 2, axis=0)
        if len(balls):
            sizes = starts[balls + 1] - starts[balls]
            rows = np.repeat(starts[balls] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            left = self.vectors[rows].astype(np.int64)
            apart = np.where(np.repeat(near, sizes, axis=0), squared(left, centroids), np.iinfo(np.int64).max)
            labels[rows] = found = apart.argmin(axis=1)
            counts += np.bincount(found, minlength=k)
            for c in range(k):
                sums[c] += left[found == c].sum(axis=0)
        return labels, counts, sums, whole


def squared(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, one column a centroid."""
    if max(np.abs(vectors).max(initial=0), np.abs(centroids).max(initial=0)) <= EXACT:
        x, c = vectors.astype(np.float64), centroids.astype(np.float64)
        return ((x**2).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c**2).sum(axis=1)).astype(np.int64)
    return np.stack([((vectors - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def grow(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    """Batches of (id, q) -> rows of (ids, NODES), a tree each."""
    for batch in batches:
        for start in range(0, len(batch), TREE):
            part = batch.slice(start, TREE)
            vectors = part.column(1).flatten().to_numpy().reshape(-1, dims)
            if np.abs(vectors).max() > MOST:
                raise ValueError(f"a component is over {MOST} after scaling: squared distances would not fit a long")
            tree, order = Tree.grown(vectors)
            ids = part.column(0).take(pa.array(order))
            lists = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            yield pa.RecordBatch.from_arrays([lists, *(pa.array([x], pa.binary()) for x in tree.packed())], ["ids", "vectors", "sums", "radii"])


def trees_of(batch: pa.RecordBatch, dims: int) -> Iterator[Tree]:
    for row in range(len(batch)):
        yield Tree.unpacked(*(batch.column(c)[row].as_py() for c in ("vectors", "sums", "radii")), dims)


def add_up(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row a centroid for the whole task: (cluster, n, sums, whole)."""
    k, dims = centroids.shape
    counts, sums, balls = np.zeros(k, np.int64), np.zeros((k, dims), np.int64), 0
    for batch in batches:
        for tree in trees_of(batch, dims):
            _, n, s, whole = tree.assigned(centroids)
            counts, sums, balls = counts + n, sums + s, balls + whole
    yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(counts), pa.array(sums.tolist(), pa.list_(pa.int64())), pa.array([balls] + [0] * (k - 1))], ["cluster", "n", "sums", "whole"])


def read_off(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(id, cluster, distance) of each vector."""
    for batch in batches:
        ids = batch.column("ids")
        for row, tree in enumerate(trees_of(batch, centroids.shape[1])):
            labels = tree.assigned(centroids)[0]
            apart = ((tree.vectors.astype(np.int64) - centroids[labels]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays([ids[row].values, pa.array(labels.astype(np.int32)), pa.array(apart)], ["id", "cluster", "distance"])


def next_centroids(trees: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floor of the mean of each centroid's vectors; one without vectors stays. Tasks hand over one row a centroid."""
    said = trees.mapInArrow(partial(add_up, centroids=centroids), "cluster int, n bigint, sums array<bigint>, whole bigint")
    sums = said.select("cluster", "n", F.posexplode("sums").alias("dim", "s")).groupBy("cluster", "dim")
    moved = centroids.copy()
    for row in sums.agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():  # centroids x components
        if row["n"]:
            moved[row["cluster"], row["dim"]] = int(row["s"]) // row["n"]
    return moved


def cluster(
    vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding", salt: str = "3:"
) -> tuple[DataFrame, np.ndarray]:
    """((id, cluster, distance), final centroids), one row for each usable row of vectors.

    Kept are vectors of exactly `dims` components, none null or non-finite, as integers floor(scale * x). Centroids start as the k
    vectors with the least sha256 of salt and id (then of least components; null ids last; fewer vectors give fewer centroids).
    Each round gives every vector to its nearest centroid (ties: the smaller number) and moves each centroid to the floor of its
    vectors' mean, exactly; an empty one stays. Vectors are assigned once more at the end.

    Trees are built once, from the rows a task happens to hold, and written; the result does not depend on how rows are dealt. A
    round reads them, gives whole balls away where it can, and hands over k sums a task. Copies are balls of radius 0. Rows that
    repeat an id are vectors of their own. Components over 2 ** 27 after scaling are an error, as distances must fit a long.
    Empty tables, or no usable vector, give no row. Other columns take no part.
    """
    spark = vectors.sparkSession
    kept = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).filter(usable(F.col("v"), dims)).select("id", quantized(F.col("v"), scale).alias("q"))
    id_type = kept.schema["id"].dataType.simpleString()
    trees = materialize(kept.mapInArrow(partial(grow, dims=dims), f"ids array<{id_type}>, {NODES}"), "balls")
    first = kept.orderBy(F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256).asc_nulls_last(), "q").limit(k).collect()  # k rows
    centroids = np.array([row["q"] for row in first], np.int64).reshape(-1, dims)
    if not len(centroids):
        return spark.createDataFrame([], f"id {id_type}, cluster int, distance bigint"), centroids
    for _ in range(rounds):
        centroids = next_centroids(trees, centroids)
    return trees.mapInArrow(partial(read_off, centroids=centroids), f"id {id_type}, cluster int, distance bigint"), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """cluster()'s result with the distances summed over each cluster and over all, and the digest of each final centroid."""
    spark = assigned.sparkSession
    assigned = materialize(assigned, "assigned")
    digests = [(c, ",".join(map(str, row))) for c, row in enumerate(centroids.tolist())]
    named = spark.createDataFrame(digests, "cluster int, components string").withColumn("centroid_sha256", F.sha2("components", 256))
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    everything = assigned.agg(F.sum("distance").alias("inertia")).first()["inertia"]
    known = named.drop("components").join(sums, "cluster")  # a row a centroid
    return assigned.join(F.broadcast(known), "cluster").withColumn("inertia", F.lit(everything).cast("bigint"))
