"""Embedding near-duplicates by cross-polytope hashing.

A hash rotates the unit vector at random (three rounds of random signs and a fast Hadamard transform) and takes the vertex of the
cross-polytope, one of the signed axes, that is nearest. A table's key joins two such hashes. Every vector is indexed under its
key and probes the keys made of the nearest vertices of both hashes; vectors that meet are candidates if the sign
bits of their rotations are near enough, and pairs if the cosine in double precision reaches the threshold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import materialise, narrow
from .components import components


@dataclass(frozen=True)
class Settings:
    tables: int = 8
    probes: int = 3  # nearest vertices of each hash; a table is probed at all combinations whose places add up to less
    min_cosine: float = 0.9
    seed: int = 17
    # standard deviations that the number of differing sign bits may lie above its mean at the threshold
    slack: float = 5.5


SKETCH_WORDS = 3  # 64-bit words of sign bits


def matrices(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and double matrix of the usable vectors, by length: not null, finite in every component, not zero."""
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    offsets = column.offsets.to_numpy()
    sizes = np.diff(offsets)
    sizes[column.is_null().to_numpy(zero_copy_only=False)] = 0
    for size in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == size)
        matrix = values[offsets[rows][:, None] + np.arange(size)]
        good = np.isfinite(matrix).all(axis=1) & (matrix != 0).any(axis=1)
        yield rows[good], matrix[good]


def unit(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; first by their largest component, so that squares neither overflow nor vanish."""
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, whose length is a power of two, scaled to keep lengths."""
    n, d = x.shape
    step = 1
    while step < d:
        x = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        step *= 2
    return x.reshape(n, d) / math.sqrt(d)


def rotate(x: np.ndarray, seed: int, number: int) -> np.ndarray:
    """Rotation ``number``; vectors whose length is no power of two are padded with zeros."""
    d = max(2, 1 << (x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, d - x.shape[1])))
    rng = np.random.default_rng((seed, number, d))
    for _ in range(3):
        x = hadamard(x * rng.choice((-1.0, 1.0), d))
    return x


def vertices(x: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest vertices of each row, nearest first: twice the axis, plus one on its negative side."""
    n = min(n, x.shape[1])
    size = np.abs(x)
    axes = np.argpartition(-size, n - 1, axis=1)[:, :n]
    axes = np.take_along_axis(axes, np.argsort(-np.take_along_axis(size, axes, 1), axis=1, kind="stable"), 1)
    return axes * 2 + (np.take_along_axis(x, axes, 1) < 0)


def sketch(x: np.ndarray, seed: int) -> np.ndarray:
    """Sign bits of random directions, as (rows, SKETCH_WORDS) signed words."""
    rng = np.random.default_rng((seed, 1 << 20, x.shape[1]))
    bits = x @ rng.standard_normal((x.shape[1], 64 * SKETCH_WORDS)) > 0
    return np.packbits(bits, axis=1).view("<i8")


def keys(x: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Index keys (rows, tables) and probe keys (rows, tables, combinations) of unit vectors of one length."""
    index, probe = [], []
    for table in range(settings.tables):
        a, b = (vertices(rotate(x, settings.seed, 2 * table + k), settings.probes) for k in (0, 1))
        pairs = [(i, j) for i in range(a.shape[1]) for j in range(b.shape[1]) if i + j < settings.probes]
        head = (table << 52) | (x.shape[1] << 36)
        join = lambda i, j: head | a[:, i].astype(np.int64) << 18 | b[:, j]  # noqa: B023, E731
        index.append(join(0, 0))
        probe.append(np.stack([join(i, j) for i, j in pairs], axis=1))
    return np.stack(index, axis=1), np.stack(probe, axis=1)


def _classes(vectors: DataFrame) -> DataFrame:
    """Columns ``vec``, ``node``, ``v``: 128-bit identity of the vector's values and the values; both null if it links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, values = [None] * batch.num_rows, [None] * batch.num_rows
            for rows, matrix in matrices(batch.column(1)):
                for row, one in zip(rows.tolist(), matrix + 0.0, strict=True):  # + 0.0: minus zero is zero
                    values[row] = one.tobytes()
                    nodes[row] = xxhash.xxh3_128_digest(values[row])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes, pa.binary()), pa.array(values, pa.binary())], names=["vec", "node", "v"])

    kind = vectors.schema[0].dataType.simpleString()
    return vectors.mapInArrow(run, f"vec {kind}, node binary, v binary")


def _matrices_of(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and unit vectors of a batch of (node, v), by length."""
    raw = batch.column(1).to_pylist()
    sizes = np.array([len(r) for r in raw])
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        yield rows, unit(np.frombuffer(b"".join(raw[r] for r in rows), np.float64).reshape(len(rows), -1))


def pairs(classes: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Pairs ``a`` < ``b`` of classes (columns ``node``, ``v``) whose cosine reaches the threshold."""
    turn = math.acos(settings.min_cosine) / math.pi
    n_bits = 64 * SKETCH_WORDS
    most = math.ceil(n_bits * turn + settings.slack * math.sqrt(n_bits * turn * (1 - turn)))

    def keyed(side: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for start in range(0, whole.num_rows, 1024):
                    batch = whole.slice(start, 1024)
                    for rows, x in _matrices_of(batch):
                        found = keys(x, settings)[side].reshape(len(rows), -1)
                        at = np.repeat(np.arange(len(rows)), found.shape[1])
                        bits = sketch(x, settings.seed)[at]
                        nodes = batch.column(0).take(pa.array(rows[at]))
                        yield pa.RecordBatch.from_arrays([pa.array(found.ravel()), nodes, *(pa.array(bits[:, k].copy()) for k in range(SKETCH_WORDS))], names=["key", "node", "s0", "s1", "s2"])

        return classes.select("node", "v").mapInArrow(run, "key long, node binary, s0 long, s1 long, s2 long")

    i, p = keyed(0).alias("i"), keyed(1).alias("p")
    apart = sum((F.bit_count(F.col(f"i.s{k}").bitwiseXOR(F.col(f"p.s{k}"))) for k in range(SKETCH_WORDS)), F.lit(0))
    met = i.join(p, (F.col("i.key") == F.col("p.key")) & (F.col("i.node") != F.col("p.node")) & (apart <= most))
    met = met.select(F.least("i.node", "p.node").alias("a"), F.greatest("i.node", "p.node").alias("b")).distinct()
    met = materialise(met, "candidates")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                batch = whole.slice(start, 4096)
                keep = np.zeros(batch.num_rows, bool)
                left, right = (batch.column(k).to_pylist() for k in (2, 3))
                sizes = np.array([len(r) for r in left])
                for size in np.unique(sizes).tolist():
                    rows = np.flatnonzero(sizes == size)
                    x, y = (unit(np.frombuffer(b"".join(side[r] for r in rows), np.float64).reshape(len(rows), -1)) for side in (left, right))
                    keep[rows] = (x * y).sum(axis=1) >= settings.min_cosine
                yield batch.filter(pa.array(keep)).select(["a", "b"])

    va, vb = (classes.select(F.col("node").alias(k), F.col("v").alias(f"v{k}")) for k in ("a", "b"))
    both = met.join(va, "a").join(vb, "b").select("a", "b", "va", "vb")
    return both.mapInArrow(verify, "a binary, b binary")


def near_duplicates(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """Per row ``id_column``, ``n_links`` (other rows with a cosine at or above the threshold) and ``component_id``.

    Rows with equal values form a class that is hashed and compared once; its members link with each other. Vectors that are null,
    empty, zero or hold null or non-finite components link with nothing and are their own component; so do vectors of
    different lengths with each other. Rows that repeat an id count as vectors of their own. Rows without an id take
    no part: no links, no component. An empty table gives no rows.
    """
    rows = vectors.select(F.col(id_column), F.col(vector_column).cast("array<double>"))
    rows = materialise(_classes(rows), "vectors")
    named = rows.where("node is not null and vec is not null")
    classes = named.groupBy("node").agg(F.min("vec").alias("least"), F.count("*").alias("n"), F.first("v").alias("v"))
    classes = materialise(classes, "classes")
    found = materialise(pairs(classes, settings), "links")
    ends = found.union(found.select("b", "a")).toDF("node", "other")
    sizes = classes.select(F.col("node").alias("other"), F.col("n").alias("m"))
    links = materialise(ends.join(sizes, "other").groupBy("node").agg(F.sum("m").alias("m")), "degrees")
    roots = components(found, "a", "b").withColumnRenamed("node", "at")
    rooted = classes.join(roots, classes["node"] == roots["at"], "left").join(links, "node", "left")
    rooted = materialise(rooted.select("node", "least", "n", "m", F.coalesce("root", "node").alias("root")), "rooted")
    least = materialise(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    by_class = rooted.join(least, "root").select("node", (F.col("n") - 1 + F.coalesce("m", F.lit(0))).alias("n_links"), "component_id")
    by_class = materialise(by_class, "named")
    known = rows.select("vec", F.when(F.col("vec").isNotNull(), F.col("node")).alias("node")).join(by_class, "node", "left")
    return known.select(
        F.col("vec").alias(id_column),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec").alias("component_id"),
    )
