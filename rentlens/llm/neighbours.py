"""Approximate nearest neighbours by collision-counting hashing over single-projection sorted arrays."""

from __future__ import annotations

import sys
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.llm.common import by_value

by_value(sys.modules[__name__])

K = 20
EVERY = 20          #: rows whose id is divisible by this are the queries
PROJECTIONS = 48
COLLISIONS = 0.56   #: share of the projections on which a vector must fall into the query's window
VERIFIED = 0.3      #: the windows widen until so large a part of a block, and MARGIN * k more, has reached the threshold
MARGIN = 20
WIDTH, RATIO = 0.8, 1.1  #: half window at the first radius, and its growth from one radius to the next
BLOCK = 8192        #: vectors of one sorted array, and queries of one task


class Index(NamedTuple):
    """Sorted projections of a block of vectors: for each projection the values in order and the rows they belong to."""

    values: np.ndarray
    rows: np.ndarray


def directions(size: int, count: int = PROJECTIONS, seed: int = 11) -> np.ndarray:
    """Random directions, orthogonal within each run of ``size`` of them, of length root of ``size``."""
    rng = np.random.default_rng(seed)
    runs = [np.linalg.qr(rng.normal(size=(size, size)))[0].T for _ in range(-(-count // size))]
    return np.concatenate(runs)[:count] * np.sqrt(size)


def build(vectors: np.ndarray, longest: float, axes: np.ndarray) -> Index:
    """Index a block. Vectors are scaled by the longest of all and get one more component that brings them to length one,
    so that the largest inner product is the smallest distance."""
    scaled = vectors / longest
    rest = np.sqrt(np.maximum(0, 1 - (scaled ** 2).sum(1)))
    placed = np.column_stack((scaled, rest)) @ axes.T
    rows = np.ascontiguousarray(np.argsort(placed, axis=0, kind="stable").T)
    return Index(np.take_along_axis(placed.T, rows, axis=1), rows)


def candidates(index: Index, queries: np.ndarray, axes: np.ndarray, k: int, collisions: float = COLLISIONS,
               verified: float = VERIFIED) -> list[np.ndarray]:
    """For each query the rows of a block that reach the collision threshold.

    The window around the query's place in each sorted array starts narrow and widens by ``RATIO`` (virtual
    rehashing); only what a round adds is counted. It ends when ``MARGIN * k`` and a share ``verified`` of the rows have reached
    the threshold, or when the windows hold everything.
    """
    n = index.rows.shape[1]
    wanted = min(n, MARGIN * k + int(verified * n))
    # by the largest component first, as squares of very small or large ones leave the range of doubles
    units = queries / np.abs(queries).max(axis=1, keepdims=True)
    units = units / np.linalg.norm(units, axis=1, keepdims=True)
    at = np.column_stack((units, np.zeros(len(units)))) @ axes.T
    need = max(1, int(np.ceil(collisions * len(axes))))
    low = np.column_stack([np.searchsorted(v, x) for v, x in zip(index.values, at.T)])
    high, counts, out = low.copy(), [0] * len(queries), [np.zeros(0, np.int64)] * len(queries)
    active, half = np.arange(len(queries)), WIDTH
    while len(active):
        ends = [np.column_stack([np.searchsorted(v, x + step, side) for v, x in zip(index.values, at[active].T)])
                for step, side in ((-half, "left"), (half, "right"))]
        still = []
        for i, new_low, new_high in zip(active.tolist(), *ends):
            added = [r[a:b] for r, a, b in zip(index.rows, new_low.tolist(), low[i].tolist())]
            added += [r[a:b] for r, a, b in zip(index.rows, high[i].tolist(), new_high.tolist())]
            counts[i] = counts[i] + np.bincount(np.concatenate(added), minlength=n)
            low[i], high[i] = new_low, new_high
            reached = np.flatnonzero(counts[i] >= need)
            if len(reached) >= wanted or (not new_low.any() and (new_high == n).all()):
                out[i], counts[i] = reached, 0
            else:
                still.append(i)
        active, half = np.array(still, np.int64), half * RATIO
    return out


def nearest(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, longest: float,
            k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the ids and exact inner products of its best ``k`` candidates in a block, best first."""
    axes = directions(vectors.shape[1] + 1)
    index = build(vectors, longest, axes)
    out = []
    groups = (candidates(index, queries[i:i + 256], axes, k) for i in range(0, len(queries), 256))
    for q, own, found in zip(queries, query_ids, chain.from_iterable(groups)):
        found = found[ids[found] != own]
        # einsum adds every row up in the same order, wherever it lies in the block
        score = np.einsum("ij,j->i", vectors[found], q)
        if len(found) > k:
            bound = -np.partition(-score, k - 1)[k - 1]
            keep = score >= bound
            found, score = found[keep], score[keep]
        best = np.lexsort((ids[found], -score))[:k]
        out.append((ids[found[best]], score[best]))
    return out


def usable(col: Column) -> Column:
    """Vectors that can be searched: not null, without null or non-finite components, and not all zero."""
    bad = F.exists(col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return col.isNotNull() & ~bad & F.exists(col, lambda x: x != 0)


def search(vectors: DataFrame, k: int = K, every: int = EVERY, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest found of every query.

    Queries are the rows whose vec_id is divisible by ``every``, candidates all rows but those with the query's own id.
    Rows are hashed into blocks of about ``block``. Each pair of a block of vectors and a block of queries is a task that
    indexes the vectors and keeps ``k`` candidates per query; these meet once more per query. The score is the inner
    product in double precision, ties go to the smaller id, and repeated ids are candidates of their own.

    Null, zero and non-finite vectors take no part, nor do rows with a null id; vectors of another length than a
    query's are not compared with it. Fewer than ``k`` candidates give them all; an empty table gives an empty result.
    """
    schema = "query_id long, vec_id long, score double"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull()).filter(usable(F.col("v"))).withColumn("size", F.size("v"))
    # lengths in units of the largest component, as its square may leave the range of doubles
    largest = F.array_max(F.transform("v", F.abs))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / F.col("largest")) * (x / F.col("largest")))
    stats = rows.withColumn("largest", largest).select(
        "size", (F.col("largest") * F.sqrt(square)).alias("length"),
        (F.col("vec_id") % every == 0).cast("long").alias("asked")).groupBy("size").agg(
        F.count(F.lit(1)).alias("n"), F.max("length").alias("longest"), F.sum("asked").alias("asked"))
    stats = stats.select("size", "longest", F.ceil(F.col("n") / block).alias("nv"),
                         F.greatest(F.lit(1), F.ceil(F.col("asked") / block)).alias("nq"))
    rows = rows.join(stats, "size")  # one row per length of vectors

    def block_of(count: str) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.col(count))

    def each(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    held = rows.withColumn("bv", block_of("nv")).withColumn("bq", each("nq"))
    asked = (rows.filter(F.col("vec_id") % every == 0).withColumn("bq", block_of("nq")).withColumn("bv", each("nv")))
    names = ["size", "bv", "bq", "vec_id", "v", "longest"]

    def matrix(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids = t.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        flat = t.column("v").combine_chunks().flatten().to_numpy()
        return flat.reshape(len(ids), -1)[order], ids[order]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, tuple]] = []
        if left.num_rows and right.num_rows:
            (v, ids), (q, query_ids) = matrix(left), matrix(right)
            found = list(zip(query_ids.tolist(), nearest(v, ids, q, query_ids, left.column("longest")[0].as_py(), k)))
        many = [len(f[0]) for _, f in found]
        empty = [np.zeros(0)]
        return pa.table({"query_id": pa.array(np.repeat([q for q, _ in found], many).astype(np.int64)),
                         "vec_id": pa.array(np.concatenate([f[0] for _, f in found] or empty).astype(np.int64)),
                         "score": pa.array(np.concatenate([f[1] for _, f in found] or empty).astype(float))})

    held = held.select(*[F.col(c).alias(c) for c in names]).groupBy("size", "bv", "bq")
    asked = asked.select(*[F.col(c).alias(c) for c in names]).groupBy("size", "bv", "bq")
    found = held.cogroup(asked).applyInArrow(run, schema)
    # the best k of each block meet per query, in an order that a sorted array gives: largest score, then smaller id
    best = found.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct(
        (-F.col("score")).alias("down"), "vec_id", "score"))), 1, k).alias("best"))
    return (best.select("query_id", F.posexplode("best").alias("place", "b"))
            .select("query_id", (F.col("place") + 1).cast("int").alias("rank"), "b.vec_id", "b.score"))
