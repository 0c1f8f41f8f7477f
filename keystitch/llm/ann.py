"""Approximate nearest neighbours by multi-index hashing of learned, rotated binary codes.

A rotation learned on a bounded sample turns each vector into a binary code: principal directions, turned until
the signs lie close to the values. A code is cut into substrings. If two codes differ in at most `radius` bits, one
of the m substrings differs in at most radius // m, so a query that opens the buckets of all substring values
within that distance meets every code within the radius. What lies within the radius is ranked by the inner product of the
original vectors, in double precision.

Defined cases: see `vectors.usable`; zero vectors take no part. A query that finds fewer than k within the radius
is searched again with a radius that takes in every code, so each query gets k neighbours or all candidates.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keystitch.llm import vectors
from keystitch.sources.tables import stage

#: The rotation, the mean and the radius are fitted on so many vectors, those with the smallest hash of their number.
SAMPLE, SAMPLE_QUERIES = 4096, 256
BITS, SUBSTRING = 64, 8
#: Share of the sample's true neighbours that the radius takes in.
WITHIN = 0.975
_ROUNDS = 30


@dataclass
class Coder:
    mean: np.ndarray
    rotation: np.ndarray
    radius: int

    def bits(self, matrix: np.ndarray) -> np.ndarray:
        width = min(matrix.shape[1], len(self.mean))
        centred = np.zeros((len(matrix), len(self.mean)))
        centred[:, :width] = matrix[:, :width]
        return (centred - self.mean) @ self.rotation > 0


def fit(sample: np.ndarray, k: int, seed: int = 0) -> Coder:
    """Mean, rotated principal directions, and the radius that holds WITHIN of the true neighbours in the sample."""
    mean = sample.mean(0)
    centred = sample - mean
    _, _, directions = np.linalg.svd(centred, full_matrices=False)
    directions = directions[:BITS].T
    low = centred @ directions
    turn, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(low.shape[1],) * 2))
    for _ in range(_ROUNDS):
        u, _, v = np.linalg.svd(np.where(low @ turn > 0, 1.0, -1.0).T @ low)
        turn = (u @ v).T
    coder = Coder(mean, directions @ turn, 0)
    codes = coder.bits(sample)
    some = np.arange(min(SAMPLE_QUERIES, len(sample)))
    score = sample[some] @ sample.T
    score[some, some] = -np.inf
    near = np.argsort(-score, axis=1)[:, : min(k, max(1, len(sample) - 1))]
    apart = (codes[some][:, None, :] != codes[near]).sum(2)
    coder.radius = int(np.quantile(apart, WITHIN, method="higher"))
    return coder


def _substrings(bits: np.ndarray) -> list[np.ndarray]:
    """Each row's substrings as numbers; the last one may be shorter."""
    cuts = [bits[:, i : i + SUBSTRING] for i in range(0, bits.shape[1], SUBSTRING)]
    return [c @ (1 << np.arange(c.shape[1])) for c in cuts]


def _within(q_bits: np.ndarray, c_bits: np.ndarray, radius: int) -> np.ndarray:
    """Which codes lie within the radius of which query, found through the buckets of their substrings."""
    q_parts, c_parts = _substrings(q_bits), _substrings(c_bits)
    near = np.bitwise_count(np.arange(256)[:, None] ^ np.arange(256)[None, :]) <= radius // len(q_parts)
    met = np.zeros((len(q_bits), len(c_bits)), bool)
    for a, b in zip(q_parts, c_parts, strict=True):
        bucket, member = np.unique(b, return_inverse=True)
        opened = near[a][:, bucket]
        met |= np.take(opened, member, axis=1)
    x, y = (np.where(bits, np.float32(1), np.float32(-1)) for bits in (q_bits, c_bits))
    return met & (x @ y.T >= x.shape[1] - 2 * radius)


def _best(q, cells, coder: Coder, radius: int, k: int) -> pd.DataFrame:
    query_ids, a = vectors.unpack(q)
    a, q_bits, held = a.astype("f8"), coder.bits(a), [[] for _ in query_ids]
    for c in cells:
        ids, b = vectors.unpack(c)
        score = vectors.products(a, b)
        score[~_within(q_bits, coder.bits(b), radius) | (query_ids[:, None] == ids[None, :])] = -np.inf
        width = min(a.shape[1], b.shape[1])
        b = b[:, :width].astype("f8")
        kth = np.partition(score, -k, axis=1)[:, -k] if score.shape[1] >= k else np.full(len(a), -np.inf)
        # a product of matrices may round equal rows differently: take a margin, and rank by one way to add up
        margin = 1e-12 * (1 + np.abs(a).sum(1) * np.abs(b).max(initial=0))
        for i in range(len(query_ids)):
            some = np.flatnonzero((score[i] >= kth[i] - margin[i]) & (score[i] > -np.inf))
            exact = (b[some] * a[i, :width]).sum(axis=1)
            first = np.lexsort((ids[some], -exact))[:k]
            held[i].append((ids[some][first], exact[first]))
    rows = []
    for query, parts in zip(query_ids, held, strict=True):
        ids, score = (np.concatenate(x) for x in zip(*parts, strict=True))
        first = np.lexsort((ids, -score))[:k]
        rows.append((np.full(len(first), query), ids[first], score[first]))
    return pd.DataFrame({n: np.concatenate(x) for n, x in zip(("query_id", "vec_id", "score"), zip(*rows, strict=True), strict=True)})


def nearest(points: DataFrame, is_query: Column, k: int) -> DataFrame:
    """query_id, rank, vec_id and score of up to `k` neighbours found for each query. `points`: see `vectors.usable`."""
    points = stage(points, "ann-points")
    sample = points.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toPandas()
    schema = "query_id long, vec_id long, score double"
    if len(sample) == 0:
        return points.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    coder = fit(vectors._matrix(sample["v"]), k)
    candidates, candidate_blocks = vectors.staged_blocks(points.select("vec_id", "v"), vectors.CANDIDATE_ROWS, "ann-codes")
    queries = points.where(is_query).select("vec_id", "v")

    def find(some: DataFrame, radius: int) -> DataFrame:
        blocks, number = vectors.blocks(some, vectors.QUERY_ROWS)
        return vectors.meet(
            blocks, number, candidates, candidate_blocks, lambda q, cells: _best(q, cells, coder, radius, k), schema
        )

    found = stage(find(queries, coder.radius), "ann-found")
    enough = found.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= k)
    short = stage(queries.join(enough, F.col("vec_id") == F.col("query_id"), "left_anti"), "ann-short")
    # a radius of m substrings, all bits wide, opens every bucket
    if short.limit(1).count():
        wide = find(short, coder.rotation.shape[1] * SUBSTRING)
        found = found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(wide)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def search(embeddings: DataFrame, k: int = 20, one_in: int = 20) -> DataFrame:
    """Up to `k` nearest neighbours of every vector whose id is divisible by `one_in`."""
    rows = vectors.usable(embeddings, zero=False)
    return vectors.named(nearest(rows, F.col("id") % one_in == 0, k), rows)
