"""Vectors in blocks: queries and candidates meet block by block in cells of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keystitch.sources.tables import stage

QUERY_ROWS, CANDIDATE_ROWS = 512, 4096
#: Candidate blocks that one cell holds at a time.
CELL_BLOCKS = 8
_PACKED = "block int, n int, dim int, ids binary, kind string, matrix binary"


def usable(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", zero: bool = True) -> DataFrame:
    """`id` and its vector `v` as doubles, under a row number `vec_id` that rises with the id; it is what the searches
    go by, and `named` puts the ids back. Rows without an id, and vectors that are null, empty or hold null or
    non-finite components, take no part, nor do zero vectors without `zero`. Every other row counts by itself, also
    where its id or all of it is repeated: a copy of a query's row is a candidate."""
    v = F.col("v")
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)).where(finite)
    if not zero:
        rows = rows.where(F.exists(v, lambda x: x != 0))
    # ranges of id and vector, so that the rows of one id need not meet in one task
    ranged = rows.withColumnRenamed("vec_id", "id").repartitionByRange("id", F.xxhash64("v")).sortWithinPartitions("id")
    return stage(ranged.select(F.monotonically_increasing_id().alias("vec_id"), "id", "v"), "vectors")


def named(found: DataFrame, rows: DataFrame) -> DataFrame:
    """`found` (query_id, rank, vec_id, score) with the ids of the rows instead of their numbers."""
    query = rows.select(F.col("vec_id").alias("query_id"), F.col("id").alias("_query"))
    other = rows.select("vec_id", F.col("id").alias("_other"))
    both = found.join(query, "query_id").join(other, "vec_id")
    return both.select(F.col("_query").alias("query_id"), "rank", F.col("_other").alias("vec_id"), "score")


def _matrix(vectors: pd.Series) -> np.ndarray:
    """Rows of the largest length; shorter vectors are filled up with zeros, which leaves inner products as they are."""
    width = max(map(len, vectors))
    out = np.zeros((len(vectors), width))
    for i, x in enumerate(vectors):
        out[i, : len(x)] = x
    return out


def _narrow(matrix: np.ndarray) -> np.ndarray:
    """The first of a few types that holds all values exactly."""
    with np.errstate(all="ignore"):
        return next((m for t in ("i1", "i2", "f4") if np.array_equal(m := matrix.astype(t), matrix)), matrix)


def blocks(vectors: DataFrame, rows: int, extra: str | None = None) -> tuple[DataFrame, int]:
    """`vectors` (vec_id, v) dealt by a hash of the id into blocks of about `rows`, each packed into one row, and the
    number of blocks. `extra` names a column of doubles arrays of one length that is packed beside them."""
    number = max(1, -(-vectors.count() // rows))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        m = _narrow(_matrix(pdf["v"]))
        row = [int(pdf["block"].iloc[0]), *m.shape, pdf["vec_id"].to_numpy("<i8").tobytes(), m.dtype.str, m.tobytes()]
        if extra:
            row.append(np.stack(list(pdf[extra])).astype("f8").tobytes())
        return pd.DataFrame([row], columns=[*_NAMES, *([extra] if extra else [])])

    schema = _PACKED + (f", {extra} binary" if extra else "")
    numbered = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(number)).cast("int"))
    return numbered.groupBy("block").applyInPandas(pack, schema), number


_NAMES = [part.split()[0] for part in _PACKED.split(", ")]


def unpack(row) -> tuple[np.ndarray, np.ndarray]:
    """Ids and matrix of a packed block."""
    return np.frombuffer(row.ids, "<i8"), np.frombuffer(row.matrix, row.kind).reshape(row.n, row.dim)


def products(queries: np.ndarray, candidates: np.ndarray, whole: bool = False) -> np.ndarray:
    """Inner products of all rows. With `whole` the values are integers, whose products below 2^53 are exact."""
    width = min(queries.shape[1], candidates.shape[1])
    a, b = queries[:, :width], candidates[:, :width]
    if whole:
        bound = np.abs(a).max(initial=0) * float(np.abs(b).max(initial=0)) * width
        if bound < 2**24:
            return (a.astype("f4") @ b.astype("f4").T).astype("i4")
        if 2**53 <= bound < 2**62:
            return a.astype("i8") @ b.astype("i8").T
        return np.clip(a.astype("f8") @ b.astype("f8").T, -(2.0**62), 2.0**62).astype("i8")
    return a.astype("f8") @ b.astype("f8").T


def meet(
    queries: DataFrame,
    query_blocks: int,
    candidates: DataFrame,
    candidate_blocks: int,
    work: Callable[[object, Iterator[object]], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """`work(query block, candidate blocks)` for each cell of the grid of query blocks and groups of candidate blocks.

    Each candidate block goes once to every query block; a cell holds one query block and about CELL_BLOCKS
    candidate blocks, so its memory is bounded, and the cells are spread over all tasks.
    """
    slots = max(1, -(-candidate_blocks // CELL_BLOCKS))

    def each(number: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(number - 1)))

    left = queries.withColumnRenamed("block", "q").withColumn("slot", each(slots))
    right = candidates.withColumn("slot", F.col("block") % slots).withColumn("q", each(query_blocks))

    def cell(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if len(q) == 0 or len(c) == 0:
            return pd.DataFrame({name.split()[0]: [] for name in schema.split(", ")})
        return work(next(q.itertuples()), c.sort_values("block").itertuples())

    return left.groupBy("q", "slot").cogroup(right.groupBy("q", "slot")).applyInPandas(cell, schema)


def staged_blocks(vectors: DataFrame, rows: int, name: str) -> tuple[DataFrame, int]:
    packed, number = blocks(vectors, rows)
    return stage(packed, name), number
