"""Exact top-k by inner product of integer vectors, by distributed histogram selection.

Every query is scored against every candidate. A first pass counts the scores in coarse bins, each further pass
splits the bin that holds the k-th best score of a query, until a bin is one score wide. The last pass keeps what
lies above that score, and of the scores equal to it the smallest ids. No pass sorts scores or sends more of them
than k a query and cell: below the k-th best score of its own candidates, a cell counts nothing.

Defined cases: see `vectors.usable` for rows that take no part. With fewer candidates than k a query gets all of
them; an empty table gives an empty result. Products of 2^53 and more are kept up to 2^62.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keystitch.llm import vectors
from keystitch.sources.tables import stage

BINS = 256
_TALL = 2.0**62


def _scores(q, c) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the candidates, scores, and which of them are no candidates: those of the query itself."""
    query_ids, a = vectors.unpack(q)
    ids, b = vectors.unpack(c)
    return ids, vectors.products(a, b, whole=True), query_ids[:, None] == ids[None, :]


def _count(q, cells, bins: int) -> pd.DataFrame:
    """Counts a query and bin over the blocks of a cell. state of a query: low end, width of a bin, how many wanted."""
    query_ids = np.frombuffer(q.ids, "<i8")
    low, width, wanted = np.frombuffer(q.state).reshape(len(query_ids), 3).T.astype("i8")
    counts = np.zeros((len(query_ids), bins + 1), np.int64)
    for c in cells:
        _, score, own = _scores(q, c)
        place = (score - low[:, None]) // width[:, None]
        place[(place < 0) | (place >= bins) | own] = bins
        place += (bins + 1) * np.arange(len(query_ids))[:, None]
        counts += np.bincount(place.ravel(), minlength=counts.size).reshape(counts.shape)
    counts = counts[:, :bins]
    above = counts[:, ::-1].cumsum(1)[:, ::-1] - counts
    rows, at = np.nonzero((counts > 0) & (above < wanted[:, None]))
    return pd.DataFrame({"vec_id": query_ids[rows], "bin": at.astype("i4"), "n": counts[rows, at]})


def _keep(q, cells) -> pd.DataFrame:
    """Scores above the threshold of a query, and of those equal to it the wanted number of smallest ids."""
    query_ids = np.frombuffer(q.ids, "<i8")
    least, _, wanted = np.frombuffer(q.state).reshape(len(query_ids), 3).T.astype("i8")
    found = [(np.zeros(0, "i8"),) * 3]
    for c in cells:
        ids, score, own = _scores(q, c)
        order = np.argsort(ids, kind="stable")
        ids, score, own = ids[order], score[:, order], own[:, order]
        equal = (score == least[:, None]) & ~own
        keep = (score > least[:, None]) & ~own | equal & (equal.cumsum(1) <= wanted[:, None])
        rows, columns = np.nonzero(keep)
        found.append((query_ids[rows], ids[columns], score[rows, columns].astype("i8")))
    return pd.DataFrame({k: np.concatenate(x) for k, x in zip(("query_id", "vec_id", "score"), zip(*found, strict=True), strict=True)})


def top_k(codes: DataFrame, is_query: Column, k: int) -> DataFrame:
    """query_id, rank, vec_id and score of the `k` best candidates of each query, ties to the smaller id.

    `codes` has vec_id, a different one in each row, and the vector `v` of whole numbers; `is_query` chooses the queries.
    """
    codes = stage(codes, "topk-codes")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    bound = min(_TALL, (codes.agg(F.max(square)).first()[0] or 0.0))
    candidates, candidate_blocks = vectors.staged_blocks(codes.select("vec_id", "v"), vectors.CANDIDATE_ROWS, "topk-candidates")
    queries = codes.where(is_query).select("vec_id", "v")
    # no score lies outside -bound .. bound
    span = 2 * int(bound) + 1
    width = -(-span // BINS)
    state = F.array(F.lit(-float(int(bound))), F.lit(float(width)), F.lit(float(k)))
    held = stage(queries.withColumn("state", state), "topk-state")
    while True:
        blocks, number = vectors.blocks(held, vectors.QUERY_ROWS, "state")
        meeting = (blocks, number, candidates, candidate_blocks)
        if width == 0:
            break
        counts = vectors.meet(*meeting, partial(_count, bins=-(-span // width)), "vec_id long, bin int, n long")
        summed = counts.groupBy("vec_id", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("vec_id").orderBy(F.desc("bin"))
        before = (F.sum("n").over(down) - F.col("n")).alias("before")
        wanted = F.col("state")[2]
        reached = held.join(summed.select("vec_id", "bin", before), "vec_id", "left").where(
            F.col("bin").isNull() | (F.col("before") < wanted)
        )
        # of the bins that are not above the k-th score the lowest holds it; with too few candidates, all do
        finer = -(-width // BINS) if width > 1 else 0
        at = F.struct(F.coalesce("bin", F.lit(0)).alias("bin"), F.coalesce("before", F.lit(0)).alias("before"))
        chosen = reached.groupBy("vec_id").agg(
            F.min(at).alias("at"), F.first("v").alias("v"), F.first("state").alias("state")
        )
        low = F.col("state")[0] + F.col("at.bin") * F.col("state")[1]
        state = F.array(low, F.lit(float(finer)), wanted - F.col("at.before"))
        held = stage(chosen.select("vec_id", "v", state.alias("state")), "topk-state")
        span, width = width, finer
    kept = vectors.meet(*meeting, _keep, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return kept.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def search(embeddings: DataFrame, k: int = 20, one_in: int = 20) -> DataFrame:
    """The `k` best integer scores of every vector whose id is divisible by `one_in`."""
    rows = vectors.usable(embeddings)
    codes = rows.select("vec_id", "id", F.transform("v", lambda x: F.floor(F.lit(64.0) * x).cast("double")).alias("v"))
    return vectors.named(top_k(codes, F.col("id") % one_in == 0, k), rows)


SEARCH_SQL = """
with ok as (
    select vec_id, embedding::double[] as e from embeddings
    where vec_id is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), code as materialized (
    select row_number() over () as place, vec_id, list_transform(e, lambda x: floor(64 * x)::double) as v from ok
), pair as (
    select q.place, q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
    from code q join code c on q.vec_id % 20 = 0 and c.place <> q.place
), ranked as (
    select *, row_number() over (partition by place order by score desc, vec_id) as rank from pair
)
select query_id, rank::integer as rank, vec_id, score from ranked where rank <= 20
"""
