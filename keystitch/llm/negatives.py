"""Hard negatives: for an anchor and each of its positives, the best rows of other labels that score close below.

Vectors become one-bit codes: a vector is rotated, the signs of its components are the code, and the length of the
vector along its code (norm times alignment) is stored beside it. What is left of the vector is rotated and coded
again, a few levels deep; the norm of the last remainder is stored too. The inner product with an anchor is estimated
level by level: popcounts of the code with bit planes of the rotated anchor give the product with the code. What the
code does not cover is orthogonal to it, so by Cauchy and Schwarz it adds no more than the norm of the remainder times
the norm of the anchor's own part beside the code. The interval this gives is certain, not likely. Pairs whose
interval misses what an anchor looks for are dropped after each level; all others get their integer score, and
only these scores decide.

Defined cases: rows without an id, label or vector, and those with a null or non-finite component, take no part. An
empty vector scores 0; shorter vectors are filled up with zeros. Every row counts by itself, also if its id or all of
it is repeated: a copy of the anchor's row is another row. Integer scores are exact up to 2^56.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keystitch.llm import vectors
from keystitch.sources.tables import stage

#: Codes of a vector; each level leaves some six tenths of the norm before it.
LEVELS = 4
#: Bits an anchor's rotated component is cut to.
PLANES = 8
ANCHOR_ROWS, CANDIDATE_ROWS = 512, 4096
#: Anchors compared with a block at a time.
ANCHORS_AT_ONCE = 128
#: Share of the product of both norms added to each side of an interval, for the rounding of doubles.
SLACK = 1e-9
_SCHEMA = "block int, n int, dim int, uids binary, ids binary, labels binary, kind string, matrix binary, codes binary, lengths binary, wanted binary"
_PACKED = [c.split()[0] for c in _SCHEMA.split(", ")]


@cache
def rotations(dim: int) -> list[np.ndarray]:
    """An orthonormal matrix for each level, the same in every task."""
    out = []
    for level in range(LEVELS):
        q, r = np.linalg.qr(np.random.default_rng(level).standard_normal((dim, dim)))
        out.append(q * np.sign(np.diag(r)))
    return out


def _bits(flags: np.ndarray) -> np.ndarray:
    """Rows of flags as rows of 64-bit words."""
    packed = np.packbits(flags, axis=1)
    words = np.zeros((len(flags), -(-flags.shape[1] // 64) * 8), np.uint8)
    words[:, : packed.shape[1]] = packed
    return words.view(np.uint64)


def encode(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (level, row, word) and lengths (level, row): along each code, and of the remainder after it."""
    dim, left = matrix.shape[1], matrix.astype("f8")
    codes, lengths = [], []
    for turn in rotations(dim):
        left = left @ turn
        sign = np.where(left >= 0, 1.0, -1.0) / np.sqrt(dim)
        along = (left * sign).sum(1)
        left = left - along[:, None] * sign
        codes.append(_bits(sign > 0))
        lengths.append(np.stack([along, np.sqrt((left * left).sum(1))]))
    return np.stack(codes), np.stack(lengths)


class Planes:
    """Anchors, rotated level by level and cut to bit planes; `error` bounds what the cut can change in a product."""

    def __init__(self, matrix: np.ndarray):
        self.dim, turned = matrix.shape[1], matrix.astype("f8")
        self.norm = np.sqrt((turned * turned).sum(1))
        self.low, self.step, self.total, self.error, self.planes = [], [], [], [], []
        for turn in rotations(self.dim):
            turned = turned @ turn
            low = turned.min(1)
            step = np.maximum((turned.max(1) - low) / ((1 << PLANES) - 1), 1e-300)
            number = np.rint((turned - low[:, None]) / step[:, None]).astype(np.int64)
            cut = low[:, None] + step[:, None] * number
            self.low.append(low)
            self.step.append(step)
            self.total.append(cut.sum(1))
            self.error.append(np.abs(turned - cut).sum(1) / np.sqrt(self.dim))
            self.planes.append([_bits(number >> b & 1 == 1) for b in range(PLANES)])

    def along(self, level: int, i: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Products of the anchors `i` with the unit vectors of the codes."""
        ones = np.bitwise_count(codes).sum(1, dtype=np.int64)
        number = np.zeros(len(i), np.int64)
        for b, plane in enumerate(self.planes[level]):
            number += np.bitwise_count(plane[i] & codes).sum(1, dtype=np.int64) << b
        positive = self.low[level][i] * ones + self.step[level][i] * number
        return (2 * positive - self.total[level][i]) / np.sqrt(self.dim)


def intervals(planes: Planes, codes: np.ndarray, lengths: np.ndarray, i: np.ndarray, j: np.ndarray) -> Iterator:
    """After each level the lower and upper bounds of the products of anchors `i` and vectors `j`; sent back is which
    of the pairs go on."""
    estimate, doubt = np.zeros(len(i)), np.zeros(len(i))
    norm = np.sqrt((lengths[0] ** 2).sum(0))
    low, high = np.full(len(i), -np.inf), np.full(len(i), np.inf)
    for level in range(len(codes)):
        along, rest = lengths[level][:, j]
        t, error = planes.along(level, i, codes[level][j]), planes.error[level][i]
        estimate = estimate + along * t
        doubt = doubt + along * error
        beside = np.sqrt(np.maximum(planes.norm[i] ** 2 - np.maximum(np.abs(t) - error, 0) ** 2, 0))
        reach = doubt + rest * beside + SLACK * planes.norm[i] * norm[j]
        low, high = np.fmax(low, estimate - reach), np.fmin(high, estimate + reach)
        keep = yield low, high
        estimate, doubt, low, high, i, j = (x[keep] for x in (estimate, doubt, low, high, i, j))


def first_of(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the `k` best of each group: higher scores first, then smaller ids."""
    order = np.lexsort((ids, -score, group))
    g = group[order]
    begin = np.searchsorted(g, g)
    return order[np.arange(len(g)) - begin < k]


def _kth(group: np.ndarray, score: np.ndarray, k: int, number: int) -> np.ndarray:
    """The k-th best score of each group, -inf where there are fewer."""
    out = np.full(number, -np.inf)
    order = np.lexsort((-score, group))
    g = group[order]
    at = np.flatnonzero(np.arange(len(g)) - np.searchsorted(g, g) == k - 1)
    out[g[at]] = score[order[at]]
    return out


def _below(score: np.ndarray) -> np.ndarray:
    """Doubles that are surely no higher."""
    return score - SLACK * np.abs(score)


class _Rows:
    """A packed block."""

    def __init__(self, row):
        self.n, self.dim = row.n, row.dim
        self.uids, self.ids, self.labels = (np.frombuffer(x, "<i8") for x in (row.uids, row.ids, row.labels))
        self.matrix = np.frombuffer(row.matrix, row.kind).reshape(row.n, row.dim)
        if row.codes:
            self.codes = np.frombuffer(row.codes, np.uint64).reshape(LEVELS, row.n, -1)
            self.lengths = np.frombuffer(row.lengths, "f8").reshape(LEVELS, 2, row.n)
        if row.wanted:
            self.wanted = np.frombuffer(row.wanted, "<i8").reshape(2, row.n, -1)


def _scores(a: _Rows, c: _Rows, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Integer scores of the pairs, slice by slice."""
    bound = float(np.abs(a.matrix).max(initial=0)) * float(np.abs(c.matrix).max(initial=0)) * a.dim
    kind = "f4" if bound < 2**24 else "f8" if bound < 2**53 else "i8"
    out, at_once = np.zeros(len(i), np.int64), max(1, (1 << 22) // max(1, a.dim))
    for b in range(0, len(i), at_once):
        x, y = (r.matrix[p[b : b + at_once]].astype(kind) for r, p in ((a, i), (c, j)))
        out[b : b + at_once] = np.einsum("nd,nd->n", x, y)
    return out


def _surviving(planes: Planes, c: _Rows, i: np.ndarray, j: np.ndarray, passes) -> tuple[np.ndarray, np.ndarray]:
    """The pairs whose interval passes after every level."""
    bounds = intervals(planes, c.codes, c.lengths, i, j)
    found = next(bounds, None)
    while found is not None:
        keep = passes(i, *found)
        i, j = i[keep], j[keep]
        try:
            found = bounds.send(keep)
        except StopIteration:
            found = None
    return i, j


def _pairs(a: _Rows, c: _Rows, begin: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of some anchors and all rows of a block that have one label, or two."""
    some = slice(begin, begin + ANCHORS_AT_ONCE)
    one = a.labels[some, None] == c.labels[None, :]
    i, j = np.nonzero(one & (a.uids[some, None] != c.uids[None, :]) if same else ~one)
    return i + begin, j


def _positives(q, cells, k: int) -> pd.DataFrame:
    """The best `k` rows of the anchor's label in a cell."""
    a = _Rows(q)
    planes = Planes(a.matrix)
    held = [np.zeros(0, np.int64)] * 3
    least = np.full(a.n, -np.inf)
    for c in map(_Rows, cells):
        for begin in range(0, a.n, ANCHORS_AT_ONCE):

            def passes(i, low, high):
                least[:] = np.maximum(least, _kth(i, low, k, a.n))
                return ~(high < least[i])

            i, j = _surviving(planes, c, *_pairs(a, c, begin, True), passes)
            held = [np.r_[x, y] for x, y in zip(held, (i, _scores(a, c, i, j), c.ids[j]), strict=True)]
            held = [x[first_of(*held, k)] for x in held]
            least = np.maximum(least, _kth(held[0], _below(held[1]), k, a.n))
    i, score, ids = held
    return pd.DataFrame({"uid": a.uids[i], "anchor_id": a.ids[i], "positive_id": ids, "score": score})


def _negatives(q, cells, k: int, percent: int) -> pd.DataFrame:
    """For each positive of an anchor the best `k` rows of other labels in a cell that are close below it."""
    a = _Rows(q)
    planes = Planes(a.matrix)
    positive, top = a.wanted
    number = top.shape[1]
    group_of = np.arange(a.n * number).reshape(a.n, number)
    # no score of a band lies below this
    floor = np.where(top < 0, np.inf, _below(percent / 100 * top))
    roof = top + SLACK * np.abs(top)
    held = [np.zeros(0, np.int64)] * 3
    for c in map(_Rows, cells):
        for begin in range(0, a.n, ANCHORS_AT_ONCE):

            def passes(i, low, high):
                keep = np.zeros(len(i), bool)
                for p in range(number):
                    keep |= ~(high < floor[i, p]) & ~(low > roof[i, p]) & (top[i, p] >= 0)
                return keep

            i, j = _surviving(planes, c, *_pairs(a, c, begin, False), passes)
            score = _scores(a, c, i, j)
            found = [held]
            for p in range(number):
                best = top[i, p]
                inside = (best >= 0) & (score <= best) & (100 * score >= percent * best)
                found.append([group_of[i[inside], p], score[inside], c.ids[j[inside]]])
            held = [np.concatenate(x) for x in zip(*found, strict=True)]
            held = [x[first_of(*held, k)] for x in held]
            least = _kth(held[0], _below(held[1]), k, a.n * number).reshape(a.n, number)
            floor = np.maximum(floor, least)
    group, score, ids = held
    i, p = np.divmod(group, number)
    return pd.DataFrame(
        {
            "uid": a.uids[i],
            "place": p.astype("i4"),
            "anchor_id": a.ids[i],
            "positive_id": positive[i, p],
            "negative_id": ids,
            "positive_score": top[i, p],
            "negative_score": score,
        }
    )


def _blocks(rows: DataFrame, size: int, dim: int, coded: bool) -> tuple[DataFrame, int]:
    """Rows (uid, vec_id, label, v and maybe `wanted`) dealt by a hash of the uid into packed blocks."""
    number = max(1, -(-rows.count() // size))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        matrix = np.zeros((len(pdf), dim))
        for i, x in enumerate(pdf["v"]):
            matrix[i, : len(x)] = x
        codes, lengths = (x.tobytes() for x in encode(matrix)) if coded else (b"", b"")
        wanted = b""
        if "best" in pdf:
            most = max(map(len, pdf["best"]))
            both = np.full((2, len(pdf), most), -1, "<i8")
            for i, found in enumerate(pdf["best"]):
                for p, x in enumerate(found):
                    both[:, i, p] = x["positive_id"], x["score"]
            wanted = both.tobytes()
        matrix = vectors._narrow(matrix)
        whole = [pdf[c].to_numpy("<i8").tobytes() for c in ("uid", "vec_id", "label")]
        row = [int(pdf["block"].iloc[0]), *matrix.shape, *whole, matrix.dtype.str, matrix.tobytes(), codes, lengths, wanted]
        return pd.DataFrame([row], columns=_PACKED)

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(number)).cast("int"))
    return dealt.groupBy("block").applyInPandas(pack, _SCHEMA), number


def rows_of(table: DataFrame, scale: float, flip: int, labels: int) -> DataFrame:
    """uid, vec_id, label and the whole-numbered vector `v` of the rows that take part; every `flip`-th id gets the
    next one of so many labels."""
    rows = table.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("v"),
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).where(finite)
    label = F.when(F.col("vec_id") % flip == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    whole = F.transform("v", lambda x: F.floor(F.lit(scale) * x).cast("double"))
    return rows.select(F.monotonically_increasing_id().alias("uid"), "vec_id", label.alias("label"), whole.alias("v"))


def mine(
    embeddings: DataFrame,
    one_in: int = 100,
    positives: int = 5,
    negatives: int = 5,
    percent: int = 80,
    scale: float = 256.0,
    flip: int = 7,
    labels: int = 10,
) -> DataFrame:
    """The hard negatives of every anchor (id divisible by `one_in`) and positive: up to `negatives` rows of another
    label whose score is at least `percent` per cent of the positive's and no higher."""
    # the uid names a row from here on, so it is written once
    rows = stage(rows_of(embeddings, scale, flip, labels), "negatives-rows")
    dim = max(1, rows.agg(F.max(F.size("v"))).first()[0] or 1)
    packed, candidate_blocks = _blocks(rows, CANDIDATE_ROWS, dim, coded=True)
    candidates = stage(packed, "negatives-candidates")
    anchors = stage(rows.where(F.col("vec_id") % one_in == 0), "negatives-anchors")
    asked, asked_blocks = _blocks(anchors, ANCHOR_ROWS, dim, coded=False)
    near = vectors.meet(
        asked, asked_blocks, candidates, candidate_blocks, partial(_positives, k=positives),
        "uid long, anchor_id long, positive_id long, score long",
    )
    best = Window.partitionBy("uid").orderBy(F.desc("score"), "positive_id")
    near = near.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives)
    found = near.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("place", "positive_id", "score"))).alias("best"))
    found = stage(found.join(anchors, "uid"), "negatives-positives")
    asked, asked_blocks = _blocks(found, ANCHOR_ROWS, dim, coded=False)
    close = vectors.meet(
        asked, asked_blocks, candidates, candidate_blocks, partial(_negatives, k=negatives, percent=percent),
        "uid long, place int, anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long",
    )
    order = Window.partitionBy("uid", "place").orderBy(F.desc("negative_score"), "negative_id")
    return close.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


MINE_SQL = """
with ok as (
    select row_number() over () as uid, vec_id, embedding::double[] as e, label from embeddings
    where vec_id is not null and label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), code as materialized (
    select uid, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(e, lambda x: floor(256 * x)::double) as v from ok
), pair as materialized (
    select a.uid as anchor, a.vec_id as anchor_id, c.vec_id, a.label = c.label as same,
        list_inner_product(a.v, c.v)::bigint as score
    from code a join code c on a.vec_id % 100 = 0 and a.uid <> c.uid
), positive as (
    select * from (select *, row_number() over (partition by anchor order by score desc, vec_id) as place from pair where same)
    where place <= 5
), close as (
    select p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id, p.score as positive_score, n.score as negative_score,
        row_number() over (partition by p.anchor, p.place order by n.score desc, n.vec_id) as rank
    from positive p join pair n on n.anchor = p.anchor and not n.same
        and 80 * p.score <= 100 * n.score and 100 * n.score <= 100 * p.score
)
select anchor_id, positive_id, rank::integer as rank, negative_id, positive_score, negative_score from close where rank <= 5
"""
