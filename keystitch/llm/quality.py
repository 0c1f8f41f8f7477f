"""Quality by perplexity under an interpolated modified Kneser-Ney model of byte n-grams of trusted text.

One scan counts the n-grams of all documents, apart for the trusted ones; each task adds up what it meets before it
is shuffled. Tables of counts, of contexts and of lower orders stay distributed, and the probability of each n-gram
that occurs anywhere comes from joins between them, order by order. The finished table is sent out in shards of a
fixed number of n-grams, and a second scan adds up each document. Documents whose perplexity lies above a quantile of
the trusted documents of their language are rejected; those that set the quantiles are not part of the model.

A language with fewer than LEAST_HELD_OUT of those has no quantile to go by: it takes the spread of all its own
documents, or its largest trusted perplexity if that is higher. No language is measured by another one.

Defined cases: texts that are null or empty have no perplexity and are not rejected. Rows without a language are one
language. Of a language with too few trusted documents and fewer than LEAST_OWN documents nothing is rejected.
Without any trusted document that was kept out of the model nothing is rejected. Rows with one id are scored each by itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keystitch.llm.hashing import text_slices
from keystitch.llm.rows import flagged, small
from keystitch.sources.tables import TEXT_ROWS, stage

ORDER = 5
#: Quantile of the trusted documents of a language up to which a document is kept.
QUANTILE = 0.995
#: One in so many trusted documents is kept out of the model and used for the quantiles.
HELD_OUT = 5
#: Held-out trusted documents from which on their quantile counts; of fewer, 0.995 is no more than the largest.
LEAST_HELD_OUT = 200
#: Documents of a language from which on their spread counts, where trusted ones are too few. The limit lies SPREADS
#: standard deviations over the median of the log perplexity. The deviation comes from the lower quartile, which junk
#: hardly moves, and is at least LEAST_SPREAD.
LEAST_OWN, SPREADS, LEAST_SPREAD = 50, 6.0, 0.05
#: N-grams of a shard of the finished table: 12 bytes each.
SHARD_NGRAMS = 1 << 21
#: N-grams a task adds up before it hands them on.
HELD_NGRAMS = 1 << 20
#: N-grams that are put into the table at a time, so that little is held besides the table.
PUT_KEYS = 1 << 16
#: Characters of text whose n-grams are worked on at a time.
SLICE = 500_000
_PAD = b"\x02" * (ORDER - 1)
_EMPTY = np.uint64((1 << 64) - 1)


def ngrams(texts: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each byte of the texts, as a number, and the place of its text."""
    pad = _PAD[: order - 1]
    data = np.frombuffer(b"".join(pad + t for t in texts), np.uint8).astype(np.uint64)
    lengths = np.array([len(t) for t in texts], np.int64)
    doc = np.repeat(np.arange(len(texts)), lengths)
    at = np.arange(lengths.sum()) + (doc + 1) * (order - 1)
    value = np.zeros(len(at), np.uint64)
    for back in range(order - 1, -1, -1):
        value = (value << np.uint64(8)) | data[at - back]
    return value, doc


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    value = np.concatenate([p[0] for p in parts])
    order = np.argsort(value, kind="stable")
    value, count = value[order], np.concatenate([p[1] for p in parts])[order]
    first = np.flatnonzero(np.r_[True, value[1:] != value[:-1]]) if len(value) else np.zeros(0, int)
    return value[first], np.add.reduceat(count, first) if len(first) else count


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """N-grams of a task, with how often they occur in trusted documents."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def out() -> pd.DataFrame:
        value, count = _merge(held)
        held.clear()
        return pd.DataFrame({"g": value.view("i8"), "c": count})

    for pdf in batches:
        for trusted, part in pdf.groupby("trusted"):
            for _, _, texts in text_slices(part["text"], SLICE):
                value, count = np.unique(ngrams(texts)[0], return_counts=True)
                held.append((value, count * int(trusted)))
                if sum(len(v) for v, _ in held) > HELD_NGRAMS:
                    held[:] = [_merge(held)]
                    if len(held[0][0]) > HELD_NGRAMS // 2:
                        yield out()
    if held:
        yield out()


def _discounts(table: DataFrame) -> list[float]:
    """Discounts of counts of one, two, and three or more, from the numbers of n-grams with counts of 1 to 4."""
    rows = table.where(F.col("c").between(1, 4)).groupBy("c").count().collect()
    n = {r["c"]: r["count"] for r in rows}
    one, two = n.get(1, 0), n.get(2, 0)
    y = one / (one + 2 * two) if one + two else 0.5
    found = []
    for c in (1, 2, 3):
        ratio = n.get(c + 1, 0) / n[c] if n.get(c) else 0.5
        found.append(min(max(c - (c + 1) * y * ratio, 0.05), c - 0.05))
    return found


def _discounted(d: list[float]) -> Column:
    c = F.col("c")
    return c - F.when(c == 1, d[0]).when(c == 2, d[1]).otherwise(d[2])


def probabilities(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """g and the natural logarithm of its last byte's probability after the others, for each row (g, c) of `counts`."""
    tables, wanted = [counts.where("c > 0")], [counts.select("g")]
    for k in range(order - 1, 0, -1):
        suffix = F.col("g").bitwiseAND((1 << 8 * k) - 1).alias("g")
        # a shorter n-gram counts once for each different byte before it
        tables.append(stage(tables[-1].groupBy(suffix).agg(F.count("*").alias("c")), "quality-counts"))
        wanted.append(wanted[-1].select(suffix).distinct())
    low = None
    for table, grams in zip(reversed(tables), reversed(wanted), strict=True):
        d = _discounts(table)
        number = [F.count(F.when(test, 1)) for test in (F.col("c") == 1, F.col("c") == 2, F.col("c") >= 3)]
        spare = reduce(Column.__add__, (n * x for n, x in zip(number, d, strict=True)))
        contexts = table.groupBy(F.shiftright("g", 8).alias("context")).agg(F.sum("c").alias("total"), spare.alias("spare"))
        rows = grams.join(table, "g", "left").withColumn("context", F.shiftright("g", 8)).join(contexts, "context", "left")
        if low is None:
            rows = rows.withColumn("low", F.lit(1 / 256))
            k = 1
        else:
            suffix = F.col("g").bitwiseAND((1 << 8 * k) - 1)
            rows = rows.withColumn("suffix", suffix).join(low.select(F.col("g").alias("suffix"), F.col("p").alias("low")), "suffix")
            k += 1
        seen = F.when(F.col("c").isNull(), 0.0).otherwise(_discounted(d))
        p = F.when(F.col("total").isNull(), F.col("low")).otherwise((seen + F.col("spare") * F.col("low")) / F.col("total"))
        low = stage(rows.select("g", p.alias("p")), "quality-probabilities")
    return low.select("g", F.log("p").alias("p"))


class Table:
    """Values by key in open slots."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys, self.values = np.full(1 << self.bits, _EMPTY), np.zeros(1 << self.bits, np.float32)
        for a in range(0, len(keys), PUT_KEYS):
            self._put(keys[a : a + PUT_KEYS], values[a : a + PUT_KEYS])

    def _put(self, keys: np.ndarray, values: np.ndarray) -> None:
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            at = slot[left]
            free = np.flatnonzero(self.keys[at] == _EMPTY)
            _, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.keys[at[won]], self.values[at[won]] = keys[left[won]], values[left[won]]
            left = np.delete(left, won)
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values of the keys; 0 where there is none."""
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], np.float32(0))
        left = np.flatnonzero((found != keys) & (found != _EMPTY))
        while len(left):
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[left]]
            hit = found == keys[left]
            out[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (found != _EMPTY)]
        return out


_TABLES: dict[str, Table] = {}


def _add(shard, name: str):
    """Add what the n-grams of one shard say about each document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if name not in _TABLES:
            _TABLES.clear()
            _TABLES[name] = Table(*shard.value)
        for pdf in batches:
            sums = []
            for a, b, texts in text_slices(pdf["text"], SLICE):
                value, doc = ngrams(texts)
                sums.append(np.bincount(doc, weights=_TABLES[name].get(value), minlength=b - a))
            yield pdf.assign(ll=pdf["ll"] + np.concatenate(sums)) if sums else pdf
        # a worker outlives its tasks; the next one of this stage makes the table again
        _TABLES.clear()

    return run


def perplexities(docs: DataFrame, trusted: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, lang and perplexity of each row of `docs` under a model of the documents with ids in `trusted`, and the
    columns of `docs` that `keep` names."""
    spark = docs.sparkSession
    used = [F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text").cast("string"), *keep]
    rows = flagged(docs.select(*used), trusted, "trusted")
    counted = rows.select("text", "trusted").mapInPandas(_count, "g long, c long")
    counts = stage(counted.groupBy("g").agg(F.sum("c").alias("c")), "quality-ngrams", TEXT_ROWS)
    known = stage(probabilities(counts), "quality-table")
    shards = max(1, -(-known.count() // SHARD_NGRAMS))
    scored = rows.withColumn("ll", F.lit(0.0))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in scored.schema.fields)
    for number in range(shards):
        part = known.where(F.pmod(F.xxhash64("g"), F.lit(shards)) == number).toArrow()
        pair = part["g"].to_numpy().view("u8"), part["p"].to_numpy().astype("f4")
        shard = spark.sparkContext.broadcast(pair)
        scored = scored.mapInPandas(_add(shard, f"{uuid.uuid4()}"), schema)
    size = F.octet_length("text")
    return scored.select("doc_id", "lang", F.when(size > 0, F.exp(-F.col("ll") / size)).alias("perplexity"), *keep)


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, lang, perplexity, threshold and rejected of every document. Trusted are those labelled of quality 1.

    `keep` names columns of `docs` to carry along, a key of the rows, say."""
    trusted = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    trusted = trusted.agg(F.min("quality").alias("q")).where("q = 1").select("doc_id")
    # a model likes what it was trained on, so the limits come from trusted documents that it has not seen
    apart = F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0
    scored = stage(perplexities(docs, trusted.where(~apart), keep), "quality-scores", TEXT_ROWS)
    good = scored.join(trusted.where(apart), "doc_id", "left_semi").where(F.col("perplexity").isNotNull())
    at = F.percentile_approx("perplexity", F.lit(quantile), F.lit(10_000))
    trusted_of = good.groupBy("lang").agg(at.alias("own"), F.max("perplexity").alias("most"), F.count("*").alias("held"))
    log = F.log("perplexity")
    quartiles = F.percentile_approx(log, F.array(F.lit(0.25), F.lit(0.5)), F.lit(10_000))
    spread_of = scored.where("perplexity is not null").groupBy(F.col("lang").alias("l")).agg(
        quartiles.alias("q"), F.count("*").alias("n")
    )
    # 0.6745 deviations lie between the quartile and the median
    deviation = F.greatest((F.col("q")[1] - F.col("q")[0]) / 0.6745, F.lit(LEAST_SPREAD))
    robust = F.when(F.col("n") >= LEAST_OWN, F.greatest(F.exp(F.col("q")[1] + SPREADS * deviation), "most"))
    limit = F.when(F.col("held") >= LEAST_HELD_OUT, F.col("own")).otherwise(robust)
    # one row a language; names of languages that are as many as documents are not broadcast
    limits = spread_of.join(trusted_of, F.col("l").eqNullSafe(F.col("lang")), "left").select("l", limit.alias("threshold"))
    if not good.limit(1).count():
        limits = limits.withColumn("threshold", F.lit(None).cast("double"))
    joined = scored.join(small(stage(limits, "quality-limits")), F.col("lang").eqNullSafe(F.col("l")), "left")
    rejected = F.coalesce(F.col("perplexity") > F.col("threshold"), F.lit(False))
    return joined.select("doc_id", "lang", "perplexity", "threshold", rejected.alias("rejected"), *keep)
