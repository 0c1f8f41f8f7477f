"""Removal of word passages that a document with a smaller id has too, by level-wise doubling.

A window of n words can only repeat where its halves do. Windows of about n/2 words are counted first, and of these
only the one with the least hash in each window of n: equal windows choose the same one. What occurs in one document
alone is dropped; only windows around the rest are extended to twice the length, and so on until n is reached or no
candidate is left. At the last level each window learns the smallest id it occurs in, and documents lose the words
of the windows whose smallest id is not their own.

Work goes back and forth between two ways to deal it out. Hashes are packed by hash bucket, so that equal ones meet,
and answers are packed by document bucket, so that they meet the texts. Before hashes travel, each task reduces
those it has to one entry each, so a passage that a third of all documents share arrives once a task, not once a
document. Hashes of the last level have 96 bits.

Defined cases: a null text has no words. Rows without an id keep their words and are not compared. Rows with the
same id count as one document: they take no words from each other. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystitch.llm.hashing import Words, least_of, text_slices
from keystitch.llm.rows import spare
from keystitch.sources.tables import TEXT_ROWS, stage

WINDOW = 13
#: Windows are not halved below this number of words.
SHORTEST = 7
#: Bytes of text that a bucket of documents holds on average.
BUCKET_BYTES = 12 << 20
#: Characters of text whose words are worked on at a time; a longer document is worked on alone.
SLICE = 500_000
#: Hashes that a task of the first level holds before it packs them.
HELD_HASHES = 1 << 18
_SEVERAL = -(1 << 63)
_FOUND = "bucket int, target int, low binary, high binary, doc binary"


def levels(window: int, shortest: int = SHORTEST) -> list[int]:
    """Lengths that double, up to the rounding, from at least `shortest` to `window`."""
    found = [window]
    while found[-1] > 1 and (found[-1] + 1) // 2 >= shortest:
        found.append((found[-1] + 1) // 2)
    return found[::-1]


def _packed(bucket: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple]:
    """For each bucket its number and its part of the columns, in their order."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(bucket) else np.zeros(1, int)
    columns = [c[order] for c in columns]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(bucket[a]), *(c[a:b].tobytes() for c in columns)


def _joined(column, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind)


def _bytes(texts) -> list[bytes]:
    return [b"" if t is None else t.encode() for t in texts]


def _chosen(words: Words, small: int, large: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of `large` words inside a document its place and the least hash of its windows of `small`."""
    place = np.flatnonzero(words.whole(large))
    return place, least_of(words.windows(small), large - small + 1)[place] if len(place) else np.zeros(0, np.uint64)


def _first_level(small: int, large: int, buckets: int):
    """Packed entries of the documents of a task: hash and document; and hashes that several documents here share."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, ...]] = []
        for pdf in batches:
            ids, home = (pdf[c].to_numpy() for c in ("doc_id", "home"))
            for a, b, texts in text_slices(pdf["text"], SLICE):
                words = Words(texts)
                place, value = _chosen(words, small, large)
                doc = words.doc[place]
                new = np.r_[True, (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])] if len(value) else np.zeros(0, bool)
                doc = doc[new] + a
                held.append((value[new] >> np.uint64(16), ids[doc], home[doc]))
                if sum(len(h[0]) for h in held) >= HELD_HASHES:
                    yield _reduced(held, buckets)
                    held.clear()
        if held:
            yield _reduced(held, buckets)

    return run


def _reduced(held: list[tuple[np.ndarray, ...]], buckets: int) -> pd.DataFrame:
    """One entry for each hash, with its document or a mark that several have it."""
    value, doc, home = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.lexsort((doc, value))
    value, doc, home = value[order], doc[order], home[order]
    rows = []
    if len(value):
        first = np.flatnonzero(np.r_[True, value[1:] != value[:-1]])
        low, high = np.minimum.reduceat(doc, first), np.maximum.reduceat(doc, first)
        rows += _entries(value[first], np.where(low != high, _SEVERAL, low), home[first], buckets)
        # documents that share a hash right here are told through the bucket of their own
        shared = np.repeat(low != high, np.diff(np.r_[first, len(value)]))
        rows += [(h, h, *halves, None) for h, *halves in _packed(home[shared], _halves(value[shared]))]
    return pd.DataFrame(rows, columns=["bucket", "target", "low", "high", "doc"])


def _halves(value: np.ndarray) -> list[np.ndarray]:
    return [value.astype("<u4"), (value >> np.uint64(32)).astype("<u2")]


def _entries(value: np.ndarray, doc: np.ndarray, home: np.ndarray, buckets: int) -> list[tuple]:
    bucket = (value % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((doc, bucket))
    value, doc, home, bucket = value[order], doc[order], home[order], bucket[order]
    packed = _packed(bucket, [*_halves(value), np.rec.fromarrays([doc.astype("<i8"), home.astype("<i4")])])
    return [(b, -1, low, high, both) for b, low, high, both in packed]


_ENTRY = np.dtype([("doc", "<i8"), ("home", "<i4")])


def _whole_hash(pdf: pd.DataFrame) -> np.ndarray:
    return _joined(pdf["low"], "<u4").astype(np.uint64) | _joined(pdf["high"], "<u2").astype(np.uint64) << np.uint64(32)


def _repeated(pdf: pd.DataFrame) -> pd.DataFrame:
    """Hashes of a bucket that occur in several documents, for the bucket of each document that has them."""
    told = pdf[pdf["target"] >= 0]
    asked = pdf[pdf["target"] < 0]
    value, entry = _whole_hash(asked), _joined(asked["doc"], _ENTRY)
    order = np.argsort(value, kind="stable")
    value, doc, home = value[order], entry["doc"][order], entry["home"][order]
    rows = list(zip(told["target"], told["low"], told["high"], strict=True))
    if len(value):
        first = np.flatnonzero(np.r_[True, value[1:] != value[:-1]])
        several = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
        keep = np.repeat(several, np.diff(np.r_[first, len(value)])) & (doc != _SEVERAL)
        rows += _packed(home[keep], _halves(value[keep]))
    return pd.DataFrame(rows, columns=["home", "low", "high"])


def _extend(small: int, large: int, step: int, last: bool, buckets: int):
    """Windows of `large` words whose parts of `small` words all survived, once for each bucket of documents, with the
    smallest id that has one. In the first step the part that stands for a window is its least one."""

    def run(docs: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[np.ndarray, ...]] = []
        if len(told) and len(docs):
            known = _known(told, step)
            for a, b, texts in text_slices(docs["text"], SLICE):
                ids, words = docs["doc_id"].to_numpy()[a:b], Words(texts)
                place = _candidates(words, small, large, known, step)
                if len(place):
                    found.append((words.windows(large)[place], words.windows(large, 1)[place] >> np.uint64(32), ids[words.doc[place]]))
        if not found:
            return pd.DataFrame({c: [] for c in ("bucket", "target", "low", "high", "doc")})
        value, more, doc = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((doc, more, value))
        value, more, doc = value[order], more[order], doc[order]
        first = np.flatnonzero(np.r_[True, (value[1:] != value[:-1]) | (more[1:] != more[:-1])])
        several = np.maximum.reduceat(doc, first) != doc[first]
        value, more, doc = value[first], more[first].astype("<u4"), doc[first]
        bucket = (value % np.uint64(buckets)).astype(np.int64)
        entry = np.rec.fromarrays([doc.astype("<i8"), several.astype("u1")])
        order = np.argsort(doc, kind="stable")
        home = int(docs["home"].iloc[0])
        rows = [(b, home, *p) for b, *p in _packed(bucket[order], [value[order], more[order], entry[order]])]
        return pd.DataFrame(rows, columns=["bucket", "target", "low", "high", "doc"])

    return run


_LAST = np.dtype([("doc", "<i8"), ("several", "u1")])


def _known(told: pd.DataFrame, step: int) -> np.ndarray:
    if step == 0:
        return np.unique(_whole_hash(told))
    return np.unique(_joined(told["low"], "<u8"))


def _has(known: np.ndarray, value: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, value), len(known) - 1)] == value


def _candidates(words: Words, small: int, large: int, known: np.ndarray, step: int) -> np.ndarray:
    if step == 0:
        place, value = _chosen(words, small, large)
        return place[_has(known, value >> np.uint64(16))] if len(place) else place
    place = np.flatnonzero(words.whole(large))
    if not len(place):
        return place
    part = _has(known, words.windows(small))
    return place[part[place] & part[place + large - small]]


def _smallest(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each bucket of documents the windows that several documents have, with the smallest id of all."""
    value, more, entry = _joined(pdf["low"], "<u8"), _joined(pdf["high"], "<u4"), _joined(pdf["doc"], _LAST)
    home = np.repeat(pdf["target"].to_numpy(), [len(x) // 8 for x in pdf["low"]])
    order = np.lexsort((entry["doc"], more, value))
    value, more, doc, several, home = value[order], more[order], entry["doc"][order], entry["several"][order], home[order]
    first = np.flatnonzero(np.r_[True, (value[1:] != value[:-1]) | (more[1:] != more[:-1])]) if len(value) else np.zeros(0, int)
    size = np.diff(np.r_[first, len(value)])
    least = np.repeat(doc[first], size)
    keep = np.repeat(size > 1, size) | (several > 0)
    rows = list(_packed(home[keep], [value[keep], more[keep], least[keep]]))
    return pd.DataFrame(rows, columns=["home", "low", "high", "doc"])


def _strip(window: int, original: bool):
    """Documents of a bucket without the words of windows that a document with a smaller id has."""

    def run(docs: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        kept, removed, number = [], [], []
        value, more, least = (_joined(told[c], k) for c, k in (("low", "<u8"), ("high", "<u4"), ("doc", "<i8")))
        key = np.rec.fromarrays([value, more], names="v,m")
        order = np.argsort(key, order=("v", "m")) if len(key) else np.zeros(0, int)
        value, more, least = value[order], more[order], least[order]
        for a, b, texts in text_slices(docs["text"], SLICE):
            words, ids = Words(texts), docs["doc_id"].to_numpy()[a:b]
            gone = np.zeros(len(words.doc) + 1, np.int64)
            place = np.flatnonzero(words.whole(window))
            if len(value) and len(place):
                v, m = words.windows(window)[place], (words.windows(window, 1)[place] >> np.uint64(32)).astype("<u4")
                at = np.searchsorted(value, v)
                hit = np.zeros(len(place), bool)
                own = ids[words.doc[place]]
                # equal first halves of different windows stand side by side
                while True:
                    inside = at < len(value)
                    same = inside.copy()
                    same[inside] = value[at[inside]] == v[inside]
                    if not same.any():
                        break
                    hit[same] |= (more[at[same]] == m[same]) & (least[at[same]] < own[same])
                    at[same] += 1
                    v = np.where(same, v, 0)
                    at[~same] = len(value)
                place = place[hit]
                np.add.at(gone, place, 1)
                np.add.at(gone, place + window, -1)
            gone = np.cumsum(gone)[:-1] > 0
            ends = np.cumsum(words.counts)
            lost = np.bincount(words.doc[gone], minlength=b - a)
            for i, (end, n) in enumerate(zip(ends, words.counts, strict=True)):
                parts = texts[i].split()
                if lost[i]:
                    parts = [p for p, g in zip(parts, gone[end - n : end].tolist(), strict=True) if not g]
                kept.append(b" ".join(parts).decode())
            number += words.counts.tolist()
            removed += lost.tolist()
        out = docs.drop(columns=["home"] if original else ["home", "text"])
        return out.assign(kept=kept, n_words=np.array(number, "i8"), n_removed=np.array(removed, "i8"))

    return run


def dedup(docs: DataFrame, window: int = WINDOW, shortest: int = SHORTEST, original: bool = False) -> DataFrame:
    """`docs` without their texts, unless `original` is set, and with what is left of each (`kept`, words joined by one
    space), `n_words` and `n_removed`. Other columns of `docs` pass through; those with the names of results are replaced."""
    spark = docs.sparkSession
    docs = docs.drop("kept", "n_words", "n_removed")
    own, aside = next((c for c in docs.columns if c.lower() == "home"), "home"), spare(docs, "home")
    docs = docs.withColumnRenamed("home", aside)
    docs = docs.withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")})
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    rows = docs.where("doc_id is not null").withColumn("home", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int"))
    short = rows.select("doc_id", "text", "home")
    lengths = levels(window, shortest)
    if len(lengths) == 1:
        lengths = [window, window]
    entries = short.where(F.octet_length("text") >= 2 * window - 1).mapInPandas(
        _first_level(lengths[0], lengths[1], buckets), _FOUND
    )
    repeated = entries.groupBy("bucket").applyInPandas(_repeated, "home int, low binary, high binary")
    told = stage(repeated, "substrings", TEXT_ROWS)
    for step, (small, large) in enumerate(zip(lengths[:-1], lengths[1:], strict=True)):
        if not told.limit(1).count():
            break
        found = short.groupBy("home").cogroup(told.groupBy("home")).applyInPandas(
            _extend(small, large, step, large == window, buckets), _FOUND
        )
        told = stage(
            found.groupBy("bucket").applyInPandas(_smallest, "home int, low binary, high binary, doc binary"),
            "substrings",
            TEXT_ROWS,
        )
    else:
        return _finish(docs, rows, told, window, original).withColumnRenamed(aside, own)
    nothing = spark.createDataFrame([], "home int, low binary, high binary, doc binary")
    return _finish(docs, rows, nothing, window, original).withColumnRenamed(aside, own)


def _finish(docs: DataFrame, rows: DataFrame, told: DataFrame, window: int, original: bool) -> DataFrame:
    gone = ["home"] if original else ["home", "text"]
    kept = [f for f in rows.schema.fields if f.name not in gone]
    schema = ", ".join(
        [*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "kept string", "n_words long", "n_removed long"]
    )
    done = rows.groupBy("home").cogroup(told.groupBy("home")).applyInPandas(_strip(window, original), schema)
    spaced = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    number = F.when(spaced == "", 0).otherwise(F.size(F.split(spaced, " "))).cast("long")
    rest = docs.where("doc_id is null").withColumns({"kept": spaced, "n_words": number, "n_removed": F.lit(0).cast("long")})
    return done.unionByName(rest.drop(*gone))


def digests(docs: DataFrame) -> DataFrame:
    """Per document the number of words, how many were removed, and a digest of the rest."""
    done = dedup(docs.select("doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


DIGESTS_SQL = r"""
with w as (
    select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws
    from documents
), start as (
    select doc_id, unnest(range(1, len(ws) - 11)) as i, ws from w where len(ws) >= 13
), win as (
    select doc_id, i, list_slice(ws, i, i + 12) as seq from start
), hit as (
    select doc_id, i from (select doc_id, i, min(doc_id) over (partition by seq) as least from win)
    where least < doc_id
), gone as (
    select doc_id, list(distinct pos) as places
    from (select doc_id, unnest(range(i, i + 13)) as pos from hit) group by doc_id
), kept as (
    select w.doc_id, len(ws) as n, coalesce(len(places), 0) as removed,
        list_filter(ws, lambda x, j: not list_contains(coalesce(places, []), j)) as rest
    from w left join gone using (doc_id)
)
select doc_id, n::bigint as n_words, removed::bigint as n_removed,
    sha256(array_to_string(rest, ' ')) as kept_sha256
from kept
"""
