"""Removal of byte strings that occur more than once, by suffix arrays built through Lyndon-prefix groups.

Every string of L bytes has an anchor: of its k-byte grams the one with the least hash, the leftmost of equals. Equal
strings have equal anchors at the same place. A region is all strings of a document in a row that share an anchor.
Regions meet by the hash of their anchor; equal regions are one class, and a class of several repeats from end to
end. What is left are classes of one region whose anchor occurs in others too. Only these, and one region of each
other class they could share a string with, have their bytes sent and sorted.

In such a group all regions are aligned at the anchor. Their bytes before and after it are cut into blocks, equal
blocks of one column become one symbol, and the suffix array of the symbols of all groups of a task shows which
regions share enough blocks with a neighbour. What passes is compared byte by byte through hashes of the strings.

The suffix array is built without recursive renaming. Suffixes start out in groups by symbol. Groups are taken from
the highest to the lowest; each suffix of a group finds the previous suffix of a lower group, and these are moved up
within their group by the number that found them. In the end groups stand in the order of the Lyndon prefixes of
their suffixes, and one pass in ascending order hands out the places: that of a suffix fixes those before it.

Defined cases: a null text is empty. Texts of fewer than L bytes lose nothing. Rows are told apart by their id only in
the results; rows with the same id, repeated rows and rows without an id are texts like all others. Bytes are
removed whatever character they belong to. A single text must be shorter than 2^28 bytes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystitch.llm.hashing import Rolling, least_of, mix, slices
from keystitch.llm.substrings import BUCKET_BYTES, _bytes, _joined, _packed
from keystitch.llm.rows import spare
from keystitch.sources.tables import stage

LENGTH, GRAM, BLOCK = 200, 100, 10
#: Low bits of an order key, which hold a position; a task's slice of texts is shorter than that.
_PLACE = np.uint64(28)
_FULL, _SENT, _ASKED = 0, 1, 2


def suffix_array(symbols: list[int]) -> list[int]:
    """Start positions of the suffixes in order. The last symbol must be the least and occur once."""
    n = len(symbols)
    # suffixes in groups by first symbol; a group is a range of `order`, named by its begin
    begin, number = {}, Counter(symbols)
    at = 0
    for symbol in sorted(number):
        begin[symbol] = at
        at += number[symbol]
    group = [begin[s] for s in symbols]
    end = [0] * (n + 1)
    for symbol, first in begin.items():
        end[first] = first + number[symbol]
    order, place, free = [0] * n, [0] * n, dict(zip(begin.values(), begin.values(), strict=True))
    for i, g in enumerate(group):
        p = free[g]
        order[p], place[i], free[g] = i, p, p + 1
    previous = [-1] * n
    high = n
    while high > 0:
        g = group[order[high - 1]]
        members = order[g:high] if high - g == 1 else sorted(order[g:high])
        found: dict[int, int] = {}
        for i in members:
            p = i - 1
            while p >= 0 and group[p] >= g:
                p = previous[p]
            previous[i] = p
            if p >= 0:
                found[p] = found.get(p, 0) + 1
        high = g
        if not found:
            continue
        if len(found) == 1:
            levels = [list(found)]
        else:
            by_count: dict[int, list[int]] = {}
            for p, c in found.items():
                by_count.setdefault(c, []).append(p)
            levels = [by_count[c] for c in sorted(by_count, reverse=True)]
        for level in levels:
            moved: dict[int, int] = {}
            for p in level:
                of = group[p]
                m = moved.get(of, 0)
                last = end[of] - 1 - m
                moved[of] = m + 1
                here = place[p]
                if here != last:
                    other = order[last]
                    order[last], order[here] = p, other
                    place[p], place[other] = last, here
            for of, m in moved.items():
                stop = end[of]
                new = stop - m
                if new != of:
                    end[new], end[of] = stop, new
                    for q in range(new, stop):
                        group[order[q]] = new
    out, taken, given = [-1] * n, [0] * n, [False] * n
    out[0] = n - 1
    given[n - 1] = True
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not given[j]:
            g = group[j]
            out[g + taken[g]] = j
            taken[g] += 1
            given[j] = True
            j = previous[j]
    return out


class Regions:
    """Regions of several texts: anchor and hash of each, where it begins and ends, and the place of its anchor."""

    def __init__(self, texts: list[bytes], length: int, gram: int):
        data = np.frombuffer(b"".join(texts), np.uint8)
        self.begins = np.cumsum([0, *map(len, texts)])
        empty = np.zeros(0, np.int64)
        self.anchor = self.value = np.zeros(0, np.uint64)
        self.start = self.end = self.place = self.doc = empty
        if len(data) < length:
            return
        rolling = Rolling(data.astype(np.uint64) + np.uint64(1))
        grams = rolling.windows(gram)
        low = np.uint64((1 << int(_PLACE)) - 1)
        key = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        place = (least_of(key, length - gram + 1) & low).astype(np.int64)
        lengths = np.diff(self.begins)
        # first string of each text, and one past the last
        inside = np.zeros(len(data) + 1, np.int8)
        long_enough = lengths >= length
        np.add.at(inside, self.begins[:-1][long_enough], 1)
        np.add.at(inside, (self.begins[1:] - length + 1)[long_enough], -1)
        x = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int64)[: len(place)])
        if not len(x):
            return
        new = np.r_[True, (place[x[1:]] != place[x[:-1]]) | (np.diff(x) != 1)]
        first = np.flatnonzero(new)
        self.start, self.end = x[first], x[np.r_[first[1:], len(x)] - 1] + length
        self.place = place[self.start]
        self.anchor = grams[self.place] >> np.uint64(16)
        self.value = mix(rolling.ranges(self.start, self.end) + (self.place - self.start).astype(np.uint64))
        self.doc = np.searchsorted(self.begins, self.start, side="right") - 1
        self.data = data


def _find(length: int, gram: int, buckets: int):
    """Packed regions by bucket of their anchor. Regions that a slice has twice are sent once, marked as several, and
    the documents they stand in are told through the bucket of their own."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, home_of = _bytes(pdf["text"]), pdf["home"].to_numpy()
            for a, b in slices(texts):
                found = Regions(texts[a:b], length, gram)
                if not len(found.start):
                    continue
                order = np.lexsort((found.value, found.anchor))
                anchor, value, home = found.anchor[order], found.value[order], home_of[a:b][found.doc[order]]
                first = _firsts(anchor, value)
                size = np.diff(np.r_[first, len(anchor)])
                several = np.repeat(size > 1, size)
                told = np.unique(_keyed(anchor[several], value[several], home[several]))
                rows = [(h, h, *p, b"", b"") for h, *p in _packed(told["home"], [told["anchor"], told["value"]])]
                bucket = (anchor[first] % np.uint64(buckets)).astype(np.int64)
                columns = [anchor[first], value[first], home[first].astype("<i4"), (size > 1).astype("u1")]
                rows += [(h, -1, *p) for h, *p in _packed(bucket, columns)]
                yield pd.DataFrame(rows, columns=_ENTRY_NAMES)

    return run


_ENTRY = "bucket int, target int, anchor binary, value binary, home binary, several binary"
_ENTRY_NAMES = [part.split(" ")[0] for part in _ENTRY.split(", ")]
_TOLD = "home int, kind int, anchor binary, value binary"


def _firsts(*columns: np.ndarray) -> np.ndarray:
    """Where the values of sorted columns change."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.r_[True, np.logical_or.reduce([c[1:] != c[:-1] for c in columns])])


def _keyed(anchor: np.ndarray, value: np.ndarray, home: np.ndarray) -> np.ndarray:
    out = np.zeros(len(anchor), [("home", "<i8"), ("anchor", "<u8"), ("value", "<u8")])
    out["anchor"], out["value"], out["home"] = anchor, value, home
    return out


def _judge(pdf: pd.DataFrame) -> pd.DataFrame:
    """Classes of several regions are full of repeats. Classes of one are asked for their bytes if their anchor has
    other classes, which then send those of one region each."""
    told, asked = pdf[pdf["target"] >= 0], pdf[pdf["target"] < 0]
    rows = [(t, _FULL, a, v) for t, a, v in zip(told["target"], told["anchor"], told["value"], strict=True)]
    anchor, value = (_joined(asked[c], "<u8") for c in ("anchor", "value"))
    home, several = _joined(asked["home"], "<i4"), _joined(asked["several"], "u1")
    if len(anchor):
        order = np.lexsort((home, value, anchor))
        anchor, value, home, several = anchor[order], value[order], home[order], several[order]
        first = _firsts(anchor, value)
        size = np.diff(np.r_[first, len(anchor)])
        full = (size > 1) | (np.add.reduceat(several.astype(np.int64), first) > 0)
        every = np.repeat(full, size)
        rows += [(h, _FULL, *p) for h, *p in _packed(home[every].astype(np.int64), [anchor[every], value[every]])]
        of = _firsts(anchor[first])
        classes = np.diff(np.r_[of, len(first)])
        ask = np.repeat((classes > 1) & (np.add.reduceat((~full).astype(np.int64), of) > 0), classes)
        for kind, which in ((_SENT, ask & full), (_ASKED, ask & ~full)):
            at = first[which]
            rows += [(h, kind, *p) for h, *p in _packed(home[at].astype(np.int64), [anchor[at], value[at]])]
    return pd.DataFrame(rows, columns=["home", "kind", "anchor", "value"])


_SENDING = "bucket int, home int, anchor binary, value binary, kind binary, before binary, size binary, data binary"


def _send(length: int, gram: int, buckets: int):
    """The bytes of the regions that were asked for, packed by bucket of their anchor."""

    def run(docs: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        names = [part.split(" ")[0] for part in _SENDING.split(", ")]
        if not len(told) or not len(docs):
            return pd.DataFrame({c: [] for c in names})
        value = _joined(told["value"], "<u8")
        anchor = _joined(told["anchor"], "<u8")
        kind = np.repeat(told["kind"].to_numpy("u1"), [len(x) // 8 for x in told["value"]])
        known, at = np.unique(mix(value) ^ anchor, return_index=True)
        sent = np.zeros(len(known), bool)
        texts, rows, home = _bytes(docs["text"]), [], int(docs["home"].iloc[0])
        for a, b in slices(texts):
            found = Regions(texts[a:b], length, gram)
            key = mix(found.value) ^ found.anchor
            place = np.minimum(np.searchsorted(known, key), len(known) - 1)
            hit = np.flatnonzero(known[place] == key)
            # one region of a class is enough
            _, first = np.unique(place[hit], return_index=True)
            hit = hit[first]
            hit = hit[~sent[place[hit]]]
            sent[place[hit]] = True
            bucket = (found.anchor[hit] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            hit, bucket = hit[order], bucket[order]
            size = found.end[hit] - found.start[hit]
            for cut, stop in zip(f := _firsts(bucket), np.r_[f[1:], len(bucket)], strict=True):
                some = hit[cut:stop]
                blob = b"".join(found.data[s:e].tobytes() for s, e in zip(found.start[some], found.end[some], strict=True))
                rows.append((
                    int(bucket[cut]), home, found.anchor[some].tobytes(), found.value[some].tobytes(),
                    kind[at[place[some]]].tobytes(), (found.place[some] - found.start[some]).astype("<i4").tobytes(),
                    size[cut:stop].astype("<i4").tobytes(), blob,
                ))
        return pd.DataFrame(rows, columns=names)

    return run


_SPANS = "home int, anchor binary, value binary, start binary, stop binary"


def _sort(length: int, gram: int, block: int):
    """For the regions that asked, which of their strings another region of their group has, as spans of bytes."""
    side = length - gram
    deep = side // block

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        anchor, value = (_joined(pdf[c], "<u8") for c in ("anchor", "value"))
        kind, before, size = (_joined(pdf[c], k) for c, k in (("kind", "u1"), ("before", "<i4"), ("size", "<i4")))
        home = np.repeat(pdf["home"].to_numpy(), [len(x) for x in pdf["kind"]])
        data = np.frombuffer(b"".join(pdf["data"]), np.uint8)
        begin = np.cumsum(size, dtype=np.int64) - size
        mid = begin + before
        _, group = np.unique(anchor, return_inverse=True)
        rolling = Rolling(data.astype(np.uint64) + np.uint64(1))
        left = np.minimum(before // block, deep)
        right = np.minimum((size - before - gram) // block, deep)
        # symbols of a region: blocks before the anchor, the anchor, blocks after it, an end of its own
        number = left + right + 2
        region = np.repeat(np.arange(len(size)), number)
        column = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number) - left[region]
        is_end = column == right[region] + 1
        start = np.where(column < 0, mid[region] + column * block, mid[region] + gram + (column - 1) * block)
        start[column == 0] = 0
        real = (column != 0) & ~is_end
        content = np.zeros(len(region), np.uint64)
        content[real] = rolling.ranges(start[real], start[real] + block)
        content[is_end] = region[is_end].astype(np.uint64)
        key = mix(content + mix(group[region].astype(np.uint64) * np.uint64(1024) + (column + 512).astype(np.uint64)))
        key[is_end] = mix(np.uint64(1 << 63) + region[is_end].astype(np.uint64))
        _, symbol = np.unique(key, return_inverse=True)
        order = np.array(suffix_array([*(symbol + 1).tolist(), 0]))[1:]
        # strings with an anchor span `deep` symbols besides it, or one less where blocks do not meet their ends
        padded = np.r_[symbol, np.full(deep + 1, -1)]
        same = np.ones(len(order) - 1, bool)
        for step in range(deep):
            same &= padded[order[1:] + step] == padded[order[:-1] + step]
        near = np.zeros(len(order), bool)
        near[order[1:][same]] = near[order[:-1][same]] = True
        near &= (column <= 0)
        some = np.flatnonzero(near)
        # the strings that begin in the block before such a suffix, or right at it
        r = np.repeat(region[some], block)
        back = np.repeat(-column[some] * block, block) + np.tile(np.arange(block), len(some))
        fits = (back <= before[r]) & (back <= side) & (mid[r] - back + length <= begin[r] + size[r])
        r, back = r[fits], back[fits]
        text = rolling.ranges(mid[r] - back, mid[r] - back + length)
        tag = mix(text + mix(group[r].astype(np.uint64) * np.uint64(1024) + back.astype(np.uint64)))
        _, which, often = np.unique(tag, return_inverse=True, return_counts=True)
        hit = (often[which] > 1) & (kind[r] == _ASKED)
        r, back = r[hit], back[hit]
        order = np.lexsort((-back, r))
        r, at = r[order], (before[r] - back)[order]
        cut = np.r_[True, (r[1:] != r[:-1]) | (np.diff(at) > length)] if len(r) else np.zeros(0, bool)
        first = np.flatnonzero(cut)
        last = np.r_[first[1:], len(r)] - 1 if len(first) else first
        owner = r[first]
        spans = [anchor[owner], value[owner], at[first].astype("<i4"), (at[last] + length).astype("<i4")]
        return pd.DataFrame(list(_packed(home[owner], spans)), columns=["home", "anchor", "value", "start", "stop"])

    return run


def _cut(length: int, gram: int):
    """Texts of a bucket of documents without the spans that were found."""

    def run(docs: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        texts = _bytes(docs["text"])
        value, anchor = _joined(told["value"], "<u8"), _joined(told["anchor"], "<u8")
        start, stop = _joined(told["start"], "<i4"), _joined(told["stop"], "<i4")
        key = mix(value) ^ anchor
        order = np.argsort(key, kind="stable")
        key, start, stop = key[order], start[order], stop[order]
        kept, sizes, removed, spans = [], [], [], []
        for a, b in slices(texts):
            found = Regions(texts[a:b], length, gram)
            gone = np.zeros(found.begins[-1] + 1, np.int64)
            own = mix(found.value) ^ found.anchor
            low, high = (np.searchsorted(key, own, side=s) for s in ("left", "right"))
            n = high - low
            which = np.repeat(np.arange(len(own)), n)
            at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
            begin = found.start[which] + start[at]
            # a stop of 0 means the end of the region
            end = np.where(stop[at] == 0, found.end[which], found.start[which] + stop[at])
            np.add.at(gone, begin, 1)
            np.add.at(gone, end, -1)
            lost = np.cumsum(gone)[:-1] > 0
            for i in range(b - a):
                s, e = found.begins[i], found.begins[i + 1]
                part, text = lost[s:e], texts[a + i]
                count = int(part.sum())
                kept.append(text if not count else np.frombuffer(text, np.uint8)[~part].tobytes())
                sizes.append(len(text))
                removed.append(count)
                spans.append(int((part[1:] & ~part[:-1]).sum() + part[:1].sum()))
        out = docs.drop(columns=["home", "text"])
        return out.assign(kept=kept, n_bytes=sizes, n_removed=removed, n_spans=spans)

    return run


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK) -> DataFrame:
    """`docs` without texts, and with the bytes that are left of each (`kept`, binary), `n_bytes`, `n_removed` and
    `n_spans`, the number of runs removed. Other columns pass through; those with the names of results are replaced."""
    spark = docs.sparkSession
    docs = docs.drop("kept", "n_bytes", "n_removed", "n_spans").withColumn("text", F.col("text").cast("string"))
    own, aside = next((c for c in docs.columns if c.lower() == "home"), "home"), spare(docs, "home")
    docs = docs.withColumnRenamed("home", aside)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES))
    # rows with one id, and rows without, spread by their text
    rows = docs.withColumn("home", F.pmod(F.xxhash64("doc_id", F.octet_length("text"), F.substring("text", 1, 64)), F.lit(buckets)).cast("int"))
    short = rows.select("text", "home").where(F.octet_length("text") >= length)
    entries = short.mapInPandas(_find(length, gram, buckets), _ENTRY)
    told = stage(entries.groupBy("bucket").applyInPandas(_judge, _TOLD), "suffixes-told")
    asked = told.where(F.col("kind") != _FULL)
    sent = short.groupBy("home").cogroup(asked.groupBy("home")).applyInPandas(_send(length, gram, buckets), _SENDING)
    spans = stage(sent.groupBy("bucket").applyInPandas(_sort(length, gram, block), _SPANS), "suffixes-spans")
    zeros = F.unhex(F.repeat(F.lit("00000000"), (F.octet_length("value") / 8).cast("int")))
    full = told.where(F.col("kind") == _FULL).select("home", "anchor", "value", zeros.alias("start"), zeros.alias("stop"))
    marks = full.unionByName(spans)
    kept = [f for f in rows.schema.fields if f.name not in ("text", "home")]
    schema = ", ".join(
        [*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "kept binary, n_bytes long, n_removed long, n_spans long"]
    )
    done = rows.groupBy("home").cogroup(marks.groupBy("home")).applyInPandas(_cut(length, gram), schema)
    return done.withColumnRenamed(aside, own)


def digests(docs: DataFrame) -> DataFrame:
    """Per document its size, what was removed in how many runs, and a digest of the bytes that are left."""
    done = dedup(docs.select("doc_id", "text"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
