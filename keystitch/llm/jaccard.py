"""Join of documents whose sets of word n-grams have a Jaccard similarity of at least `percent` per cent.

Documents with the same set are one class and travel as one. Candidates come from a partition of the tokens: the set
of a class is dealt into K parts by hash, where K is more than the number of tokens in which two similar sets of
such sizes can differ, so similar sets have a part in common, token for token. Among the classes that share a part,
sketches bound each overlap from above: a sketch counts how many tokens of a set fall into each of some bins. Classes that may reach the threshold are linked loosely, and the components of these links are
the groups. Similar documents thus share a group, which is dealt into blocks of bounded size.

A part without tokens says nothing and would bring unrelated sets together. There are some parts more than sets can
differ in, so a set with fewer empty parts than that still shares another one with each similar set, and does not show
its empty ones.

A block is a column of the token-group matrix: its members and the union of their tokens. Of a pair of blocks of one
group, which meet alone, only members whose overlap with the union of the other block can reach the threshold are compared, and these
exactly, all at once over the tokens that both blocks have. What leaves a pair of blocks is the number of links of each
member and a star for each component, never the pairs.

Defined cases: A-Z count as a-z. A text with fewer words than n is one token, its whole sequence. Texts that are null
or without words have no tokens, are linked with nothing, and are components of their own, as are rows without an
id. Of several rows with one id each takes part; links of any of them hold for the id, which joins their components,
and the number of links is the largest of theirs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystitch.llm.hashing import Rolling, Words, mix, text_slices
from keystitch.llm.rows import small
from keystitch.llm.substrings import _joined, _packed
from keystitch.sources.tables import TEXT_ROWS, stage

WORDS, PERCENT = 3, 90
#: Members of a block and their tokens, on average; a larger group is several blocks.
BLOCK_MEMBERS, BLOCK_TOKENS = 256, 500_000
#: Bins of a sketch, for sets below LARGE tokens and above.
BINS, LARGE, LARGE_BINS = 64, 1024, 512
#: Groups of parts a task works on one after the other, so that it holds few sketches at a time.
NEAR_BUCKETS = 8
#: Bytes of text that become tokens at a time.
SLICE_BYTES = 500_000
#: Tokens of two blocks that are counted at a time.
COLUMNS = 8192


def bands(largest: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower ends of bands of set sizes, such that similar sets lie in one band or in neighbouring ones, and for pairs
    of a band with itself or the next one the number of tokens they can differ in and the number of parts."""
    low, differ = [1], []
    while True:
        high = low[-1] * 100 // percent
        together = high + high * 100 // percent
        differ.append((100 - percent) * together // (100 + percent))
        if high >= largest:
            return np.array(low), np.array(differ), np.array([d + 2 + d // 8 for d in differ])
        low.append(high + 1)


class Sets:
    """Distinct tokens of several documents in a row, ordered by document and value."""

    def __init__(self, texts: list[bytes], n: int):
        words = Words([t.lower() for t in texts])
        place = np.flatnonzero(words.whole(n))
        doc, token = words.doc[place], words.windows(n)[place] if len(place) else np.zeros(0, np.uint64)
        few = np.flatnonzero((words.counts > 0) & (words.counts < n))
        if len(few):
            ends = np.cumsum(words.counts)
            short = Rolling(words.value).ranges(ends[few] - words.counts[few], ends[few])
            doc, token = np.r_[doc, few], np.r_[token, short]
        order = np.lexsort((token, doc))
        doc, token = doc[order], token[order]
        new = np.r_[True, (doc[1:] != doc[:-1]) | (token[1:] != token[:-1])] if len(doc) else np.zeros(0, bool)
        self.doc, self.token = doc[new], token[new]
        self.size = np.bincount(self.doc, minlength=len(texts))

    def classes(self) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of each set."""
        one, two = (np.zeros(len(self.size), np.uint64) for _ in range(2))
        np.add.at(one, self.doc, mix(self.token))
        np.add.at(two, self.doc, mix(self.token ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
        return mix(one + self.size.astype(np.uint64)), mix(two)

    def parts(self, doc_slot: np.ndarray, number: np.ndarray, spare: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Document and hash of each part, where the set of a document is dealt into its `number` of parts; without the
        empty ones where these are fewer than `spare`."""
        begins = np.cumsum(number) - number
        key = begins[self.doc] + ((self.token >> np.uint64(17)) % number[self.doc].astype(np.uint64)).astype(np.int64)
        value = np.zeros(number.sum(), np.uint64)
        np.add.at(value, key, mix(self.token))
        doc = np.repeat(np.arange(len(number)), number)
        within = (np.arange(len(doc)) - begins[doc]).astype(np.uint64)
        value = mix(value ^ mix((doc_slot[doc].astype(np.uint64) << np.uint64(32)) + within + np.uint64(1)))
        empty = np.bincount(key, minlength=len(doc)) == 0
        show = ~empty | (np.bincount(doc[empty], minlength=len(number)) >= spare)[doc]
        return doc[show], value[show]


def _sketches(sets: Sets) -> list[bytes]:
    """For each set how many tokens fall into each bin; bytes of 255 where one bin holds as many."""
    bins = np.where(sets.size < LARGE, BINS, LARGE_BINS)
    begins = np.cumsum(bins) - bins
    at = begins[sets.doc] + (sets.token % bins[sets.doc].astype(np.uint64)).astype(np.int64)
    counts = np.bincount(at, minlength=int(bins.sum()))
    full = np.maximum.reduceat(counts, begins) >= 255 if len(begins) else np.zeros(0, bool)
    counts[np.repeat(full, bins)] = 255
    counts = counts.astype("u1")
    return [counts[s : s + k].tobytes() for s, k in zip(begins, bins, strict=True)]


def _describe(n: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a, b, texts in text_slices(pdf["text"], SLICE_BYTES):
                sets = Sets(texts, n)
                one, two = (x.view("i8") for x in sets.classes())
                yield pd.DataFrame(
                    {"doc_id": pdf["doc_id"].array[a:b], "n_shingles": sets.size, "one": one, "two": two, "sketch": _sketches(sets)}
                )

    return run


def _sign(n: int, percent: int, buckets: int):
    """Packed parts: hash and class, by bucket of the hash. Classes that a slice has twice are sent once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a, b, texts in text_slices(pdf["text"], SLICE_BYTES):
                sets = Sets(texts, n)
                one = sets.classes()[0]
                first = np.zeros(b - a, bool)
                first[np.unique(one, return_index=True)[1]] = True
                low, differ, parts = bands(int(sets.size.max(initial=1)), percent)
                band = np.searchsorted(low, sets.size, side="right") - 1
                rows = []
                for lower in (0, 1):
                    slot = np.maximum(band - lower, 0)
                    number = np.where(first & (sets.size > 0) & (band >= lower), parts[slot], 0)
                    keep = number[sets.doc] > 0
                    some = Sets.__new__(Sets)
                    some.doc, some.token, some.size = sets.doc[keep], sets.token[keep], sets.size
                    doc, value = some.parts(slot, number, number - differ[slot])
                    bucket = (value % np.uint64(buckets)).astype(np.int64)
                    rows += _packed(bucket, [value, one[doc]])
                yield pd.DataFrame(rows, columns=["bucket", "value", "class"])

    return run


def _shared(pdf: pd.DataFrame) -> pd.DataFrame:
    """Parts that several classes have, once for each class."""
    value, owner = _joined(pdf["value"], "<u8"), _joined(pdf["class"], "<u8")
    order = np.lexsort((owner, value))
    value, owner = value[order], owner[order]
    if not len(value):
        return pd.DataFrame({"class": [], "part": []})
    new = np.r_[True, (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])]
    value, owner = value[new], owner[new]
    first = np.flatnonzero(np.r_[True, value[1:] != value[:-1]])
    size = np.diff(np.r_[first, len(value)])
    keep = np.repeat(size, size) > 1
    return pd.DataFrame({"class": owner[keep].view("i8"), "part": value[keep].view("i8")})


def _opened(sketches: bytes) -> np.ndarray:
    """Counts of sketches; what stands for too many bounds nothing."""
    counts = np.frombuffer(sketches, "u1").astype(np.int32)
    counts[counts == 255] = 1 << 20
    return counts


def _near(percent: int):
    """Stars of classes that share a part and whose sketches allow a link, for the parts of a bucket."""

    def reach(bound, a, b):
        return 100 * bound >= percent * (a + b - bound)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["part", "size", "class"])
        part, size, owner = (pdf[c].to_numpy() for c in ("part", "size", "class"))
        _, first, slot = np.unique(owner, return_index=True, return_inverse=True)
        raw = pdf["sketch"].iloc[first].tolist()
        del pdf
        large = [i for i, x in enumerate(raw) if len(x) > BINS]
        sketches = {i: _opened(raw[i]) for i in large}
        folded = np.zeros((len(raw), BINS), np.int32)
        rest = np.setdiff1d(np.arange(len(raw)), large)
        folded[rest] = _opened(b"".join(raw[i] for i in rest)).reshape(-1, BINS)
        for i, x in sketches.items():
            folded[i] = x.reshape(-1, BINS).sum(0)
        del raw
        edges = []
        at, apart = np.arange(len(part)), 1
        # each class against those of its part that follow at one distance after the other, while sizes are close
        while True:
            at = at[at + apart < len(part)]
            to = at + apart
            close = (part[at] == part[to]) & reach(size[at], size[at], size[to])
            at, to = at[close], to[close]
            if not len(at):
                break
            for begin in range(0, len(at), 1 << 16):
                i, j = at[begin : begin + (1 << 16)], to[begin : begin + (1 << 16)]
                ok = reach(np.minimum(folded[slot[i]], folded[slot[j]]).sum(1, dtype=np.int64), size[i], size[j])
                for t in np.flatnonzero(ok & (size[i] >= LARGE) & (size[j] >= LARGE)).tolist():
                    closer = np.minimum(sketches[int(slot[i[t]])], sketches[int(slot[j[t]])]).sum(dtype=np.int64)
                    ok[t] = reach(closer, size[i[t]], size[j[t]])
                edges.append((slot[i[ok]], slot[j[ok]]))
            apart += 1
        if not edges:
            return pd.DataFrame({"u": [], "v": []})
        x, y = (np.concatenate(e) for e in zip(*edges, strict=True))
        ids, label = owner[first], _stars(x, y, len(first))
        met = np.unique(np.r_[x, y])
        return pd.DataFrame({"u": ids[met], "v": ids[label[met]]})

    return run


def _tokens(n: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a, b, texts in text_slices(pdf["text"], SLICE_BYTES):
                sets = Sets(texts, n)
                ends = np.cumsum(sets.size)
                tokens = [sets.token[e - s : e].tobytes() for e, s in zip(ends, sets.size, strict=True)]
                rows = pdf.iloc[a:b].drop(columns="text").assign(size=sets.size, tokens=tokens)
                # another row with the id of the class's first row may have another set
                yield rows[sets.classes()[0].view("i8") == rows["class"].to_numpy()]

    return run


def _block(pdf: pd.DataFrame) -> pd.DataFrame:
    # the row of a class may be repeated
    pdf = pdf.sort_values("class").drop_duplicates("class")
    tokens = _joined(pdf["tokens"], "<u8")
    union = np.unique(tokens)
    at = np.searchsorted(union, tokens).astype("<i4")
    row = [pdf["block"].iloc[0], *(pdf[c].to_numpy("<i8").tobytes() for c in ("class", "copies", "size"))]
    return pd.DataFrame([[*row, at.tobytes(), union.tobytes()]], columns=["block", "keys", "copies", "sizes", "at", "union"])


class _Block:
    def __init__(self, keys: bytes, copies: bytes, sizes: bytes, at: bytes, union: bytes):
        self.keys, self.copies, self.sizes = (np.frombuffer(x, "<i8") for x in (keys, copies, sizes))
        self.at, self.union = np.frombuffer(at, "<i4"), np.frombuffer(union, "<u8")
        self.member = np.repeat(np.arange(len(self.keys), dtype=np.int32), self.sizes)

    def only(self, column: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Member and column of the tokens that `column` (a place or -1 for each token of the union) keeps."""
        place = column[self.at]
        keep = (place >= 0) & members[self.member]
        return self.member[keep], place[keep]


def _overlaps(a: _Block, b: _Block, percent: int) -> np.ndarray:
    """Sizes of the intersections of members of `a` and `b`; 0 where the union of the other block rules a link out."""
    both = np.intersect1d(a.union, b.union, assume_unique=True)
    columns, able = [], []
    for x in (a, b):
        column = np.full(len(x.union), -1, np.int32)
        column[np.searchsorted(x.union, both)] = np.arange(len(both), dtype=np.int32)
        columns.append(column)
        bound = np.bincount(x.member[column[x.at] >= 0], minlength=len(x.keys))
        able.append(100 * bound >= percent * x.sizes)
    out = np.zeros((len(a.keys), len(b.keys)), np.int64)
    if not (able[0].any() and able[1].any()):
        return out
    (ma, ca), (mb, cb) = (x.only(c, k) for x, c, k in zip((a, b), columns, able, strict=True))
    # tokens that only one of two equal blocks' members has do not count in any pair
    if a is b:
        common = np.bincount(ca, minlength=len(both)) > 1
    else:
        common = (np.bincount(ca, minlength=len(both)) > 0) & (np.bincount(cb, minlength=len(both)) > 0)
    rank = np.cumsum(common, dtype=np.int32) - 1
    (ma, ca), (mb, cb) = ((m[common[c]], rank[c[common[c]]]) for m, c in ((ma, ca), (mb, cb)))
    for begin in range(0, int(common.sum()), COLUMNS):
        sides = []
        for m, c, number in ((ma, ca, len(a.keys)), (mb, cb, len(b.keys))):
            inside = (c >= begin) & (c < begin + COLUMNS)
            side = np.zeros((number, COLUMNS), np.float32)
            side[m[inside], c[inside] - begin] = 1
            sides.append(side)
        out += (sides[0] @ sides[1].T).astype(np.int64)
    return out


def _stars(rows: np.ndarray, columns: np.ndarray, number: int) -> np.ndarray:
    """Least member of the component of each of `number` members, given edges."""
    label = np.arange(number)
    while len(rows):
        before = label.copy()
        np.minimum.at(label, rows, before[columns])
        np.minimum.at(label, columns, before[rows])
        label = label[label]
        if np.array_equal(before, label):
            break
    return label


def _compare(percent: int):
    """Links of each member of a pair of blocks, or of one block with itself, counted in documents, and the head of its
    component in the pair."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sides = [_Block(*row) for row in pdf[["keys", "copies", "sizes", "at", "union"]].itertuples(index=False)]
        a, b, same = sides[0], sides[-1], len(sides) == 1
        met = _overlaps(a, b, percent)
        linked = (met > 0) & (100 * met >= percent * (a.sizes[:, None] + b.sizes[None, :] - met))
        if same:
            np.fill_diagonal(linked, False)
        x, y = np.nonzero(linked)
        keys = a.keys if same else np.r_[a.keys, b.keys]
        n = linked @ b.copies if same else np.r_[linked @ b.copies, linked.T @ a.copies]
        order = np.argsort(keys, kind="stable")
        place = np.argsort(order)
        label = _stars(place[x], place[y if same else y + len(a.keys)], len(keys))
        head = keys[order][label][place]
        keep = n > 0
        return pd.DataFrame({"class": keys[keep], "head": head[keep], "n": n[keep]})

    return run


def components(edges: DataFrame) -> DataFrame:
    """node and component (its least node) of the nodes of `edges` (u, v), by large and small stars in turn.

    Each turn hangs neighbours on the least node they know; degrees are reduced before they are shuffled, and each
    turn is written, so lineage stays short.
    """
    edges = stage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    known = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        large = stage(large, "edges")
        head = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(head, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            head.select("u", F.col("m").alias("v"))
        )
        edges = stage(small.where("u <> v").distinct(), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == known:
            heads = edges.select(F.col("v").alias("u"), "v")
            nodes = edges.unionByName(heads).groupBy("u").agg(F.min("v").alias("component"))
            return nodes.withColumnRenamed("u", "node")
        known = state


def join(docs: DataFrame, n: int = WORDS, percent: int = PERCENT, block_members: int = BLOCK_MEMBERS) -> DataFrame:
    """doc_id, n_shingles, class_id (least id with the same set), n_links and component_id of every document."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    narrow = stage(
        docs.mapInPandas(_describe(n), "doc_id long, n_shingles long, one long, two long, sketch binary"),
        "jaccard-sets",
        TEXT_ROWS,
    )
    taking = narrow.where("n_shingles > 0 and doc_id is not null")
    first = F.min(F.struct("doc_id", "n_shingles", "sketch")).alias("first")
    classes = taking.groupBy("one", "two").agg(first, F.count("*").alias("copies"))
    classes = classes.select("one", "two", "first.*", "copies").withColumnRenamed("doc_id", "rep")
    classes = stage(classes.withColumnRenamed("n_shingles", "size"), "jaccard-classes")
    narrow = narrow.drop("sketch")
    whole = docs.where("doc_id is not null")
    signed = whole.mapInPandas(_sign(n, percent, buckets), "bucket int, value binary, class binary")
    shared = stage(signed.groupBy("bucket").applyInPandas(_shared, "class long, part long"), "jaccard-parts", TEXT_ROWS)

    def blocks_of(home: DataFrame) -> DataFrame:
        """class and block of `home` (class, grp): members of a group are dealt into blocks by hash."""
        number = F.greatest(F.count("*") / block_members, F.sum("size") / BLOCK_TOKENS)
        sizes = classes.select(F.col("one").alias("class"), "size")
        count = home.join(sizes, "class").groupBy("grp").agg(F.ceil(number).alias("blocks"))
        sub = F.pmod(F.xxhash64("class"), F.col("blocks"))
        return home.join(count, "grp").select("class", "grp", F.xxhash64("grp", sub).alias("block"))

    def pairs_of(members: DataFrame) -> DataFrame:
        """Each pair of different blocks that stand together in a row of `members` (blocks), once."""
        pairs = members.select(F.explode("blocks").alias("a"), "blocks").select("a", F.explode("blocks").alias("b"))
        return stage(pairs.where(F.col("a") < F.col("b")).distinct(), "jaccard-pairs")

    def met(pairs: DataFrame, blocks: DataFrame) -> DataFrame:
        """Each block with itself, and the blocks of each pair; a row each, grouped by (a, b)."""
        sides = F.explode(F.array("a", "b")).alias("block")
        return blocks.select(F.col("block").alias("a"), F.col("block").alias("b"), "*").unionByName(
            pairs.select("a", "b", sides).join(blocks, "block")
        )

    owners = classes.select(F.col("one").alias("class"), "size", "sketch")
    sketched = shared.join(owners, "class").withColumn("bucket", F.pmod(F.xxhash64("part"), F.lit(NEAR_BUCKETS * buckets)))
    near = stage(sketched.groupBy("bucket").applyInPandas(_near(percent), "u long, v long"), "jaccard-near")
    # a link joins classes of one component of those that may be linked
    home = components(near).select(F.col("node").alias("class"), F.col("component").alias("grp"))
    home = stage(blocks_of(home), "jaccard-home")
    pairs = pairs_of(home.groupBy("grp").agg(F.array_sort(F.collect_set("block")).alias("blocks")))
    reps = home.join(classes, F.col("class") == F.col("one"))
    reps = stage(reps.select(F.col("rep").alias("doc_id"), "block", "copies", "class"), "jaccard-reps")
    tokens = whole.join(small(reps), "doc_id").mapInPandas(
        _tokens(n), "doc_id long, block long, copies long, class long, size long, tokens binary"
    )
    blocks = stage(
        tokens.groupBy("block").applyInPandas(
            _block, "block long, keys binary, copies binary, sizes binary, at binary, union binary"
        ),
        "jaccard-blocks",
        TEXT_ROWS,
    )
    compared = met(pairs, blocks).groupBy("a", "b").applyInPandas(_compare(percent), "class long, head long, n long")
    links = stage(compared, "jaccard-links")
    # ids that have several sets join what these are linked with
    several = taking.groupBy("doc_id").agg(F.min("one").alias("v"), F.max("one").alias("last")).where("v <> last")
    several = small(stage(several.select("doc_id", "v"), "jaccard-several"))
    same_id = taking.join(several, "doc_id").select(F.col("one").alias("u"), "v")
    found = components(links.select(F.col("class").alias("u"), F.col("head").alias("v")).unionByName(same_id))
    heads = found.join(classes, F.col("node") == F.col("one"))
    heads = heads.groupBy("component").agg(F.min("rep").alias("least"))
    found = found.join(heads, "component").select("node", F.col("least").alias("component"))
    counted = links.groupBy("class").agg(F.sum("n").alias("n"))
    described = classes.join(counted, F.col("one") == F.col("class"), "left").drop("class")
    described = described.join(found, F.col("one") == F.col("node"), "left").select(
        "one", "two", "rep", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("links"), "component"
    )
    largest = taking.join(several, "doc_id").join(described, ["one", "two"]).groupBy("doc_id").agg(F.max("links").alias("most"))
    largest = small(stage(largest, "jaccard-largest"))
    own = narrow.join(described, ["one", "two"], "left").join(largest, "doc_id", "left")
    own = own.withColumn("links", F.coalesce("most", "links"))
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    return own.select(
        "doc_id",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("rep")).alias("class_id"),
        F.when(alone, F.lit(0)).otherwise(F.col("links")).cast("long").alias("n_links"),
        F.when(alone, F.col("doc_id")).otherwise(F.coalesce("component", "rep")).alias("component_id"),
    )


def linked(docs: DataFrame) -> DataFrame:
    """The set size, component, class and number of links of every document."""
    return join(docs).select("doc_id", "n_shingles", "component_id", "class_id", "n_links")


LINKED_SQL = r"""
with recursive w as (
    select doc_id, list_filter(
        regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws
    from documents
), token as materialized (
    select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 3 then [ws]
        else list_transform(range(1, len(ws) - 1), lambda i: list_slice(ws, i, i + 2)) end) as t from w
), size as materialized (
    select w.doc_id, count(t) as n, coalesce(list_sort(list(hash(t)) filter (t is not null))::varchar, '') as whole
    from w left join token using (doc_id) group by w.doc_id
), met as (
    select a.doc_id as x, b.doc_id as y, count(*) as n from token a join token b on a.t = b.t and a.doc_id <> b.doc_id
    group by a.doc_id, b.doc_id
), link as materialized (
    select x, y from met join size s on s.doc_id = x join size r on r.doc_id = y
    where 100 * met.n >= 90 * (s.n + r.n - met.n)
), reach as (
    select doc_id as x, doc_id as y from size union select reach.x, link.y from reach join link on link.x = reach.y
), least as (
    select x, min(y) as component_id from reach group by x
), same as (
    select doc_id, case when n = 0 then doc_id else min(doc_id) over (partition by whole) end as class_id from size
)
select size.doc_id, n::bigint as n_shingles, component_id, class_id,
    (select count(*) from link where link.x = size.doc_id) as n_links
from size join least on least.x = size.doc_id join same on same.doc_id = size.doc_id
"""
