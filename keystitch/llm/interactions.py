"""How the filters of a cleaning run interact: what each removes in every order they could be applied in.

Each document becomes one word of 32 bits, its truth table: bit S tells whether the document survives the set S of
filters. The table of a filter alone is a fixed word, so a document's word is the intersection of the words of the
filters it fails. Positional popcounts over the words of a part give the survivors of all 32 sets at once; they add up
words through a tree of carry-save adders, task by task, apart for documents that are labelled good or toxic. What a
filter removes at any step of any order is then a difference of two survivor counts.

The filter on copies fails for a document whose text a smaller id has too. Texts meet as SHA-256 digests; the least id
of a digest is found by a pre-aggregated minimum, and (digest, least id) are joined back, so copies never meet in one
group.

Defined cases: a null text is empty, a null language is the part ''. Rows without an id are never copies of others nor
have labels; each repeated row counts by itself, and rows with the same id are no copies of each other. A document is
good or toxic if any of its label rows says so. An empty table has no parts and no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keystitch.sources.tables import stage

#: Filters that fit a word of 32 bits.
MOST = 5
#: Parts a task adds up before it hands them on.
HELD_PARTS = 1 << 12
KINDS = ("all", "good", "toxic")
_SPACES = "\x20\t\n\x0b\x0c\r"


def text_filters() -> dict[str, Column]:
    """Failure conditions on the columns that `measured` adds."""
    chars, words, distinct = F.col("chars"), F.col("n_words"), F.col("n_distinct")
    return {
        "A": words < 200,
        "B": 100 * distinct < 50 * words,
        "C": 100 * F.col("capitals") > 3 * chars,
        "D": F.col("marked"),
    }


def measured(rows: DataFrame) -> DataFrame:
    """Add code points, words, distinct words, capitals and whether a mark occurs, all of the whole column `text`."""
    text = F.col("text")
    bare = F.btrim(text, F.lit(_SPACES))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))
    return rows.withColumn("words", words).select(
        *rows.columns,
        F.length(text).cast("long").alias("chars"),
        F.size("words").cast("long").alias("n_words"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))).cast("long").alias("capitals"),
        text.rlike(r"[#$%&*|]").alias("marked"),
    )


def truth(place: int, number: int) -> int:
    """Word of the sets without filter `place`: what a document that fails it can survive."""
    return sum(1 << s for s in range(1 << number) if not s >> place & 1)


def survival_word(fails: Sequence[Column]) -> Column:
    """The sets a document survives, given which filters it fails."""
    number = len(fails)
    whole = F.lit((1 << (1 << number)) - 1).cast("long")
    word = whole
    for place, failed in enumerate(fails):
        mine = F.lit(truth(place, number)).cast("long")
        word = word.bitwiseAND(F.when(F.coalesce(failed, F.lit(False)), mine).otherwise(whole))
    return word


def popcounts(words: np.ndarray) -> np.ndarray:
    """How many of the words have each of the 32 bits set.

    Full adders turn three words of a weight into a sum of that weight and a carry of the next one, for all threes at
    once; of each weight at most two words are left to be counted bit by bit.
    """
    total, weight, pending = np.zeros(32, np.int64), 1, words.astype(np.uint32)
    while len(pending):
        carries = []
        while len(pending) > 2:
            third = len(pending) // 3
            a, b, c = (pending[i * third : (i + 1) * third] for i in range(3))
            half = a ^ b
            carries.append((a & b) | (half & c))
            pending = np.concatenate([half ^ c, pending[3 * third :]])
        total += weight * ((pending[:, None] >> np.arange(32, dtype=np.uint32)) & 1).sum(0, dtype=np.int64)
        pending = np.concatenate(carries) if carries else pending[:0]
        weight *= 2
    return total


def _survivors(subsets: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, np.ndarray] = {}

        def out() -> pd.DataFrame:
            counts = np.array(list(held.values()))[:, :, :subsets]
            part = np.repeat(np.array(list(held), object), len(KINDS) * subsets)
            kind = np.tile(np.repeat(np.array(KINDS, object), subsets), len(held))
            subset = np.tile(np.arange(subsets), len(held) * len(KINDS))
            held.clear()
            return pd.DataFrame({"part": part, "kind": kind, "subset": subset, "n": counts.ravel()})

        for pdf in batches:
            for part, rows in pdf.groupby("part"):
                words = rows["word"].to_numpy()
                chosen = (words, words[rows["good"].to_numpy(bool)], words[rows["toxic"].to_numpy(bool)])
                held[part] = held.get(part, 0) + np.array([popcounts(w) for w in chosen])
            if len(held) > HELD_PARTS:
                yield out()
        if held:
            yield out()

    return run


def survivors(words: DataFrame, filters: int) -> DataFrame:
    """One row a part: for each kind of document the number of survivors of every set of filters, as an array."""
    counted = words.select("part", "word", "good", "toxic").mapInPandas(
        _survivors(1 << filters), "part string, kind string, subset int, n long"
    )
    summed = counted.groupBy("part", "kind", "subset").agg(F.sum("n").alias("n"))

    def of(kind: str) -> Column:
        entries = F.collect_list(F.when(F.col("kind") == kind, F.struct("subset", "n")))
        return F.transform(F.array_sort(entries), lambda x: x["n"]).alias(kind)

    return summed.groupBy("part").agg(*[of(k) for k in KINDS])


def interactions(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    """A row for each part, order of the filters and step, from the survivors of every set."""
    number, every = len(names), (1 << len(names)) - 1

    def shapley(place: int) -> Column:
        """Over all orders: the sets of filters that can stand before this one, each as often as it does."""
        mine, terms = 1 << place, []
        for s in range(1 << number):
            if not s & mine:
                before = s.bit_count()
                times = factorial(before) * factorial(number - 1 - before)
                terms.append(times * (F.col("all")[s] - F.col("all")[s | mine]))
        return sum(terms[1:], terms[0])

    orders = F.lit(["".join(p) for p in permutations(names)])
    rows = (
        counts.withColumn("shares", F.array(*[shapley(i) for i in range(number)]))
        .select("part", *KINDS, "shares", F.explode(orders).alias("filter_order"))
        .select("*", F.posexplode(F.lit(list(range(1, number + 1)))).alias("place", "step"))
    )
    letter = F.substr("filter_order", F.col("step"), F.lit(1))
    before = F.lit(0)
    for i, name in enumerate(names):
        earlier = F.instr(F.col("filter_order"), F.lit(name)) < F.col("step")
        before = before + F.when(earlier, 1 << i).otherwise(0)
    index = F.array_position(F.lit(list(names)), letter).cast("int") - 1
    rows = rows.select("*", before.alias("before"), index.alias("index"))
    bit = F.element_at(F.lit([1 << i for i in range(number)]), F.col("index") + 1)
    rows = rows.select("*", bit.alias("bit")).select("*", F.col("before").bitwiseOR(F.col("bit")).alias("after"))

    def at(kind: str, subset: Column) -> Column:
        return F.element_at(F.col(kind), (subset + 1).cast("int"))

    def removed(kind: str) -> Column:
        return at(kind, F.col("before")) - at(kind, F.col("after"))

    failing = at("all", F.lit(0)) - at("all", F.col("bit"))
    return rows.select(
        "part",
        "filter_order",
        F.col("step").cast("int").alias("step"),
        at("all", F.col("after")).alias("kept"),
        removed("all").alias("removed"),
        (failing - removed("all")).alias("redundant"),
        (at("all", F.lit(every) - F.col("bit")) - at("all", F.lit(every))).alias("unique_fails"),
        removed("good").alias("good_lost"),
        removed("toxic").alias("toxic_lost"),
        F.element_at("shares", F.col("index") + 1).alias("shapley"),
    )


def words_of(docs: DataFrame, labels: DataFrame, failing: Mapping[str, Column], copies: str | None) -> DataFrame:
    """part, word, good and toxic of every document; `copies` names the filter on texts that a smaller id has too."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    flags = [c.alias(f"fails_{name}") for name, c in failing.items()]
    facts = stage(measured(rows).select("doc_id", "part", digest.alias("digest"), *flags), "filter-facts")
    first = facts.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    firsts = first.withColumn("first", F.lit(True))
    said = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        *[F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(k) for c, k in (("quality", "good"), ("toxic", "toxic"))]
    )
    known = facts.join(firsts, ["digest", "doc_id"], "left").join(said, "doc_id", "left")
    fails = [F.col(f"fails_{name}") for name in failing]
    if copies:
        fails.append(F.col("doc_id").isNotNull() & F.col("first").isNull())
    marks = [F.coalesce(k, F.lit(False)).alias(k) for k in ("good", "toxic")]
    return known.select("part", survival_word(fails).alias("word"), *marks)


def audit(
    docs: DataFrame, labels: DataFrame, failing: Mapping[str, Column] | None = None, copies: str | None = "E"
) -> DataFrame:
    """The interactions of the filters `failing` (name of one letter, failure condition on the columns of `measured`)
    and of the filter on copies, in every part."""
    failing = text_filters() if failing is None else failing
    names = [*failing, *([copies] if copies else [])]
    if not 1 <= len(names) <= MOST or any(len(n) != 1 for n in names) or len(set(names)) < len(names):
        raise ValueError(f"one to {MOST} filters with different names of one letter")
    return interactions(survivors(words_of(docs, labels, failing, copies), len(names)), names)


AUDIT_SQL = r"""
with doc as (
    select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws
    from documents
), said as (
    select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
    from labels where doc_id is not null group by doc_id
), judged as (
    select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
        case when len(ws) < 200 then 'A' else '' end
        || case when 100 * len(list_distinct(ws)) < 50 * len(ws) then 'B' else '' end
        || case when 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t) then 'C' else '' end
        || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
        || case when doc.doc_id > min(doc.doc_id) over (partition by t) then 'E' else '' end as failed
    from doc left join said on said.doc_id = doc.doc_id
), pattern as (
    select part, failed, good, toxic, count(*) as n from judged group by all
), letter as (
    select unnest(['A', 'B', 'C', 'D', 'E']) as x
), orders as (
    select a.x || b.x || c.x || d.x || e.x as o from letter a, letter b, letter c, letter d, letter e
    where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), met as (
    select p.*, o, step, substr(o, step, 1) as f, contains(failed, substr(o, step, 1)) as fails,
        len(list_filter(string_split(failed, ''), lambda x: x <> '' and contains(substr(o, 1, step - 1), x))) > 0 as gone
    from pattern p, orders, (select unnest(range(1, 6)) as step)
), counted as (
    select part, o as filter_order, step::integer as step, any_value(f) as f,
        sum(case when not gone and not fails then n else 0 end)::bigint as kept,
        sum(case when not gone and fails then n else 0 end)::bigint as removed,
        sum(case when gone and fails then n else 0 end)::bigint as redundant,
        sum(case when failed = f then n else 0 end)::bigint as unique_fails,
        sum(case when not gone and fails then n * good else 0 end)::bigint as good_lost,
        sum(case when not gone and fails then n * toxic else 0 end)::bigint as toxic_lost
    from met group by part, o, step
)
select * exclude (f), (sum(removed) over (partition by part, f))::bigint as shapley from counted
"""
