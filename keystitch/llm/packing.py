"""Best-fit packing of documents into training sequences of several permitted lengths.

Documents are dealt by hash into blocks of a bounded number of pieces, and each block is packed by itself, longest
piece first, into the open bin with the least room that still takes it. Which size to open is settled for a block as
a whole: each permitted length is tried as the least size to open, every bin is cut down in the end to the smallest
permitted length that holds its contents, and the way with the least total cost is kept.

Defined cases: a document longer than the largest length is split into pieces of that length and a rest. A document
without content is a piece of length 0, which fits into any bin, so every row is in some sequence. Rows with a null
id, repeated rows and repeated ids are packed like any others. An empty table gives no sequences.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keystitch.sources.tables import stage

LENGTHS = (512, 1024, 2048, 4096)
#: Cost of a sequence besides its length: a start token, and the fixed share of a training step.
OVERHEAD = 16
BLOCK_PIECES = 20_000


def cost(length: int) -> float:
    """Cost of a sequence: its length, attention growing with the square, and what each sequence costs anyway."""
    return length + length * length / 65536 + OVERHEAD


def best_fit(sizes: list[int], lengths: tuple[int, ...], least: int) -> list[list[int]]:
    """Bins of indexes of `sizes`, which descend. A new bin is the smallest length from `least` that takes the piece."""
    bins: list[list[int]] = []
    rooms: list[int] = []
    with_room: dict[int, list[int]] = {}
    for i, size in enumerate(sizes):
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            stack = with_room[room]
            chosen = stack.pop()
            if not stack:
                del with_room[room], rooms[at]
        else:
            room, chosen = next(n for n in lengths if n >= max(size, least)), len(bins)
            bins.append([])
        bins[chosen].append(i)
        left = room - size
        if left in with_room:
            with_room[left].append(chosen)
        else:
            with_room[left] = [chosen]
            insort(rooms, left)
    return bins


def cut_down(used: int, lengths: tuple[int, ...]) -> int:
    return next(n for n in lengths if n >= used)


def pack_block(
    sizes: list[int], lengths: tuple[int, ...], price: Callable[[int], float]
) -> list[tuple[int, list[int]]]:
    """Length and contents of each bin, for the opening size that costs least in the end; ties to the smaller one."""

    def packed(least: int) -> list[tuple[int, list[int]]]:
        bins = best_fit(sizes, lengths, least)
        return [(cut_down(sum(sizes[i] for i in b), lengths), b) for b in bins]

    return min(map(packed, lengths), key=lambda bins: sum(price(n) for n, _ in bins))


def pack(
    items: DataFrame,
    lengths: tuple[int, ...] = LENGTHS,
    price: Callable[[int], float] = cost,
    block_pieces: int = BLOCK_PIECES,
) -> DataFrame:
    """Sequences of `items` (doc_id, n): sequence, length, used, doc_ids, and pieces (doc_id, start, n) in order."""
    lengths = tuple(sorted(lengths))
    longest = lengths[-1]
    length = F.greatest(F.coalesce(F.col("n").cast("long"), F.lit(0)), F.lit(0))
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(length - 1, F.lit(0)), F.lit(longest).cast("long"))
    pieces = items.select(F.col("doc_id").cast("long"), length.alias("n"), F.explode(starts).alias("start"))
    pieces = pieces.select(
        "doc_id",
        "start",
        F.least(F.col("n") - F.col("start"), F.lit(longest)).cast("int").alias("n"),
        # rows with one id or none still spread; the staged rows keep the value whatever happens later
        F.xxhash64("doc_id", "start", F.monotonically_increasing_id()).alias("at"),
    )
    pieces = stage(pieces, "pack-pieces")
    blocks = max(1, -(-pieces.count() // block_pieces))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n", "doc_id", "start", "at"], ascending=[False, True, True, True])
        ids = [None if pd.isna(x) else int(x) for x in pdf["doc_id"]]
        start, n, block = pdf["start"].tolist(), pdf["n"].tolist(), int(pdf["block"].iloc[0])
        rows = [
            (
                f"{block}-{number}",
                bin_length,
                sum(n[i] for i in members),
                [ids[i] for i in members],
                [{"doc_id": ids[i], "start": start[i], "n": n[i]} for i in members],
            )
            for number, (bin_length, members) in enumerate(pack_block(n, lengths, price))
        ]
        return pd.DataFrame(rows, columns=["sequence", "length", "used", "doc_ids", "pieces"])

    schema = (
        "sequence string, length int, used int, doc_ids array<bigint>, "
        "pieces array<struct<doc_id: bigint, start: bigint, n: int>>"
    )
    return pieces.withColumn("block", F.pmod("at", F.lit(blocks))).groupBy("block").applyInPandas(run, schema)


def words(text: str = "text") -> Column:
    """Number of words of a text; null counts as none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))


def pack_documents(docs: DataFrame) -> DataFrame:
    """Sequences of whole documents, measured in words."""
    return pack(docs.select("doc_id", words().alias("n")))
