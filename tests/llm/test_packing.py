"""Best-fit packing against a plain search for the best bin."""

import random

from keystitch.llm import packing


def plain(sizes, lengths, price):
    best = None
    for least in lengths:
        bins = []
        for i, size in enumerate(sizes):
            fits = [b for b in bins if b[0] >= size]
            if fits:
                chosen = min(fits, key=lambda b: b[0])
            else:
                chosen = [min(n for n in lengths if n >= max(size, least)), []]
                bins.append(chosen)
            chosen[0] -= size
            chosen[1].append(i)
        cost = sum(price(packing.cut_down(sum(sizes[i] for i in b), lengths)) for _, b in bins)
        best = cost if best is None else min(best, cost)
    return best


def test_cost_of_a_plain_best_fit():
    random.seed(3)
    for _ in range(60):
        lengths = tuple(sorted(random.sample(range(5, 60), 3)))
        sizes = sorted((random.randint(0, lengths[-1]) for _ in range(random.randint(1, 60))), reverse=True)
        bins = packing.pack_block(sizes, lengths, packing.cost)
        assert sorted(i for _, b in bins for i in b) == list(range(len(sizes)))
        for length, members in bins:
            assert length == packing.cut_down(sum(sizes[i] for i in members), lengths)
        # rooms of one size are alike, so any choice among them costs the same
        assert sum(packing.cost(n) for n, _ in bins) == plain(sizes, lengths, packing.cost)


def test_sizes_are_chosen_jointly():
    cheap_large = packing.pack_block([5, 5, 5, 5], (6, 20), lambda n: n + 100)
    assert [n for n, _ in cheap_large] == [20]
    cheap_small = packing.pack_block([5, 5, 5, 5], (5, 20), lambda n: n * n)
    assert [n for n, _ in cheap_small] == [5, 5, 5, 5]


def test_every_word_is_in_one_sequence(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = packing.pack(docs.select("doc_id", packing.words().alias("n")), (128, 512), block_pieces=60).collect()
    held = {}
    for r in out:
        assert r.used == sum(p.n for p in r.pieces) <= r.length and r.length in (128, 512)
        assert r.doc_ids == [p.doc_id for p in r.pieces]
        for p in r.pieces:
            held.setdefault(p.doc_id, []).append((p.start, p.n))
    for r in docs.collect():
        at = 0
        for start, n in sorted(held[r.doc_id]):
            assert start == at
            at += n
        assert at == len(r.text.encode().split())
    assert len({r.sequence for r in out}) == len(out)


def test_defined_cases(spark):
    items = spark.createDataFrame([(None, 3), (1, None), (2, 0), (3, 25), (3, 25), (4, -1)], "doc_id long, n int")
    out = packing.pack(items, (10, 20)).collect()
    pieces = sorted((str(p.doc_id), p.start, p.n) for r in out for p in r.pieces)
    assert pieces == sorted([("None", 0, 3), ("1", 0, 0), ("2", 0, 0), ("4", 0, 0)] + 2 * [("3", 0, 20), ("3", 20, 5)])
    assert packing.pack(items.limit(0)).count() == 0
    assert packing.pack_documents(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).count() == 1
