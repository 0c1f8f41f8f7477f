"""Similarity join against a comparison of all pairs."""

import random

import pytest

from keystitch.llm import jaccard


def tokens(text, n):
    w = (text or "").encode().lower().split()
    if len(w) >= n:
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    return {tuple(w)} if w else set()


def plain(docs, n, percent):
    sets = [tokens(t, n) for t in docs]
    head, links = list(range(len(docs))), [0] * len(docs)

    def top(x):
        while head[x] != x:
            x = head[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                links[i] += 1
                links[j] += 1
                low, high = sorted((top(i), top(j)))
                head[high] = low
    return [(i, len(s), top(i), links[i]) for i, s in enumerate(sets)]


def texts(seed):
    random.seed(seed)
    words, docs = [f"w{i}" for i in range(300)], []
    passage = [random.choice(words) for _ in range(40)]
    for _ in range(45):
        base = [random.choice(words) for _ in range(random.choice([1, 2, 3, 5, 12, 30, 60, 200]))]
        base += random.choice([[], [], passage])
        for _ in range(random.choice([1, 1, 2, 6])):
            b = list(base)
            for _ in range(random.choice([0, 0, 1, 1, 2, 4, 9])):
                if b:
                    k = random.randrange(len(b))
                    b[k : k + 1] = random.choice([[], [random.choice(words)], [b[k], "x"]])
            docs.append(" ".join(b))
    return [*docs, "", None, " \t", "A b", "a B", "É b", "é b"]


@pytest.mark.parametrize("n, percent, members", [(3, 90, 512), (3, 90, 3), (5, 80, 512), (1, 50, 4), (2, 100, 5)])
def test_all_pairs(spark, n, percent, members):
    docs = texts(n)
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(5)
    found = jaccard.join(df, n, percent, members).orderBy("doc_id").collect()
    assert [(r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in found] == plain(docs, n, percent)
    assert all(r.class_id <= r.doc_id and tokens(docs[r.class_id], n) == tokens(docs[r.doc_id], n) for r in found)


def test_large_sets_use_finer_sketches(spark):
    random.seed(8)
    words, docs = [f"w{i}" for i in range(5000)], []
    for size in (1000, 1030, 1100, 1600):
        base = [random.choice(words) for _ in range(size)]
        for cuts in (0, 5, 30, 60, 70):
            b = list(base)
            for _ in range(cuts):
                b[random.randrange(len(b))] = "x"
            docs.append(" ".join(b))
        docs.append(" ".join(base[: size // 2] + [random.choice(words) for _ in range(size // 2)]))
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    found = jaccard.join(df, 3, 80).orderBy("doc_id").collect()
    assert [(r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in found] == plain(docs, 3, 80)


def test_defined_cases(spark, rows):
    data = [(None, "a b c d"), (1, "a b c d"), (1, "a b c d"), (2, "x y z"), (3, None)]
    df = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "7 as n_links")
    got = rows(jaccard.join(df).select("doc_id", "n_shingles", "component_id", "n_links"))
    want = [(None, 2, None, 0), (1, 2, 1, 1), (1, 2, 1, 1), (2, 1, 2, 0), (3, 0, 3, 0)]
    assert got == sorted(want, key=repr)
    assert jaccard.join(df.limit(0)).count() == 0


def test_different_texts_of_one_id_all_take_part(spark, rows):
    one, other = ([f"{x}{i}" for i in range(60)] for x in "ab")
    near = [*other[:30], "x", *other[31:]]
    data = [(5, one), (5, other), (9, near), (4, [*one, "y"]), (2, ["p", "q", "r"]), (7, ["p", "q", "r"]), (7, [f"c{i}" for i in range(9)])]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in data], "doc_id long, text string")
    got = rows(jaccard.join(df, 3, 80).select("doc_id", "n_shingles", "component_id", "n_links"))
    want = [(2, 1, 2, 1), (4, 59, 4, 1), (5, 58, 4, 1), (5, 58, 4, 1), (7, 1, 2, 1), (7, 7, 2, 1), (9, 58, 4, 1)]
    assert got == sorted(want, key=repr)


def test_bands_keep_similar_sizes_together():
    for percent in (50, 80, 90, 95, 100):
        low, differ, parts = jaccard.bands(500, percent)
        band = lambda n: max(i for i, x in enumerate(low) if x <= n)  # noqa: B023, E731
        for a in range(1, 501):
            for b in range(a, 501):
                # the least overlap that links sets of these sizes
                least = -(-percent * (a + b) // (100 + percent))
                if least <= a:
                    assert band(b) - band(a) <= 1
                    assert a + b - 2 * least <= differ[band(a)] < parts[band(a)]


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 300), (300, 100), (-5, -7)]
    random.seed(1)
    random.shuffle(edges)
    found = dict(jaccard.components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 200: 100, 300: 100, -5: -7, -7: -7}


def test_empty_parts_do_not_bring_strangers_together():
    rng = random.Random(3)
    docs = [" ".join(f"w{rng.randrange(10**9)}" for _ in range(200)).encode() for _ in range(1000)]
    sets, shown = jaccard.Sets(docs, 5), []
    low, differ, parts = jaccard.bands(200, 80)
    slot = jaccard.np.searchsorted(low, sets.size, side="right") - 1
    for number in (parts[slot],):
        doc, value = sets.parts(slot, number, number - differ[slot])
        shown += value.tolist()
    assert len(set(shown)) >= 0.999 * len(shown)
