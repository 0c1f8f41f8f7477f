"""Hard negatives against all pairs, and the bounds of the codes."""

import numpy as np
import pytest

from keystitch.llm import negatives as N

SCHEMA = "vec_id long, embedding array<double>, label int, uid string, block string"


def plain(table, one_in=100, flip=7, percent=80):
    rows = []
    for vec_id, e, label, *_ in table:
        if None in (vec_id, e, label) or any(x is None or not np.isfinite(x) for x in e):
            continue
        label = int(np.fmod(label + 1, 10)) if vec_id % flip == 0 else label
        rows.append((vec_id, label, [int(np.floor(256 * x)) for x in e]))
    out = []
    for a, (anchor, label, v) in enumerate(rows):
        if anchor % one_in:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w, strict=False)), i, other) for c, (i, other, w) in enumerate(rows) if c != a]
        for p, positive, _ in sorted(s for s in scored if s[2] == label)[:5]:
            close = sorted((n, i) for n, i, other in scored if other != label and 80 * -p <= 100 * -n <= 100 * -p)[:5]
            out += [(anchor, positive, rank, i, -p, -n) for rank, (n, i) in enumerate(close, 1)]
    return sorted(out)


def found(spark, table, **settings):
    out = N.mine(spark.createDataFrame(table, SCHEMA), **settings)
    assert out.dtypes == [(c, "int" if c == "rank" else "bigint") for c in "anchor_id positive_id rank negative_id positive_score negative_score".split()]
    return sorted(map(tuple, out.collect()))


def vectors(n, dim, seed, kinds=6):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((kinds, dim))
    return [centres[rng.integers(kinds)] + 0.7 * rng.standard_normal(dim) for _ in range(n)]


@pytest.mark.parametrize("dim", [1, 3, 64, 70])
def test_against_all_pairs(spark, monkeypatch, dim):
    monkeypatch.setattr(N, "CANDIDATE_ROWS", 90)
    monkeypatch.setattr(N, "ANCHOR_ROWS", 7)
    rng = np.random.default_rng(dim)
    table = [(i, v.tolist(), int(rng.integers(4)), "u", "b") for i, v in enumerate(vectors(400, dim, dim))]
    assert found(spark, table, one_in=20) == plain(table, one_in=20)


def test_defined_cases(spark):
    rng = np.random.default_rng(3)
    base = [(i, v.tolist(), int(rng.integers(3)), "u", "b") for i, v in enumerate(vectors(150, 5, 9))]
    odd = [
        (None, [1.0] * 5, 1, "u", "b"), (300, None, 1, "u", "b"), (400, [1.0] * 5, None, "u", "b"),
        (500, [1.0, None, 0.0, 0.0, 0.0], 1, "u", "b"), (600, [float("nan")] * 5, 1, "u", "b"), (700, [float("inf")] * 5, 1, "u", "b"),
        (800, [], 1, "u", "b"), (900, [0.0] * 5, 1, "u", "b"), (1000, [2.0, 1.0], 2, None, None), (-100, [-1.0] * 5, 9, "u", "b"),
    ]
    again = [base[0], base[0], base[20], (20, base[3][1], 1, "u", "b"), (40, base[40][1], 2, "u", "b")] + [base[7]] * 8
    table = base + odd + again
    assert found(spark, table, one_in=20) == plain(table, one_in=20)


def test_ties_go_to_smaller_ids(spark):
    table = [(i, [1.0, 0.0], int(i > 50), "u", "b") for i in range(120)]
    assert found(spark, table) == plain(table)


def test_one_label_and_empty_tables(spark):
    assert found(spark, [(i, [1.0], 1, "u", "b") for i in range(6)], flip=1000) == plain([(0, [1.0], 1), (1, [1.0], 1)], flip=1000) == []
    assert found(spark, []) == []


@pytest.mark.parametrize("dim", [2, 64, 200])
def test_intervals_hold_and_narrow(dim):
    rng = np.random.default_rng(dim)
    a, b = np.rint(300 * rng.standard_normal((20, dim))), np.rint(300 * rng.standard_normal((200, dim)))
    b[:20] = a
    i, j = (x.ravel() for x in np.indices((20, 200)))
    true, widths = (a @ b.T).ravel(), []
    bounds = N.intervals(N.Planes(a), *N.encode(b), i, j)
    low, high = next(bounds)
    for _ in range(N.LEVELS - 1):
        assert (low <= true).all() and (true <= high).all()
        widths.append(np.median(high - low))
        low, high = bounds.send(np.ones(len(i), bool))
    assert (low <= true).all() and (true <= high).all()
    assert widths == sorted(widths, reverse=True)


def test_codes_drop_most_pairs():
    rng = np.random.default_rng(0)
    v = rng.standard_normal((2000, 64))
    v = np.floor(256 * v / np.linalg.norm(v, axis=1, keepdims=True))
    a, true = v[:20], v[:20] @ v.T
    codes, lengths = N.encode(v)
    i, j = (x.ravel() for x in np.indices((20, 2000)))
    bounds, least = N.intervals(N.Planes(a), codes, lengths, i, j), np.sort(true, 1)[:, -6]
    low, high = next(bounds)
    keep = ~(high < least[i])
    while True:
        i, j = i[keep], j[keep]
        try:
            low, high = bounds.send(keep)
        except StopIteration:
            break
        keep = ~(high < least[i])
    assert len(i) < 0.1 * 20 * 2000
    assert {(x, y) for x, y in zip(i.tolist(), j.tolist(), strict=True)} >= set(zip(*np.nonzero(true >= least[:, None]), strict=True))
