"""The interactions of filters against a plain count over every order."""

import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from keystitch.llm.interactions import audit, popcounts, text_filters, truth, words_of, survivors

DOCS = "doc_id long, text string, lang string, part string, word long, good boolean"
LABELS = "doc_id long, quality int, toxic int, lang string"


def failed(text, doc_id, least):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = "A" if len(words) < 200 else ""
    out += "B" if 100 * len(set(words)) < 50 * len(words) else ""
    out += "C" if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else ""
    out += "D" if re.search(r"[#$%&*|]", text) else ""
    return out + ("E" if doc_id is not None and doc_id > least.get(text, doc_id) else "")


def plain(docs, labels):
    """Every document through every order, one step after the other."""
    least = {}
    for i, text, *_ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    good = {i for i, q, _, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t, _ in labels if t == 1 and i is not None}
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
    counts, shapley, parts = Counter(), Counter(), {lang or "" for _, _, lang, *_ in docs}
    for i, text, lang, *_ in docs:
        part, fails = lang or "", failed(text or "", i, least)
        for order in permutations("ABCDE"):
            gone, key = False, (part, "".join(order))
            for step, f in enumerate(order, 1):
                now = f in fails and not gone
                gone_before, gone = gone, gone or now
                at = (*key, step)
                counts[at, "kept"] += not gone
                counts[at, "removed"] += now
                counts[at, "redundant"] += f in fails and gone_before
                counts[at, "unique_fails"] += fails == f
                counts[at, "good_lost"] += now and i in good
                counts[at, "toxic_lost"] += now and i in toxic
                shapley[part, f] += now
    return sorted(
        (part, "".join(o), step, *[counts[(part, "".join(o), step), n] for n in names], shapley[part, o[step - 1]])
        for part in parts for o in permutations("ABCDE") for step in range(1, 6)
    )


def found(spark, docs, labels):
    out = audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    assert out.columns == "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    return sorted(map(tuple, out.collect()))


def rows(texts):
    return [(i, t, lang, "x", 7, True) for i, t, lang in texts]


def test_popcounts():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 4, 9, 100, 4097):
        words = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)
        assert popcounts(words).tolist() == [int((words >> b & 1).sum()) for b in range(32)]


def test_truth_words():
    assert [truth(i, 5) for i in range(5)] == [0x55555555, 0x33333333, 0x0F0F0F0F, 0x00FF00FF, 0x0000FFFF]


def test_audit_against_every_order(spark):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(400)] + ["Caps", "LOUD", "a#b", "50%", "été", "\U0001f600"]
    texts = []
    for i in range(60):
        few, n = int(rng.choice([20, 90, 400])), int(rng.choice([5, 150, 220, 260]))
        texts.append((i, " \t".join(rng.choice(vocabulary[:few] if i % 3 else vocabulary, n)), ["en", "de", None, ""][i % 4]))
    texts += [(100 + i, texts[i % 7][1], "fr") for i in range(20)]
    texts += [(3, texts[3][1], "en"), (3, texts[3][1], "en"), (None, texts[3][1], "en"), (-5, texts[9][1], "de")]
    texts += [(200, None, "en"), (201, "", "en"), (202, " \n ", None), (203, "A" * 50, "ü"), (204, "\x0b".join(["x"] * 300), "en")]
    docs = rows(texts)
    labels = [(i, i % 2, int(i % 3 == 0), "zz") for i in range(0, 120, 2)] + [(3, 1, 1, "a"), (3, 0, 0, "a"), (None, 1, 1, "a"), (100, None, None, "a")]
    assert found(spark, docs, labels) == plain(docs, labels)


def test_hot_text_and_very_long_text(spark):
    docs = rows([(i, "same words here", "en") for i in range(300)] + [(1000, "word " * 300_000, "en"), (1001, "w#" * 200_000, "en")])
    assert found(spark, docs, []) == plain(docs, [])


def test_empty_tables(spark):
    assert found(spark, [], []) == []
    assert len(found(spark, rows([(1, "a", "en")]), [])) == 600


def test_fewer_filters_and_wrong_names(spark):
    docs, labels = spark.createDataFrame(rows([(1, "a#", "en"), (2, "a#", "en")]), DOCS), spark.createDataFrame([], LABELS)
    out = audit(docs, labels, {"D": text_filters()["D"]}, copies="E").orderBy("filter_order", "step").collect()
    assert [(r.filter_order, r.step, r.kept, r.removed, r.redundant, r.shapley) for r in out] == [
        ("DE", 1, 0, 2, 0, 3), ("DE", 2, 0, 0, 1, 1), ("ED", 1, 1, 1, 0, 1), ("ED", 2, 0, 1, 1, 3),
    ]
    with pytest.raises(ValueError):
        audit(docs, labels, {c: F.lit(True) for c in "ABCDE"}, copies="F")


def test_survivors_add_up_over_many_parts(spark):
    docs = spark.createDataFrame(rows([(i, "x", f"l{i % 50}") for i in range(200)]), DOCS)
    words = words_of(docs, spark.createDataFrame([], LABELS), text_filters(), "E").repartition(7)
    out = survivors(words, 5).collect()
    assert len(out) == 50 and all(r["all"][0] == 4 and len(r["all"]) == 32 for r in out)
