"""Toxicity by compression distance: two zstandard dictionaries, one trained on ordinary and one on toxic text.

Toxic documents are mostly ordinary text, so the toxic dictionary is trained on their toxic passages: words with a
byte sequence that many toxic and hardly any ordinary training documents have. The windows of a text are its words
in two bytes a character, which weighs what must be spelled out against what a dictionary has. Each window is
compressed twice, with the ordinary dictionary alone and with the toxic one in front of it, so only what the toxic
passages shorten makes the lengths differ. The bytes a document saves that way, by length and by window, are turned into a
score by a logistic curve, calibrated on training documents that the dictionaries used for that have not seen.

Bounds: the dictionaries are trained on up to DICTIONARY_ROWS documents of each label and the curve on up to CURVE_ROWS,
those with the smallest hash of the id, of at most TRAIN_BYTES each. Scores take in the whole text of every document.

Defined cases: null and empty texts are scored as texts that save nothing. Of several labels of one id the largest
counts; rows without a label or an id do not train. Where a label has no training row, every score is 0.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystitch.sources.tables import stage

DICTIONARY_ROWS, CURVE_ROWS, TRAIN_BYTES = 1500, 6000, 20_000
ORDINARY_BYTES, TOXIC_BYTES = 32_768, 12_288
#: Characters of a window; a longer word is several windows.
WINDOW = 48
#: Bytes of the sequences that mark toxic passages, and for each length how many times more common it is in toxic
#: documents than in ordinary ones; a long sequence says more. Least number and share of toxic documents with one.
GRAMS, MARKED, SHARE = {10: 12, 16: 8}, 4, 0.03
#: Saving at which a window counts as toxic.
SAVED = 2
#: Windows whose saving a worker remembers; past that it forgets all of them. Only speed depends on it.
CACHED_WINDOWS = 150_000
_FEATURES = "saved double, rate double, windows double"


def windows(text: str) -> list[str]:
    """The lower-cased words, each between spaces."""
    found = []
    for word in text.lower().split():
        if len(word) <= WINDOW:
            found.append(word)
        else:
            found += [word[i : i + WINDOW] for i in range(0, len(word), WINDOW)]
    return found


def _wide(word: str) -> bytes:
    return f" {word} ".encode("utf-16-le", "surrogatepass")


def _grams(words: set[str]) -> set[bytes]:
    wide = [_wide(w) for w in words]
    return {w[i : i + n] for n in GRAMS for w in wide for i in range(0, len(w) - n + 1, 2)}


def _content(passages: list[bytes], size: int) -> bytes:
    """What a dictionary of about `size` trained on the passages holds, without its header and tables. Passages that
    training left out go in front, common ones nearest."""
    samples = [b"".join(passages[i : i + 16]) for i in range(0, len(passages), 16)]
    trained = b""
    if len(samples) >= 32 and sum(map(len, samples)) >= 4 * size:
        trained = zstandard.train_dictionary(size, samples, k=96, d=8, level=3).as_bytes()[600:]
    kept, room = [], size - len(trained)
    for passage, _ in Counter(passages).most_common():
        if passage not in trained and room >= len(passage):
            kept.append(passage)
            room -= len(passage)
    return b"".join(reversed(kept)) + trained


@dataclass
class Dictionaries:
    ordinary: bytes
    toxic: bytes

    @classmethod
    def train(cls, ordinary: list[str], toxic: list[str]) -> Dictionaries:
        # repeated texts count once
        normal, bad = ([windows(t) for t in dict.fromkeys(part)] for part in (ordinary, toxic))
        among = [Counter(g for words in group for g in _grams(set(words))) for group in (normal, bad)]
        least, ratio = max(MARKED, SHARE * len(bad)), len(bad) / max(1, len(normal))
        marks = {
            g for g, n in among[1].items() if n >= least and n >= GRAMS[len(g)] * ratio * (among[0][g] + 0.5)
        }
        passages = [_wide(w) for words in bad for w in words if not marks.isdisjoint(_grams({w}))]
        order = np.random.default_rng(0).permutation(len(passages))
        return cls(
            _content([_wide(w) for words in normal for w in words], ORDINARY_BYTES),
            _content([passages[i] for i in order], TOXIC_BYTES),
        )


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters(
        window_log=17, hash_log=16, chain_log=16, search_log=5, min_match=6, target_length=64,
        strategy=zstandard.STRATEGY_BTLAZY2, write_content_size=0, write_checksum=0, write_dict_id=0,
    )
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(compression_params=parameters, dict_data=dictionary)


class Meter:
    """Bytes that the toxic passages save in each window, at least SAVED or none."""

    def __init__(self, dictionaries: Dictionaries):
        # the ordinary part stands at the same distance in both
        self.ordinary = _compressor(dictionaries.ordinary)
        self.toxic = _compressor(dictionaries.toxic + dictionaries.ordinary)
        self.known: dict[str, int] = {}

    def _measure(self, word: str) -> int:
        wide = _wide(word)
        saved = len(self.ordinary.compress(wide)) - len(self.toxic.compress(wide))
        self.known[word] = saved = saved if saved >= SAVED else 0
        return saved

    def features(self, text: str) -> tuple[float, float, float]:
        """Log of the bytes saved, log of their share of the text, and share of the windows that save some."""
        if len(self.known) > CACHED_WINDOWS:
            self.known.clear()
        found, known = windows(text), self.known
        saved = [self._measure(w) if (s := known.get(w)) is None else s for w in found]
        gain, hits = sum(saved), len(saved) - saved.count(0)
        length = sum(map(len, found))
        return float(np.log1p(gain)), float(np.log(1e-4 + gain / (length + 50))), hits / max(1, len(found))


def _with_features(docs: DataFrame, dictionaries) -> DataFrame:
    """id, held_out and label of `docs` with the features of each text."""
    kept = [f for f in docs.schema.fields if f.name != "text"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        meter = Meter(dictionaries.value)
        for pdf in batches:
            found = [meter.features(t or "") for t in pdf["text"]]
            yield pdf.drop(columns="text").assign(
                **dict(zip(("saved", "rate", "windows"), zip(*found, strict=True), strict=True))
            )

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), _FEATURES])
    return docs.mapInPandas(run, schema)


def _curve(x: np.ndarray, y: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Logistic regression by Newton's method with a small penalty; the last weight is the constant."""
    x = np.c_[x, np.ones(len(x))]
    w, penalty = np.zeros(x.shape[1]), 1e-2 * np.eye(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def score(docs: DataFrame, labels: DataFrame, fold: int = 5, keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, held_out, score and predicted of every document. Rows whose crc32 of the id is divisible by `fold`
    are held out: their labels are not learned from. `keep` names columns of `docs` to carry along, a key of the rows, say."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *keep)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % fold == 0, F.lit(False))
    known = labels.where("toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max("toxic").cast("int").alias("toxic")
    )
    # ids are chosen from the labels alone, so no text is shuffled; their number is bounded, and they are broadcast
    ids = known.where(~held_out).withColumn("at", F.xxhash64("doc_id"))
    first = [ids.where(F.col("toxic") == x).orderBy("at", "doc_id").limit(DICTIONARY_ROWS) for x in (0, 1)]
    second = ids.orderBy(F.xxhash64("at"), "doc_id").limit(CURVE_ROWS)
    uses = reduce(
        DataFrame.unionByName, [part.withColumn("use", F.lit(use)) for use, part in enumerate([*first, second])]
    )
    short = docs.where(F.octet_length("text") <= TRAIN_BYTES)
    train = stage(short.select("doc_id", "text").join(F.broadcast(uses), "doc_id"), "toxicity-training")
    sample = [train.where(F.col("use") == x).orderBy("at", "doc_id", "text").select("at", "text").collect() for x in (0, 1)]
    rows = docs.select("doc_id", held_out.alias("held_out"), "text", *keep)
    if not all(sample):
        return rows.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), *keep)

    def trained(keep):
        return spark.sparkContext.broadcast(
            Dictionaries.train(*([r["text"] for r in part if keep(r["at"] % 2)] for part in sample))
        )

    # each half of the documents for the curve is measured with dictionaries trained on the other half
    second = train.where(F.col("use") == 2)
    halves = [
        _with_features(
            second.where(F.pmod("at", F.lit(2)) == half).select("toxic", "text").repartition(12),
            trained(lambda of, half=half: of != half),
        )
        for half in (0, 1)
    ]
    seen = halves[0].unionByName(halves[1]).toPandas()
    dictionaries = trained(lambda of: True)
    names = ["saved", "rate", "windows"]
    w = _curve(seen[names].to_numpy(), seen["toxic"].to_numpy(float)) if len(seen) else np.array([0.0, 0, 0, -1])
    logit = sum((F.col(n) * float(a) for n, a in zip(names, w[:-1], strict=True)), F.lit(float(w[-1])))
    value = 1 / (1 + F.exp(-logit))
    scored = _with_features(rows, dictionaries).withColumn("score", value)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), *keep)
