"""Byte-pair encoding and decoding with a public word-end vocabulary.

A text is normalised (NFC, white space, lower case) and cut at white space; no merge crosses white space, so the
ids of a text are those of its chunks in a row. Each task encodes every chunk it meets once: the symbols of many
chunks lie in one flat array, and a round finds the lowest-ranked pair of each chunk by binary search over the
sorted pair keys, merges it, and lets finished chunks go.

Defined cases: a null text is encoded as an empty one, an empty text has no ids and decodes to an empty text.
Rows are independent, so repeated rows repeat their results. Other columns of the input pass through `encode` and
`decode` untouched; an output column that clashes with one of them replaces it.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

#: Chunks a worker keeps encoded; past that it forgets all of them and starts anew. Only speed depends on it.
CACHED_CHUNKS = 250_000
#: Bytes of text or ids that are converted together.
SLICE_BYTES = 1_000_000
_SPACES = "\t-\r \x85\xa0  -     　"
_SPLIT = re.compile(f"[{_SPACES}]+")
# str.split() also cuts at these, which are ordinary characters to the vocabulary
_INFORMATION_SEPARATORS = re.compile("[\x1c-\x1f]")
_NO_RANK = np.iinfo(np.int64).max


def _byte_characters() -> list[str]:
    """The printable stand-in of each byte: itself if it is a visible Latin-1 character, else the next one from 256."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Vocabulary:
    """Ids, merge ranks and patterns of a vocabulary file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        ids, end = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, i in [*ids.items(), *self.special.items()]:
            self.tokens[i] = token
        self.pattern = next(
            p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"
        )
        shown = _byte_characters()
        self.inner = np.array([ids[c] for c in shown], np.int64)
        self.last = np.array([ids[c + end] for c in shown], np.int64)
        self.size = len(self.tokens)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        left = np.array([ids[a] for a, _ in pairs], np.int64)
        right = np.array([ids[b] for _, b in pairs], np.int64)
        merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        # a pair that is listed twice keeps its lowest rank
        self.keys, self.rank = np.unique(left * self.size + right, return_index=True)
        self.merged = merged[self.rank]
        # where what a merge makes belongs to no pair of lower rank, all its occurrences can merge in one round
        first_use = np.full(self.size, _NO_RANK)
        np.minimum.at(first_use, left, np.arange(len(left)))
        np.minimum.at(first_use, right, np.arange(len(right)))
        self.at_once = first_use[self.merged] > self.rank

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and the number of ids of each; no word is empty."""
        lengths = np.array([len(w) for w in words], np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(lengths)
        symbols = self.inner[raw]
        symbols[ends - 1] = self.last[raw[ends - 1]]
        word = np.repeat(np.arange(len(words)), lengths)
        done_symbols, done_words = [], []
        while len(symbols):
            rank, at = np.full(len(symbols), _NO_RANK), np.zeros(len(symbols), np.int64)
            inside = np.flatnonzero(word[:-1] == word[1:])
            key = symbols[inside] * self.size + symbols[inside + 1]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[place] == key
            rank[inside[hit]], at[inside[hit]] = self.rank[place[hit]], place[hit]
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            sizes = np.diff(np.r_[starts, len(word)])
            least = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            over = least == _NO_RANK
            if over.any():
                done_symbols.append(symbols[over])
                done_words.append(word[over])
                going = ~over
                symbols, word, rank, at, least = symbols[going], word[going], rank[going], at[going], least[going]
            chosen = np.flatnonzero(rank == least)
            if not len(chosen):
                continue
            # of the occurrences in a run that overlap, every second one from the left
            new_run = np.r_[True, np.diff(chosen) != 1] | np.r_[True, word[chosen[1:]] != word[chosen[:-1]]]
            place_in_run = np.arange(len(chosen)) - np.maximum.accumulate(np.where(new_run, np.arange(len(chosen)), 0))
            first_in_word = np.r_[True, word[chosen[1:]] != word[chosen[:-1]]]
            chosen = chosen[np.where(self.at_once[at[chosen]], place_in_run % 2 == 0, first_in_word)]
            symbols[chosen] = self.merged[at[chosen]]
            kept = np.ones(len(symbols), bool)
            kept[chosen + 1] = False
            symbols, word = symbols[kept], word[kept]
        if not done_words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        word, symbols = np.concatenate(done_words), np.concatenate(done_symbols)
        order = np.argsort(word, kind="stable")
        return symbols[order], np.bincount(word, minlength=len(words))


class _Encoder:
    """Encodes texts with a growing table of chunks that were met before."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.words = regex.compile(vocabulary.pattern.replace(r"[^\s", f"[^{_SPACES}"), regex.V0)
        self.cut = re.compile("|".join(map(re.escape, vocabulary.special))) if vocabulary.special else None
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.start, self.length = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for token, i in self.vocabulary.special.items():
            # no chunk has a space, so none is taken for a special token
            self._add([" " + token], np.array([i]), np.array([1]))

    def _add(self, chunks: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        for i, chunk in enumerate(chunks, len(self.index)):
            self.index[chunk] = i
        self.start = np.r_[self.start, len(self.flat) + np.cumsum(counts) - counts]
        self.length = np.r_[self.length, counts]
        self.flat = np.concatenate([self.flat, ids.astype("<u4")])

    def _learn(self, chunks: list[str]) -> None:
        pieces = [self.words.findall(c) for c in chunks]
        flat = [p.encode() for group in pieces for p in group]
        distinct = {p: i for i, p in enumerate(dict.fromkeys(flat))}
        ids, counts = self.vocabulary.encode_words(list(distinct)) if distinct else (np.zeros(0, int),) * 2
        which = np.fromiter(map(distinct.__getitem__, flat), np.int64, len(flat))
        start = np.cumsum(counts) - counts
        of_chunk = np.repeat(np.arange(len(chunks)), [len(g) for g in pieces])
        per_chunk = np.bincount(of_chunk, weights=counts[which], minlength=len(chunks)).astype(np.int64)
        self._add(chunks, ids[_gather(start[which], counts[which])], per_chunk)

    def _plain(self, text: str) -> list[str]:
        if not text.isascii():
            # each capital sigma is lowered by itself, whatever its place in the word
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        if _INFORMATION_SEPARATORS.search(text):
            return [c for c in _SPLIT.split(text) if c]
        return text.split()

    def chunks(self, text: str) -> list[str]:
        if self.cut is None or "<|" not in text:
            return self._plain(text)
        found, at = [], 0
        for match in self.cut.finditer(text):
            found += [*self._plain(text[at : match.start()]), " " + match[0]]
            at = match.end()
        return found + self._plain(text[at:])

    def encode(self, texts: list[str]) -> list[bytes]:
        chunks = [self.chunks(t) for t in texts]
        flat = [c for group in chunks for c in group]
        if len(self.index) > CACHED_CHUNKS:
            self.forget()
        which = np.fromiter(map(self.index.get, flat, repeat(-1)), np.int64, len(flat))
        if len(unknown := np.flatnonzero(which < 0)):
            missing = [flat[i] for i in unknown]
            self._learn(list(dict.fromkeys(missing)))
            which[unknown] = np.fromiter(map(self.index.__getitem__, missing), np.int64, len(missing))
        counts = self.length[which]
        ids = self.flat[_gather(self.start[which], counts)]
        ends = np.r_[0, np.cumsum(counts)][np.cumsum([0, *(len(g) for g in chunks)])]
        return [ids[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _gather(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of each run of `count` in a row."""
    return np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())


def _with_column(df: DataFrame, name: str, kind, column: str, convert, model) -> DataFrame:
    """`df` and a column that `convert(model value, list of values)` makes of `column`, batch by batch."""
    kept = [c for c in df.columns if c != name]
    schema = StructType([*(df.schema[c] for c in kept), StructField(name, kind, False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply, target = convert(model.value), pa.binary() if isinstance(kind, BinaryType) else pa.string()
        for batch in batches:
            values = batch.column(batch.schema.get_field_index("keystitch_in"))
            others = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            for a, b in _slices(values):
                out = pa.array(apply(values.slice(a, b - a).to_pylist()), target)
                yield pa.RecordBatch.from_arrays([*(o.slice(a, b - a) for o in others), out], [*kept, name])

    return df.select(*kept, F.col(column).alias("keystitch_in")).mapInArrow(run, schema)


def _slices(values: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about SLICE_BYTES; a longer value is a range of its own."""
    size = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.cumsum(size) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(size)]
    yield from ((a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b)


_ENCODERS: dict[str, _Encoder] = {}


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """`docs` with the token ids of `text` as little-endian unsigned 32-bit integers in the binary column `ids`.

    The vocabulary at `path`, a file of fixed size, is read by the driver and sent to each executor once. Strings
    of special tokens in a text are those tokens.
    """
    model = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))

    def convert(vocabulary: Vocabulary):
        encoder = _ENCODERS.get(path) or _ENCODERS.setdefault(path, _Encoder(vocabulary))
        return lambda texts: encoder.encode([t or "" for t in texts])

    return _with_column(docs, ids, BinaryType(), text, convert, model)


def decode(encoded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """`encoded` with the text of each id sequence: its tokens joined by one space, as the vocabulary has no decoder."""
    model = encoded.sparkSession.sparkContext.broadcast(Vocabulary(path).tokens)

    def convert(tokens: list[str]):
        return lambda rows: [
            " ".join(map(tokens.__getitem__, np.frombuffer(r or b"", "<u4").tolist())) for r in rows
        ]

    return _with_column(encoded, text, StringType(), ids, convert, model)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: number of tokens, and digests of the ids and of the text they decode to."""
    both = decode(encode(docs.select("doc_id", "text"), path).drop("text"), path)
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
