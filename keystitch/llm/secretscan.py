"""Secrets in texts: fixed patterns, and tokens that a battery of randomness tests cannot tell from random ones.

Only built-in expressions run here. Where a pattern occurs is found without a position function: the pieces between the
matches and the matches themselves have lengths, and their running sums are the places.

Candidates are maximal runs of LEAST_TOKEN or more characters that one encoding explains (hexadecimal in either case,
base 32, base 64, base 64 for URLs). Under its encoding a token is a row of symbol numbers, and three tests ask whether
these could be drawn evenly and independently: chi-squared over the alphabet, runs above and below its middle, and
correlation of neighbours. Their probabilities are combined by Fisher's rule. Random tokens spread evenly over the
combined probability, ordinary ones pile up near zero, more so the longer they are. For each encoding and octave of
length the upper half of a histogram over all documents therefore tells how many random tokens there are, and a token
counts as secret from the least probability on at which at most FALSE of the tokens above are not of those.

Defined cases: a null text is empty, and a document without spans has empty lists. Every row is answered, also without an id or with a
repeated one. Places count code points, ends are exclusive. Spans of the tests may lie over spans of the patterns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keystitch.sources.tables import stage

# The patterns, and how many characters of which group a match must have.
KINDS = ("assign", "access", "hex")
PATTERNS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": ("AKIA[A-Z0-9]+", 0, 20),
    "hex": ("[0-9a-f]+", 0, 24),
}
#: Same matches for patterns of one class of characters, without stopping at each short run.
LONG = {"access": "AKIA[A-Z0-9]{16,}", "hex": "[0-9a-f]{24,}"}

RANDOM = "random"
LEAST_TOKEN = 20
TOKEN = rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{LEAST_TOKEN},}}={{0,2}}"
#: Share of the tokens called secret that may be ordinary.
FALSE = 0.1
BINS = 20

_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
# Encodings in the order they are tried, what their tokens look like, and their alphabets.
ENCODINGS = {
    "hex": (r"^[0-9a-f]+\z", _DIGITS + "abcdef"),
    "HEX": (r"^[0-9A-F]+\z", _DIGITS + "ABCDEF"),
    "base32": (r"^[A-Z2-7]+\z", _UPPER + "234567"),
    "base64": (r"^[A-Za-z0-9+/]+\z", _UPPER + _LOWER + _DIGITS + "+/"),
    "base64url": (r"^[A-Za-z0-9_-]+\z", _UPPER + _LOWER + _DIGITS + "-_"),
}
#: Running sums are built in chunks of so many, as appending to an array copies it.
CHUNK = 256


def computed(rows: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated once, whatever uses them: the optimizer does not push through a generator."""
    return rows.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _scan(docs: DataFrame, patterns: dict[str, tuple[str, int]]) -> DataFrame:
    """For each name the matches, what the given group has of them, and the pieces of text around them."""
    rows = computed(docs, **{f"{name}_any": F.col("text").rlike(p) for name, (p, _) in patterns.items()})
    none = F.array().cast("array<string>")
    found = {}
    for name, (p, group) in patterns.items():
        some = F.col(f"{name}_any")
        found[f"{name}_all"] = F.when(some, F.regexp_extract_all("text", F.lit(p), F.lit(0))).otherwise(none)
        if group:
            found[f"{name}_part"] = F.when(some, F.regexp_extract_all("text", F.lit(p), F.lit(group))).otherwise(none)
        pieces = F.transform(F.split("text", p), F.length)
        found[f"{name}_gaps"] = F.when(some, pieces).otherwise(F.array().cast("array<int>"))
    return computed(rows, **found).drop("text", *[f"{name}_any" for name in patterns])


def _sums(values: Column, start: Column) -> Column:
    """Running sums of a short array, with `start` before its first value."""
    return F.aggregate(values, F.array(start), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))


def _placed(rows: DataFrame, name: str) -> DataFrame:
    """Replace what `_scan` found under a name by an array `name` of (start, end, found, part)."""
    found, gaps = F.col(f"{name}_all"), F.col(f"{name}_gaps")
    part = F.col(f"{name}_part") if f"{name}_part" in rows.columns else found
    steps = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda gap, match: (gap + F.length(match)).cast("long"))
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("steps") - 1) / CHUNK).cast("int")),
        lambda c: F.slice("steps", c * CHUNK + 1, F.lit(CHUNK)),
    )
    none = F.array().cast("array<bigint>")
    totals = F.transform("chunks", lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda acc, x: acc + x))
    rows = computed(rows, steps=steps)
    rows = computed(rows, chunks=F.when(F.size("steps") > 0, chunks).otherwise(F.array(none)))
    rows = computed(rows, bases=_sums(totals, F.lit(0).cast("long")))
    # of each chunk the sums up to its values, without what comes before the first one
    ends = F.flatten(
        F.zip_with(
            "chunks",
            F.slice("bases", 1, F.size("chunks")),
            lambda c, base: F.slice(_sums(c, base), F.lit(2), F.size(c)),
        )
    )
    rows = computed(rows, ends=ends)
    spans = F.zip_with(
        F.arrays_zip(found.alias("found"), part.alias("part")),
        "ends",
        lambda m, end: F.struct((end - F.length(m["found"])).alias("start"), end.alias("end"), m["found"], m["part"]),
    )
    rows = computed(rows, **{name: spans})
    kept = [c for c in rows.columns if c not in ("steps", "chunks", "bases", "ends", *[f"{name}_{x}" for x in ("all", "part", "gaps")])]
    return rows.select(*kept)


def occurrences(docs: DataFrame, patterns: dict[str, tuple[str, int]]) -> DataFrame:
    """`docs` with, instead of `text`, an array of (start, end, found, part) for each named (pattern, group): its leftmost
    matches that do not overlap."""
    return reduce(_placed, patterns, _scan(docs, patterns))


def _tail(z: Column) -> Column:
    """Probability that a normal variable lies further out than |z|, by a fixed approximation good to seven digits."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1 / (1 + 0.3275911 * x)
    # Coefficients of the approximation.
    terms = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
    series = reduce(lambda acc, a: (acc + a) * t, reversed(terms), F.lit(0.0))
    return F.least(F.lit(1.0), F.greatest(series * F.exp(-x * x), F.lit(1e-300)))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def inferred(tokens: DataFrame) -> DataFrame:
    """Tokens (with a column `token`) that an encoding explains, with it, its alphabet and their symbols."""
    token = F.rtrim("token", F.lit("="))
    rows = computed(tokens.where(~F.col("token").rlike(r"^[0-9]+=*\z")), symbols=token)
    name = F.coalesce(*[F.when(F.col("symbols").rlike(p), F.lit(e)) for e, (p, _) in ENCODINGS.items()])
    rows = computed(rows, encoding=name).where(F.col("encoding").isNotNull())
    alphabet = F.coalesce(*[F.when(F.col("encoding") == e, F.lit(a)) for e, (_, a) in ENCODINGS.items()])
    return computed(rows, alphabet=alphabet)


def tested(tokens: DataFrame) -> DataFrame:
    """`inferred` tokens with the probability `p` that a random token looks less random, and `band`, the octave of
    their length."""
    symbols, alphabet = F.col("symbols"), F.col("alphabet")
    rows = computed(
        tokens,
        n=F.length(symbols).cast("double"),
        size=F.length(alphabet).cast("double"),
        x=F.transform(F.split(symbols, ""), lambda c: (F.instr(alphabet, c) - 1).cast("double")),
        # how often each symbol occurs
        counts=F.transform(F.split(alphabet, ""), lambda s: (F.length(symbols) - F.length(F.replace(symbols, s, F.lit("")))).cast("double")),
    )
    n, size, x = F.col("n"), F.col("size"), F.col("x")
    high = F.transform("x", lambda v: F.when(v >= size / 2, 1.0).otherwise(0.0))
    after = F.slice("x", F.lit(2), F.size("x") - 1)
    neighbours = F.zip_with(x, F.concat(after, F.slice("x", 1, 1)), lambda a, b: a * b)
    rows = computed(
        rows,
        squares=_total(F.transform("counts", lambda c: c * c)),
        sum1=_total(x),
        sum2=_total(F.transform("x", lambda v: v * v)),
        cross=_total(neighbours),
        high=high,
    )
    changes = F.zip_with(F.slice("high", F.lit(1), F.size("high") - 1), F.slice("high", F.lit(2), F.size("high") - 1), lambda a, b: F.abs(a - b))
    rows = computed(rows, above=_total(F.col("high")), runs=1 + _total(changes))
    freedom = size - 1
    # spread evenly: chi-squared, made normal by the cube root, with the variance that a row of n symbols has
    chi = size / n * F.col("squares") - n
    scaled = freedom + (chi - freedom) * F.sqrt(n / F.greatest(n - 1, F.lit(1.0)))
    cube = 2 / (9 * freedom)
    z_even = (F.cbrt(F.greatest(scaled, F.lit(0.0)) / freedom) - (1 - cube)) / F.sqrt(cube)
    p_even = F.when(z_even > 0, _tail(z_even) / 2).otherwise(1 - _tail(z_even) / 2)
    # runs above and below the middle; all on one side happens to two of 2^n random tokens
    above, below = F.col("above"), n - F.col("above")
    twice = 2 * above * below
    spread = twice * (twice - n) / (n * n * F.greatest(n - 1, F.lit(1.0)))
    p_runs = F.when(twice == 0, F.pow(F.lit(2.0), 1 - F.least(n, F.lit(900.0)))).otherwise(
        _tail((F.col("runs") - 1 - twice / n) / F.sqrt(F.greatest(spread, F.lit(1e-9))))
    )
    # neighbours, the last symbol before the first
    level = n * F.col("sum2") - F.col("sum1") * F.col("sum1")
    serial = (n * F.col("cross") - F.col("sum1") * F.col("sum1")) / F.greatest(level, F.lit(1e-9))
    z_serial = (serial + 1 / (n - 1)) * (n - 1) * F.sqrt(n - 2) / n
    p_serial = F.when(level > 0, _tail(z_serial)).otherwise(F.lit(1e-300))
    log = reduce(Column.__add__, [-F.log(F.greatest(p, F.lit(1e-300))) for p in (p_even, p_runs, p_serial)])
    rows = computed(rows, log=log)
    s = F.col("log")
    p = F.exp(-s) * (1 + s + s * s / 2)
    return rows.select(*tokens.columns, p.alias("p"), F.floor(F.log2(n)).cast("int").alias("band"))


def thresholds(tests: DataFrame, false: float = FALSE) -> DataFrame:
    """(encoding, band, least): from which bin of the probability on tokens count as secret. At most one row for each
    encoding and octave."""
    place = F.least(F.floor(F.col("p") * BINS), F.lit(BINS - 1)).cast("int")
    counts = tests.groupBy("encoding", "band", place.alias("bin")).agg(F.count("*").alias("n"))
    upper = F.sum(F.when(F.col("bin") >= BINS // 2, F.col("n")).otherwise(0)) / (BINS - BINS // 2)
    entries = F.map_from_entries(F.collect_list(F.struct("bin", "n")))
    strata = counts.groupBy("encoding", "band").agg(upper.alias("rate"), entries.alias("entries"))
    bins = F.sequence(F.lit(0), F.lit(BINS - 1))
    strata = computed(strata, found=F.transform(bins, lambda b: F.coalesce(F.element_at("entries", b), F.lit(0))))

    def good(b: Column) -> Column:
        """Of the tokens from bin `b` on all but the allowed share can be random."""
        many = F.aggregate(F.slice("found", b + 1, F.lit(BINS)), F.lit(0).cast("long"), lambda acc, x: acc + x)
        return (many > 0) & (many - F.col("rate") * (BINS - b) <= false * many)

    return strata.select("encoding", "band", F.array_min(F.filter(bins, good)).alias("least")).where("least is not null")


def _joined(spans: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of spans (start, kind as a number, end), by start and then kind."""
    names = F.lit(list(kinds))
    written = F.transform(
        F.array_sort(spans),
        lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.concat_ws(",", written)


def _long_enough(matches: str, field: str, least: int) -> Column:
    return F.filter(matches, lambda m: F.length(m[field]) >= least)


def _spans(matches: Column, kind: int) -> Column:
    return F.transform(matches, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))


def scan(docs: DataFrame, false: float = FALSE) -> DataFrame:
    """doc_id, the number of spans of each pattern, digest of these spans and all spans of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    patterns = {k: (LONG.get(k, p), g) for k, (p, g, _) in PATTERNS.items()} | {RANDOM: (TOKEN, 0)}
    placed = occurrences(rows, patterns)
    for kind, (_, group, least) in PATTERNS.items():
        placed = placed.withColumn(kind, _long_enough(kind, "part" if group else "found", least))
    spans = F.concat(*[_spans(F.col(k), i) for i, k in enumerate(KINDS)])
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in KINDS]
    facts = stage(placed.select("row", "doc_id", *counts, spans.alias("base"), RANDOM), "secrets-found")

    tokens = facts.select("row", F.inline(RANDOM)).select("row", "start", "end", F.col("found").alias("token"))
    tests = stage(tested(inferred(tokens)).select("row", "start", "end", "encoding", "band", "p"), "secrets-tested")
    # one row an encoding and octave of length, and lengths are below 2^31
    limits = F.broadcast(thresholds(tests, false))
    secret = tests.join(limits, ["encoding", "band"]).where(F.col("p") * BINS >= F.col("least"))
    random = _spans(F.collect_list(F.struct("start", "end")), len(KINDS)).alias("random_spans")
    found = secret.groupBy("row").agg(random)
    known = facts.drop(RANDOM).join(found, "row", "left")
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    every = F.concat("base", F.coalesce("random_spans", none))
    return known.select(
        "doc_id",
        *[f"n_{k}" for k in KINDS],
        F.sha2(_joined(F.col("base"), KINDS).cast("binary"), 256).alias("base_sha256"),
        _joined(every, (*KINDS, RANDOM)).alias("spans"),
    )
