"""Folios in document texts and unit codes in movement texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that decide which text is a code. `\z` and [0-9] instead of `$` and `\d`:
# in Java `$` also matches before a final newline, and `\d` has Unicode variants.
FOLIO_EXACT = r"^[MS]-[0-9]{6}-[0-9]+\z"
FOLIO_BARE = r"^[0-9]{6}-[0-9]+\z"
FOLIO_SEPARATOR = r"[/,;]"
FOLIO_ANYWHERE = r"[0-9]{6}-[0-9]+"
FOLIO_SCAN = r"[MS]?-?[0-9]{6}-[0-9]+"
UNIT_PREFIX = r"(?:AP|TP|TR|AR|PR)-"
UNIT_THREE_DIGITS = rf"^{UNIT_PREFIX}[0-9]{{3}}\z"
UNIT_SHORT = rf"^{UNIT_PREFIX}[0-9]{{1,2}}\z"
UNIT_WHOLE = rf"^{UNIT_PREFIX}[0-9]{{1,3}}\z"
UNIT_ANYWHERE = rf"{UNIT_PREFIX}[0-9]{{1,3}}"
UNIT_BOUNDED = rf"(?<![A-Za-z0-9]){UNIT_ANYWHERE}(?![A-Za-z0-9])"
UNIT_STORED = rf"{UNIT_PREFIX}[0-9]{{2,3}}"


def folio_shape(text: Column, shapes: Sequence[str] = ("exact", "bare", "multi")) -> Column:
    """`exact`, `bare`, `multi` or NULL. The shapes exclude each other, as only `multi` has a
    separator; any of them can therefore be left out."""
    tests = {
        "exact": text.rlike(FOLIO_EXACT),
        "bare": text.rlike(FOLIO_BARE),
        "multi": text.rlike(FOLIO_SEPARATOR) & text.rlike(FOLIO_ANYWHERE),
    }
    return F.coalesce(*[F.when(tests[s], F.lit(s)) for s in shapes])


def folio_scan(text: Column) -> Column:
    """All folios of a text from left to right, each with its prefix letter if it has one."""
    return F.regexp_extract_all(text, F.lit(FOLIO_SCAN), F.lit(0))


def folio_prefix(found: Column) -> Column:
    """M, S or '' for one item of `folio_scan`."""
    first = F.substring(found, 1, 1)
    return F.when(first.isin("M", "S"), first).otherwise("")


def folio_number(found: Column) -> Column:
    """`YYMMDD-n` of one item of `folio_scan`: whatever stands before it is made of M, S and -."""
    return F.ltrim(found, F.lit("MS-"))


def _group(text: Column, pattern: str, group: int) -> Column:
    # regexp_extract gives '' both for no match and for an empty group
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _pad3(digits: Column) -> Column:
    return F.lpad(digits, 3, "0")


def bounded_codes(text: Column) -> Column:
    """Every code that stands alone in a text, left to right, with three digits: neither a letter nor a digit touches it,
    and its prefix and digits are of one occurrence."""

    def padded(found: Column) -> Column:
        return F.concat(F.substring(found, 1, 3), _pad3(F.substring(found, 4, 3)))

    return F.transform(F.regexp_extract_all(text, F.lit(UNIT_BOUNDED), F.lit(0)), padded)


def unit_match(
    text: Column,
    trimmed: Column,
    upper: Column,
    steps: Sequence[str] = ("direct", "padded", "text"),
    strict: bool = False,
) -> Column:
    """The unit a movement text names, as an array of at most one (code, eco_number, confidence, rule), or with `strict`
    of all that `text` finds; NULL without one. `trimmed` and `upper` are the text without outer blanks, as written and in
    upper case.

    `code` has three digits and is what is looked up; `eco_number` is what the link stores. Only
    `direct` ignores case: the other rules read the text as written, so that a lower-case prefix
    gives no code. Under `text` the prefix and the digits may come from different places, digits
    beyond the third are cut, only the first code counts, and the stored code needs two or three
    digits as written. With `strict` that rule takes all codes that stand alone, see `bounded_codes`, and stores them
    with three digits. The rules exclude each other.
    """
    # under the short shape a code is its first three characters and the digits behind them
    padded = F.concat(F.substring(upper, 1, 3), _pad3(F.substring(upper, 4, 3)))
    rules = {
        "direct": (upper.rlike(UNIT_THREE_DIGITS), upper, upper, "high"),
        "padded": (
            upper.rlike(UNIT_SHORT),
            F.when(F.substring(trimmed, 1, 3) == F.substring(upper, 1, 3), padded),
            padded,
            "high",
        ),
        "text": (
            upper.rlike(UNIT_ANYWHERE) & ~upper.rlike(UNIT_WHOLE),
            F.concat(
                _group(text, f"({UNIT_PREFIX})", 1), _pad3(_group(text, rf"{UNIT_PREFIX}([0-9]{{1,3}})", 1))
            ),
            _group(trimmed, f"({UNIT_STORED})", 1),
            "medium",
        ),
    }

    def match(step: str) -> Column:
        applies, code, stored, confidence = rules[step]

        def found(code: Column, stored: Column) -> Column:
            return F.struct(
                code.alias("code"),
                stored.alias("eco_number"),
                F.lit(confidence).alias("confidence"),
                F.lit(step).alias("rule"),
            )

        if strict and step == "text":
            return F.when(applies, F.transform(bounded_codes(text), lambda c: found(c, c)))
        return F.when(applies, F.array(found(code, stored)))

    return F.coalesce(*[match(s) for s in steps])
