"""Record linkage: documents to maintenances and accidents, movements to units."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keystitch.functions.codes import (
    UNIT_THREE_DIGITS,
    folio_number,
    folio_prefix,
    folio_scan,
    folio_shape,
    unit_match,
)

# Stored columns; the link operators add `rule`, which only the counters need.
DOCUMENT_LINK = [
    "document_id",
    "link_type",
    "maintenance_id",
    "accident_id",
    "linked_pid",
    "match_method",
    "confidence",
]
MOVEMENT_LINK = ["movement_id", "unit_id", "eco_number", "match_method", "confidence"]

# Names of the rules in the run report, and for movements in `rule`.
DOCUMENT_RULES = ["exact_m", "exact_s", "normalized_m", "normalized_s", "multiple_folios"]
MOVEMENT_RULES = {"direct": "direct_matches", "padded": "normalized_matches", "text": "text_matches"}


def active(table: DataFrame) -> DataFrame:
    """Rows that are not soft-deleted; a NULL flag counts as deleted."""
    return table.filter(F.col("active") == 1)


def _folios(documents: DataFrame, shapes: Sequence[str], distinct: bool) -> DataFrame:
    """(document_id, shape, pos, found): the folios of the active documents, `found` as written."""
    text, shape = F.col("extra_text_three"), F.col("shape")
    scan = folio_scan(text)
    found = F.when(shape == "multi", F.array_distinct(scan) if distinct else scan)
    # a text without folio has the shape NULL and so no rows; a filter on the shape would only
    # be pushed down and match every text twice
    return (
        active(documents)
        .select("document_id", "extra_text_three", folio_shape(text, shapes).alias("shape"))
        .select(
            "document_id",
            "shape",
            F.posexplode(found.when(shape.isNotNull(), F.array(text))).alias("pos", "found"),
        )
    )


def folio_explode(documents: DataFrame) -> DataFrame:
    """(document_id, pos, prefix, date, seq) for every folio of the texts with a separator.

    The separator only admits the text; the whole text is scanned, not its parts.
    """
    number = folio_number(F.col("found"))
    return _folios(documents, ["multi"], distinct=False).select(
        "document_id",
        "pos",
        folio_prefix(F.col("found")).alias("prefix"),
        F.substring(number, 1, 6).alias("date"),
        F.substr(number, F.lit(8)).alias("seq"),
    )


def folio_candidates(
    documents: DataFrame, shapes: Sequence[str] = ("exact", "bare", "multi"), distinct: bool = True
) -> DataFrame:
    """(document_id, shape, link_type, pid) to look up: M is a maintenance, S an accident, and a folio
    without prefix is tried as both. `distinct` drops a folio repeated within its text."""
    prefix, number = folio_prefix(F.col("found")), folio_number(F.col("found"))
    kinds = (
        F.when(prefix == "M", F.array(F.lit("maintenance")))
        .when(prefix == "S", F.array(F.lit("accident")))
        .otherwise(F.array(F.lit("maintenance"), F.lit("accident")))
    )
    letter = F.when(F.col("link_type") == "maintenance", "M-").otherwise("S-")
    return (
        _folios(documents, shapes, distinct)
        .select("document_id", "shape", number.alias("number"), F.explode(kinds).alias("link_type"))
        .select("document_id", "shape", "link_type", F.concat(letter, "number").alias("pid"))
    )


def link_documents(
    documents: DataFrame,
    maintenances: DataFrame,
    accidents: DataFrame,
    links: DataFrame,
    shapes: Sequence[str] = ("exact", "bare", "multi"),
    kinds: Sequence[str] = ("maintenance", "accident"),
) -> DataFrame:
    """New document links.

    All rules run in one pass: their text shapes exclude each other, and a folio that goes to both
    lookups fills different columns, so no rule can see what another one adds. `shapes` and `kinds`
    choose single rules.
    """
    wanted = folio_candidates(documents, shapes).filter(F.col("link_type").isin(*kinds))
    lookups = {"maintenance": maintenances, "accident": accidents}
    lookup = None
    for kind in kinds:
        part = active(lookups[kind]).select(F.lit(kind).alias("link_type"), "pid", F.col("id").alias("_id"))
        lookup = part if lookup is None else lookup.unionByName(part)
    known = (
        active(links)
        .select(
            "document_id",
            F.inline(
                F.array(
                    F.struct(F.lit("maintenance").alias("link_type"), F.col("maintenance_id").alias("_id")),
                    F.struct(F.lit("accident").alias("link_type"), F.col("accident_id").alias("_id")),
                )
            ),
        )
        .filter(F.col("_id").isNotNull())
    )
    # the rules in their order, should a document be listed twice
    order = F.when(F.col("shape") == "exact", 0).when(F.col("shape") == "bare", 1).otherwise(2)
    found = (
        wanted.join(lookup, ["link_type", "pid"])
        .join(known, ["document_id", "link_type", "_id"], "left_anti")
        # Grouped by the keys of the anti join, so this adds no shuffle; a plain distinct would also
        # be content with the partitions of the lookup join, and keep a hot folio in one of them.
        .groupBy("document_id", "link_type", "_id")
        .agg(F.min("pid").alias("linked_pid"), F.min(order).alias("order"))
    )
    maintenance, exact, multi = F.col("link_type") == "maintenance", F.col("order") == 0, F.col("order") == 2
    rule = (
        F.when(multi, "multiple_folios")
        .when(exact, F.when(maintenance, "exact_m").otherwise("exact_s"))
        .otherwise(F.when(maintenance, "normalized_m").otherwise("normalized_s"))
    )
    return found.select(
        "document_id",
        "link_type",
        F.when(maintenance, F.col("_id")).alias("maintenance_id"),
        F.when(~maintenance, F.col("_id")).alias("accident_id"),
        "linked_pid",
        F.when(exact, "auto_exact").otherwise("auto_normalized").alias("match_method"),
        F.when(multi, "medium").otherwise("high").alias("confidence"),
        rule.alias("rule"),
    )


def link_movements(
    movements: DataFrame,
    units: DataFrame,
    links: DataFrame,
    steps: Sequence[str] = ("direct", "padded", "text"),
    strict: bool = False,
) -> DataFrame:
    """New movement links. A text falls under at most one of the three rules, so one pass does. With `strict` a free text
    links every unit whose code stands alone in it, instead of one put together from parts. Of several
    rows of one movement that name the same unit the one with the earliest rule counts."""
    text = F.col("extra_text_one")
    coded = (
        active(movements)
        .select("movement_id", "extra_text_one", F.trim(text).alias("trimmed"), F.upper(F.trim(text)).alias("upper"))
        .select("movement_id", F.inline(unit_match(text, F.col("trimmed"), F.col("upper"), steps, strict)))
        .filter(F.col("code").isNotNull())
    )
    code = F.upper("eco_number")
    # every rule looks up a three-digit code, so other units cannot match
    lookup = active(units).filter(code.rlike(UNIT_THREE_DIGITS)).select(
        code.alias("code"), F.col("id").alias("unit_id")
    )
    return (
        coded.join(lookup, "code")
        .join(active(links).select("movement_id", "unit_id"), ["movement_id", "unit_id"], "left_anti")
        .select(
            "movement_id",
            "unit_id",
            "eco_number",
            F.lit("auto_direct").alias("match_method"),
            "confidence",
            "rule",
        )
        .groupBy("movement_id", "unit_id")
        .agg(F.min(F.struct(_rank(steps), "eco_number", "match_method", "confidence", "rule")).alias("link"))
        .select("movement_id", "unit_id", "link.eco_number", "link.match_method", "link.confidence", "link.rule")
    )


def _rank(steps: Sequence[str]) -> Column:
    """Place of a rule in the order of the steps."""
    return F.array_position(F.lit([*steps]), F.col("rule")).alias("rank")


def document_link_stats(links: DataFrame) -> DataFrame:
    """One row of counts over the active document links, from one scan."""
    method, kind = F.col("match_method"), F.col("link_type")
    return active(links).agg(
        F.count(F.lit(1)).alias("total_links"),
        F.count_if(method == "auto_exact").alias("auto_exact"),
        F.count_if(method == "auto_normalized").alias("auto_normalized"),
        F.count_if(method == "manual").alias("manual_links"),
        F.count_if(kind == "maintenance").alias("maintenance_links"),
        F.count_if(kind == "accident").alias("accident_links"),
    )


def movement_link_stats(links: DataFrame) -> DataFrame:
    """One row of counts over the active movement links, from one scan."""
    method = F.col("match_method")
    return active(links).agg(
        F.count(F.lit(1)).alias("total_links"),
        F.count_if(method == "auto_direct").alias("auto_direct"),
        F.count_if(method == "auto_via_document").alias("auto_via_document"),
        F.count_if(method == "manual").alias("manual_links"),
    )


def link_delta(links: DataFrame, new_links: DataFrame) -> DataFrame:
    """One row (before, after, delta): active links without and with the new ones."""
    both = active(links).select(F.lit(0).alias("new")).unionByName(new_links.select(F.lit(1).alias("new")))
    return both.agg(
        F.count_if(F.col("new") == 0).alias("before"),
        F.count(F.lit(1)).alias("after"),
        F.count_if(F.col("new") == 1).alias("delta"),
    )
