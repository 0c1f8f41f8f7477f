"""Counts of tables and reports of runs."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from keystitch.operators.links import DOCUMENT_RULES, MOVEMENT_RULES, active

# Counters of a synchronisation, and the mark before a summary in the log.
COUNTERS = ["missing", "inserted", "updated", "errors"]
SUMMARY_MARK = "::SUMMARY_JSON::"


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def sync_report(table_counts: list[DataFrame]) -> DataFrame:
    """(name, missing, inserted, updated, errors) per table and, under the name NULL, in total."""
    return (
        union_all(table_counts)
        .rollup("name")
        .agg(*[F.sum(c).alias(c) for c in COUNTERS])
    )


def max_id_or_one(table: DataFrame, column: str = "id") -> DataFrame:
    """Start value of a key generator after a load."""
    return table.agg(F.coalesce(F.max(column), F.lit(1).cast("bigint")).alias("next_base"))


def verify_counts(tables: Mapping[str, DataFrame], number_of_tables: int, label: str = "tables") -> DataFrame:
    """(check, total) as text: number of tables, then rows of each given table."""
    first = next(iter(tables.values())).sparkSession.range(1).select(
        F.lit(label).alias("check"), F.lit(str(number_of_tables)).alias("total")
    )
    counts = [
        t.agg(F.count(F.lit(1)).cast("string").alias("total")).select(F.lit(n).alias("check"), "total")
        for n, t in tables.items()
    ]
    return union_all([first, *counts])


def _json(script: str, elapsed: float, fields: list[Column]) -> Column:
    head = [F.lit(script).alias("script"), F.lit(float(elapsed)).alias("elapsed_seconds")]
    options = {"ignoreNullFields": "false"}
    return F.to_json(F.struct(*head, *fields), options).alias("summary")


def sync_summary(report: DataFrame, script: str = "sync", elapsed: float = 0.0) -> DataFrame:
    """One JSON row: the counters of each table and their totals. One entry per table spec."""
    entry = F.struct("name", *COUNTERS)
    return report.agg(
        F.sort_array(F.collect_list(F.when(F.col("name").isNotNull(), entry))).alias("tables"),
        F.first(F.when(F.col("name").isNull(), F.struct(*COUNTERS)), ignorenulls=True).alias("totals"),
    ).select(_json(script, elapsed, [F.col("tables"), F.col("totals")]))


def counts_row(spark: SparkSession, counts: Mapping[str, int], name: str | None = None) -> DataFrame:
    """One row of counters a run has at hand, after the name of its table if one is given."""
    head = [] if name is None else [F.lit(name).alias("name")]
    return spark.range(1).select(*head, *[F.lit(n).cast("bigint").alias(c) for c, n in counts.items()])


def patch_summary(counts: DataFrame, script: str = "patch", elapsed: float = 0.0) -> DataFrame:
    """One JSON row: changes found, rows patched, and changes that met no row."""
    return counts.select(_json(script, elapsed, [F.col("candidates"), F.col("updated"), F.col("errors")]))


def link_counts(
    document_links: DataFrame,
    new_document_links: DataFrame,
    movement_links: DataFrame,
    new_movement_links: DataFrame,
) -> DataFrame:
    """One row (documents, movements), each a struct of the active links before and after, the
    difference and the new links of each rule."""

    def part(kind: str, links: DataFrame, new: DataFrame) -> DataFrame:
        old = active(links).select(F.lit(kind).alias("kind"), F.lit(None).cast("string").alias("rule"))
        return old.unionByName(new.select(F.lit(kind).alias("kind"), "rule"))

    def counts(kind: str, rules: Mapping[str, str]) -> Column:
        mine, rule = F.col("kind") == kind, F.col("rule")
        result = F.struct(*[F.count_if(mine & (rule == r)).alias(label) for r, label in rules.items()])
        return F.struct(
            F.count_if(mine & rule.isNull()).alias("before"),
            F.count_if(mine).alias("after"),
            F.count_if(mine & rule.isNotNull()).alias("delta"),
            result.alias("result"),
        ).alias(kind)

    rows = part("documents", document_links, new_document_links).unionByName(
        part("movements", movement_links, new_movement_links)
    )
    return rows.agg(counts("documents", {r: r for r in DOCUMENT_RULES}), counts("movements", MOVEMENT_RULES))


def link_summary(counts: DataFrame, script: str = "link", elapsed: float = 0.0) -> DataFrame:
    """One JSON row of `link_counts`."""
    return counts.select(_json(script, elapsed, [F.col("documents"), F.col("movements")]))


def readings_summary(
    totals: DataFrame,
    day_range: Row,
    last_synced: DataFrame | None = None,
    script: str = "readings",
    elapsed: float = 0.0,
) -> DataFrame:
    """One JSON row of `ingest_totals`.

    `day_range` is the row of `range_warnings` the run worked on; `last_synced` gives the last day
    after an automatic run and is None after a manual one.
    """
    idle = day_range["up_to_date"]
    day = F.lit(None).cast("string") if last_synced is None else last_synced.scalar().cast("string")
    bounds = [
        F.lit(None if idle else str(day_range[c])).cast("string").alias(name)
        for c, name in (("from_day", "from"), ("to_day", "to"))
    ]
    counters = ["fetched", "valid", "inserted", "skipped", "errors"]
    return totals.select(
        _json(
            script,
            elapsed,
            [
                F.lit("manual" if last_synced is None else "auto").alias("mode"),
                day.alias("last_synced_date"),
                *bounds,
                F.lit(day_range["days"]).alias("days"),
                *[F.col(c) for c in counters],
                F.lit(day_range["warnings"]).cast("array<string>").alias("warnings"),
            ],
        )
    )


def summary_line(summary: str) -> str:
    """The line a scheduler looks for in the log of a run."""
    return SUMMARY_MARK + summary
