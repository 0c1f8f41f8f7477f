"""Reader settings for operational databases. The driver jar comes with the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keystitch.functions.stamps import NEVER
from keystitch.sources.specs import TableSpec


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    num_partitions: int = 64,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of one scan. With a numeric partition column the scan runs as `num_partitions`
    parallel range queries; without one Spark would pull the table through a single task."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if partition_column:
        if bounds is None:
            raise ValueError("a partitioned scan needs the lower and upper bound of its column")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(num_partitions),
        }
    return options


def modified_table(spec: TableSpec, stamp: str) -> str:
    """`dbtable` text for the rows modified after a text stamp.

    The comparison has to run in the database, as Spark cannot push a parsed text stamp down.
    """
    column = spec.source_modified_col
    names = ", ".join(spec.columns)
    return (
        f"(SELECT {names} FROM {spec.name} WHERE {column} NOT IN ('', '{NEVER}')"
        f" AND CONVERT(DATETIME, {column}, 101) > CONVERT(DATETIME, '{stamp}', 101)) AS modified"
    )


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()
