"""Gzip CSV export and import that keep NULL, '', quotes, line breaks and outer blanks apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_COMMON = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    # the default formats would cut timestamps to milliseconds
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def write_csv_gz(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """NULL is written as nothing and '' as a pair of quotes. Neither gzip nor quoted line breaks can
    be split on reading, so the rows per file bound the work of one reading task."""
    (
        df.write.options(**_COMMON, nullValue="", emptyValue='""', compression="gzip")
        .option("maxRecordsPerFile", rows_per_file)
        # fixed value: level 1, as compression otherwise takes most of the time
        .option("zlib.compress.level", "BEST_SPEED")
        .csv(path)
    )


# no text of a table has these two characters side by side: the first is not a character of Unicode
_NO_TEXT = "\uffff\x00"


def read_csv_gz(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return (
        spark.read.schema(schema)
        .options(**_COMMON, multiLine="true", nullValue=_NO_TEXT, emptyValue="", mode="FAILFAST")
        .csv(path)
    )
