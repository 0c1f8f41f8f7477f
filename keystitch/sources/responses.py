"""Landed sensor responses: one JSON body per line, below one folder `day=YYYY-MM-DD` per requested day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Field names of one reading in a response.
READING_FIELDS = [
    "fecha",
    "hora",
    "numero_tanque",
    "status_actual",
    "volumen",
    "volumen_compensado",
    "altura",
    "temperatura",
    "volument_agua",
]
UNREADABLE = "_corrupt_record"
BODY_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("data", T.VariantType()),
        T.StructField("day", T.StringType()),
        T.StructField(UNREADABLE, T.StringType()),
    ]
)
_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": UNREADABLE}

# Columns that tell which of two readings came first: the number a body has, if any, then when and where its file came.
# `place`, which `with_place` adds, orders what stands in one piece of a file.
ARRIVAL = ["seq", "arrived", "file", "block"]
PLACE = "place"


def _bodies(lines: DataFrame) -> DataFrame:
    """Bodies with the state they are in and the file they came in."""
    data = F.col("data")
    return lines.select(
        "day",
        "seq",
        "data",
        F.col(UNREADABLE).isNotNull().alias("unreadable"),
        (data.isNotNull() & ~F.coalesce(F.is_variant_null(data), F.lit(True))).alias("given"),
        F.col("_metadata.file_modification_time").alias("arrived"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def explode_responses(bodies: DataFrame, every_body: bool = False) -> DataFrame:
    """One row per element of `data` with its place of arrival.

    A body is parsed once, into a variant, in which a number, a quoted number and junk stay apart; every field is read
    from it as text. An element that is no object is a row of NULLs. A body that is unreadable, or whose `data` is no
    array, has no rows, or with `every_body` one without `pos`.
    """
    items = F.try_variant_get("data", "$", "array<variant>")
    explode = F.posexplode_outer if every_body else F.posexplode
    fields = [F.try_variant_get("item", f"$.{f}", "string").alias(f) for f in READING_FIELDS]
    states = ["unreadable", "given"] if every_body else []
    found = bodies.select(F.col("day").alias("dia"), *ARRIVAL, *states, explode(items).alias("pos", "item"))
    return found.select("dia", *ARRIVAL, *states, "pos", *fields)


def with_place(readings: DataFrame) -> DataFrame:
    """Add the order in which a task met the rows. Filter by day before, as no filter passes this."""
    return readings.withColumn(PLACE, F.monotonically_increasing_id())


def scan_bodies(spark: SparkSession, path: str) -> DataFrame:
    """The landed bodies; `unreadable` marks one that is no JSON object, `given` one that has `data`."""
    return _bodies(spark.read.schema(BODY_SCHEMA).options(**_OPTIONS).json(path))


def failed_days(bodies: DataFrame, days: DataFrame, day: str = "day") -> DataFrame:
    """Those of the requested days that have an unreadable body, or none with `data`."""
    landed = bodies.groupBy(F.col(day).try_cast("date").alias("day")).agg(
        F.max("unreadable").alias("unreadable"), F.max("given").alias("given")
    )
    failed = F.coalesce(F.col("unreadable") | ~F.col("given"), F.lit(True))
    return days.join(landed, "day", "left").filter(failed).select("day")


def scan_responses(spark: SparkSession, path: str) -> DataFrame:
    """Batch scan; a filter on `dia` prunes the day folders."""
    return explode_responses(scan_bodies(spark, path))


def stream_responses(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(BODY_SCHEMA).options(**_OPTIONS)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return explode_responses(_bodies(reader.json(path)))
