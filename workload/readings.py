"""Queries on sensor readings: landing, mapping, insertion, day ranges and malformed hours."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystitch.functions.hours import normalize_hour as hour_of
from keystitch.functions.text import script_trim
from keystitch.operators import quality as Q
from keystitch.operators import ranges as R
from keystitch.operators import readings as G
from keystitch.plans.cleanup import clean_hours, clean_table
from keystitch.plans.ingest import READINGS_SCHEMA, high_water_days, ingest_readings, read_readings
from keystitch.sources.responses import READING_FIELDS, scan_responses
from keystitch.sources.tables import new_folder
from keystitch.streaming.readings import ingest_stream
from workload.standins import standin

NOW = datetime(2024, 2, 3, 5, 0)
RESPONSE_ROWS = 500


_LANDED: dict[tuple[str, str], str] = {}


def land_responses(spark: SparkSession, sf: str) -> str:
    """Folder with the raw readings as the responses they came in, written once per application: at
    most 500 readings per body, one folder per requested day, and in each folder one body that is an
    error message."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LANDED:
        _LANDED[key] = _land(spark, sf)
    return _LANDED[key]


def _land(spark: SparkSession, sf: str) -> str:
    path = new_folder(spark, "landed")
    raw = standin(spark, sf, "readings_raw")
    bodies = raw.groupBy(F.col("dia").alias("day"), F.expr(f"ord div {RESPONSE_ROWS}").alias("seq")).agg(
        F.sort_array(F.collect_list(F.struct("ord", *READING_FIELDS))).alias("data")
    )
    fields = F.transform("data", lambda r: F.struct(*[r[f].alias(f) for f in READING_FIELDS]))
    bodies.withColumn("data", fields).write.partitionBy("day").json(path)
    error = F.lit('{"seq": -1, "data": "no readings"}').alias("value")
    raw.select(F.col("dia").alias("day")).distinct().select("day", error).write.mode("append").partitionBy(
        "day"
    ).text(path)
    return path


def _raw(spark, sf):
    return standin(spark, sf, "readings_raw")


def _mapped(spark, sf):
    return G.map_readings(_raw(spark, sf), keep=["ord", "dia"])


def _target(spark, sf):
    return standin(spark, sf, "tgt_readings")


def _range(spark, sf):
    return R.high_water_range(_target(spark, sf), NOW)


def insert_ignore(spark, sf):
    return G.new_readings(_target(spark, sf), G.valid_readings(_mapped(spark, sf)), ["ord"])


def ingest_day_counts(spark, sf):
    return G.day_counts(_mapped(spark, sf), _target(spark, sf))


def day_sequence(spark, sf):
    days = _raw(spark, sf).select(F.col("fecha").cast("date").alias("date"))
    return R.day_sequence(days, "date")


def stream_ingest_readings(spark, sf):
    landed, table = land_responses(spark, sf), new_folder(spark, "readings")
    ingest_stream(spark, landed, table, new_folder(spark, "stream"))
    return read_readings(spark, table)


def _stored_target(spark, sf):
    """The known readings as a table partitioned by date."""
    table, old = new_folder(spark, "readings"), _target(spark, sf)
    absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in READINGS_SCHEMA if f.name not in old.columns]
    old = old.select("*", *absent).select(*READINGS_SCHEMA.names).hint("rebalance", "date")
    old.write.partitionBy("date").parquet(table)
    return table


def _ingest_run(spark, sf):
    landed, table = land_responses(spark, sf), _stored_target(spark, sf)
    return ingest_readings(spark, landed, table, NOW, date(2023, 12, 30), date(2024, 1, 31))


def cleanup_delete_job(spark, sf):
    path = new_folder(spark, "hours")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    hours = standin(spark, sf, "bad_hours").hint("rebalance", "date")
    hours.write.partitionBy("date").option("path", path).saveAsTable(name)
    return clean_table(spark, name).table


QUERIES = {
    "normalize_hour": lambda spark, sf: _raw(spark, sf).select(
        "ord", "hora", hour_of(script_trim(F.col("hora"))).alias("hour")
    ),
    "readings_scan": lambda spark, sf: scan_responses(spark, land_responses(spark, sf)).drop("arrived", "file", "block"),
    "readings_map": _mapped,
    "readings_valid": lambda spark, sf: G.valid_readings(_mapped(spark, sf)),
    "insert_ignore": insert_ignore,
    "high_water_range": _range,
    "high_water_days_job": lambda spark, sf: high_water_days(spark, _stored_target(spark, sf), NOW),
    "pending_days": lambda spark, sf: R.pending_days(_range(spark, sf)),
    "missing_days": lambda spark, sf: R.missing_days(_target(spark, sf)),
    "day_sequence": day_sequence,
    "ingest_day_counts": ingest_day_counts,
    "ingest_totals": lambda spark, sf: G.ingest_totals(ingest_day_counts(spark, sf)),
    "ingest_job": lambda spark, sf: _ingest_run(spark, sf).day_counts,
    "ingest_job_totals": lambda spark, sf: _ingest_run(spark, sf).totals,
    "stream_ingest_readings": stream_ingest_readings,
    "bad_hour_count": lambda spark, sf: Q.bad_hour_count(standin(spark, sf, "bad_hours")),
    "bad_hour_sample": lambda spark, sf: Q.bad_hour_sample(standin(spark, sf, "bad_hours")),
    "bad_hour_by_date": lambda spark, sf: Q.bad_hour_by_date(standin(spark, sf, "bad_hours")),
    "bad_hour_profile": lambda spark, sf: Q.bad_hour_profile(standin(spark, sf, "bad_hours")),
    "bad_hour_clean": lambda spark, sf: Q.without_bad_hours(standin(spark, sf, "bad_hours")),
    "cleanup_delete_job": cleanup_delete_job,
    "cleanup_job": lambda spark, sf: clean_hours(standin(spark, sf, "bad_hours")).by_date,
}

_HOUR = r"""case when regexp_matches(trim(hora, ' '), '^\d{2}:\d{2}(:\d{2})?$') then trim(hora, ' ')[1:5]
    when regexp_matches(trim(hora, ' '), '^\d+$')
    then lpad(trim(hora, ' '), cast(greatest(6, length(trim(hora, ' '))) as int), '0')[1:2] || ':'
      || lpad(trim(hora, ' '), cast(greatest(6, length(trim(hora, ' '))) as int), '0')[3:4] end"""


def _number(c: str) -> str:
    t = f"trim({c}, ' ')"
    pattern = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
    return f"case when regexp_matches({t}, '{pattern}') then try_cast({t} as double) end"


_MAPPED = f"""mapped as (
    select ord, dia, fecha as date, {_HOUR} as hour, cast({_number("numero_tanque")} as int) as tank_number,
        cast({_number("status_actual")} as int) as actual_status, {_number("volumen")} as volume,
        {_number("volumen_compensado")} as compensated_volume, {_number("altura")} as height,
        {_number("temperatura")} as temperature, {_number("volument_agua")} as water_volume
    from readings_raw)"""
_VALID = rf"""{_MAPPED}, valid as (
    select * replace (cast(date as date) as date) from mapped
    where date <> '' and regexp_matches(hour, '^\d{{2}}:\d{{2}}$') and tank_number > 0 and date = dia)"""
_FRESH = f"""{_VALID}, fresh as (
    select * exclude (n) from (
        select *, row_number() over (partition by date, hour, tank_number order by ord) as n from valid) v
    where n = 1 and not exists (select 1 from tgt_readings t
        where t.date = v.date and t.hour = v.hour and t.tank_number = v.tank_number))"""
_COUNTS = f"""{_FRESH}, counts as (
    select r.day, r.fetched, coalesce(v.valid, 0) as valid, coalesce(f.inserted, 0) as inserted,
           coalesce(v.valid, 0) - coalesce(f.inserted, 0) as skipped
    from (select dia as day, count(*) as fetched from readings_raw group by dia) r
    left join (select dia as day, count(*) as valid from valid group by dia) v on v.day = r.day
    left join (select dia as day, count(*) as inserted from fresh group by dia) f on f.day = r.day)"""
_YESTERDAY = "cast(timestamp '2024-02-03 05:00:00' - interval 6 hour as date) - 1"
_RANGE = f"""span as (select max(date) as last_date, coalesce(max(date) + 1, {_YESTERDAY}) as from_day,
        {_YESTERDAY} as to_day, max(date) is null as empty from tgt_readings where active = 1)"""
_BAD = r"bad as (select * from bad_hours where regexp_matches(hour, '^[0-9]{2}:[0-9]:$'))"
_BY_DATE = f"{_BAD}, by_date as (select date, cast(count(*) as int) as rows from bad group by date)"

ORACLES = {
    "normalize_hour": f"select ord, hora, {_HOUR} as hour from readings_raw",
    "readings_scan": f"""select dia, ord // {RESPONSE_ROWS} as seq,
        cast(row_number() over (partition by dia, ord // {RESPONSE_ROWS} order by ord) - 1 as int) as pos,
        {", ".join(READING_FIELDS)} from readings_raw""",
    "readings_map": f"with {_MAPPED} select * from mapped",
    "readings_valid": f"with {_VALID} select * from valid",
    "insert_ignore": f"with {_FRESH} select * from fresh",
    "high_water_range": f"with {_RANGE} select *, from_day > to_day as up_to_date from span",
    "pending_days": f"""with {_RANGE} select cast(d as date) as day from span,
        unnest(generate_series(cast(from_day as timestamp), cast(to_day as timestamp), interval 1 day)) as g(d)""",
    "missing_days": """with live as (select date from tgt_readings where active = 1)
        select cast(d as date) as day from (select min(date) as a, max(date) as b from live),
        unnest(generate_series(cast(a as timestamp), cast(b as timestamp), interval 1 day)) as g(d)
        where cast(d as date) not in (select date from live)""",
    "day_sequence": """select cast(d as date) as day
        from (select cast(min(fecha) as timestamp) as a, cast(max(fecha) as timestamp) as b from readings_raw),
        unnest(generate_series(a, b, interval 1 day)) as g(d)""",
    "ingest_day_counts": f"with {_COUNTS} select * from counts",
    "ingest_totals": f"""with {_COUNTS} select count(*) as days, cast(sum(fetched) as bigint) as fetched,
        cast(sum(valid) as bigint) as valid, cast(sum(inserted) as bigint) as inserted,
        cast(sum(skipped) as bigint) as skipped, cast(0 as bigint) as errors from counts""",
    "ingest_job": f"""with {_COUNTS}
        select strftime(d, '%Y-%m-%d') as day, coalesce(fetched, 0) as fetched, coalesce(valid, 0) as valid,
            coalesce(inserted, 0) as inserted, coalesce(skipped, 0) as skipped
        from unnest(generate_series(timestamp '2023-12-30', timestamp '2024-01-31', interval 1 day)) as g(d)
        left join counts c on c.day = strftime(d, '%Y-%m-%d')""",
    "ingest_job_totals": f"""with {_COUNTS}, asked as (
            select strftime(d, '%Y-%m-%d') as day, c.* exclude (day)
            from unnest(generate_series(timestamp '2023-12-30', timestamp '2024-01-31', interval 1 day)) as g(d)
            left join counts c on c.day = strftime(d, '%Y-%m-%d'))
        select count(*) as days, cast(coalesce(sum(fetched), 0) as bigint) as fetched,
            cast(coalesce(sum(valid), 0) as bigint) as valid, cast(coalesce(sum(inserted), 0) as bigint) as inserted,
            cast(coalesce(sum(skipped), 0) as bigint) as skipped,
            cast(count(*) filter (fetched is null) as bigint) as errors
        from asked""",
    "stream_ingest_readings": f"""with {_VALID} select * exclude (n, ord, dia), 1 as active from (
        select *, row_number() over (partition by date, hour, tank_number order by ord) as n from valid)
        where n = 1""",
    "bad_hour_count": f"with {_BAD} select cast(count(*) as int) as total from bad",
    "bad_hour_sample": f"with {_BAD} select * from bad order by id desc limit 5",
    "bad_hour_by_date": f"with {_BY_DATE} select * from by_date",
    "bad_hour_profile": f"""with {_BY_DATE} select count(*) as days, min(date) as first_day,
        max(date) as last_day, min(rows) as min_rows, max(rows) as max_rows from by_date""",
    "bad_hour_clean": r"""select * from bad_hours
        where hour is null or not regexp_matches(hour, '^[0-9]{2}:[0-9]:$')""",
    "cleanup_job": f"with {_BY_DATE} select * from by_date",
}
ORACLES["high_water_days_job"] = ORACLES["high_water_range"]
ORACLES["cleanup_delete_job"] = ORACLES["bad_hour_clean"]
