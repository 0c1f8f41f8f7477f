"""Readings: validity, insertion, counters, day ranges, ingest and stream; and the malformed hours."""

import json
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from keystitch.operators import quality as Q
from keystitch.operators import ranges as R
from keystitch.operators import readings as G
from keystitch.plans.cleanup import clean_hours, clean_table
from keystitch.plans.ingest import READINGS_SCHEMA, high_water_days, ingest_readings, newest_active_day, read_readings
from keystitch.sources.responses import READING_FIELDS, failed_days, scan_bodies, scan_responses
from keystitch.sources.tables import empty_table
from keystitch.streaming.readings import ingest_stream
from workload.readings import QUERIES

NOW = datetime(2024, 2, 3, 5, 0)  # still 2 February in local time, so yesterday is 1 February


def reading(day, hour, tank, volume=1, **more):
    return {"fecha": day, "hora": hour, "numero_tanque": tank, "volumen": volume} | more


def land(folder, day, data, seq=0, name="a"):
    place = folder / f"day={day}"
    place.mkdir(parents=True, exist_ok=True)
    (place / f"{name}.json").write_text(json.dumps({"seq": seq, "data": data}) + "\n")


def raw_frame(spark, readings):
    schema = "ord long, dia string, " + ", ".join(f"{f} string" for f in READING_FIELDS)
    return spark.createDataFrame(
        [
            (i, r.get("dia", r["fecha"]), *[None if r.get(f) is None else str(r.get(f)) for f in READING_FIELDS])
            for i, r in enumerate(readings)
        ],
        schema,
    )


DAY = "2024-01-05"
READINGS = [
    reading(DAY, "09:30", 1, 10),
    reading(DAY, "093000", 1, 11),  # same key in another form: the first one wins
    reading(DAY, "09:30", 2, ""),
    reading(DAY, "9:30", 1),
    reading(DAY, None, 1),
    reading(DAY, "10:00", 0),
    reading(DAY, "10:00", "NaN"),
    reading(DAY, "10:00", ""),
    reading(DAY, "99:99", 3),
    reading("2024-01-04", "10:00", 1, dia=DAY),  # another day than the requested one
    reading("", "10:00", 1, dia=DAY),
]
NO_DAY = reading("someday", "10:00", 1)


def test_valid_and_new_readings(spark):
    mapped = G.map_readings(raw_frame(spark, READINGS), keep=["ord", "dia"])
    valid = G.valid_readings(mapped)
    assert [r.ord for r in valid.orderBy("ord").collect()] == [0, 1, 2, 8]
    target = spark.createDataFrame([(date(2024, 1, 5), "09:30", 2)], "date date, hour string, tank_number int")
    new = G.new_readings(target, valid, ["ord"]).orderBy("ord").collect()
    assert [(r.hour, r.tank_number, r.volume) for r in new] == [("09:30", 1, 10.0), ("99:99", 3, 1.0)]
    counts = G.day_counts(mapped, target)
    assert [tuple(r) for r in counts.collect()] == [(DAY, 11, 4, 2, 2)]
    days = spark.createDataFrame([(date(2024, 1, 5),), (date(2024, 1, 6),)], "day date")
    full = G.complete_days(counts, days)
    assert [tuple(r) for r in full.collect()] == [(DAY, 11, 4, 2, 2), ("2024-01-06", 0, 0, 0, 0)]
    failed = spark.createDataFrame([(date(2024, 1, 6),)], "day date")
    assert tuple(G.ingest_totals(full, failed).first()) == (2, 11, 4, 2, 2, 1)


def test_a_folder_that_is_no_day(spark):
    mapped = G.map_readings(raw_frame(spark, [NO_DAY]), keep=["ord", "dia"])
    assert G.valid_readings(mapped).count() == 0
    target = spark.createDataFrame([], "date date, hour string, tank_number int")
    assert [tuple(r) for r in G.day_counts(mapped, target).collect()] == [("someday", 1, 0, 0, 0)]


def target_days(spark, *days):
    return spark.createDataFrame([(d, a) for d, a in days], "date date, active int")


def test_high_water_range(spark):
    span = R.high_water_range(target_days(spark, (date(2024, 1, 25), 1), (date(2024, 1, 30), 0)), NOW)
    assert tuple(span.first()) == (date(2024, 1, 25), date(2024, 1, 26), date(2024, 2, 1), False, False)
    assert R.pending_days(span).count() == 7
    assert R.range_warnings(span).first().warnings == []
    late = R.range_warnings(R.high_water_range(target_days(spark, (date(2024, 1, 1), 1)), NOW)).first()
    assert late.days == 31 and len(late.warnings) == 1

    empty = R.high_water_range(target_days(spark, (date(2024, 1, 30), 0)), NOW)
    assert tuple(empty.first()) == (None, date(2024, 2, 1), date(2024, 2, 1), True, False)
    assert R.pending_days(empty).count() == 1 and len(R.range_warnings(empty).first().warnings) == 1

    done = R.high_water_range(target_days(spark, (date(2024, 2, 1), 1)), NOW)
    assert done.first().up_to_date and R.pending_days(done).count() == 0
    assert R.range_warnings(done).first().days == 0


def test_manual_range(spark):
    a, b = date(2024, 1, 1), date(2024, 1, 3)
    assert R.pending_days(R.manual_range(spark, a, b)).count() == 3
    assert R.pending_days(R.manual_range(spark, a, None)).count() == 1
    assert R.manual_range(spark, None, b).first().from_day == b
    with pytest.raises(ValueError):
        R.manual_range(spark, b, a)
    with pytest.raises(ValueError):
        R.manual_range(spark, None, None)


def test_missing_days(spark):
    table = target_days(spark, (date(2024, 1, 1), 1), (date(2024, 1, 2), 0), (date(2024, 1, 4), 1))
    assert sorted(r.day for r in R.missing_days(table).collect()) == [date(2024, 1, 2), date(2024, 1, 3)]


def test_missing_days_query_reads_every_day(spark, tmp_path):
    # event ids and users that make a valid active reading of the stand-in table
    rows = [(6 * i, "signup", datetime(2024, 1, day, 8), 1, 1.0) for i, day in enumerate((6, 7, 9, 14))]
    events = spark.createDataFrame(rows, "event_id long, event_type string, ts timestamp_ntz, user_id long, value double")
    events.write.parquet(f"{tmp_path}/events.parquet")
    got = QUERIES["missing_days"](spark, str(tmp_path))
    assert sorted(r.day.day for r in got.collect()) == [8, 10, 11, 12, 13]


def test_scan_skips_bodies_without_readings(spark, tmp_path):
    land(tmp_path, DAY, READINGS[:2])
    land(tmp_path, DAY, "down for maintenance", name="b")
    land(tmp_path, DAY, None, name="c")
    land(tmp_path, DAY, [], name="d")
    got = scan_responses(spark, str(tmp_path)).orderBy("pos").collect()
    assert [(r.dia, r.pos, r.hora, r.volumen) for r in got] == [(DAY, 0, "09:30", "10"), (DAY, 1, "093000", "11")]


def test_ingest_job(spark, tmp_path):
    landed, table = tmp_path / "landed", str(tmp_path / "table")
    land(landed, "2024-01-31", [reading("2024-01-31", f"{h:02d}:00", t) for h in range(24) for t in (1, 2)])
    land(landed, "2024-02-01", [reading("2024-02-01", "00:00", 1), reading("2024-02-01", "00:00", 1, 5)])
    land(landed, "2024-02-02", [reading("2024-02-02", "00:00", 1)])  # today: not asked for
    empty_table(spark, READINGS_SCHEMA, table, "date")
    manual = ingest_readings(spark, str(landed), table, NOW, first=date(2024, 1, 31))
    assert [tuple(r) for r in manual.day_counts.collect()] == [("2024-01-31", 48, 48, 48, 0)]
    auto = ingest_readings(spark, str(landed), table, NOW)
    assert [tuple(r) for r in auto.day_counts.collect()] == [("2024-02-01", 2, 2, 1, 1)]
    summary = json.loads(auto.summary.first().summary)
    assert 0 < summary.pop("elapsed_seconds") < 600
    assert summary == {
        "script": "readings",
        "mode": "auto",
        "last_synced_date": "2024-02-01",
        "from": "2024-02-01",
        "to": "2024-02-01",
        "days": 1,
        "fetched": 2,
        "valid": 2,
        "inserted": 1,
        "skipped": 1,
        "errors": 0,
        "warnings": [],
    }
    idle = json.loads(ingest_readings(spark, str(landed), table, NOW).summary.first().summary)
    assert (idle["from"], idle["to"], idle["days"], idle["fetched"]) == (None, None, 0, 0)
    again = ingest_readings(spark, str(landed), table, NOW, date(2024, 1, 31), date(2024, 2, 1))
    for r in again.day_counts.collect():
        assert r.inserted == 0 and r.skipped == r.valid
    assert json.loads(again.summary.first().summary)["mode"] == "manual"
    assert read_readings(spark, table).count() == 49


def test_stream_takes_each_reading_once(spark, tmp_path):
    landed, table, state = tmp_path / "landed", str(tmp_path / "table"), tmp_path / "state"
    land(landed, DAY, READINGS)
    land(landed, "2024-01-07", [reading("2024-01-07", "00:00", 1)])
    ingest_stream(spark, str(landed), table, str(state / "a"), files_per_trigger=1)
    assert read_readings(spark, table).count() == 4
    # the same hour again in a later file, a new one, and a day that lands late
    land(landed, DAY, [reading(DAY, "09:30", 1, 99), reading(DAY, "11:00", 1)], seq=1, name="b")
    land(landed, "2024-01-02", [reading("2024-01-02", "00:00", 1)])
    ingest_stream(spark, str(landed), table, str(state / "a"))
    assert read_readings(spark, table).count() == 6
    # without its checkpoint the stream reads everything again and inserts nothing
    ingest_stream(spark, str(landed), table, str(state / "b"))
    got = read_readings(spark, table)
    assert got.count() == got.select(*G.READING_KEY).distinct().count() == 6
    assert got.filter("hour = '09:30' and tank_number = 1").first().volume == 10.0
    assert {r.active for r in got.collect()} == {1}


def test_bad_hours(spark, rows):
    table = spark.createDataFrame(
        [(1, date(2024, 1, 1), "09:3:"), (2, date(2024, 1, 1), "09:30"), (3, date(2024, 1, 2), "9:3:")]
        + [(4, date(2024, 1, 2), None)]
        + [(i, date(2024, 1, 3), "10:1:") for i in range(5, 12)],
        "id long, date date, hour string",
    )
    assert Q.bad_hour_count(table).first().total == 8
    assert [r.id for r in Q.bad_hour_sample(table).collect()] == [11, 10, 9, 8, 7]
    assert rows(Q.bad_hour_by_date(table)) == [(date(2024, 1, 1), 1), (date(2024, 1, 3), 7)]
    assert tuple(Q.bad_hour_profile(table).first()) == (2, date(2024, 1, 1), date(2024, 1, 3), 1, 7)
    dry, real = clean_hours(table), clean_hours(table, execute=True)
    assert dry.table.count() == 11
    assert dry.table.count() - real.table.count() == dry.count.first().total
    assert [r.id for r in real.table.orderBy("id").collect()] == [2, 3, 4]
    assert clean_hours(real.table, execute=True).count.first().total == 0


def test_odd_elements_and_unreadable_bodies_lose_nothing_else(spark, tmp_path):
    day = tmp_path / "day=2024-01-01"
    day.mkdir()
    good = '{"fecha": "2024-01-01", "hora": "01:00", "numero_tanque": 1}'
    (day / "a.json").write_text(
        f'{{"seq": 1, "data": [{good}, 5, "x", null, [1]]}}\n{{"seq": 2, "data": [{good}\n{{"seq": 3, "data": [{good}]}}\n'
    )
    (tmp_path / "day=2024-01-02").mkdir()
    (tmp_path / "day=2024-01-02" / "b.json").write_text(f'{{"seq": 1, "data": [{good}]}}\n')
    got = scan_responses(spark, str(tmp_path)).filter("dia = '2024-01-01'").orderBy("seq", "pos").collect()
    assert [(r.seq, r.pos, r.numero_tanque) for r in got] == [
        (1, 0, "1"), (1, 1, None), (1, 2, None), (1, 3, None), (1, 4, None), (3, 0, "1")]
    days = spark.sql("select explode(sequence(date'2024-01-01', date'2024-01-03')) as day")
    failed = failed_days(scan_bodies(spark, str(tmp_path)), days).orderBy("day").collect()
    assert [str(r.day) for r in failed] == ["2024-01-01", "2024-01-03"]


def test_without_numbers_the_earlier_file_wins(spark, tmp_path):
    """In batch and as a stream, whatever the files are called, and within a file the earlier line."""
    landed = tmp_path / "landed"
    day = landed / f"day={DAY}"
    day.mkdir(parents=True)
    line = lambda *values: json.dumps({"data": [reading(DAY, "09:30", 1, v) for v in values]}) + "\n"
    (day / "a.json").write_text(line(3))
    (day / "z.json").write_text(line(1, 2) + line(0))
    os.utime(day / "z.json", (1_700_000_000, 1_700_000_000))
    os.utime(day / "a.json", (1_700_000_100, 1_700_000_100))
    for kind in ("batch", "stream"):
        table = str(tmp_path / kind)
        if kind == "batch":
            empty_table(spark, READINGS_SCHEMA, table, "date")
            ingest_readings(spark, str(landed), table, NOW, date(2024, 1, 5))
        else:
            ingest_stream(spark, str(landed), table, str(tmp_path / "state"))
        assert [r.volume for r in read_readings(spark, table).collect()] == [1.0]


def test_bodies_are_parsed_once(spark, tmp_path):
    land(tmp_path, DAY, READINGS[:2])
    text = scan_responses(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in text and "data:variant" in text


def test_values_of_any_json_type_are_read_as_text(spark, tmp_path):
    values = [1, 1.5, "2", True, None, {"a": 1}, [1], "", "n/a", 1e300, 12345678901234567890]
    land(tmp_path, DAY, [reading(DAY, "09:30", 1, v) for v in values])
    mapped = G.map_readings(scan_responses(spark, str(tmp_path)), keep=["pos"]).orderBy("pos")
    assert [r.volume for r in mapped.collect()] == [1.0, 1.5, 2.0, None, None, None, None, None, None, 1e300, 12345678901234567890.0]


def test_cleaned_table_rewrites_touched_days_only(spark):
    data = [(1, "09:3:", date(2024, 1, 1)), (2, "09:30", date(2024, 1, 1)), (3, "1", date(2024, 1, 2)), (4, "10:1:", date(2024, 1, 3))]
    data += [(5, "08:1:", None), (6, None, None)]
    spark.createDataFrame(data, "id long, hour string, date date").write.partitionBy("date").saveAsTable("hours")
    files = lambda: {r.f for r in spark.table("hours").select(F.input_file_name().alias("f")).distinct().collect()}
    before = files()
    run = clean_table(spark, "hours")
    assert run.count.first().total == 3
    assert [r.id for r in spark.table("hours").orderBy("id").collect()] == [2, 3, 6]
    after = files()
    assert {f for f in before if "2024-01-02" in f} <= after
    assert clean_table(spark, "hours").count.first().total == 0 and files() == after
    spark.sql("drop table hours")


def test_high_water_opens_no_old_day(spark, tmp_path):
    table = str(tmp_path / "table")
    assert newest_active_day(spark, table) is None
    days = [(date(2024, 1, d), 1 if d < 20 else 0 if d % 2 else None) for d in range(1, 31)]
    data = [("00:00", 1, None, None, None, None, None, None, a, d) for d, a in days] + [("00:00", 1, *[None] * 6, 1, None)]
    spark.createDataFrame(data, READINGS_SCHEMA).write.partitionBy("date").parquet(table)
    assert newest_active_day(spark, table) == date(2024, 1, 19)
    for d in range(1, 14):
        for file in (tmp_path / "table" / f"date=2024-01-{d:02d}").glob("*.parquet"):
            file.write_bytes(b"no parquet")
    # folders 30, 28-29, 24-27 and 16-23 are read, not those before
    assert newest_active_day(spark, table) == date(2024, 1, 19)
    row = high_water_days(spark, table, NOW).first()
    assert tuple(row) == (date(2024, 1, 19), date(2024, 1, 20), date(2024, 2, 1), False, False)
