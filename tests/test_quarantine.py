"""The store of rejected rows: what enters, what is offered again, what leaves."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from keystitch.plans.quarantine import keep_rejects, read_rejects, with_pending
from keystitch.plans.sync import sync_run, sync_table
from keystitch.sources.specs import TableSpec
from keystitch.sources.tables import new_folder, swap_table

SPEC = TableSpec("docs", "docs_kept", "id", "ID", "stamp", {"ID": "id", "V": "v", "TS": "stamp"}, {"id": "long", "v": "double"})
SOURCE, TARGET = "ID string, V string, TS string", "id long, v double, stamp string"
FIRST, SECOND, THIRD = (datetime(2025, 7, n) for n in (1, 2, 3))


def day(month):
    return f"{month:02d}/01/2025 00:00:00:000"


@pytest.fixture
def run(spark):
    store = new_folder(spark, "rejects")

    def once(source, target, at, **more):
        rows, again = with_pending(spark.createDataFrame(source, SOURCE), SPEC, store)
        found = sync_table(rows, target, SPEC, at, again=again, keep_source=True, **more)
        keep_rejects(found.rejects, SPEC, store, at)
        kept = {r.entry: (r.reason, r.first_run.day, r.last_run.day, r.attempts) for r in read_rejects(spark, store).collect()}
        return found, {r.id: r.v for r in found.table.collect()}, kept

    return once


MISFIT = "value does not fit its type"


def test_a_mended_row_leaves_the_store(spark, run):
    target = spark.createDataFrame([(1, 1.0, day(1)), (2, 2.0, day(1))], TARGET)
    source = [("1", "x", day(2)), ("2", "2.5", day(3)), ("3", "y", day(1)), ("4", "4", "")]
    first, table, kept = run(source, target, FIRST)
    assert table == {1: 1.0, 2: 2.5, 4: 4.0}
    assert kept == {"1": (MISFIT, 1, 1, 1), "3": (MISFIT, 1, 1, 1)} and first.counts["errors"] == 2
    # the watermark has passed the edit of 1, which is mended without a new stamp
    source[0] = ("1", "1.5", day(2))
    second, table, kept = run(source, first.table, SECOND)
    assert table == {1: 1.5, 2: 2.5, 4: 4.0} and kept == {"3": (MISFIT, 1, 2, 2)}
    assert second.counts == {"missing": 1, "inserted": 0, "updated": 1, "errors": 1}
    source[2] = ("3", "3", day(1))
    _, table, kept = run(source, second.table, THIRD)
    assert table == {1: 1.5, 2: 2.5, 3: 3.0, 4: 4.0} and kept == {}


def test_rows_that_the_source_has_no_more(spark, run):
    target = spark.createDataFrame([(1, 1.0, day(1))], TARGET)
    low = {"too large": F.col("v") < 10}
    first, table, kept = run([("1", "50", day(2)), ("2", "7", "")], target, FIRST, checks=low)
    assert table == {1: 1.0, 2: 7.0} and kept == {"1": ("too large", 1, 1, 1)}
    second, table, kept = run([("2", "7", "")], first.table, SECOND, checks=low)
    assert table == {1: 1.0, 2: 7.0} and kept == {"1": ("too large", 1, 2, 2)}
    _, table, kept = run([("2", "7", "")], second.table, THIRD, checks={"too large": F.col("v") < 100})
    assert table == {1: 50.0, 2: 7.0} and kept == {}


def test_rows_without_a_key(spark, run):
    target = spark.createDataFrame([], TARGET)
    source = [(None, "1", ""), (None, "1", ""), (None, None, None), ("abc", "1", ""), ("5", "5", "")]
    first, table, kept = run(source, target, FIRST)
    assert table == {5: 5.0} and first.counts["errors"] == 4
    assert kept.pop("abc") == ("no key", 1, 1, 1) and list(kept.values()) == [("no key", 1, 1, 1)] * 2
    _, table, kept = run(source[3:], first.table, SECOND)
    assert table == {5: 5.0} and kept == {"abc": ("no key", 1, 2, 2)}


def test_a_run_over_tables(spark):
    base = new_folder(spark, "versions")
    target = spark.createDataFrame([(1, 1.0, day(1))], TARGET).withColumn("synced_at", F.lit(None).cast("timestamp"))
    swap_table(target, SPEC.target, f"{base}/{SPEC.target}")
    bad = spark.createDataFrame([("1", "x", day(2)), ("2", "2", day(3))], SOURCE)
    good = spark.createDataFrame([("1", "1.5", day(2)), ("2", "2", day(3))], SOURCE)
    held = []
    for source in (bad, bad, good, good):
        sync_run([SPEC], lambda spec, s=source: s, base, FIRST, rejects=f"{base}/rejects")
        held.append([(r.entry, r.attempts) for r in read_rejects(spark, f"{base}/rejects/{SPEC.target}").collect()])
    assert held == [[("1", 1)], [("1", 2)], [], []]
    assert {r.id: r.v for r in spark.table(SPEC.target).collect()} == {1: 1.5, 2: 2.0}
    spark.sql(f"drop table {SPEC.target}")
