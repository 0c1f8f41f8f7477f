"""Runs over several tables: cut off at every step, taken up, given up."""

from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from keystitch.plans import journal as J
from keystitch.plans.quarantine import read_rejects
from keystitch.sources.specs import TableSpec, with_block
from keystitch.sources.tables import folders_in, new_folder, shared_dir, swap_table

COLUMNS = {"ID": "id", "V": "v", "TS": "stamp"}
SOURCE, TARGET = "ID string, V string, TS string", "id long, v double, stamp string, synced_at timestamp"
TYPES = {"id": "long", "v": "double"}
FIRST, SECOND = datetime(2025, 7, 1), datetime(2025, 7, 2)
OLD, NEW = "01/01/2025 00:00:00:000", "02/01/2025 00:00:00:000"


class Cut(Exception):
    pass


@pytest.fixture
def tables(spark):
    """Two swapped tables and one in blocks, all with the same row, and folders for a journal."""
    base = new_folder(spark, "versions")
    mark = base[-8:]
    specs = [TableSpec(f"t{i}", f"journal_{mark}_{i}", "id", "ID", "stamp", COLUMNS, TYPES, 10 if i == 2 else None) for i in range(3)]
    rows = spark.createDataFrame([(1, 1.0, OLD, None), (25, 25.0, OLD, None)], TARGET)
    for spec in specs[:2]:
        swap_table(rows, spec.target, f"{base}/{spec.target}")
    with_block(rows, specs[2]).write.partitionBy("key_block").saveAsTable(specs[2].target)
    yield specs, base
    for spec in specs:
        spark.sql(f"drop table {spec.target}")


def values(spark, specs):
    return [{r.id: r.v for r in spark.table(s.target).collect()} for s in specs]


def reader(spark, fails=None, rows=(("1", "1.5", NEW), ("2", "2", ""), ("3", "x", ""))):
    read = []

    def source(spec):
        read.append(spec.name)
        if spec.name == fails:
            raise Cut
        return spark.createDataFrame(list(rows), SOURCE)

    return source, read


BEFORE, AFTER = {1: 1.0, 25: 25.0}, {1: 1.5, 2: 2.0, 25: 25.0}


def staged(spark):
    return set(folders_in(spark, shared_dir(spark)))


def test_all_tables_change_in_one_run(spark, tables):
    specs, base = tables
    before = staged(spark)
    source, _ = reader(spark)
    run = J.sync_together(spark, specs, source, base, FIRST, f"{base}/journal", f"{base}/rejects")
    assert values(spark, specs) == [AFTER] * 3
    assert {tuple(r)[1:] for r in run.report.where("name is not null").collect()} == {(2, 1, 1, 1)}
    assert [[r.entry for r in read_rejects(spark, f"{base}/rejects/{s.target}").collect()] for s in specs] == [["3"]] * 3
    # nothing that the run staged is left, and its blocks are in the table alone
    assert staged(spark) == before and not folders_in(spark, f"{base}/{specs[2].target}")
    again = J.sync_together(spark, specs, source, base, SECOND, f"{base}/journal", f"{base}/rejects")
    assert {tuple(r)[1:4] for r in again.report.where("name is not null").collect()} == {(1, 0, 0)}
    assert [[r.attempts for r in read_rejects(spark, f"{base}/rejects/{s.target}").collect()] for s in specs] == [[2]] * 3
    assert sorted(folders_in(spark, f"{base}/journal")) == ["run-00000001", "run-00000002"]


def test_a_run_goes_on_at_the_table_that_failed(spark, tables):
    specs, base = tables
    before, journal = staged(spark), f"{base}/journal"
    source, _ = reader(spark, fails="t2")
    with pytest.raises(Cut):
        J.sync_together(spark, specs, source, base, FIRST, journal)
    assert values(spark, specs) == [BEFORE] * 3 and staged(spark) == before
    source, read = reader(spark)
    run = J.sync_together(spark, specs, source, base, SECOND, journal)
    assert read == ["t2"] and values(spark, specs) == [AFTER] * 3 and staged(spark) == before
    assert run.report.where("name is null").first().inserted == 3
    # all tables carry the time of the run that was cut off
    stamps = [{r.synced_at for r in spark.table(s.target).where("synced_at is not null").collect()} for s in specs]
    assert stamps == [{FIRST}] * 3


@pytest.mark.parametrize("published", [0, 1, 2, 3])
def test_a_decided_run_is_finished(spark, tables, monkeypatch, published):
    specs, base = tables
    journal, publish, done = f"{base}/journal", J._publish, []

    def until(run, version):
        if len(done) == published:
            raise Cut
        publish(run, version)
        done.append(version.name)

    monkeypatch.setattr(J, "_publish", until)
    source, _ = reader(spark)
    if published < 3:
        with pytest.raises(Cut):
            J.sync_together(spark, specs, source, base, FIRST, journal, f"{base}/rejects")
    else:
        J.sync_together(spark, specs, source, base, FIRST, journal, f"{base}/rejects")
    monkeypatch.setattr(J, "_publish", publish)
    source, read = reader(spark, rows=[("1", "9", NEW)])
    if published < 3:
        J.sync_together(spark, specs, source, base, SECOND, journal, f"{base}/rejects")
        assert read == []
    assert values(spark, specs) == [AFTER] * 3
    assert [read_rejects(spark, f"{base}/rejects/{s.target}").count() for s in specs] == [1] * 3


def test_a_run_is_given_up(spark, tables):
    specs, base = tables
    journal = f"{base}/journal"
    source, _ = reader(spark, fails="t1")
    with pytest.raises(Cut):
        J.sync_together(spark, specs, source, base, FIRST, journal)
    assert "run-00000001" in folders_in(spark, f"{base}/{specs[0].target}")
    J.abandon(spark, journal)
    assert "run-00000001" not in folders_in(spark, f"{base}/{specs[0].target}")
    assert values(spark, specs) == [BEFORE] * 3
    source, read = reader(spark)
    J.sync_together(spark, specs, source, base, SECOND, journal)
    assert read == ["t0", "t1", "t2"] and values(spark, specs) == [AFTER] * 3


def test_a_table_that_moved_is_prepared_again(spark, tables):
    specs, base = tables
    journal = f"{base}/journal"
    source, _ = reader(spark, fails="t1")
    with pytest.raises(Cut):
        J.sync_together(spark, specs, source, base, FIRST, journal)
    moved = spark.createDataFrame([(7, 7.0, OLD, None)], TARGET)
    swap_table(moved, specs[0].target, f"{base}/{specs[0].target}")
    source, read = reader(spark)
    J.sync_together(spark, specs, source, base, SECOND, journal)
    assert read == ["t0", "t1", "t2"]
    assert values(spark, specs)[0] == {1: 1.5, 2: 2.0, 7: 7.0}


def test_blocks_only_where_the_table_has_them(spark, tables):
    specs, base = tables
    plain = replace(specs[0], block_size=10)
    source, _ = reader(spark)
    J.sync_together(spark, [plain], source, base, FIRST, f"{base}/journal")
    assert values(spark, specs[:1]) == [AFTER]
    assert "key_block" not in spark.table(plain.target).columns
    assert spark.table(plain.target).where(F.col("id") == 2).count() == 1
