"""Exports, snapshots, restores and the swap of a table."""

from datetime import date, datetime
from types import SimpleNamespace

import pytest

from keystitch.operators.reports import verify_counts
from keystitch.plans import snapshot as S
from keystitch.sources.csvfiles import read_csv_gz, write_csv_gz
from keystitch.sources.jdbc import jdbc_options, modified_table
from keystitch.sources.specs import DOCUMENTS
from keystitch.sources.tables import shared_dir, swap_table

TEXTS = [None, "", " ", "  a  ", 'say "x"', "a,b", "line\nbreak", "\r\n", "\\", "\\N", "ñ", '"', '""', "\t"]


def test_csv_keeps_texts_apart(spark, tmp_path):
    rows = [(i, t, datetime(2024, 1, 1, 0, 0, 0, i + 1), 0.1 * i) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "id long, t string, at timestamp, v double")
    df = df.withColumn("ntz", df["at"].cast("timestamp_ntz"))
    write_csv_gz(df, str(tmp_path / "csv"), rows_per_file=5)
    back = read_csv_gz(spark, str(tmp_path / "csv"), df.schema)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    assert len(list((tmp_path / "csv").glob("*.csv.gz"))) >= 3


def test_snapshot_and_restore(spark, tmp_path):
    folder, dev = str(tmp_path / "snapshot"), str(tmp_path / "dev")
    users = spark.createDataFrame([(1,), (2,)], "id long")
    moves = spark.createDataFrame(
        [(1, date(2025, 12, 31)), (2, date(2026, 1, 1)), (3, None)], "id long, transaction_date date"
    )
    S.write_snapshot({"users": users, "moves": moves}, folder, ["moves"])
    S.export_since(moves, "transaction_date", "2026-01-01", f"{folder}/moves_csv")
    held = S.read_snapshot(spark, folder, ["users", "moves"])
    manifest = {r.table: (r.columns, r.rows, r.structure_only) for r in S.snapshot_manifest(held, ["moves"]).collect()}
    assert manifest == {"users": (1, 2, False), "moves": (2, 0, True)}

    for _ in range(2):  # restoring again replaces what is there
        restored = S.restore_snapshot(
            spark, folder, ["users", "moves"], dev, {"moves": f"{folder}/moves_csv"}
        )
    assert [tuple(r) for r in restored["moves"].collect()] == [(2, date(2026, 1, 1))]
    counts = {r.check: r.total for r in verify_counts(restored, len(restored)).collect()}
    assert counts == {"tables": "2", "users": "2", "moves": "1"}


def test_swap_reads_the_table_it_replaces(spark, tmp_path):
    base = str(tmp_path / "swap")
    swap_table(spark.range(3).toDF("id"), "swapped", base)
    for size in (4, 5):
        old = spark.table("swapped")
        swap_table(old.unionByName(spark.range(size - 1, size).toDF("id")), "swapped", base)
        assert spark.table("swapped").count() == size
    spark.sql("drop table swapped")


def test_jdbc_settings():
    options = jdbc_options("jdbc:x:y", "t", "id", (0, 999), num_partitions=10)
    assert options["numPartitions"] == "10" and options["upperBound"] == "999"
    assert "partitionColumn" not in jdbc_options("jdbc:x:y", "t")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x:y", "t", "id")
    query = modified_table(DOCUMENTS, "01/02/2025 00:00:00:000")
    assert "CONVERT(DATETIME, CTIMESTAMP, 101) > CONVERT(DATETIME, '01/02/2025 00:00:00:000', 101)" in query
    assert query.startswith("(SELECT CIDDOCUMENTO, ") and query.endswith(") AS modified")


def test_shared_folder_is_one_that_all_executors_reach():
    def session(master, **conf):
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert shared_dir(session("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})) == "hdfs:///shared"
    for master in ("yarn", "local[2]"):
        warehouse = {"spark.sql.warehouse.dir": "hdfs:///warehouse/"}
        assert shared_dir(session(master, **warehouse)) == "hdfs:///warehouse/keystitch-staged"


def test_csv_keeps_a_text_of_one_null_character(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, "\x00"), (2, None), (3, ""), (4, "a\x00b")], "k int, t string")
    write_csv_gz(df, str(tmp_path / "csv"))
    assert rows(read_csv_gz(spark, str(tmp_path / "csv"), df.schema)) == rows(df)


def test_restore_removes_what_the_snapshot_lacks_and_keeps_a_table_whose_load_fails(spark, tmp_path):
    snapshot, target = str(tmp_path / "snapshot"), str(tmp_path / "target")
    spark.range(3).write.parquet(f"{snapshot}/a")
    for name in ("a", "stale"):
        spark.range(9).write.parquet(f"{target}/{name}")
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        S.restore_table(spark, f"{snapshot}/absent", f"{target}/a")
    assert spark.read.parquet(f"{target}/a").count() == 9
    restored = S.restore_snapshot(spark, snapshot, ["a"], target)
    assert restored["a"].count() == 3
    assert [p.name for p in (tmp_path / "target").iterdir()] == ["a"]
    with pytest.raises(ValueError, match="below the target"):
        S.restore_snapshot(spark, snapshot, ["a"], str(tmp_path))


def test_a_changed_row_is_found(spark, tmp_path):
    folder, target = str(tmp_path / "s"), str(tmp_path / "t")
    rows = [(1, "a", None), (2, None, "a"), (2, None, "a"), (3, "", "x")]
    table = spark.createDataFrame(rows, "id long, u string, v string")
    S.write_snapshot({"a": table, "b": table, "c": table}, folder, ["b"])
    held = S.restore_snapshot(spark, folder, ["a", "b", "c"], target)
    check = lambda tables: {r.table: tuple(r)[1:] for r in S.verify_restore(spark, folder, tables, ids={"a": "id", "b": "id"}).collect()}
    assert check(held) == {"a": (4, 4, True, 3), "b": (0, 0, True, 1), "c": (4, 4, True, None)}
    assert check(held | {"a": held["a"].orderBy("u").repartition(3)})["a"] == (4, 4, True, 3)
    changed = {
        "null or empty": [(1, "a", None), (2, "", "a"), (2, None, "a"), (3, "", "x")],
        "moved a column": [(1, None, "a"), (2, None, "a"), (2, None, "a"), (3, "", "x")],
        "another repeat": [(1, "a", None), (1, "a", None), (2, None, "a"), (3, "", "x")],
    }
    for other in changed.values():
        assert check(held | {"a": spark.createDataFrame(other, table.schema)})["a"][:3] == (4, 4, False)
    assert check(held | {"a": table.limit(3)})["a"][:3] == (4, 3, False)
    lost = check({"a": held["a"], "z": held["a"]})
    assert lost["c"] == (4, None, False, None) and lost["z"][:3] == (None, 4, False)


def test_an_export_is_verified_by_its_own_manifest(spark, tmp_path):
    folder, target = str(tmp_path / "s"), str(tmp_path / "t")
    table = spark.createDataFrame([(1, date(2025, 1, 1), 'x "y"'), (2, date(2026, 1, 1), ""), (3, date(2026, 2, 1), None)], "id long, d date, v string")
    S.write_snapshot({"m": table}, folder, ["m"])
    S.export_since(table, "d", "2026-01-01", f"{folder}/m_csv")
    exports = {"m": f"{folder}/m_csv"}
    held = S.restore_snapshot(spark, folder, ["m"], target, exports)
    assert [tuple(r) for r in S.verify_restore(spark, folder, held, exports, {"m": "id"}).collect()] == [("m", 2, 2, True, 3)]
