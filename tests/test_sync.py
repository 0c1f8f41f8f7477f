"""Change detection, upserts and the synchronisation job."""

import json
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keystitch.operators import changes as C
from keystitch.operators import keys as K
from keystitch.operators import merge as M
from keystitch.operators.extras import changed_texts, rows_with_text
from keystitch.operators.reports import max_id_or_one, summary_line, sync_report, sync_summary
from keystitch.plans.extras import patch_extras, patch_table
from keystitch.plans.sync import sync_table, sync_tables
from keystitch.sources.specs import SPECS, TableSpec, map_columns, select_specs, with_block
from keystitch.sources.tables import replace_folder, stage_counted, swap_table

SPEC = TableSpec("docs", "docs_copy", "id", "ID", "stamp", {"ID": "id", "V": "v", "TS": "stamp"})
UNSTAMPED = TableSpec("movs", "movs_copy", "id", "ID", None, SPEC.columns)
SOURCE, TARGET = "ID long, V string, TS string", "id long, v string, stamp string, note string"
AT = "2025-07-01 00:00:00"


def day(month, year, ms=0):
    return f"{month:02d}/01/{year} 00:00:00:{ms:03d}"


def test_specs():
    assert [len(s.columns) for s in SPECS] == [26, 36, 59, 23, 30]
    assert [s.modified_col for s in SPECS] == [None, "sql_timestamp", "sql_timestamp", None, None]
    assert all(s.columns[s.source_key] == s.key and s.key not in s.value_columns for s in SPECS)
    stock = SPECS[2].columns
    assert stock["CCOSTOSALIDASPERIODO12"] == "exits_cost_period_12" and list(stock)[9] == "CENTRADASPERIODO1"
    assert SPECS[4].columns["CPRECIO10"] == "price_ten"


def test_select_specs():
    assert select_specs(SPECS) == SPECS
    chosen = select_specs(SPECS, ["comercial_adm_products", "admDocumentos", "unknown"])
    assert [s.name for s in chosen] == ["admDocumentos", "admProductos"]
    with pytest.raises(ValueError, match="admMovimientos"):
        select_specs(SPECS, ["unknown"])


def test_map_columns_keeps_null_empty_and_zero_apart(spark, rows):
    spec = TableSpec("a", "b", "id", "ID", None, {"ID": "id", "T": "t", "N": "n", "GONE": "gone"}, {"n": "int", "gone": "double"})
    source = spark.createDataFrame([(1, "", "0"), (2, None, "x")], "ID long, T string, N string")
    mapped = map_columns(source, spec)
    assert rows(mapped) == [(1, "", 0, None), (2, None, None, None)]
    assert mapped.schema["gone"].dataType.simpleString() == "double"


def test_missing_keys_keep_repeats(spark, rows):
    source = spark.createDataFrame([(1,), (2,), (2,), (3,)], "id long")
    target = spark.createDataFrame([(3,), (9,)], "id long")
    missing = K.missing_keys(source, target, "id")
    assert rows(missing) == [(1,), (2,), (2,)]
    assert K.fetch_rows(source, missing, "id").count() == 3


def test_watermarks(spark):
    table = spark.createDataFrame(
        [(day(12, 2024),), (day(6, 2025),), ("12/30/1899 00:00:00:000",), ("",), (None,)], "stamp string"
    )
    assert C.watermark_text(table, "stamp").first()[0] == day(12, 2024)
    assert C.watermark_time(table, "stamp").first()[0] == datetime(2025, 6, 1)
    empty = table.limit(0)
    assert C.watermark_text(empty, "stamp").first()[0] == ""
    assert C.watermark_time(empty, "stamp").first()[0] is None
    for mark in (C.text_as_time(C.watermark_text(empty, "stamp")), C.watermark_time(empty, "stamp")):
        assert C.modified_rows(table, "stamp", mark.scalar()).count() == 0


def sync(spark, source, target, spec=SPEC, **options):
    return sync_table(
        spark.createDataFrame(source, SOURCE), spark.createDataFrame(target, TARGET), spec, AT, **options
    )


SOURCE_ROWS = [
    (1, "same", day(1, 2025)),  # tie with the watermark: not read again
    (2, None, day(2, 2025)),  # modified, NULL overwrites
    (3, "new", ""),  # missing
    (4, "edited", ""),  # known and not stamped: not updated
    (5, "bad", "13/45/2025 00:00:00:000"),  # known, bad stamp
    (None, "no key", day(3, 2025)),
]
TARGET_ROWS = [
    (1, "same", day(1, 2025), "a"),
    (2, "old", day(1, 2025), "b"),
    (4, "old", "", "c"),
    (5, "old", None, "d"),
    (9, "only here", "", "e"),
]


def test_sync_table(spark, rows):
    run = sync(spark, SOURCE_ROWS, TARGET_ROWS)
    at = datetime(2025, 7, 1)
    assert rows(run.table) == [
        (1, "same", day(1, 2025), "a", None),
        (2, None, day(2, 2025), "b", at),
        (3, "new", "", None, at),
        (4, "old", "", "c", None),
        (5, "old", None, "d", None),
        (9, "only here", "", "e", None),
    ]
    assert tuple(run.report.first()) == ("docs", 2, 1, 1, 1)
    assert run.rejects.count() == 0


def test_sync_again_changes_nothing(spark, rows):
    first = sync(spark, SOURCE_ROWS[:-1], TARGET_ROWS)
    again = sync_table(spark.createDataFrame(SOURCE_ROWS[:-1], SOURCE), first.table, SPEC, "2030-01-01 00:00:00")
    assert rows(again.table) == rows(first.table)
    assert tuple(again.report.first()) == ("docs", 0, 0, 0, 0)


def test_unstamped_table_only_inserts(spark):
    run = sync(spark, SOURCE_ROWS, TARGET_ROWS, UNSTAMPED)
    assert tuple(run.report.first()) == ("movs", 2, 1, 0, 1)


def test_empty_target_takes_all(spark):
    run = sync(spark, SOURCE_ROWS[:-1], [])
    assert tuple(run.report.first()) == ("docs", 5, 5, 0, 0)


def test_repeated_source_key(spark, rows):
    source = [(1, "first", ""), (1, "last", ""), (2, "stamped", day(2, 2025)), (2, "z plain", ""), (2, "y plain", "")]
    run = sync(spark, source, [(2, "old", day(1, 2025), None)], order=["V"])
    got = [(r.id, r.v) for r in run.table.orderBy("id").collect()]
    assert got == [(1, "last"), (2, "stamped")]
    assert tuple(run.report.first()) == ("docs", 2, 1, 1, 0)


def test_rejects(spark):
    run = sync(spark, SOURCE_ROWS, TARGET_ROWS, checks={"v too long": F.coalesce(F.length("v") < 3, F.lit(True))})
    assert [(r.id, r.reason) for r in run.rejects.collect()] == [(3, "v too long")]
    assert tuple(run.report.first()) == ("docs", 2, 0, 1, 2)
    assert run.table.filter("id = 3").count() == 0
    checked = K.split_rejects(
        spark.createDataFrame([(1, None), (2, "abcd"), (3, "a")], "id long, v string"),
        {"no v": F.col("v").isNotNull(), "long v": F.length("v") < 3},
    )
    assert [(r.id, r.reason) for r in K.reject_sample(checked, "id").collect()] == [(1, "no v"), (2, "long v")]


def test_values_that_do_not_fit_are_rejected(spark):
    spec = TableSpec("docs", "docs_copy", "id", "ID", "stamp", SPEC.columns, types={"id": "bigint", "v": "int"})
    source = spark.createDataFrame([("1", "5", ""), ("2", "x", ""), ("3", None, ""), ("?", "5", "")], "ID string, V string, TS string")
    target = spark.createDataFrame([], "id long, v int, stamp string")
    run = sync_table(source, target, spec, AT)
    assert sorted((r.id, r.v) for r in run.table.collect()) == [(1, 5), (3, None)]
    assert [(r.id, r.reason) for r in run.rejects.collect()] == [(2, "value does not fit its type")]
    assert tuple(run.report.first()) == ("docs", 4, 2, 0, 2)


def test_change_counts_match_the_job(spark):
    source = map_columns(spark.createDataFrame(SOURCE_ROWS, SOURCE), SPEC)
    target = spark.createDataFrame(TARGET_ROWS, TARGET)
    keys = C.change_keys(source, target, "id", "stamp", C.watermark_time(target, "stamp").scalar())
    assert tuple(C.change_counts(keys, "docs").first()) == ("docs", 2, 1, 1, 1)


VALUES = st.one_of(st.none(), st.sampled_from(["", "a", "b"]))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(st.integers(0, 30), VALUES, max_size=20),
    st.dictionaries(st.integers(0, 30), VALUES, max_size=20),
)
def test_upsert_like_a_dictionary(spark, old, new):
    target = spark.createDataFrame([(k, v, "n") for k, v in old.items()], "id long, v string, note string")
    changes = spark.createDataFrame(list(new.items()), "id long, v string")
    merged = M.upsert(target, changes, "id", ["v"])
    assert {r.id: r.v for r in merged.collect()} == old | new
    assert {r.id: r.note for r in merged.collect()} == {k: "n" if k in old else None for k in old | new}
    outcome = {r.id: r.outcome for r in M.upsert_outcome(target, changes, "id").collect()}
    assert outcome == {k: "updated" if k in old else "inserted" for k in new}
    again = M.upsert(merged, changes, "id", ["v"])
    assert sorted(map(repr, again.collect())) == sorted(map(repr, merged.collect()))


def test_sync_tables_and_report(spark, tmp_path):
    spark.createDataFrame(TARGET_ROWS, TARGET).write.mode("overwrite").saveAsTable("docs_copy")
    spark.createDataFrame([], TARGET).write.mode("overwrite").saveAsTable("movs_copy")
    source = spark.createDataFrame(SOURCE_ROWS[:-1], SOURCE)
    report = sync_tables([SPEC, UNSTAMPED], lambda spec: source, str(tmp_path), AT)
    counts = {r.name: tuple(r)[1:] for r in report.collect()}
    assert counts == {"docs": (1, 1, 1, 0), "movs": (5, 5, 0, 0), None: (6, 6, 1, 0)}
    assert spark.table("docs_copy").count() == 6 and spark.table("movs_copy").count() == 5
    again = sync_tables([SPEC, UNSTAMPED], lambda spec: source, str(tmp_path), AT)
    assert {tuple(r)[1:] for r in again.collect()} == {(0, 0, 0, 0)}
    body = sync_summary(report, elapsed=1.5).first().summary
    assert json.loads(body) == {
        "script": "sync",
        "elapsed_seconds": 1.5,
        "tables": [
            {"name": "docs", "missing": 1, "inserted": 1, "updated": 1, "errors": 0},
            {"name": "movs", "missing": 5, "inserted": 5, "updated": 0, "errors": 0},
        ],
        "totals": {"missing": 6, "inserted": 6, "updated": 1, "errors": 0},
    }
    assert summary_line(body).startswith("::SUMMARY_JSON::{")
    spark.sql("drop table docs_copy")
    spark.sql("drop table movs_copy")


def test_blocks_rewrite_only_what_changes(spark, rows):
    spec = TableSpec("docs", "docs_blocks", "id", "ID", "stamp", SPEC.columns, block_size=10)
    target = [(i, "old", day(1, 2025), "n") for i in range(60)]
    frame = spark.createDataFrame(target, TARGET).withColumn("synced_at", F.lit(None).cast("timestamp"))
    with_block(frame, spec).write.partitionBy("key_block").mode("overwrite").saveAsTable("docs_blocks")
    files = lambda: {r.f for r in spark.table("docs_blocks").select(F.input_file_name().alias("f")).distinct().collect()}
    before = files()
    source = [(i, "same", day(1, 2025)) for i in range(60)] + [(61, "new", "")]
    source[25] = (25, "edited", day(2, 2025))
    frame = spark.createDataFrame(source, SOURCE)
    run = sync_table(frame, spark.table("docs_blocks"), spec, AT)
    assert {r.key_block for r in run.table.collect()} == {2, 6} and run.table.count() == 11
    assert "dynamicpruning" in run.table._jdf.queryExecution().executedPlan().toString()
    plain = sync_table(frame, spark.createDataFrame(target, TARGET), SPEC, AT)

    report = sync_tables([spec], lambda s: frame, "unused", AT)
    assert {tuple(r)[1:] for r in report.collect()} == {(1, 1, 1, 0)}
    spark.catalog.refreshTable("docs_blocks")
    assert rows(spark.table("docs_blocks").drop("key_block")) == rows(plain.table)
    kept = {f for f in before if "key_block=2/" not in f}
    assert kept <= files() and not (before - kept) & files()
    spark.sql("drop table docs_blocks")


def test_max_id_or_one(spark):
    ids = spark.createDataFrame([(7,), (3,)], "id long")
    assert max_id_or_one(ids).first()[0] == 7 and max_id_or_one(ids.limit(0)).first()[0] == 1


EXTRA_SOURCE = "CIDDOCUMENTO long, CTEXTOEXTRA1 string, CTEXTOEXTRA2 string, CTEXTOEXTRA3 string"
EXTRA_TARGET = "document_id long, extra_text_one string, extra_text_two string, extra_text_three string, synced_at string"


def test_text_patch(spark, rows):
    source = spark.createDataFrame(
        [
            (1, "a", None, None),
            (2, "a", "", None),
            (3, "", "  ", None),
            (4, " x ", None, None),
            (5, "a", None, None),
        ],
        EXTRA_SOURCE,
    )
    target = spark.createDataFrame(
        [(1, " a ", None, "", "t"), (2, "a", "b", None, "t"), (3, "a", "b", "c", "t"), (4, "y", None, None, "t")],
        EXTRA_TARGET,
    )
    found = changed_texts(rows_with_text(source, "CIDDOCUMENTO", "document_id"), target, "document_id")
    assert rows(found) == [(2, "a", None, None), (4, " x ", None, None)]
    run = patch_extras(source, target)
    assert rows(run.table) == [
        (1, " a ", None, "", "t"),
        (2, "a", None, None, "t"),
        (3, "a", "b", "c", "t"),
        (4, " x ", None, None, "t"),
    ]
    assert json.loads(run.summary.first().summary)["candidates"] == 2
    assert run.counts == {"candidates": 2, "updated": 2, "errors": 0}
    again = json.loads(patch_extras(source, run.table).summary.first().summary)
    assert again.pop("elapsed_seconds") > 0
    assert again == {"script": "patch", "candidates": 0, "updated": 0, "errors": 0}
    # a key that two target rows have is two updates
    assert patch_extras(source, target.union(target.where("document_id = 2"))).counts["updated"] == 3


def test_patched_table_is_written_once(spark, rows, tmp_path):
    source = spark.createDataFrame([(1, "a", None, None)], EXTRA_SOURCE)
    spark.createDataFrame([(1, "b", None, None, "t"), (2, "c", None, None, "t")], EXTRA_TARGET).write.saveAsTable("patched")
    files = lambda: {r.f for r in spark.table("patched").select(F.input_file_name().alias("f")).distinct().collect()}
    assert patch_table(spark, source, "patched", str(tmp_path)).counts == {"candidates": 1, "updated": 1, "errors": 0}
    assert rows(spark.table("patched").select("document_id", "extra_text_one")) == [(1, "a"), (2, "c")]
    before = files()
    assert patch_table(spark, source, "patched", str(tmp_path)).counts == {"candidates": 0, "updated": 0, "errors": 0}
    assert files() == before
    spark.sql("drop table patched")


def test_counters_of_a_write(spark):
    df = spark.range(100)
    staged, counts = stage_counted(df.repartition(7), "counted", rows=F.count(F.lit(1)), odd=F.count_if(F.col("id") % 2 == 1))
    assert staged.count() == 100 and counts == {"rows": 100, "odd": 50}
    for empty in (df.limit(0), df.where("id < 0"), df.join(df.limit(0), "id")):
        assert stage_counted(empty, "counted", rows=F.count(F.lit(1)), total=F.sum("id"))[1] == {"rows": 0, "total": 0}


def test_report_of_one_table(spark):
    part = spark.createDataFrame([("t", 1, 1, 0, 0)], "name string, missing long, inserted long, updated long, errors long")
    assert {r.name for r in sync_report([part]).collect()} == {"t", None}


def test_a_key_that_changes_twice_does_not_multiply_rows(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    changes = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (3, "p", 2), (3, "q", 1)], "k int, v string, n int")
    assert rows(M.patch(target, changes, "k", ["v"], order=["n"])) == [(1, "y"), (2, "b")]
    assert rows(M.upsert(target, changes, "k", ["v"], order=["n"])) == [(1, "y"), (2, "b"), (3, "p")]


def test_a_partitioned_table_is_not_swapped(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k int, p string")
    df.write.partitionBy("p").saveAsTable("swap_partitioned")
    with pytest.raises(ValueError, match="partitioned"):
        swap_table(df, "swap_partitioned", str(tmp_path))
    assert spark.table("swap_partitioned").count() == 1


def test_replaced_folder_is_there_at_every_moment(spark, tmp_path):
    old, new = tmp_path / "t", tmp_path / "n"
    spark.range(3).write.parquet(str(old))
    spark.range(5).write.parquet(str(new))
    with pytest.raises(Exception):  # noqa: B017
        replace_folder(spark, str(tmp_path / "absent"), str(old))
    assert spark.read.parquet(str(old)).count() == 3
    replace_folder(spark, str(new), str(old))
    assert spark.read.parquet(str(old)).count() == 5
    assert [p.name for p in tmp_path.iterdir() if p.is_dir()] == ["t"]
