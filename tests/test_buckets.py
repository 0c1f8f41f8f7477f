"""Bucketed targets: they are not moved, and hold the same rows as others."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from keystitch.operators import keys as K
from keystitch.operators import merge as M
from keystitch.sources import buckets as B
from keystitch.sources.tables import new_folder, stage

TARGET = "id long, v string, kept string, synced_at timestamp"


@pytest.fixture
def target(spark):
    def make(rows, buckets=4):
        name = f"t_{uuid.uuid4().hex}"
        df = rows if hasattr(rows, "columns") else spark.createDataFrame(rows, TARGET)
        B.write_buckets(df, name, new_folder(spark, "buckets"), "id", buckets)
        return name

    return make


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def sides(text):
    """The plan below each side of its only merge join."""
    lines = text[text.index("SortMergeJoin") :].splitlines()
    depth = [len(re.match(r"[ :|+-]*", x).group()) for x in lines]
    first, second = [i for i in range(1, len(lines)) if depth[i] == min(depth[1:])][:2]
    return "\n".join(lines[first:second]), "\n".join(lines[second:])


def test_only_the_source_moves(spark, target):
    table = target([(i, "a", "k", None) for i in range(100)])
    rows = stage(spark.range(50, 200).select("id", F.lit("b").alias("v")), "rows")
    missing = B.missing_keys_in(table, rows)
    source, held = sides(plan(missing))
    assert "Exchange" in source and "Exchange" not in held and "Bucketed: true" in held
    assert "ReadSchema: struct<id:bigint>" in held
    for new in (B.upsert_in(table, rows, ["v"], "2024-01-01"), B.patch_in(table, rows, ["v"])):
        held, moved = sides(plan(new))
        assert "Exchange" not in held and "Bucketed: true" in held and moved.count("Exchange") == 1


def test_same_rows_as_without_buckets(spark, target, rows):
    old = [(1, "a", "x", None), (2, None, "y", None), (2, "twice", "z", None), (None, "n", "no key", None), (7, "g", None, None)]
    new = spark.createDataFrame(
        [(1, None, 1), (1, "late", 2), (3, "c", 1), (None, "m", 1), (2, "", 5)], "id long, v string, n int"
    )
    table = target(old)
    plain = spark.createDataFrame(old, TARGET)
    assert rows(B.missing_keys_in(table, new)) == rows(K.missing_keys(new, plain, "id"))
    want = M.upsert(plain, new, "id", ["v"], "2024-01-01 00:00:00", ["n"])
    assert rows(B.upsert_in(table, new, ["v"], "2024-01-01 00:00:00", ["n"])) == rows(want)
    assert rows(B.patch_in(table, new, ["v"], ["n"])) == rows(M.patch(plain, new, "id", ["v"], ["n"]))


def test_replaced_table_keeps_its_buckets(spark, target, rows):
    table = target([(i, "a", str(i), None) for i in range(40)])
    changes = spark.createDataFrame([(i, "b") for i in range(30, 60)], "id long, v string")
    base = new_folder(spark, "versions")
    for _ in range(2):
        want = rows(M.upsert(spark.table(table), changes, "id", ["v"], "2024-01-01"))
        done = B.replace_buckets(B.upsert_in(table, changes, ["v"], "2024-01-01"), table, base)
        assert rows(done) == want and done.count() == 60
        assert B.bucketing(spark, table) == ("id", 4)
        files = done.select(F.input_file_name().alias("f")).distinct().count()
        assert files == 4
    assert "Exchange" not in sides(plan(B.missing_keys_in(table, changes)))[1]
    # a scan by bucket finds a key where the table says it is
    assert spark.table(table).where("id = 35").count() == 1


def test_hot_key_and_empty_sides(spark, target, rows):
    ids = spark.range(3000)
    hot = ids.select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("id"), F.lit("a").alias("v"))
    table = target(hot.select("id", "v", F.lit("k").alias("kept"), F.lit(None).cast("timestamp").alias("synced_at")))
    none = hot.limit(0)
    assert B.missing_keys_in(table, none).count() == 0
    assert B.upsert_in(table, none, ["v"]).count() == 3000
    assert B.upsert_in(table, hot.withColumn("v", F.lit("z")), ["v"]).where("v = 'z'").count() == 3000
    empty = target([])
    assert B.missing_keys_in(empty, hot).count() == 3000
    assert B.upsert_in(empty, hot, ["v"]).count() == 2001


def test_other_tables_are_refused(spark, target):
    name = f"plain_{uuid.uuid4().hex}"
    spark.range(3).write.option("path", new_folder(spark, "plain")).saveAsTable(name)
    with pytest.raises(ValueError):
        B.bucketing(spark, name)
    with pytest.raises(ValueError):
        rows = spark.range(3).withColumn("v", F.lit("a"))
        B.upsert_in(target(rows), rows, ["v"], "2024-01-01")
