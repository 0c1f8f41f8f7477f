"""What the plans must look like at any size."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from keystitch.functions.stamps import STAMP_FORMAT
from keystitch.operators import changes as C
from keystitch.operators import keys as K
from keystitch.operators import links as L
from keystitch.operators import merge as M
from keystitch.operators import readings as G
from keystitch.plans import snapshot as S
from keystitch.plans.ingest import READINGS_SCHEMA, append_readings, read_readings
from keystitch.session import session_conf
from keystitch.sources.responses import scan_responses
from keystitch.sources.tables import scan_keys, stage
from tests.conftest import SF
from workload.readings import land_responses
from workload.standins import standin

# the document operators run Python in their tasks and have tests of their own
QUERIES = {k: q for k, q in __spark_entry__.queries().items() if not re.match(r"op\d+_|pipeline$", k)}
# these run jobs before they return a DataFrame; their operators are covered by the others
JOBS = {n for n in QUERIES if n.endswith(("_job", "_job_totals"))} | {"stream_ingest_readings", "readings_scan"}
JOBS |= {n for n in QUERIES if n.endswith("_bucketed")}
JOBS |= {n for n in QUERIES if n.startswith(("csv_", "snapshot_manifest", "snapshot_restore", "restore_verify", "report_json", "sync_rejects", "sync_retried"))}


def plan(df, executed=False):
    if executed:
        df.write.format("noop").mode("overwrite").save()
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    old = {}

    def change(**values):
        for name, value in values.items():
            name = name.replace("__", ".")
            old.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in old.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - JOBS))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not re.search(r"Python|Pandas|CartesianProduct|BroadcastNestedLoopJoin", text)


def test_key_scan_reads_the_key_only(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan(scan_keys(orders, "o_orderkey", "id"))


def test_change_keys_reads_key_and_stamp_only(spark):
    stamp = F.date_format("o_orderdate", STAMP_FORMAT)
    source = stage(spark.read.parquet(f"{SF}/orders.parquet").withColumn("stamp", stamp), "wide")
    mark = F.lit("2000-01-01").cast("timestamp")
    text = plan(C.change_keys(source, source, "o_orderkey", "stamp", mark))
    assert sorted(re.findall(r"ReadSchema: struct<([^>]*)>", text)) == [
        "o_orderkey:bigint",
        "o_orderkey:bigint,stamp:string",
    ]


def test_date_floor_reaches_the_scan(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    assert "GreaterThanOrEqual(o_orderdate,2000-01-01T00:00)" in plan(S.rows_since(orders, "o_orderdate", "2000-01-01"))


def test_days_prune_folders(spark, tmp_path):
    landed = scan_responses(spark, land_responses(spark, SF)).filter(F.col("dia").between("2024-01-05", "2024-01-06"))
    assert re.search(r"PartitionFilters: \[[^\]]*day#\d+ >= 2024-01-05", plan(landed))
    append_readings(spark.createDataFrame([tuple(None for _ in range(9)) + (date(2024, 1, 5),)], READINGS_SCHEMA), str(tmp_path / "t"))
    table = read_readings(spark, str(tmp_path / "t"))
    low = spark.range(1).select(F.lit("2024-01-05").cast("date"))
    assert re.search(r"PartitionFilters: \[[^\]]*date#\d+ >= Subquery", plan(table.filter(F.col("date") >= low.scalar())))


def test_one_row_per_key_leaves_each_map_task(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    text = plan(K.last_per_key(lines, ["l_orderkey"], ["l_shipdate"]))
    assert text.count("Exchange") == 1
    after_shuffle = text.split("Exchange")[1]
    assert re.search(r"WindowGroupLimit .* row_number\(\), 1, Partial", after_shuffle)


def test_few_wanted_keys_cut_the_source_before_it_is_shuffled(spark):
    source = stage(spark.range(1000).select((F.col("id") % 10).alias("k"), F.col("id").alias("v")), "source")
    keys = C.change_keys(source, source.limit(0), "k")
    safe = plan(C.change_rows(source, keys, "k", order=["v"]))
    assert re.search(r"WindowGroupLimit .* row_number\(\), 1, Partial", safe)
    few = stage(spark.range(5).select(F.col("id").alias("k"), F.lit("inserted").alias("outcome")), "few")
    cut = plan(C.change_rows(source, few, "k", order=["v"]))
    # the one shuffle moves what the broadcast and a group limit in each task have left
    assert "BroadcastHashJoin" in cut and cut.count("Exchange hashpartitioning") == 1
    below = cut.split("Exchange hashpartitioning")[1]
    assert "Partial" in below and below.index("Partial") < below.index("BroadcastHashJoin")


def test_source_keys_are_counted_before_the_shuffle(spark):
    """Missing rows are counted with their repeats, without moving the repeats."""
    source = stage(spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k")), "source")
    target = stage(spark.range(5000, 9000).select(F.col("id").alias("k")), "target")
    keys = C.change_keys(source, target, "k")
    assert re.search(r"Exchange hashpartitioning\(k#[^+]*\n[^+]*\+- HashAggregate\(keys=\[k#\d+L\], functions=\[partial_", plan(keys))
    assert keys.filter("k = 0").first().copies == 3000
    assert C.change_counts(keys, "t").first().missing == 3000 + sum(1 for i in range(5000) if i % 3)


def test_day_counts_aggregates_before_every_shuffle(spark):
    mapped = G.map_readings(standin(spark, SF, "readings_raw"), keep=["dia"])
    known = spark.createDataFrame([], "date date, hour string, tank_number int")
    text = plan(G.day_counts(mapped, known))
    assert text.count("partial_count") + text.count("partial_sum") >= 3


def test_small_changes_do_not_shuffle_the_table(spark):
    table = stage(spark.range(100_000).select(F.col("id"), F.col("id").alias("v")), "table")
    few = stage(spark.range(10).select(F.col("id"), F.lit(0).cast("long").alias("v")), "few")
    text = plan(M.overwrite_rows(table, few, "id", ["v"]))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text
    fetched = plan(K.fetch_rows(table, few, "id"))
    assert "BroadcastHashJoin" in fetched and "hashpartitioning" not in fetched


def test_big_changes_are_not_broadcast(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="1024")
    table = stage(spark.range(100_000).select(F.col("id"), F.col("id").alias("v")), "table")
    text = plan(M.overwrite_rows(table, table, "id", ["v"]))
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_link_distinct_uses_the_partitioning_of_the_anti_join(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    names = ("docs_text", "maint", "acc", "doc_links")
    tables = [stage(standin(spark, SF, n), n) for n in names]
    text = plan(L.link_documents(*tables))
    # documents and lookup for the first join, its result and the links for the second, nothing more
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 4


@pytest.mark.parametrize("kind", ["patch", "link"])
def test_hot_keys_are_split(spark, conf, kind):
    """A third of the rows share one key: the join splits that partition and loses nothing."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__shuffle__partitions="16",
    )
    n = 60_000
    ids = spark.range(n, numPartitions=8)
    hot = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id"))
    if kind == "patch":
        table = stage(ids.select(hot.alias("k"), F.md5(F.col("id").cast("string")).alias("v")), "hot")
        changes = stage(ids.select(F.col("id").alias("k"), F.lit("new").alias("v")), "changes")
        df = M.overwrite_rows(table, changes, "k", ["v"])
        assert df.filter("v = 'new'").count() == n
    else:
        folio = F.concat(F.lit("M-250101-"), hot.cast("string"))
        docs = stage(ids.select(F.col("id").alias("document_id"), folio.alias("extra_text_three"), F.lit(1).alias("active")), "docs")
        maint = stage(ids.select("id", F.concat(F.lit("M-250101-"), F.col("id").cast("string")).alias("pid"), F.lit(1).alias("active")), "maint")
        links = spark.createDataFrame([], "document_id long, maintenance_id long, accident_id long, active int")
        df = L.link_documents(docs, maint, maint.limit(0), links)
        assert df.count() == n
    assert "SortMergeJoin(skew=true)" in plan(df, executed=True)


def test_session_conf():
    small, large = session_conf(1, 8), session_conf(10 * 1024**4, 4000)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert large["spark.sql.shuffle.partitions"] == "81920"
