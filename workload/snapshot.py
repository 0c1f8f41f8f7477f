"""Queries on snapshots, exports and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from keystitch.operators.reports import max_id_or_one as next_base
from keystitch.operators.reports import verify_counts as counts_of
from keystitch.plans import snapshot as S
from keystitch.sources.csvfiles import read_csv_gz, write_csv_gz
from keystitch.sources.tables import new_folder
from workload.standins import DRIVER_TABLES, driver_table, standin

FLOOR = "2000-01-01"


def snapshot_filtered(spark, sf):
    return S.rows_since(driver_table(spark, sf, "orders"), "o_orderdate", FLOOR)


def snapshot_manifest(spark, sf):
    folder = new_folder(spark, "snapshot")
    S.write_snapshot({n: driver_table(spark, sf, n) for n in DRIVER_TABLES}, folder, ["orders"])
    return S.snapshot_manifest(S.read_snapshot(spark, folder, DRIVER_TABLES), ["orders"])


def snapshot_restore(spark, sf):
    """Structure of orders from the snapshot, its recent rows from the filtered export."""
    folder, restored = new_folder(spark, "snapshot"), new_folder(spark, "restored")
    orders = driver_table(spark, sf, "orders")
    S.write_snapshot({"orders": orders, "customer": driver_table(spark, sf, "customer")}, folder, ["orders"])
    S.export_since(orders, "o_orderdate", FLOOR, f"{folder}/orders_csv")
    exports = {"orders": f"{folder}/orders_csv"}
    tables = S.restore_snapshot(spark, folder, ["orders", "customer"], restored, exports)
    rows, clients = tables["orders"], tables["customer"]
    return rows.join(clients, rows.o_custkey == clients.c_custkey, "left").drop("c_custkey")


def restore_verify(spark, sf):
    """What was restored, held against the manifests of the snapshot and of the export."""
    folder, restored = new_folder(spark, "snapshot"), new_folder(spark, "restored")
    names = ("orders", "customer", "documents")
    tables = {n: driver_table(spark, sf, n) for n in names}
    S.write_snapshot(tables, folder, ["orders"])
    exports = {"orders": f"{folder}/orders_csv"}
    S.export_since(tables["orders"], "o_orderdate", FLOOR, exports["orders"])
    held = S.restore_snapshot(spark, folder, names, restored, exports)
    return S.verify_restore(spark, folder, held, exports, {"orders": "o_orderkey", "customer": "c_custkey"})


def csv_roundtrip(spark, sf):
    path = new_folder(spark, "csv")
    rows = standin(spark, sf, "docs_text")
    write_csv_gz(rows, path)
    return read_csv_gz(spark, path, rows.schema)


def csv_texts(spark, sf):
    """Whole prose texts, with their quotes and line breaks, through the export and back."""
    path = new_folder(spark, "csv")
    rows = driver_table(spark, sf, "documents")
    write_csv_gz(rows, path, rows_per_file=20_000)
    return read_csv_gz(spark, path, rows.schema)


def verify_counts(spark, sf):
    tables = {
        "users": driver_table(spark, sf, "customer"),
        "units": driver_table(spark, sf, "supplier"),
        "transactions": snapshot_filtered(spark, sf),
    }
    return counts_of(tables, len(DRIVER_TABLES))


QUERIES = {
    "snapshot_filtered": snapshot_filtered,
    "snapshot_manifest": snapshot_manifest,
    "snapshot_restore": snapshot_restore,
    "restore_verify": restore_verify,
    "csv_roundtrip": csv_roundtrip,
    "csv_texts": csv_texts,
    "max_id_or_one": lambda spark, sf: next_base(
        driver_table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))
    ),
    "verify_counts": verify_counts,
}

_RECENT = f"o_orderdate >= timestamp '{FLOOR}'"


def _columns_of(table: str) -> str:
    return f"(select cast(count(*) as int) from (describe {table}))"


ORACLES = {
    "snapshot_filtered": f"select * from orders where {_RECENT}",
    "snapshot_manifest": " union all ".join(
        f"select '{n}' as \"table\", {_columns_of(n)} as columns, "
        f"{'cast(0 as bigint)' if n == 'orders' else f'(select count(*) from {n})'} as rows, "
        f"{'true' if n == 'orders' else 'false'} as structure_only"
        for n in DRIVER_TABLES
    ),
    "snapshot_restore": f"""select o.*, c_name, c_nationkey, c_acctbal, c_mktsegment
        from orders o left join customer on c_custkey = o_custkey where {_RECENT}""",
    "restore_verify": f"""
        select 'orders' as "table", count(*) as expected, count(*) as found, true as same, max(o_orderkey) as next_base
        from orders where {_RECENT}
        union all select 'customer', count(*), count(*), true, max(c_custkey) from customer
        union all select 'documents', count(*), count(*), true, null from documents""",
    "csv_roundtrip": "select * from docs_text",
    "csv_texts": "select * from documents",
    "max_id_or_one": "select coalesce(max(o_orderkey), 1) as next_base from orders",
    "verify_counts": f"""select 'tables' as "check", '{len(DRIVER_TABLES)}' as total
        union all select 'users', cast(count(*) as varchar) from customer
        union all select 'units', cast(count(*) as varchar) from supplier
        union all select 'transactions', cast(count(*) as varchar) from orders where {_RECENT}""",
}
