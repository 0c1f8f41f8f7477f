"""Queries on key comparison, watermarks, upserts and text patches."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystitch.functions.numbers import parse_number, whole
from keystitch.operators.changes import (
    change_counts,
    change_keys,
    change_rows,
    modified_rows,
    stamps_after_load,
    text_as_time,
    watermark_text,
    watermark_time,
)
from keystitch.operators.extras import EXTRA_COLUMNS, changed_texts, rows_with_text
from keystitch.operators.keys import fetch_rows, last_per_key, missing_keys, split_rejects
from keystitch.operators.merge import patch, upsert, upsert_outcome
from keystitch.operators.reports import sync_report as total_report
from keystitch.plans.extras import patch_extras
from keystitch.plans.journal import sync_together
from keystitch.plans.quarantine import keep_rejects, read_rejects, with_pending
from keystitch.plans.sync import sync_run, sync_table
from keystitch.sources.buckets import missing_keys_in, patch_in, replace_buckets, upsert_in, write_buckets
from keystitch.sources.specs import BLOCK, DOCUMENTS, TableSpec, map_columns as rename, with_block
from keystitch.sources.tables import new_folder, stage, swap_table
from keystitch.sources.tables import scan_keys as key_scan
from workload.standins import driver_table, standin

DOCS = TableSpec(
    "src_docs",
    "tgt_docs",
    "document_id",
    "CIDDOCUMENTO",
    "sql_timestamp",
    {
        "CIDDOCUMENTO": "document_id",
        "CTOTAL": "total",
        "CNATURALEZA": "nature",
        "CTIMESTAMP": "sql_timestamp",
    },
)
CLIENTS = TableSpec(
    "src_clients",
    "tgt_clients",
    "client_id",
    "ID",
    None,
    {"ID": "client_id", "NAME": "name", "BALANCE": "balance"},
)
SYNCED_AT = "2024-03-01 06:00:00"
MENDED_AT = "2024-03-02 06:00:00"


def _docs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return rename(standin(spark, sf, "src_docs"), DOCS), standin(spark, sf, "tgt_docs")


def _last_time(target: DataFrame):
    return watermark_time(target, "sql_timestamp").scalar()


def _without_zone(df: DataFrame) -> DataFrame:
    stamps = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps})


def scan_keys(spark, sf):
    return key_scan(standin(spark, sf, "src_docs"), "CIDDOCUMENTO", "document_id")


def map_columns(spark, sf):
    return rename(standin(spark, sf, "src_docs"), DOCUMENTS)


def _missing(spark, sf):
    docs, target = _docs(spark, sf)
    return docs, missing_keys(docs, target, "document_id")


def fetch_missing_rows(spark, sf):
    docs, keys = _missing(spark, sf)
    return fetch_rows(docs, keys, "document_id")


def cdc_modified_ref(spark, sf):
    docs, target = _docs(spark, sf)
    stamps = stamps_after_load(docs, target, "document_id", "sql_timestamp")
    watermark = text_as_time(watermark_text(stamps, "sql_timestamp"))
    return modified_rows(docs, "sql_timestamp", watermark.scalar())


def cdc_modified_safe(spark, sf):
    docs, target = _docs(spark, sf)
    return modified_rows(docs, "sql_timestamp", _last_time(target))


def cdc_changes(spark, sf):
    docs, target = _docs(spark, sf)
    keys = change_keys(docs, target, "document_id", "sql_timestamp", _last_time(target))
    return change_rows(docs, keys, "document_id", "sql_timestamp", _last_time(target))


def dedupe_last_wins(spark, sf):
    lines = driver_table(spark, sf, "lineitem")
    return last_per_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def upsert_apply(spark, sf):
    docs, target = _docs(spark, sf)
    return _without_zone(upsert(target, docs, "document_id", DOCS.value_columns, SYNCED_AT))


def _bucketed(spark, sf, name, key="document_id", buckets=8):
    """A stand-in as a bucketed catalog table of its own."""
    path = new_folder(spark, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    rows = standin(spark, sf, name)
    if name == "tgt_docs":
        rows = rows.withColumn("synced_at", F.lit(None).cast("timestamp"))
    write_buckets(rows, table, path, key, buckets)
    return table


def missing_keys_bucketed(spark, sf):
    docs, _ = _docs(spark, sf)
    return missing_keys_in(_bucketed(spark, sf, "tgt_docs"), docs)


def upsert_bucketed(spark, sf):
    docs, _ = _docs(spark, sf)
    table = _bucketed(spark, sf, "tgt_docs")
    new = upsert_in(table, docs, DOCS.value_columns, SYNCED_AT)
    return _without_zone(replace_buckets(new, table, new_folder(spark, "upsert")))


def patch_bucketed(spark, sf):
    table = _bucketed(spark, sf, "tgt_extras")
    new = patch_in(table, extra_diff(spark, sf), list(EXTRA_COLUMNS.values()))
    return replace_buckets(new, table, new_folder(spark, "patch"))


def upsert_outcomes(spark, sf):
    docs, target = _docs(spark, sf)
    return upsert_outcome(target, docs, "document_id")


def reject_split(spark, sf):
    raw = standin(spark, sf, "readings_raw")
    checks = {
        "no hour": F.col("hora").isNotNull(),
        "hour too long": F.length("hora") <= 5,
        "no tank number": whole(parse_number(F.col("numero_tanque"))).isNotNull(),
    }
    return split_rejects(raw, checks).select("ord", "reason")


def sync_report(spark, sf):
    docs, target = _docs(spark, sf)
    clients = rename(standin(spark, sf, "src_clients"), CLIENTS)
    doc_keys = change_keys(docs, target, "document_id", "sql_timestamp", _last_time(target))
    client_keys = change_keys(clients, standin(spark, sf, "tgt_clients"), "client_id")
    return total_report([change_counts(doc_keys, "src_docs"), change_counts(client_keys, "src_clients")])


def sync_job(spark, sf):
    run = sync_table(standin(spark, sf, "src_docs"), standin(spark, sf, "tgt_docs"), DOCS, SYNCED_AT)
    return _without_zone(run.table)


def _retried(spark, sf):
    """Two runs over a source of texts with totals that are no numbers, half of them mended before the second run; gives
    that run and the store it leaves."""
    spec = replace(DOCS, types={"document_id": "long", "total": "double"})
    store, table = new_folder(spark, "rejects"), standin(spark, sf, "tgt_docs")
    for bad, at in ((13, SYNCED_AT), (26, MENDED_AT)):
        total = F.when(F.col("CIDDOCUMENTO") % bad == 5, "n/a").otherwise(F.col("CTOTAL").cast("string"))
        source = standin(spark, sf, "src_docs").withColumns({"CTOTAL": total, "CIDDOCUMENTO": F.col("CIDDOCUMENTO").cast("string")})
        source, again = with_pending(source, spec, store)
        run = sync_table(source, table, spec, at, again=again, keep_source=True)
        # written, as a table is before its store changes
        table = stage(run.table, "synced")
        keep_rejects(run.rejects, spec, store, at)
    return table, read_rejects(spark, store)


def sync_rejects(spark, sf):
    rejects = _retried(spark, sf)[1]
    raw = F.get_json_object("row", "$.CTOTAL").alias("total")
    return _without_zone(rejects.select("entry", "reason", raw, "first_run", "last_run", "attempts"))


def sync_retried(spark, sf):
    return _without_zone(_retried(spark, sf)[0])


def _two_tables(spark, sf):
    """Catalog tables of their own for documents and clients, and the folder of their versions."""
    base = new_folder(spark, "versions")
    specs = [replace(s, target=f"{s.target}_{base[-32:]}") for s in (DOCS, CLIENTS)]
    for spec, name in zip(specs, ("tgt_docs", "tgt_clients"), strict=True):
        table = standin(spark, sf, name).withColumn("synced_at", F.lit(None).cast("timestamp"))
        swap_table(table, spec.target, f"{base}/{spec.target}")
    return specs, base


class _CutOff(Exception):
    pass


def sync_resumed(spark, sf):
    """Documents after a run over two tables that was cut off at the clients and then finished."""
    specs, base = _two_tables(spark, sf)
    read: list[str] = []

    def source(spec):
        read.append(spec.name)
        if read == ["src_docs", "src_clients"]:
            raise _CutOff
        return standin(spark, sf, spec.name)

    try:
        sync_together(spark, specs, source, base, SYNCED_AT, f"{base}/journal")
    except _CutOff:
        # goes on at the clients, with the time of the run that was cut off
        sync_together(spark, specs, source, base, MENDED_AT, f"{base}/journal")
    return _without_zone(spark.table(specs[0].target))


def sync_blocks_job(spark, sf):
    """Documents after a run over a table in blocks of keys, of which only those with changes are written."""
    spec = replace(DOCS, target=new_folder(spark, "blocks").rsplit("/", 1)[1].replace("-", "_"), block_size=10_000)
    table = standin(spark, sf, "tgt_docs").withColumn("synced_at", F.lit(None).cast("timestamp"))
    rows = with_block(table, spec).hint("rebalance", BLOCK)
    rows.write.partitionBy(BLOCK).saveAsTable(spec.target)
    sync_run([spec], lambda s: standin(spark, sf, s.name), new_folder(spark, "versions"), SYNCED_AT)
    return _without_zone(spark.table(spec.target).drop(BLOCK))


def report_json(spark, sf):
    """The summary of a run over two catalog tables, without the time it took."""
    specs, base = _two_tables(spark, sf)
    run = sync_run(specs, lambda spec: standin(spark, sf, spec.name), base, SYNCED_AT)
    return run.summary.select(F.regexp_replace("summary", '"elapsed_seconds":[0-9.E-]+,', "").alias("summary"))


def any_extra_filter(spark, sf):
    return rows_with_text(standin(spark, sf, "src_extras"), "CIDDOCUMENTO", "document_id")


def extra_diff(spark, sf):
    return changed_texts(any_extra_filter(spark, sf), standin(spark, sf, "tgt_extras"), "document_id")


def extra_patch_apply(spark, sf):
    target = standin(spark, sf, "tgt_extras")
    return patch(target, extra_diff(spark, sf), "document_id", list(EXTRA_COLUMNS.values()))


def extra_patch_job(spark, sf):
    return patch_extras(standin(spark, sf, "src_extras"), standin(spark, sf, "tgt_extras")).table


QUERIES = {
    "scan_keys": scan_keys,
    "map_columns": map_columns,
    "missing_keys": lambda spark, sf: _missing(spark, sf)[1],
    "fetch_missing_rows": fetch_missing_rows,
    "watermark_text": lambda spark, sf: watermark_text(standin(spark, sf, "tgt_docs"), "sql_timestamp"),
    "watermark_time": lambda spark, sf: _without_zone(
        watermark_time(standin(spark, sf, "tgt_docs"), "sql_timestamp")
    ),
    "cdc_modified_ref": cdc_modified_ref,
    "cdc_modified_safe": cdc_modified_safe,
    "cdc_changes": cdc_changes,
    "dedupe_last_wins": dedupe_last_wins,
    "upsert_apply": upsert_apply,
    "upsert_outcome": upsert_outcomes,
    "missing_keys_bucketed": missing_keys_bucketed,
    "upsert_bucketed": upsert_bucketed,
    "patch_bucketed": patch_bucketed,
    "reject_split": reject_split,
    "sync_report": sync_report,
    "sync_job": sync_job,
    "sync_rejects": sync_rejects,
    "sync_retried": sync_retried,
    "sync_resumed": sync_resumed,
    "sync_blocks_job": sync_blocks_job,
    "report_json": report_json,
    "any_extra_filter": any_extra_filter,
    "extra_diff": extra_diff,
    "extra_patch_apply": extra_patch_apply,
    "extra_patch_job": extra_patch_job,
}

_DOCS = """docs as (select "CIDDOCUMENTO" as document_id, "CTOTAL" as total, "CNATURALEZA" as nature,
    "CTIMESTAMP" as sql_timestamp from src_docs)"""
_FORMAT = "'%m/%d/%Y %H:%M:%S:%g'"
_STAMPED = "sql_timestamp is not null and sql_timestamp not in ('', '12/30/1899 00:00:00:000')"
_SAFE = f"""select max(try_strptime(sql_timestamp, {_FORMAT})) from tgt_docs where {_STAMPED}"""
_CHANGES = f"""{_DOCS}, changes as (
    select d.*, case when t.document_id is null then 'inserted' else 'updated' end as outcome
    from docs d left join tgt_docs t on t.document_id = d.document_id
    where t.document_id is null
       or ({_STAMPED.replace("sql_timestamp", "d.sql_timestamp")}
           and try_strptime(d.sql_timestamp, {_FORMAT}) > ({_SAFE})))"""
_MAPPED = {t: s for s, t in DOCUMENTS.columns.items()}
_HAVE = ("CIDDOCUMENTO", "CTOTAL", "CNATURALEZA", "CTIMESTAMP")
_BLANKS = r"[\s\x0B\x{00A0}\x{FEFF}\x{2028}\x{2029}\p{Zs}]"


def _trimmed(c: str) -> str:
    return f"regexp_replace(regexp_replace(coalesce({c}, ''), '^{_BLANKS}+', ''), '{_BLANKS}+$', '')"


_WITH_TEXT = """with_text as (
    select "CIDDOCUMENTO" as document_id, "CTEXTOEXTRA1" as extra_text_one,
           "CTEXTOEXTRA2" as extra_text_two, "CTEXTOEXTRA3" as extra_text_three
    from src_extras
    where rtrim(coalesce("CTEXTOEXTRA1", ''), ' ') <> '' or rtrim(coalesce("CTEXTOEXTRA2", ''), ' ') <> ''
       or rtrim(coalesce("CTEXTOEXTRA3", ''), ' ') <> '')"""
_DIFF = f"""{_WITH_TEXT}, diff as (
    select s.document_id, nullif(s.extra_text_one, '') as extra_text_one,
           nullif(s.extra_text_two, '') as extra_text_two, nullif(s.extra_text_three, '') as extra_text_three
    from with_text s join tgt_extras t on t.document_id = s.document_id
    where {" or ".join(
        f"{_trimmed(f's.{c}')} <> {_trimmed(f't.{c}')}" for c in EXTRA_COLUMNS.values())})"""
_PATCHED = f"""with {_DIFF} select t.document_id,
    case when d.document_id is null then t.extra_text_one else d.extra_text_one end as extra_text_one,
    case when d.document_id is null then t.extra_text_two else d.extra_text_two end as extra_text_two,
    case when d.document_id is null then t.extra_text_three else d.extra_text_three end as extra_text_three,
    t.active from tgt_extras t left join diff d on d.document_id = t.document_id"""


def _merged(rows: str) -> str:
    return f"""select coalesce(s.document_id, t.document_id) as document_id,
        case when s.document_id is not null then s.total else t.total end as total,
        case when s.document_id is not null then s.nature else t.nature end as nature,
        case when s.document_id is not null then s.sql_timestamp else t.sql_timestamp end as sql_timestamp,
        t.label, case when s.document_id is not null then timestamp '{SYNCED_AT}' end as synced_at
    from tgt_docs t full outer join {rows} s on s.document_id = t.document_id"""


ORACLES = {
    "scan_keys": 'select "CIDDOCUMENTO" as document_id from src_docs',
    "map_columns": "select "
    + ", ".join(
        f'"{s}" as "{t}"' if s in _HAVE else f'cast(null as varchar) as "{t}"' for t, s in _MAPPED.items()
    )
    + " from src_docs",
    "missing_keys": f"""with {_DOCS} select document_id from docs d
        where not exists (select 1 from tgt_docs t where t.document_id = d.document_id)""",
    "fetch_missing_rows": f"""with {_DOCS} select * from docs
        where document_id not in (select document_id from tgt_docs)""",
    "watermark_text": f"select coalesce(max(sql_timestamp), '') as last_ts from tgt_docs where {_STAMPED}",
    "watermark_time": f"""select max(try_strptime(sql_timestamp, {_FORMAT})) as last_time
        from tgt_docs where {_STAMPED}""",
    "cdc_modified_ref": f"""with {_DOCS}, loaded as (
            select sql_timestamp from tgt_docs union all
            select sql_timestamp from docs where document_id not in (select document_id from tgt_docs)),
        mark as (select max(sql_timestamp) as last_ts from loaded where {_STAMPED})
        select docs.* from docs where {_STAMPED} and try_strptime(sql_timestamp, {_FORMAT})
            > (select try_strptime(last_ts, {_FORMAT}) from mark)""",
    "cdc_modified_safe": f"""with {_DOCS} select * from docs
        where {_STAMPED} and try_strptime(sql_timestamp, {_FORMAT}) > ({_SAFE})""",
    "cdc_changes": f"with {_CHANGES} select * from changes",
    "dedupe_last_wins": """select * exclude (n) from (
        select *, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc,
            l_partkey desc, l_suppkey desc, l_quantity desc, l_extendedprice desc, l_discount desc,
            l_tax desc, l_returnflag desc, l_linestatus desc) as n from lineitem) where n = 1""",
    "upsert_apply": f"with {_DOCS} {_merged('docs')}",
    "upsert_outcome": f"""with {_DOCS} select document_id,
        case when exists (select 1 from tgt_docs t where t.document_id = d.document_id)
             then 'updated' else 'inserted' end as outcome from docs d""",
    "reject_split": """select ord, case when hora is null then 'no hour'
        when length(hora) > 5 then 'hour too long'
        when not regexp_matches(numero_tanque, '^[0-9]+$') then 'no tank number' end as reason
        from readings_raw""",
    "sync_report": f"""with {_CHANGES}, counts as (
        select 'src_docs' as name, outcome from changes union all
        select 'src_clients', 'inserted' from src_clients
        where "ID" not in (select client_id from tgt_clients))
        select name, count(*) filter (where outcome = 'inserted') as missing,
            count(*) filter (where outcome = 'inserted') as inserted,
            count(*) filter (where outcome = 'updated') as updated, cast(0 as bigint) as errors
        from counts group by rollup (name)""",
    "sync_job": f"with {_CHANGES} {_merged('changes')}",
    "any_extra_filter": f"with {_WITH_TEXT} select * from with_text",
    "extra_diff": f"with {_DIFF} select * from diff",
    "extra_patch_apply": _PATCHED,
    "extra_patch_job": _PATCHED,
    "patch_bucketed": _PATCHED,
}
_ENTRY = """'{"name":"' || name || '",' || numbers || '}'"""
ORACLES["report_json"] = f"""with counted as ({ORACLES["sync_report"]}), written as (
    select name, '"missing":' || missing || ',"inserted":' || inserted || ',"updated":' || updated || ',"errors":' || errors
        as numbers from counted)
    select '{{"script":"sync","tables":[' || (select string_agg({_ENTRY}, ',' order by name) from written where name is not null)
        || '],"totals":{{' || (select numbers from written where name is null) || '}}}}' as summary"""
ORACLES["sync_rejects"] = f"""with {_CHANGES} select cast(document_id as varchar) as entry,
    'value does not fit its type' as reason, 'n/a' as total, timestamp '{SYNCED_AT}' as first_run,
    timestamp '{MENDED_AT}' as last_run, 2 as attempts from changes where document_id % 26 = 5"""
ORACLES["sync_retried"] = f"""with {_CHANGES}, loaded as (
    select *, case when document_id % 13 = 5 then timestamp '{MENDED_AT}' else timestamp '{SYNCED_AT}' end as loaded_at
    from changes where document_id % 26 <> 5)
    select coalesce(s.document_id, t.document_id) as document_id,
        case when s.document_id is not null then s.total else t.total end as total,
        case when s.document_id is not null then s.nature else t.nature end as nature,
        case when s.document_id is not null then s.sql_timestamp else t.sql_timestamp end as sql_timestamp,
        t.label, s.loaded_at as synced_at
    from tgt_docs t full outer join loaded s on s.document_id = t.document_id"""
ORACLES["sync_resumed"] = ORACLES["sync_blocks_job"] = ORACLES["sync_job"]
ORACLES["missing_keys_bucketed"] = ORACLES["missing_keys"]
ORACLES["upsert_bucketed"] = ORACLES["upsert_apply"]
