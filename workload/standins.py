"""Tables of the synchronised systems, played by the driver's star schema.

Each is one SQL text over whole driver tables that reads the same in Spark and in DuckDB. Row counts
grow linearly with the driver tables. Every supplier is a unit; those with a key of more than three digits have a code
that no text names.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def _folio(key: str) -> str:
    return (
        f"'25'||lpad(cast({key}%12+1 as string),2,'0')||lpad(cast({key}%28+1 as string),2,'0')"
        f"||'-'||cast({key} as string)"
    )


def _stamp(years: str) -> str:
    return (
        "lpad(cast(month(o_orderdate) as string),2,'0')||'/'||lpad(cast(day(o_orderdate) as string),2,'0')"
        f"||'/'||cast(year(o_orderdate)+{years} as string)||' 00:00:00:000'"
    )


_BLANK_STAMPS = "when o_orderkey%17=0 then '' when o_orderkey%13=0 then '12/30/1899 00:00:00:000'"
_HH = "lpad(cast(hour(ts) as string),2,'0')"
_MM = "lpad(cast(minute(ts)-minute(ts)%10 as string),2,'0')"

STANDINS: dict[str, str] = {
    # lookups
    "units": """
        select id, case when id%7=3 then lower(code) else code end as eco_number,
               case when id%19=18 then 0 else 1 end as active
        from (select s_suppkey as id, substr('APTPTRARPR', cast(s_suppkey%5*2+1 as int), 2)||'-'
                     ||lpad(cast(s_suppkey as string), cast(greatest(3, length(cast(s_suppkey as string))) as int), '0')
                     as code from supplier) u""",
    "maint": f"""
        select c_custkey as id, 'M-'||{_folio("c_custkey")} as pid,
               case when c_custkey%23=22 then 0 else 1 end as active from customer""",
    "acc": f"""
        select c_custkey as id, 'S-'||{_folio("c_custkey")} as pid,
               case when c_custkey%23=21 then 0 else 1 end as active from customer""",
    # documents, as the linkage and the patch see them
    "docs_text": f"""
        select document_id, active, priority, status,
               case k when 0 then 'M-'||f when 1 then 'S-'||f when 2 then f when 3 then 'm-'||f||', '||g
                      when 4 then 'M-'||f||' / S-'||g||'; '||f when 5 then '' when 6 then null
                      when 7 then 'M-'||f||chr(10) when 8 then 'ref '||f||' rev'
                      else 'M--'||f||',12'||g end as extra_text_three
        from (select o_orderkey as document_id, o_orderpriority as priority, o_orderstatus as status,
                     case when o_orderkey%29=28 then 0 when o_orderkey%29=27 then null else 1 end as active,
                     cast(o_orderkey%10 as int) as k, {_folio("o_custkey")} as f,
                     {_folio("(o_custkey+1)")} as g from orders) x""",
    "doc_links": """
        select d.document_id, 'maintenance' as link_type, m.id as maintenance_id,
               cast(null as bigint) as accident_id, d.extra_text_three as linked_pid,
               case when d.status='O' then 'manual' else 'auto_exact' end as match_method,
               'high' as confidence, case when d.status='P' then 0 else 1 end as active
        from docs_text d join maint m on m.pid=d.extra_text_three where d.priority='1-URGENT'
        union all
        select d.document_id, 'accident', cast(null as bigint), a.id, a.pid, 'auto_normalized', 'high', 1
        from docs_text d join acc a on a.pid='S-'||d.extra_text_three where d.priority='2-HIGH'""",
    # a source table and the copy kept of it
    "src_docs": f"""
        select o_orderkey as "CIDDOCUMENTO", o_totalprice as "CTOTAL",
               case when o_orderkey%11=3 then null else o_orderstatus end as "CNATURALEZA",
               case {_BLANK_STAMPS} when o_orderkey%7=0 then {_stamp("1")} else {_stamp("0")} end
                 as "CTIMESTAMP" from orders""",
    "tgt_docs": f"""
        select o_orderkey as document_id,
               case when o_orderkey%7=0 then o_totalprice-1 else o_totalprice end as total,
               o_orderstatus as nature,
               case {_BLANK_STAMPS} else {_stamp("0")} end as sql_timestamp, o_orderpriority as label
        from orders where o_orderpriority<>'5-LOW'
        union all
        select -1-o_orderkey, o_totalprice, o_orderstatus, '', o_orderpriority
        from orders where o_orderpriority='3-MEDIUM'""",
    "src_clients": """
        select c_custkey as "ID", c_name as "NAME", c_acctbal as "BALANCE" from customer""",
    "tgt_clients": """
        select c_custkey as client_id, c_name as name, c_acctbal+1 as balance from customer
        where c_mktsegment<>'BUILDING'""",
    "src_extras": """
        select d.document_id as "CIDDOCUMENTO",
               case cast(d.document_id%7 as int) when 0 then 'a' when 1 then ' x ' when 2 then '   '
                    when 3 then '' when 4 then chr(9)||'t' else null end as "CTEXTOEXTRA1",
               case d.status when 'O' then d.priority when 'P' then '' else null end as "CTEXTOEXTRA2",
               d.extra_text_three as "CTEXTOEXTRA3" from docs_text d""",
    "tgt_extras": """
        select d.document_id,
               case cast(d.document_id%7 as int) when 0 then ' a ' when 1 then 'y' when 2 then 'a'
                    when 3 then 'b' when 4 then 't' else null end as extra_text_one,
               case d.status when 'O' then d.priority when 'P' then '' else 'old' end as extra_text_two,
               case when d.document_id%6=0 then null else d.extra_text_three end as extra_text_three,
               d.active from docs_text d where d.priority<>'5-LOW'""",
    # movements
    "mov_text": """
        select movement_id, case when movement_id%31=30 then 0 else 1 end as active, kind,
               case cast(movement_id%8 as int) when 0 then p||'-'||lpad(n,3,'0')
                    when 1 then lower(p||'-'||lpad(n,3,'0')) when 2 then ' '||p||'-'||n||' '
                    when 3 then lower(p||'-'||n) when 4 then 'unidad '||p||'-'||n||' frenos'
                    when 5 then 'S'||p||'-'||n||'99' when 6 then p||'-X y TP-'||lpad(n,2,'0')
                    else null end as extra_text_one
        from (select event_id as movement_id, event_type as kind,
                     substr('APTPTRARPR', cast(user_id%5*2+1 as int), 2) as p,
                     cast(user_id%100 as string) as n from events) e""",
    "mov_links": """
        select m.movement_id, u.id as unit_id, u.eco_number,
               case when m.kind='click' then 'manual' when m.kind='view' then 'auto_via_document'
                    else 'auto_direct' end as match_method,
               'high' as confidence, case when m.kind='error' then 0 else 1 end as active
        from mov_text m join units u on u.eco_number=m.extra_text_one
        where m.kind in ('click','view','error')""",
    # readings; every value is text, as in the responses
    "readings_raw": f"""
        select event_id as ord, event_type as kind, cast(cast(ts as date) as string) as fecha,
               case cast(event_id%6 as int) when 0 then {_HH}||':'||{_MM} when 1 then {_HH}||':'||{_MM}||':00'
                    when 2 then {_HH}||{_MM}||'00' when 3 then {_HH}||{_MM}
                    when 4 then cast(hour(ts) as string)||':'||{_MM} else null end as hora,
               case when event_id%41=40 then '' when event_id%43=42 then '2d'
                    else cast(user_id%4 as string) end as numero_tanque,
               cast(user_id%3 as string) as status_actual, cast(value as string) as volumen,
               case when event_id%47=46 then '' else cast(value as string) end as volumen_compensado,
               case when event_id%53=52 then 'n/a' else ' '||cast(user_id as string)||' ' end as altura,
               cast(user_id%30 as string)||'.5' as temperatura,
               case when user_id%5=0 then '1e-2' else null end as volument_agua,
               case when event_id%50=49 then '2023-12-31' else cast(cast(ts as date) as string) end as dia
        from events""",
    "tgt_readings": """
        select cast(fecha as date) as date, hora as hour, try_cast(numero_tanque as int) as tank_number,
               min(ord) as first_ord, max(case when kind='signup' then 1 else 0 end) as active
        from readings_raw
        where kind in ('signup','error') and length(hora)=5 and numero_tanque in ('1','2','3') and dia=fecha
        group by fecha, hora, numero_tanque""",
    "bad_hours": f"""
        select event_id as id, cast(ts as date) as date,
               case when event_id%9=8 then {_HH}||':'||cast(minute(ts)%10 as string)||':'
                    when event_id%9=7 then null else {_HH}||':'||{_MM} end as hour,
               cast(user_id%4 as int) as tank_number, ts as created_at from events""",
}


def _names_in(sql: str, names: Iterable[str]) -> list[str]:
    return [n for n in names if re.search(rf"\b(?:from|join)\s+{n}\b", sql)]


@cache
def _schema(path: str) -> StructType:
    return SparkSession.active().read.parquet(path).schema


def driver_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A driver table; its schema is looked up once, as every lookup is a Spark job."""
    path = f"{folder}/{name}.parquet"
    return spark.read.schema(_schema(path)).parquet(path)


def standin(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The stand-in as a DataFrame over the Parquet tables of `folder`."""
    sql = STANDINS[name].replace('"', "")
    inputs = {n: standin(spark, folder, n) for n in _names_in(sql, STANDINS)}
    inputs |= {n: driver_table(spark, folder, n) for n in _names_in(sql, DRIVER_TABLES)}
    for n in inputs:
        sql = re.sub(rf"\b(from|join)\s+{n}\b", rf"\1 {{{n}}}", sql)
    return spark.sql(sql, **inputs)


def with_standins(query: str) -> str:
    """The DuckDB query with a common table expression for every stand-in it uses."""
    needed: list[str] = []

    def add(sql: str) -> None:
        for n in _names_in(sql, STANDINS):
            if n not in needed:
                add(STANDINS[n])
                needed.append(n)

    add(query)
    if not needed:
        return query
    ctes = ", ".join(f"{n} as ({STANDINS[n]})" for n in needed)
    body = query.strip()
    if body[:5].lower() == "with ":
        return f"with {ctes}, {body[5:]}"
    return f"with {ctes} {body}"
