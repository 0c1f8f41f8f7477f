"""Queries on record linkage."""

from __future__ import annotations

from pyspark.sql import functions as F

from keystitch.operators import links as L
from keystitch.plans.linking import link_all
from workload.standins import standin


def _documents(spark, sf, **rules):
    docs, maint, acc, links = (standin(spark, sf, n) for n in ("docs_text", "maint", "acc", "doc_links"))
    return L.link_documents(docs, maint, acc, links, **rules).select(*L.DOCUMENT_LINK)


def _movements(spark, sf, **rules):
    movs, units, links = (standin(spark, sf, n) for n in ("mov_text", "units", "mov_links"))
    return L.link_movements(movs, units, links, **rules).select(*L.MOVEMENT_LINK)


def _documents_of(shape, kind=None):
    rules = {"shapes": [shape]} | ({"kinds": [kind]} if kind else {})
    return lambda spark, sf: _documents(spark, sf, **rules)


def _movements_of(step):
    return lambda spark, sf: _movements(spark, sf, steps=[step])


def link_mov_strict(spark, sf):
    return _movements(spark, sf, steps=["text"], strict=True)


def folio_candidates(spark, sf):
    docs = standin(spark, sf, "docs_text")
    return L.folio_candidates(docs, ["multi"], distinct=False).select("document_id", "link_type", "pid")


def link_delta(spark, sf):
    links = standin(spark, sf, "doc_links")
    return L.link_delta(links, _documents(spark, sf))


def link_job(spark, sf):
    names = ("docs_text", "maint", "acc", "doc_links", "mov_text", "units", "mov_links")
    counts = link_all(*[standin(spark, sf, n) for n in names]).counts
    return counts.select(
        *[
            F.col(f"{kind}.{c}").alias(f"{kind}_{c}")
            for kind in ("documents", "movements")
            for c in ("before", "after", "delta")
        ],
        "documents.result.*",
        "movements.result.*",
    )


QUERIES = {
    "link_doc_exact_m": _documents_of("exact", "maintenance"),
    "link_doc_exact_s": _documents_of("exact", "accident"),
    "link_doc_norm_m": _documents_of("bare", "maintenance"),
    "link_doc_norm_s": _documents_of("bare", "accident"),
    "folio_explode": lambda spark, sf: L.folio_explode(standin(spark, sf, "docs_text")),
    "folio_candidates": folio_candidates,
    "link_doc_multi": _documents_of("multi"),
    "link_docs_all": lambda spark, sf: _documents(spark, sf),
    "link_mov_exact": _movements_of("direct"),
    "link_mov_padded": _movements_of("padded"),
    "link_mov_text": _movements_of("text"),
    "link_mov_strict": link_mov_strict,
    "link_movs_all": lambda spark, sf: _movements(spark, sf),
    "doc_link_stats": lambda spark, sf: L.document_link_stats(standin(spark, sf, "doc_links")),
    "mov_link_stats": lambda spark, sf: L.movement_link_stats(standin(spark, sf, "mov_links")),
    "link_delta": link_delta,
    "link_job": link_job,
}


def _doc_step(prefix: str, kind: str, table: str, column: str, pattern: str, method: str) -> str:
    ids = ("t.id", "cast(null as bigint)") if kind == "maintenance" else ("cast(null as bigint)", "t.id")
    return f"""select distinct d.document_id, '{kind}' as link_type, {ids[0]} as maintenance_id,
            {ids[1]} as accident_id, t.pid as linked_pid, '{method}' as match_method, 'high' as confidence
        from docs_text d join {table} t on t.pid = '{prefix}' || d.extra_text_three and t.active = 1
        where d.active = 1 and regexp_matches(d.extra_text_three, '{pattern}')
          and not exists (select 1 from doc_links l
              where l.document_id = d.document_id and l.{column} = t.id and l.active = 1)"""


_STEPS = {
    "link_doc_exact_m": _doc_step("", "maintenance", "maint", "maintenance_id", r"^M-\d{6}-\d+$", "auto_exact"),
    "link_doc_exact_s": _doc_step("", "accident", "acc", "accident_id", r"^S-\d{6}-\d+$", "auto_exact"),
    "link_doc_norm_m": _doc_step("M-", "maintenance", "maint", "maintenance_id", r"^\d{6}-\d+$", "auto_normalized"),
    "link_doc_norm_s": _doc_step("S-", "accident", "acc", "accident_id", r"^\d{6}-\d+$", "auto_normalized"),
}
_FOLIOS = r"""folios as (
    select document_id, unnest(m) as found, unnest(range(len(m))) as pos
    from (select document_id, regexp_extract_all(extra_text_three, '[MS]?-?\d{6}-\d+') as m from docs_text
          where active = 1 and regexp_matches(extra_text_three, '[/,;]')
            and regexp_matches(extra_text_three, '\d{6}-\d+')))"""
_CANDIDATES = _FOLIOS + r""", candidates as (
    select document_id, 'maintenance' as link_type, 'M-' || regexp_extract(found, '\d{6}-\d+$') as pid
    from folios where found[1] <> 'S'
    union all
    select document_id, 'accident', 'S-' || regexp_extract(found, '\d{6}-\d+$')
    from folios where found[1] <> 'M')"""
_MULTI = """select distinct c.document_id, c.link_type, m.id as maintenance_id,
        cast(null as bigint) as accident_id, c.pid as linked_pid, 'auto_normalized' as match_method,
        'medium' as confidence
    from candidates c join maint m on m.pid = c.pid and m.active = 1 and c.link_type = 'maintenance'
    where not exists (select 1 from doc_links l
        where l.document_id = c.document_id and l.maintenance_id = m.id and l.active = 1)
    union all
    select distinct c.document_id, c.link_type, cast(null as bigint), a.id, c.pid, 'auto_normalized', 'medium'
    from candidates c join acc a on a.pid = c.pid and a.active = 1 and c.link_type = 'accident'
    where not exists (select 1 from doc_links l
        where l.document_id = c.document_id and l.accident_id = a.id and l.active = 1)"""
_DOCS_ALL = " union all ".join([*_STEPS.values(), _MULTI])

_P = "(AP|TP|TR|AR|PR)"
# every text taken apart once: the whole of it as one code, and what looks like codes within it
_PARTS = rf"""parts as (
    select movement_id, extra_text_one as whole, trim(extra_text_one, ' ') as word,
        regexp_extract(upper(trim(extra_text_one, ' ')), '^{_P}-(\d+)$', 1) as own_prefix,
        regexp_extract(upper(trim(extra_text_one, ' ')), '^{_P}-(\d+)$', 2) as own_digits,
        regexp_extract(extra_text_one, '{_P}-', 1) as first_prefix,
        regexp_extract(extra_text_one, '{_P}-(\d+)', 2) as first_digits,
        regexp_extract(trim(extra_text_one, ' '), '{_P}-\d\d\d?') as long_code,
        regexp_matches(upper(extra_text_one), '{_P}-\d') as has_code
    from mov_text where active = 1 and extra_text_one is not null)"""
# what each rule reads off the parts: the code to look up and the one to store
_NAMED = f"""{_PARTS}, named as (
    select movement_id, 'direct' as rule, own_prefix || '-' || own_digits as code,
        own_prefix || '-' || own_digits as stored, 'high' as confidence
    from parts where length(own_digits) = 3
    union all
    select movement_id, 'padded', case when starts_with(word, own_prefix) then own_prefix || '-' || lpad(own_digits, 3, '0') end,
        own_prefix || '-' || lpad(own_digits, 3, '0'), 'high'
    from parts where length(own_digits) in (1, 2)
    union all
    select movement_id, 'text', first_prefix || '-' || lpad(first_digits, 3, '0'), nullif(long_code, ''), 'medium'
    from parts where has_code and length(own_digits) not between 1 and 3 and first_prefix <> '' and first_digits <> ''
    union all
    select movement_id, 'strict', c, c, 'medium' from (
        select movement_id, split_part(f, '--', 1) || '-' || lpad(split_part(f, '--', 2), 3, '0') as c from (
            -- separators are doubled, so that neighbours do not share one
            select movement_id, unnest(regexp_extract_all(regexp_replace(' ' || whole || ' ', '([^A-Za-z0-9])', '\\1\\1', 'g'),
                '[^A-Za-z0-9]({_P}--\\d\\d?\\d?)[^A-Za-z0-9]', 1)) as f
            from parts where has_code and length(own_digits) not between 1 and 3)))"""


def _mov_links(*rules: str) -> str:
    wanted = ", ".join(f"'{r}'" for r in rules)
    return f"""with {_NAMED} select distinct n.movement_id, u.id as unit_id, n.stored as eco_number,
            'auto_direct' as match_method, n.confidence
        from named n join units u on u.active = 1 and upper(u.eco_number) = n.code
        where n.rule in ({wanted}) and not exists (select 1 from mov_links l
            where l.active = 1 and l.movement_id = n.movement_id and l.unit_id = u.id)"""


_MOVS = {
    "link_mov_exact": _mov_links("direct"),
    "link_mov_padded": _mov_links("padded"),
    "link_mov_text": _mov_links("text"),
    "link_mov_strict": _mov_links("strict"),
}
_MOVS_ALL = _mov_links("direct", "padded", "text")


def _count(table: str, alias: str, condition: str = "true") -> str:
    return f"(select count(*) from {table} where active = 1 and {condition}) as {alias}"


def _new(table: str, alias: str, condition: str = "true") -> str:
    return f"(select count(*) from {table} where {condition}) as {alias}"


def _delta(kind: str, links: str, new: str) -> str:
    before, added = f"(select count(*) from {links} where active = 1)", f"(select count(*) from {new})"
    return f"{before} as {kind}before, {before} + {added} as {kind}after, {added} as {kind}delta"


ORACLES = {
    **_STEPS,
    "folio_explode": rf"""with {_FOLIOS} select document_id, cast(pos as int) as pos,
        regexp_extract(found, '^[MS]') as prefix, regexp_extract(found, '(\d{{6}})-\d+$', 1) as date,
        regexp_extract(found, '-(\d+)$', 1) as seq from folios""",
    "folio_candidates": f"with {_CANDIDATES} select * from candidates",
    "link_doc_multi": f"with {_CANDIDATES} {_MULTI}",
    "link_docs_all": f"with {_CANDIDATES} {_DOCS_ALL}",
    **_MOVS,
    "link_movs_all": _MOVS_ALL,
    "doc_link_stats": "select "
    + ", ".join(
        [
            _count("doc_links", "total_links"),
            _count("doc_links", "auto_exact", "match_method = 'auto_exact'"),
            _count("doc_links", "auto_normalized", "match_method = 'auto_normalized'"),
            _count("doc_links", "manual_links", "match_method = 'manual'"),
            _count("doc_links", "maintenance_links", "link_type = 'maintenance'"),
            _count("doc_links", "accident_links", "link_type = 'accident'"),
        ]
    ),
    "mov_link_stats": "select "
    + ", ".join(
        [
            _count("mov_links", "total_links"),
            _count("mov_links", "auto_direct", "match_method = 'auto_direct'"),
            _count("mov_links", "auto_via_document", "match_method = 'auto_via_document'"),
            _count("mov_links", "manual_links", "match_method = 'manual'"),
        ]
    ),
    "link_delta": f"with {_CANDIDATES}, new as ({_DOCS_ALL}) select {_delta('', 'doc_links', 'new')}",
    "link_job": f"""with {_CANDIDATES}, nd as ({_DOCS_ALL}), em as ({_MOVS["link_mov_exact"]}),
        pm as ({_MOVS["link_mov_padded"]}), tm as ({_MOVS["link_mov_text"]}),
        nm as (select * from em union all select * from pm union all select * from tm)
        select {_delta("documents_", "doc_links", "nd")}, {_delta("movements_", "mov_links", "nm")}, """
    + ", ".join(
        [
            _new("nd", "exact_m", "match_method = 'auto_exact' and link_type = 'maintenance'"),
            _new("nd", "exact_s", "match_method = 'auto_exact' and link_type = 'accident'"),
            _new("nd", "normalized_m", "match_method <> 'auto_exact' and confidence = 'high' and link_type = 'maintenance'"),
            _new("nd", "normalized_s", "match_method <> 'auto_exact' and confidence = 'high' and link_type = 'accident'"),
            _new("nd", "multiple_folios", "confidence = 'medium'"),
            _new("em", "direct_matches"),
            _new("pm", "normalized_matches"),
            _new("tm", "text_matches"),
        ]
    ),
}
