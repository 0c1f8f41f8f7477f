"""Record linkage: golden rows, comparison with plain Python, and a second run that adds nothing."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keystitch.operators import links as L
from keystitch.plans.linking import link_all, link_tables
from workload.standins import standin

LOOKUP = "id long, pid string, active int"
LINKS = (
    "document_id long, link_type string, maintenance_id long, accident_id long, linked_pid string, "
    "match_method string, confidence string, active int"
)
MOVEMENT_LINKS = "movement_id long, unit_id long, eco_number string, match_method string, confidence string, active int"
MAINT = [
    (1, "M-250101-1", 1),
    (2, "M-250102-2", 1),
    (3, "M-250101-3", 1),
    (4, "M-234567-3", 1),
    (5, "M-250103-4", 1),
    (6, "M-250104-5", 1),
    (7, "M-250109-9", 0),
    (8, "S-250101-2", 1),
]
ACC = [
    (11, "S-250101-1", 1),
    (12, "S-250101-2", 1),
    (13, "S-250101-3", 1),
    (14, "S-234567-3", 1),
    (15, "S-250103-4", 1),
    (16, "S-250104-5", 1),
    (17, "S-250102-2", 1),
]
# text, then expected (linked_pid, method, confidence)
TEXTS = [
    ("M-250101-1", [("M-250101-1", "auto_exact", "high")]),
    ("S-250101-2", [("S-250101-2", "auto_exact", "high")]),
    ("250101-3", [("M-250101-3", "auto_normalized", "high"), ("S-250101-3", "auto_normalized", "high")]),
    ("m-250101-1", []),
    ("m-250101-1, x", [("M-250101-1", "auto_normalized", "medium"), ("S-250101-1", "auto_normalized", "medium")]),
    (
        "M-250101-1/250102-2",
        [
            ("M-250101-1", "auto_normalized", "medium"),
            ("M-250102-2", "auto_normalized", "medium"),
            ("S-250102-2", "auto_normalized", "medium"),
        ],
    ),
    (
        "M-250101-1, 250101-1",
        [("M-250101-1", "auto_normalized", "medium"), ("S-250101-1", "auto_normalized", "medium")],
    ),
    ("M-250101-1 250102-2", []),
    ("1234567-3,", [("M-234567-3", "auto_normalized", "medium"), ("S-234567-3", "auto_normalized", "medium")]),
    ("XM250103-4;", [("M-250103-4", "auto_normalized", "medium")]),
    ("M--250104-5,", [("M-250104-5", "auto_normalized", "medium"), ("S-250104-5", "auto_normalized", "medium")]),
    (" M-250101-1", []),
    ("M-250101-1\n", []),
    ("M-250109-9", []),
    ("", []),
    (None, []),
]


def documents(spark, rows):
    return spark.createDataFrame(rows, "document_id long, extra_text_three string, active int")


def linked(spark, docs, links=()):
    return L.link_documents(
        docs,
        spark.createDataFrame(MAINT, LOOKUP),
        spark.createDataFrame(ACC, LOOKUP),
        spark.createDataFrame(list(links), LINKS),
    )


def test_document_texts(spark):
    docs = documents(spark, [(i, t, 1) for i, (t, _) in enumerate(TEXTS)])
    got = {i: [] for i in range(len(TEXTS))}
    for r in linked(spark, docs).collect():
        kind = "maintenance" if r.linked_pid.startswith("M") else "accident"
        assert r.link_type == kind
        assert (r.maintenance_id is None) == (kind == "accident") and (r.accident_id is None) == (kind != "accident")
        got[r.document_id].append((r.linked_pid, r.match_method, r.confidence))
    assert {i: sorted(v) for i, v in got.items()} == {i: sorted(e) for i, (_, e) in enumerate(TEXTS)}


def test_inactive_documents_and_known_links(spark):
    docs = documents(spark, [(1, "M-250101-1", 0), (2, "M-250101-1", None), (3, "M-250101-1", 1), (4, "M-250101-1", 1)])
    known = [
        (3, "maintenance", 1, None, "M-250101-1", "manual", "high", 1),
        (4, "maintenance", 1, None, "M-250101-1", "manual", "high", 0),
    ]
    assert [r.document_id for r in linked(spark, docs, known).collect()] == [4]


def test_repeated_lookup_codes_keep_the_fan_out(spark):
    docs = documents(spark, [(1, "M-250101-1", 1)])
    maint = spark.createDataFrame([(1, "M-250101-1", 1), (2, "M-250101-1", 1)], LOOKUP)
    links = spark.createDataFrame([], LINKS)
    got = L.link_documents(docs, maint, spark.createDataFrame([], LOOKUP), links)
    assert sorted(r.maintenance_id for r in got.collect()) == [1, 2]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.lists(st.sampled_from(["M", "S", "m", "-", "250101", "12", "3", "/", ",", " ", "X"]), max_size=12).map("".join),
        min_size=1,
        max_size=100,
    )
)
def test_folio_scan_like_plain_python(spark, texts):
    def plain(text):
        if not (re.search("[/,;]", text) and re.search("[0-9]{6}-[0-9]+", text)):
            return []
        found = re.finditer("([MS])?-?([0-9]{6})-([0-9]+)", text)
        return [(p, m[1] or "", m[2], m[3]) for p, m in enumerate(found)]

    docs = documents(spark, [(i, t, 1) for i, t in enumerate(texts)])
    got = sorted(tuple(r) for r in L.folio_explode(docs).collect())
    assert got == [(i, *f) for i, t in enumerate(texts) for f in plain(t)]


UNITS = [(5, "AP-005", 1), (12, "ap-012", 1), (123, "AP-123", 1), (223, "AR-123", 1), (312, "TP-012", 1), (7, "AP-007", 0)]
MOVEMENTS = [
    (" ap-005 ", (5, "AP-005", "high")),
    ("AP-012", (12, "AP-012", "high")),
    ("AP-5", (5, "AP-005", "high")),
    ("AP-05", (5, "AP-005", "high")),
    ("ap-5", None),
    ("unidad AP-12 frenos", (12, "AP-12", "medium")),
    ("unidad AP-5 frenos", (5, None, "medium")),
    ("ap-12 frenos", None),
    ("STAR-123", (223, "AR-123", "medium")),
    ("AP-1234", (123, "AP-123", "medium")),
    ("TP-X y AP-12", (312, "AP-12", "medium")),
    ("AP-5 y AP-12", (5, "AP-12", "medium")),
    ("AP-005\n", (5, "AP-005", "medium")),
    ("AP-007", None),
    ("ZZ-005", None),
    ("", None),
    (None, None),
]


def movements(spark, texts):
    return spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "movement_id long, extra_text_one string, active int")


def test_movement_texts(spark):
    units = spark.createDataFrame(UNITS, "id long, eco_number string, active int")
    links = spark.createDataFrame([], MOVEMENT_LINKS)
    got = L.link_movements(movements(spark, [t for t, _ in MOVEMENTS]), units, links).collect()
    assert {r.movement_id: (r.unit_id, r.eco_number, r.confidence) for r in got} == {
        i: e for i, (_, e) in enumerate(MOVEMENTS) if e
    }
    assert len(got) == len({(r.movement_id, r.unit_id) for r in got})
    assert {r.match_method for r in got} == {"auto_direct"}


def test_second_run_adds_nothing(spark):
    docs = documents(spark, [(i, t, 1) for i, (t, _) in enumerate(TEXTS)])
    maint, acc = spark.createDataFrame(MAINT, LOOKUP), spark.createDataFrame(ACC, LOOKUP)
    units = spark.createDataFrame(UNITS, "id long, eco_number string, active int")
    movs = movements(spark, [t for t, _ in MOVEMENTS])
    doc_links, mov_links = spark.createDataFrame([], LINKS), spark.createDataFrame([], MOVEMENT_LINKS)
    first = link_all(docs, maint, acc, doc_links, movs, units, mov_links)
    counts = first.counts.first()
    assert counts.documents.before == 0 and counts.documents.after == counts.documents.delta
    assert counts.documents.delta == sum(counts.documents.result)
    assert counts.movements.delta == sum(counts.movements.result)
    assert counts.movements.result.asDict() == {"direct_matches": 2, "normalized_matches": 2, "text_matches": 7}
    again = link_all(docs, maint, acc, first.document_links, movs, units, first.movement_links)
    assert again.counts.first().documents.delta == 0 and again.counts.first().movements.delta == 0
    pairs = first.document_links.groupBy("document_id", "maintenance_id", "accident_id").count()
    assert pairs.filter(F.col("count") > 1).count() == 0
    assert '"script":"link"' in again.summary.first().summary


def test_stats_ignore_inactive_links(spark):
    rows = [
        (1, "maintenance", 1, None, "p", "auto_exact", "high", 1),
        (2, "accident", None, 1, "p", "manual", "high", 1),
        (3, "accident", None, 1, "p", "auto_normalized", "high", 0),
        (4, "accident", None, 1, "p", "auto_normalized", "high", None),
    ]
    stats = L.document_link_stats(spark.createDataFrame(rows, LINKS)).first()
    assert tuple(stats) == (2, 1, 0, 1, 1, 1)


def test_a_movement_listed_twice_links_a_unit_once(spark):
    movements = spark.createDataFrame([(1, "TP-007", 1), (1, "see TP-007 there", 1)], "movement_id int, extra_text_one string, active int")
    units = spark.createDataFrame([(5, "TP-007", 1)], "id int, eco_number string, active int")
    links = spark.createDataFrame([], "movement_id int, unit_id int, active int")
    found = L.link_movements(movements, units, links).collect()
    assert [(r.movement_id, r.unit_id, r.rule) for r in found] == [(1, 5, "direct")]


def test_link_tables_appends_once(spark, sf):
    names = ("docs_text", "maint", "acc", "doc_links", "mov_text", "units", "mov_links")
    tables = [f"linked_{n}" for n in names]
    for n, t in zip(names, tables, strict=True):
        standin(spark, sf, n).write.mode("overwrite").saveAsTable(t)
    files = lambda: {r.f for t in (tables[3], tables[6]) for r in spark.table(t).select(F.input_file_name().alias("f")).distinct().collect()}
    before = [spark.table(t).count() for t in (tables[3], tables[6])]
    run = link_tables(spark, *tables)
    delta = run.counts.select("documents.delta", F.col("movements.delta").alias("m")).first()
    after = [spark.table(t).count() for t in (tables[3], tables[6])]
    assert [b - a for a, b in zip(before, after, strict=True)] == [delta["delta"], delta["m"]] and min(delta) > 0
    held = files()
    again = link_tables(spark, *tables).counts.select("documents.delta", F.col("movements.delta").alias("m")).first()
    assert tuple(again) == (0, 0) and files() == held
    for t in tables:
        spark.sql(f"drop table {t}")


def test_strict_rule_takes_codes_that_stand_alone(spark):
    texts = {
        1: "STAR-123 frenos", 2: "TP-X y AP-12", 3: "AP-1, TP-22;AR-333", 4: "AP-1234 x", 5: "ap-12 x", 6: "AP-12", 7: "x AP-5a", 8: "(PR-7)",
        9: "AP-1 AP-1 AP-01", 10: None, 11: "", 12: "9AP-1 y", 13: "TR-4-5",
    }
    movements = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "movement_id int, extra_text_one string, active int")
    codes = ["AP-012", "AP-001", "TP-022", "AR-333", "AR-123", "TP-012", "AP-123", "AP-005", "PR-007", "TR-004"]
    units = spark.createDataFrame([(i, c, 1) for i, c in enumerate(codes)], "id int, eco_number string, active int")
    links = spark.createDataFrame([], "movement_id int, unit_id int, active int")
    found = L.link_movements(movements, units, links, ["text"], strict=True).collect()
    assert sorted((r.movement_id, r.eco_number, codes[r.unit_id], r.confidence) for r in found) == [
        (i, c, c, "medium")
        for i, c in [(2, "AP-012"), (3, "AP-001"), (3, "AR-333"), (3, "TP-022"), (8, "PR-007"), (9, "AP-001"), (13, "TR-004")]
    ]


def test_every_supplier_is_a_unit(spark):
    suppliers = spark.range(1, 3001).withColumnRenamed("id", "s_suppkey")
    from workload.standins import STANDINS

    units = spark.sql(STANDINS["units"].replace("from supplier", "from {supplier}"), supplier=suppliers)
    assert units.count() == units.select("eco_number").distinct().count() == 3000
