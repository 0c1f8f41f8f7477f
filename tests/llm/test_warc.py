"""Archives: round trip, revisits, file sizes and repeatability."""

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from keystitch.llm import warc
from keystitch.sources.tables import new_folder

DATE = "2025-01-01T00:00:00Z"


def digest(payload):
    return base64.b32encode(hashlib.sha1((payload or "").encode()).digest()).decode()


def expected(pages, least=0):
    groups = {}
    for key, payload in pages:
        groups.setdefault(payload or "", []).append(key)
    out = []
    for key, payload in pages:
        last = max(groups[payload or ""])
        size = len((payload or "").encode())
        revisit = key != last and size >= least
        out.append((key, size, digest(payload), "revisit" if revisit else "response", last if revisit else None))
    return sorted(out)


@pytest.mark.parametrize("least", [0, 10])
def test_pages_with_copies(spark, sf, rows, least):
    pages = spark.read.parquet(f"{sf}/pages.parquet").withColumn(
        "html", F.expr("case when page_id % 3 = 0 then 'same é' when page_id % 7 = 0 then null else html end")
    )
    folder = new_folder(spark, "warc")
    files = warc.write(pages, folder, date=DATE, revisit_bytes=least, shard_bytes=40_000, file_bytes=9_000)
    assert files.count() > 4 and files.agg(F.sum("records")).first()[0] == pages.count()
    got = warc.read(spark, folder).withColumn("intact", F.col("intact").cast("int"))
    assert got.agg(F.min("intact")).first()[0] == 1
    kept = rows(got.select("key", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    source = [(r.page_id, r.html) for r in pages.collect()]
    assert kept == sorted(expected(source, least), key=repr)
    texts = {r.key: r.payload.decode() for r in got.where("record_type = 'response'").collect()}
    assert all((dict(source)[k] or "") == v for k, v in texts.items())


def test_archives_do_not_depend_on_the_run(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    found = []
    for parts in (1, 5):
        folder = new_folder(spark, "warc")
        files = warc.write(pages.repartition(parts), folder, date=DATE, shard_bytes=60_000, file_bytes=9_000)
        found.append(sorted((r.name, r.sha256) for r in files.collect()))
    assert found[0] == found[1]


def test_a_folder_is_written_once(spark, sf):
    pages, folder = spark.read.parquet(f"{sf}/pages.parquet"), new_folder(spark, "warc")
    warc.write(pages, folder, date=DATE)
    with pytest.raises(Exception, match="manifest|exist|EXISTS"):
        warc.write(pages, folder, date=DATE)


def test_defined_cases(spark, rows):
    data = [(None, "u", "a"), (None, None, "a"), (1, "x y\n", "b"), (1, "z", "b"), (1, "z", "b"), (5, None, None), (6, "q", "")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("key", F.lit(0))
    got = warc.archive(pages)
    assert rows(got.select("page_id", "record_type", "refers_to")) == sorted(
        [(None, "response", None), (None, "revisit", None), (1, "response", None), (1, "revisit", 1), (1, "revisit", 1),
         (5, "revisit", 6), (6, "response", None)], key=repr)
    assert {r.url for r in got.collect()} == {None, "u", "x%20y%0A", "z", "q"}
    assert warc.archive(pages.limit(0)).count() == 0
