"""Keys of rows, and joins of documents with a list of ids that keep the texts where they are while the list is small."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystitch.sources.tables import stage

#: Ids that are broadcast at most; they take some 100 MB. Longer lists are joined by shuffling both sides.
BROADCAST_IDS = 2_000_000
#: More rows than a file holds.
FILE_ROWS = 1 << 40


def small(ids: DataFrame) -> DataFrame:
    """`ids`, to be broadcast if there are few."""
    return F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids


def spare(docs: DataFrame, name: str) -> str:
    """`name`, with underscores behind it until no column of `docs` is called so."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """`docs` with a number of its own for each row, and the name of that column.

    Rows are told apart that agree in every column, or have no id. Where `docs` is a Parquet table as it was read, the
    number is the row's place in its file, behind a number of the file, and nothing is written. Other rows are written
    down with a number, as a second run of their plan may deal them otherwise."""
    name = spare(docs, "row")
    places = _places(docs, name)
    if places is None:
        return stage(docs.withColumn(name, F.monotonically_increasing_id()), "keyed"), name
    return places, name


def _places(docs: DataFrame, name: str) -> DataFrame | None:
    # above a join or a generator one row of a file may stand several times
    if not docs._jdf.queryExecution().analyzed().children().isEmpty():
        return None
    file, place = spare(docs, "file"), spare(docs, "place")
    try:
        hidden = docs.metadataColumn("_metadata")
        found = docs.select("*", hidden["file_path"].alias(file), hidden["row_index"].alias(place))
    except AnalysisException:
        return None
    # as many as the files that the driver lists for the scan
    files = sorted(r[0] for r in found.select(file).distinct().collect())
    numbers = docs.sparkSession.createDataFrame(list(zip(files, range(len(files)))), f"{file} string, {name} long")
    key = (F.col(name) * FILE_ROWS + F.col(place)).alias(name)
    return found.join(small(numbers), file).select(*docs.columns, key)


def without(docs: DataFrame, ids: DataFrame, name: str = "doc_id") -> DataFrame:
    """Rows of `docs` whose column `name` is not in the one column of `ids`. Rows that have NULL there stay."""
    return docs.join(small(ids.toDF(name)), name, "left_anti").select(*docs.columns)


def flagged(docs: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """`docs` with a column that tells whether doc_id is among the distinct `ids`."""
    marked = ids.toDF("doc_id").distinct().withColumn(name, F.lit(True))
    return docs.join(small(marked), "doc_id", "left").withColumn(name, F.coalesce(name, F.lit(False)))
