"""Sheet documents: nested JSON, one file per sheet, and the same as lines.

A document is one JSON value, so one task reads it. ``land_documents`` splits
documents into lines once: one row per sheet row and one per column, as a table
that any number of tasks read together.

A sheet too large for one task comes in parts: documents with its columns and
some of its rows, in folders ``document_part=<number>`` below the sheet's own.
Such documents are landed; their rows follow each other by the parts' numbers.

Cells name their column by an id. Which place and id a title has is worked out
once per sheet (``_layout``); a row then takes the cell at that place and looks
further only if the cell there is another one. Of columns with equal titles the
last one that a row has a cell for gives the value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackledger.model import CREATED, MODIFIED, ROW_ID, ROW_ORDER, SHEET, SHEET_JSON
from trackledger.operators.blocks import BLOCK, rows_before
from trackledger.session import materialize

_ROW = SHEET_JSON["rows"].dataType.elementType
PART = "document_part"
_LINE = (
    T.StructType()
    .add("kind", T.StringType())
    .add(SHEET, T.StringType())
    .add(PART, T.LongType())
    .add("place", T.LongType())
    .add("id", T.LongType())
    .add("title", T.StringType())
    .add("createdAt", T.TimestampType())
    .add("modifiedAt", T.TimestampType())
    .add("cells", _ROW["cells"].dataType)
)

#: Bytes of a document file beyond which its lines are dealt over several files.
LARGE_DOCUMENT = 4 << 20

Titles = Sequence[str] | Mapping[str, T.DataType]


def _sheet_name(named_by: str) -> Column:
    """Sheet name from the file (without extension) or from its folder."""
    if named_by == "folder":
        part = F.regexp_extract(F.col("_metadata.file_path"), rf"/(?:[^/=]+=)?([^/]+)(?:/{PART}=\d+)?/[^/]+$", 1)
    else:
        part = F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*(?:\.gz)?$", "")
    # Paths in file metadata are encoded, except for the plus sign.
    return F.url_decode(F.replace(part, F.lit("+"), F.lit("%2B")))


def _documents(spark: SparkSession, path: str | list[str], named_by: str) -> DataFrame:
    docs = spark.read.schema(SHEET_JSON).json(path, multiLine=True)
    part = F.regexp_extract(F.col("_metadata.file_path"), rf"/{PART}=(\d+)/[^/]+$", 1)
    return docs.select(
        _sheet_name(named_by).alias(SHEET),
        F.nullif(part, F.lit("")).cast("long").alias(PART),
        F.col("_metadata.file_size").alias("n_bytes"),
        "columns",
        "rows",
    )


def _whole(docs: DataFrame) -> DataFrame:
    """Fails on a part of a sheet, whose rows have no place of their own."""
    broken = F.raise_error(F.concat(F.lit("sheet comes in parts, land it first: "), SHEET)).cast("string")
    return docs.withColumn(SHEET, F.when(F.col(PART).isNull(), F.col(SHEET)).otherwise(broken))


def sheet_columns(spark: SparkSession, path: str | list[str], named_by: str = "file") -> DataFrame:
    """Column metadata: sheet, column_id, title and position."""
    return _whole(_documents(spark, path, named_by)).select(SHEET, F.posexplode("columns").alias("position", "column")).select(
        SHEET, F.col("column.id").alias("column_id"), F.col("column.title").alias("title"), "position"
    )


def _titles_of(columns: DataFrame) -> list[str]:
    """Distinct titles in sheet order: as many as the result has columns."""
    titles = columns.groupBy("title").agg(F.min("position").alias("p"))
    return [r["title"] for r in titles.orderBy("p", "title").collect()]


def list_titles(spark: SparkSession, path: str | list[str], named_by: str = "file") -> list[str]:
    """Distinct column titles of all sheets, in sheet order."""
    return _titles_of(sheet_columns(spark, path, named_by))


def _layout(columns: Column, titles: Sequence[str]) -> Column:
    """For each title: place and id of its last column, and the ids of all its columns.

    ``columns`` are the ``(id, title)`` of a sheet in order.
    """

    def of(title: str) -> Column:
        placed = F.transform(columns, lambda c, i: F.struct(i.alias("place"), c["id"].alias("id"), c["title"].alias("title")))
        own = F.filter(placed, lambda c: c["title"] == F.lit(title))
        last = F.get(own, F.size(own) - 1)
        return F.struct(last["place"].alias("place"), last["id"].alias("id"), F.transform(own, lambda c: c["id"]).alias("ids"))

    return F.array(*[of(t) for t in titles]) if titles else F.array()


def _value(cells: Column, at: Column) -> Column:
    """Text of the cell that belongs to one entry of a layout."""
    there = F.get(cells, at["place"])
    own = F.filter(cells, lambda c: F.array_contains(at["ids"], c["columnId"]))
    return F.when(there["columnId"] == at["id"], there["value"]).when(
        at["id"].isNotNull(), F.get(own, F.size(own) - 1)["value"]
    )


def _typed_rows(rows: DataFrame, titles: Titles) -> DataFrame:
    """Rows ``sheet, _layout, place, id, createdAt, modifiedAt, cells`` as sheet rows."""
    types = titles if isinstance(titles, Mapping) else {t: T.StringType() for t in titles}
    values = [
        _value(F.col("cells"), F.get("_layout", F.lit(i))).cast(kind).alias(title)
        for i, (title, kind) in enumerate(types.items())
    ]
    return rows.select(
        SHEET,
        F.col("id").alias(ROW_ID),
        F.col("createdAt").alias(CREATED),
        F.col("modifiedAt").alias(MODIFIED),
        F.col("place").cast("long").alias(ROW_ORDER),
        *values,
    )


def read_sheets(
    spark: SparkSession, path: str | list[str], titles: Titles | None = None, named_by: str = "file"
) -> DataFrame:
    """All sheet documents below ``path`` as one DataFrame, one column per title.

    ``titles`` may be a list (text columns) or a mapping to types. Without it
    the titles come from the documents, which reads them once more. ``_row`` is
    the place of the row in its sheet. A cell without a value is null, and so is
    a title without a cell.
    """
    if titles is None:
        titles = list_titles(spark, path, named_by)
    docs = _whole(_documents(spark, path, named_by)).withColumn("_layout", _layout(F.col("columns"), list(titles)))
    rows = docs.select(SHEET, "_layout", F.posexplode("rows").alias("place", "row"))
    return _typed_rows(rows.select(SHEET, "_layout", "place", "row.*"), titles)


def land_documents(spark: SparkSession, path: str | list[str], landing: str, named_by: str = "file") -> None:
    """Split the documents below ``path`` into lines, reading each once.

    ``landing`` gets one table of rows and columns, told apart by ``kind``. Lines
    of large documents are dealt over several files, others stay where they are.
    """
    own = _LINE.names[3:]
    nothing = {c: F.lit(None).cast(_LINE[c].dataType) for c in own}

    def line(kind: str, place: Column, values: dict[str, Column]) -> Column:
        given = {**nothing, **values, "place": place.cast("long")}
        return F.struct(F.lit(kind).alias("kind"), *[given[c].alias(c) for c in own])

    columns = F.transform("columns", lambda c, i: line("columns", i, {"id": c["id"], "title": c["title"]}))
    rows = F.transform("rows", lambda r, i: line("rows", i, {n: r[n] for n in _ROW.names}))
    empty = F.array().cast(T.ArrayType(T.StructType([_LINE["kind"], *_LINE.fields[3:]])))
    both = F.concat(F.coalesce(columns, empty), F.coalesce(rows, empty))
    docs, size = _documents(spark, path, named_by), F.col("n_bytes")
    small, large = (docs.where(of).select(SHEET, PART, F.inline(both)) for of in (size <= LARGE_DOCUMENT, size > LARGE_DOCUMENT))
    small.unionByName(large.hint("rebalance")).write.parquet(landing)


def _lines(spark: SparkSession, landing: str, kind: str) -> DataFrame:
    return spark.read.schema(_LINE).parquet(landing).where(F.col("kind") == kind)


def landed_columns(spark: SparkSession, landing: str) -> DataFrame:
    """Column metadata of landed sheets: sheet, column_id, title and position; those of a sheet's parts once."""
    columns = _lines(spark, landing, "columns").select(
        SHEET, F.col("id").alias("column_id"), "title", F.col("place").cast("int").alias("position")
    )
    return columns.distinct()


def _in_sheet(rows: DataFrame) -> DataFrame:
    """Landed rows with their place in the sheet: parts give that within the part."""
    if rows.where(F.col(PART).isNotNull()).isEmpty():
        return rows
    part = F.coalesce(PART, F.lit(-1).cast("long")) + 1
    sizes = materialize(rows.groupBy(SHEET, part.alias(BLOCK)).agg(F.count(F.lit(1)).alias("_n")))
    before = materialize(rows_before(sizes, [SHEET]))
    placed = rows.withColumn(BLOCK, part).join(before, [SHEET, BLOCK])
    return placed.withColumn("place", F.col("place") + F.col("_offset")).drop(BLOCK, "_offset")


def read_landed(spark: SparkSession, landing: str, titles: Titles | None = None) -> DataFrame:
    """As ``read_sheets``, from landed lines: a sheet is read by as many tasks as its size asks for."""
    columns = landed_columns(spark, landing)
    if titles is None:
        titles = _titles_of(columns)
    entry = F.struct("position", F.col("column_id").alias("id"), "title")
    # One row a sheet, as wide as the sheet.
    sheets = columns.groupBy(SHEET).agg(F.array_sort(F.collect_list(entry)).alias("columns"))
    # Written, so that its size is known: then rows need not meet by sheet, of which one may be most of all.
    layouts = materialize(sheets.select(SHEET, _layout(F.col("columns"), list(titles)).alias("_layout")))
    rows = _in_sheet(_lines(spark, landing, "rows"))
    return _typed_rows(rows.join(layouts, SHEET, "left"), titles)


def snapshot_raw(spark: SparkSession, path: str, landing: str) -> None:
    """Keep the raw sheet documents as they came, one row per file, each with a digest of its text."""
    raw = spark.read.text(path, wholetext=True)
    kept = raw.select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("document"))
    kept.withColumn("sha256", F.sha2("document", 256)).write.mode("errorifexists").parquet(landing, compression="zstd")


def read_snapshot(spark: SparkSession, landing: str) -> DataFrame:
    """Kept documents; fails on one whose text is not what its digest was taken of."""
    kept = spark.read.schema("file string, document string, sha256 string").parquet(landing)
    same = F.sha2("document", 256) == F.col("sha256")
    broken = F.raise_error(F.concat(F.lit("document differs from its digest: "), "file")).cast("string")
    return kept.withColumn("document", F.when(same, F.col("document")).otherwise(broken))
