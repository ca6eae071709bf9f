"""Publish sheets, export files and count what is there."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackledger.functions.rules import name
from trackledger.model import SHEET
from trackledger.operators.blocks import BLOCK, rows_before
from trackledger.session import materialize
from trackledger.sinks import versions
from trackledger.sinks.folders import can_write, local_path, write_folders
from trackledger.sinks.versions import SHEET_ID
from trackledger.sources import text
from trackledger.sources.ledger import file_ledger, folder_rows

ID = "id"
LISTING = 4
_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def export_by(
    df: DataFrame,
    cols: Sequence[str],
    path: str,
    format: str = "parquet",
    sort: Sequence[str] = (),
    mode: str = "errorifexists",
    partitions: int | None = None,
    many: bool = False,
) -> None:
    """One folder per value of ``cols``; a null value has a folder of its own.

    The files keep all columns; the folders are named after copies of ``cols``
    that begin with ``by_``. Rows are rebalanced by ``cols``: small values
    share a task, and a value with very many rows is written by several tasks
    as several files.

    With ``sort`` the rows are cut into even ranges of folder and ``sort``, nulls
    last, and every range is sorted: a folder's files follow each other in the
    order of the numbers in their names (``in_order`` says each row's place), and a large folder is
    cut where its rows are. Equal rows may be many; the task that read them
    decides between them, so that they need not share one range.

    ``many`` small folders of a sorted Parquet export are written by
    ``sinks/folders.py`` where the file system is a local or mounted one.
    """
    folders = [f"by_{c}" for c in cols]
    at = None
    if many and cols and sort and format == "parquet" and mode == "errorifexists" and can_write(df.schema):
        at = local_path(df.sparkSession, path)
    rows = df.withColumns({f: name(c) for f, c in zip(folders, cols)})
    if at:
        rows = rows.withColumns({f: F.nullif(name(f).cast("string"), F.lit("")) for f in folders})
    if sort:
        order = [*[name(f).asc_nulls_first() for f in folders], *[name(c).asc_nulls_last() for c in sort]]
        tied = rows.withColumn("_tie", F.spark_partition_id())
        by = [*order, F.col("_tie")]
        ranged = tied.repartitionByRange(partitions, *by) if partitions else tied.repartitionByRange(*by)
        rows = ranged.sortWithinPartitions(*by).drop("_tie")
    else:
        rows = rows.hint("rebalance", *[name(f) for f in folders])
    if at:
        return write_folders(rows, folders, at)
    writer = rows.write.mode(mode).partitionBy(*folders)
    if format == "csv":
        writer = writer.options(**text.WRITE)
    writer.format(format).save(path)


def in_order(spark: SparkSession, path: str, schema: T.StructType, by: Sequence[str] = ()) -> DataFrame:
    """Rows of a sorted Parquet export with ``place``, 1, 2, ... in the order of its files.

    With ``by``, the columns that the export has folders of, places count within
    a folder. Only the files' sizes are added up; rows get their place by a join
    with as many rows as there are files.
    """
    rows = spark.read.schema(schema).parquet(path)
    number = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("long")
    folder = F.to_json(F.struct(*[name(c) for c in by])) if by else F.lit("")
    rows = rows.select(
        *[name(c) for c in schema.names], folder.alias("_folder"), number.alias(BLOCK), F.col("_metadata.row_index").alias("_pos")
    )
    sizes = materialize(rows.groupBy("_folder", BLOCK).agg(F.count(F.lit(1)).alias("_n")))
    before = materialize(rows_before(sizes, ["_folder"]))
    place = (F.col("_offset") + F.col("_pos") + 1).alias("place")
    return rows.join(before, ["_folder", BLOCK]).select(*[name(c) for c in schema.names], place)


def export_sheets(df: DataFrame, path: str, format: str = "parquet") -> None:
    """One folder per sheet."""
    export_by(df, [SHEET], path, format)


def split_by_ac(df: DataFrame, path: str, base: str = "base", ac: str = "AC", format: str = "parquet") -> None:
    """One folder per base name and aircraft; rows without an aircraft have theirs."""
    export_by(df, [base, ac], path, format)


def read_export(spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet") -> DataFrame:
    """Read an export back, without the folder columns.

    These are not looked for in the paths, for which Spark takes time that grows
    with the square of the number of folders. The folders are listed by ``LISTING`` tasks for each core: by default every
    folder has a task of its own, which takes longer to start than to list it.
    """
    reader = spark.read.schema(schema).format(format).option("recursiveFileLookup", True)
    if format == "csv":
        reader = reader.options(**text.read_options(text.has_broken_lines(spark, path)))
    before = spark.conf.get(_LISTING_TASKS)
    spark.conf.set(_LISTING_TASKS, str(LISTING * spark.sparkContext.defaultParallelism))
    try:
        return reader.load(path).select(*[name(c) for c in schema.names])
    finally:
        spark.conf.set(_LISTING_TASKS, before)


def new_sheet_id(sheet: str = SHEET) -> Column:
    """Id of a sheet that has none yet, made from its name."""
    return F.concat(F.lit("S"), F.substring(F.sha2(name(sheet), 256), 1, 16))


def assign_ids(registry: DataFrame) -> DataFrame:
    """Registry in which every sheet has an id."""
    has_id = F.col(ID).isNotNull() & (F.col(ID) != "")
    return registry.withColumn(ID, F.when(has_id, F.col(ID)).otherwise(new_sheet_id()))


def require_one_entry(registry: DataFrame, *columns: str | Column) -> None:
    """Raise when the registry names a sheet, an id or a target more than once."""
    named = registry.select(*columns)
    entry = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in named.columns])
    values = named.select(F.inline(entry)).where("value IS NOT NULL AND value <> ''")
    found = values.groupBy("column", "value").agg(F.count("*").alias("n")).where("n > 1").take(3)
    if found:
        raise ValueError(f"registry repeats {found[0]['column']}: {[row['value'] for row in found]}")


@dataclass(frozen=True)
class Published:
    """What a publish did.

    ``registry`` is the one to keep. ``account`` has rows ``sheet, sheet_id,
    fate, reason, n_rows``: input rows are ``published`` (under the sheet's own
    id), ``moved`` (under its target's) or ``left_out``; rows that were there
    before and are no more are ``cleared``. ``left_out`` are the input rows that
    went nowhere.
    """

    registry: DataFrame
    account: DataFrame
    left_out: DataFrame


def publish_version(
    df: DataFrame,
    registry: DataFrame,
    root: str,
    run_date: dt.date | str | None = None,
    to_target: bool = False,
    covers: DataFrame | None = None,
) -> Published:
    """Create or replace sheets in the versioned table below ``root``.

    Each sheet's rows go under its id, or with ``to_target`` under its target's,
    whose rows they replace; the sheet's own rows then go, and the target goes
    by the sheet's name. The input is read once: rows without a place are
    written beside the others, and everything else is counted from what was
    written. The new version counts all at once, by the last step.

    Sheets with rows in ``df`` are set, and those that ``covers`` (column
    ``sheet``) names, too, when they have none: these become empty. All others
    stay as they are. Only sheets that were set get a new date. A registry that
    names a sheet, an id or a target twice is refused, also if it would do so
    after the move.
    """
    spark = df.sparkSession
    entries = materialize(registry if to_target else assign_ids(registry))
    place = F.col("target_id") if to_target else F.col(ID)
    require_one_entry(entries, SHEET, place.alias(SHEET_ID))
    places = entries.where(place.isNotNull() & (place != "")).select(SHEET, ID, place.alias(SHEET_ID))

    before, version = versions.live_and_next(spark, root)
    versions.add_rows(df.join(places.select(SHEET, SHEET_ID), SHEET, "left").select(*df.columns, SHEET_ID), root, version)
    written = versions.version_rows(spark, root, version, df.schema)
    counts = materialize(written.groupBy(SHEET, SHEET_ID).agg(F.count(F.lit(1)).alias(versions.ROWS)))
    placed = counts.where(F.col(SHEET_ID).isNotNull())
    named = placed.select(SHEET) if covers is None else placed.select(SHEET).unionByName(covers.select(SHEET))
    # One row a sheet that was set, with the number of its rows, 0 if it is empty now.
    done = places.join(named.distinct(), SHEET, "left_semi").join(placed.select(SHEET, versions.ROWS), SHEET, "left")
    done = materialize(done.na.fill(0, subset=[versions.ROWS]))

    moved_id = F.col(SHEET_ID) if to_target else F.col(ID)
    set_now = done.select(SHEET, moved_id.alias("_id_now"), F.lit(True).alias("_written"))
    now = dt.datetime.now(dt.timezone.utc).isoformat(timespec="seconds") if run_date is None else str(run_date)
    kept = (
        entries.join(set_now, SHEET, "left")
        .withColumn("date", F.when(F.col("_written"), F.lit(now)).otherwise(F.col("date")))
        .withColumn(ID, F.coalesce("_id_now", ID))
        .select(*registry.columns)
    )
    if to_target:  # a sheet may have got the id of another one
        require_one_entry(kept, ID)

    gone = done.select(SHEET_ID).unionByName(done.select(F.col(ID).alias(SHEET_ID))) if to_target else done.select(SHEET_ID)
    gone = gone.where(F.col(SHEET_ID).isNotNull()).distinct()
    new = done.select(SHEET_ID, F.lit(version).alias(versions.VERSION), versions.ROWS)
    state = before.join(gone, SHEET_ID, "left_anti").unionByName(new)

    def fates(rows: DataFrame, fate: str, reason: Column) -> DataFrame:
        return rows.select(SHEET, SHEET_ID, F.lit(fate).alias("fate"), reason.alias("reason"), versions.ROWS)

    none = F.lit(None).cast("string")
    known = entries.select(SHEET, F.lit("no target").alias("_why"))
    left = counts.where(F.col(SHEET_ID).isNull()).join(known, SHEET, "left")
    # Rows that go were those of the sheet that had this id, else of the target's new one.
    owners = done.where(F.col(ID).isNotNull()).select(SHEET, F.col(ID).alias(SHEET_ID))
    names = owners.unionByName(done.select(SHEET, SHEET_ID).join(owners.select(SHEET_ID), SHEET_ID, "left_anti"))
    cleared = before.join(gone, SHEET_ID, "left_semi").join(names, SHEET_ID, "left")
    account = fates(done, "moved" if to_target else "published", none)
    account = account.unionByName(fates(left, "left_out", F.coalesce("_why", F.lit("not in the registry"))))
    account = account.unionByName(fates(cleared, "cleared", none)).where(F.col(versions.ROWS) > 0)

    versions.commit(state, root, version)
    return Published(kept, account, written.where(F.col(SHEET_ID).isNull()).drop(SHEET_ID))


def publish(df: DataFrame, registry: DataFrame, root: str, run_date: dt.date | str | None = None) -> DataFrame:
    """Create or replace the sheets of ``df``; the registry with ids and dates filled in."""
    return publish_version(df, registry, root, run_date).registry


def publish_to_target(
    df: DataFrame, registry: DataFrame, root: str, run_date: dt.date | str | None = None
) -> DataFrame:
    """Replace the target sheet of each sheet of ``df``, which then goes by the new name."""
    return publish_version(df, registry, root, run_date, to_target=True).registry


def with_source(registry: DataFrame) -> DataFrame:
    """Sheets whose entry names a source: a job that sets them empties those without rows."""
    return registry.where(F.col("src").isNotNull() & (F.col("src") != "")).select(SHEET)


def unregistered_rows(df: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows of sheets the registry does not name; publishing leaves them out."""
    return df.join(registry.select(SHEET), SHEET, "left_anti")


def read_published(
    spark: SparkSession, root: str, schema: T.StructType, registry: DataFrame | None = None
) -> DataFrame:
    """Published rows with the sheet id; ``schema`` is that of the rows.

    With the registry only the sheets that it names are read.
    """
    rows = versions.live_rows(spark, root, schema)
    if registry is None:
        return rows
    return rows.join(registry.select(F.col(ID).alias(SHEET_ID)).distinct(), SHEET_ID, "left_semi").select(*rows.columns)


def rows_per_group(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*[name(c) for c in cols]).agg(F.count(F.lit(1)).alias("n"))


def folder_counts(
    spark: SparkSession, root: str, kinds: Sequence[str] = ("Category", "AC"), format: str = "parquet"
) -> DataFrame:
    """Rows per fleet folder and kind, over all files of ``root/<fleet>/<kind>``; empty files count as 0."""
    where = f"{root.rstrip('/')}/*/{{{','.join(kinds)}}}"
    return folder_rows(file_ledger(spark, where, format), kinds)
