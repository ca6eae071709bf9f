"""Categories as a table: declared or found, numbered, and joined to what was counted.

Reports count what occurs. Titles that a report has to show although nothing
occurs come from a dimension, a table with a ``CATEGORY`` column (and ``FLEET``,
if only some pairs are wanted), which may be a file that someone keeps.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackledger.functions.rules import name
from trackledger.model import AIRFRAME_ACTIONS, OTHER, REPORTED
from trackledger.operators.blocks import number_rows
from trackledger.operators.summary import CATEGORY, category_counts, count_where, distinct_values, total_columns, totals
from trackledger.session import materialize

FLEET = "FLEET"
POSITION = "position"


def categories_of(df: DataFrame) -> DataFrame:
    """``CATEGORY, position`` of the categories that occur, and of OTHER, which comes first."""
    found = distinct_values(df.where(name(CATEGORY).isNotNull() & (name(CATEGORY) != OTHER)), CATEGORY)
    first = df.sparkSession.createDataFrame([(OTHER, 1)], f"{CATEGORY} string, {POSITION} long")
    return first.unionByName(number_rows(materialize(found), [CATEGORY], POSITION, start=1))


def pairs_of(fleets: DataFrame, categories: DataFrame, fleet: str = FLEET) -> DataFrame:
    """Every fleet with every category, which is what the report lists.

    A fleet makes one row for each number up to the count of categories, and the
    numbers meet the numbered categories: rows move once, none are compared.
    """
    numbered = materialize(number_rows(categories.select(CATEGORY).distinct(), [CATEGORY], "_slot"))
    count = numbered.agg(F.count(F.lit(1))).scalar()
    slots = fleets.select(name(fleet)).withColumn("_count", count).where(F.col("_count") > 0)
    slots = slots.select(name(fleet), F.explode(F.sequence(F.lit(1).cast("long"), F.col("_count"))).alias("_slot"))
    return slots.join(numbered, "_slot").select(name(fleet), CATEGORY)


def with_zeros(counted: DataFrame, wanted: DataFrame, by: Sequence[str], titles: Sequence[str]) -> DataFrame:
    """A row for each of ``wanted`` (columns ``by``), with zeros where nothing was counted.

    Rows that were counted for something that is not wanted stay, too.
    """
    joined = wanted.select(*[name(c) for c in by]).distinct().join(counted, list(by), "full")
    return joined.na.fill(0, subset=list(titles)).select(*[name(c) for c in counted.columns])


def titles_of(dimension: DataFrame) -> list[str]:
    """Category titles in order: a wide report has a column for each."""
    order = [POSITION, CATEGORY] if POSITION in dimension.columns else [CATEGORY]
    return [r[0] for r in dimension.select(CATEGORY, *order[:-1]).distinct().orderBy(*order).collect()]


def totals_with_categories(
    df: DataFrame,
    by: Sequence[str] = (FLEET,),
    actions: Mapping[str, str] = AIRFRAME_ACTIONS,
    statuses: Sequence[str] = REPORTED,
    categories: Sequence[str] | DataFrame | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Totals with one more column per category, from one aggregate.

    Columns need titles before anything is counted: they are given, or come from
    a dimension, or are those that occur, with OTHER first. ``long_totals`` has
    them as rows.
    """
    if categories is None:
        categories = categories_of(df)
    titles = titles_of(categories) if isinstance(categories, DataFrame) else categories
    columns = total_columns(actions, statuses, weight)
    columns += [count_where(name(CATEGORY) == c, weight).alias(c) for c in titles]
    for column in by:
        df = df.where(name(column).isNotNull())
    return df.groupBy(*[name(c) for c in by]).agg(*columns)


def pair_totals(
    df: DataFrame,
    dimension: DataFrame | None = None,
    fleet: str = FLEET,
    actions: Mapping[str, str] = AIRFRAME_ACTIONS,
    statuses: Sequence[str] = REPORTED,
    weight: str | None = None,
) -> DataFrame:
    """Totals of every fleet and category, with zeros where there are no rows.

    ``dimension`` declares the categories (with a fleet column: the pairs). Without
    it they are those that occur, each with every fleet that occurs.
    """
    counted = totals(df, [fleet, CATEGORY], actions, statuses, weight)
    if dimension is not None and fleet in dimension.columns:
        wanted = dimension
    else:
        found = df if dimension is None else dimension
        fleets = distinct_values(df.where(name(fleet).isNotNull()), fleet)
        wanted = pairs_of(fleets, found.where(name(CATEGORY).isNotNull()), fleet)
    return with_zeros(counted, wanted, [fleet, CATEGORY], [*actions, *statuses])


def long_totals(
    df: DataFrame,
    dimension: DataFrame | None = None,
    fleet: str = FLEET,
    actions: Mapping[str, str] = AIRFRAME_ACTIONS,
    statuses: Sequence[str] = REPORTED,
    weight: str | None = None,
) -> DataFrame:
    """``FLEET, kind, title, n``: the totals of a fleet as rows, for any number of categories.

    The ``dimension`` adds rows with zero for its categories that a fleet does
    not have; without it OTHER is listed for every fleet, and what occurs.
    """
    wide = totals(df, [fleet], actions, statuses, weight)
    titles = [*[("action", t) for t in actions], *[("status", t) for t in statuses]]
    entries = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(t).alias("title"), name(t).alias("n")) for k, t in titles])
    rows = wide.select(name(fleet), F.inline(entries))
    counted = category_counts(df, [fleet], weight)
    fleets = distinct_values(df.where(name(fleet).isNotNull()), fleet)
    other = fleets.withColumn(CATEGORY, F.lit(OTHER))
    if dimension is None:
        wanted = other
    elif fleet in dimension.columns:
        wanted = dimension.select(fleet, CATEGORY).unionByName(other)
    else:
        wanted = pairs_of(fleets, dimension, fleet).unionByName(other)
    counted = with_zeros(counted, wanted, [fleet, CATEGORY], ["n"])
    return rows.unionByName(counted.select(name(fleet), F.lit("category").alias("kind"), name(CATEGORY).alias("title"), "n"))
