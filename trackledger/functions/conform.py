"""Column-type conformance: picklist, dates and text, with rejected cells."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackledger.functions.rules import name
from trackledger.model import PICKLIST, ROW_ID, SHEET, user_columns

ISO_DATE = "yyyy-MM-dd"


@dataclass(frozen=True)
class Picklist:
    options: Sequence[str]


@dataclass(frozen=True)
class Date:
    format: str = ISO_DATE


@dataclass(frozen=True)
class Text:
    pass


SHEET_TYPES: dict[str, Picklist | Date | Text] = {
    "Status": Picklist(PICKLIST),
    "Created Date": Date(),
    "Modified Date": Date(),
}


def _typed(column: str, data_type: T.DataType, rule: Picklist | Date | Text) -> tuple[Column, Column | None]:
    """Converted column, and the reason why a cell cannot be taken (or None)."""
    value = name(column)
    text = value.cast("string")
    if isinstance(rule, Picklist):
        bad = value.isNotNull() & ~text.isin(*rule.options)
        return text, F.when(bad, F.lit("not in picklist"))
    if isinstance(rule, Date):
        if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return value.cast("date"), None
        if rule.format == ISO_DATE:
            # Much cheaper on bad cells than the format parser.
            parsed = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))
        else:
            parsed = F.try_to_date(text, rule.format)
        return parsed, F.when(value.isNotNull() & parsed.isNull(), F.lit("not a date"))
    return text, None


def conform(
    df: DataFrame, spec: Mapping[str, Picklist | Date | Text] = SHEET_TYPES
) -> tuple[DataFrame, DataFrame]:
    """Give every user column its sheet type; a column without a rule is text.

    Returns the rows in which every cell fits, and one row per cell that does
    not: sheet, row id, column, value and reason. Neither needs a shuffle.
    ``conform_all`` returns the other rows as well.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    users = set(user_columns(df))
    columns, cells, fits = [], [], F.lit(True)
    for c in df.columns:
        if c not in users:
            columns.append(name(c))
            continue
        typed, reason = _typed(c, types[c], spec.get(c, Text()))
        columns.append(typed.alias(c))
        if reason is not None:
            fits = fits & reason.isNull()
            cells.append(
                F.struct(
                    F.lit(c).alias("column"), name(c).cast("string").alias("value"), reason.alias("reason")
                )
            )
    clean = df.where(fits).select(*columns)
    at = [c for c in (SHEET, ROW_ID) if c in df.columns]
    if not cells:
        none = F.array().cast("array<struct<column:string,value:string,reason:string>>")
        return clean, df.select(*at, F.inline(none))
    rejects = df.where(~fits).select(*at, F.inline(F.array(*cells))).where(F.col("reason").isNotNull())
    return clean, rejects


REJECTED = "_rejected"


def conform_all(df: DataFrame, spec: Mapping[str, Picklist | Date | Text] = SHEET_TYPES) -> DataFrame:
    """Every row in sheet types; ``_rejected`` tells whether a cell did not fit.

    A text that is not in its picklist stays as it is, a text that is not a
    date becomes null; ``conform`` lists both.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    users = set(user_columns(df))
    columns, fits = [], F.lit(True)
    for c in df.columns:
        typed, reason = _typed(c, types[c], spec.get(c, Text())) if c in users else (name(c), None)
        columns.append(typed.alias(c))
        if reason is not None:
            fits = fits & reason.isNull()
    return df.select(*columns, (~fits).alias(REJECTED))
