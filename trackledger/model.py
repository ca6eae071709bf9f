"""Names, value sets and schemas of the tracker data model.

All sheets live in one DataFrame with a ``sheet`` column. Columns whose name
starts with ``_`` are system columns; every other column except ``sheet`` is a
user column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

SHEET = "sheet"
ROW_ID = "_id"
ROW_ORDER = "_row"
CREATED = "_created"
MODIFIED = "_modified"
OP = "op"

# Business keys.
AIRFRAME_KEY = ["AC", "FLEET", "PN", "MAIN_PN", "VENDOR"]
ENGINE_KEY = ["AC", "FLEET", "PN", "NHA", "TOP", "LEVEL"]

# Proposed actions.
ADD = "ADD_EFFECTIVITY"
VALIDATE = "VALIDATE_EFFECTIVITY"
UPDATE = "UPDATE_EFFECTIVITY"
NO_ACTION = "NO_ACTION"

# Report column title per action.
AIRFRAME_ACTIONS = {"Add Effectivity": ADD, "Validate Effectivity": VALIDATE}
ENGINE_ACTIONS = {"Update Effectivity": UPDATE}

# Status sets.
PICKLIST = ["Initial", "Assigned", "In-Work", "Issue", "Updated", "Re-Opened", "Validated", "Complete"]
CLOSABLE = ["Initial", "Assigned", "In-Work", "Issue", "Updated", "Re-Opened"]
REPORTED = ["Initial", "In-Work", "Issue", "Updated", "Re-Opened", "Validated", "Complete"]
NOT_OPEN = ["Validated", "Complete"]

# Categories that reports count as OTHER.
FOLDED_CATEGORIES = ["KIT", "GEN-CON", "SOFTWARE"]
OTHER = "OTHER"

# Columns a packed extract must have.
PACK_REQUIRED = ["Status", "Created Date", "Modified Date", "CATEGORY", "PN", "MAIN_PN", "AC", "FLEET"]
PACK_SORT = ["CATEGORY", "PN", "MAIN_PN", "AC"]
SHEET_ROW_CAP = 19_500

# Nested form of one exported sheet document.
SHEET_JSON = T.StructType(
    [
        T.StructField(
            "columns",
            T.ArrayType(
                T.StructType([T.StructField("id", T.LongType()), T.StructField("title", T.StringType())])
            ),
        ),
        T.StructField(
            "rows",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", T.LongType()),
                        T.StructField("createdAt", T.TimestampType()),
                        T.StructField("modifiedAt", T.TimestampType()),
                        T.StructField(
                            "cells",
                            T.ArrayType(
                                T.StructType(
                                    [
                                        T.StructField("columnId", T.LongType()),
                                        T.StructField("value", T.StringType()),
                                    ]
                                )
                            ),
                        ),
                    ]
                )
            ),
        ),
    ]
)

REGISTRY = T.StructType(
    [
        T.StructField("sheet", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("target_id", T.StringType()),
        T.StructField("src", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
    ]
)


def user_columns(df: DataFrame) -> list[str]:
    """Titles of the sheet itself, without system columns and the sheet name."""
    return [c for c in df.columns if not c.startswith("_") and c != SHEET]


def system_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("_")]
