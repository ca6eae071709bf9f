"""Hash of a business key, to sort and join by one number before the key itself."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackledger.functions.rules import name
from trackledger.model import SHEET


def key_hash(keys: Sequence[str]) -> str:
    """Name of the hash column of these keys; other keys have another one."""
    return f"_key_hash_{zlib.crc32(chr(0).join(keys).encode()):08x}"


def with_key_hash(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the hash of ``(sheet, *keys)`` unless it is there.

    Key parts are hashed as text, so both sides of a join agree where one holds
    numbers and the other their digits.

    Key parts often share their first characters, and sheets are few, so
    sorting by the parts compares whole rows most of the time. Sorting by the
    hash first compares numbers. The key parts still decide what is equal.
    """
    if key_hash(keys) in df.columns:
        return df
    return df.withColumn(key_hash(keys), F.xxhash64(SHEET, *[name(k).cast("string") for k in keys]))
