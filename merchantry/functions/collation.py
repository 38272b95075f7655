"""Strings compared as the source server does: without regard to case and trailing blanks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

SERVER_COLLATION = "UTF8_LCASE_RTRIM"
EXACT = "UTF8_BINARY"


def collated(df: DataFrame, collation: str | None, *columns: str) -> DataFrame:
    """``df`` with its string columns, or those named, under ``collation``; None changes nothing.

    Joins, groups, orders and comparisons of such columns follow the collation; the
    strings themselves stay as they are.
    """
    if collation is None:
        return df
    names = {f.name for f in df.schema if isinstance(f.dataType, StringType)} & set(columns or df.columns)
    return df.withColumns({c: F.collate(F.col(c), collation) for c in names})
