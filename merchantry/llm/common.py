"""What several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word: a run of characters that are neither blanks nor ASCII control spaces.
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Words of a text in order; NULL counts as empty."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def spare(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def values(df: DataFrame, names: str, rows: list[tuple]) -> DataFrame:
    """A small table of whole numbers as literals; ``names`` like ``a, b``."""
    spark = df.sparkSession
    if not rows:
        columns = ", ".join(f"CAST(NULL AS BIGINT) AS {n.strip()}" for n in names.split(","))
        return spark.sql(f"SELECT {columns} WHERE false")
    text = ", ".join("(" + ", ".join(f"{v}L" for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {text} AS t({names})")
