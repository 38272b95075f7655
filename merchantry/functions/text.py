"""Text helpers: code normalisation, length and NULL-tolerant concatenation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import UNKNOWN


def code_label(code: Column, labels: Mapping[str, str], otherwise: Column | str = UNKNOWN) -> Column:
    """Label of a code, or ``otherwise`` for any other code and for NULL."""
    codes_of: dict[str, list[str]] = {}
    for value, label in labels.items():
        codes_of.setdefault(label, []).append(value)
    result = None
    for label, values in codes_of.items():
        matches = code.isin(values) if len(values) > 1 else code == values[0]
        result = F.when(matches, label) if result is None else result.when(matches, label)
    return result.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def text_length(text: Column) -> Column:
    """Length without trailing spaces."""
    return F.length(F.rtrim(text))


def concat_text(*parts: Column) -> Column:
    """Concatenation in which a NULL part counts as empty text."""
    return F.concat(*[F.coalesce(part, F.lit("")) for part in parts])
