"""Scalar expressions shared by the cleaning steps and the reports."""

from .collation import EXACT, SERVER_COLLATION, collated
from .dates import decode_yyyymmdd, is_undecodable, years_between
from .numeric import growth_percentage, int_avg, int_div, truncated_ratio
from .text import code_label, concat_text, text_length

__all__ = [
    "EXACT",
    "SERVER_COLLATION",
    "code_label",
    "collated",
    "concat_text",
    "decode_yyyymmdd",
    "growth_percentage",
    "int_avg",
    "int_div",
    "is_undecodable",
    "text_length",
    "truncated_ratio",
    "years_between",
]
