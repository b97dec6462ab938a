"""Column-expression helpers shared by every operator."""

from .text import (WHITESPACE, NUMBER_PATTERN, strip, upper_strip, null_if_token,
                   is_empty_cell, text_to_double, num, to_int, num_col, int_col, as_text)
from .money import safe_div, to_usd
from .dates import parse_date, local_date_text, local_stamp_text, iso_text

__all__ = [
    "WHITESPACE", "NUMBER_PATTERN", "strip", "upper_strip", "null_if_token",
    "is_empty_cell", "text_to_double", "num", "to_int", "num_col", "int_col", "as_text",
    "safe_div", "to_usd", "parse_date", "local_date_text", "local_stamp_text", "iso_text",
]
