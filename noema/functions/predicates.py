"""Row predicates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from noema.functions._col import col_of
from noema.functions.text import strip


def is_empty_str(c) -> Column:
    """P10: null or blank string."""
    x = col_of(c)
    return x.isNull() | (strip(x) == "")


def is_empty_arr(c) -> Column:
    """P10: null or empty list."""
    x = col_of(c)
    return x.isNull() | (F.size(x) == 0)


def needs_lookup(name, link, categories) -> Column:
    """P10 mask: name present and (categories empty or link empty)."""
    return col_of(name).isNotNull() & (is_empty_arr(categories) | is_empty_str(link))


def not_self_loop(name, prereq) -> Column:
    """``name != prereq`` where a null prerequisite row is kept (pandas semantics)."""
    return col_of(prereq).isNull() | col_of(name).isNull() | (col_of(name) != col_of(prereq))


def non_blank(c) -> Column:
    """Trimmed string is not empty (null is dropped)."""
    return strip(col_of(c)) != ""


def truthy_items(c) -> Column:
    """Drop null and empty entries of a list."""
    return F.filter(col_of(c), lambda a: a.isNotNull() & (a != ""))
