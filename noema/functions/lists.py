"""List-valued column expressions.

F1 parse_to_list, F2 literal-or-empty, F3 alias split, F4 list-like,
F6 ranked-prerequisite explode, F11 categories, F14 concept-list cleanup,
F15 alias cleanup, F16 candidate list, F17 remove own name, F18 append new,
F19 fill-if-empty, F26 quoted rendering, F28 category merge.

Python list literals are read by ``from_json`` when the text is a plain list
of quoted strings without backslashes (the common case, JVM-side); any other
bracketed text goes through ``ast.literal_eval`` in an Arrow-batched
``pandas_udf`` that receives null for every row the fast path already handled.
"""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from noema.functions._col import col_of
from noema.functions.text import strip

STR_ARRAY = T.ArrayType(T.StringType())
_JSON_OPTS = {"allowSingleQuotes": "true"}

# A bracketed list of quoted strings with no backslash inside any string:
# both Python and Jackson read such text identically.
_SIMPLE_LIST_RE = (
    r"^\[\s*(?:(?:'[^'\\\n]*'|\"[^\"\\\n]*\")\s*"
    r"(?:,\s*(?:'[^'\\\n]*'|\"[^\"\\\n]*\")\s*)*)?\]$"
)


def empty_str_array() -> Column:
    return F.array().cast(STR_ARRAY)


def _literal_list(text: str | None, allow_tuple: bool):
    if text is None:
        return None
    try:
        v = ast.literal_eval(text)
    except Exception:
        return None
    if isinstance(v, list) or (allow_tuple and isinstance(v, tuple)):
        return [None if x is None else (x if isinstance(x, str) else str(x)) for x in v]
    return None


@F.pandas_udf(STR_ARRAY)
def _py_list_literal(s: pd.Series) -> pd.Series:
    return s.map(lambda t: _literal_list(t, allow_tuple=False))


@F.pandas_udf(STR_ARRAY)
def _py_listlike_literal(s: pd.Series) -> pd.Series:
    return s.map(lambda t: _literal_list(t, allow_tuple=True))


def _fast_list(v: Column) -> Column:
    """from_json result for simple literals, null otherwise."""
    return F.when(v.rlike(_SIMPLE_LIST_RE), F.from_json(v, STR_ARRAY, _JSON_OPTS))


def parse_to_list(c) -> Column:
    """null or ``''`` → []; ``[...]`` literal → list; else split on ``,`` and strip."""
    raw = col_of(c)
    v = strip(raw)
    bracketed = v.startswith("[") & v.endswith("]")
    fast = _fast_list(v)
    slow = _py_list_literal(F.when(bracketed & fast.isNull(), v))
    split_items = F.transform(F.split(v, ","), strip)
    return (F.when(raw.isNull() | (raw == ""), empty_str_array())
            .when(bracketed, F.coalesce(fast, slow, split_items))
            .otherwise(split_items))


def literal_or_empty(c) -> Column:
    """Python list literal → list, anything else (or failure) → []."""
    raw = col_of(c)
    fast = _fast_list(raw)
    slow = _py_list_literal(F.when(raw.isNotNull() & fast.isNull(), raw))
    return F.coalesce(fast, slow, empty_str_array())


def split_alias(c) -> Column:
    """split on ``", "``; null → []."""
    return F.coalesce(F.split(col_of(c), ", "), empty_str_array())


def listlike(c) -> Column:
    """null/blank → []; ``[...]``/``(...)`` literal → list of strings; else ``[stripped]``."""
    raw = col_of(c)
    s = strip(raw)
    bracketed = (s.startswith("[") & s.endswith("]")) | (s.startswith("(") & s.endswith(")"))
    fast = _fast_list(s)
    slow = _py_listlike_literal(F.when(bracketed & fast.isNull(), s))
    return (F.when(raw.isNull() | (s == ""), empty_str_array())
            .otherwise(F.coalesce(fast, slow, F.array(s))))


RANKED_PREREQ = T.ArrayType(T.StructType([
    T.StructField("rank", T.LongType()),
    T.StructField("topic", T.StringType()),
    T.StructField("rationale", T.StringType()),
]))


def ranked_items(c) -> Column:
    """F6 input: ``[{rank, topic, rationale}, ...]`` JSON → array of structs with
    the defaults 0 / ``""`` / ``""`` for absent (or null) keys."""
    arr = F.from_json(col_of(c), RANKED_PREREQ)
    return F.transform(arr, lambda x: F.struct(
        F.coalesce(x["rank"], F.lit(0)).alias("rank"),
        F.coalesce(x["topic"], F.lit("")).alias("topic"),
        F.coalesce(x["rationale"], F.lit("")).alias("rationale")))


def categories_of(fields, s2_fields) -> Column:
    """ordered distinct of string ``fieldsOfStudy`` then ``s2FieldsOfStudy[].category``."""
    a = F.filter(F.coalesce(col_of(fields), empty_str_array()), lambda x: x.isNotNull())
    b = F.filter(F.transform(F.coalesce(col_of(s2_fields), F.array()), lambda x: x["category"]),
                 lambda x: x.isNotNull())
    return F.array_distinct(F.concat(a, b))


def clean_concepts(c, max_len: int | None = None) -> Column:
    """strip, drop empty, ordered distinct; with ``max_len`` also without those of more
    code points, which ``long_concepts`` returns."""
    xs = F.transform(F.coalesce(col_of(c), empty_str_array()), strip)
    xs = F.array_distinct(F.filter(xs, lambda s: s.isNotNull() & (s != "")))
    return xs if max_len is None else F.filter(xs, lambda s: F.length(s) <= max_len)


def long_concepts(c, max_len: int) -> Column:
    """The concepts that ``clean_concepts`` leaves out for their length."""
    return F.filter(clean_concepts(c), lambda s: F.length(s) > max_len)


def clean_aliases(c, name) -> Column:
    """strip, drop empty, ordered distinct, minus the canonical name (exact case)."""
    xs = F.transform(F.coalesce(col_of(c), empty_str_array()), strip)
    kept = F.filter(xs, lambda s: s.isNotNull() & (s != ""))
    return F.array_except(kept, F.array(col_of(name)))


def candidates(name, alias) -> Column:
    """F16: ordered distinct of ``[name] + alias``, stripped, null → ``""`` dropped."""
    xs = F.concat(F.array(col_of(name)), F.coalesce(col_of(alias), empty_str_array()))
    xs = F.transform(xs, lambda x: strip(F.coalesce(x, F.lit(""))))
    return F.array_distinct(F.filter(xs, lambda x: x != ""))


def remove_name(alias, name) -> Column:
    """drop every element equal to the name."""
    return F.array_remove(col_of(alias), col_of(name))


def append_new(current, new) -> Column:
    """``cur + [a in new where a not in cur]`` (duplicates inside ``new`` kept)."""
    cur = F.coalesce(col_of(current), empty_str_array())
    return F.concat(cur, F.filter(F.coalesce(col_of(new), empty_str_array()),
                                  lambda a: ~F.array_contains(cur, a)))


def fill_if_empty(current, new) -> Column:
    """keep ``current`` unless it is null or ``''``."""
    cur = col_of(current)
    return F.when(cur.isNull() | (cur == ""), col_of(new)).otherwise(cur)


def quoted_list(c, n: int | None = None) -> Column:
    """``"a", "b"`` rendering of all elements, or of the first ``n``."""
    xs = col_of(c) if n is None else F.slice(col_of(c), 1, n)
    return F.array_join(F.transform(xs,
                                    lambda x: F.concat(F.lit('"'), x, F.lit('"'))), ", ")


def merge_categories(existing, new) -> Column:
    """F28 (order made deterministic): union of the parsed existing value and ``new``, sorted."""
    return F.array_sort(F.array_union(parse_to_list(existing), F.coalesce(col_of(new), empty_str_array())))
