"""Small SQL text helpers for the DuckDB oracle strings (kept next to the
Spark queries so both sides spell the same rule)."""

from __future__ import annotations

from noema.functions.text import PY_WHITESPACE, WIKI_PREFIX

# DuckDB expression for the Python whitespace set, built from code points.
WS = " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE)


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def lower_strip(x: str) -> str:
    return strip(f"lower({x})")


def title_from_url(x: str) -> str:
    return f"string_split(regexp_replace(regexp_replace({x}, '[?#].*$', ''), '/+$', ''), '/')[-1]"


def quote(x: str, safe: str) -> str:
    """DuckDB ``url_encode`` equals Python ``quote(s, safe='')``; un-escape ``safe``."""
    e = f"url_encode({x})"
    for ch in safe:
        if ch.isalnum() or ch in "_.-~":
            continue
        lit = ch.replace("'", "''")
        e = f"replace({e}, '%{ord(ch):02X}', '{lit}')"
    return e


def name_link(x: str) -> str:
    s = strip(x)
    return (f"CASE WHEN {x} IS NULL OR {s} = '' THEN NULL ELSE "
            f"'{WIKI_PREFIX}' || {quote(f'replace({s}, chr(32), chr(95))', "()'_-")} END")


def path_quote(x: str) -> str:
    return quote(f"replace({x}, ' ', '_')", "()_-.,:")
