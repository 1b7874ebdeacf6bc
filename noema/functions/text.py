"""String column expressions (all JVM-side, codegen friendly).

F7 strip / lower-strip, F8 norm, F9 link encoders, F10 title from URL,
F13 reason cleanup, F21 category text, F22 one-line description,
F27 page-title comparison, F29 truncation.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from noema.functions._col import col_of

# The characters Python's ``str.strip()`` / ``str.split()`` treat
# as whitespace (str.isspace), in code-point order.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a regex character class body (Java and RE2 syntax).
PY_WHITESPACE_CLASS = (
    r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)

# Fixed value: the encyclopedia article prefix used by every link builder.
WIKI_PREFIX = "https://en.wikipedia.org/wiki/"

# The extra "safe" sets of the three link encoders.
SAFE_NAME_LINK = "()'_-"        # F9(a) node link from a concept name
SAFE_PATH_FRAGMENT = "()_-.,:"  # F9(b) article path and #fragment
SAFE_NONE = ""                  # F9(c) category-page link

# Characters percent-encoding always leaves alone (RFC 3986 unreserved).
_ALWAYS_SAFE = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-~")


def strip(c) -> Column:
    """Python ``str.strip()`` (Unicode whitespace), not Spark's space-only trim."""
    return F.btrim(col_of(c), F.lit(PY_WHITESPACE))


def lower_strip(c) -> Column:
    """``s.lower().strip()``."""
    return strip(F.lower(col_of(c)))


def collapse_ws(c) -> Column:
    """Whitespace runs → one space (Python ``" ".join(s.split())`` without the strip)."""
    return F.regexp_replace(col_of(c), f"[{PY_WHITESPACE_CLASS}]+", " ")


def norm(c) -> Column:
    """F8: strip, lower, collapse whitespace runs."""
    return strip(collapse_ws(F.lower(col_of(c))))


def url_quote(c, safe: str = "") -> Column:
    """Percent-encode UTF-8 like Python ``urllib.parse.quote(s, safe)``.

    ``url_encode`` is Java's form encoder: it writes a space as ``+``, keeps
    ``*`` and escapes ``~``.  Those three are corrected, then every character of
    ``safe`` is un-escaped.  A literal ``%`` is written as ``%25``, so no escape
    sequence can be produced by accident.
    """
    e = F.url_encode(col_of(c))
    e = F.replace(e, F.lit("+"), F.lit("%20"))
    e = F.replace(e, F.lit("*"), F.lit("%2A"))
    e = F.replace(e, F.lit("%7E"), F.lit("~"))
    for ch in safe:
        if ch in _ALWAYS_SAFE:
            continue
        e = F.replace(e, F.lit("%" + format(ord(ch), "02X")), F.lit(ch))
    return e


def name_link(c) -> Column:
    """F9(a): link for a concept name; null/blank → null."""
    s = strip(col_of(c))
    return F.when(s.isNull() | (s == ""), F.lit(None).cast("string")).otherwise(
        F.concat(F.lit(WIKI_PREFIX), url_quote(F.replace(s, F.lit(" "), F.lit("_")), SAFE_NAME_LINK)))


def path_quote(c) -> Column:
    """F9(b): path / fragment encoder (space → ``_``)."""
    return url_quote(F.replace(col_of(c).cast("string"), F.lit(" "), F.lit("_")), SAFE_PATH_FRAGMENT)


def article_link(title, fragment=None) -> Column:
    """F9(b): ``prefix + path(title)`` plus ``#frag(fragment)`` when a fragment is given."""
    base = F.concat(F.lit(WIKI_PREFIX), path_quote(title))
    if fragment is None:
        return base
    return F.when(col_of(fragment).isNull(), base).otherwise(
        F.concat(base, F.lit("#"), path_quote(fragment)))


def page_link(c) -> Column:
    """F9(c): category-page link, nothing extra kept."""
    return F.concat(F.lit(WIKI_PREFIX), url_quote(F.replace(col_of(c), F.lit(" "), F.lit("_")), SAFE_NONE))


def title_from_url(c) -> Column:
    """drop ``?query`` / ``#anchor``, strip trailing ``/``, take the last path segment."""
    u = F.regexp_replace(col_of(c), r"[?#].*$", "")
    u = F.regexp_replace(u, r"/+$", "")
    return F.element_at(F.split(u, "/"), -1)


def reason_clean(c) -> Column:
    """strip; blank → null."""
    return F.nullif(strip(col_of(c)), F.lit(""))


def categories_text(c) -> Column:
    """category list → ``"; "``-joined text of stripped, non-blank entries."""
    return F.array_join(F.filter(F.transform(col_of(c), strip), lambda x: x != ""), "; ")


def categories_text_from_string(c) -> Column:
    """F21, string branch: strip, drop outer brackets, remove all quotes."""
    s = F.regexp_replace(strip(col_of(c)), r"^\[|\]$", "")
    return F.translate(s, "'\"", "")


def one_line(c) -> Column:
    """collapse whitespace; append ``.`` unless it ends in ``. ? !``; blank → ``""``."""
    t = strip(collapse_ws(F.coalesce(col_of(c), F.lit(""))))
    return F.when((t != "") & ~t.rlike(r"[.?!]$"), F.concat(t, F.lit("."))).otherwise(t)


def page_key(c) -> Column:
    """``s.replace('_', ' ').lower()`` for page-title comparison."""
    return F.lower(F.replace(col_of(c), F.lit("_"), F.lit(" ")))


def strip_category_prefix(c) -> Column:
    """remove the ``Category:`` prefix."""
    return F.replace(col_of(c), F.lit("Category:"), F.lit(""))


def truncate(c, n: int) -> Column:
    """first ``n`` characters."""
    return F.substring(col_of(c), 1, n)


def has_replacement_char(c) -> Column:
    """Value contains U+FFFD."""
    return F.contains(col_of(c), F.lit("\ufffd"))


def has_non_ascii(c) -> Column:
    """Value holds a character above U+007F."""
    return col_of(c).rlike(r"[^\x00-\x7F]")
