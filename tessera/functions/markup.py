"""Text extraction from markup records (B1, B4) with regular expressions.

For well-formed XML records the ``xpath_*`` functions are used (see
:mod:`tessera.sources.articles`); they throw on malformed input, so raw web
pages (rarely well-formed) use these regex extractors instead: first element
by tag, inner tags removed, the predefined entities decoded, whitespace
stripped, ``''`` when absent (``nullif`` turns that into null where a field
is optional).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import strip_ws

# --- fixed values: the XML predefined entities (ampersand decoded last) ---
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&amp;", "&")]


def unescape_entities(c: Column) -> Column:
    for ent, ch in ENTITIES:
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return c


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, r"<[^>]*>", "")


def first_element_text(markup: Column, tag: str) -> Column:
    """B1: all text of the first ``<tag>`` element, stripped; ``''`` if absent."""
    inner = F.regexp_extract(markup, rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>", 1)
    return F.coalesce(strip_ws(unescape_entities(strip_tags(inner))), F.lit(""))


def attribute_value(markup: Column, tag: str, attr: str) -> Column:
    """Value of ``attr`` on the first ``<tag>`` carrying it; null if absent."""
    v = F.regexp_extract(markup, rf'(?is)<{tag}\s[^>]*\b{attr}\s*=\s*"([^"]*)"', 1)
    return F.nullif(v, F.lit(""))


def count_elements(markup: Column, tag: str) -> Column:
    return F.size(F.regexp_extract_all(markup, F.lit(rf"(?i)<{tag}[\s>]"), 0))
