"""Scalar text functions as native Spark column expressions.

Every function takes and returns ``Column``s, so they stay inside whole-stage
codegen and can be used in ``select``/``filter``/``withColumn`` anywhere.

Whitespace: ``\\s`` in Java regexes is ASCII only and Spark's ``trim`` only
removes spaces.  Everything here uses ``fixed_values.WHITESPACE``, so that tabs,
newlines, no-break and other Unicode spaces count, like in Python's
``str.strip``/``str.split``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera import fixed_values as fv

ColumnOrName = Column | str

# "Word" characters in the Unicode sense (letters, digits, underscore).
# Java's \w is ASCII-only, which would split "año" into "a o".
SPACE = f"[{fv.WHITESPACE}]"
NON_WORD = r"[^a-z\p{L}\p{N}_]+"  # a-z, the most frequent, first; no whitespace is a word character
#: The characters of ``fixed_values.WHITESPACE``.
SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
HAS_LETTER, URL_PATTERN, EMAIL_PATTERN = fv.HAS_LETTER, fv.URL_PATTERN, fv.EMAIL_PATTERN
SENTENCE_BOUNDARY = rf"(?<=[.!?]){SPACE}+"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a ``Column -> Column``
    function) as a lambda variable.  Catalyst does not share subexpressions
    across conditional branches or inside lambdas, so an expression used in
    many places of a ``CASE`` (or of a fold) would otherwise be recomputed at
    every use."""
    return F.transform(F.array(value), body)[0]


def strip_ws(c: ColumnOrName) -> Column:
    """Python ``str.strip()``: remove leading and trailing whitespace."""
    return F.btrim(_col(c), F.lit(SPACES))


def collapse_ws(c: ColumnOrName) -> Column:
    """Collapse whitespace runs to one space and strip."""
    return strip_ws(F.regexp_replace(_col(c), rf"{SPACE}+", " "))


def words(c: ColumnOrName) -> Column:
    """Python ``str.split()``: whitespace tokens, no empty strings (J5 helper)."""
    return F.filter(F.split(F.coalesce(_col(c), F.lit("")), rf"{SPACE}+"), lambda t: t != "")


def word_count(c: ColumnOrName) -> Column:
    """Number of whitespace-separated tokens (0 for null).

    One regex split and no per-token lambda (stays in generated code): a
    split on whitespace runs yields one extra empty piece for leading and
    one for trailing whitespace, which are subtracted."""
    t = F.coalesce(_col(c), F.lit(""))
    pieces = F.size(F.split(t, rf"{SPACE}+", -1))
    lead = F.substring(t, 1, 1).rlike(SPACE).cast("int")
    trail = F.substring(t, -1, 1).rlike(SPACE).cast("int")
    return F.when(t == "", F.lit(0)).otherwise(pieces - lead - trail)


def has_content(c: ColumnOrName) -> Column:
    """Non-null text with at least one non-whitespace character."""
    return F.coalesce(F.length(strip_ws(c)) > 0, F.lit(False))


def _unwrap(c: Column, open_ch: str, close_ch: str) -> Column:
    """Remove ``open_ch ... close_ch`` pairs wrapping the whole string, repeatedly,
    stripping whitespace after each removal.

    The number of levels removed is fixed up front: it is the smaller of the
    count of ``open_ch`` in the leading run of ``open_ch``/whitespace and the
    count of ``close_ch`` in the trailing run.  The fold then peels exactly that
    many levels, so there is no data-dependent loop.
    """
    o, cl = "\\" + open_ch, "\\" + close_ch

    def peel(s: Column) -> Column:
        lead = F.regexp_extract(s, rf"^({o}{SPACE}*)*", 0)
        trail = F.regexp_extract(s, rf"({SPACE}*{cl})*$", 0)
        n_lead = F.length(lead) - F.length(F.replace(lead, F.lit(open_ch), F.lit("")))
        n_trail = F.length(trail) - F.length(F.replace(trail, F.lit(close_ch), F.lit("")))

        def apply(levels: Column) -> Column:
            peeled = F.aggregate(
                F.sequence(F.lit(1), levels), s,
                lambda acc, _i: strip_ws(F.substring(acc, 2, F.length(acc) - 2)),
            )
            return F.when(levels > 0, peeled).otherwise(s)

        return let(F.least(n_lead, n_trail), apply)

    # quick exit for the common case (no wrapping character at the start)
    return F.when(c.startswith(open_ch) & c.endswith(close_ch), let(c, peel)).otherwise(c)


def clean_title(c: ColumnOrName) -> Column:
    """Strip; drop trailing dots; unwrap ``[...]`` levels, then ``(...)``
    levels; drop trailing dots; collapse whitespace.  Null and ``''`` pass
    through unchanged.

    Note ``(a) and (b)`` becomes ``a) and (b`` -- the outer characters are
    removed without checking that they match each other, as in the original.
    """
    src = _col(c)

    def clean(s0: Column) -> Column:
        s1 = strip_ws(F.regexp_replace(s0, r"\.+$", ""))
        s2 = let(s1, lambda a: _unwrap(a, "[", "]"))
        s3 = let(s2, lambda b: _unwrap(b, "(", ")"))
        return collapse_ws(strip_ws(F.regexp_replace(s3, r"\.+$", "")))

    return F.when(src.isNull() | (src == ""), src).otherwise(let(strip_ws(src), clean))


def indicator_hits(lower_text: Column, indicators: Sequence[str]) -> Column:
    """Number of distinct indicator substrings present in ``lower_text``."""
    hits = [F.contains(lower_text, F.lit(w)).cast("int") for w in dict.fromkeys(indicators)]
    if not hits:
        return F.lit(0)
    total = hits[0]
    for h in hits[1:]:
        total = total + h
    return total


def detect_language(
    c: ColumnOrName,
    spanish: Sequence[str] = fv.SPANISH_INDICATORS,
    english: Sequence[str] = fv.ENGLISH_INDICATORS,
    min_hits: int = fv.MIN_LANGUAGE_HITS,
) -> Column:
    """Substring-indicator language vote.

    ``unknown`` for null/empty text; ``spanish``/``english`` when that side has
    strictly more distinct indicator hits and at least ``min_hits``; otherwise
    ``mixed_or_unknown``.  Indicators are plain substrings, so ``conclusiones``
    also counts for ``conclusion``.
    """
    text = _col(c)

    def vote(low: Column) -> Column:
        es = indicator_hits(low, spanish)
        en = indicator_hits(low, english)
        return (
            F.when((es > en) & (es >= min_hits), F.lit(fv.LANG_SPANISH))
            .when((en > es) & (en >= min_hits), F.lit(fv.LANG_ENGLISH))
            .otherwise(F.lit(fv.LANG_MIXED))
        )

    return F.when(text.isNull() | (text == ""), F.lit(fv.LANG_UNKNOWN)).otherwise(let(F.lower(text), vote))


def split_sentences(c: ColumnOrName) -> Column:
    """Split after ``.``/``!``/``?`` followed by whitespace; strip; drop blanks."""
    parts = F.split(F.coalesce(_col(c), F.lit("")), SENTENCE_BOUNDARY)
    return F.filter(F.transform(parts, strip_ws), lambda s: s != "")


def join_sentences(c: ColumnOrName) -> Column:
    """Join translated sentences with one space."""
    return F.array_join(_col(c), " ")


def clean_text(c: ColumnOrName, extra_cleaning: bool = False) -> Column:
    """Lower-case; optionally drop URLs then e-mail-like tokens; punctuation
    to space; collapse whitespace.  Null -> ``''``."""
    s = F.lower(F.coalesce(_col(c), F.lit("")))
    if extra_cleaning:
        s = F.regexp_replace(s, URL_PATTERN, "")
        s = F.regexp_replace(s, EMAIL_PATTERN, "")
    return F.trim(F.regexp_replace(s, NON_WORD, " "))


def tokenize(clean: ColumnOrName) -> Column:
    """Tokens of already-cleaned text (no punctuation is left, so a
    whitespace split equals a word tokenizer here)."""
    return F.array_remove(F.split(_col(clean), " "), "")


def filter_tokens(
    tokens: ColumnOrName,
    stopwords: Sequence[str] | None,
    min_length: int = 2,
) -> Column:
    """Keep tokens with ``length >= min_length``, not stopwords, with a letter."""
    stop = F.array(*[F.lit(w) for w in sorted(set(stopwords or []))]) if stopwords else None

    def keep(t: Column) -> Column:
        cond = (F.length(t) >= min_length) & t.rlike(HAS_LETTER)
        if stop is not None:
            cond = cond & ~F.array_contains(stop, t)
        return cond

    return F.filter(_col(tokens), keep)


def nested_get(c: ColumnOrName, default) -> Column:
    """``.get(a, {}).get(b, default)`` -- a missing struct or field yields the default."""
    return F.coalesce(_col(c), F.lit(default))


def tokens_to_text(tokens: ColumnOrName) -> Column:
    """``token<TAB>label`` lines of an ``array<struct<token,label>>``."""
    return F.array_join(
        F.transform(_col(tokens), lambda t: F.concat_ws("\t", t["token"], t["label"])), "\n"
    )


def estimate_tokens(text: ColumnOrName) -> Column:
    """Rough token estimate ``len(text) // 4``."""
    return F.floor(F.length(_col(text)) / 4).cast("long")
