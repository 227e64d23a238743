"""Cleansing expressions: every function maps Columns to a Column and stays inside code generation.

Text comparisons are case-insensitive and accent-insensitive (``fold``), the collation the source
warehouse uses, so no rule depends on how a value happens to be capitalised.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from ticketlake.rules import ACCENTS_FROM, ACCENTS_TO


def _c(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


# ---------------------------------------------------------------- keys
def composite_key(*cols, sep: str = "_") -> Column:
    """NULL-propagating concatenation, e.g. ``<year>_<id>``."""
    parts: list[Column] = []
    for i, col in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(_c(col).cast("string"))
    return F.concat(*parts)


def md5_key(*cols, prefix: str = "", sep: str = "_", null_as: str = "") -> Column:
    """Hash key over a null-safe concatenation."""
    parts = [F.lit(prefix)] if prefix else []
    for i, col in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(F.coalesce(_c(col).cast("string"), F.lit(null_as)))
    return F.md5(F.concat(*parts))


def rekey(prefix: str, col) -> Column:
    """Branch-prefixed re-key of an existing key; a NULL key stays NULL."""
    return F.md5(F.concat(F.lit(prefix), _c(col).cast("string")))


# ---------------------------------------------------------------- null rules
def null_if_blank(col) -> Column:
    return F.nullif(F.trim(_c(col)), F.lit(""))


def lower_or_null(col) -> Column:
    return F.lower(null_if_blank(col))


def upper_or_null(col) -> Column:
    return F.upper(null_if_blank(col))


def null_if_in(col, values, *, contains=()) -> Column:
    """Blank, blacklisted (whole value) or blacklisted (substring) text becomes NULL."""
    text = F.trim(_c(col))
    bad = fold(text).isin([v.lower() for v in values] + [""])
    for piece in contains:
        bad = bad | fold(text).contains(piece)
    return F.when(~bad, text)


def fold(col) -> Column:
    """Lower-case and strip accents."""
    return F.translate(F.lower(_c(col)), ACCENTS_FROM, ACCENTS_TO)


# ---------------------------------------------------------------- time
def moment(as_of) -> Column:
    """Literal for the injected "now", free of any session time zone."""
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def clean_ts(col) -> Column:
    """Zero dates, blanks and malformed text become NULL."""
    return _c(col).try_cast("timestamp_ntz")


def clean_date(col) -> Column:
    return _c(col).try_cast("date")


def not_before(end, start) -> Column:
    """NULL where ``end`` precedes ``start``; an unknown start is no objection."""
    return F.when(~F.coalesce(_c(end) < _c(start), F.lit(False)), _c(end))


def elapsed(unit: str, start, end) -> Column:
    """Whole elapsed units, truncated toward zero."""
    return F.timestamp_diff(unit, _c(start), _c(end))


def day_month_date(col) -> Column:
    """``dd/mm/yyyy`` or ``mm/dd/yyyy``: the part above 12 decides, otherwise day first."""
    text = _c(col)
    shaped = text.rlike(r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$")
    first = F.substring(text, 1, 2).try_cast("int")
    second = F.substring(text, 4, 2).try_cast("int")
    year = F.substring(text, 7, 4)

    def iso(month: Column, day: Column) -> Column:
        return F.concat_ws("-", year, F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0"))

    return F.when(
        shaped,
        F.when(second.between(1, 12), iso(second, first))
        .when(first.between(1, 12), iso(first, second))
        .try_cast("date"),
    )


# ---------------------------------------------------------------- numbers
def within(col, low=None, high=None) -> Column:
    """Out-of-range values become NULL."""
    c = _c(col)
    ok = F.lit(True)
    if low is not None:
        ok = ok & (c >= low)
    if high is not None:
        ok = ok & (c <= high)
    return F.when(ok, c)


def positive(col) -> Column:
    return F.when(_c(col) > 0, _c(col))


def floor_at_one(col) -> Column:
    return F.greatest(F.coalesce(_c(col), F.lit(1)), F.lit(1))


def leading_int(col) -> Column:
    """Leading digits of a text as BIGINT, 0 where there are none, NULL for NULL."""
    c = _c(col)
    digits = F.regexp_extract(c, r"^\s*([0-9]+)", 1)
    return F.when(c.isNotNull(), F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint")))


def rounded(col, digits: int) -> Column:
    """Half-up rounding on a compact decimal, so binary noise never decides a tie."""
    c = _c(col)
    return F.coalesce(F.round(c.try_cast("decimal(18,6)"), digits).cast("double"), F.round(c.cast("double"), digits))


def scaled(col, divisor, digits: int = 2) -> Column:
    return rounded(_c(col) / F.lit(float(divisor)), digits)


def without_suffix(col, suffix: str, dtype: str) -> Column:
    """Number from unit-suffixed text such as ``8GB`` or ``1.37kg``."""
    return F.replace(F.lower(_c(col)), F.lit(suffix), F.lit("")).try_cast(dtype)


def bytes_or_megabytes_gb(col) -> Column:
    """Magnitude-sensitive capacity: above 1e9 bytes, above 256 megabytes, else unknown."""
    n = leading_int(col)
    return (
        F.when(n > 1_000_000_000, rounded(n / F.lit(1024.0**3), 2))
        .when(n > 256, rounded(n / F.lit(1024.0), 2))
    )


def ratio(numerator, denominator, digits: int = 4) -> Column:
    """Guarded division: NULL for a zero denominator."""
    return rounded(_c(numerator) / F.nullif(_c(denominator).cast("double"), F.lit(0.0)), digits)


# ---------------------------------------------------------------- flags
def is_one(col) -> Column:
    return F.coalesce(_c(col) == 1, F.lit(False))


def has_text(col) -> Column:
    return F.coalesce(F.trim(_c(col)) != "", F.lit(False))


def is_true(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def text_bool(col) -> Column:
    return is_true(F.lower(F.trim(_c(col))).isin("true", "yes", "1"))


def ipv4_shape(col) -> Column:
    return is_true(_c(col).rlike(r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$"))


# ---------------------------------------------------------------- rule tables
def _all(col, patterns) -> tuple:
    return (patterns,) if isinstance(patterns, str) else tuple(patterns)


def contains_any(col, patterns) -> Column:
    text = fold(col)
    return reduce(lambda a, b: a | b, [text.contains(p) for p in _all(col, patterns)])


def classify(col, rules, default) -> Column:
    """Ordered substring classifier: the first rule with a matching pattern wins."""
    text = fold(col)
    out = None
    for patterns, label in rules:
        cond = reduce(lambda a, b: a | b, [text.contains(p) for p in _all(col, patterns)])
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(F.lit(default))


_OPS = {
    ">=": lambda c, v: c >= v,
    ">": lambda c, v: c > v,
    "<=": lambda c, v: c <= v,
    "<": lambda c, v: c < v,
    "=": lambda c, v: c == v,
}


def tier(col, cuts, default) -> Column:
    """Threshold ladder ``[(op, cut, label), ...]``; NULL falls through to ``default``."""
    c = _c(col)
    out = None
    for op, cut, label in cuts:
        cond = _OPS[op](c, F.lit(cut))
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(F.lit(default))


def map_codes(col, mapping, default) -> Column:
    """Code-to-label map compared as text, so mixed code types never fail a cast."""
    c = _c(col).cast("string")
    out = None
    for codes, label in mapping:
        codes = codes if isinstance(codes, tuple) else (codes,)
        cond = c.isin([str(x) for x in codes])
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(F.lit(default))


# ---------------------------------------------------------------- text bodies
def strip_entities(col, literals) -> Column:
    """Nested literal removal in the listed order, then blank to NULL."""
    out = _c(col)
    for piece in literals:
        out = F.replace(out, F.lit(piece), F.lit(""))
    return null_if_blank(out)


def first_token(col, sep: str) -> Column:
    return null_if_blank(F.substring_index(_c(col), sep, 1))


def full_name(first, last) -> Column:
    return null_if_blank(F.concat(F.coalesce(_c(first), F.lit("")), F.lit(" "), F.coalesce(_c(last), F.lit(""))))


def change_type(old, new) -> Column:
    o, n = _c(old), _c(new)
    return (
        F.when(o.isNull() & n.isNotNull(), "created")
        .when(o.isNotNull() & n.isNull(), "deleted")
        .when(fold(o) != fold(n), "updated")
        .otherwise("no_change")
    )


# ---------------------------------------------------------------- schema alignment
def align(df, schema):
    """Project ``df`` onto ``[(name, type), ...]``; absent columns become typed NULLs."""
    have = set(df.columns)
    return df.select(
        *[(F.col(n).cast(t) if n in have else F.lit(None).cast(t)).alias(n) for n, t in schema]
    )


def project_existing(df, wanted):
    """Tolerant projection; returns the frame and the list of missing names."""
    have = set(df.columns)
    return df.select(*[c for c in wanted if c in have]), [c for c in wanted if c not in have]
