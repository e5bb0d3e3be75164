"""Cleaning and conversion rules as Column expressions.

Everything here is a pure ``Column -> Column`` builder so it stays inside
whole-stage codegen; no Python UDFs.  ANSI mode is on in Spark 4, so all
parsing goes through ``try_*`` functions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom import schemas as S


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Whitespace stripped from both ends of text values: space, tab, LF, VT, FF, CR.
WHITESPACE = " \t\n\x0b\x0c\r"
# Shapes the parsers can accept; parsing is only attempted on these (cheap guards).
NUMBER_SHAPE = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
NUMBER_WORDS = ["nan", "inf", "+inf", "-inf", "infinity", "+infinity", "-infinity"]
# Month and day ranges are in the guards: failed parses are costly (exception path), and
# 8-digit keys would otherwise all be tried as yyyyMMdd dates.
_MM, _DD = "(0[1-9]|1[0-2])", "(0[1-9]|[12][0-9]|3[01])"
DATE_FORMATS = [("yyyy-MM-dd", rf"^[0-9]{{4}}-{_MM}-{_DD}$"), ("yyyyMMdd", rf"^[0-9]{{4}}{_MM}{_DD}$"),
                ("MM/dd/yyyy", rf"^{_MM}/{_DD}/[0-9]{{4}}$"),
                ("yyyy-MM-dd HH:mm:ss", rf"^[0-9]{{4}}-{_MM}-{_DD} ([01][0-9]|2[0-3])(:[0-5][0-9]){{2}}$")]


def strip_ws(c) -> Column:
    """Trim all leading/trailing whitespace (Spark's ``trim`` only strips spaces); no regex."""
    return F.btrim(_c(c).cast("string"), F.lit(WHITESPACE))


def number_like(s: Column) -> Column:
    """True when ``s`` (already stripped) has the shape of a number."""
    return s.rlike(NUMBER_SHAPE) | F.lower(s).isin(*NUMBER_WORDS)


def try_number(s: Column) -> Column:
    """``try_cast(s AS DOUBLE)``, attempted only on number-shaped text."""
    return F.when(number_like(s), s.try_cast("double"))


def try_date(s: Column, formats=None) -> Column:
    """First format that parses; each parse attempted only on text of that format's shape."""
    fmts = [f for f in DATE_FORMATS if formats is None or f[0] in formats]
    return F.coalesce(*[F.when(s.rlike(rx), F.try_to_date(s, fmt)) for fmt, rx in fmts])


def null_token(c) -> Column:
    """P6: '', whitespace, 'nan', 'none', 'null' (any case) -> NULL; else the value."""
    c = _c(c)
    return F.when(F.lower(strip_ws(c)).isin(*S.NULL_TOKENS), F.lit(None)).otherwise(c)


def empty_to_null_trim(c) -> Column:
    """P7: '' -> NULL, otherwise trimmed (whitespace-only stays '')."""
    c = _c(c)
    return F.when(c == "", F.lit(None).cast("string")).otherwise(strip_ws(c))


def text_or_null(c) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(strip_ws(c), F.lit(""))


def text_or_empty(c) -> Column:
    """F2 variant returning '' instead of NULL."""
    return F.coalesce(strip_ws(c), F.lit(""))


def to_flag_bool(c) -> Column:
    """Boolean by '_in' suffix.  Token sets first, then any number (!= 0), else NULL."""
    s = F.lower(strip_ws(c))
    num = try_number(s)
    return (F.when(s.isin(*S.TRUE_TOKENS), F.lit(True))
            .when(s.isin(*S.FALSE_TOKENS), F.lit(False))
            .when(num.isNotNull(), num != 0)
            .otherwise(F.lit(None).cast("boolean")))


def _try_cast(c: Column, t: str) -> Column:
    return c.try_cast(t)


def to_date_text(c) -> Column:
    """P9: '' / '0000-00-00' / 'nan' -> NULL, any accepted date format -> DATE, else NULL."""
    s = strip_ws(c)
    parsed = try_date(s)
    return F.when(s.isin(*S.EMPTY_DATE_TOKENS) | s.isNull(), F.lit(None).cast("date")).otherwise(parsed)


def date_unparsable(c) -> Column:
    """Quarantine flag for P9: a non-empty value that no format parses."""
    s = strip_ws(c)
    return (s.isNotNull() & ~s.isin(*S.EMPTY_DATE_TOKENS) & to_date_text(c).isNull())


def to_whole_number(c) -> Column:
    """P10: numeric text -> BIGINT, truncating fractions ('12.0' -> 12); failure -> NULL."""
    s = strip_ws(c)
    return F.when(s.rlike(NUMBER_SHAPE), _try_cast(_try_cast(s, "decimal(38,6)"), "bigint"))


def whole_number_text(c) -> Column:
    """P10 for keys and codes kept as text: digits stay as they are ('00012'), other numbers lose their fraction
    ('12.0' -> '12'), anything else -> NULL."""
    s = strip_ws(c)
    return F.when(s.rlike(r"^[0-9]+$"), s).otherwise(to_whole_number(c).cast("string"))


def unconverted(stripped: Column, value: Column, kind: str) -> Column:
    """Whether a column's text, stripped and without null tokens, is there but has no ``value`` of this kind."""
    failed = stripped.isNotNull() & value.isNull()
    if kind == "date":
        failed = failed & ~stripped.isin(*S.EMPTY_DATE_TOKENS)
    return F.coalesce(failed, F.lit(False))


def typed_text(name: str, kind: str, c=None) -> tuple[Column, Column]:
    """A raw text column as ``kind`` by the cleaning rules, and whether it held a value that does not convert."""
    raw = null_token(_c(c) if c is not None else F.col(f"`{name}`"))
    present = text_or_null(raw)
    if kind == "date":
        value = to_date_text(raw)
        return value, date_unparsable(raw)
    if kind == "boolean":
        value = to_flag_bool(raw)
    elif kind in ("int", "bigint"):
        value = to_whole_number(raw).cast(kind)
    elif name in S.INTEGER_NAMES:
        value = whole_number_text(raw)
    else:
        return present, F.lit(False)
    return value, F.coalesce(present.isNotNull() & value.isNull(), F.lit(False))


def yyyymmdd_to_date(c) -> Column:
    """'YYYYMMDD' -> DATE; NULL unless 8 digits and a real calendar day."""
    s = strip_ws(c)
    return F.when(s.rlike(DATE_FORMATS[1][1]), F.try_to_date(s, "yyyyMMdd")).otherwise(F.lit(None).cast("date"))


def yyyymmdd_to_iso_text(c) -> Column:
    """F1 as text 'YYYY-MM-DD' (what the date normaliser emits)."""
    return F.date_format(yyyymmdd_to_date(c), "yyyy-MM-dd")


def xml_flag(c) -> Column:
    """P20: text starting with T/t -> 'T', other non-empty text -> 'F', else NULL."""
    s = text_or_null(c)
    return (F.when(F.upper(s).startswith("T"), F.lit("T"))
            .when(s.isNotNull(), F.lit("F"))
            .otherwise(F.lit(None).cast("string")))


def xml_flag_bool(c) -> Column:
    """P20 as BOOLEAN."""
    f = xml_flag(c)
    return F.when(f.isNull(), F.lit(None).cast("boolean")).otherwise(f == "T")


def no_registration(c) -> Column:
    """The sentinel '0000000' means no registration number."""
    return F.nullif(text_or_null(c), F.lit(S.NO_REGISTRATION))


def digits_to_int(c) -> Column:
    """P25: digits-only text -> INT, anything else NULL."""
    s = strip_ws(c)
    return F.when(s.rlike(r"^[0-9]+$"), _try_cast(s, "bigint")).otherwise(F.lit(None).cast("bigint"))


def composite_id(a, b, sep: str = "-") -> Column:
    """'a-b' only when both parts are present."""
    a, b = text_or_null(a), text_or_null(b)
    return F.when(a.isNotNull() & b.isNotNull(), F.concat_ws(sep, a, b))


def join_present(*parts, sep: str = ", ") -> Column:
    """join the non-empty parts; NULL when none is present."""
    return F.nullif(F.concat_ws(sep, *[text_or_null(p) for p in parts]), F.lit(""))


def distinct_merge(*parts, sep: str = "; ") -> Column:
    """ordered distinct merge of the non-empty parts."""
    arr = F.array(*[text_or_null(p) for p in parts])
    kept = F.array_distinct(F.filter(arr, lambda x: x.isNotNull()))
    return F.nullif(F.array_join(kept, sep), F.lit(""))


def first_present(*parts) -> Column:
    """first non-empty alternative."""
    return F.coalesce(*[text_or_null(p) for p in parts])


def table_name_of(product_id) -> Column:
    """'product_' + lower(product id)."""
    return F.concat(F.lit("product_"), F.lower(_c(product_id)))


def pct(num, den, digits: int = 1) -> Column:
    """percentage rounded to ``digits``; NULL when the base is 0."""
    return F.round(F.try_divide(_c(num) * F.lit(100.0), F.nullif(_c(den), F.lit(0))), digits)


def ceil_div(n, k) -> Column:
    """batches needed for n rows at k rows per batch."""
    return F.ceil(_c(n) / F.lit(k)).cast("bigint")


def bytes_to_mb(c, digits: int = 2) -> Column:
    return F.round(_c(c) / F.lit(1048576.0), digits)


def lineage_source(product_id, fmt: str) -> Column:
    """data_source = '<product> [<FORMAT>]'."""
    return F.format_string("%s [%s]", _c(product_id), F.lit(fmt.upper()))


def clean_by_name(name: str, c=None) -> Column:
    """Apply the name-suffix type rules (P6, P8-P11) to a raw text column."""
    c = null_token(_c(c) if c is not None else F.col(f"`{name}`"))
    if name.endswith("_in"):
        return to_flag_bool(c)
    if name.endswith("_dt") or name.endswith("_date"):
        return to_date_text(c)
    if name in S.INTEGER_NAMES:
        return to_whole_number(c)
    return text_or_null(c)
