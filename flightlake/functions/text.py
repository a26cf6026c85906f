"""Text clean-up and the legacy text extractors of the board display."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters Python's ``str.split()`` treats as whitespace
# (ASCII \t \n \v \f \r, the separators \x1c-\x1f, space, and the Unicode
# White_Space code points U+0085 U+00A0 U+1680 U+2000-U+200A U+2028 U+2029
# U+202F U+205F U+3000).  Written with \x{...} escapes, valid in Java and RE2.
WHITESPACE_CLASS = (r"[\t\n\x{0b}\x{0c}\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
                    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+")


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def normalize_text(text) -> Column:
    """Collapse every whitespace run to one space and strip both ends."""
    return F.trim(F.regexp_replace(_c(text), WHITESPACE_CLASS, " "))


def _normalize(col: Column, dtype: T.DataType) -> Column | None:
    """Expression that normalizes every string inside ``col``; None if none inside."""
    if isinstance(dtype, T.StringType):
        return normalize_text(col)
    if isinstance(dtype, T.StructType):
        out = col
        changed = False
        for field in dtype.fields:
            inner = _normalize(col.getField(field.name), field.dataType)
            if inner is not None:
                out = out.withField(field.name, inner)
                changed = True
        if not changed:
            return None
        # withField on a null struct would build a struct of nulls: keep null.
        return F.when(col.isNull(), F.lit(None).cast(dtype)).otherwise(out)
    if isinstance(dtype, T.ArrayType):
        probe = _normalize(F.col("x"), dtype.elementType)
        if probe is None:
            return None
        return F.transform(col, lambda x: _normalize(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        vals = _normalize(F.col("v"), dtype.valueType)
        if vals is None:
            return None
        return F.transform_values(col, lambda k, v: _normalize(v, dtype.valueType))
    return None


def normalize_strings(df: DataFrame) -> DataFrame:
    """Whitespace clean-up of every string in every (nested) column, schema-driven."""
    exprs = []
    for field in df.schema.fields:
        e = _normalize(F.col(f"`{field.name}`"), field.dataType)
        exprs.append(e.alias(field.name) if e is not None else F.col(f"`{field.name}`"))
    return df.select(*exprs)


# The board display once read Java ``Map.toString`` text; these reproduce those
# extractions for payloads that still arrive in that form (legacy_text mode).
def legacy_origin_name(text) -> Column:
    """Name from ``{name=Foo, ...}``: text up to the first comma, minus ``{name=`` and ``,``."""
    # fixed value: the pattern of the display text
    m = F.regexp_extract(_c(text), r"^(.+?),", 0)
    return F.when(F.length(m) > 0, m.substr(F.lit(7), F.greatest(F.length(m) - F.lit(7), F.lit(0))))


def legacy_board_times(text) -> tuple[Column, Column]:
    """(arrival, departure) epochs from ``{arrival=..., departure=...}`` text.

    Arrival is the first digit run inside the first ``a...,`` span, departure the
    first digit run inside the first ``d...}`` span (same spans as the legacy
    display, including its behaviour when departure is listed first).
    """
    t = _c(text)
    # fixed value: the pattern of the display text
    arr = F.regexp_extract(F.regexp_extract(t, r"a(.+?),", 0), r"\d+", 0)
    dep = F.regexp_extract(F.regexp_extract(t, r"d(.+?)\}", 0), r"\d+", 0)
    return (F.when(arr != "", arr.cast("long")), F.when(dep != "", dep.cast("long")))
