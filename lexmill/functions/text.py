"""Column expressions on text, with byte and white-space semantics stated by each.

White space is the Unicode property of that name, not Java's ``\\s``; "bytes" are UTF-8 bytes and "characters" code
points. Ratios are computed in double, rounded to float and widened again, so that comparisons with double thresholds
come out as for single-precision metrics.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WS = r"\p{IsWhite_Space}"
#: Splits sentences; never occurs in valid text.
MARK = "￿"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def single(x: Column) -> Column:
    """A double rounded to single precision."""
    return x.cast("float").cast("double")


def ratio(a: Column, b: Column) -> Column:
    """a / b in single precision; null where b is 0."""
    return single(F.try_divide(a.cast("double"), b.cast("double")))


def words(text: Column | str) -> Column:
    """Maximal runs of characters that are not white space."""
    return F.filter(F.split(col(text), WS + "+"), lambda w: w != "")


def lines(text: Column | str) -> Column:
    """Lines without their ends; a final newline does not open another line, and empty text has none."""
    t = col(text)
    parts = F.split(t, "\n", -1)
    parts = F.when(F.endswith(t, F.lit("\n")), F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.transform(parts, lambda x: F.regexp_replace(x, "\r$", "")))


def trim(text: Column | str) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(col(text), rf"^{WS}+|{WS}+\z", "")


def total_bytes(items: Column) -> Column:
    """Bytes of all strings of an array."""
    return F.aggregate(items, F.lit(0).cast("long"), lambda a, w: a + F.octet_length(w))


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, also where body uses it inside other lambdas."""
    return F.transform(F.array(value), body)[0]


def flatten_newlines(text: Column | str) -> Column:
    """Newlines become spaces, as language identification wants one line."""
    return F.translate(col(text), "\n", " ")


def strip_label(label: Column | str) -> Column:
    """A model's label without its prefix."""
    return F.regexp_replace(col(label), "^__label__", "")


def round3(x: Column | str) -> Column:
    """Three decimals, half to even on the exact binary value."""
    return F.bround(col(x), 3)


def round2_single(x: Column) -> Column:
    """Two decimals in single precision, half away from zero."""
    return single(F.try_divide(F.round(single(single(x) * F.lit(100.0)), 0), F.lit(100.0)))
