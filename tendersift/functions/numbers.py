"""Amount and score expressions. What cannot be read becomes null; halves round to even."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tendersift.labels import LEXICAL_MAX

NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)$"


def plain_number(c: Column) -> Column:
    return F.when(c.rlike(NUMBER), c.try_cast("double"))


def amount(c: Column) -> Column:
    """NUM1: currency signs and every kind of space dropped, comma as decimal point."""
    s = F.regexp_replace(c, r"(?U)[€$\s]", "")
    return plain_number(F.replace(s, F.lit(","), F.lit(".")))


def _range_token(c: Column) -> Column:
    s = F.trim(F.replace(F.replace(F.lower(F.trim(c)), F.lit("€"), F.lit("")), F.lit(","), F.lit(".")))
    unit = F.right(s, F.lit(1))
    factor = F.when(unit == "k", F.lit(1_000.0)).when(unit == "m", F.lit(1_000_000.0)).otherwise(F.lit(1.0))
    digits = F.trim(F.regexp_replace(s, "[km]$", ""))
    return plain_number(digits) * factor


def amount_range(c: Column) -> Column:
    """NUM2: struct(low, high) of `40k - 100k€`, `+ 100M€`, `<50k` or one amount."""
    s = F.trim(c)
    rest, none = F.regexp_replace(s, "^.", ""), F.lit(None).cast("string")
    tokens = (F.when(s.rlike("^[+>]"), F.array(rest, none)).when(s.startswith("<"), F.array(none, rest))
              .when(s.contains("-"), F.split(s, "-", 2)).otherwise(F.array(s, s)))
    both = F.transform(tokens, _range_token)
    return F.transform(F.array(both), lambda r: F.struct(r[0].alias("low"), r[1].alias("high")))[0]


def local_amount(c: Column) -> Column:
    """NUM3: zero or a placeholder is no amount."""
    v = amount(c)
    return F.when(v > 0, v)


def amount_display(c: Column, currency: str) -> Column:
    """NUM4: `354 000,00 MAD`."""
    return F.concat(F.translate(F.format_number(c, 2), ",.", " ,"), F.lit(" " + currency))


def lexical_percent(c: Column, top: int = LEXICAL_MAX) -> Column:
    """NUM5."""
    return F.least(F.lit(100), F.coalesce(F.bround(c / F.lit(float(top)) * 100), F.lit(0)).cast("int"))


def judge_score(c: Column) -> Column:
    """NUM6: a number or 0, rounded, within 0..100."""
    v = F.bround(F.coalesce(c.try_cast("double"), F.lit(0.0)))
    return F.greatest(F.lit(0), F.least(F.lit(100), v.cast("int")))
