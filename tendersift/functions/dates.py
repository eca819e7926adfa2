"""Date expressions. What cannot be read becomes null, never an error; `today` is a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tendersift.functions.text import fold

# fixed values: French month names and their short forms, folded
MONTHS_FR = {
    "janvier": 1, "janv": 1, "jan": 1, "fevrier": 2, "fevr": 2, "fev": 2, "mars": 3, "mar": 3,
    "avril": 4, "avr": 4, "mai": 5, "juin": 6, "juillet": 7, "juil": 7, "aout": 8, "aou": 8,
    "septembre": 9, "sept": 9, "sep": 9, "octobre": 10, "oct": 10, "novembre": 11, "nov": 11,
    "decembre": 12, "dec": 12,
}
# fixed values: days in one unit of "il y a n unit"
UNIT_DAYS = {"heure": 0, "minute": 0, "jour": 1, "semaine": 7, "mois": 30, "an": 365}
RELATIVE = r"(?i)il y a\s+(\d+)\s*(jour|semaine|mois|an|heure|minute)"


def literal_map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def iso_date(c: Column) -> Column:
    """DAT1: date from the first ten characters; strict `yyyy-MM-dd`."""
    head = F.substring(F.trim(c), 1, 10)
    return F.when(head.rlike(r"^\d{4}-\d{2}-\d{2}$"), head.try_cast("date"))


def relative_days(c: Column) -> Column:
    """DAT2: age in days from a relative text."""
    t = F.translate(F.coalesce(c, F.lit("")), " ", " ")
    n = F.regexp_extract(t, RELATIVE, 1).try_cast("int")
    return n * literal_map(UNIT_DAYS)[F.lower(F.regexp_extract(t, RELATIVE, 2))]


def days_between(later: Column, earlier: Column) -> Column:
    """DAT8."""
    return F.date_diff(later, earlier)


def posting_age(published: Column, relative: Column, today: Column) -> tuple[Column, Column, Column]:
    """DAT2: (date, age in days, source of the date) of a posting."""
    d = iso_date(published)
    r = relative_days(relative)
    age = F.coalesce(F.date_diff(today, d), r)
    day = F.coalesce(d, F.date_sub(today, r))
    src = (F.when(d.isNotNull(), F.lit("iso")).when(r.isNotNull(), F.lit("relatif"))
           .otherwise(F.lit("inconnu")))
    return day, age, src


def site_date(c: Column, today: Column) -> Column:
    """DAT3: now, yesterday, or dd/mm of this year, of last year when that is still to come."""
    t = F.lower(F.coalesce(c, F.lit("")))
    dd, mm = F.regexp_extract(t, r"(\d{2})/(\d{2})", 1), F.regexp_extract(t, r"(\d{2})/(\d{2})", 2)
    this = F.try_to_date(F.concat_ws("-", F.year(today), mm, dd), "yyyy-MM-dd")
    last = F.try_to_date(F.concat_ws("-", F.year(today) - 1, mm, dd), "yyyy-MM-dd")
    return (F.when(t.contains("instant") | t.contains("aujourd"), today)
            .when(t.contains("hier"), F.date_sub(today, 1))
            .when(this > today, last).otherwise(this))


def day_first_date(c: Column) -> Column:
    """DAT4: dd/mm/yyyy or dd-mm-yyyy, anything may follow."""
    h = F.substring(F.trim(c), 1, 10)
    return F.when(h.rlike(r"^\d{2}[/-]\d{2}[/-]\d{4}$"), F.try_to_date(F.translate(h, "/", "-"), "dd-MM-yyyy"))


def any_date(c: Column) -> Column:
    """ISO first, then day-first."""
    return F.coalesce(iso_date(c), day_first_date(c))


def month_number(c: Column) -> Column:
    """DAT5: number of a French month name, full or short, accents and final dot optional."""
    return literal_map(MONTHS_FR)[F.regexp_replace(fold(F.trim(c)), r"\.$", "")]


def french_date(c: Column) -> Column:
    """DAT5: `d month yyyy`, a time may follow."""
    p = r"^(\d{1,2})\s+(\S+)\s+(\d{4})(?:\s+\d{2}:\d{2})?$"
    t = F.trim(c)
    return date_from_parts(F.regexp_extract(t, p, 1), F.regexp_extract(t, p, 2), F.regexp_extract(t, p, 3))


def date_from_parts(day: Column, month: Column, year: Column) -> Column:
    """DAT5: date from day, month name and year given apart."""
    return F.try_to_date(F.concat_ws("-", year, F.lpad(month_number(month).cast("string"), 2, "0"),
                                     F.lpad(day, 2, "0")), "yyyy-MM-dd")


def rfc822_date(c: Column) -> Column:
    """DAT6: the weekday is dropped, Spark's parser refuses it."""
    t = F.regexp_replace(F.trim(c), r"^[A-Za-z]{3},\s*", "")
    t = F.regexp_replace(t, r"\s(?:GMT|UTC|UT|Z)$", " +0000")
    day = F.regexp_extract(t, r"^(\d{1,2} [A-Za-z]{3} \d{4}) ", 1)
    return F.when(t.rlike(r"\d{2}:\d{2}:\d{2} [+-]\d{4}$"), F.try_to_date(day, "d MMM yyyy"))


def unless_sentinel(c: Column, marker: str = "-0001") -> Column:
    """DAT7."""
    return F.when(~c.contains(marker), c)


def display_date(published: Column, relative: Column, default: str = "NC") -> Column:
    """STR8: dd/mm/yyyy, else the relative text, else the default."""
    return F.coalesce(F.date_format(iso_date(published), "dd/MM/yyyy"),
                      F.nullif(F.trim(relative), F.lit("")), F.lit(default))
