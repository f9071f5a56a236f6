"""Column functions that read one field of a posting: dates, places, pay, experience, level."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The months' abbreviations on Spanish pages, in order.
MONTHS_ES = ("ene", "feb", "mar", "abr", "may", "jun", "jul", "ago", "sep", "oct", "nov", "dic")
#: How months begin on pages in each language, without accents, in order.
MONTHS = {
    "de": ("jan", "feb", "mar", "apr", "mai", "jun", "jul", "aug", "sep", "okt", "nov", "dez"),
    "en": ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"),
    "es": MONTHS_ES,
    "fr": ("jan", "fev", "mar", "avr", "mai", "juin", "juil", "aou", "sep", "oct", "nov", "dec"),
    "it": ("gen", "feb", "mar", "apr", "mag", "giu", "lug", "ago", "set", "ott", "nov", "dic"),
    "pt": ("jan", "fev", "mar", "abr", "mai", "jun", "jul", "ago", "set", "out", "nov", "dez"),
}
#: Pay periods and how often a year has them.
PERIODS = {"hour": 2080, "day": 260, "week": 52, "month": 12, "year": 1}
#: Levels by the words of a title; the first that fits wins.
LEVELS = (("intern", r"intern(ship)?|trainee"), ("junior", r"junior|entry.level|graduate"), ("lead", r"lead|principal|head"), ("senior", r"senior|sr"), ("manager", r"manager|director"))


def posted_date(raw: Column) -> Column:
    """Date of any of three spellings: ``Mon Mar 03 09:30:00 UTC 2025``, ``3 mar 2025``, ``2025-03-03``; else null."""
    long = F.to_date(F.try_to_timestamp(F.regexp_replace(raw, r"^\w{3} (\w{3} \d+ [\d:]+) UTC (\d+)$", "$1 $2"), F.lit("MMM dd HH:mm:ss yyyy")))
    iso = F.to_date(F.try_to_timestamp(raw, F.lit("yyyy-MM-dd")))
    month = F.array_position(F.array(*map(F.lit, MONTHS_ES)), F.lower(F.regexp_extract(raw, r"^\d+ (\p{L}{3})\p{L}*\.? \d+$", 1))).cast("int")
    day, year = (F.regexp_extract(raw, p, 1).try_cast("int") for p in (r"^(\d+) ", r" (\d{4})$"))
    local = F.when(month > 0, F.try_make_timestamp(year, month, day, F.lit(0), F.lit(0), F.lit(0)).cast("date"))
    return F.coalesce(F.when(raw.rlike("UTC"), long), F.when(raw.rlike(r"^\d{4}-"), iso), local)


def localised_date(raw: Column, lang: Column) -> Column:
    """Date of a day, a month in words and a year in the page's language: ``3 mars 2025``, ``3. März 2025``, ``3 de marzo de
    2025``, ``March 3, 2025``. Null where the language, the month or the day is unknown. ``lang`` is a primary tag (``fr``).
    """
    small = F.translate(F.lower(raw), "áàâãäçéèêëíìîïñóòôõöúùûü", "aaaaaceeeeiiiinooooouuuu")
    word = F.regexp_extract(small, r"\b(?!de\b)([a-z]{3,})", 1)
    known = F.create_map(*[F.lit(x) for name, months in MONTHS.items() for k, m in enumerate(months, 1) for x in (f"{name}:{m}", k)])
    start = F.when(F.substring(word, 1, 3) == "jui", F.substring(word, 1, 4)).otherwise(F.substring(word, 1, 3))
    month = F.try_element_at(known, F.concat(F.lower(lang), F.lit(":"), start))
    day, year = F.regexp_extract(small, r"\b([0-9]{1,2})\b", 1).try_cast("int"), F.regexp_extract(small, r"\b([0-9]{4})\b", 1).try_cast("int")
    return F.try_make_timestamp(year, month, day, F.lit(0), F.lit(0), F.lit(0)).cast("date")


def split_place(raw: Column) -> Column:
    """struct(locality, region, country) of ``a, b, c``, ``a, c`` or ``c``; the last part is the country."""
    parts = F.transform(F.split(raw, ","), lambda p: F.trim(p))
    n = F.size(parts)
    return F.struct(
        F.when(n >= 2, F.get(parts, 0)).alias("locality"),
        F.when(n >= 3, F.get(parts, n - 2)).alias("region"),
        F.element_at(parts, -1).alias("country"),
    )


EXPERIENCE = r"(?i)(\d+)\s*(?:\+|(?:-|to)\s*(\d+))?\s*(years?|yrs?|months?)"
#: Kinds of employment by the words of a text; the first that fits wins.
KINDS = (("internship", r"intern(ship)?|trainee"), ("temporary", r"temporary|seasonal|temp"), ("contract", r"contract(or)?|freelance"), ("part_time", r"part.time"), ("full_time", r"full.time|permanent"))


def experience(raw: Column) -> Column:
    """struct(low, high) of the months that a text asks for: ``3+ years`` has no high end, ``18 months`` two equal ones,
    ``1-2 years`` two; both null where it names none."""
    low, high = (F.regexp_extract(raw, EXPERIENCE, k).try_cast("int") for k in (1, 2))
    times = F.when(F.lower(F.regexp_extract(raw, EXPERIENCE, 3)).startswith("y"), 12).otherwise(1)
    open_ended = F.regexp_extract(raw, EXPERIENCE, 0).contains("+")
    return F.struct((low * times).alias("low"), F.when(~open_ended, F.coalesce(high, low) * times).alias("high"))


def months_of_experience(raw: Column) -> Column:
    """Least months that a text asks for; null where it names none."""
    return experience(raw)["low"]


def employment_kind(text: Column) -> Column:
    """The first kind of employment whose words a text has, else null."""
    from jobsluice.functions.text import delimited

    small = F.lower(text)
    return F.coalesce(*(F.when(small.rlike(delimited(p)), F.lit(name)) for name, p in KINDS))


def salary(raw: Column) -> Column:
    """struct(low, high, currency, period, yearly): pay such as ``$1,200.50 - $1,500 per month``; yearly is the low end."""
    amount = r"([$€£])\s*([0-9][0-9,]*(?:\.[0-9]+)?)"
    both = rf"{amount}(?:\s*-\s*[$€£]?\s*([0-9][0-9,]*(?:\.[0-9]+)?))?"
    number = lambda k: F.replace(F.regexp_extract(raw, both, k), F.lit(","), F.lit("")).try_cast("decimal(18,2)")
    low, high = number(2), number(3)
    period = F.lower(F.regexp_extract(raw, r"(?i)(?:per|an?|/)\s*(hour|day|week|month|year)", 1))
    times = F.coalesce(*(F.when(period == p, n) for p, n in PERIODS.items()))
    symbol = F.regexp_extract(raw, both, 1)
    currency = F.when(symbol == "$", "USD").when(symbol == "€", "EUR").when(symbol == "£", "GBP")
    return F.struct(low.alias("low"), F.coalesce(high, low).alias("high"), currency.alias("currency"), F.nullif(period, F.lit("")).alias("period"), (low * times).cast("decimal(18,2)").alias("yearly"))


def seniority(title: Column) -> Column:
    """The first level whose words a title has, else ``mid``."""
    from jobsluice.functions.text import delimited

    small = F.lower(title)
    return F.coalesce(*(F.when(small.rlike(delimited(p)), F.lit(name)) for name, p in LEVELS), F.lit("mid"))
