"""Pay read out of free text, and pay made comparable; all built-in expressions.

Where a text names no pay every part is null. Bounds come back in order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .postings import european_amount

# What a figure is multiplied by to be a year's, and what a unit of a currency is in US dollars.
PER_YEAR = (("hourly", 2080.0), ("daily", 260.0), ("weekly", 52.0), ("monthly", 12.0), ("yearly", 1.0))
USD_RATES = (
    ("USD", 1.0), ("GBP", 1.3240), ("DZD", 0.007462), ("MUR", 0.02077), ("CNY", 0.1492), ("EGP", 0.01868297436), ("SAR", 0.2666666667), ("AED", 0.2722940776), ("GEL", 0.3850574602),
    ("AZN", 0.5886196281), ("MYR", 0.2450040609), ("ZAR", 0.0608742393), ("IRT", 6.036086175e-07), ("NPR", 0.00746), ("THB", 0.0274), ("CAD", 0.735), ("BDT", 0.0082), ("BTN", 0.011940),
    ("QAR", 0.2747252747), ("KRW", 0.00072), ("UYU", 0.023), ("MMK", 0.00048), ("XOF", 0.0016), ("LKR", 0.00300818), ("CDF", 0.00043257), ("CHF", 1.1856250), ("MNT", 0.00029412),
)

# Patterns, markers and words of pay in texts.
USD_RANGE = r"^\$\s*([\d,]+)\s*([kK])?\s*(?:-|–|to)\s*\$?\s*([\d,]+)\s*([kK])?\s*$"
ANNUAL_MARKERS = ("a year", "per year", "annually", "/yr", "/year")
DOLLARS = r"\$([\d,]+(?:\.\d+)?)"
EASTERN_DIGITS, WESTERN_DIGITS = "۰۱۲۳۴۵۶۷۸۹٠١٢٣٤٥٦٧٨٩", "01234567890123456789"
MAGNITUDES = (("میلیارد", 1_000_000_000), ("میلیون", 1_000_000), ("هزار", 1_000))
HIDDEN_MARKERS = ("לא צוין", "בתיאום")
MONTH_WORDS, YEAR_WORDS = ("לחודש", "בחודש", "חודשי", "monthly"), ("לשנה", "בשנה", "שנתי", "yearly", "year")
PLAIN_RANGE, PLAIN_SINGLE = r"(\d[\d,]*)\s*[–\-−]\s*(\d[\d,]*)", r"(\d[\d,]+)"

#: An annual minimum below this, or a maximum over so many times the minimum, is looked at again.
LEAST_ANNUAL, MOST_SPREAD = 1000, 5


def annual_usd(amount: Column, currency: Column, period: Column) -> Column:
    """A year's pay in US dollars, to the cent; null for a currency or period that is not known. Currencies count in any case, periods do not."""
    times = F.try_element_at(F.create_map(*[F.lit(x) for pair in PER_YEAR for x in pair]), period)
    rate = F.try_element_at(F.create_map(*[F.lit(x) for pair in USD_RATES for x in pair]), F.upper(currency))
    return F.floor(amount.cast("double") * times * rate * 100 + 0.5) / 100


def anomaly(low: Column, high: Column) -> Column:
    """Why a disclosed annual pay looks wrong; empty if it does not."""
    spread = F.concat(F.lit("min/max spread is "), F.bround(high / low, 0).cast("long").cast("string"), F.lit("x - check pay-period/currency conversion"))
    missing = low.isNull() | high.isNull() | F.isnan(low) | F.isnan(high)
    return F.when(missing, "missing normalized value despite salary_disclosed=true").when(low < LEAST_ANNUAL, "implausibly low for an annual figure - likely un-annualized rate").when((low > 0) & (high / low > MOST_SPREAD), spread).otherwise("")


def _whole(digits: Column) -> Column:
    return F.replace(digits, F.lit(","), F.lit("")).try_cast("long")


def _ordered(a: Column, b: Column) -> tuple[Column, Column]:
    """Both in order, a missing one staying where it is."""
    swap = F.coalesce(a > b, F.lit(False))
    return F.when(swap, b).otherwise(a), F.when(swap, a).otherwise(b)


def dollar_range(text: Column) -> tuple[Column, Column]:
    """`$80k - $120,000`; anything else that is not two such figures alone gives nulls."""
    own = F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    part = lambda k: F.nullif(F.regexp_extract(own, USD_RANGE, k), F.lit(""))
    figure = lambda digits, kilo: _whole(part(digits)) * F.when(part(kilo).isNotNull(), 1000).otherwise(1)
    return _ordered(figure(1, 2), figure(3, 4))


def annual_dollars(text: Column) -> tuple[Column, Column]:
    """The least and the greatest `$` figure of a text that says it is a year's, cents cut off."""
    says = F.lit(False)
    for marker in ANNUAL_MARKERS:
        says = says | F.lower(text).contains(marker)
    amounts = F.transform(F.regexp_extract_all(text, F.lit(DOLLARS), F.lit(1)), lambda x: F.floor(F.replace(x, F.lit(","), F.lit("")).try_cast("double")).cast("long"))
    amounts = F.when(says, F.filter(amounts, lambda x: x.isNotNull()))
    return F.array_min(amounts), F.array_max(amounts)


def shown_bounds(low: Column, high: Column, show_low: Column, show_high: Column) -> tuple[Column, Column]:
    """European amounts of which a source hides either with the flag 0."""
    hidden = lambda flag: F.trim(F.coalesce(flag, F.lit("1"))) == "0"
    return _ordered(F.when(~hidden(show_low), european_amount(low)), F.when(~hidden(show_high), european_amount(high)))


def _numbers(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"\d[\d,]*"), F.lit(0)), _whole)


def persian_range(text: Column) -> tuple[Column, Column]:
    """Figures in eastern or western digits, all scaled by the greatest magnitude that the text names; a single one is a minimum."""
    plain = F.translate(text, EASTERN_DIGITS, WESTERN_DIGITS)
    scale = F.lit(None).cast("long")
    for word, factor in MAGNITUDES:
        scale = F.coalesce(scale, F.when(plain.contains(word), F.lit(factor).cast("long")))
    scale = F.coalesce(scale, F.lit(1).cast("long"))
    found = F.filter(_numbers(plain), lambda n: n > 0)
    return F.array_min(found) * scale, F.when(F.size(found) >= 2, F.array_max(found) * scale)


def hebrew_range(text: Column) -> tuple[Column, Column, Column]:
    """Minimum, maximum and period: the first two figures in order, one alone being both; nulls where pay is withheld."""
    withheld = F.lit(False)
    for marker in HIDDEN_MARKERS:
        withheld = withheld | text.contains(marker)
    found = F.filter(F.slice(_numbers(text), 1, 4), lambda n: n.isNotNull())
    two = F.when(~withheld & (F.size(found) > 0), F.slice(found, 1, 2))
    named = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: text.contains(w))
    return F.array_min(two), F.array_max(two), F.when(two.isNotNull(), F.when(named(MONTH_WORDS), "monthly").when(named(YEAR_WORDS), "yearly"))


def plain_range(text: Column) -> tuple[Column, Column]:
    """The first `a - b` of a text, in order, else its first figure of two digits or more as both."""
    part = lambda pattern, k: _whole(F.nullif(F.regexp_extract(text, pattern, k), F.lit("")))
    low, high = _ordered(part(PLAIN_RANGE, 1), part(PLAIN_RANGE, 2))
    single = part(PLAIN_SINGLE, 1)
    return F.coalesce(low, single), F.coalesce(high, single)


def grouped_number(token: Column) -> Column:
    """A figure of which dots group thousands (`610.001`), else as it stands; null unless it is finite."""
    own = F.trim(token)
    value = F.when(own.rlike(r"^\d{1,3}(\.\d{3})+$"), F.replace(own, F.lit("."), F.lit(""))).otherwise(own).try_cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def configured_range(text: Column, pattern: str, groups: dict[str, int]) -> tuple[Column, Column, Column, Column]:
    """Minimum, maximum, currency and unit by a site's own pattern, of which `groups` numbers the parts min, max, currency, unit that it has."""
    part = lambda name: F.nullif(F.regexp_extract(text, pattern, groups[name]), F.lit("")) if name in groups else F.lit(None).cast("string")
    low, high = grouped_number(part("min")), grouped_number(part("max"))
    low, high = _ordered(F.coalesce(low, high), F.coalesce(high, low))
    word = lambda name: F.when(low.isNotNull(), F.nullif(F.upper(F.trim(part(name))), F.lit("")))
    return low, high, F.when(word("currency").rlike("^[A-Z]{3}$"), word("currency")), word("unit")
