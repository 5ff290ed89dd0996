"""Numbers out of texts. Rounding is half to even; what does not parse is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veedor.functions.text import clean_text, col, first_present, strip


def _double(c: Column) -> Column:
    return c.try_cast("double")


def _long(c: Column) -> Column:
    return c.try_cast("bigint")


def round_even(c) -> Column:
    """Round to a whole number, halves to even."""
    return F.bround(col(c), 0).cast("bigint")


def number_thousands(c) -> Column:
    """First number of a text in which dots part thousands and a comma is the decimal sign."""
    plain = F.replace(F.replace(F.replace(col(c), F.lit(" "), F.lit(" ")), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return _double(F.nullif(F.regexp_extract(plain, r"(-?[0-9]+(?:\.[0-9]+)?)", 1), F.lit("")))


def int_thousands(c) -> Column:
    return round_even(number_thousands(c))


def first_number(c) -> Column:
    """First number of a text in which dot and comma are both decimal signs."""
    plain = F.replace(col(c), F.lit(","), F.lit("."))
    return _double(F.nullif(F.regexp_extract(plain, r"(-?[0-9]+(?:\.[0-9]+)?)", 1), F.lit("")))


def first_int(c) -> Column:
    return round_even(first_number(c))


def all_digits(c) -> Column:
    """All digits of a text as one number."""
    return _long(F.nullif(F.regexp_replace(col(c), "[^0-9]", ""), F.lit("")))


kilograms = all_digits


def millimetres(c) -> Column:
    """With ``mm`` all digits; else the first number, in metres if it is under 20."""
    n = first_number(c)
    plain = F.when(n < 20, round_even(n * 1000)).otherwise(round_even(n))
    return F.when(F.lower(col(c)).contains("mm"), F.coalesce(all_digits(c), plain)).otherwise(plain)


def cubic_centimetres(c) -> Column:
    """With ``cc`` all digits; else the first number, in litres if the text has an ``l``."""
    low, n = F.lower(col(c)), first_number(c)
    plain = F.when(low.contains("l"), round_even(n * 1000)).otherwise(round_even(n))
    return F.when(low.contains("cc"), F.coalesce(all_digits(c), plain)).otherwise(plain)


def years(c) -> Column:
    """First and last year of 1900 to 2099 that stands alone: struct ``first, last``."""
    found = F.regexp_extract_all(col(c), F.lit(r"(?U)\b((?:19|20)[0-9]{2})\b"), 1)
    return F.struct(_long(F.try_element_at(found, F.lit(1))).alias("first"), _long(F.try_element_at(found, F.lit(-1))).alias("last"))


def last_int(c) -> Column:
    """The last whole number of a text: ``3-5`` doors are 5."""
    return _long(F.try_element_at(F.regexp_extract_all(col(c), F.lit("([0-9]+)"), 1), F.lit(-1)))


def item(values, n: int) -> Column:
    """The n-th item of an array from 1, or null."""
    return F.try_element_at(col(values), F.lit(n))


def displacement(values) -> Column:
    """Struct ``cc, l`` from a pair such as ``1,9 Litro`` and ``1.896 cc``."""
    return F.struct(cubic_centimetres(first_present(item(values, 2), item(values, 1))).alias("cc"), first_number(item(values, 1)).alias("l"))


def pair(values) -> Column:
    """Numbers of both items: struct ``first, second``."""
    return F.struct(first_number(item(values, 1)).alias("first"), first_number(item(values, 2)).alias("second"))


def rpm(c) -> Column:
    """The number after ``@``, without separators."""
    return _long(F.nullif(F.regexp_replace(F.regexp_extract(col(c), r"@\s*([0-9.,]+)", 1), "[.,]", ""), F.lit("")))


def valves(c) -> Column:
    """Struct ``per_cylinder, total`` from a text such as ``2 (8v Total)``."""
    text = col(c)
    before = _long(F.nullif(F.regexp_extract(text, r"([0-9]+)\s*\(", 1), F.lit("")))
    return F.struct(F.coalesce(before, first_int(text)).alias("per_cylinder"), _long(F.nullif(F.regexp_extract(text, "(?i)([0-9]+)v", 1), F.lit(""))).alias("total"))


def bore_stroke(c) -> Column:
    """Struct ``bore, stroke, text`` from ``79,5 x 95,5 mm``."""
    text = clean_text(c)
    part = lambda k: _double(F.replace(F.nullif(F.regexp_extract(text, r"(?i)([0-9]+(?:[.,][0-9]+)?)\s*x\s*([0-9]+(?:[.,][0-9]+)?)", k), F.lit("")), F.lit(","), F.lit(".")))
    return F.struct(part(1).alias("bore"), part(2).alias("stroke"), text.alias("text"))


def ratio_and_label(values) -> Column:
    return F.struct(first_number(item(values, 1)).alias("ratio"), clean_text(item(values, 2)).alias("label"))


def gearbox(c) -> Column:
    """Struct ``label, gears``."""
    text = clean_text(c)
    return F.struct(text.alias("label"), first_int(text).alias("gears"))


def towing(c) -> Column:
    """Struct ``braked, unbraked``: of two numbers the second is braked; one alone is."""
    found = F.regexp_extract_all(F.replace(col(c), F.lit(","), F.lit(".")), F.lit(r"([0-9]+(?:\.[0-9]+)?)"), 1)
    first, second = _double(F.try_element_at(found, F.lit(1))), _double(F.try_element_at(found, F.lit(2)))
    return F.struct(F.coalesce(second, first).alias("braked"), F.when(second.isNotNull(), first).alias("unbraked"))


def drive_type(values) -> Column:
    """Struct ``code, label`` of a drive layout."""
    text = first_present(clean_text(item(values, 1)), clean_text(item(values, 2)))
    up = F.upper(text)
    both = lambda a, b: F.struct(a.alias("code"), b.alias("label"))
    # Codes and labels.
    return (
        F.when(up.contains("FWD") | up.contains("DELANTERA"), both(F.lit("FWD"), F.lit("Tracción Delantera")))
        .when(up.contains("RWD") | up.contains("TRASERA"), both(F.lit("RWD"), F.lit("Tracción Trasera")))
        .when(up.contains("AWD") | up.contains("4WD"), both(F.lit("AWD"), text))
        .otherwise(both(text, text))
    )


def lenient_double(c) -> Column:
    """A number written in full, blanks around it allowed; NaN and unparsable texts are null."""
    text = strip(c)
    plain = text.rlike(r"^[+-]?([0-9]+(_[0-9]+)*\.?([0-9]+(_[0-9]+)*)?|\.[0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+)?$")
    infinite = text.rlike(r"(?i)^[+-]?inf(inity)?$")
    value = _double(F.replace(text, F.lit("_"), F.lit("")))
    return F.when(plain | infinite, value)
