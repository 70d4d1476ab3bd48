"""Address and phone parsing on built-in string functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Trailing house number (with an optional second number after a
# slash), and the number of digits of a national phone number.
HOUSE_NUMBER_AT_END = r"(\d+[A-Za-z]?(\s*/\s*\d+[A-Za-z]?)?)\s*$"
NATIONAL_DIGITS = 9


def token(text: Column, separator: str, position: int) -> Column:
    """Part of a separated text, NULL where there are fewer parts."""
    return F.get(F.split(text, separator), F.lit(position))


def address_parts(address: Column, trimmed: bool) -> tuple[Column, Column, Column]:
    """Street line, city and postal code of ``street, city, zip``."""
    street, city, postal = (token(address, ",", i) for i in range(3))
    if trimmed:
        city, postal = F.trim(city), F.trim(postal)
    return street, city, postal


def first_word_street(street_line: Column, keep_number: bool) -> tuple[Column, Column]:
    """Street name and house number as the first two words of the street line.

    With ``keep_number=False`` the number is always NULL: the original looks
    for a second word after it has cut the line down to its first.
    """
    number = token(street_line, " ", 1) if keep_number else F.lit(None).cast("string")
    return token(street_line, " ", 0), number


def trailing_number_street(street_line: Column) -> tuple[Column, Column]:
    """Street name and house number, the number being what ends the line."""
    name = F.trim(F.regexp_replace(street_line, HOUSE_NUMBER_AT_END, ""))
    number = F.trim(F.regexp_extract(street_line, HOUSE_NUMBER_AT_END, 1))
    return name, number


def phone_parts(phone: Column) -> tuple[Column, Column]:
    """Dialling prefix (NULL when there is none) and the last nine characters."""
    compact = F.regexp_replace(phone, " ", "")
    prefix = F.when(F.length(compact) > NATIONAL_DIGITS, token(phone, " ", 0))
    return prefix, F.substring(compact, -NATIONAL_DIGITS, NATIONAL_DIGITS)
