"""Tolerant text parsers as Column expressions.

Everything stays inside generated code: no higher-order functions and no
Python UDFs, and every cast is a ``try_`` cast so that ANSI mode never throws.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WHITESPACE = " \t\n\r\f\x0b"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?([iI][nN][fF]|[iI][nN][fF][iI][nN][iI][tT][yY])$"
INTEGER = r"^[+-]?[0-9]+$"
SLASHED, EIGHT_DIGITS = r"^[0-9]{2}/[0-9]{2}/[0-9]{4}\z", r"^[0-9]{8}\z"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    """Null, or nothing but whitespace."""
    return text.isNull() | (strip(text) == "")


def parse_date(text: Column) -> Column:
    """DD/MM/YYYY when a slash is present, eight digits as YYYYMMDD, else null.

    Two digits, two and four are turned round and cast, which costs a tenth of
    a format.  Other texts with a slash, such as 1/2/2024, are left to the
    format.
    """
    day = strip(text)
    part = lambda at, n: F.substring(day, at, n)
    cast = lambda *parts: F.concat_ws("-", *parts).try_cast("date")
    return (
        F.when(day.rlike(SLASHED), cast(part(7, 4), part(4, 2), part(1, 2)))
        .when(day.rlike(EIGHT_DIGITS), cast(part(1, 4), part(5, 2), part(7, 2)))
        .when(day.contains("/"), F.try_to_date(day, "d/M/yyyy"))
    )


def decimal_text(text: Column) -> Column:
    """With a comma the dots are thousands marks; without one a dot is the decimal point."""
    number = strip(text)
    swapped = F.replace(F.replace(number, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.when(number.contains(","), swapped).otherwise(number)


def is_number(text: Column) -> Column:
    return F.coalesce(decimal_text(text).rlike(NUMBER), F.lit(False))


def parse_decimal(text: Column, declared: str) -> Column:
    """Decimal of the declared type; junk and overflow are null.

    Blanks are common and are kept from the cast, where a failed conversion
    costs an exception.
    """
    number = decimal_text(text)
    return F.when(number != "", number.try_cast(declared))


def parse_int(text: Column, declared: str = "int") -> Column:
    number = strip(text)
    return F.when(number.rlike(INTEGER), number.try_cast(declared))


def is_yes_letter(flag: Column, letter: str) -> Column:
    return F.coalesce(flag == letter, F.lit(False))


def is_yes_word(flag: Column, words: list[str]) -> Column:
    return F.coalesce(flag.isin(words), F.lit(False))


def month_start(month: Column) -> Column:
    """YYYYMM to the first day of that month; null when it is no month."""
    return F.try_to_date(F.concat(month, F.lit("01")), "yyyyMMdd")
