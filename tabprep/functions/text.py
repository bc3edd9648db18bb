"""Column expressions for text repair. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def format_ssn(digits: Column) -> Column:
    """Nine digits to ``XXX-XX-XXXX``."""
    return F.concat_ws("-", digits.substr(1, 3), digits.substr(4, 2), digits.substr(6, 4))


def canonical_ssn(ssn: Column) -> Column:
    """Hyphenated values stay, plain ones are formatted, null stays null."""
    return F.when(ssn.isNull() | ssn.contains("-"), ssn).otherwise(format_ssn(ssn))


def title_case(text: Column) -> Column:
    """First letter of each space-separated word in upper case, the rest in lower case."""
    return F.initcap(text)


def strip_currency(text: Column, symbols: str = "$,") -> Column:
    """Remove currency and grouping symbols."""
    return F.translate(text, symbols, "")


def currency_to_double(text: Column, symbols: str = "$,") -> Column:
    """Currency text to a number; text that is no number becomes null."""
    return strip_currency(text, symbols).try_cast("double")


def fixed_decimal_text(number: Column, digits: int = 2) -> Column:
    """A number as text with a fixed count of decimals.

    Plain double-to-text depends on magnitude (``1.0E7``) and on the inferred
    type (``1000`` or ``1000.0``), so equal amounts would hash differently.
    """
    return number.cast(f"decimal(38,{digits})").cast("string")


def anonymize(text: Column, salt: str | None = None) -> Column:
    """SHA-256 in hexadecimal, optionally salted."""
    return F.sha2(text if salt is None else F.concat(F.lit(salt), text), 256)
