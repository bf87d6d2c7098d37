"""Column-level parsing helpers (all JVM-side built-ins, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from navforge.specs import DATE_FORMAT


def trimmed(name: str, alias: str | None = None) -> Column:
    """ASCII-space trim; tabs and newlines stay, as with SQL ``trim``."""
    return F.trim(F.col(name)).alias(alias or name)


def parse_timestamp(col: str | Column, fmt: str = DATE_FORMAT) -> Column:
    """Strict pattern parse; NULL (never an error) for text that does not fit."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(c, F.lit(fmt))


def parse_decimal(col: str | Column, precision: int, scale: int,
                  decimal_comma: bool = False) -> Column:
    """Text to DECIMAL(p,s); NULL for unparsable or overflowing text.

    ``try_cast`` keeps the intended NULL-on-failure behaviour under ANSI mode
    (a plain cast would abort the job).  With ``decimal_comma`` every ','
    becomes '.', so ``1234,50`` parses and ``1.234,50`` does not.
    """
    c = F.col(col) if isinstance(col, str) else col
    if decimal_comma:
        c = F.translate(c, ",", ".")
    return c.try_cast(f"decimal({precision},{scale})")
