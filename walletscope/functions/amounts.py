"""Exact integer and decimal handling of dirty text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from walletscope import params


INTEGER = r"^\s*([+-]?[0-9]+)\s*$"


def canonical_integer(value: Column) -> Column:
    """Integer text of any width without plus sign or leading zeros; ``0`` if unparseable."""
    digits = F.regexp_extract(value, r"^\s*[+-]?0*([0-9]+)\s*$", 1)
    negative = value.rlike(r"^\s*-") & (digits != "0")
    return F.when(F.coalesce(digits, F.lit("")) == "", F.lit("0")).otherwise(
        F.concat(F.when(negative, F.lit("-")).otherwise(F.lit("")), digits)
    )


def units(digits: Column, nano_per_unit: int = params.NANO_PER_UNIT) -> Column:
    """Nano amount text to whole units, exact ``decimal(38,9)``; NULL beyond 96-bit decimals.

    The dividend has 29 digits: a wider one would make Spark drop the scale to 6.
    """
    nano = digits.try_cast("decimal(29,0)")
    limit = F.lit(params.MAX_DECIMAL_UNITS).cast("decimal(29,0)")
    quotient = nano / F.lit(nano_per_unit).cast("decimal(10,0)")
    return F.when(F.abs(nano) <= limit, quotient).cast("decimal(38,9)")
