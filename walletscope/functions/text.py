"""Text clean-up and the fixed sentence forms."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def sanitize_json(body: Column) -> Column:
    """Drop the escapes and raw forms of U+0000 and U+0001, which text columns reject."""
    for code in (0, 1):
        body = F.replace(body, F.lit(f"\\u{code:04d}"), F.lit(""))
        body = F.replace(body, F.chr(F.lit(code)), F.lit(""))
    return body


def short_address(address: Column, width: int = 10) -> Column:
    return F.when(F.length(address) > width, F.concat(F.left(address, F.lit(width)), F.lit("..."))
                  ).otherwise(address)


def transfer_text(direction: Column, source: Column, destination: Column) -> Column:
    return F.when(direction == "IN", F.concat(F.lit("Received from "), short_address(source))
                  ).otherwise(F.concat(F.lit("Sent to "), short_address(destination)))


def plain_amount(amount: Column) -> Column:
    """Decimal as text without trailing zeros (``150``, ``123.45``)."""
    return F.rtrim(F.rtrim(amount.cast("decimal(38,9)").cast("string"), F.lit("0")), F.lit("."))
