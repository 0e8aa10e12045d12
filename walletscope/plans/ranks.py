"""Exact percentiles of a whole-number column by counting, with no task that sees all values."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, floor

from pyspark.sql import DataFrame, functions as F

BITS = 14  # a pass counts some 2 ** BITS cells, and as many numbers reach the driver


def percentiles(df: DataFrame, column: str, shares: Sequence[float], bits: int = BITS) -> list[float | None]:
    """What ``F.percentile`` gives, which keeps every distinct value in one task; NULLs do not count.

    A pass counts the values by their upper bits, and the next one looks into the cells that hold a
    rank in question only: five passes at most, two or three for usual numbers.
    """
    value = F.col(column).cast("bigint")
    known = df.where(value.isNotNull())
    n, lo, hi = known.agg(F.count(F.lit(1)), F.min(value), F.max(value)).first()
    if not n:
        return [None] * len(shares)
    places = [share * (n - 1) for share in shares]
    found = {rank: rank for place in places for rank in (floor(place), ceil(place))}  # ranks within their cells
    shift = max(0, ((lo ^ hi) if (lo < 0) == (hi < 0) else 2 ** 64 - 1).bit_length() - bits)
    cells = dict.fromkeys(found)
    while True:
        parent = F.shiftright(value, min(shift + bits, 63))
        some = {c for c in cells.values() if c is not None}
        rows = known.where(parent.isin(*some)) if some else known
        counted = rows.groupBy(F.shiftright(value, shift).alias("cell")).count().orderBy("cell").collect()
        for rank in found:
            for r in counted:
                if cells[rank] is not None and r["cell"] >> (min(shift + bits, 63) - shift) != cells[rank]:
                    continue
                if found[rank] < r["count"]:
                    cells[rank] = r["cell"]
                    break
                found[rank] -= r["count"]
        if not shift:
            break
        # The next pass must begin where this one's cells end.
        step = min(bits, shift)
        shift, bits = shift - step, step
    at = {rank: float(cells[rank]) for rank in found}
    return [at[floor(p)] if floor(p) == ceil(p) else (ceil(p) - p) * at[floor(p)] + (p - floor(p)) * at[ceil(p)] for p in places]
