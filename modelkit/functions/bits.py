"""32-bit activity masks: the most significant of 32 bits is the snapshot day, one bit per day back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 32
# Masks over the 32 bits, newest day first.
LAST_7_DAYS = 0b11111110000000000000000000000000
PREVIOUS_7_DAYS = 0b00000001111111000000000000000000
LAST_DAY = 0b10000000000000000000000000000000
ALL_DAYS = 0b11111111111111111111111111111111


def datelist_int(days: Column, as_of: Column, literal: bool = False) -> Column:
    """Fold an array of dates into a mask held in a bigint. Days outside the window are ignored.

    ``literal=True`` shifts by 32 instead of 31 and keeps the low 32 bits, so the snapshot day falls
    out of the mask and each older day moves up by one.
    """
    top = WIDTH if literal else WIDTH - 1
    in_window = F.filter(F.array_distinct(days), lambda d: F.datediff(as_of, d).between(0, top))
    mask = F.aggregate(
        in_window,
        F.lit(0).cast("long"),
        lambda acc, d: acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.lit(top) - F.datediff(as_of, d))),
    )
    return mask.bitwiseAND(F.lit(ALL_DAYS)) if literal else mask


def bit_text(mask: Column) -> Column:
    return F.lpad(F.bin(mask), WIDTH, "0")


def datelist_metrics(df: DataFrame, mask: str = "datelist_int") -> DataFrame:
    """Activity flags and counts from the mask; narrow, no shuffle."""
    m = F.col(mask)

    def active(bits: int) -> Column:
        return F.bit_count(m.bitwiseAND(F.lit(bits).cast("long"))).cast("long")

    return df.withColumns(
        {
            "monthly_active": active(ALL_DAYS) > 0,
            "l32": active(ALL_DAYS),
            "weekly_active": active(LAST_7_DAYS) > 0,
            "l7": active(LAST_7_DAYS),
            "weekly_active_previous_week": active(PREVIOUS_7_DAYS) > 0,
            "daily_active": active(LAST_DAY) > 0,
        }
    )
