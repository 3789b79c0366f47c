"""Text forms used by reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_text(share: Column, decimals: int = 2) -> Column:
    """A share as percent text, rounded half to even on the binary value."""
    pattern = "0." + "0" * decimals if decimals else "0"
    return F.concat(F.call_function("format_number", share * 100, F.lit(pattern)), F.lit("%"))


def run_name(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd_HHmmss'hs'")


def hours_minutes_seconds(seconds: Column) -> tuple[Column, Column, Column]:
    whole = F.floor(seconds).cast("bigint")
    return (
        F.floor(whole / 3600).cast("bigint"),
        F.floor(F.pmod(whole, F.lit(3600)) / 60).cast("bigint"),
        F.pmod(whole, F.lit(60)).cast("bigint"),
    )
