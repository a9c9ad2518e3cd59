"""Ranges written as `lo:hi`, and distance of a value from its limits."""

from pyspark.sql import Column, functions as F


def range_around(value: Column, low: float = 0.8, high: float = 1.2) -> Column:
    return F.struct((value * low).alias("lo"), (value * high).alias("hi"))


def range_text(value: Column, low: float = 0.8, high: float = 1.2) -> Column:
    """Text form of the range; a missing value leaves both sides empty."""
    low_text = F.coalesce((value * low).cast("string"), F.lit(""))
    high_text = F.coalesce((value * high).cast("string"), F.lit(""))
    return F.concat(low_text, F.lit(":"), high_text)


def _side(text: Column, index: int) -> Column:
    part = F.trim(F.split_part(text, F.lit(":"), F.lit(index + 1)))
    return F.nullif(part, F.lit("")).try_cast("double")


def parse_range(text: Column, policy: str = "open") -> Column:
    """`lo:hi` as a struct. An empty side is unbounded (open), 0 (zero) or absent (skip);
    under the open policy an empty text is no range at all."""
    lo, hi = _side(text, 0), _side(text, 1)
    if policy == "open":
        bounded = F.struct(
            F.coalesce(lo, F.lit(float("-inf"))).alias("lo"), F.coalesce(hi, F.lit(float("inf"))).alias("hi")
        )
        return F.when(F.length(F.trim(text)) > 0, bounded)
    if policy == "zero":
        filled = F.struct(F.coalesce(lo, F.lit(0.0)).alias("lo"), F.coalesce(hi, F.lit(0.0)).alias("hi"))
        return F.when(text.isNotNull(), filled)
    if policy == "skip":
        return F.when(text.isNotNull(), F.struct(lo.alias("lo"), hi.alias("hi")))
    raise ValueError(f"unknown policy: {policy}")


def limit_zone(value: Column, lo: Column, hi: Column, margin: float = 0.1) -> Column:
    """below / above / near / inside. `near` is within the margin (a share of the limit) of a limit."""
    return (
        F.when(value.isNull(), F.lit(None).cast("string"))
        .when(value < lo, F.lit("below"))
        .when(value > hi, F.lit("above"))
        .when((value <= lo + F.abs(lo) * margin) | (value >= hi - F.abs(hi) * margin), F.lit("near"))
        .otherwise(F.lit("inside"))
    )
