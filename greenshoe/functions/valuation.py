"""Scalar expressions of the mart: sector, prices, ratios, periods, flags."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from greenshoe import fixed_values as V


def sector(sic_code: Column) -> Column:
    """Sector of a code by string comparison, NULL for no code at all."""
    rules = F.when(sic_code.isNull(), F.lit(None).cast("string"))
    for low, high, name in V.SECTOR_RULES:
        rules = rules.when(sic_code.between(low, high), name)
    return rules.otherwise(V.OTHER_SECTOR)


def final_price(low: Column, high: Column) -> Column:
    return F.coalesce((low + high) / 2, low, high)


def market_cap(outstanding: Column, offered: Column, price: Column) -> Column:
    """Shares outstanding of 0 is a figure, only NULL falls back to the shares offered."""
    return F.coalesce(outstanding, offered) * price


def price_to_sales(cap: Column, revenue: Column) -> Column:
    return F.when(revenue > 0, cap / revenue)


def quarter_start(day: Column) -> Column:
    return F.trunc(day, "quarter")


def year_start(day: Column) -> Column:
    return F.trunc(day, "year")


def valuation_flag(ratio: Column, median: Column) -> Column:
    return (
        F.when(ratio.isNull(), V.FLAG_NO_REVENUE)
        .when(ratio > median * V.RICH_FACTOR, V.FLAG_RICH)
        .when(ratio < median * V.CHEAP_FACTOR, V.FLAG_CHEAP)
        .otherwise(V.FLAG_IN_LINE)
    )
