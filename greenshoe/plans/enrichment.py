"""Financials of companies whose offering lies back half a year or more."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenshoe import fixed_values as V
from greenshoe.operators.semi_join import semi_join
from greenshoe.schemas import POST_IPO_FINANCIALS
from greenshoe.sources.landed import answered, company_facts


def eligible_ciks(mart: DataFrame, as_of: date) -> DataFrame:
    latest = F.add_months(F.lit(as_of), -V.ENRICHMENT_AGE_MONTHS)
    return mart.where(F.col("filing_date") <= latest).select("cik").distinct()


def eligible_facts(landed: DataFrame, ciks: DataFrame) -> DataFrame:
    """Landed rows of eligible companies; bodies of other companies are not shuffled."""
    return semi_join(landed, ciks, "cik")


def post_ipo_financials(landed: DataFrame) -> DataFrame:
    """One row per answered company that has revenue.

    A company whose chosen fact lacks its figure is left out whole.
    """
    found = company_facts(answered(landed))
    broken = (F.col("shares").isNotNull() & F.col("shares.value").isNull()) | (
        F.col("year_end").isNotNull() & F.col("year_end.value").isNull()
    )
    return found.where(F.col("revenue.value").isNotNull() & ~broken).select(
        "cik",
        F.col("year_end.value").alias("fiscal_year_end"),
        F.col("revenue.value").alias("trailing_revenue"),
        F.col("shares.value").alias("shares_outstanding"),
        F.col("revenue.tag").alias("revenue_tag"),
    )


def enrich(landed: DataFrame, mart: DataFrame, as_of: date) -> DataFrame:
    """The weekly batch. Bodies are parsed first, so the join shuffles five short columns."""
    financials = post_ipo_financials(landed).select(*POST_IPO_FINANCIALS.names)
    return financials.join(eligible_ciks(mart, as_of), "cik", "left_semi")
