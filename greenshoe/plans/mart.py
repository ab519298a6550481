"""The fact table of priced IPOs and what it is made of."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenshoe import fixed_values as V
from greenshoe.functions import valuation as X
from greenshoe.operators.latest import latest_by, newest
from greenshoe.operators.median import exact_median
from greenshoe.operators.skew import ROWS_PER_PART, hot_keys, lookup_join
from greenshoe.plans import staging
from greenshoe.schemas import FCT_IPO_OFFERINGS
from greenshoe.session import materialize

FACT_FILING_COLUMNS = ["cik", "company_name", "filing_date", "accession_number"]


def ipo_terms(stg_terms: DataFrame) -> DataFrame:
    """Priced IPOs. Filters the latest terms: an IPO re-classified later is out."""
    return stg_terms.where(
        (F.col("offering_type") == V.IPO)
        & F.col("final_price").isNotNull()
        & F.col("shares_offered").isNotNull()
    )


def latest_financials(financials: DataFrame) -> DataFrame:
    """Per company the latest financials among those with revenue."""
    columns = ["cik", "fiscal_year_end", "trailing_revenue", "shares_outstanding"]
    positive = financials.where(F.col("trailing_revenue") > 0).select(*columns)
    return latest_by(positive, ["cik"], [newest("fiscal_year_end")]).drop("fiscal_year_end")


def sector_map(stg_companies: DataFrame) -> DataFrame:
    return stg_companies.select(
        "cik", "sic_code", "sic_description", X.sector(F.col("sic_code")).alias("sector")
    )


def filings_with_terms(stg_filings: DataFrame, terms: DataFrame) -> DataFrame:
    """Inner join on filing and company; terms stored under another company are dropped.

    Both sides come out of their de-duplication partitioned and sorted by accession number.
    Only that column is an equi-key here, and the company is compared by range, so that Spark
    keeps this partitioning and does not shuffle both sides a second time.
    """
    t = terms.withColumnRenamed("cik", "_terms_cik")
    joined = stg_filings.join(t, "accession_number")
    same_company = (F.col("cik") <= F.col("_terms_cik")) & (F.col("cik") >= F.col("_terms_cik"))
    return joined.where(same_company).drop("_terms_cik")


def mart_base(
    filings: DataFrame,
    terms: DataFrame,
    companies: DataFrame,
    financials: DataFrame,
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """The fact table without the sector benchmark, from the four raw tables."""
    offerings = filings_with_terms(
        staging.stg_prospectus_filings(filings, FACT_FILING_COLUMNS),
        ipo_terms(staging.stg_offering_terms(terms)),
    )
    # Both dimensions hold about one row per company. Joined to each other first, they cost the
    # filings a single shuffle. A company with very many filings is dealt to several tasks; the
    # raw filings bound how many there can be.
    dimensions = sector_map(staging.stg_companies(companies)).join(
        latest_financials(financials), "cik", "full"
    )
    hot = hot_keys(filings, "cik", rows_per_part)
    cap = X.market_cap(F.col("shares_outstanding"), F.col("shares_offered"), F.col("final_price"))
    return lookup_join(offerings, dimensions, "cik", hot).select(
        "cik",
        "company_name",
        "filing_date",
        "accession_number",
        "sic_code",
        "sic_description",
        "sector",
        "shares_offered",
        "final_price",
        "gross_proceeds",
        "extraction_method",
        "trailing_revenue",
        "shares_outstanding",
        cap.alias("implied_market_cap"),
        X.price_to_sales(cap, F.col("trailing_revenue")).alias("price_to_sales_ratio"),
        X.quarter_start(F.col("filing_date")).alias("filing_quarter"),
        X.year_start(F.col("filing_date")).alias("filing_year"),
    )


def sector_benchmark(base: DataFrame) -> DataFrame:
    """Mean and exact median price-to-sales of every sector that has a ratio."""
    return exact_median(base, "sector", "price_to_sales_ratio").select(
        "sector",
        F.col("mean").alias("sector_avg_ps"),
        F.col("median").alias("sector_median_ps"),
    )


def with_benchmark(base: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """The base, or just ``rows`` of it, with benchmark and flag.

    Companies without a sector are a group of their own.
    """
    # One row per sector of the fixed rules and one for no sector: always small.
    benchmark = sector_benchmark(base).withColumnRenamed("sector", "_sector")
    joined = (base if rows is None else rows).join(
        F.broadcast(benchmark), F.col("sector").eqNullSafe(F.col("_sector")), "left"
    )
    flag = X.valuation_flag(F.col("price_to_sales_ratio"), F.col("sector_median_ps"))
    return joined.withColumn("valuation_flag", flag).select(*FCT_IPO_OFFERINGS.names)


def fct_ipo_offerings(
    filings: DataFrame, terms: DataFrame, companies: DataFrame, financials: DataFrame
) -> DataFrame:
    """The fact table. The base is written once, as the benchmark reads two columns of it twice."""
    base = materialize(mart_base(filings, terms, companies, financials), "mart-base")
    return with_benchmark(base)
