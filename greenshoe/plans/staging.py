"""Staging views over the raw layer."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenshoe.functions.valuation import final_price
from greenshoe.operators.latest import latest_by, newest
from greenshoe.schemas import FILING_INDEX

FILING_COLUMNS = FILING_INDEX.names


def stg_companies(companies: DataFrame) -> DataFrame:
    return companies.where(F.col("sic_code").isNotNull()).select(
        "cik",
        "company_name",
        "sic_code",
        "sic_description",
        "state_of_incorp",
        "fiscal_year_end",
    )


def stg_prospectus_filings(filings: DataFrame, columns: list[str] = FILING_COLUMNS) -> DataFrame:
    """The last ingested row of every filing.

    With the first few of the columns only, the others are neither read nor shuffled. Ties are
    broken column by column, so these hold the same values as in the whole view.
    """
    rows = filings.select(*columns, "ingested_at")
    return latest_by(rows, ["accession_number"], [newest("ingested_at")]).select(*columns)


def stg_offering_terms(terms: DataFrame) -> DataFrame:
    """The last extraction of every filing, with final price and gross proceeds."""
    price = final_price(F.col("price_low"), F.col("price_high"))
    return latest_by(terms, ["accession_number"], [newest("extracted_at")]).select(
        "cik",
        "accession_number",
        "offering_type",
        "shares_offered",
        "price_low",
        "price_high",
        price.alias("final_price"),
        (F.col("shares_offered") * price).alias("gross_proceeds"),
        "extraction_method",
    )
