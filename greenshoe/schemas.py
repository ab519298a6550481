"""Explicit schemas for every table the jobs read or write; nothing is inferred."""

from pyspark.sql import types as T


def _struct(**columns) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


STRING, LONG, DOUBLE = T.StringType(), T.LongType(), T.DoubleType()
DATE, TIMESTAMP, INT = T.DateType(), T.TimestampType(), T.IntegerType()
MONEY = T.DecimalType(18, 2)

# --- landed responses -----------------------------------------------------------------------
FILING_INDEX = _struct(
    cik=STRING,
    company_name=STRING,
    filing_date=DATE,
    accession_number=STRING,
    form_type=STRING,
    filing_url=STRING,
)
LANDED_BODY = _struct(cik=STRING, http_status=INT, body=STRING, landed_at=TIMESTAMP)
# Bodies of company facts as they are kept once they are parsed.
PARSED_BODY = T.StructType(LANDED_BODY.fields + [T.StructField("parsed", T.VariantType())])
LANDED_DOCUMENT = _struct(
    cik=STRING, accession_number=STRING, filing_date=DATE, http_status=INT, html=STRING
)
EXTRACTED = _struct(
    cik=STRING,
    accession_number=STRING,
    filing_date=DATE,
    cover=STRING,
    offering_type=STRING,
    shares_offered=LONG,
    price_low=DOUBLE,
    price_high=DOUBLE,
    extraction_method=STRING,
)
FALLBACK_RESPONSES = _struct(accession_number=STRING, raw=STRING, landed_at=TIMESTAMP)

# --- raw layer --------------------------------------------------------------------------------
COMPANIES = _struct(
    cik=STRING,
    company_name=STRING,
    sic_code=STRING,
    sic_description=STRING,
    state_of_incorp=STRING,
    fiscal_year_end=STRING,
    ingested_at=TIMESTAMP,
)
PROSPECTUS_FILINGS = T.StructType(FILING_INDEX.fields + [T.StructField("ingested_at", TIMESTAMP)])
OFFERING_TERMS = _struct(
    cik=STRING,
    accession_number=STRING,
    offering_type=STRING,
    shares_offered=LONG,
    price_low=MONEY,
    price_high=MONEY,
    extraction_method=STRING,
    extracted_at=TIMESTAMP,
)
POST_IPO_FINANCIALS = _struct(
    cik=STRING,
    fiscal_year_end=STRING,
    trailing_revenue=DOUBLE,
    shares_outstanding=LONG,
    revenue_tag=STRING,
)

# --- mart ------------------------------------------------------------------------------------
FCT_IPO_OFFERINGS = _struct(
    cik=STRING,
    company_name=STRING,
    filing_date=DATE,
    accession_number=STRING,
    sic_code=STRING,
    sic_description=STRING,
    sector=STRING,
    shares_offered=LONG,
    final_price=DOUBLE,
    gross_proceeds=DOUBLE,
    extraction_method=STRING,
    trailing_revenue=DOUBLE,
    shares_outstanding=LONG,
    implied_market_cap=DOUBLE,
    price_to_sales_ratio=DOUBLE,
    filing_quarter=DATE,
    filing_year=DATE,
    sector_avg_ps=DOUBLE,
    sector_median_ps=DOUBLE,
    valuation_flag=STRING,
)

# --- sampled covers (JSON lines) ------------------------------------------------------------------
COVER_SAMPLE = _struct(
    index=INT,
    company=STRING,
    cik=STRING,
    filing_date=STRING,
    url=STRING,
    cover_3000=STRING,
    dollar_matches=T.ArrayType(STRING),
)

# --- JSON bodies. A column the parser cannot fill is NULL; MALFORMED holds text that is no object. --
MALFORMED = "_malformed"
SUBMISSION_BODY = _struct(
    name=STRING,
    sic=STRING,
    sicDescription=STRING,
    stateOfIncorporation=STRING,
    fiscalYearEnd=STRING,
    **{MALFORMED: STRING},
)
ATTACHMENT = _struct(type=STRING, description=STRING)
ATTACHMENTS_BODY = _struct(attachments=T.ArrayType(ATTACHMENT))
FACT = _struct(end=STRING, val=STRING, form=STRING, fp=STRING)
