"""Queries on staging, mart, enrichment, upsert and quality."""

import uuid
from datetime import date

from pyspark.sql import functions as F

from greenshoe import fixed_values as V
from greenshoe.cases.registry import query
from greenshoe.functions import text as X
from greenshoe.functions import valuation
from greenshoe.operators.upsert import upsert
from greenshoe.plans import enrichment, mart, quality, reports, staging
from greenshoe.session import materialize, shared_folder
from greenshoe.sources import changes, tables
from greenshoe.sources.landed import parsed_facts

AS_OF = date(2000, 8, 31)
ELIGIBLE_UNTIL = "2000-02-29"

RAW = ["fx_prospectus_filings", "fx_offering_terms", "fx_companies", "fx_post_ipo_financials"]

STG_FILINGS = """
SELECT cik, company_name, filing_date, accession_number, form_type, filing_url FROM (
  SELECT *, row_number() OVER (PARTITION BY accession_number ORDER BY ingested_at DESC NULLS FIRST)
    AS rn FROM fx_prospectus_filings) q WHERE rn = 1"""

STG_TERMS = """
SELECT cik, accession_number, offering_type, shares_offered, price_low, price_high,
  coalesce((price_low + price_high) / 2, price_low, price_high) AS final_price,
  shares_offered * coalesce((price_low + price_high) / 2, price_low, price_high) AS gross_proceeds,
  extraction_method FROM (
  SELECT *, row_number() OVER (PARTITION BY accession_number ORDER BY extracted_at DESC NULLS FIRST)
    AS rn FROM fx_offering_terms) q WHERE rn = 1"""

IPO_TERMS = f"""
SELECT * FROM ({STG_TERMS}) s
WHERE offering_type = 'ipo' AND final_price IS NOT NULL AND shares_offered IS NOT NULL"""

LATEST_FINANCIALS = """
SELECT cik, trailing_revenue, shares_outstanding FROM (
  SELECT *, row_number() OVER (PARTITION BY cik ORDER BY fiscal_year_end DESC NULLS FIRST) AS rn
  FROM fx_post_ipo_financials WHERE trailing_revenue > 0) q WHERE rn = 1"""

_SECTORS = "\n".join(
    f"  WHEN sic_code BETWEEN '{low}' AND '{high}' THEN '{name}'" for low, high, name in V.SECTOR_RULES
)
SECTOR_MAP = f"""
SELECT cik, sic_code, sic_description, CASE
{_SECTORS}
  ELSE '{V.OTHER_SECTOR}' END AS sector
FROM fx_companies WHERE sic_code IS NOT NULL"""

FILINGS_TERMS = f"""
SELECT f.*, t.offering_type, t.shares_offered, t.price_low, t.price_high, t.final_price,
  t.gross_proceeds, t.extraction_method
FROM ({STG_FILINGS}) f JOIN ({IPO_TERMS}) t
  ON f.cik = t.cik AND f.accession_number = t.accession_number"""

MART_BASE = f"""
SELECT b.cik, company_name, filing_date, accession_number, sic_code, sic_description, sector,
  shares_offered, final_price, gross_proceeds, extraction_method, trailing_revenue,
  shares_outstanding,
  coalesce(shares_outstanding, shares_offered) * final_price AS implied_market_cap,
  CASE WHEN trailing_revenue > 0 THEN
    coalesce(shares_outstanding, shares_offered) * final_price / trailing_revenue END
    AS price_to_sales_ratio,
  cast(date_trunc('quarter', filing_date) AS date) AS filing_quarter,
  cast(date_trunc('year', filing_date) AS date) AS filing_year
FROM ({FILINGS_TERMS}) b LEFT JOIN ({SECTOR_MAP}) s ON b.cik = s.cik
  LEFT JOIN ({LATEST_FINANCIALS}) fin ON b.cik = fin.cik"""

# The benchmark as window functions, where the library aggregates and joins.
FACT = f"""
SELECT *, CASE WHEN price_to_sales_ratio IS NULL THEN '{V.FLAG_NO_REVENUE}'
    WHEN price_to_sales_ratio > sector_median_ps * {V.RICH_FACTOR}e0 THEN '{V.FLAG_RICH}'
    WHEN price_to_sales_ratio < sector_median_ps * {V.CHEAP_FACTOR}e0 THEN '{V.FLAG_CHEAP}'
    ELSE '{V.FLAG_IN_LINE}' END AS valuation_flag
FROM (SELECT *, avg(price_to_sales_ratio) OVER w AS sector_avg_ps,
    median(price_to_sales_ratio) OVER w AS sector_median_ps
  FROM ({MART_BASE}) m WINDOW w AS (PARTITION BY sector)) v"""

# Means are rounded: the engines add in another order, which shows in the last digits.
ROUNDED_FACT = f"""
SELECT * REPLACE (round(sector_avg_ps, 6) AS sector_avg_ps,
  round(sector_median_ps, 6) AS sector_median_ps) FROM ({FACT}) f"""


def raw_tables(t):
    return [t[name] for name in RAW]


def fact_table(t):
    return mart.fct_ipo_offerings(*raw_tables(t))


def rounded(fact):
    return fact.withColumn("sector_avg_ps", F.round("sector_avg_ps", 6)).withColumn(
        "sector_median_ps", F.round("sector_median_ps", 6)
    )


def base_table(t):
    return mart.mart_base(*raw_tables(t))


# --- staging -----------------------------------------------------------------------------------


@query(
    "stg_companies",
    ["fx_companies"],
    "SELECT * FROM fx_companies WHERE sic_code IS NOT NULL",
)
def _(t):
    return staging.stg_companies(t["fx_companies"])


@query("stg_prospectus_filings", ["fx_prospectus_filings"], STG_FILINGS)
def _(t):
    return staging.stg_prospectus_filings(t["fx_prospectus_filings"])


@query("stg_offering_terms", ["fx_offering_terms"], STG_TERMS)
def _(t):
    return staging.stg_offering_terms(t["fx_offering_terms"])


@query("ipo_terms", ["fx_offering_terms"], IPO_TERMS)
def _(t):
    return mart.ipo_terms(staging.stg_offering_terms(t["fx_offering_terms"]))


@query("latest_financials", ["fx_post_ipo_financials"], LATEST_FINANCIALS)
def _(t):
    return mart.latest_financials(t["fx_post_ipo_financials"])


# --- mart --------------------------------------------------------------------------------------


@query("sector_map", ["fx_companies"], SECTOR_MAP)
def _(t):
    return mart.sector_map(staging.stg_companies(t["fx_companies"]))


@query("filings_terms", ["fx_prospectus_filings", "fx_offering_terms"], FILINGS_TERMS)
def _(t):
    return mart.filings_with_terms(
        staging.stg_prospectus_filings(t["fx_prospectus_filings"]),
        mart.ipo_terms(staging.stg_offering_terms(t["fx_offering_terms"])),
    )


@query(
    "filing_periods",
    ["fx_prospectus_filings"],
    """SELECT accession_number, filing_date, cast(date_trunc('quarter', filing_date) AS date)
  AS filing_quarter, cast(date_trunc('year', filing_date) AS date) AS filing_year
FROM fx_prospectus_filings""",
)
def _(t):
    day = F.col("filing_date")
    return t["fx_prospectus_filings"].select(
        "accession_number",
        "filing_date",
        valuation.quarter_start(day).alias("filing_quarter"),
        valuation.year_start(day).alias("filing_year"),
    )


@query(
    "sector_benchmark",
    RAW,
    f"""SELECT sector, round(avg(price_to_sales_ratio), 6) AS sector_avg_ps,
  round(median(price_to_sales_ratio), 6) AS sector_median_ps
FROM ({MART_BASE}) m WHERE price_to_sales_ratio IS NOT NULL GROUP BY sector""",
)
def _(t):
    base = materialize(
        base_table(t).select("sector", "price_to_sales_ratio"), "sector-ratios"
    )
    return rounded(mart.sector_benchmark(base))


@query("fct_offerings", RAW, ROUNDED_FACT)
def _(t):
    return rounded(fact_table(t))


@query("mart_export", RAW, f"{ROUNDED_FACT} ORDER BY filing_date DESC, accession_number")
def _(t):
    return tables.newest_first(rounded(fact_table(t)))


@query(
    "sector_summary",
    RAW,
    f"""SELECT sector, count(*) AS ipo_count, round(avg(implied_market_cap), 2) AS avg_market_cap
FROM ({MART_BASE}) m GROUP BY sector""",
)
def _(t):
    # Reads no benchmark column, so the base is enough.
    return reports.sector_summary(base_table(t)).withColumn(
        "avg_market_cap", F.round("avg_market_cap", 2)
    )


@query(
    "top_valued",
    RAW,
    f"""SELECT company_name, sector, price_to_sales_ratio, valuation_flag FROM ({FACT}) f
WHERE price_to_sales_ratio IS NOT NULL
ORDER BY price_to_sales_ratio DESC, accession_number LIMIT 10""",
)
def _(t):
    return reports.top_valued(materialize(base_table(t), "mart-base"))


# --- enrichment ----------------------------------------------------------------------------------

ELIGIBLE = f"SELECT DISTINCT cik FROM ({MART_BASE}) m WHERE filing_date <= DATE '{ELIGIBLE_UNTIL}'"

# The derived bodies, read back by rule instead of by JSON.
REVENUE = """
SELECT cast(c_custkey AS string) AS cik,
  CASE c_custkey % 4 WHEN 0 THEN 'Revenues'
    WHEN 1 THEN 'RevenueFromContractWithCustomerExcludingAssessedTax'
    WHEN 2 THEN 'SalesRevenueNet' END AS revenue_tag,
  CASE WHEN c_custkey % 4 <> 3 THEN
    cast((c_custkey + 1) * 10 + CASE WHEN c_custkey % 5 = 0 THEN 3 ELSE 2 END AS double) END
    AS trailing_revenue,
  cast((c_custkey + 1) * 100 AS bigint) AS shares_outstanding,
  CASE WHEN c_custkey % 4 = 0 THEN '2023-12-31' END AS fiscal_year_end
FROM customer JOIN fx_landed_facts f ON cast(c_custkey AS string) = f.cik
WHERE f.http_status < 400 AND f.body <> '{"facts":{}}'"""
REVENUE_READS = ["fx_landed_facts"]


@query("eligible_ciks", RAW, ELIGIBLE)
def _(t):
    return enrichment.eligible_ciks(base_table(t), AS_OF)


@query(
    "eligible_facts",
    [*RAW, "fx_landed_facts"],
    f"SELECT * FROM fx_landed_facts WHERE cik IN ({ELIGIBLE})",
)
def _(t):
    ciks = enrichment.eligible_ciks(base_table(t), AS_OF)
    return enrichment.eligible_facts(t["fx_landed_facts"], ciks)


def _facts(t):
    return enrichment.company_facts(t["fx_landed_facts"])


@query(
    "trailing_revenue",
    REVENUE_READS,
    f"SELECT cik, revenue_tag, trailing_revenue FROM ({REVENUE}) r WHERE revenue_tag IS NOT NULL",
)
def _(t):
    return (
        _facts(t)
        .where(F.col("revenue").isNotNull())
        .select(
            "cik",
            F.col("revenue.tag").alias("revenue_tag"),
            F.col("revenue.value").alias("trailing_revenue"),
        )
    )


@query("shares_outstanding", REVENUE_READS, f"SELECT cik, shares_outstanding FROM ({REVENUE}) r")
def _(t):
    return (
        _facts(t)
        .where(F.col("shares").isNotNull())
        .select("cik", F.col("shares.value").alias("shares_outstanding"))
    )


@query(
    "fiscal_year_end",
    REVENUE_READS,
    f"SELECT cik, fiscal_year_end FROM ({REVENUE}) r WHERE fiscal_year_end IS NOT NULL",
)
def _(t):
    return (
        _facts(t)
        .where(F.col("year_end").isNotNull())
        .select("cik", F.col("year_end.value").alias("fiscal_year_end"))
    )


@query(
    "xbrl_facts",
    REVENUE_READS,
    f"""SELECT cik, fiscal_year_end, trailing_revenue, shares_outstanding, revenue_tag
FROM ({REVENUE}) r WHERE revenue_tag IS NOT NULL""",
)
def _(t):
    return enrichment.post_ipo_financials(t["fx_landed_facts"])


@query(
    "weekly_enrichment",
    [*RAW, *REVENUE_READS],
    f"""SELECT cik, fiscal_year_end, trailing_revenue, shares_outstanding, revenue_tag
FROM ({REVENUE}) r WHERE revenue_tag IS NOT NULL AND cik IN ({ELIGIBLE})""",
)
def _(t):
    return enrichment.enrich(t["fx_landed_facts"], base_table(t), AS_OF)


def _parsed(t):
    """The landed facts as they are kept once they are parsed: VARIANTs in a table."""
    return materialize(parsed_facts(t["fx_landed_facts"]), "parsed-facts")


@query(
    "xbrl_facts_parsed",
    REVENUE_READS,
    f"""SELECT cik, fiscal_year_end, trailing_revenue, shares_outstanding, revenue_tag
FROM ({REVENUE}) r WHERE revenue_tag IS NOT NULL""",
)
def _(t):
    return enrichment.post_ipo_financials(_parsed(t))


@query(
    "weekly_enrichment_parsed",
    [*RAW, *REVENUE_READS],
    f"""SELECT cik, fiscal_year_end, trailing_revenue, shares_outstanding, revenue_tag
FROM ({REVENUE}) r WHERE revenue_tag IS NOT NULL AND cik IN ({ELIGIBLE})""",
)
def _(t):
    return enrichment.enrich(_parsed(t), base_table(t), AS_OF)


# --- upsert --------------------------------------------------------------------------------------


@query(
    "upsert_companies",
    ["fx_companies_old", "fx_companies_incoming"],
    """SELECT * FROM fx_companies_incoming
UNION ALL SELECT * FROM fx_companies_old
  WHERE cik NOT IN (SELECT cik FROM fx_companies_incoming)""",
)
def _(t):
    return upsert(t["fx_companies_old"], t["fx_companies_incoming"], ["cik"], [])


@query(
    "merged_companies",
    ["fx_companies_old", "fx_companies_incoming"],
    """SELECT * FROM fx_companies_incoming
UNION ALL SELECT * FROM fx_companies_old
  WHERE cik NOT IN (SELECT cik FROM fx_companies_incoming)""",
)
def _(t):
    """The same by appended changes: the old rows, the batch, the batch again, compacted between."""
    old, batch = t["fx_companies_old"], t["fx_companies_incoming"]
    path = f"{shared_folder(t.spark)}/merged-companies-{uuid.uuid4().hex}"
    changes.merge(old, path, "initial", old.schema, changes.before_all())
    changes.merge(batch, path, "batch-1", old.schema)
    changes.compact(t.spark, path, old.schema, ["cik"])
    changes.merge(batch, path, "batch-1", old.schema)
    return changes.read(t.spark, path, old.schema, ["cik"])


# --- names and keys ---------------------------------------------------------------------------------

# Fixed value: name parts looked for in the sampled names; here parts of generated names.
NAME_PARTS = ["#00000001", "CUSTOMER#00000077", "12"]


@query(
    "name_filter",
    ["fx_companies"],
    "SELECT cik, company_name FROM fx_companies WHERE "
    + " OR ".join(f"contains(lower(company_name), '{p.lower()}')" for p in NAME_PARTS),
)
def _(t):
    wanted = X.name_contains_any(F.col("company_name"), NAME_PARTS)
    return t["fx_companies"].where(wanted).select("cik", "company_name")


@query(
    "pad_key",
    ["fx_prospectus_filings"],
    """SELECT accession_number, CASE WHEN length(accession_number) >= 10 THEN accession_number
  ELSE lpad(accession_number, 10, '0') END AS padded_accession, lpad(cik, 10, '0') AS padded_cik
FROM fx_prospectus_filings""",
)
def _(t):
    return t["fx_prospectus_filings"].select(
        "accession_number",
        X.pad_key(F.col("accession_number")).alias("padded_accession"),
        X.pad_key(F.col("cik")).alias("padded_cik"),
    )


# --- data quality -----------------------------------------------------------------------------------


@query(
    "dq_unique",
    [],
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def _(t):
    return quality.unique(t["lineitem"], ["l_orderkey", "l_linenumber"])


@query(
    "dq_not_null",
    ["fx_offering_terms"],
    "SELECT * FROM fx_offering_terms WHERE shares_offered IS NULL",
)
def _(t):
    return quality.not_null(t["fx_offering_terms"], "shares_offered")


@query(
    "dq_accepted_values",
    ["fx_offering_terms"],
    "SELECT * FROM fx_offering_terms WHERE offering_type NOT IN ('ipo', 'spac', 'unknown')",
)
def _(t):
    allowed = [kind for kind in V.OFFERING_TYPES if kind != V.FOLLOW_ON]
    return quality.accepted_values(t["fx_offering_terms"], "offering_type", allowed)


@query(
    "dq_accepted_range",
    ["fx_offering_terms"],
    "SELECT * FROM fx_offering_terms WHERE NOT price_high BETWEEN 5 AND 25",
)
def _(t):
    return quality.accepted_range(t["fx_offering_terms"], "price_high", 5, 25)


@query(
    "dq_expression",
    ["fx_offering_terms"],
    "SELECT * FROM fx_offering_terms WHERE NOT (price_high - price_low > 0)",
)
def _(t):
    return quality.expression_is_true(t["fx_offering_terms"], "price_high - price_low > 0")


def _missing(table: str, source: str, column: str) -> str:
    return f"""SELECT 'not_null' AS test, '{table}' AS "table", '{column}' AS "column",
  count(*) FILTER ({column} IS NULL) AS failures FROM {source}"""


def _failing(test: str, table: str, source: str, column: str, bad: str) -> str:
    return f"""SELECT '{test}', '{table}', '{column}', count(*) FILTER ({bad}) FROM {source}"""


def _repeated(table: str, source: str, column: str) -> str:
    return f"""SELECT 'unique', '{table}', '{column}', count(*) FROM (SELECT {column} FROM {source}
  WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1) q"""


_M = f"({MART_BASE}) m"
REPORT = " UNION ALL ".join(
    [
        _missing("companies", "fx_companies", "cik"),
        _repeated("companies", "fx_companies", "cik"),
        _missing("prospectus_filings", "fx_prospectus_filings", "cik"),
        _missing("prospectus_filings", "fx_prospectus_filings", "accession_number"),
        _failing(
            "accepted_values",
            "offering_terms",
            "fx_offering_terms",
            "offering_type",
            "offering_type NOT IN ('ipo', 'spac', 'follow_on', 'unknown')",
        ),
        _repeated("fct_ipo_offerings", _M, "accession_number"),
        _missing("fct_ipo_offerings", _M, "accession_number"),
        _missing("fct_ipo_offerings", _M, "cik"),
        _missing("fct_ipo_offerings", _M, "final_price"),
        _failing(
            "accepted_range",
            "fct_ipo_offerings",
            _M,
            "final_price",
            "NOT final_price BETWEEN 0.01 AND 500",
        ),
        _missing("fct_ipo_offerings", _M, "shares_offered"),
        _failing(
            "accepted_range",
            "fct_ipo_offerings",
            _M,
            "shares_offered",
            "NOT shares_offered BETWEEN 10000 AND 1000000000",
        ),
        _failing(
            "expression_is_true",
            "fct_ipo_offerings",
            _M,
            "gross_proceeds",
            "NOT gross_proceeds > 0",
        ),
    ]
)


@query("dq_report", RAW, REPORT)
def _(t):
    return quality.report(
        {
            "companies": t["fx_companies"],
            "prospectus_filings": t["fx_prospectus_filings"],
            "offering_terms": t["fx_offering_terms"],
            # Two checks read the fact table, so it is a table here as well.
            "fct_ipo_offerings": materialize(base_table(t), "checked-mart"),
        }
    )
