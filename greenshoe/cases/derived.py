"""Derived input tables, as SQL that any engine can run.

Each covers the whole of its base table, so the work grows with it. Values vary by key, so that
every rule of the jobs meets both matching and failing rows.
"""

from pyspark.sql import DataFrame, SparkSession


# Columns of the base tables that are read often; the others are read with the schema they carry.
BASE: dict[str, str | None] = {
    "region": None,
    "nation": None,
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "supplier": None,
    "part": None,
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": None,
    "events": None,
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": None,
    "pages": "page_id bigint, url string, html string",
    "benchmark": None,
    "labels": None,
    "conversations": None,
}

_ACCESSION = (
    "lpad(cast(o_orderkey AS string), 10, '0') || '-24-' ||"
    " lpad(cast(o_orderkey % 1000000 AS string), 6, '0')"
)

# name -> (tables it reads, SQL). A table stands after those it reads.
DERIVED: dict[str, tuple[list[str], str]] = {}

DERIVED["fx_orders"] = (
    ["orders"],
    f"""
SELECT *, {_ACCESSION} AS acc, cast(o_custkey AS string) AS ck,
  cast(o_orderdate AS date) AS day FROM orders""",
)

# Customers in debt have no company record. Codes: every sector, one short, one unmapped, one NULL.
DERIVED["fx_companies"] = (
    ["customer"],
    """
SELECT cast(c_custkey AS string) AS cik, c_name AS company_name,
  CASE c_custkey % 16 WHEN 0 THEN '7372' WHEN 1 THEN '2834' WHEN 2 THEN '8731' WHEN 3 THEN '3841'
    WHEN 4 THEN '6021' WHEN 5 THEN '6311' WHEN 6 THEN '3674' WHEN 7 THEN '5812' WHEN 8 THEN '1311'
    WHEN 9 THEN '4812' WHEN 10 THEN '6798' WHEN 11 THEN '6726' WHEN 12 THEN '9999'
    WHEN 13 THEN '737' WHEN 14 THEN NULL ELSE '6411' END AS sic_code,
  c_mktsegment AS sic_description, 'DE' AS state_of_incorp, '1231' AS fiscal_year_end
FROM customer WHERE c_acctbal >= 0""",
)

# The filing index: two forms, some filings without a document, one to four attachments.
DERIVED["fx_filing_index"] = (
    ["fx_orders"],
    """
SELECT ck AS cik, 'Customer ' || ck AS company_name, day AS filing_date, acc AS accession_number,
  CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'S-1' ELSE '424B4' END AS form_type,
  CASE WHEN o_orderkey % 37 <> 0 THEN 'https://filings.example/' || acc END AS filing_url,
  '{"attachments":[{"type":"424B4","description":"PROSPECTUS ' || acc || '"}'
    || CASE WHEN o_orderkey % 4 >= 1 THEN ',{"type":"EX-1.1","description":"AGREEMENT"}' ELSE '' END
    || CASE WHEN o_orderkey % 4 >= 2 THEN ',{"type":"GRAPHIC","description":null}' ELSE '' END
    || CASE WHEN o_orderkey % 4 >= 3 THEN ',{"type":"EX-99"}' ELSE '' END || ']}' AS attachments
FROM fx_orders""",
)

# Pending orders are ingested again a day later under another name; some rows lack a time.
DERIVED["fx_prospectus_filings"] = (
    ["fx_orders"],
    """
SELECT ck AS cik, 'Customer ' || ck AS company_name, day AS filing_date, acc AS accession_number,
  '424B4' AS form_type, 'https://filings.example/' || acc AS filing_url,
  CASE WHEN o_orderkey % 97 <> 0 THEN o_orderdate END AS ingested_at FROM fx_orders
UNION ALL
SELECT ck, 'Customer ' || ck || ' (refiled)', day, acc, '424B4',
  'https://filings.example/' || acc || '/2', o_orderdate + INTERVAL '1' DAY
FROM fx_orders WHERE o_orderstatus = 'P'""",
)

# Pending orders are extracted again, some with another type. Some terms name another company.
DERIVED["fx_offering_terms"] = (
    ["fx_orders"],
    """
SELECT CASE WHEN o_orderkey % 101 = 0 THEN ck || 'x' ELSE ck END AS cik, acc AS accession_number,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'ipo' WHEN '2-HIGH' THEN 'ipo' WHEN '3-MEDIUM' THEN 'spac'
    WHEN '5-LOW' THEN 'follow_on' ELSE 'unknown' END AS offering_type,
  CASE WHEN o_orderkey % 11 <> 0 THEN 10000 + (o_orderkey * 7919) % 5000000 END AS shares_offered,
  CASE WHEN o_orderkey % 13 <> 0 THEN cast(4 + o_orderkey % 57 AS double) / 2 END AS price_low,
  CASE WHEN o_orderkey % 17 <> 0 THEN cast(4 + o_orderkey % 57 AS double) / 2
    + CASE WHEN o_orderkey % 5 = 0 THEN 2 ELSE 0 END END AS price_high,
  'regex' AS extraction_method, o_orderdate AS extracted_at FROM fx_orders
UNION ALL
SELECT CASE WHEN o_orderkey % 101 = 0 THEN ck || 'x' ELSE ck END, acc,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'ipo' ELSE 'unknown' END,
  10000 + (o_orderkey * 7919) % 5000000, cast(6 + o_orderkey % 57 AS double) / 2,
  cast(6 + o_orderkey % 57 AS double) / 2, 'llm', o_orderdate + INTERVAL '1' DAY
FROM fx_orders WHERE o_orderstatus = 'P'""",
)

# Urgent finished orders are a year's revenue; late years can be zero, one year-end is unknown.
DERIVED["fx_post_ipo_financials"] = (
    ["orders"],
    """
SELECT cast(o_custkey AS string) AS cik,
  CASE WHEN o_custkey % 9 <> 1 OR yr <> 1996 THEN cast(yr AS string) || '-12-31' END
    AS fiscal_year_end,
  CASE WHEN o_custkey % 7 = 0 AND yr >= 2000 THEN 0.0e0
    ELSE cast(sum(cast(o_totalprice AS decimal(18, 2))) AS double) END AS trailing_revenue,
  CASE WHEN o_custkey % 4 = 0 THEN NULL WHEN o_custkey % 10 = 5 THEN 0
    ELSE 1000000 + o_custkey * 1000 END AS shares_outstanding,
  'Revenues' AS revenue_tag
FROM (SELECT *, year(o_orderdate) AS yr FROM orders) t
WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
GROUP BY o_custkey, yr""",
)

# Cover texts: every type, price form and share form, matching and failing.
DERIVED["fx_cover_parts"] = (
    ["fx_orders"],
    """
SELECT ck AS cik, 'Customer ' || ck AS company_name, acc AS accession_number, day AS filing_date,
  'https://filings.example/' || acc AS filing_url,
  CASE WHEN o_custkey % 23 = 0 THEN 404 WHEN o_custkey % 29 = 0 THEN 500 ELSE 200 END AS http_status,
  CASE o_orderkey % 10
    WHEN 0 THEN 'This is an initial public offering. We are offering ' || n || ',000,000 ordinary shares.'
    WHEN 1 THEN n || ',000,000 Shares. Prior to this offering, there has been no market. Trust account.'
    WHEN 2 THEN n || ',500,000 American Depositary Shares. Our common stock is listed under X.'
    WHEN 3 THEN 'Blank check company with a trust account and founder shares. ' || n || ',000,000 units.'
    WHEN 4 THEN 'We are offering, on a firm commitment basis, ' || n || ',050,000 Ordinary Shares. There is no active public market. Underwriting discounts and commissions.'
    WHEN 5 THEN 'We are offering ' || n || ',000 shares; underwriting discount and commission.'
    WHEN 6 THEN n || ',000' || chr(160) || 'Shares. No public market  has existed.'
    WHEN 7 THEN 'No prior public market. Terms to be announced.'
    WHEN 8 THEN 'We are offering , shares. Underwriting discounts and commissions.'
    ELSE 'We are offering on a best efforts basis, ' || n || ',000,000 Class A shares. No prior public market.' END AS body,
  CASE o_orderkey % 7
    WHEN 0 THEN 'The initial public offering price per share is $' || n || '.50'
    WHEN 1 THEN 'Between $ ' || n || '.00 and $' || cast(o_orderkey % 90 + 3 AS string) || '.00 per share'
    WHEN 2 THEN 'Price range of $' || n || '00 to $' || n || '50'
    WHEN 3 THEN 'Per' || chr(160) || 'Share' || chr(160) || '$ ' || n || '.25'
    WHEN 4 THEN 'public offering price of $' || n || ',250.00 per share'
    WHEN 5 THEN 'offering price of $' || n || '.00 per unit'
    ELSE 'no price' END AS tail
FROM (SELECT *, cast(o_orderkey % 90 + 1 AS string) AS n FROM fx_orders) q""",
)

DERIVED["fx_covers"] = (
    ["fx_cover_parts"],
    """
SELECT cik, company_name, accession_number, filing_date, filing_url, body || ' ' || tail AS cover
FROM fx_cover_parts""",
)

# The same as landed HTML; the block around both parts repeats their text.
DERIVED["fx_documents"] = (
    ["fx_cover_parts"],
    """
SELECT cik, accession_number, filing_date, http_status,
  '<html><head><title>F &amp; Co</title><style>p{margin:0}</style></head><body><div class="c">'
    || '<p>' || replace(body, chr(160), '&nbsp;') || '<br></p><!-- x --><span> '
    || replace(tail, chr(160), '&#160;') || '</span><script>var t = "</p>";</script></div></body></html>' AS html
FROM fx_cover_parts""",
)

# Answers of the fallback service, none for open orders.
DERIVED["fx_fallback_responses"] = (
    ["fx_orders"],
    """
SELECT acc AS accession_number, CASE o_custkey % 5
  WHEN 0 THEN '```json' || chr(10) || '{"offering_type":"ipo","shares_offered":' || cast(o_orderkey + 10000 AS string) || ',"price_low":10.5,"price_high":12.0}' || chr(10) || '```'
  WHEN 1 THEN '{"shares_offered":null,"price_low":7.0}'
  WHEN 2 THEN 'not json'
  WHEN 3 THEN ' [1, 2] '
  ELSE '{"offering_type":null,"shares_offered":20000}' END AS raw
FROM fx_orders WHERE o_orderstatus <> 'O'""",
)

DERIVED["fx_landed_facts"] = (
    ["customer"],
    """
SELECT cast(c_custkey AS string) AS cik,
  CASE WHEN c_custkey % 23 = 0 THEN 404 WHEN c_custkey % 19 = 0 THEN 500 ELSE 200 END AS http_status,
  CASE WHEN c_custkey % 17 = 0 THEN '{"facts":{}}' ELSE '{"facts":{"us-gaap":{"'
    || CASE c_custkey % 4 WHEN 0 THEN 'Revenues'
       WHEN 1 THEN 'RevenueFromContractWithCustomerExcludingAssessedTax'
       WHEN 2 THEN 'SalesRevenueNet' ELSE 'Assets' END
    || '":{"units":{"USD":[{"end":"2022-12-31","val":' || k || '1,"form":"10-K","fp":"FY"},'
    || '{"end":"2023-12-31","val":' || k || '2,"form":"'
    || CASE WHEN c_custkey % 5 = 0 THEN '10-Q' ELSE '10-K/A' END || '","fp":"FY"},'
    || '{"end":"2023-12-31","val":' || k || '3,"form":"10-K","fp":"FY"},'
    || '{"end":"2024-03-31","val":' || k || '4,"form":"10-Q","fp":"Q1"}]}}},'
    || '"dei":{"EntityCommonStockSharesOutstanding":{"units":{"shares":['
    || '{"end":"2024-01-31","val":' || k || '00,"form":"10-K","fp":"FY"}]}}}}}' END AS body
FROM (SELECT c_custkey, cast(c_custkey + 1 AS string) AS k FROM customer) q""",
)

DERIVED["fx_landed_submissions"] = (
    ["fx_companies"],
    """
SELECT cik,
  CASE WHEN cast(cik AS int) % 23 = 0 THEN 404 WHEN cast(cik AS int) % 19 = 0 THEN 500 ELSE 200 END
    AS http_status,
  CASE WHEN cast(cik AS int) % 31 = 0 THEN '<busy>' ELSE '{"name":"' || company_name || '","sic":'
    || coalesce('"' || sic_code || '"', 'null') || ',"sicDescription":"' || sic_description
    || '","stateOfIncorporation":"DE","fiscalYearEnd":"1231","tickers":["A","B"]}' END AS body
FROM fx_companies""",
)

# The company table before a batch, and the batch: two segments each, one of them shared.
DERIVED["fx_companies_old"] = (
    ["fx_companies"],
    """
SELECT * FROM fx_companies WHERE sic_description IN ('BUILDING', 'MACHINERY', 'FURNITURE')""",
)
DERIVED["fx_companies_incoming"] = (
    ["fx_companies"],
    """
SELECT cik, company_name || ' (renamed)' AS company_name, sic_code, sic_description,
  'NV' AS state_of_incorp, fiscal_year_end
FROM fx_companies WHERE sic_description IN ('FURNITURE', 'HOUSEHOLD', 'AUTOMOBILE')""",
)


def needed(*names: str) -> list[str]:
    """The derived tables that ``names`` rest on, themselves included, in order."""
    wanted: set[str] = set()
    pending = list(names)
    while pending:
        name = pending.pop()
        if name in DERIVED and name not in wanted:
            wanted.add(name)
            pending.extend(DERIVED[name][0])
    return [name for name in DERIVED if name in wanted]


def with_clause(*names: str) -> str:
    """A ``WITH`` list of the derived tables, for an engine that has the base tables as views."""
    return ",\n".join(f"{name} AS ({DERIVED[name][1]}\n)" for name in needed(*names))


# Tables with texts made of short rows. The test tables are single files, so the short rows are
# dealt to all cores before the texts are made; no text is shuffled.
TEXTS = {"fx_covers", "fx_documents", "fx_landed_facts"}


class Tables:
    """Base and derived tables of one data folder as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.read: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name in BASE:
            if name not in self.read:
                schema = BASE[name]
                reader = self.spark.read.schema(schema) if schema else self.spark.read
                self.read[name] = reader.parquet(f"{self.folder}/{name}.parquet")
            return self.read[name]
        order = needed(name)
        bases = {b for n in order for b in DERIVED[n][0] if b in BASE}
        cores = self.spark.sparkContext.defaultParallelism
        for base in bases:
            table = self[base].repartition(cores) if name in TEXTS else self[base]
            table.createOrReplaceTempView(base)
        return self.spark.sql(f"WITH {with_clause(name)} SELECT * FROM {name}")
