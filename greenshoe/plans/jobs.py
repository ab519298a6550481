"""The jobs over folders of tables: ingest, weekly enrichment and mart build.

    landed/   filing_index documents submissions company_facts fallback_responses
    staging/  extracted fallback_requests company_facts
    raw/      prospectus_filings offering_terms post_ipo_financials company_changes
    marts/    fct_ipo_offerings

Documents are parsed once, by ``extract_days``. The requests and the terms both start from what it
wrote, as the answers of the fallback service come in between.

Run dates are parameters. The mart decides which companies are enriched and enrichment feeds the
mart, so the order is: mart, enrichment, mart again.
"""

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from greenshoe import fixed_values as V
from greenshoe import schemas as S
from greenshoe.plans import enrichment, ingest, mart, reports, terms
from greenshoe.sources import changes, landed, tables

LANDED = {
    "filing_index": S.FILING_INDEX,
    "documents": S.LANDED_DOCUMENT,
    "submissions": S.LANDED_BODY,
    "company_facts": S.LANDED_BODY,
    "fallback_responses": S.FALLBACK_RESPONSES,
}
RAW = {
    "prospectus_filings": S.PROSPECTUS_FILINGS,
    "offering_terms": S.OFFERING_TERMS,
    "post_ipo_financials": S.POST_IPO_FINANCIALS,
}
PARTITIONS = {"prospectus_filings": "filing_date"}
# Companies by what was merged into them, and where warehouses of before keep whole versions.
COMPANY_CHANGES, COMPANY_VERSIONS = "company_changes", "companies"
FACT = "fct_ipo_offerings"


@dataclass(frozen=True)
class Warehouse:
    """Tables by layer under one root folder."""

    spark: SparkSession
    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def landed(self, table: str) -> DataFrame:
        return tables.read_table(self.spark, self.path("landed", table), LANDED[table])

    def raw(self, table: str) -> DataFrame:
        return tables.read_table(self.spark, self.path(tables.RAW, table), RAW[table])

    def extracted(self, start: date, end: date) -> DataFrame:
        path = self.path(tables.STAGING, "extracted")
        table = tables.read_table(self.spark, path, S.EXTRACTED)
        return ingest.documents_between(table, start, end)

    def companies(self) -> DataFrame:
        path = self.path(tables.RAW, COMPANY_CHANGES)
        return changes.read(self.spark, path, S.COMPANIES, ["cik"])

    def fact(self) -> DataFrame:
        return self.spark.read.parquet(self.path(tables.MARTS, FACT))


def create_raw(w: Warehouse) -> None:
    """Empty raw tables; once, before the first batch.

    The last version of a company table that an earlier release wrote is taken over.
    """
    for table in RAW:
        tables.create(w.spark, w.path(tables.RAW, table))
    path, versions = (w.path(tables.RAW, t) for t in (COMPANY_CHANGES, COMPANY_VERSIONS))
    tables.create(w.spark, path)
    last = tables.last_version(w.spark, versions)
    if last is not None and not changes.changes(w.spark, path, S.COMPANIES).inputFiles():
        rows = tables.read_version(w.spark, versions, last, S.COMPANIES)
        changes.merge(rows, path, "versions", S.COMPANIES, changes.before_all())


def load(
    w: Warehouse, batch: dict[str, DataFrame], number: int, mode: str = terms.DAILY
) -> dict[str, int]:
    """Append the filings and terms of a batch and merge its companies.

    A batch that is repeated under its number writes the same load again. Gives the counts of the
    run, as ``reports.run_summary`` does, taken from the rows as they are written.
    """
    now, name_of_load = F.current_timestamp(), f"batch-{number}"
    counts: dict[str, int] = {}

    def append(rows: DataFrame, table: str, measure: str, count: Column) -> None:
        seen = Observation(measure)
        path = w.path(tables.RAW, table)
        tables.append(rows, path, name_of_load, PARTITIONS.get(table), seen, count.alias("n"))
        counts[measure] = seen.get.get("n", 0)

    filings = batch["prospectus_filings"].withColumn("ingested_at", now)
    append(filings, "prospectus_filings", "filings", F.count("*"))
    found = with_default(batch["offering_terms"], "extraction_method", V.METHOD_REGEX)
    found = found.withColumn("extracted_at", now)
    found = terms.keep_for(mode, terms.typed(found, S.OFFERING_TERMS))
    append(found, "offering_terms", "extracted", reports.extracted())
    seen = Observation("companies")
    incoming = batch["companies"].withColumn("ingested_at", now)
    incoming = incoming.observe(seen, F.count("*").alias("n"))
    changes.merge(incoming, w.path(tables.RAW, COMPANY_CHANGES), name_of_load, S.COMPANIES)
    counts["companies"] = seen.get.get("n", 0)
    return counts


def compact_companies(w: Warehouse) -> None:
    """Bring the merged companies down to one row each; at any time, changes no result."""
    changes.compact(w.spark, w.path(tables.RAW, COMPANY_CHANGES), S.COMPANIES, ["cik"])


def with_default(df: DataFrame, column: str, value: str) -> DataFrame:
    """A missing column gets the default; a NULL in a column that is there stays."""
    return df if column in df.columns else df.withColumn(column, F.lit(value))


def extract_days(w: Warehouse, start: date, end: date) -> None:
    """Parse the documents of a range of days; repeated, it replaces its days."""
    extracted = ingest.extract_days(w.landed("documents"), start, end)
    path = w.path(tables.STAGING, "extracted")
    tables.replace_days(terms.typed(extracted, S.EXTRACTED), path, start, end)


def request_fallback(w: Warehouse, start: date, end: date) -> None:
    """Write what the fallback service has to be asked, one JSON line per filing."""
    requests = terms.fallback_requests(w.extracted(start, end), "filing_date")
    path = w.path(tables.STAGING, "fallback_requests")
    tables.replace_days(requests, path, start, end, "json")


def ingest_days(
    w: Warehouse, start: date, end: date, version: int, mode: str = terms.DAILY
) -> dict[str, int]:
    """The daily job (one day) or the backfill (a range of days in one job); gives its counts."""
    batch = ingest.batch(
        w.landed("filing_index"),
        w.extracted(start, end),
        w.landed("submissions"),
        w.landed("fallback_responses"),
        start,
        end,
        mode,
    )
    return load(w, batch, version, mode)


def build_mart(w: Warehouse) -> None:
    fact = mart.fct_ipo_offerings(
        w.raw("prospectus_filings"),
        w.raw("offering_terms"),
        w.companies(),
        w.raw("post_ipo_financials"),
    )
    tables.rebuild(fact, w.path(tables.MARTS, FACT))


def parse_facts(w: Warehouse) -> None:
    """Parse the landed company facts once; ``enrich`` then reads tags instead of text.

    Optional. Repeated, it replaces its table.
    """
    parsed = landed.parsed_facts(w.landed("company_facts"))
    tables.rebuild(parsed, w.path(tables.STAGING, "company_facts"))


def enrich(w: Warehouse, as_of: date, parsed: bool = False) -> None:
    """The weekly job, from landed bodies or from what ``parse_facts`` has made of them."""
    if parsed:
        path = w.path(tables.STAGING, "company_facts")
        facts = tables.read_table(w.spark, path, S.PARSED_BODY)
    else:
        facts = w.landed("company_facts")
    found = enrichment.enrich(facts, w.fact(), as_of)
    tables.append(found, w.path(tables.RAW, "post_ipo_financials"), f"enriched-{as_of}")
