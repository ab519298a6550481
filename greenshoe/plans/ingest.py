"""The daily batch and the backfill, from landed responses to the raw layer."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenshoe import fixed_values as V
from greenshoe.operators.latest import latest_by, newest_landed
from greenshoe.plans import terms as T
from greenshoe.sources.filings import filings_in_range
from greenshoe.sources.landed import company_metadata, document_covers


def company_lookup(filings: DataFrame, landed_metadata: DataFrame) -> DataFrame:
    """Metadata of every company among the filings, the newest answer; no answer, no row."""
    ciks = filings.select("cik").distinct()
    time = [c for c in ["landed_at"] if c in landed_metadata.columns]
    found = company_metadata(landed_metadata, *time)
    last = latest_by(found, ["cik"], newest_landed(found)).drop(*time)
    return ciks.join(last, "cik")


def documents_between(documents: DataFrame, start: date, end: date) -> DataFrame:
    """Landed documents of a range of days; prunes the partitions of the table."""
    return documents.where(F.col("filing_date").between(F.lit(start), F.lit(end)))


def extract_days(documents: DataFrame, start: date, end: date) -> DataFrame:
    """Covers and terms of the documents of a range of days, before the fallback."""
    return T.extract(document_covers(documents_between(documents, start, end)))


def terms_of(documents: DataFrame, responses: DataFrame, mode: str) -> DataFrame:
    """Terms of landed documents, the fallback answers folded in."""
    extracted = T.extract(document_covers(documents))
    return T.keep_for(mode, T.fold_responses(extracted, responses))


def batch(
    index: DataFrame,
    extracted: DataFrame,
    landed_metadata: DataFrame,
    responses: DataFrame,
    start: date,
    end: date,
    mode: str = T.DAILY,
    form: str = V.PROSPECTUS_FORM,
) -> dict[str, DataFrame]:
    """Filings, companies and terms of a range of days; one day is the daily job.

    A backfill is this one job over its whole range, not a loop over days. ``extracted`` comes
    from ``extract_days``. Only the documents of the filings count. That join comes after the extraction and never
    moves HTML or covers.
    """
    filings = filings_in_range(index, form, start, end)
    terms = T.fold_responses(extracted, responses, filings)
    return {
        "prospectus_filings": filings,
        "companies": company_lookup(filings, landed_metadata),
        "offering_terms": T.keep_for(mode, terms),
    }
