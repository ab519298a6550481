"""Scans of the landed filing index.

The index is partitioned by ``filing_date``, so the date filters prune partitions and the form
filter is pushed to the Parquet reader.
"""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenshoe.functions.dialect import json_object
from greenshoe.schemas import ATTACHMENTS_BODY, FILING_INDEX

COLUMNS = FILING_INDEX.names


def daily_filings(index: DataFrame, form: str, day: date) -> DataFrame:
    """Filings of one form on one day that have a document."""
    return filings_in_range(index, form, day, day)


def filings_in_range(index: DataFrame, form: str, start: date, end: date) -> DataFrame:
    """Filings of one form from ``start`` to ``end``, both included, that have a document."""
    return index.where(
        (F.col("form_type") == form)
        & F.col("filing_date").between(F.lit(start), F.lit(end))
        & F.col("filing_url").isNotNull()
    ).select(*COLUMNS)


def attachments(index: DataFrame, body: str = "attachments") -> DataFrame:
    """One row per document of a filing, from the JSON listing in column ``body``."""
    listed = json_object(F.col(body), ATTACHMENTS_BODY)["attachments"]
    return index.select(
        "accession_number", F.posexplode(listed).alias("position", "document")
    ).select(
        "accession_number",
        "position",
        F.col("document.type").alias("document_type"),
        F.col("document.description").alias("description"),
    )
