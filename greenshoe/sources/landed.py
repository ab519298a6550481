"""Landed responses of the metadata, company-facts and document services.

Fetching happens elsewhere; each response stands in a table with its HTTP status.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenshoe.functions import facts as FX
from greenshoe.functions.dialect import json_object, once
from greenshoe.operators.cover import cover_text
from greenshoe.schemas import MALFORMED, SUBMISSION_BODY

OK, NOT_FOUND, FAILED = "ok", "not_found", "failed"


def outcome(http_status: Column) -> Column:
    """ok, not_found (skipped in silence) or failed; no status at all is a failure."""
    return (
        F.when(http_status == 404, NOT_FOUND)
        .when(http_status < 400, OK)
        .otherwise(FAILED)
    )


def triage(landed: DataFrame) -> DataFrame:
    return landed.withColumn("outcome", outcome(F.col("http_status")))


def answered(landed: DataFrame) -> DataFrame:
    return landed.where(outcome(F.col("http_status")) == OK)


def company_metadata(landed: DataFrame, *keep: str) -> DataFrame:
    """Five renamed fields of each submissions body; bodies that are no JSON object are skipped.

    Columns named in ``keep`` are passed on.
    """
    body = json_object(F.col("body"), SUBMISSION_BODY, MALFORMED)
    return (
        answered(landed)
        .select("cik", *keep, once(body).alias("b"))
        .where(F.col("b").isNotNull() & F.col(f"b.{MALFORMED}").isNull())
        .select(
            "cik",
            F.col("b.name").alias("company_name"),
            F.col("b.sic").alias("sic_code"),
            F.col("b.sicDescription").alias("sic_description"),
            F.col("b.stateOfIncorporation").alias("state_of_incorp"),
            F.col("b.fiscalYearEnd").alias("fiscal_year_end"),
            *keep,
        )
    )


def parsed_facts(landed: DataFrame) -> DataFrame:
    """Landed company facts with their bodies parsed: ``parsed`` (VARIANT) instead of ``body``.

    A body that a VARIANT cannot hold, for instance one with repeated keys, stays as text.
    """
    parsed = FX.facts_variant(F.col("body"))
    return (
        landed.withColumn("parsed", once(parsed))
        .withColumn("body", F.when(F.col("parsed").isNull(), F.col("body")))
        .select(*landed.columns, "parsed")
    )


def _facts(landed: DataFrame) -> Column:
    """The facts of a landed table, whether its bodies are parsed or not."""
    text = FX.parse_facts(F.col("body"))
    if "parsed" not in landed.columns:
        return text
    return F.when(F.col("parsed").isNotNull(), FX.read_facts(F.col("parsed"))).otherwise(text)


def company_facts(landed: DataFrame) -> DataFrame:
    """``cik`` and the three figures of each company-facts body, as found (NULL: not found).

    Takes bodies as text or as ``parsed_facts`` leaves them.
    """
    facts = F.col("facts")
    figures = F.struct(
        FX.trailing_revenue(facts).alias("revenue"),
        FX.shares_outstanding(facts).alias("shares"),
        FX.fiscal_year_end(facts).alias("year_end"),
    )
    return (
        answered(landed)
        .select("cik", _facts(landed).alias("facts"))
        .select("cik", once(figures).alias("f"))
        .select("cik", "f.*")
    )


def document_covers(documents: DataFrame) -> DataFrame:
    """Landed documents with their cover text instead of the HTML.

    ``cover`` is NULL where the fetch failed or the document cannot be parsed. Runs map-only:
    no shuffle ever carries the HTML.
    """
    html = F.when(outcome(F.col("http_status")) == OK, F.col("html"))
    return documents.withColumn("cover", cover_text(html)).drop("html", "http_status")
