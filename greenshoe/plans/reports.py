"""Profiling and reporting queries."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from greenshoe import fixed_values as V
from greenshoe.functions import text as X
from greenshoe.functions.dialect import once
from greenshoe.plans.mart import with_benchmark
from greenshoe.sources.landed import document_covers


def top_valued(base: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` highest price-to-sales ratios; only these rows of the base are flagged."""
    highest = [F.desc("price_to_sales_ratio"), F.asc("accession_number")]
    top = base.where(F.col("price_to_sales_ratio").isNotNull()).orderBy(*highest).limit(n)
    return (
        with_benchmark(base, top)
        .orderBy(*highest)
        .select("company_name", "sector", "price_to_sales_ratio", "valuation_flag")
    )


def sector_summary(mart: DataFrame) -> DataFrame:
    return mart.groupBy("sector").agg(
        F.count("*").alias("ipo_count"), F.avg("implied_market_cap").alias("avg_market_cap")
    )


def type_breakdown(terms: DataFrame) -> DataFrame:
    """Filings per offering type, most frequent first; error rows and NULL are not counted."""
    read = F.col("offering_type").isNotNull() & (F.col("extraction_method") != V.METHOD_ERROR)
    counts = terms.where(read).groupBy("offering_type").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc("offering_type"))


def extraction_rate(terms: DataFrame) -> DataFrame:
    """Number of IPOs and the share of them for which a price was found."""
    found = F.col("price_low").isNotNull().cast("int")
    return terms.where(F.col("offering_type") == V.IPO).agg(
        F.count("*").alias("ipos"), F.avg(found).alias("price_rate")
    )


def ipo_listing(terms: DataFrame, filings: DataFrame) -> DataFrame:
    """The IPOs among extracted terms with their company and what was found for each."""
    names = filings.select("accession_number", F.col("company_name").alias("company"))
    columns = ["company", "cik", "accession_number", "filing_date", "shares_offered", "price_low"]
    ipos = terms.where(F.col("offering_type") == V.IPO)
    return ipos.join(names, "accession_number").select(*columns)


def extracted() -> Column:
    """How many terms were extracted; error rows do not count."""
    return F.count_if(F.col("extraction_method") != V.METHOD_ERROR)


def run_summary(filings: DataFrame, terms: DataFrame, companies: DataFrame) -> DataFrame:
    """Counts of a run from its batch: filings, their extracted terms, companies with metadata."""

    def counted(df: DataFrame, measure: str, count: Column) -> DataFrame:
        return df.agg(count.alias("n")).select(F.lit(measure).alias("measure"), "n")

    return (
        counted(filings, "filings", F.count("*"))
        .unionByName(counted(terms, "extracted", extracted()))
        .unionByName(counted(companies, "companies", F.count("*")))
    )


def sample_filings(filings: DataFrame, n: int) -> DataFrame:
    """The first ``n`` filings, newest first."""
    return filings.orderBy(F.desc("filing_date"), F.asc("accession_number")).limit(n)


def with_dollar_phrases(covers: DataFrame) -> DataFrame:
    """The start of every cover and the dollar phrases of the whole cover."""
    return covers.select(
        *covers.columns,
        F.substring("cover", 1, V.SAMPLE_CHARS).alias("cover_3000"),
        once(X.dollar_phrases(F.col("cover"))).alias("dollar_matches"),
    )


def with_share_phrases(covers: DataFrame) -> DataFrame:
    """The first phrases of the whole cover that look like a large share count."""
    phrases = once(X.share_phrases(F.col("cover"))).alias("share_matches")
    return covers.select(*covers.columns, phrases)


def _numbered(filings: DataFrame, n: int) -> DataFrame:
    """The first ``n`` filings, newest first, numbered from 0. The numbering sees ``n`` rows."""
    newest = Window.orderBy(F.desc("filing_date"), F.asc("accession_number"))
    return sample_filings(filings, n).withColumn("index", F.row_number().over(newest) - 1)


def _chosen_covers(chosen: DataFrame, documents: DataFrame) -> DataFrame:
    """Covers of the chosen filings; only their documents are parsed, and only they broadcast."""
    keys = ["cik", "accession_number", "filing_date"]
    return document_covers(documents.join(F.broadcast(chosen), keys))


def cover_samples(filings: DataFrame, documents: DataFrame, n: int) -> DataFrame:
    """The rows of the sample file: the first ``n`` filings, numbered, with their covers.

    Filings without a readable document are left out; ``failed_samples`` lists them.
    """
    covers = _chosen_covers(_numbered(filings, n), documents)
    return with_dollar_phrases(covers.where(F.col("cover").isNotNull())).select(
        "index",
        F.col("company_name").alias("company"),
        "cik",
        F.col("filing_date").cast("string").alias("filing_date"),
        F.col("filing_url").alias("url"),
        "cover_3000",
        "dollar_matches",
    )


def failed_samples(filings: DataFrame, documents: DataFrame, n: int) -> DataFrame:
    """Those of the first ``n`` filings that have no readable document."""
    chosen = _numbered(filings, n)
    read = _chosen_covers(chosen, documents).where(F.col("cover").isNotNull())
    return chosen.join(read.select("index"), "index", "left_anti").select(
        "index",
        F.col("company_name").alias("company"),
        "cik",
        "accession_number",
        F.col("filing_date").cast("string").alias("filing_date"),
        F.col("filing_url").alias("url"),
    )


def without_dollars(samples: DataFrame) -> DataFrame:
    return samples.where(F.size("dollar_matches") == 0)


def phrase_frequency(samples: DataFrame, n: int = V.FREQUENT_PHRASES_KEPT) -> DataFrame:
    """The ``n`` most frequent dollar phrases, numbers masked."""
    phrases = samples.select(F.explode("dollar_matches").alias("phrase"))
    counts = phrases.groupBy(X.mask_numbers(F.col("phrase")).alias("masked")).agg(
        F.count("*").alias("n")
    )
    return counts.orderBy(F.desc("n"), F.asc("masked")).limit(n)


def distinct_phrases(samples: DataFrame, order: list[str]) -> DataFrame:
    """Every distinct masked phrase with its first original, in the order of the given columns."""
    phrases = samples.select(
        *order, F.posexplode("dollar_matches").alias("position", "phrase")
    ).withColumn("masked", X.mask_digits(F.col("phrase")))
    first = F.min_by("phrase", F.struct(*order, "position"))
    return phrases.groupBy("masked").agg(
        F.substring(first, 1, V.PHRASE_SHOWN_CHARS).alias("example")
    )


def share_phrase_report(samples: DataFrame, names: list[str]) -> DataFrame:
    """Share-count phrases of the companies whose name contains one of ``names``, and the start
    of the cover they are looked for in."""
    return samples.where(X.name_contains_any(F.col("company"), names)).select(
        "company",
        F.substring("cover_3000", 1, V.SHARE_PREVIEW_CHARS).alias("preview"),
        X.share_phrases(F.col("cover_3000")).alias("share_phrases"),
    )
