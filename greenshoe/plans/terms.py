"""Offering terms of a batch of landed documents."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from greenshoe import fixed_values as V
from greenshoe.functions import offering as O
from greenshoe.functions.dialect import ascii_digits, once, regex, whole_number
from greenshoe.functions.text import normalize_whitespace, strip
from greenshoe.operators.latest import latest_by, newest_landed

TERMS = ["offering_type", "shares_offered", "price_low", "price_high", "extraction_method"]

DAILY, BACKFILL = "daily", "backfill"


TYPE, PRICE, SHARES = "type", "price", "shares"


def extract(covers: DataFrame, parts: tuple[str, ...] = (TYPE, PRICE, SHARES)) -> DataFrame:
    """Terms of every cover; the other columns stay, ``cover`` too.

    A cover that is NULL, or whose share count has no digit, gives an error row: type unknown,
    method ``error`` and no figures. Only the columns of ``parts`` are made, and the method. Shares
    are looked for in any case, as they decide which rows are error rows.
    """
    text = F.col("_text")
    ways = {TYPE: O.offering_type(F.col("_lower")), PRICE: O.price(text), SHARES: O.shares(text)}
    found = F.struct(*[c.alias(part) for part, c in ways.items() if part in (*parts, SHARES)])
    failed = F.col("cover").isNull() | F.coalesce(F.col("_f.shares") == O.NO_DIGITS, F.lit(False))

    def unless_failed(value: str, otherwise: str | None = None) -> Column:
        return F.when(F.col("_failed"), F.lit(otherwise)).otherwise(F.col(value))

    columns = {
        TYPE: [unless_failed("_f.type", V.UNKNOWN).alias("offering_type")],
        SHARES: [unless_failed("_f.shares").alias("shares_offered")],
        PRICE: [
            unless_failed("_f.price.low").alias("price_low"),
            unless_failed("_f.price.high").alias("price_high"),
        ],
    }
    return (
        covers.withColumn("_lower", F.lower("cover"))
        .withColumn("_text", normalize_whitespace(F.col("cover")))
        .withColumn("_text", ascii_digits(text))
        .select(*covers.columns, once(found).alias("_f"))
        .withColumn("_failed", failed)
        .select(
            *covers.columns,
            *[c for part, made in columns.items() if part in parts for c in made],
            F.when(F.col("_failed"), V.METHOD_ERROR)
            .otherwise(V.METHOD_REGEX)
            .alias("extraction_method"),
        )
    )


def needs_fallback() -> Column:
    """IPOs for which the patterns found neither price nor shares."""
    return (
        (F.col("extraction_method") == V.METHOD_REGEX)
        & (F.col("offering_type") == V.IPO)
        & F.col("price_low").isNull()
        & F.col("shares_offered").isNull()
    )


def fallback_requests(extracted: DataFrame, *keep: str) -> DataFrame:
    """The request table for the filings that need the fallback; ``keep`` names further columns."""
    sample = F.substring("cover", 1, V.FALLBACK_CHARS)
    prompt = F.concat(F.lit(V.FALLBACK_PROMPT), sample).alias("prompt")
    return extracted.where(needs_fallback()).select("accession_number", *keep, prompt)


_STRICT = {"allowSingleQuotes": "false"}


def _answers(listed: Column, kind: str) -> Column:
    """A list of answers, every figure as a value of one kind."""
    names = [name for name in TERMS if name != "extraction_method"]
    return F.from_json(listed, f"array<struct<{', '.join(f'{n} {kind}' for n in names)}>>", _STRICT)


def parse_responses(responses: DataFrame) -> DataFrame:
    """Terms from raw fallback answers ``(accession_number, raw)``, row by row.

    An answer that is no JSON gives ``llm_parse_error``; JSON that is no object is an error row, and
    so is one with a figure that is no number, or a share count that is not whole or too large.
    JSON is read leniently: of repeated keys the last counts, and NaN and the infinities are numbers.
    The type defaults to unknown only where its key is absent. Figures are not range-checked.
    """
    unfenced = strip(F.col("raw"))
    for fence in (V.FENCE_START_PATTERN, V.FENCE_END_PATTERN):
        unfenced = F.regexp_replace(unfenced, regex(fence), "")
    # As the only element of a list, so that nothing may follow the value.
    listed = F.concat(F.lit("["), F.col("_text"), F.lit("]"))
    values = F.from_json(listed, "array<string>", _STRICT)
    is_object = F.ltrim("_text", F.lit(" \n\r\t")).startswith("{")
    is_json, answer, written = F.col("_is_json"), F.col("_answer"), F.col("_written")

    def text(name: str) -> Column:
        return F.try_variant_get(answer[name], "$", "string")

    def odd(name: str) -> Column:
        # A variant tells a number from a string; an object that it cannot hold is there as text.
        kind = F.schema_of_variant(answer[name])
        is_number = kind.rlike(r"^(BIGINT|DECIMAL\(.*\)|DOUBLE|FLOAT|VOID)$")
        return F.coalesce(~is_number, written[name].isNotNull())

    shares = whole_number(text("shares_offered"))
    is_whole = F.coalesce(shares == text("shares_offered").try_cast("double"), F.lit(False))
    bad_shares = text("shares_offered").isNotNull() & ~is_whole
    is_odd = odd("shares_offered") | odd("price_low") | odd("price_high") | bad_shares
    offering_type = F.when(answer["offering_type"].isNull(), V.UNKNOWN).otherwise(
        text("offering_type")
    )
    fits = F.col("_fits")

    return (
        responses.withColumn("_text", unfenced)
        .withColumn("_is_json", F.coalesce(F.size(values) == 1, F.lit(False)))
        .withColumn("_answer", F.when(is_json & is_object, _answers(listed, "VARIANT")[0]))
        .withColumn("_written", F.when(is_json & is_object, _answers(listed, "STRING")[0]))
        .withColumn("_fits", answer.isNotNull() & ~is_odd)
        .select(
            "accession_number",
            F.when(fits, offering_type).otherwise(V.UNKNOWN).alias("offering_type"),
            F.when(fits, shares).alias("shares_offered"),
            F.when(fits, text("price_low").try_cast("double")).alias("price_low"),
            F.when(fits, text("price_high").try_cast("double")).alias("price_high"),
            F.when(fits, V.METHOD_FALLBACK)
            .when(is_json, V.METHOD_ERROR)
            .otherwise(V.METHOD_FALLBACK_UNPARSED)
            .alias("extraction_method"),
        )
    )


def fold_responses(
    extracted: DataFrame,
    responses: DataFrame,
    filings: DataFrame | None = None,
) -> DataFrame:
    """Replace the terms of the filings that needed the fallback by its answer.

    A filing whose answer never came is an error row; of several answers the newest is taken. With
    ``filings`` given, only documents of those filings are kept. The cover is dropped before the
    join, so only short rows are shuffled, and once for both purposes. Accession numbers are all
    but unique; the few that have very many copies are left to adaptive execution.
    """
    short = extracted.drop("cover").withColumn("_open", needs_fallback())
    once_each = latest_by(responses, ["accession_number"], newest_landed(responses))
    answers = parse_responses(once_each).select(
        "accession_number", F.struct(*TERMS).alias("_answer")
    )
    error = F.struct(
        F.lit(V.UNKNOWN).alias("offering_type"),
        F.lit(None).cast("bigint").alias("shares_offered"),
        F.lit(None).cast("double").alias("price_low"),
        F.lit(None).cast("double").alias("price_high"),
        F.lit(V.METHOD_ERROR).alias("extraction_method"),
    )
    if filings is None:
        joined = short.join(answers, "accession_number", "left")
    else:
        wanted = filings.select("accession_number").distinct()
        answers = wanted.join(answers, "accession_number", "left")
        joined = short.join(answers, "accession_number")
    own = F.struct(*TERMS)
    chosen = F.when(F.col("_open"), F.coalesce("_answer", error)).otherwise(own)
    others = [c for c in short.columns if c not in TERMS and c != "_open"]
    return joined.select(*others, chosen.alias("_t")).select(*others, "_t.*")


def typed(terms: DataFrame, schema: StructType) -> DataFrame:
    """Columns as the table has them. Answers of the fallback are not range-checked, so a figure
    may not fit; its row is an error row then."""
    cast = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema}
    figures = ["shares_offered", "price_low", "price_high"]
    misfits = [F.col(c).isNotNull() & cast[c].isNull() for c in figures]
    fits = ~(misfits[0] | misfits[1] | misfits[2])
    errors = {"offering_type": V.UNKNOWN, "extraction_method": V.METHOD_ERROR}
    columns = [
        F.when(fits, cast[f.name]).otherwise(F.lit(errors.get(f.name)).cast(f.dataType))
        if f.name in figures or f.name in errors
        else cast[f.name]
        for f in schema
    ]
    return terms.select(*[c.alias(f.name) for c, f in zip(columns, schema)])


def keep_for(mode: str, terms: DataFrame) -> DataFrame:
    """The daily job stores error rows, the backfill drops them."""
    if mode == DAILY:
        return terms
    if mode == BACKFILL:
        return terms.where(F.col("extraction_method") != V.METHOD_ERROR)
    raise ValueError(f"unknown mode {mode!r}")
