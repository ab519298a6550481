"""Data-quality checks. A check returns the failing rows; none means it passed.

NULL passes every check but ``not_null``.
"""

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenshoe import fixed_values as V


def unique(df: DataFrame, key: str | list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    keys = [key] if isinstance(key, str) else key
    present = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    return df.where(present).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    return df.where(~F.col(column).isin(values))


def accepted_range(df: DataFrame, column: str, low, high) -> DataFrame:
    return df.where(~F.col(column).between(low, high))


def expression_is_true(df: DataFrame, expression: str) -> DataFrame:
    return df.where(~F.expr(expression))


@dataclass(frozen=True)
class Check:
    """One check of the suite; ``failing`` is the condition of a bad row."""

    test: str
    table: str
    column: str
    failing: Column | None = field(default=None, compare=False)

    @property
    def label(self) -> str:
        return f"{self.test}:{self.column}"


def suite() -> list[Check]:
    """The declared checks, table by table."""
    low_price, high_price = V.PRICE_RANGE
    low_shares, high_shares = V.SHARES_RANGE

    def missing(table: str, column: str) -> Check:
        return Check("not_null", table, column, F.col(column).isNull())

    def outside(table: str, column: str, low, high) -> Check:
        return Check("accepted_range", table, column, ~F.col(column).between(low, high))

    types = ~F.col("offering_type").isin(V.OFFERING_TYPES)
    fact = "fct_ipo_offerings"
    return [
        Check("unique", "companies", "cik"),
        missing("companies", "cik"),
        missing("prospectus_filings", "cik"),
        missing("prospectus_filings", "accession_number"),
        Check("accepted_values", "offering_terms", "offering_type", types),
        Check("unique", fact, "accession_number"),
        missing(fact, "accession_number"),
        missing(fact, "cik"),
        missing(fact, "final_price"),
        outside(fact, "final_price", low_price, high_price),
        missing(fact, "shares_offered"),
        outside(fact, "shares_offered", low_shares, high_shares),
        Check("expression_is_true", fact, "gross_proceeds", ~(F.col("gross_proceeds") > 0)),
    ]


def report(tables: dict[str, DataFrame]) -> DataFrame:
    """``(test, table, column, failures)`` for the whole suite.

    Every table is read once. Its rows are counted by the key that has to be unique, together with
    the failures of all row-wise checks, and the counts of the keys are summed. Keys are counted
    before the shuffle too, so a key with very many rows stays cheap.
    """
    parts = []
    for name, df in tables.items():
        checks = [c for c in suite() if c.table == name]
        keys = [c.column for c in checks if c.failing is None]
        if not checks:
            continue
        parts += [_counted(df, checks, key) for key in keys[:1] or [None]]
        # A second key cannot share the grouping of the first.
        parts += [_counted(df, [c for c in checks if c.column == key and c.failing is None], key)
                  for key in keys[1:]]
    return reduce(DataFrame.unionByName, parts)


def _counted(df: DataFrame, checks: list[Check], key: str | None) -> DataFrame:
    """The failures of the checks; of the uniqueness checks only that of ``key`` is counted."""
    row_wise = [c for c in checks if c.failing is not None]
    failures = [F.count_if(c.failing).alias(c.label) for c in row_wise]
    sums = [F.coalesce(F.sum(f"`{c.label}`"), F.lit(0)).alias(c.label) for c in row_wise]
    counted = [*row_wise]
    if key is None:
        counts = df.agg(*failures)
    else:
        (unique_key,) = [c for c in checks if c.failing is None and c.column == key]
        counted.append(unique_key)
        repeated = F.count_if(F.col("_key").isNotNull() & (F.col("_n") > 1))
        by_key = df.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n"), *failures)
        counts = by_key.agg(*sums, repeated.alias(unique_key.label))
    rows = F.array(*[_row(c, F.col(f"`{c.label}`")) for c in counted])
    return counts.select(F.inline(rows))


def _row(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.test).alias("test"),
        F.lit(check.table).alias("table"),
        F.lit(check.column).alias("column"),
        failures.alias("failures"),
    )
