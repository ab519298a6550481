"""The registered queries and the plain SQL each one must agree with."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from greenshoe.cases.derived import Tables, with_clause

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, reads: list[str] | None = None, sql: str | None = None):
    """Register a function of ``Tables``; ``sql`` may use the derived tables in ``reads``."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = with_tables(reads or [], sql)
        return build

    return register


def with_tables(reads: list[str], sql: str) -> str:
    tables = with_clause(*reads)
    return f"WITH {tables}\n{sql}" if tables else sql
