"""Registered queries and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeledger.catalog.inputs import Inputs, check_sql
from tradeledger.session import apply_skew_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}
# Named DuckDB texts that checks build on.
STAGES: dict[str, str] = {}


def plain(df: DataFrame, places: int = 6) -> DataFrame:
    """Decimals and doubles as doubles with a fixed number of places, for comparison."""
    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType | T.DoubleType | T.FloatType):
            column = F.round(column.cast("double"), places)
        out.append(column.alias(field.name))
    return df.select(*out)


def query(key: str, check: str | None = None, places: int = 6):
    """Register a function of the inputs under a key, with its DuckDB text."""

    def register(fn: Callable[[Inputs], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            apply_skew_settings(spark)
            return plain(fn(Inputs(spark, folder)), places)

        QUERIES[key] = run
        if check is not None:
            CHECKS[key] = check
        return fn

    return register


def check_texts() -> dict[str, str]:
    return {key: check_sql(text, STAGES) for key, text in CHECKS.items()}
