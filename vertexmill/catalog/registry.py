"""Collects queries with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vertexmill.catalog.oracle import with_blocks

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, blocks: dict[str, str] | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its checking SQL."""

    def keep(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = with_blocks(sql, blocks)
        return fn

    return keep


def r6(column: Column | str) -> Column:
    """Rounded to 6 places, without a negative zero."""
    value = F.col(column) if isinstance(column, str) else column
    return F.round(value, 6) + F.lit(0.0)


def rounded(df: DataFrame, *exact: str) -> DataFrame:
    """Every double column rounded, the named ones and all other types as they are."""
    doubles = {f.name for f in df.schema if f.dataType.simpleString() == "double"}
    return df.select(
        *[r6(c).alias(c) if c in doubles and c not in exact else F.col(c) for c in df.columns]
    )


def long_rows(vectors: DataFrame, column: str = "vec") -> DataFrame:
    """``(id, k, v)`` with rounded values."""
    return vectors.select("id", F.posexplode(column).alias("k", "v")).select(
        "id", F.col("k").cast("bigint").alias("k"), r6("v").alias("v")
    )
