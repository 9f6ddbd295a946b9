"""Where queries and their check texts are kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundledger.catalog.views import with_views

Query = Callable[[SparkSession, str], DataFrame]

# Numbers this large have too few binary digits left for seven decimals.
LARGE = 1e8

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def shown(df: DataFrame) -> DataFrame:
    """Plain types for comparing results: numbers as long or rounded double, dates and lists as text."""

    def plain(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            c = c.cast("double")
            c = F.when(F.abs(c) >= LARGE, F.round(c, 2)).otherwise(F.round(c, 7))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, "|")
        return c.alias(f.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def register(name: str, run: Query, views: str = "", check: str | None = None) -> None:
    """Add a query; ``check`` is the SQL that must give the same rows, over the named views."""
    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")
    QUERIES[name] = lambda spark, sf: shown(run(spark, sf))
    if check is not None:
        CHECKS[name] = with_views(views, check) if views else check.strip()


def r(expr: str) -> str:
    """SQL: a number as double, to 7 places or to 2 when it is large."""
    x = f"CAST({expr} AS DOUBLE)"
    return f"CASE WHEN ABS({x}) >= 1e8 THEN ROUND({x}, 2) ELSE ROUND({x}, 7) END"


def d(expr: str) -> str:
    """SQL: a date as text."""
    return f"CAST({expr} AS VARCHAR)"
