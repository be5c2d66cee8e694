"""Registry of named queries: a Spark builder and, where SQL can say it, a DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    key: str
    build: Builder
    oracle: str | None
    survey_ids: str


REGISTRY: dict[str, Entry] = {}


def register(key: str, oracle: str | None = None, ids: str = ""):
    def deco(fn: Builder) -> Builder:
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Entry(key, fn, oracle, ids)
        return fn
    return deco


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every floating column: JVM and C maths may differ in the last digit."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.round(F.col(f"`{f.name}`"), places).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)
