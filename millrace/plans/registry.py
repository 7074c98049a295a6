"""All queries of the library and the SQL that each must agree with."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
MODULES = ["catalog_queries", "table_queries", "value_queries", "ontology_queries", "search_queries", "ingest_queries"]


def _gather(attribute: str) -> dict:
    out: dict = {}
    for name in MODULES:
        part = getattr(importlib.import_module(f"millrace.plans.{name}"), attribute)
        if clash := out.keys() & part.keys():
            raise ValueError(f"queries defined twice: {sorted(clash)}")
        out |= part
    return out


def queries() -> dict[str, Query]:
    return _gather("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _gather("SQL")
