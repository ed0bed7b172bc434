from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from millrace.sources import load

FAMILIES = ("tables", "recommend", "vectors", "binary", "features", "predict", "series", "lifetime")


@dataclass
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


class Tables:
    """Short access to the tables of one directory."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark, self.directory = spark, directory

    def __call__(self, name: str, *columns: str) -> DataFrame:
        return load(self.spark, self.directory, name, columns or None)


_found: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def add(build: Callable[[Tables], DataFrame]):
        _found[name] = Query(lambda spark, directory: build(Tables(spark, directory)), sql)
        return build

    return add


def all_queries() -> dict[str, Query]:
    for family in FAMILIES:
        importlib.import_module(f"millrace.plans.{family}")
    return dict(_found)
