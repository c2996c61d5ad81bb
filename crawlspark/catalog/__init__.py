"""Registered queries, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from crawlspark.catalog import crawl, pages, rules, schedule, scalars, streams, writes
from crawlspark.catalog.fixtures import Tables, with_fixtures

_MODULES = (scalars, pages, rules, writes, schedule, crawl, streams)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {}
    for module in _MODULES:
        for name, build in module.QUERIES.items():
            found[name] = lambda spark, folder, build=build: build(Tables(spark, folder))
    return found


def oracles() -> dict[str, str]:
    return {name: with_fixtures(sql) for module in _MODULES for name, sql in module.ORACLES.items()}
