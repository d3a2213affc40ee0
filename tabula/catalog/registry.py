"""Query registry and access to the input tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.catalog import fixtures
from tabula.plans.cleaning import clean_domains, clean_ips, clean_pulses, clean_vulnerabilities
from tabula.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """Input tables of one folder, and the reference-shaped tables derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        # only local sessions set this: tables of one small file then use every core
        self.parts = int(spark.conf.get("tabula.local.parts", "0"))

    def __getattr__(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)

    def derived(self, name: str) -> DataFrame:
        text, inputs = fixtures.spark_sql(name)
        tables = {i: read_table(self.spark, self.folder, i, parts=self.parts if i == inputs[0] else None) for i in inputs}
        return self.spark.sql(text, **tables)

    def spread(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name, parts=self.parts)

    def pulses(self) -> DataFrame:
        return clean_pulses(self.derived("pulses_raw"), ["seq"])

    def vulnerabilities(self) -> DataFrame:
        return clean_vulnerabilities(
            self.derived("vulnerabilities_raw"), ["seq", "dueDate", "vulnerabilityName"])

    def domains(self) -> DataFrame:
        return clean_domains(self.derived("domains_raw"))

    def ips(self) -> DataFrame:
        return clean_ips(self.derived("ips_raw"), ["seq"])


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Tables` under a name, with the SQL it must agree with."""
    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLE[name] = fixtures.with_prelude(sql)
        return build
    return register


def r6(column: Column | str) -> Column:
    """Round to six places (the oracle does the same); adding zero removes a negative zero."""
    return F.round(F.col(column) if isinstance(column, str) else column, 6) + F.lit(0.0)
