"""Query registration: a Spark callable and, next to it, its DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ebbline.session import work_dir
from workload.fixtures import oracle, view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Views:
    """``t.logs`` is the fixture view or base table ``logs`` of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._stored: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name, self._stored)

    def store(self, name: str, df: DataFrame | None = None) -> DataFrame:
        """Write a control table once in the shared folder, as a run does, and read it back.

        Later uses of the view, also by other views, read the stored rows.
        """
        if name not in self._stored:
            df = getattr(self, name) if df is None else df
            path = work_dir(self.spark, name)
            df.write.parquet(path)
            self._stored[name] = self.spark.read.schema(df.schema).parquet(path)
        return self._stored[name]


def query(sql: str | None = None):
    """Register a function of ``Views`` under its name, with its oracle SQL."""
    def add(fn):
        name = fn.__name__
        QUERIES[name] = lambda spark, sf_dir: fn(Views(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return fn
    return add
