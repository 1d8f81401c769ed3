"""Registry of named queries and their oracle SQL."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from parcelmill.fixtures import fixture, oracle_sql_with
from parcelmill.session import prepare


@dataclass(frozen=True)
class Inputs:
    """The tables a query may read."""

    spark: SparkSession
    sf_dir: str

    def __post_init__(self):
        prepare(self.spark)

    def view(self, name: str) -> DataFrame:
        return fixture(self.spark, self.sf_dir, name)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    run: Callable[[Inputs], DataFrame]
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def query(key: str, views: str = "", sql: str | None = None):
    """Register a query; `views` are the sample sources its oracle reads."""

    def register(run: Callable[[Inputs], DataFrame]):
        if key in REGISTRY:
            raise ValueError(f"query {key} is registered twice")
        oracle = None if sql is None else (oracle_sql_with(views, sql) if views else sql)
        REGISTRY[key] = Query(run, oracle)
        return run

    return register
