"""Union of the counties and the flattened export."""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmill.operators import joins
from parcelmill.plans.harris import HarrisFiles
from parcelmill.schemas import property_schema


STATUS_DDL = "county string, status string, error string, records bigint"


def _written(spark: SparkSession, builders: dict[str, Callable[[], DataFrame]], root: str) -> dict[str, int | Exception]:
    """For each county the number of its records, or the error that ended its job.

    Each county is a job of its own, which writes to its own folder under `root`; they run side by side.
    """

    def load(county: str) -> int | Exception:
        try:
            builders[county]().write.parquet(f"{root}/{county}")
            return _read(spark, root, [county]).count()
        except Exception as error:  # whatever ends one county's job must not end the others'
            return error

    with ThreadPoolExecutor(len(builders) or 1) as pool:
        return dict(zip(builders, pool.map(load, builders), strict=True))


def _read(spark: SparkSession, root: str, counties: list[str]) -> DataFrame:
    paths = [f"{root}/{county}" for county in counties]
    return spark.read.schema(property_schema()).parquet(*paths) if paths else spark.createDataFrame([], property_schema())


def _first_line(error: Exception) -> str:
    return (str(error).splitlines() or [type(error).__name__])[0]


def union_counties(
    spark: SparkSession, builders: dict[str, Callable[[], DataFrame]], root: str
) -> tuple[DataFrame, DataFrame]:
    """Records of all counties that could be built, and a status row per county.

    A county that fails, be it while its files are found or while they are read, fails alone: its status is `failed`,
    with the error's first line, and nothing of it is among the records. A caller that does not give the status on
    needs `all_counties`.
    """
    done = _written(spark, builders, root)
    failed = {county: _first_line(n) for county, n in done.items() if isinstance(n, Exception)}
    status = [(c, "failed", failed[c], 0) if c in failed else (c, "ok", None, n) for c, n in done.items()]
    return _read(spark, root, [c for c in done if c not in failed]), spark.createDataFrame(status, STATUS_DDL)


def all_counties(spark: SparkSession, builders: dict[str, Callable[[], DataFrame]], root: str) -> DataFrame:
    """Records of all counties; if any of them fails, an error that names each that did."""
    done = _written(spark, builders, root)
    failed = {county: n for county, n in done.items() if isinstance(n, Exception)}
    if failed:
        said = "; ".join(f"{county}: {_first_line(error)}" for county, error in failed.items())
        raise RuntimeError(f"counties that could not be built: {said}") from next(iter(failed.values()))
    return _read(spark, root, [*done])


def flat_export(files: HarrisFiles, key: str = "acct") -> DataFrame:
    """Account columns, primary owner, neighbourhood, mineral flag and child counts, one row each.

    The frames must carry the same (normalised) `key`.
    """
    out = files.accounts
    if files.owners is not None:
        out = out.join(joins.primary_owner(files.owners, key), key, "left")
    if files.neighborhoods is not None:
        codes = files.neighborhoods.select(
            "cd",
            F.col("dscr").alias("neighborhood_description"),
            F.col("grp_cd").alias("neighborhood_group"),
        )
        out = joins.lookup_join(out, codes, "market_area_1", "cd")
    if files.minerals is not None:
        out = joins.with_existence_flag(out, files.minerals, key, "has_mineral_rights")
    for child, name in [
        (files.owners, "total_owners"),
        (files.deeds, "total_deeds"),
        (files.permits, "total_permits"),
    ]:
        if child is not None:
            out = joins.with_child_count(out, child, key, name)
    return out
