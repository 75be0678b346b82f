"""Silver and gold of the given tables, written once per session.

Serving and quality questions are asked of stored tables.  They are derived
from the given tables, kept in the shared staging folder and read from there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from postlake.fixtures import raw_postings
from postlake.plans import gold
from postlake.plans.silver import complete_postings, to_silver
from postlake.session import staging_root

TIE_BREAKS = ("posting_key",)

_tables: dict[str, DataFrame] = {}


def staging_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    data = hashlib.md5(sf_dir.encode()).hexdigest()[:12]
    run = spark.sparkContext.applicationId
    return f"{staging_root(spark)}/{run}/{data}/{name}"


def staged(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The named table; made and written on first use in this session."""
    path = staging_path(spark, sf_dir, name)
    if path not in _tables:
        make().write.mode("overwrite").option("compression", "zstd").parquet(path)
        _tables[path] = spark.read.parquet(path)
    return _tables[path]


_done: set[str] = set()


def once(path: str, write: Callable[[], None]) -> None:
    """Run a write once per session: earlier readers of the path keep their files."""
    if path not in _done:
        write()
        _done.add(path)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make() -> DataFrame:
        return complete_postings(raw_postings(spark, sf_dir), tie_breaks=TIE_BREAKS)

    return staged(spark, sf_dir, "silver", make)


def unchecked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All postings in silver shape, neither split nor deduplicated."""
    return staged(
        spark, sf_dir, "unchecked", lambda: to_silver(raw_postings(spark, sf_dir))
    )


_BUILDERS = {
    "dim_company": gold.dim_company,
    "dim_location": gold.dim_location,
    "dim_job_category": gold.dim_job_category,
    "dim_skill": gold.dim_skill,
    "dim_level": gold.dim_level,
    "fact_job_postings": gold.fact_job_postings,
    "bridge_job_skills": partial(gold.bridge_job_skills, one_row_per_job=True),
}


class StagedStar:
    """A star schema whose tables are made when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in _BUILDERS:
            raise AttributeError(name)
        spark, sf_dir = self._spark, self._sf_dir
        return staged(spark, sf_dir, name, lambda: _BUILDERS[name](silver(spark, sf_dir)))


class UncheckedStar(StagedStar):
    """The same dimensions next to facts and links of all postings, so that the
    quality checks have something to find."""

    def __getattr__(self, name: str) -> DataFrame:
        if name == "fact_job_postings":
            build = gold.fact_job_postings
        elif name == "bridge_job_skills":
            build = gold.bridge_job_skills
        else:
            return super().__getattr__(name)
        spark, sf_dir = self._spark, self._sf_dir
        return staged(spark, sf_dir, f"unchecked_{name}", lambda: build(unchecked(spark, sf_dir)))
