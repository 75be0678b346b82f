"""Data-quality checks on the star schema (DQ-1 to DQ-6)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.operators import aggregate
from postlake.operators.columns import union_by_name
from postlake.operators.filters import salary_inverted, salary_negative
from postlake.plans.serving import Star
from postlake.sinks.keyed import KEY_PARTITION, parts_slice
from postlake.sinks.tables import publish_version

_SALARY = ("job_id", "salary_min", "salary_max")


def completeness(star: Star) -> DataFrame:
    """DQ-1."""
    return aggregate.null_counts(
        star.fact_job_postings,
        {
            "null_titles": "job_title",
            "null_companies": "company_id",
            "null_locations": "location_id",
            "null_sources": "source",
        },
    )


def duplicates(table: DataFrame, key: str) -> DataFrame:
    """DQ-2: expected to be empty."""
    return aggregate.duplicates(table, key)


def orphaned_companies(star: Star) -> DataFrame:
    """DQ-3, as the next three: expected to be 0."""
    return aggregate.orphans(
        star.fact_job_postings, star.dim_company, "company_id", "orphaned_companies"
    )


def orphaned_locations(star: Star) -> DataFrame:
    return aggregate.orphans(
        star.fact_job_postings, star.dim_location, "location_id", "orphaned_locations"
    )


def orphaned_categories(star: Star) -> DataFrame:
    return aggregate.orphans(
        star.fact_job_postings, star.dim_job_category, "job_category_id", "orphaned_categories"
    )


def orphaned_levels(star: Star) -> DataFrame:
    return aggregate.orphans(star.fact_job_postings, star.dim_level, "level_id", "orphaned_levels")


def invalid_bridge_jobs(star: Star) -> DataFrame:
    """DQ-4, as the next: a NULL key counts; expected to be 0."""
    return aggregate.orphans(
        star.bridge_job_skills,
        star.fact_job_postings,
        "job_id",
        "invalid_bridge_jobs",
        nulls_count=True,
    )


def invalid_bridge_skills(star: Star) -> DataFrame:
    return aggregate.orphans(
        star.bridge_job_skills,
        star.dim_skill,
        "skill_id",
        "invalid_bridge_skills",
        nulls_count=True,
    )


def salary_inverted_rows(facts: DataFrame) -> DataFrame:
    """DQ-5."""
    return facts.filter(salary_inverted()).select(*_SALARY)


def salary_negative_rows(facts: DataFrame) -> DataFrame:
    """DQ-6."""
    return facts.filter(salary_negative()).select(*_SALARY)


# --- orphan counts carried forward ------------------------------------------------------

DIMENSIONS = {
    "orphaned_companies": ("dim_company", "company_id"),
    "orphaned_locations": ("dim_location", "location_id"),
    "orphaned_categories": ("dim_job_category", "job_category_id"),
    "orphaned_levels": ("dim_level", "level_id"),
}


def _orphans_by_part(facts: DataFrame, dim: DataFrame, key: str, name: str) -> DataFrame:
    """check_name, key_part and n; only parts that have orphans."""
    per_key = facts.where(F.col(key).isNotNull()).groupBy(KEY_PARTITION, key).agg(F.count(F.lit(1)).alias("_n"))
    lost = per_key.join(dim.select(key), key, "left_anti")
    return lost.groupBy(KEY_PARTITION).agg(F.sum("_n").alias("n")).select(F.lit(name).alias("check_name"), KEY_PARTITION, "n")


def carry_orphans_forward(
    spark: SparkSession, facts: str, dims: Mapping[str, tuple[DataFrame, str]], state: str, touched: Iterable[int] | None = None
) -> None:
    """DQ-3 after an upsert of the keyed table ``facts`` that rewrote the parts ``touched``.

    The table ``state`` holds orphans by part.  Counted again are the touched parts and those that had
    orphans: dimensions gain keys and lose none, so a part without orphans that was not touched
    has none now.  Without ``touched``, or the first time, all parts are counted."""
    rows = spark.table(facts)
    known = spark.catalog.tableExists(state)
    kept = None
    if known and touched is not None:
        had = {r[0] for r in spark.table(state).select(KEY_PARTITION).distinct().collect()}
        again = sorted(had | set(touched))  # at most as many as the table has parts
        rows = parts_slice(spark, facts, again)
        kept = spark.table(state).where(~F.col(KEY_PARTITION).isin(again))
    found = union_by_name([_orphans_by_part(rows, dim, key, name) for name, (dim, key) in dims.items()])
    publish_version(found if kept is None else found.unionByName(kept), state)


def carried_orphans(spark: SparkSession, state: str, names: Iterable[str] = DIMENSIONS) -> DataFrame:
    """check_name and n of every check, 0 where no part has orphans."""
    checks = spark.createDataFrame([(name,) for name in names], "check_name string")
    sums = spark.table(state).groupBy("check_name").agg(F.sum("n").alias("n"))
    return checks.join(sums, "check_name", "left").select("check_name", F.coalesce("n", F.lit(0)).alias("n"))
