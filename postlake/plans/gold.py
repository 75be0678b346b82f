"""Silver postings -> star schema (GLD-1 to GLD-7, PRJ-6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.functions.keys import link_id, name_id
from postlake.operators.columns import column_or_null, project_existing
from postlake.operators.filters import named
from postlake.operators.ranking import first_per_key, latest_first

# --- Fixed values: star-schema columns ------------------------------------------
COMPANY = (
    "company_id", "company_name", "company_industry", "company_size_std",
    "company_address", "company_link",
)
FACT = (
    "job_id", "source", "job_url", "job_title", "company_id", "location_id",
    "job_category_id", "level_id", "experience_req", "education", "working_type_std",
    "working_day", "working_hour", "salary_min", "salary_max", "salary_currency",
    "salary_band", "deadline_date", "inserted_at", "ingested_at",
)


def dim_company(silver: DataFrame) -> DataFrame:
    """GLD-1: the company as its latest posting describes it."""
    ties = [c for c in ("job_id",) if c in silver.columns]
    rows = silver.select(
        *(column_or_null(silver, c).alias(c) for c in COMPANY),
        *(c for c in ("ingested_at", *ties) if c in silver.columns),
    )
    latest = first_per_key(named(rows, "company_id"), ["company_id"], latest_first(rows, ties))
    return latest.select(*COMPANY)


def _dim_by_name(silver: DataFrame, column: str, name: str, key: str) -> DataFrame:
    names = named(silver.select(F.col(column).alias(name)), name).distinct()
    return names.withColumn(key, name_id(F.col(name)))


def dim_location(silver: DataFrame) -> DataFrame:
    """GLD-2."""
    return _dim_by_name(silver, "location", "location_name", "location_id")


def dim_job_category(silver: DataFrame) -> DataFrame:
    """GLD-3."""
    return _dim_by_name(silver, "job_category", "job_category_name", "job_category_id")


def _exploded(silver: DataFrame, *keep: str) -> DataFrame:
    """GEN-1: one row per listed skill; NULL and empty lists give none."""
    rows = silver.select(*keep, F.explode("skills_array").alias("skill_name"))
    return named(rows, "skill_name", no_blanks=True)


def dim_skill(silver: DataFrame) -> DataFrame:
    """GLD-4: case-sensitive."""
    return _exploded(silver).distinct().withColumn("skill_id", name_id(F.col("skill_name")))


def dim_level(silver: DataFrame) -> DataFrame:
    """GLD-5."""
    return _dim_by_name(silver, "level_processed", "level_name", "level_id")


def fact_job_postings(silver: DataFrame) -> DataFrame:
    """GLD-6: narrow; no exchange."""
    linked = silver.withColumns(
        {
            "location_id": name_id(F.col("location")),
            "job_category_id": name_id(F.col("job_category")),
            "level_id": name_id(F.col("level_processed")),
        }
    )
    return project_existing(linked, FACT)


def bridge_job_skills(silver: DataFrame, *, one_row_per_job: bool = False) -> DataFrame:
    """GLD-7: one row per posting and skill.

    ``one_row_per_job`` states what silver guarantees, a unique ``job_id``: then
    repeats can only sit within one list and no exchange is needed.
    """
    if one_row_per_job:
        silver = silver.withColumn("skills_array", F.array_distinct("skills_array"))
    links = _exploded(silver, "job_id").select("job_id", name_id(F.col("skill_name")).alias("skill_id"))
    if not one_row_per_job:
        links = links.distinct()
    return links.withColumn("bridge_id", link_id(F.col("job_id"), F.col("skill_id")))
