"""The thirteen column standardizers as DataFrame steps (STD-1 to STD-13).

A step is a few layers of columns, each computed from the one before: folded
text first, then labels, then what depends on labels.  Steps that run together
share their layers, so a chain of any length is three projections and no text
is folded or searched twice.

An absent input column stands for NULL, so its outputs are what the
expressions yield on NULL.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions import keys, labels, salary, skills, terms
from postlake.functions.text import folded
from postlake.operators.columns import column_or_null

Layer = dict[str, Column]


@dataclass(frozen=True)
class Step:
    """Columns by layer; names starting with "_" are dropped at the end."""

    layers: tuple[Layer, ...]


def run(df: DataFrame, steps: Iterable[Step]) -> DataFrame:
    """All steps, layer by layer."""
    merged: list[Layer] = []
    for step in steps:
        for depth, layer in enumerate(step.layers):
            if depth == len(merged):
                merged.append({})
            merged[depth].update(layer)
    for layer in merged:
        if layer:
            df = df.withColumns(layer)
    return df.drop(*(name for layer in merged for name in layer if name.startswith("_")))


def salary_step(df: DataFrame, salary_col: str = "salary") -> Step:
    raw = column_or_null(df, salary_col)
    first = {"_salary": folded(raw), "salary_raw": raw}
    return Step((first, salary.salary_fields("_salary")))


def band_step(df: DataFrame) -> Step:
    band = salary.salary_band("salary_min", "salary_max", "salary_currency")
    return Step(({}, {}, {"salary_band": band}))


def deadline_step(
    df: DataFrame, deadline_col: str = "deadline", reference_date_col: str = "ingested_at"
) -> Step:
    hcompat = reference_date_col in df.columns
    seen_on = F.col(reference_date_col) if hcompat else F.current_date()
    text = {"_deadline": column_or_null(df, deadline_col)}
    return Step((text, {"deadline_date": labels.deadline_date("_deadline", seen_on)}))


def _texts(df: DataFrame, column: str, name: str) -> Layer:
    raw = column_or_null(df, column)
    return {f"_{name}": folded(raw), f"_{name}_kept": F.trim(raw)}


def location_step(df: DataFrame, place_col: str = "place") -> Step:
    name = labels.place_name("_place", "_place_kept")
    return Step((_texts(df, place_col, "place"), {"location": name}))


def experience_step(df: DataFrame, exp_col: str = "experience") -> Step:
    text = {"_experience": folded(column_or_null(df, exp_col))}
    return Step((text, {"experience_req": labels.experience("_experience")}))


def level_step(df: DataFrame, level_col: str = "level") -> Step:
    name = labels.level_name("_level", "_level_kept")
    return Step((_texts(df, level_col, "level"), {"level_processed": name}))


def working_type_step(df: DataFrame, wt_col: str = "working_type") -> Step:
    name = labels.working_type("_working_type", "_working_type_kept")
    return Step((_texts(df, wt_col, "working_type"), {"working_type_std": name}))


def skills_step(df: DataFrame, skills_col: str = "skills") -> Step:
    listed = skills.no_skills()
    if skills_col in df.columns:
        listed = skills.skill_list(F.col(skills_col), df.schema[skills_col].dataType)
    return Step(({}, {"skills_array": listed}))


def title_skills_step(df: DataFrame, title_col: str = "job_title") -> Step:
    return Step(
        (
            {"_title": F.lower(F.col(title_col))},
            {"_found": skills.skills_found("_title")},
            {"skills_array": skills.with_title_skills("skills_array", "_found")},
        )
    )


def category_step(df: DataFrame, title_col: str = "job_title") -> Step:
    text = {"_title": F.lower(column_or_null(df, title_col))}
    return Step((text, {"job_category": labels.job_category("_title")}))


def company_size_step(df: DataFrame, size_col: str = "scale") -> Step:
    raw = column_or_null(df, size_col)
    text = {"_size": labels.bare_size(raw), "_size_kept": F.trim(raw)}
    return Step((text, {"company_size_std": labels.company_size("_size", "_size_kept")}))


def job_id_step(df: DataFrame, source_col: str = "source", url_col: str = "job_url") -> Step:
    return Step(({"job_id": keys.job_id(F.col(source_col), F.col(url_col))},))


def company_id_step(df: DataFrame, company_name_col: str = "company_name") -> Step:
    return Step(({"company_id": keys.company_id(column_or_null(df, company_name_col))},))


# --- one standardizer at a time ---------------------------------------------------


def extract_salary(df: DataFrame, salary_col: str = "salary") -> DataFrame:
    """STD-1: adds salary_raw, salary_min, salary_max, salary_currency."""
    return run(df, [salary_step(df, salary_col)])


def enrich_salary_band(df: DataFrame) -> DataFrame:
    """STD-2: adds salary_band."""
    if not {"salary_min", "salary_max"} <= set(df.columns):
        return df.withColumn("salary_band", F.lit(terms.BAND_NEGOTIABLE))
    return run(df, [band_step(df)])


def parse_deadline(
    df: DataFrame, deadline_col: str = "deadline", reference_date_col: str = "ingested_at"
) -> DataFrame:
    """STD-3: adds deadline_date."""
    return run(df, [deadline_step(df, deadline_col, reference_date_col)])


def standardize_location(df: DataFrame, place_col: str = "place") -> DataFrame:
    """STD-4: adds location."""
    return run(df, [location_step(df, place_col)])


def standardize_experience(df: DataFrame, exp_col: str = "experience") -> DataFrame:
    """STD-5: adds experience_req."""
    return run(df, [experience_step(df, exp_col)])


def standardize_level(df: DataFrame, level_col: str = "level") -> DataFrame:
    """STD-6: adds level_processed."""
    return run(df, [level_step(df, level_col)])


def standardize_working_type(df: DataFrame, wt_col: str = "working_type") -> DataFrame:
    """STD-7: adds working_type_std."""
    return run(df, [working_type_step(df, wt_col)])


def normalize_skills(df: DataFrame, skills_col: str = "skills") -> DataFrame:
    """STD-8: adds skills_array."""
    return run(df, [skills_step(df, skills_col)])


def enrich_skills_from_title(df: DataFrame, title_col: str = "job_title") -> DataFrame:
    """STD-9: extends skills_array; without it or the title, nothing changes."""
    if not {title_col, "skills_array"} <= set(df.columns):
        return df
    return run(df, [title_skills_step(df, title_col)])


def standardize_job_category(df: DataFrame, title_col: str = "job_title") -> DataFrame:
    """STD-10: adds job_category."""
    return run(df, [category_step(df, title_col)])


def standardize_company_size(df: DataFrame, size_col: str = "scale") -> DataFrame:
    """STD-11: adds company_size_std."""
    return run(df, [company_size_step(df, size_col)])


def generate_job_id(
    df: DataFrame, source_col: str = "source", url_col: str = "job_url"
) -> DataFrame:
    """STD-12: adds job_id."""
    return run(df, [job_id_step(df, source_col, url_col)])


def generate_company_id(df: DataFrame, company_name_col: str = "company_name") -> DataFrame:
    """STD-13: adds company_id."""
    return run(df, [company_id_step(df, company_name_col)])


def all_steps(df: DataFrame) -> list[Step]:
    """Every standardizer on conformed rows that already carry ``job_id``."""
    steps = [
        company_id_step(df),
        salary_step(df),
        band_step(df),
        deadline_step(df),
        location_step(df),
        experience_step(df),
        level_step(df),
        working_type_step(df),
        skills_step(df),
        category_step(df),
        company_size_step(df),
    ]
    if "job_title" in df.columns:
        steps.append(title_skills_step(df))
    return steps
