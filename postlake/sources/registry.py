"""The posting sources: landing schema and column names (SRC-1, SRC-6)."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import types as T

from postlake.operators.filters import CORRUPT


@dataclass(frozen=True)
class Source:
    name: str
    ddl: str
    renames: Mapping[str, str] = field(default_factory=dict)

    @property
    def table(self) -> str:
        return f"{self.name}_jobs"


# --- Fixed values: landing columns and renames per source -------------------
SOURCES = {
    source.name: source
    for source in (
        Source(
            "itviec",
            """job_title string, place string, is_accepted_intern string, working_type string,
            skills array<string>, company_name string, company_industry string,
            company_size string, company_place string, company_link string,
            working_days string, demands array<string>, benefits array<string>,
            inserted_at string, job_url string""",
            {"company_size": "scale", "company_place": "company_address"},
        ),
        Source(
            "vietnamworks",
            """job_title string, salary string, is_urgent string, deadline string,
            place string, level string, experience string, skills string,
            name_company string, scale string, field string, address string,
            link_company string, inserted_at string, job_url string""",
            {
                "name_company": "company_name", "field": "company_industry",
                "address": "company_address", "link_company": "company_link",
            },
        ),
        Source(
            "careerviet",
            """job_title string, company_name string, place string, salary string,
            experience string, level string, industry string, deadline string,
            requirements array<string>, benefits array<string>, skills array<string>,
            inserted_at string, job_url string""",
            {"industry": "company_industry"},
        ),
        Source(
            "topcv",
            """job_title string, salary string, deadline string, place string,
            experience string, level string, education string, working_type string,
            working_day string, working_hour string, skills array<string>,
            name_company string, scale string, field string, address string,
            link_company string, inserted_at string, job_url string""",
            {
                "name_company": "company_name", "field": "company_industry",
                "address": "company_address", "link_company": "company_link",
            },
        ),
    )
}


def get_source(name: str) -> Source:
    if name not in SOURCES:
        raise ValueError(f"unknown source {name!r}; known: {', '.join(SOURCES)}")
    return SOURCES[name]


def select_sources(name: str) -> list[Source]:
    """SRC-6: one source by name, or ``all``."""
    return list(SOURCES.values()) if name == "all" else [get_source(name)]


def load_schema(name: str, schema_dir: str | Path | None = None) -> T.StructType:
    """SRC-1: landing schema plus the corrupt-record column.

    ``schema_dir`` may hold ``<source>_schema.json`` files in Spark's own
    StructType format that replace the built-in schemas.
    """
    source = get_source(name)
    if schema_dir is None:
        schema = T.StructType.fromDDL(source.ddl)
    else:
        path = Path(schema_dir) / f"{name}_schema.json"
        if not path.exists():
            raise FileNotFoundError(f"no schema file for {name}: {path}")
        schema = T.StructType.fromJson(json.loads(path.read_text(encoding="utf-8")))
    return schema.add(CORRUPT, T.StringType(), True)
