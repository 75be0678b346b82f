"""Skill lists (STD-8, STD-9)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.functions import terms
from postlake.functions.text import literal, word_pattern


def no_skills() -> Column:
    return F.array().cast("array<string>")


def _without_blanks(items: Column) -> Column:
    return F.filter(F.transform(items, lambda item: F.trim(item)), lambda item: item != "")


def skill_list(skills: Column, kind: T.DataType) -> Column:
    """STD-8: dispatch on the declared type of the column.

    A NULL array stays NULL, a NULL or blank string is an empty list.
    """
    if isinstance(kind, T.ArrayType):
        return _without_blanks(skills)
    if isinstance(kind, T.StringType):
        return F.coalesce(_without_blanks(F.split(skills, ",")), no_skills())
    return no_skills()


def skills_found(title: str) -> Column:
    """Known skills standing in a lower-case title, in one pass of one regex."""
    pattern = f"({word_pattern(terms.TITLE_SKILLS)})"
    found = f"regexp_extract_all({title}, {literal(pattern)}, 1)"
    return F.expr(f"coalesce({found}, CAST(array() AS array<string>))")


def _positions() -> dict[str, list[int]]:
    """Listed position of each skill, and of those that stand inside its spelling.

    The regex takes the longest skill at a place; a shorter one within it
    ("react" in "react native") counts too.
    """
    listed = list(terms.TITLE_SKILLS)
    return {
        skill: [
            at
            for at, other in enumerate(listed, 1)
            if other == skill or re.search(rf"\b{re.escape(other)}\b", skill)
        ]
        for skill in listed
    }


def _skill_names(found: str) -> str:
    """Display names of found skills, in listed order, each once."""
    places = ", ".join(
        f"{literal(skill)}, array({', '.join(map(str, at))})" for skill, at in _positions().items()
    )
    names = ", ".join(literal(name) for name in terms.TITLE_SKILLS.values())
    listed = f"flatten(transform({found}, skill -> element_at(map({places}), skill)))"
    return f"transform(array_sort(array_distinct({listed})), at -> element_at(array({names}), at))"


def with_title_skills(skills: str, found: str) -> Column:
    """STD-9: given skills first, then those of the title, each once; NULL stays NULL."""
    return F.expr(
        f"""array_distinct(
        CASE WHEN size({found}) = 0 THEN {skills} ELSE concat({skills}, {_skill_names(found)}) END)"""
    )
