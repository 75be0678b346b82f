"""Surrogate keys (STD-12, STD-13 and the star-schema keys)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlake.functions import terms
from postlake.functions.text import folded


def job_id(source: Column, url: Column) -> Column:
    """STD-12: never NULL; a NULL part is left out of the hashed text."""
    return F.md5(F.concat_ws(terms.JOB_ID_SEPARATOR, source, url))


def company_id(name: Column) -> Column:
    """STD-13."""
    return F.md5(folded(name))


def name_id(name: Column) -> Column:
    """Key of a dimension row identified by its name alone."""
    return F.md5(name)


def link_id(left: Column, right: Column) -> Column:
    """Key of a bridge row."""
    return F.md5(F.concat(left, right))
