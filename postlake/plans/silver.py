"""Bronze rows -> silver postings (PRJ-4, PRJ-5)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.operators import columns
from postlake.operators import standardize as std
from postlake.operators.filters import all_present, split_required
from postlake.operators.ranking import first_per_key, latest_first
from postlake.session import store

# --- Fixed values: silver columns, in order; text unless named below ------------
SILVER_COLUMNS = (
    "job_id", "source", "job_url", "job_title", "job_category", "company_id", "company_name",
    "company_link", "company_address", "company_industry", "location", "company_size_std",
    "experience_req", "level_processed", "education", "working_type_std", "working_day",
    "working_hour", "skills_array", "salary_raw", "salary_min", "salary_max",
    "salary_currency", "salary_band", "deadline_date", "inserted_at", "ingested_at",
)
SILVER_TYPES = {
    "skills_array": "array<string>", "salary_min": "double", "salary_max": "double",
    "deadline_date": "date", "ingested_at": "timestamp",
}

# --- Fixed values: silver upsert rule -------------------------------------------
GUARD = (
    "job_title", "job_category", "company_name", "location", "salary_raw",
    "deadline_date", "experience_req", "level_processed", "working_type_std",
)
KEEP = ("source", "ingested_at")

_COMPLETE = "_complete"


def conform_source(
    df: DataFrame, source: str, renames: Mapping[str, str] | None = None
) -> DataFrame:
    """PRJ-2, PRJ-3: one source's bronze rows under the common column names."""
    return columns.rename_present(columns.with_source(df, source), renames or {})


def standardized(df: DataFrame) -> DataFrame:
    """All standardizers on conformed rows; input columns stay."""
    if "job_id" not in df.columns:
        df = std.generate_job_id(df)
    return std.run(df, std.all_steps(df))


def to_silver(df: DataFrame) -> DataFrame:
    """Standardize and project onto the silver columns, NULL where absent."""
    types = {name: SILVER_TYPES.get(name, "string") for name in SILVER_COLUMNS}
    return columns.conform(standardized(df), types)


def one_per_posting(df: DataFrame, tie_breaks: Sequence[str] = ()) -> DataFrame:
    """DST-1 on conformed rows: the latest row of each posting."""
    return first_per_key(std.generate_job_id(df), ["job_id"], latest_first(df, tie_breaks))


def complete_postings(
    conformed: DataFrame, *, tie_breaks: Sequence[str] = (), dedup_first: bool = False
) -> DataFrame:
    """Silver rows of a batch.

    Rows are filtered, then reduced to one per posting, then standardized: the
    expressions run on surviving rows only and the exchange carries source
    columns.  ``dedup_first`` reduces before the filter, so a posting whose
    latest row is incomplete is rejected as a whole.
    """
    if dedup_first:
        return to_silver(split_required(one_per_posting(conformed, tie_breaks))[0])
    return latest_postings(split_required(conformed)[0], tie_breaks)


def rejected_postings(
    conformed: DataFrame, *, tie_breaks: Sequence[str] = (), dedup_first: bool = False
) -> DataFrame:
    """Rows lacking a required field, in silver shape; no exchange by default."""
    rows = one_per_posting(conformed, tie_breaks) if dedup_first else conformed
    return to_silver(split_required(rows)[1])


def split_stored(conformed: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """FLT-3 in one pass: (complete rows, rows lacking a required field), both written by one
    job below a flag partition and read back.

    Counting a half reads the footers of its files: what was written, not what was attempted.
    """
    spark = conformed.sparkSession
    flagged = conformed.withColumn(_COMPLETE, F.coalesce(all_present(conformed), F.lit(False)))
    path = store(flagged, name, _COMPLETE)
    halves = spark.read.schema(flagged.schema).parquet(path)
    return tuple(halves.where(F.col(_COMPLETE) == flag).drop(_COMPLETE) for flag in (True, False))


def latest_postings(complete: DataFrame, tie_breaks: Sequence[str] = ()) -> DataFrame:
    """Silver rows of complete rows: one per posting, then standardized."""
    return to_silver(one_per_posting(complete, tie_breaks))


def metrics_input(conformed: DataFrame) -> DataFrame:
    """The two columns the batch metrics need."""
    keyed = std.generate_job_id(conformed)
    return keyed.select("job_id", all_present(keyed).alias("complete"))


def with_updated_at(silver: DataFrame) -> DataFrame:
    """Silver keeps a known posting's first ``ingested_at``; this column follows
    every change, so that gold can pick up changed postings by day."""
    return silver.withColumn("updated_at", F.col("ingested_at"))
